"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplelog.llm.frames import SPACE, count_words

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
#: Each source is cut into 4096 slices by the leading 12 of a seeded hash's 60 bits, so that none
#: of its sums or orders needs one task.
SLICE_SHIFT = 48


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows (source, source_size, weight): one row per source.

    All sizes together are shared by weight. A source stops at ``max_epochs`` times its size; what
    it can't take is shared among the others by weight, until none is above. In order of cap over
    weight the clamped sources come first, so one running sum finds the level at which the rest
    stands. Sums are exact integers; a target is one division.
    """
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy((cap / F.col("weight")).asc(), F.col("place"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = sources.select(
        "*",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("weights"),
    )
    wide = "decimal(19,0)"
    fits = cap.cast(wide) * F.col("weights").cast(wide) <= F.col("left").cast(wide) * F.col("weight").cast(wide)
    # The level is set by the first source that isn't clamped; all after it stand at that level.
    level = F.min(F.when(~fits, F.struct(cap / F.col("weight"), "place", "left", "weights"))).over(whole)
    ranked = ranked.select("*", fits.alias("clamped"), level.alias("level"))
    free = F.col("level.left") * F.col("weight") / F.col("level.weights")
    target = F.when(F.col("clamped"), cap.cast("double")).otherwise(free).cast("double")
    return ranked.withColumn("target", target).drop("left", "weights", "clamped", "level", "place")


def _key(source: str) -> list[Column]:
    return [F.col(source).isNull().alias("no_source"), F.coalesce(F.col(source), F.lit("")).alias("key")]


def seeded(value: Column, seed: int) -> Column:
    """60 bits of the hash of the value as text and of the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    carry: bool = False,
) -> DataFrame:
    """One row per row: id, size in words, source_size, target, taken (words the mix takes).

    Sources in code point order, null last, get the weights in turn. A source with target t and
    size s repeats each document floor(t/s) times; the rest of t is filled with whole documents in
    a seeded order, and the document on the border gives its first words only, so the words taken
    from a source are its target, rounded. ``carry`` keeps the row as struct ``row``.

    Null or blank texts have size 0 and take 0; a null source is a source of its own; equal rows
    are independent rows. Ties in the seeded order are broken by id and then by size, which leaves
    only rows that can change places. Other columns don't matter. An empty table gives an empty
    table. A source may hold any share of the rows: it is summed and ordered in slices.
    """
    size = count_words(F.col(text_col))
    u = seeded(F.col(id_col), seed)
    slice_ = F.shiftright(u, SLICE_SHIFT).alias("slice")
    base = df.select(
        *([F.struct("*").alias("row")] if carry else []),
        F.col(id_col).alias("id"),
        *_key(source_col),
        size.alias("size"),
        u.alias("u"),
        slice_,
    )
    narrow = df.select(*_key(source_col), size.alias("size"), slice_)
    part = ["no_source", "key", "slice"]
    sums = narrow.groupBy(*part).agg(F.sum("size").alias("slice_size"))
    by_source = Window.partitionBy("no_source", "key").orderBy("slice")
    sums = sums.select(
        *part,
        F.coalesce(
            F.sum("slice_size").over(by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
        F.sum("slice_size").over(Window.partitionBy("no_source", "key")).alias("source_size"),
    )
    rank = F.row_number().over(Window.orderBy("no_source", "key")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = (
        sums.groupBy("no_source", "key")
        .agg(F.max("source_size").alias("source_size"))
        .withColumn("place", rank)
        .withColumn("weight", weight.cast("bigint"))
    )
    plan = sums.drop("source_size").join(water_fill(sources, max_epochs), ["no_source", "key"])
    order = Window.partitionBy(*part).orderBy("u", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = base.withColumn("ahead", F.coalesce(F.sum("size").over(order), F.lit(0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.round(F.col("target")).cast("bigint") - whole * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before") - F.col("ahead")))
    return ordered.join(plan, part).select(
        *(["row"] if carry else []),
        "id",
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + extra).cast("bigint").alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    words = F.regexp_extract_all(text, F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    return F.concat_ws("", F.slice(words, 1, F.greatest(n, F.lit(1)).cast("int")))


def repeat_documents(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus: rows of ``df`` repeated as ``mix`` decides, with the columns of ``df``.

    A row that the mix takes k and a fraction times comes k times whole and once with its first
    words. Rows without words carry nothing that could be taken and stay out.
    """
    mixed = mix(df, text_col=text_col, carry=True, **options)
    size, taken = F.col("size"), F.col("taken")
    whole = F.floor(taken / F.greatest(size, F.lit(1))).cast("int")
    part = (taken % F.greatest(size, F.lit(1))).cast("bigint")
    rest = F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    copies = mixed.where(taken > 0).select(
        "row", "size", F.explode(F.concat(F.array_repeat(size, whole), rest)).alias("words")
    )
    text = F.when(F.col("words") == F.col("size"), F.col(f"row.`{text_col}`")).otherwise(
        first_words(F.col(f"row.`{text_col}`"), F.col("words"))
    )
    return copies.select(
        *[text.alias(n) if n == text_col else F.col(f"row.`{n}`").alias(n) for n in df.columns]
    )
