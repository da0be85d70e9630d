"""Document fingerprints by one-permutation MinHash, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplelog.llm.frames import SPACE, let

SHINGLE = 5
#: Bins are the leading 8 bits of a shingle's hash.
BINS, BIN_SHIFT = 256, 56
#: Low-order bits kept of each bin, one hex digit.
BITS = 4
#: Bins that an empty bin probes by hash before it falls back to a fixed order of all bins.
PROBES = 12
_REST = (1 << BIN_SHIFT) - 1


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of all word shingles; a text with fewer words is one shingle, without words none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), f"[{SPACE}]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grams(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1)))
        found = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(size))))
        return F.when(F.size(w) > 0, found).otherwise(F.array().cast("array<bigint>"))

    return let(hashes, grams)


def _bins(hashes: Column) -> Column:
    """The least hash of each bin; null for an empty bin.

    One value that ends each bin is added, so in sorted order each bin has a first element.
    """
    ends = F.array(*[F.lit((((b - BINS // 2) << BIN_SHIFT) | _REST)) for b in range(BINS)])
    of = lambda h: F.shiftright(h, BIN_SHIFT)
    # The element before the first is an element, too: get() of a negative index is null.
    first = lambda s: F.filter(s, lambda h, i: (i == 0) | (of(F.get(s, i - 1)) != of(h)))
    held = lambda h: F.when(h.bitwiseAND(F.lit(_REST)) != _REST, h)
    return F.transform(let(F.sort_array(F.concat(hashes, ends)), first), held)


def _densified(bins: Column) -> Column:
    """Empty bins filled from others: by seeded probes, then by the fixed order of the bin's hashes.

    Every bin has one probing order for all documents, and takes the first bin in it that holds
    something, so two documents agree in a filled bin as often as in any other.
    """
    every = F.sequence(F.lit(0), F.lit(BINS - 1))

    def fill(v: Column) -> Column:
        full = F.filter(every, lambda j: F.get(v, j).isNotNull())
        return let(
            full,
            lambda some: F.transform(
                every,
                lambda i: F.coalesce(
                    F.get(v, i),
                    *[F.get(v, F.pmod(F.xxhash64(i, F.lit(a)), F.lit(BINS)).cast("int")) for a in range(PROBES)],
                    F.get(v, F.array_min(F.transform(some, lambda j: F.struct(F.xxhash64(j, i), j.alias("j"))))["j"]),
                ),
            ),
        )

    return let(bins, fill)


def fingerprint(text: Column) -> Column:
    """256 hex digits, four low-order bits for each bin; the empty string if there are no words.

    Null counts as empty. Equal texts have equal fingerprints.
    """
    # The bin takes part in the bits, so copies of one hash don't agree by chance all at once.
    digit = lambda h, i: F.hex(F.xxhash64(h, i).bitwiseAND(F.lit((1 << BITS) - 1)))
    packed = let(
        shingle_hashes(text),
        lambda h: F.when(
            F.size(h) > 0, F.concat_ws("", F.transform(_densified(_bins(h)), digit))
        ).otherwise(F.lit("")),
    )
    return F.lower(packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, 0 to 1, without the share of chance agreement.

    Bins of unlike documents agree by chance in one of 2**BITS cases. Two empty fingerprints are
    alike, an empty and another one are not.
    """
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda x: x))
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(corrected)


def with_next(
    df: DataFrame, id_col: str, columns: list[str], per_bucket: int = 256, most: int = 100_000
) -> DataFrame:
    """Adds ``next``, the struct of ``columns`` of the row after in id order; the last gets the first's.

    Ids are cut into at most ``most`` ranges of equal width. The first row of a range also goes,
    marked, to the range before, so one shuffle by range brings each row together with the one after.
    Null ids come first; rows of one id stand in the order of ``columns``. Ids may be dense or
    hashed; where they crowd in one range, that range's rows are sorted on disk in one task.
    """
    low, high, n = df.agg(F.min(id_col), F.max(id_col), F.count("*")).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // min(most, max(1, n // per_bucket))))
    wide = (F.col(id_col).cast("decimal(20,0)") - F.lit(low or 0).cast("decimal(20,0)")) / F.lit(width)
    bucket = F.coalesce(F.floor(wide).cast("bigint"), F.lit(-1).cast("bigint"))
    order = Window.orderBy("bucket")
    heads = df.groupBy(bucket.alias("bucket")).agg(F.min(id_col).alias("head"))
    # At most ``most`` + 1 rows of three numbers.
    heads = heads.select(
        "head", F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("before")
    )
    marked = df.withColumn("bucket", bucket).join(
        F.broadcast(heads), F.col(id_col).eqNullSafe(F.col("head")), "left"
    )
    here, there = F.struct("bucket", F.lit(False).alias("ghost")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("ghost"))
    places = F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there))
    placed = marked.select(*df.columns, F.explode(places).alias("place"))
    within = Window.partitionBy("place.bucket").orderBy("place.ghost", F.col(id_col).asc_nulls_first(), *columns)
    return (
        placed.withColumn("next", F.lead(F.struct(*columns)).over(within)).where(~F.col("place.ghost")).drop("place")
    )


def compare_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points replaced by as many from the start of the
    next text in id order, or by all of it. Null texts count as empty; null ids come first, rows of
    equal id stand in the order of their texts; a single row is its own next. Other columns don't
    matter; an empty table gives an empty table. Texts go through one shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(F.col(id_col).alias("id"), text.alias("text"))
    base = base.withColumn("fingerprint", fingerprint(F.col("text")))
    rows = with_next(base, "id", ["text", "fingerprint"])
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next.text", F.lit(1), cut))
    rows = rows.select(
        "id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "fingerprint", F.col("next.fingerprint").alias("following")
    )
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
    )
