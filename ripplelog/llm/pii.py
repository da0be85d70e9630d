"""Personal data: fixed shapes, and identifiers that contexts learnt from them reveal.

All of it is DataFrame functions. Patterns are written so that a match is only tried where one can
begin and never tried in more than one way, which gives the same matches in time proportional to
the text: ``++`` marks runs that what follows could not take part of anyway.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import SPACE, cut, drop_cut, let

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"
#: Distinct seeds that a context must surround, and the share of its instances they must make.
SUPPORT, PRECISION = 5, 0.8

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_SHAPES = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Strings without white space, and those of them that hold a digit.
_WORD = rf"[^{SPACE}]++"
_TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9]*+[0-9][^{SPACE}]*+"
#: Marks around an instance, and those that open a word before one.
_LEFT, _RIGHT, _OPEN = "^[^A-Za-z0-9+]+", "[^A-Za-z0-9]+$", rf"(?<![^{SPACE}])[^A-Za-z0-9+{SPACE}]++$"
#: Code points of a word that count in a context.
_WIDE = 64
#: Matches of a shape, of three code points or more with what parts them, that surely reach back so far.
_BACK = 2 * _WIDE // 3 + 2

#: Whether a value may be one that was asked for.
Test = Callable[[Column], Column]

_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_BASE = "array<struct<kind:string,start:bigint,end:bigint,instance:bigint,context:string>>"
_TOKENS = "array<struct<start:bigint,end:bigint,instance:bigint,context:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        small = lambda x: let(
            F.regexp_replace(x, "^0+(?=[0-9])", ""),
            lambda d: F.when(F.length(d) <= 3, d.cast("int") <= 255).otherwise(F.lit(False)),
        )
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return let(_digits(match), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _running(values: Column) -> Column:
    """Sum of the values before each value. In blocks, so that long arrays are not copied often."""
    block, none = 512, F.array().cast("array<bigint>")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
        lambda b: F.slice(values, b * block + 1, F.lit(block)),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), none.alias("all"))
    within = F.transform(
        blocks,
        lambda v: F.aggregate(
            v, start, lambda s, x: F.struct((s["n"] + x).alias("n"), F.concat(s["all"], F.array(s["n"])).alias("all"))
        ),
    )
    nested = F.struct(F.lit(0).cast("bigint").alias("n"), F.array().cast("array<array<bigint>>").alias("all"))
    return F.aggregate(
        within,
        nested,
        lambda s, x: F.struct(
            (s["n"] + x["n"]).alias("n"),
            F.concat(s["all"], F.array(F.transform(x["all"], lambda y: y + s["n"]))).alias("all"),
        ),
        lambda s: F.flatten(s["all"]),
    )


def matches(text: Column, shape: str) -> Column:
    """Structs (before, match, start) of the leftmost non-overlapping matches, start in code points.

    ``before`` is the text between the match before and this one.
    """
    found = F.struct(F.regexp_extract_all(text, F.lit(shape), F.lit(0)).alias("m"), F.split(text, shape, -1).alias("p"))
    size = lambda x: F.length(x).cast("bigint")

    def placed(x: Column) -> Column:
        pairs = F.transform(x["m"], lambda m, i: F.struct(F.get(x["p"], i).alias("before"), m.alias("match")))
        starts = _running(F.transform(pairs, lambda y: size(y["before"]) + size(y["match"])))
        return let(
            starts,
            lambda s: F.transform(
                pairs,
                lambda y, i: F.struct(
                    y["before"].alias("before"), y["match"].alias("match"), (F.get(s, i) + size(y["before"])).alias("start")
                ),
            ),
        )

    none = F.array().cast("array<struct<before:string,match:string,start:bigint>>")
    return let(found, lambda x: F.when(F.size(x["m"]) > 0, placed(x)).otherwise(none))


def _known(word: Column) -> Column:
    """A word as it counts in a context: its end, in lower case, with runs of digits (or ``#``) as ``#``."""
    marked = F.translate(F.lower(F.right(word, F.lit(_WIDE))), "0123456789", "#" * 10)
    return let(marked, lambda x: F.when(F.contains(x, F.lit("##")), F.regexp_replace(x, "#+", "#")).otherwise(x))


def _context(ahead: Column) -> Column:
    """The last two words of the text before an instance."""
    words = F.filter(F.split(ahead, f"[{SPACE}]+"), lambda w: w != "")
    return F.concat_ws(" ", F.transform(F.reverse(F.slice(F.reverse(words), 1, 2)), _known))


def _ahead(all_: Column, i: Column, back: int) -> Column:
    """The text before match ``i``, from ``back`` matches earlier or the start of the text on."""
    first = F.greatest(i - back, F.lit(0))
    pieces = F.transform(F.slice(all_, first + 1, i - first), lambda y, j: F.concat(F.when(j > 0, y["before"]).otherwise(F.when(first > 0, "").otherwise(y["before"])), y["match"]))
    start = F.when(first == 0, F.lit("^ ^ ")).otherwise("")
    return F.concat(start, F.array_join(pieces, ""), F.get(all_, i)["before"])


def base_spans(text: Column) -> Column:
    """Spans of the fixed shapes by kind and start; matches that fail their test are dropped.

    Structs (kind, start, end, instance, context): the whole span, hashed, and the two words before.
    """

    def of(kind: str) -> Column:
        def span(x: Column, i: Column, all_: Column) -> Column:
            good = F.struct(
                F.lit(kind).alias("kind"),
                x["start"].alias("start"),
                (x["start"] + F.length(x["match"])).cast("bigint").alias("end"),
                F.xxhash64(x["match"]).alias("instance"),
                _context(F.regexp_replace(_ahead(all_, i, _BACK), _OPEN, "")).alias("context"),
            )
            return F.when(_valid(kind, x["match"]), good)

        placed = let(matches(text, _SHAPES[kind]), lambda all_: F.transform(all_, lambda x, i: span(x, i, all_)))
        can = F.contains(text, F.lit("@")) if kind == "email" else text.rlike("[0-9]")
        return F.when(can, F.filter(placed, lambda x: x.isNotNull())).otherwise(F.array()).cast(_BASE)

    return F.concat(*[of(kind) for kind in KINDS])


def tokens(text: Column, base: Column) -> Column:
    """Runs of adjacent strings with a digit, none touched by a base span, as structs (start, end,
    instance, context). The instance is hashed without the marks around it."""

    def word(x: Column) -> Column:
        end = (x["start"] + F.length(x["match"])).cast("bigint")
        touched = F.exists(base, lambda s: (s["start"] < end) & (s["end"] > x["start"]))
        return F.struct(x["start"].alias("start"), end.alias("end"), touched.alias("touched"))

    def run(first: Column, last: Column, all_: Column) -> Column:
        text = F.array_join(F.transform(F.slice(all_, first + 1, last - first + 1), lambda x: x["match"]), " ")
        head, tail = F.get(all_, first), F.get(all_, last)
        start = head["start"] + F.length(head["match"]) - F.length(F.regexp_replace(head["match"], _LEFT, ""))
        end = tail["start"] + F.length(F.regexp_replace(tail["match"], _RIGHT, ""))
        return F.struct(
            start.cast("bigint").alias("start"),
            end.cast("bigint").alias("end"),
            F.xxhash64(F.regexp_replace(F.regexp_replace(text, _LEFT, ""), _RIGHT, "")).alias("instance"),
            _context(_ahead(all_, first, 2)).alias("context"),
        )

    def runs(all_: Column) -> Column:
        def found(words: Column) -> Column:
            def joined(i: Column) -> Column:
                """Whether word ``i`` goes on with the run of the word before."""
                free = ~F.get(words, i)["touched"] & ~F.get(words, i - 1)["touched"]
                return F.coalesce(free & (F.get(words, i)["start"] - F.get(words, i - 1)["end"] == F.length(F.get(all_, i)["before"])) & ~F.get(all_, i)["before"].rlike(f"[^{SPACE}]"), F.lit(False))

            place = F.sequence(F.lit(0), F.size(words) - 1)
            firsts = F.filter(place, lambda i: ~F.get(words, i)["touched"] & ~joined(i))
            lasts = F.filter(place, lambda i: ~F.get(words, i)["touched"] & ~joined(i + 1))
            return let(lasts, lambda ends: F.transform(firsts, lambda i, n: run(i, F.get(ends, n), all_)))

        return F.when(F.size(all_) > 0, let(F.transform(all_, word), found)).otherwise(F.array().cast(_TOKENS))

    found = F.filter(let(matches(text, _TOKEN), runs), lambda x: x["end"] > x["start"])
    return F.when(text.rlike("[0-9]"), found).otherwise(F.array()).cast(_TOKENS)


def _core(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, _LEFT, ""), _RIGHT, "")


def _plain(word: Column) -> Column:
    """Whether a word has neither a digit nor an email; the other shapes need a digit."""
    mail = F.contains(word, F.lit("@")) & word.rlike(_SHAPES["email"])
    return word.rlike("[A-Za-z]") & ~word.rlike("[0-9]") & ~mail


def _follows(names: Column, i: Column) -> Column:
    mark = F.lit("^")
    return F.concat_ws(" ", F.coalesce(F.get(names, i - 2), mark), F.coalesce(F.get(names, i - 1), mark))


def contexts(text: Column) -> Column:
    """Structs (h, word): each string of a text and its context, hashed."""
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    pair = lambda w, context: F.struct(F.xxhash64(context).alias("h"), w.alias("word"))
    of = lambda w: let(F.transform(w, _known), lambda names: F.transform(w, lambda x, i: pair(x, _follows(names, i))))
    return let(words, of)


def plain_words(text: Column, key: str, test: Test) -> Column:
    """Strings without digits as structs (context, instance), the word hashed without marks around
    it: those whose context or instance, as ``key`` says, passes the test."""

    def edge(word: Column, context: Column) -> Column:
        made = lambda own: F.struct(context.alias("context"), own.alias("instance"))
        if key == "context":
            return F.when(test(context) & _plain(word), made(F.xxhash64(_core(word))))
        return F.when(_plain(word), let(F.xxhash64(_core(word)), lambda own: F.when(test(own), made(own))))

    def of(words: Column) -> Column:
        edges = lambda names: F.transform(words, lambda w, i: let(_follows(names, i), lambda c: edge(w, c)))
        return F.filter(let(F.transform(words, _known), edges), lambda x: x.isNotNull())

    return let(F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""), of)


def placed_words(text: Column, test: Test) -> Column:
    """The same words as structs (start, end, context), where the context passes the test."""

    def word(x: Column, i: Column, names: Column) -> Column:
        start = x["start"] + F.length(x["match"]) - F.length(F.regexp_replace(x["match"], _LEFT, ""))
        span = F.struct(
            start.cast("bigint").alias("start"),
            (start + F.length(_core(x["match"]))).cast("bigint").alias("end"),
            _follows(names, i).alias("context"),
        )
        return F.when(test(_follows(names, i)) & _plain(x["match"]), span)

    def of(all_: Column) -> Column:
        names = F.transform(all_, lambda x: _known(x["match"]))
        return F.filter(let(names, lambda n: F.transform(all_, lambda x, i: word(x, i, n))), lambda x: x.isNotNull())

    return let(matches(text, _WORD), of)


#: A context's seeds and likely instances must be one in so many of the strings that follow it. Any
#: share will do, unless a smaller number is set: precision alone decides.
RARITY = math.inf
#: Slots of a map of hashed keys, and how many share an entry of it.
_SLOTS, _ENTRY = 1 << 17, 32


def _may_hold(keys: DataFrame, key: str, hashed: bool = False) -> Test:
    """A test that is true of the keys, and of few others while they are fewer than the slots.

    It spares work and never decides: a map of fixed size that stands in the plan itself.
    """
    number = lambda x: x if hashed else F.xxhash64(x)
    slot = F.pmod(number(F.col(key)), F.lit(_SLOTS))
    marks = keys.select(F.floor(slot / _ENTRY).cast("int").alias("at"), (slot % _ENTRY).cast("int").alias("bit"))
    marks = marks.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    held = {row.at: row.bits for row in marks.collect()}  # at most _SLOTS / _ENTRY rows
    table = F.expr("array(" + ",".join(f"{held.get(i, 0)}L" for i in range(_SLOTS // _ENTRY)) + ")")

    def test(value: Column) -> Column:
        own = F.pmod(number(value), F.lit(_SLOTS))
        bit = F.pow(F.lit(2.0), own % _ENTRY).cast("bigint")
        return F.get(table, F.floor(own / _ENTRY).cast("int")).bitwiseAND(bit) > 0

    return test


class Words:
    """The strings of a corpus without a digit, as edges of the graph of contexts and instances."""

    def __init__(self, texts: DataFrame):
        self.texts = texts
        self.counted: DataFrame | None = None

    def edges(self, key: str, test: Test) -> DataFrame:
        """Edges (context, instance) whose ``key`` passes the test, as often as they occur."""
        return self.texts.select(F.explode(plain_words(F.col("text"), key, test)).alias("t")).select("t.*")

    def rare(self, sums: DataFrame, precision: float) -> DataFrame:
        """Contexts whose score can make the ``precision``: all but those that more distinct words
        follow than that allows (and, if ``RARITY`` is set, more strings).

        The words of all contexts asked about are counted exactly, in one pass over the corpus; so the
        edges of those that are left are in proportion to their scores, and none that could be
        trusted is left out.
        """
        named = sums.groupBy("context").agg(F.max("score").alias("score")).withColumn("h", F.xxhash64("context"))
        new = named if self.counted is None else named.join(self.counted, "h", "left_anti")
        new = cut(new.select("h").distinct(), "asked")
        if not new.isEmpty():
            each = self.texts.select(F.explode(contexts(F.col("text"))).alias("t")).select("t.*")
            each = each.where(_may_hold(new, "h", hashed=True)(F.col("h")))
            own = F.when(_plain(F.col("word")), F.xxhash64(_core(F.col("word")))).alias("instance")
            pairs = each.select("h", own).groupBy("h", "instance").agg(F.count(F.lit(1)).alias("n"))
            found = pairs.groupBy("h").agg(F.sum("n").alias("strings"), F.count("instance").alias("words"))
            counts = cut(new.join(found, "h", "left").na.fill(0, ["strings", "words"]), "strings")
            self.counted = counts if self.counted is None else self.counted.unionByName(counts)
        drop_cut(new)
        if self.counted is None:
            return named.select("context")
        most = F.col("score") / precision * (1 + 1e-9) if precision > 0 else F.lit(math.inf)
        can = F.col("words") <= most
        if RARITY < math.inf:
            can &= F.col("strings") <= F.col("score") * RARITY
        return named.join(self.counted, "h").where(can).select("context")


class _Asked:
    """The distinct edges of words whose key was asked for, a table for each time some were."""

    def __init__(self, words: Words, key: str, none: DataFrame):
        self.words, self.key = words, key
        self.all, self.tables = none, []

    def ask(self, wanted: DataFrame) -> None:
        new = cut(wanted.select(self.key).distinct().join(self.all, self.key, "left_anti"), "asked")
        if new.isEmpty():
            return
        self.all = self.all.unionByName(new)
        found = self.words.edges(self.key, _may_hold(new, self.key, self.key == "instance")).groupBy("context", "instance").agg(F.count(F.lit(1)))
        self.tables.append((new, cut(found.select("context", "instance"), "words")))

    def edges(self, of: DataFrame) -> list[DataFrame]:
        """Edges of some of the keys that were asked for."""
        return [
            found.join(new.join(of.select(self.key).distinct(), self.key, "left_semi"), self.key, "left_semi")
            for new, found in self.tables
        ]

    def counts(self) -> list[DataFrame]:
        """Distinct edges (n) of each key; counted before anything is joined."""
        return [
            found.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).join(new, self.key, "left_semi")
            for new, found in self.tables
        ]

    def drop(self) -> None:
        for new, found in self.tables:
            drop_cut(new)
            drop_cut(found)


def learn_contexts(
    edges: DataFrame,
    support: int = SUPPORT,
    precision: float = PRECISION,
    rounds: int | None = None,
    words: Words | None = None,
) -> DataFrame:
    """Contexts to be trusted, (context, kind), from edges (context, instance, kind or null).

    Instances matched by a fixed shape are seeds of score 1. In each round a context's precision for
    a kind is the mean score of the distinct instances it surrounds, and it is trusted if that and
    the sum of scores are high enough; an instance's score is the chance that one of its trusted
    contexts is right. Scores and so the trusted contexts only grow; rounds end when these are the
    same as before, or after ``rounds``. Both steps are partial aggregates over edges that are
    distinct already.

    ``words`` gives more edges without a kind, as many as the corpus has words; none of their
    instances may be one of ``edges``. Edges of words are made distinct in each task and never joined
    as a whole: of contexts with enough support the number of their words is counted, and only of
    those whose precision these allow the edges are made (few, since most of them go to seeds), and
    of newly scored instances theirs. With ``RARITY``, support is relative, too.
    """
    distinct = cut(edges.groupBy("context", "instance").agg(F.min("kind").alias("kind")), "edges")
    seeds = distinct.where("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score"))
    pairs = distinct.select("context", "instance")
    scores, trusted, turn, used = seeds, None, 0, [distinct]
    behind, around = (_Asked(words, key, pairs.select(key).limit(0)) for key in ("context", "instance"))

    while True:
        known = reduce(DataFrame.unionByName, [pairs, *around.edges(scores)])
        sums = known.join(scores, "instance").groupBy("context", "kind").agg(F.sum("score").alias("score"))
        sums = cut(sums.where(F.col("score") >= support), "sums")
        if words is not None:
            rare = cut(words.rare(sums, precision), "rare")
            used += [sums, rare]
            sums = sums.join(rare, "context", "left_semi")
            behind.ask(sums)
        own = pairs.join(sums.select("context").distinct(), "context", "left_semi").groupBy("context").agg(F.count("*").alias("n"))
        total = reduce(DataFrame.unionByName, [own, *behind.counts()]).groupBy("context").agg(F.sum("n").alias("n"))
        good = sums.join(total, "context")
        good = good.withColumn("precision", F.col("score") / F.col("n")).where(F.col("precision") >= precision)
        last, trusted, turn = trusted, cut(good.select("context", "kind", "precision"), "contexts"), turn + 1
        used += [trusted] if words is not None else [sums, trusted]
        if turn == rounds or trusted.isEmpty():
            break
        if last is not None and trusted.join(last, ["context", "kind"], "left_anti").isEmpty():
            break  # precisions may still move, the contexts that are trusted do not
        miss = F.exp(F.sum(F.log1p(-F.least(F.col("precision"), F.lit(0.999)))))
        theirs = reduce(DataFrame.unionByName, [pairs, *behind.edges(trusted)])
        gained = theirs.join(trusted, "context").groupBy("instance", "kind").agg((1 - miss).alias("score"))
        gained = cut(gained.join(seeds.select("instance"), "instance", "left_anti"), "gained")
        used.append(gained)
        if words is not None:
            around.ask(gained)
        scores = seeds.unionByName(gained)
    out = cut(trusted.select("context", "kind"), "trusted")
    for rows in used:
        drop_cut(rows)
    behind.drop()
    around.drop()
    return out


def find_identifiers(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = SUPPORT,
    precision: float = PRECISION,
    rounds: int | None = None,
) -> DataFrame:
    """One row per row: id, base, learnt; arrays of structs (kind, start, end) in code points.

    ``base`` holds the fixed shapes by kind and start. ``learnt`` holds, by start, runs of adjacent
    strings with a digit, and strings without one, that no fixed shape touches and that follow a
    context which the corpus shows to surround one kind of identifier; their kind is ``context``.
    Contexts are learnt from all rows; fixed shapes are their seeds, whole and with spaces.

    Null and empty texts have no spans. Null ids and repeated rows are fine; equal rows get equal
    results. Other columns don't matter. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = df.select(F.col(id_col).alias("id"), text.alias("text"))
    same = F.xxhash64("text").alias("same")
    found = let(base_spans(F.col("text")), lambda b: F.struct(b.alias("seeds"), tokens(F.col("text"), b).alias("tokens")))
    rows = cut(source.select("id", same, found.alias("found")).select("id", "same", "found.*"), "identifiers")
    base = F.transform("seeds", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    seeds = rows.select(F.explode("seeds").alias("t")).select("t.context", "t.instance", "t.kind")
    each = rows.select("id", "same", F.explode("tokens").alias("t")).select("id", "same", "t.*")
    edges = seeds.unionByName(each.select("context", "instance", F.lit(None).cast("string").alias("kind")))
    found_contexts = learn_contexts(edges, support, precision, rounds, Words(source)).select("context").distinct()
    new = each.join(found_contexts, "context", "left_semi").select("id", "same", "start", "end")
    if not found_contexts.isEmpty():
        test = _may_hold(found_contexts, "context")
        placed = source.select("id", same, F.explode(placed_words(F.col("text"), test)).alias("t")).select("id", "same", "t.*")
        new = new.unionByName(placed.join(found_contexts, "context", "left_semi").select("id", "same", "start", "end"))
    span = F.struct("start", "end")
    # Spans of one text only, so a group is bounded by its text.
    new = new.groupBy("id", "same").agg(F.sort_array(F.collect_set(span)).alias("found"))
    new = new.select(F.col("id").alias("id2"), F.col("same").alias("same2"), "found")
    both = rows.join(new, rows["id"].eqNullSafe(new["id2"]) & (rows["same"] == new["same2"]), "left")
    learnt = F.transform(
        F.coalesce("found", F.array().cast("array<struct<start:bigint,end:bigint>>")),
        lambda x: F.struct(F.lit(FOUND).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    return both.select("id", base.cast(_SPANS).alias("base"), learnt.alias("learnt"))
