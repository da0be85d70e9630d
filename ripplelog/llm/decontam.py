"""Benchmark decontamination by suffix arrays of the training texts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import batches_of, share, text_bytes

WINDOW = 10
#: Characters of test items that are searched at once.
BLOCK_CHARS = 32 << 20
#: Bytes of training text under one suffix array, or one text.
SHARD_BYTES = 8 << 20

# Letters, digits and everything beyond ASCII make words; A-Z count as a-z.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

_INTERVAL = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_MATCH = pa.struct(
    [("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("words", pa.int64())]
)
_FOUND = "n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>, matches array<struct<item:string,item_start:bigint,start:bigint,words:bigint>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class TestSet:
    """The suffixes of test items, by their first words, ready to be searched for.

    Items with the same words are one entry with several ids.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        by_words: dict[tuple, set[str]] = defaultdict(set)
        self.vocabulary: dict[bytes, int] = {}
        for item, text in items:
            numbers = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text))
            if numbers:
                by_words[numbers].add(item)
        self.ids = [sorted(x) for x in by_words.values()]
        owners: dict[tuple, list[tuple[int, int, int, int]]] = defaultdict(list)
        for n, numbers in enumerate(by_words):
            # The words on both sides; beyond the item's ends there are numbers that no text has.
            beside = (-1, *numbers, -1)
            for j in range(max(1, len(numbers) - window + 1)):
                key = numbers[j : j + window]
                owners[key].append((n, j, beside[j], beside[j + 1 + len(key)]))
        self.lengths = np.array([len(x) for x in owners], np.int64)
        low = np.zeros((len(owners), window), ">u4")
        high = np.full((len(owners), window), 0xFFFFFFFF, ">u4")
        for n, numbers in enumerate(owners):
            low[n, : len(numbers)] = high[n, : len(numbers)] = numbers
        self.low, self.high = self._keys(low), self._keys(high)
        self.owners = [np.array(x, np.int64) for x in owners.values()]
        self.shortest = int(self.lengths.min()) if owners else 0
        self.begins = np.zeros(len(self.vocabulary) + 1, bool)
        self.begins[low[:, 0].astype(np.int64)] = True

    def _keys(self, rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows).view(f"S{4 * self.window}").ravel()

    def search(self, texts: list[bytes]) -> list[tuple[int, list, list, list]]:
        """For each text: number of words, hit intervals, ids of items found, longest matches.

        The suffix array holds each position at which a test suffix could begin. Every test suffix
        is looked up by binary search; occurrences on one diagonal join to one longest match, of which
        only the two ends are looked for.
        """
        get = self.vocabulary.get
        coded, sizes = [], []
        for text in texts:
            numbers = [get(w, 0) for w in words_of(text)]
            sizes.append(len(numbers))
            coded += numbers
            coded.append(0)  # no match goes from one text to the next
        found: list[tuple[int, list, list, list]] = [(n, [], [], []) for n in sizes]
        if not self.owners:
            return found
        ids = np.array(coded + [0] * self.window, np.int64)
        # Number of known words from each position on, up to the window.
        gap = np.flatnonzero(ids == 0)
        at = np.flatnonzero(self.begins[ids])
        run = np.minimum(gap[np.searchsorted(gap, at)] - at, self.window)
        at, run = at[run >= self.shortest], run[run >= self.shortest]
        if not len(at):
            return found
        grid = ids[at[:, None] + np.arange(self.window)]
        grid[np.arange(self.window) >= run[:, None]] = 0
        keys = self._keys(grid.astype(">u4"))
        order = np.argsort(keys, kind="stable")
        keys, suffixes = keys[order], at[order]
        first = np.searchsorted(keys, self.low, "left")
        last = np.searchsorted(keys, self.high, "right")
        starts = np.cumsum([0] + [n + 1 for n in sizes])
        # A match is longest if it can't go on to either side. Its first and its last window are found
        # each by itself, and the n-th of each on a diagonal belong together; a repeated window costs
        # no more than the longest matches it takes part in.
        heads, tails = [], []
        for n in np.flatnonzero(first < last):
            places, width = np.sort(suffixes[first[n] : last[n]]), self.lengths[n]
            own = self.owners[n]
            heads.append(_unlike(places, np.where(places > 0, ids[places - 1], 0), own, own[:, 2]))
            tails.append(_unlike(places + width, ids[places + width], own + [0, width, 0, 0], own[:, 3]))
        item, at, begin = _on_diagonals(heads)
        stop = _on_diagonals(tails)[2]
        doc = np.searchsorted(starts, begin, "right") - 1
        for k in np.lexsort((begin, begin - at, item, doc)):
            d = int(doc[k])
            start, words = int(begin[k] - starts[d]), int(stop[k] - begin[k])
            for name in self.ids[item[k]]:
                found[d][2].append(name)
                found[d][3].append({"item": name, "item_start": int(at[k]), "start": start, "words": words})
            found[d][1].append({"start": start, "end": start + words})
        return [(n, hits, sorted(set(names)), matches) for n, hits, names, matches in found]


def _unlike(places: np.ndarray, beside: np.ndarray, owners: np.ndarray, words: np.ndarray) -> np.ndarray:
    """(item, place in the item, place) of the places and owners that have different words beside them.

    At most one word is beside more than half of the owners, so the work is in proportion to what
    comes out.
    """
    if len(owners) == 1:
        chosen = places[beside != words[0]]
        return np.stack([np.full(len(chosen), owners[0, 0]), np.full(len(chosen), owners[0, 1]), chosen])
    out = []
    order = np.argsort(beside, kind="stable")
    cuts = np.flatnonzero(np.diff(beside[order])) + 1
    for group in np.split(order, cuts):
        other = owners[words != beside[group[0]]]
        out.append(
            np.stack([np.repeat(other[:, 0], len(group)), np.repeat(other[:, 1], len(group)), np.tile(places[group], len(other))])
        )
    return np.concatenate(out, axis=1)


def _on_diagonals(pieces: list[np.ndarray]) -> np.ndarray:
    """(item, place in the item, place) sorted by item, diagonal and place."""
    if not pieces:
        return np.zeros((3, 0), np.int64)
    item, at, place = rows = np.concatenate(pieces, axis=1)
    return rows[:, np.lexsort((place, place - at, item))]


def _scan(df: DataFrame, block: list[tuple[str, bytes]], window: int) -> DataFrame:
    """Adds what of the block occurs in ``text``; drops the text."""
    carried = [f for f in df.schema.fields if f.name != "text"]
    shared = share(df.sparkSession, TestSet(block, window))

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared()
        for batch in batches_of(rows, SHARD_BYTES):
            found = tests.search(text_bytes(batch.column(batch.schema.get_field_index("text"))))
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            new = [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], pa.list_(_INTERVAL)),
                pa.array([x[2] for x in found], pa.list_(pa.string())),
                pa.array([x[3] for x in found], pa.list_(_MATCH)),
            ]
            names = [f.name for f in carried] + ["n_words", "hits", "items", "matches"]
            yield pa.RecordBatch.from_arrays(kept + new, names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    return df.mapInArrow(scan, f"{schema}, {_FOUND}")


def _union_size(intervals: Column) -> Column:
    """Words in the union of intervals."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    return F.aggregate(
        F.array_sort(intervals),
        zero,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["end"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def find_test_text(
    df: DataFrame,
    tests: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_id: str = "item_id",
    test_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    carry: bool = False,
) -> DataFrame:
    """One row per row: id, n_words, n_hit, items, matches, contaminated.

    ``matches`` are the longest stretches of at least ``window`` words (or of a whole shorter item)
    that a text shares with an item: item, place in the item, place in the text, length in words.
    ``n_hit`` counts words inside any of them, ``items`` are the ids found, sorted as strings.
    Test items are broadcast in blocks of bounded size; each block's suffixes are searched in the
    suffix arrays of all shards of ``df``. ``carry`` keeps the row as struct ``row``.

    Null and empty texts have no words and are clean; items without words are in no text; items
    with equal ids are one item, and a null id counts as the empty string; equal rows get equal
    results, one each; other columns are not looked at. An empty table on either side is fine.
    """
    chars = tests.agg(F.sum(F.length(test_text))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    items = tests.select(
        F.coalesce(F.col(test_id).cast("string"), F.lit("")).alias("item"),
        F.col(test_text).alias("text"),
    ).withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))

    def block(n: int) -> list[tuple[str, bytes]]:
        chosen = items.where((F.col("block") == n) & F.col("text").isNotNull())
        return sorted((r.item, r.text.encode()) for r in chosen.select("item", "text").toLocalIterator())

    rows = df.select(
        *([F.struct("*").alias("row")] if carry else []),
        F.col(id_col).alias("id"),
        *([F.xxhash64(id_col, text_col).alias("same")] if blocks > 1 else []),
        F.col(text_col).alias("text"),
    )
    found = _scan(rows, block(0), window)
    for n in range(1, blocks):
        # Equal rows have equal results, so one row for each id and text is enough to join.
        more = _scan(rows.drop("row"), block(n), window).where(F.size("items") > 0)
        more = more.dropDuplicates(["id", "same"]).select(
            F.col("id").alias("id2"),
            F.col("same").alias("same2"),
            *[F.col(c).alias(f"{c}2") for c in ("hits", "items", "matches")],
        )
        both = found.join(
            more, found["id"].eqNullSafe(more["id2"]) & (found["same"] == more["same2"]), "left"
        )
        joined = lambda c: F.when(F.col(f"{c}2").isNull(), F.col(c)).otherwise(F.concat(c, f"{c}2")).alias(c)
        found = both.select(
            *[joined(c) if c in ("hits", "items", "matches") else F.col(c) for c in found.columns]
        )
    return found.select(
        *(["row"] if carry else []),
        "id",
        "n_words",
        _union_size(F.col("hits")).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        "matches",
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_test_text(df: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """Rows of ``df`` that share no window with a test item, with the columns of ``df``."""
    found = find_test_text(df, tests, carry=True, **options).where(~F.col("contaminated"))
    return found.select(*[F.col(f"row.`{n}`").alias(n) for n in df.columns])
