"""Repeated passages by sparse suffixes at minimiser positions, sorted and compared with neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import batches_of, cut, drop_cut, id_map, in_map, map_bit, share
from ripplelog.llm.words import Hasher, constants, mixed

#: Least length of a passage in words, and of the prefix that its minimiser is taken from. They differ
#: by less than 63, as the places of a minimiser in passages are kept as bits.
PASSAGE, PREFIX = 50, 16
#: Parts of the rows of one context, when passages go back to their documents.
SALT = 8
_BASE = 0xD6E8FEB86659FD93


class _Sums:
    """Hashes of stretches of words, by differences of one running sum."""

    def __init__(self, words: np.ndarray):
        steps = np.full(len(words) + 1, _BASE, np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        self.inverse = np.multiply.accumulate(steps)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[:-1], dtype=np.uint64)))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[begin]) * self.inverse[begin])


class _Text:
    """Passages of a batch of texts, and the suffixes retained for them."""

    def __init__(self, hasher: Hasher, column: pa.Array, passage: int, prefix: int):
        self.words, self.offsets = hasher.words(column)
        self.passage, self.prefix, self.span = passage, prefix, passage - prefix
        self.sums = _Sums(self.words)
        places = np.arange(max(len(self.words) - prefix + 1, 0))
        self.keys = self.sums.of(places, places + prefix)
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))
        self.starts = np.flatnonzero(np.arange(len(self.words)) + passage <= ends)
        #: Place of the least prefix hash in each passage; equal passages choose equal places.
        self.least = self.starts
        if len(self.starts):
            view = np.lib.stride_tricks.sliding_window_view(self.keys, self.span + 1)
            chosen = np.empty(len(view), np.int64)
            for a in range(0, len(chosen), 1 << 16):
                chosen[a : a + (1 << 16)] = view[a : a + (1 << 16)].argmin(1)
            self.least = self.starts + chosen[self.starts]

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, "right") - 1

    def contexts(self, places: np.ndarray) -> np.ndarray:
        """Hash of all words that passages around a minimiser can have, and of where it is in them."""
        text = self.owner(places)
        begin = np.maximum(places - self.span, self.offsets[text])
        end = np.minimum(places + self.passage, self.offsets[text + 1])
        edges = constants(2, 9)
        where = (places - begin).astype(np.uint64) * edges[0] + (end - places).astype(np.uint64) * edges[1]
        return mixed(self.sums.of(begin, end) + where)

    def letters(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Four bits of each word behind the prefix, and of each word before it, nearest first; 0 beyond
        the text. Equal words have equal bits, two to a byte."""
        bits = np.append(np.maximum(self.words >> np.uint64(60), np.uint64(1)).astype(np.uint8), np.uint8(0))
        text, steps, none = self.owner(places), np.arange(self.span), len(self.words)
        right = places[:, None] + self.prefix + steps
        right = np.where(right < self.offsets[text + 1][:, None], right, none)
        left = places[:, None] - 1 - steps
        left = np.where(left >= self.offsets[text][:, None], left, none)
        return bits[right], bits[left]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of four-bit numbers, two to a byte."""
    rows = np.pad(rows, ((0, 0), (0, rows.shape[1] % 2)))
    return pa.array([x.tobytes() for x in rows[:, ::2] << 4 | rows[:, 1::2]], pa.binary())


def _letters(column: pa.ChunkedArray, span: int) -> np.ndarray:
    """What ``_binary`` packed."""
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, -(-span // 2))
    return np.stack([packed >> 4, packed & 15], axis=2).reshape(len(packed), -1)[:, :span]


def _suffixes(df: DataFrame, passage: int, prefix: int) -> DataFrame:
    """(id, place, context, key, right, left): the suffixes retained for each text."""

    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches_of(rows, 4 << 20):
            text = _Text(hasher, batch.column(1), passage, prefix)
            places = np.unique(text.least)
            owner = text.owner(places)
            right, left = text.letters(places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array((places - text.offsets[owner]).astype(np.int64)),
                    pa.array(text.contexts(places).view(np.int64)),
                    pa.array(text.keys[places].view(np.int64)),
                    _binary(right),
                    _binary(left),
                ],
                ["id", "place", "context", "key", "right", "left"],
            )

    schema = "id bigint, place bigint, context bigint, key bigint, right binary, left binary"
    return df.select("id", "text").mapInArrow(emit, schema)


def _agreement(df: DataFrame, column: str, span: int) -> DataFrame:
    """Adds ``agree`` to rows with a key, low and high: sorted by key and ``column``, in how many words of
    that column a row agrees with the better one of its neighbours; -1 if neither has its key.

    No other row of the key agrees in more. Rows of several documents agree in all words, and so do, to
    be safe, the first and the last one of a partition, whose neighbours are elsewhere. Words are told
    by four bits here, so it may be more than the words themselves, never less.
    """
    names = df.columns

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, span  # the last row, and its agreement with the row before it
        for batch in rows:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            key = both["key"].to_numpy()
            data = _letters(both[column], span)
            same = np.append(data[1:] == data[:-1], np.zeros((len(key) - 1, 1), bool), axis=1).argmin(1)
            same = np.where(key[1:] == key[:-1], same, -1)
            around = np.concatenate(([before], same))
            if len(same):
                yield from done(both.slice(0, len(same)), np.maximum(around[:-1], around[1:]))
            held, before = both.slice(len(same)).to_batches()[0], around[-1]
        if held is not None:
            yield from done(pa.Table.from_batches([held]), np.array([span]))

    def done(part: pa.Table, agree: np.ndarray) -> Iterator[pa.RecordBatch]:
        several = part["low"].to_numpy() < part["high"].to_numpy()
        agree = pa.array(np.where(several, span, agree).astype(np.int32))
        yield from part.append_column("agree", agree).to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = df.sort("key", column, "context").select(*names)
    return rows.mapInArrow(compare, f"{kinds}, agree int")


def _extended(df: DataFrame, passage: int, prefix: int) -> DataFrame:
    """(passage, context, back, low, high) for rows (id, text, wanted): each context that is wanted,
    extended to the passages around its minimiser that begin between ``least`` and ``most`` words
    before it."""

    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches_of(rows, 2 << 20):
            text = _Text(hasher, batch.column(1), passage, prefix)
            lists = batch.column(2)
            flat = lists.flatten()
            if not len(flat) or not len(text.starts):
                continue
            bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            # A context together with its text, as one number.
            salt = mixed(np.arange(len(lists), dtype=np.uint64))
            column = lambda name: flat.field(name).to_numpy()  # noqa: B023, E731
            known = column("context").view(np.uint64) ^ salt[np.repeat(np.arange(len(lists)), np.diff(bounds))]
            order = np.argsort(known)
            known = known[order]
            context = text.contexts(text.least)
            mine = context ^ salt[text.owner(text.starts)]
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            back, row = text.least - text.starts, order[at]
            hit = (known[at] == mine) & (back >= column("least")[row]) & (back <= column("most")[row])
            starts, row = text.starts[hit], row[hit]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(text.sums.of(starts, starts + passage).view(np.int64)),
                    pa.array(context[hit].view(np.int64)),
                    pa.array(back[hit].astype(np.int32)),
                    pa.array(column("low")[row]),
                    pa.array(column("high")[row]),
                ],
                ["passage", "context", "back", "low", "high"],
            )

    schema = "passage bigint, context bigint, back int, low bigint, high bigint"
    return df.select("id", "text", "wanted").mapInArrow(emit, schema)


def _joined(df: DataFrame, passage: int) -> DataFrame:
    """(id, start, end, other) from rows (id, places), arrays of (place, backs, other): the union of
    passages that meet, other being the least of theirs. backs has a bit for each passage, by how many
    words before the place it begins."""

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(rows, 4 << 20):
            lists = batch.column(1)
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            place, other = flat.field("place").to_numpy(), flat.field("other").to_numpy()
            backs = flat.field("backs").to_numpy()
            found = [np.flatnonzero((backs >> back) & 1) for back in range(passage)]
            start = np.concatenate([place[x] - back for back, x in enumerate(found)])
            row = np.concatenate(found)
            owner, other = owner[row], other[row]
            order = np.lexsort((start, owner))
            owner, start, other = owner[order], start[order], other[order]
            if not len(start):
                continue
            new = np.ones(len(start), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + passage)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(start)) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner[first])),
                    pa.array(start[first]),
                    pa.array(start[last] + passage),
                    pa.array(np.minimum.reduceat(other, first)),
                ],
                ["id", "start", "end", "other"],
            )

    return df.select("id", "places").mapInArrow(merge, "id bigint, start bigint, end bigint, other bigint")


def repeated_passages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, prefix: int = PREFIX
) -> DataFrame:
    """One row (id, start, end, other) per stretch of words that also stands in another document.

    A stretch is a union of passages of ``passage`` words, each of which another document holds word
    for word (A-Z in either case, any white space between). start and end count words, end exclusive.
    other is a document that shares some of it: the least id that does, or, in that document itself,
    the greatest.

    1. Of all suffixes, those at the minimisers of passages are kept; equal passages keep equal ones.
       Suffixes with equal words around them, as copies have, are one context from here on.
    2. Contexts are sorted by their first ``prefix`` words and then word by word, and each is compared
       with its neighbours: no other context agrees with it further to the right. Those that share the
       prefix with a neighbour are sorted by the words to the left, and compared in the same way.
    3. A context whose agreements to both sides make a passage is extended to the passages that lie
       within them. The best neighbours of the two sides may be different documents, so these passages
       are at last compared as a whole, by hash.

    Sorting is by ranges of whole contexts, so a prefix may begin any share of the suffixes, and least
    and greatest ids are partial aggregates, so a passage may stand in any share of the documents; no
    pairs are built. Null ids are left out, texts that are null, empty or shorter than a passage have no
    rows, rows with one id are one document, and a text that repeats itself alone doesn't count. Other
    columns don't matter; an empty table gives an empty table.
    """
    span = passage - prefix
    plain = df.where(F.col(id_col).isNotNull())
    plain = plain.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    suffixes = cut(_suffixes(plain, passage, prefix), "suffixes")
    first = [F.first(name).alias(name) for name in ("key", "right", "left")]
    contexts = suffixes.groupBy("context").agg(*first, F.min("id").alias("low"), F.max("id").alias("high"))
    right = _agreement(contexts, "right", span).where("agree >= 0").drop("right")
    right = cut(right.withColumnRenamed("agree", "ahead"), "right")
    both = _agreement(right, "left", span).withColumn("least", F.lit(span) - F.col("ahead"))
    both = both.where("least <= agree").select("context", "low", "high", "least", F.col("agree").alias("most"))
    # Contexts of one document, so a group is bounded by its text.
    wanted = F.collect_list(F.struct("context", "least", "most", "low", "high")).alias("wanted")
    asked = cut(both.groupBy(F.col("low").alias("id")).agg(wanted), "asked")
    ids = share(df.sparkSession, id_map(asked, "id"))  # of fixed size

    def sieve(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = ids()
        for batch in rows:
            yield batch.filter(in_map(bits, batch.column(2))).select(["id", "text"])

    texts = plain.select("id", "text", map_bit("id").alias("bit")).mapInArrow(sieve, "id bigint, text string")
    passages = cut(_extended(texts.join(asked, "id"), passage, prefix), "passages")
    ends = passages.groupBy("passage").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most")
    backs = F.bit_or(F.expr("shiftleft(1L, back)")).alias("backs")
    marks = passages.join(ends, "passage").groupBy("context", "least", "most").agg(backs)
    marks = marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = suffixes.select("id", "place", "context", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int").alias("salt"))
    other = F.when(F.col("id") == F.col("least"), F.col("most")).otherwise(F.col("least")).alias("other")
    rows = rows.join(marks, ["context", "salt"]).select("id", F.struct("place", "backs", other).alias("place"))
    result = cut(_joined(rows.groupBy("id").agg(F.collect_list("place").alias("places")), passage), "repeats")
    for frame in (suffixes, right, asked, passages):
        drop_cut(frame)
    return result
