"""Hard negatives by a vertical scan: dimension after dimension, in each anchor's own order.

Vectors are stored as blocks of one label's rows, a block as one column of whole numbers for each
dimension, with the least and the greatest value of each column. An anchor reads the columns of a
block in descending order of its own components' magnitude and adds up their products. What the
columns not read yet can still add lies between sums of their extremes, so every candidate's score
is known within bounds; a bitmap holds the candidates that can still be among the results, and
shrinks until the scores of those left are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplelog.files import remove
from ripplelog.llm.frames import cut
from ripplelog.llm.records import _filesystem
from ripplelog.llm.vectors import usable, whole_numbers
from ripplelog.session import workspace

#: Largest component, so that 100 times a score of 64 components fits 64 bits.
MOST = 1 << 25
#: Up to here, scores are whole numbers that doubles hold exactly.
_DOUBLES = 1 << 23
#: Rows of a block, rows a task holds while it goes through the anchors, anchors read at a time.
BLOCK, HELD, ANCHORS = 8192, 1 << 19, 4096
#: Dimensions read between two looks at the bounds.
STEP = 8

_STORE = "base bigint, ids binary, missing binary, labels binary, columns binary, low binary, high binary"
_ANCHOR = "anchor bigint, anchor_id bigint, label bigint, vector binary"


@dataclass
class Block:
    """Rows of one place in the store: ``columns[d]`` has dimension d of all of them."""

    base: int
    ids: np.ndarray
    missing: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(row: dict, dims: int) -> Block:
        columns = np.frombuffer(row["columns"], "<i4").reshape(dims, -1)
        low, high = np.frombuffer(row["low"], "<i8"), np.frombuffer(row["high"], "<i8")
        small = max(-low.min(), high.max()) <= _DOUBLES
        return Block(
            row["base"],
            np.frombuffer(row["ids"], "<i8"),
            np.frombuffer(row["missing"], bool),
            np.frombuffer(row["labels"], "<i8"),
            columns.astype(np.float64 if small else np.int64),
            low,
            high,
        )


#: Tells, from the sums so far and the least and most that can be added, who may still be a result.
Keep = Callable[[np.ndarray, int, int], np.ndarray]


def scan(anchor: np.ndarray, block: Block, alive: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
    """(positions, exact scores) of the candidates that are left after all dimensions."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = anchor * block.low, anchor * block.high
    # What the dimensions from the i-th of the order on can add at least and at most.
    least, most = (
        np.concatenate((np.cumsum(f(*ends)[order][::-1])[::-1], [0])) for f in (np.minimum, np.maximum)
    )
    exact = block.columns.dtype if np.abs(anchor).max(initial=0) <= _DOUBLES else np.dtype(np.int64)
    columns, factors = block.columns.astype(exact, copy=False), anchor.astype(exact)
    rows = None  # all rows, while many are candidates
    sums = np.zeros(len(alive), exact)
    for a in range(0, len(order), STEP):
        for d in order[a : a + STEP]:
            sums += factors[d] * (columns[d] if rows is None else columns[d][rows])
        at = min(a + STEP, len(order))
        if rows is None:
            seen = np.flatnonzero(alive)
            alive[seen] = keep(sums[seen], int(least[at]), int(most[at]))
            left = int(alive.sum())
            if 4 * left <= len(alive):
                rows = np.flatnonzero(alive)
                sums = sums[rows]
        else:
            stays = keep(sums, int(least[at]), int(most[at]))
            if not stays.all():
                rows, sums = rows[stays], sums[stays]
        if rows is not None and not len(rows):
            break
    if rows is None:
        rows = np.flatnonzero(alive)
        sums = sums[rows]
    return rows, sums.astype(np.int64)


def among_best(k: int, bar: int | None) -> Keep:
    """Candidates for the k greatest scores, where those below ``bar`` are out already."""

    def keep(sums: np.ndarray, least: int, most: int) -> np.ndarray:
        stays = np.ones(len(sums), bool) if bar is None else sums + most >= bar
        if len(sums) > k:
            stays &= sums + most >= np.partition(sums, -k)[-k] + least
        return stays

    return keep


def in_windows(k: int, windows: list[tuple[int, int, int | None]]) -> Keep:
    """Candidates for the k greatest scores within one of (lowest, highest, bar) at least."""

    def keep(sums: np.ndarray, least: int, most: int) -> np.ndarray:
        stays = np.zeros(len(sums), bool)
        for low, high, bar in windows:
            may = (sums + least <= high) & (sums + most >= (low if bar is None else max(low, bar)))
            sure = sums[(sums + least >= low) & (sums + most <= high)]
            if len(sure) >= k:
                may &= sums + most >= np.partition(sure, -k)[-k] + least
            stays |= may
        return stays

    return keep


class Best:
    """The k best (score, id) so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    @property
    def bar(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def add(self, block: Block, rows: np.ndarray, scores: np.ndarray) -> None:
        if not len(rows):
            return
        scores = np.concatenate((self.scores, scores))
        ids = np.concatenate((self.ids, block.ids[rows]))
        missing = np.concatenate((self.missing, block.missing[rows]))
        first = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[first], ids[first], missing[first]

    def pairs(self) -> list[tuple[int, int | None]]:
        return [
            (score, None if gone else key)
            for score, key, gone in zip(self.scores.tolist(), self.ids.tolist(), self.missing.tolist(), strict=True)
        ]


def write_vertical(rows: DataFrame, path: str, dims: int, scale: int, parts: int) -> None:
    """(id, label, vector) rows as blocks of columns, each mostly of one label."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, parts, held = TaskContext.get().partitionId() << 40, [], 0

        def block() -> pa.RecordBatch:
            nonlocal base
            ids, missing, labels, points = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = {
                "base": base, "ids": ids.tobytes(), "missing": missing.tobytes(), "labels": labels.tobytes(),
                "columns": np.ascontiguousarray(points.T, "<i4").tobytes(),
                "low": points.min(axis=0).tobytes(), "high": points.max(axis=0).tobytes(),
            }
            base += len(ids)
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                some = batch.slice(a, BLOCK)
                ids = some.column("id")
                parts.append((
                    ids.fill_null(0).to_numpy(zero_copy_only=False),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    some.column("label").to_numpy(zero_copy_only=False),
                    whole_numbers(some.column("vector"), scale, dims, MOST),
                ))
                held += some.num_rows
                if held >= BLOCK:
                    yield block()
                    parts, held = [], 0
        if held:
            yield block()

    by = ["label", F.xxhash64("id", "vector")]
    rows.repartitionByRange(parts, *by).sortWithinPartitions("label").mapInArrow(pack, _STORE).write.parquet(path)


def _anchors(store: DataFrame, dims: int, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, known by their place in the store."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row, dims)
                found = np.flatnonzero(~block.missing & (block.ids % every == 0))
                vectors = block.columns[:, found].T.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.base + found, pa.int64()),
                        pa.array(block.ids[found], pa.int64()),
                        pa.array(block.labels[found], pa.int64()),
                        pa.array([x.tobytes() for x in vectors], pa.binary()),
                    ],
                    ["anchor", "anchor_id", "label", "vector"],
                )

    return store.mapInArrow(pick, _ANCHOR)


def _visit(store: DataFrame, anchors: str, dims: int, result: Callable[[dict, list[Block]], list], schema: str) -> DataFrame:
    """``result(anchor, blocks)`` for every anchor and the blocks that a task holds at a time.

    The anchors are read from their table in the shared folder, some at a time, by each task: they
    go neither through the driver nor into memory as a whole.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                blocks.append(Block.of(row, dims))
                held += len(blocks[-1].ids)
                if held >= HELD:
                    yield from through(blocks)
                    blocks, held = [], 0
        if blocks:
            yield from through(blocks)

    def through(blocks: list[Block]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(anchors)
        for info in sorted(files.get_file_info(pafs.FileSelector(root)), key=lambda x: x.path):
            if not info.path.endswith(".parquet"):
                continue
            with files.open_input_file(info.path) as file:
                for some in pq.ParquetFile(file).iter_batches(ANCHORS):
                    out = [x for anchor in some.to_pylist() for x in result(anchor, blocks)]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x[i] for x in out], pa.int64()) for i in range(len(names))], names
                        )

    return store.mapInArrow(run, schema)


def _first(rows: DataFrame, k: int, by: list[str], score: str, key: str, rank: str) -> DataFrame:
    """The best k of each group; Spark cuts to k in each task before it shuffles."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(key))
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(
    df: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    every: int = 50,
    dims: int = 64,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) rows.

    Rows without a label take no part, nor do those whose vector hasn't ``dims`` components, all
    there and finite; each component becomes floor(scale * x). A score is an inner product; higher
    ones come first, ties by smaller id, null ids last. Rows whose id is divisible by ``every`` are
    anchors. Positives are an anchor's first other rows of its label; for each of them the first rows
    of other labels are returned whose score is from ``low`` to ``high`` per cent of the positive's.

    All rows are searched for every anchor, and the result is exact. Repeated rows are rows of their
    own: a copy of an anchor is an anchor, and a possible positive of the other. A row with a null
    id is no anchor. Other columns are not read. An empty table, or one without anchors, gives no
    rows. A component beyond ``MOST`` after scaling is an ArithmeticError.

    The rows are shuffled once, by label and a hash, so a label with most rows is spread over many
    blocks. A task sends at most ``positives`` (then ``positives * negatives``) rows for each anchor.
    """
    if dims > 64:
        raise ValueError("64-bit results are proved for up to 64 components")
    spark = df.sparkSession
    label = (F.col(label) if isinstance(label, str) else label).cast("bigint")
    rows = df.where(usable(vector_col, dims)).select(
        F.col(id_col).cast("bigint").alias("id"), label.alias("label"), F.col(vector_col).alias("vector")
    )
    blocks = max(1, -(-df.count() // BLOCK))  # at least as many as usable rows fill
    parts = max(min(blocks, spark.sparkContext.defaultParallelism), -(-blocks * BLOCK // HELD))
    stored, where, asked = (workspace(spark, name) for name in ("vertical", "anchors", "windows"))
    write_vertical(rows.where("label IS NOT NULL"), stored, dims, scale, parts)
    store = spark.read.schema(_STORE).parquet(stored)

    def nearest(anchor: dict, blocks: list[Block]) -> list:
        vector, best = np.frombuffer(anchor["vector"], "<i8"), Best(positives)
        for block in blocks:
            alive = block.labels == anchor["label"]
            own = anchor["anchor"] - block.base
            if 0 <= own < len(alive):
                alive[own] = False
            if alive.any():
                best.add(block, *scan(vector, block, alive, among_best(positives, best.bar)))
        return [(anchor["anchor"], score, key) for score, key in best.pairs()]

    _anchors(store, dims, every).write.parquet(where)
    anchors = spark.read.schema(_ANCHOR).parquet(where)
    near = _visit(store, where, dims, nearest, "anchor bigint, score bigint, id bigint")
    near = _first(near, positives, ["anchor"], "score", "id", "nth")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    anchors.join(listed, "anchor").write.parquet(asked)

    def negative(anchor: dict, blocks: list[Block]) -> list:
        vector = np.frombuffer(anchor["vector"], "<i8")
        bounds = [(-(-low * x["score"] // 100), high * x["score"] // 100) for x in anchor["near"]]
        found = [Best(negatives) for _ in bounds]
        for block in blocks:
            alive = block.labels != anchor["label"]
            windows = [(a, b, best.bar) for (a, b), best in zip(bounds, found, strict=True) if a <= b]
            if not windows or not alive.any():
                continue
            left, scores = scan(vector, block, alive, in_windows(negatives, windows))
            for (a, b), best in zip(bounds, found, strict=True):
                inside = (scores >= a) & (scores <= b)
                best.add(block, left[inside], scores[inside])
        return [
            (anchor["anchor"], x["nth"], anchor["anchor_id"], x["id"], x["score"], key, score)
            for x, best in zip(anchor["near"], found, strict=True)
            for score, key in best.pairs()
        ]

    schema = "anchor bigint, nth bigint, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    hard = _visit(store, asked, dims, negative, schema)
    hard = cut(_first(hard, negatives, ["anchor", "nth"], "negative_score", "negative_id", "rank"), "negatives")
    for used in (stored, where, asked):
        remove(spark, used)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
