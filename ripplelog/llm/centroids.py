"""Clusters around integer centroids; the nearest one is found by a tournament of bisectors.

The points that are as near to centroid a as to centroid b lie on a plane. With integer vectors its
normal 2 (b - a) and its threshold b.b - a.a are integers, so one product and one comparison tell
exactly on which side of it a vector lies. Against k centroids a vector takes k - 1 such tests: the
winner so far meets the next one, and a vector on the plane stays with the smaller number. Only the
distance to the last winner is computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import cut
from ripplelog.llm.vectors import usable, whole_numbers

#: Largest component, so that every product and distance of 64 components fits 64 bits.
MOST = 1 << 26
#: Up to here, all of them are whole numbers that doubles hold exactly.
_DOUBLES = 1 << 21
#: Sums travel as digits to this base, so that Spark can add any number of them in 64 bits.
_BASE = 1 << 40
_BATCH = 8192


class Tournament:
    """Normals and thresholds of all pairs of some centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]
        self.small = not centroids.size or np.abs(centroids).max() <= _DOUBLES

    def winners(self, points: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each point, the smallest among equally near ones."""
        exact = np.float64 if self.small and np.abs(points).max(initial=0) <= _DOUBLES else np.int64
        points, normals = points.astype(exact), self.normals.astype(exact)
        best = np.zeros(len(points), np.int32)
        for challenger in range(1, len(self.centroids)):
            for holder in range(challenger):
                rows = np.flatnonzero(best == holder)
                beyond = points[rows] @ normals[holder, challenger] > self.thresholds[holder, challenger]
                best[rows[beyond]] = challenger
        return best

    def distances(self, points: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        away = points - self.centroids[numbers]
        return (away * away).sum(axis=1)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        value, digit = divmod(value, _BASE)
        yield place, sign * digit
        place += 1


def _first(vectors: DataFrame, k: int, dims: int, scale: int, seed: int) -> np.ndarray:
    """The k vectors whose ids hash lowest; equal ids are ordered by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(digest, "vector").limit(k).toArrow()  # k rows
    return whole_numbers(rows.column("vector").combine_chunks(), scale, dims, MOST)


def _moved(vectors: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """Each centroid that won a vector replaced by the floor of the mean of those it won."""
    games = Tournament(centroids)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * (dims + 1) for _ in centroids]  # a column for the count
        for batch in batches:
            for a in range(0, batch.num_rows, _BATCH):
                points = whole_numbers(batch.column("vector").slice(a, _BATCH), scale, dims, MOST)
                best = games.winners(points)
                for number in np.unique(best).tolist():
                    won = points[best == number]
                    added = [*won.sum(axis=0).tolist(), len(won)]
                    sums[number] = [x + y for x, y in zip(sums[number], added, strict=True)]
        out = [(c, d, *digit) for c, row in enumerate(sums) for d, x in enumerate(row) for digit in _digits(x)]
        names = ("cluster", "dim", "place", "digit")
        yield pa.RecordBatch.from_pydict(
            {name: pa.array([row[i] for row in out], pa.int64()) for i, name in enumerate(names)}
        )

    # At most one row per centroid, component and place of digits reaches the driver.
    parts = vectors.select("vector").mapInArrow(total, "cluster bigint, dim bigint, place bigint, digit bigint")
    sums = [[0] * (dims + 1) for _ in centroids]
    for c, d, place, digit in parts.groupBy("cluster", "dim", "place").agg(F.sum("digit")).collect():
        sums[c][d] += digit * _BASE**place
    rows = [[x // row[-1] for x in row[:-1]] if row[-1] else old for row, old in zip(sums, centroids.tolist(), strict=True)]
    return np.array(rows, np.int64).reshape(centroids.shape)


def cluster(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(rows (id, cluster, distance, cluster_inertia, inertia), final centroids), all in whole numbers.

    A vector takes part if it has ``dims`` components, none null or not finite; each becomes
    floor(scale * x). The first centroids are the k vectors whose ids hash lowest with the seed
    (fewer if there are fewer vectors). A round moves each centroid that is nearest to some vector
    to the floor of their mean; one without vectors stays, also where two centroids are equal and
    the smaller number wins all.

    Null ids take part and hash as empty text; repeated rows count each time; other columns are not
    read, so their names don't matter. A table without a usable vector gives no rows. A component
    beyond ``MOST`` after scaling is an ArithmeticError, since distances would leave 64 bits.

    Each round reads the vectors once and shuffles k * (dims + 1) sums per task, never a vector, so
    equal vectors or one large cluster do no harm. ``df`` is read rounds + 2 times: pass a table.
    """
    if dims > 64:
        raise ValueError("64-bit results are proved for up to 64 components")
    vectors = df.where(usable(vector_col, dims)).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector")
    )
    centroids = _first(vectors, k, dims, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(vectors, centroids, dims, scale)
    games = Tournament(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _BATCH):
                points = whole_numbers(batch.column("vector").slice(a, _BATCH), scale, dims, MOST)
                best = games.winners(points)
                columns = [batch.column("id").slice(a, _BATCH), best, games.distances(points, best)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "cluster", "distance"])

    assigned = cut(vectors.mapInArrow(assign, "id bigint, cluster int, distance bigint"), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    own = {row[0]: row[1] for row in sums.collect()}  # a row per centroid
    inertia = F.lit(None).cast("bigint")
    for number, value in own.items():
        inertia = F.when(F.col("cluster") == number, F.lit(value).cast("bigint")).otherwise(inertia)
    whole = F.lit(sum(own.values())).cast("bigint")
    return assigned.withColumns({"cluster_inertia": inertia, "inertia": whole}), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """sha256 of each centroid's components as decimal numbers, comma-joined."""
    return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
