"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact links."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.components import components
from ripplelog.llm.frames import batches_of, cut, drop_cut, id_map, in_map, map_bit, share
from ripplelog.llm.words import Hasher, constants, mixed, shingles

SHINGLE = 5
THRESHOLD = (75, 100)
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Signatures are compared in batches of so many hashes.
BATCH = 32
#: A pair is pruned when the posterior probability that its similarity reaches the threshold falls
#: below this.
MISS = 1e-5
#: Documents, and shingles of them, in each half of a block that one task compares.
TILE, TILE_SHINGLES = 2048, 4_000_000
#: Up to this size, what the buckets join is one unit of comparison, above it each bucket is one. Either
#: way, the pairs that share a bucket are compared and no others.
WHOLE = 16_384


def least_matches(threshold: float, miss: float, hashes: int = HASHES, batch: int = BATCH) -> list[int]:
    """After each batch, the fewest equal hashes with which a pair stays.

    With a flat prior the similarity, given m of n equal hashes, has a Beta(m+1, n-m+1)
    distribution; its upper tail is a sum of binomial terms.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _set_hashes(grams: np.ndarray, bounds: np.ndarray, factors: np.ndarray) -> list[np.ndarray]:
    """Two numbers that together identify each set; 0 for an empty one."""
    out, some = [], np.flatnonzero(np.diff(bounds))
    for factor in factors[:2]:
        sums = np.zeros(len(bounds) - 1, np.uint64)
        if len(some):
            sums[some] = np.add.reduceat(mixed(grams ^ factor), bounds[:-1][some])
        out.append(sums.view(np.int64))
    return out


def _sign(df: DataFrame) -> DataFrame:
    """(id, n_shingles, h1, h2, bands, signature) of rows (id, text).

    h1 and h2 together identify the set of shingles; a signature holds 16 bits of each minimum.
    """

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, factors, band_factors = Hasher(), constants(HASHES, 3), constants(ROWS, 4)
        for batch in batches_of(rows, 2 << 20):
            grams, bounds = shingles(*hasher.words(batch.column(1)), SHINGLE)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            least = np.zeros((HASHES, len(sizes)), np.uint64)
            for k in range(HASHES if len(some) else 0):
                least[k, some] = np.minimum.reduceat(grams * factors[k], bounds[:-1][some])
            least = mixed(least)
            h1, h2 = _set_hashes(grams, bounds, factors)
            by_band = least.reshape(BANDS, ROWS, -1)
            bands = mixed((by_band * band_factors[:, None]).sum(1) + constants(BANDS, 5)[:, None])
            signature = np.ascontiguousarray((least >> np.uint64(48)).astype("<u2").T)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(h1),
                    pa.array(h2),
                    pa.array(list(np.ascontiguousarray(bands.T).view(np.int64)), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in signature], pa.binary()),
                ],
                ["id", "n_shingles", "h1", "h2", "bands", "signature"],
            )

    schema = "id bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>, signature binary"
    return df.mapInArrow(sign, schema)


def _grams(df: DataFrame, nodes: DataFrame) -> DataFrame:
    """(h1, h2, grams) of the nodes (node, h1, h2): their shingle sets, from rows (id, text)."""
    wanted = share(df.sparkSession, id_map(nodes, "node"))  # of fixed size

    def sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, factors, bits = Hasher(), constants(HASHES, 3), wanted()
        for batch in batches_of(rows, 2 << 20):
            batch = batch.filter(in_map(bits, batch.column(2)))
            grams, bounds = shingles(*hasher.words(batch.column(1)), SHINGLE)
            h1, h2 = _set_hashes(grams, bounds, factors)
            data = [grams[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]  # noqa: B905
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(h1), pa.array(h2), pa.array(data, pa.binary())],
                ["node", "h1", "h2", "grams"],
            )

    rows = df.where("id IS NOT NULL").select("id", "text", map_bit("id").alias("bit"))
    return rows.mapInArrow(sets, "node bigint, h1 bigint, h2 bigint, grams binary")


class _Forest:
    """Union-find over the rows of a block."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return int(x)


def _linked(
    half: np.ndarray, cross: bool, signature: np.ndarray, grams: np.ndarray, bounds: np.ndarray,
    stay: list[int], threshold: tuple[int, int],
) -> list[tuple[int, int]]:
    """Links that join the rows of a block as all its links do; no more of them than rows.

    Each row is compared with the later ones (of the other half, if ``cross``) that share a band with
    it and that links haven't joined with it yet: signatures first, batch by batch, then the full sets
    of the survivors. So a large group of copies costs little more than one row of comparisons.
    """
    n, size = len(half), np.diff(bounds)
    bands = signature.view("<u8")  # ROWS minima of 16 bits each
    shingle = np.unique(grams, return_inverse=True)[1].reshape(-1)
    marked = np.zeros(int(shingle.max(initial=0)) + 1, bool)
    forest, links = _Forest(n), []
    roots = forest.roots()
    other = np.flatnonzero(half) if cross else None
    for x in np.flatnonzero(half == 0) if cross else range(n - 1):
        y = other if cross else np.arange(x + 1, n)
        y = y[roots[y] != roots[x]]
        # A set that is too small or too large cannot reach the threshold.
        least, most = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
        y = y[threshold[1] * least >= threshold[0] * most]
        y = y[(bands[y] == bands[x]).any(1)]
        matches = np.zeros(len(y), np.int64)
        for step, fewest in enumerate(stay):
            part = slice(step * BATCH, (step + 1) * BATCH)
            matches += (signature[y, part] == signature[x, part]).sum(1)
            alive = matches >= fewest
            y, matches = y[alive], matches[alive]
        if not len(y):
            continue
        before = len(links)
        own = shingle[bounds[x] : bounds[x + 1]]
        marked[own] = True
        for some in np.array_split(y, -(-int(size[y].sum()) // 4_000_000)):
            lengths = size[some]
            starts = np.cumsum(lengths) - lengths
            places = np.arange(int(lengths.sum())) + np.repeat(bounds[some] - starts, lengths)
            both = np.add.reduceat(marked[shingle[places]].astype(np.int64), starts)
            good = threshold[1] * both >= threshold[0] * (size[x] + lengths - both)
            for z in some[good].tolist():
                a, b = forest.find(x), forest.find(z)
                if a != b:
                    forest.parent[max(a, b)] = min(a, b)
                    links.append((int(x), z))
        marked[own] = False
        if len(links) > before:
            roots = forest.roots()
    return links


def _compare(rows: DataFrame, stay: list[int], threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) found in blocks (unit, i, j), which are sorted together.

    Rows: unit, i, j, half, node, signature, grams.
    """

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in rows:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):  # noqa: B905
                if b == a:
                    continue
                here = tuple(key[:, a])
                if held and here != last:
                    yield from block(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = here
        if held:
            yield from block(held)

    def block(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        if whole.num_rows < 2:
            return
        half, node = whole["half"].to_numpy(), whole["node"].to_numpy()
        data = b"".join(whole["signature"].to_pylist())
        signature = np.frombuffer(data, "<u2").reshape(-1, HASHES)
        sets = whole["grams"].to_pylist()
        bounds = np.cumsum([0] + [len(x) // 8 for x in sets])
        grams = np.frombuffer(b"".join(sets), np.uint64)
        cross = whole["i"][0] != whole["j"][0]
        found = _linked(half, cross, signature, grams, bounds, stay, threshold)
        if found:
            a, b = np.array(found).T
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return rows.select("unit", "i", "j", "half", "node", "signature", "grams").mapInArrow(
        compare, "a bigint, b bigint"
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    miss: float = MISS,
) -> DataFrame:
    """One row per row: id, n_shingles, component_id, kept.

    Documents are linked when the sets of their five-word shingles have at least ``threshold``
    similarity; a component is what links reach, named by its least id, and kept is that id's.

    1. Equal sets become one node. MinHash bands put nodes into buckets.
    2. Nodes that buckets join, directly or through others, make a unit of comparison; if there are
       more than ``WHOLE`` of them, each of their buckets is one. This decides where pairs are
       compared, not which: within a unit, only those that share a band are. A unit is cut into halves of
       bounded size, and each pair of halves is a block, compared in one task.
    3. In a block, signatures are compared batch by batch, and a pair is dropped once the posterior
       probability that it reaches the threshold is below ``miss``. Survivors are verified on their
       full sets, unless links have joined them already. A block returns the links that join its
       rows, fewer than it has rows; components of these links are those of all links.

    So no pair that shares a bucket is left out, at any size, and no list of pairs is ever written.

    Null and blank texts have no shingles and link with nothing. Null ids take no part: component
    null, kept. Rows of one id are one document, linked with each other. Equal rows get equal results.
    Other columns don't matter. An empty table gives an empty table.
    """
    stay = least_matches(threshold[0] / threshold[1], miss)
    plain = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = cut(_sign(plain), "signed")
    used = signed.where("id IS NOT NULL AND n_shingles > 0")
    nodes = cut(
        used.groupBy("h1", "h2").agg(
            F.min("id").alias("node"),
            F.max("n_shingles").alias("size"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    classes = nodes.select("h1", "h2", "node")
    # Two sets may have one id; within the comparison each set is a node of its own.
    key = F.xxhash64("h1", "h2").alias("key")
    members = nodes.select(key, "size", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("least")).where("n > 1")
    members = cut(members.join(buckets.select("bucket", "least"), "bucket"), "members")
    groups = components(members.select(F.col("key").alias("a"), F.col("least").alias("b")))
    groups = groups.select(F.col("node").alias("key"), F.col("root").alias("group"))
    sizes = groups.groupBy("group").agg(F.count("*").alias("n")).where(f"n > {WHOLE}")
    placed = members.select("key", "size", "bucket").join(groups, "key").join(
        sizes.select("group", F.lit(True).alias("large")), "group", "left"
    )
    placed = placed.select("key", "size", F.when(F.col("large"), F.col("bucket")).otherwise(F.col("group")).alias("unit"), F.coalesce("large", F.lit(False)).alias("large"))
    placed = cut(placed.distinct(), "placed")
    units = placed.groupBy("unit", "large").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    halves = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    units = units.where("n > 1").select("unit", "large", halves.alias("halves"))
    mine = F.pmod(F.xxhash64("key"), F.col("halves")).cast("int")
    blocks = placed.join(units, ["unit", "large"]).select(
        # A bucket and a group may have the same number.
        F.xxhash64("unit", "large").alias("unit"), "key", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("halves") - 1)).alias("with"),
    )
    blocks = blocks.select(
        "unit",
        "key",
        F.least("mine", "with").alias("i"),
        F.greatest("mine", "with").alias("j"),
        (F.col("mine") > F.col("with")).cast("int").alias("half"),
    )
    chosen = nodes.select("h1", "h2", "node", "signature", key).join(placed.select("key").distinct(), "key", "left_semi")
    grams = _grams(plain, chosen.select("node")).dropDuplicates(["node", "h1", "h2"])
    full = chosen.join(grams, ["node", "h1", "h2"]).select("key", "node", "signature", "grams")
    rows = blocks.join(full, "key").repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    links = _compare(rows, stay, threshold)

    versions = used.join(classes, ["h1", "h2"]).select("id", "node")
    several = versions.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    versions = versions.join(several, "id").select("a", F.col("node").alias("b"))
    roots = components(links.union(versions))
    named = classes.join(roots, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("root"))
    result = signed.drop("bands", "signature").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("root")), "id"))
    kept = F.col("id").isNull() | (F.col("id") == component)
    result = cut(
        result.select("id", "n_shingles", component.alias("component_id"), kept.alias("kept")), "near"
    )
    for frame in (signed, nodes, members, placed):
        drop_cut(frame)
    return result


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near duplicates, with the columns of ``df``."""
    groups = near_duplicates(df, id_col=id_col, **options)
    gone = groups.where(~F.col("kept")).select(F.col("id").alias("gone")).distinct()
    # One kind of join at every size, so that what is shuffled grows with the documents.
    return df.join(gone.hint("merge"), df[id_col] == gone["gone"], "left_anti")
