"""Small helpers that several operators share."""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.session import workspace

SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    Ends the lineage, so that a lost executor costs a read and not a recomputation.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete what ``cut`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not at each place where the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast a value of bounded size; the result gives it inside tasks.

    It is pickled with its class, which executors need not have.
    """
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def kept(name: str, make: Callable[[], object]) -> object:
    """A value that lives as long as the Python worker and so serves all its tasks."""
    store = sys.modules.setdefault("_ripplelog_kept", types.ModuleType("_ripplelog_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


#: Bits of a map of hashed ids.
MAP_BITS = 1 << 23


def map_bit(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(MAP_BITS))


def id_map(ids: DataFrame, id_col: str) -> np.ndarray:
    """A bit map of fixed size that holds the ids, hashed; it spares work and never decides."""
    words = ids.select(
        F.floor(map_bit(id_col) / 64).cast("int").alias("word"), (map_bit(id_col) % 64).cast("int").alias("bit")
    )
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    out = np.zeros(MAP_BITS // 64, np.int64)
    got = words.toArrow()  # at most MAP_BITS / 64 rows
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def in_map(bits: np.ndarray, column: pa.Array) -> pa.Array:
    """Which values of ``map_bit`` may belong to an id of the map."""
    bit = column.to_numpy().astype(np.uint64)
    return pa.array(((bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool))


def count_words(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts as empty."""
    runs = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SPACE}]+", "x")
    return F.length(F.regexp_replace(runs, f"[{SPACE}]+", "")).cast("bigint")


def batches_of(rows: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many bytes, or of one row."""
    for batch in rows:
        pieces = [batch]
        while pieces:
            piece = pieces.pop()
            if piece.num_rows > 1 and piece.get_total_buffer_size() > most_bytes and piece.nbytes > most_bytes:
                half = piece.num_rows // 2
                pieces += [piece.slice(half), piece.slice(0, half)]
            elif piece.num_rows:
                yield piece


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
