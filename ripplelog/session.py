"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_REQUIRED = {
    # A JSON object may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Dedupe state grows with the number of events, so it may not live on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each write to a store reads its key first, to know how many there are; state_sizes counts them.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "ripplelog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library needs; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_RECOMMENDED, **_REQUIRED}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time settings the operators rely on; safe to call again."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def configured(df: DataFrame) -> DataFrame:
    configure(df.sparkSession)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there is one machine then.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ripplelog-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
