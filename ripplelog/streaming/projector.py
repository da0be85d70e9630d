"""Idempotent, replayable read model kept by one streaming query.

The query aggregates the validated topic by event id, keeping the first copy; ids met for the
first time leave the aggregation once, in the micro-batch that brought them. Copies of one id are
combined before the shuffle, so a flood of redeliveries does not gather in one task. The same
aggregation counts the rows per log partition, which is what a batch publishes as its progress.

A micro-batch is the transaction: it writes the new ledger rows, what they add per page and per
wiki, and last a commit row, each into a folder of its own batch that a retry replaces. Readers
look only at committed batches and add up what these hold per key. The cost of a batch follows the
keys it touches, never the size of the tables. No watermark is set: late events always count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ripplelog import schema as S
from ripplelog.files import children, remove, rename
from ripplelog.operators import readmodel as R
from ripplelog.operators.decode import decode_envelope
from ripplelog.session import configure
from ripplelog.sources.log import log_batch, log_stream
from ripplelog.streaming.progress import commit_totals, forget_progress, progress
from ripplelog.streaming.runner import DRAIN, drain

_LONG, _STRING, _INT = T.LongType(), T.StringType(), T.IntegerType()

APPLIED = T.StructType(
    [
        *(S.ENVELOPE[name] for name in ("event_id", "wiki", "title", "user", "bot", "occurred_at")),
        T.StructField("partition", _INT),
        T.StructField("offset", _LONG),
    ]
)

_COMMIT = S.struct_of(applied=_LONG)


@dataclass(frozen=True)
class _Table:
    """A table of additions per key and batch: how a batch makes them and how they add up."""

    key: list[str]
    schema: T.StructType
    report: list[str]

    def additions(self, events: DataFrame) -> DataFrame:
        if self.key == R.WIKI_KEY:
            return R.wiki_stats(events)
        last = F.max(F.struct(*R.ARRIVAL)).alias("_last")
        pages = R.page_activity(events, also=[last])
        return pages.select(R.PAGE_COLUMNS + [F.col(f"_last.{name}") for name in R.ARRIVAL])

    def merged(self, rows: DataFrame) -> DataFrame:
        counters = [name for name in self.schema.fieldNames() if name.endswith(("_count", "_events"))]
        sums: list[Column] = [F.sum(name).alias(name) for name in counters]
        sums.append(F.max("last_event_at").alias("last_event_at"))
        if "last_user" not in self.schema.fieldNames():
            return rows.groupBy(*self.key).agg(*sums)
        last = F.max(F.struct(*R.ARRIVAL, "last_user")).alias("_last")
        return rows.groupBy(*self.key).agg(*sums, last).select(*self.key, *counters, "last_event_at", "_last.*")


TABLES = {
    "page_activity": _Table(
        R.PAGE_KEY,
        S.struct_of(
            wiki=_STRING,
            title=_STRING,
            edit_count=_LONG,
            bot_edit_count=_LONG,
            last_event_at=_LONG,
            last_user=_STRING,
            partition=_INT,
            offset=_LONG,
        ),
        R.PAGE_COLUMNS,
    ),
    "wiki_stats": _Table(
        R.WIKI_KEY,
        S.struct_of(
            wiki=_STRING,
            total_events=_LONG,
            bot_events=_LONG,
            human_events=_LONG,
            last_event_at=_LONG,
        ),
        R.WIKI_COLUMNS,
    ),
}


@dataclass(frozen=True)
class ReadModel:
    """Where a read model lives: tables, commits and checkpoint under one folder."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def batch(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch_id={batch_id}"

    def snapshots(self, name: str) -> str:
        return f"{self.root}/{name}_snapshot"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def _first_copies(events: DataFrame) -> DataFrame:
    """Events whose id this micro-batch met for the first time, each as its first copy; and, with
    ``_is_event`` false, the rows of each log partition in all micro-batches so far.

    The current time is one value per micro-batch, kept in the checkpoint for retries. All copies
    of an id carrying one and the same time means that they all came in the running batch.
    """
    rest = [name for name in APPLIED.fieldNames() if name not in ("event_id", *R.ARRIVAL)]
    first = F.struct(*R.ARRIVAL, *rest)
    event = F.struct(F.lit(True).alias("_is_event"), F.col("event_id"), first.alias("_row"))
    place = F.struct(
        F.lit(False).alias("_is_event"),
        F.col("partition").cast("string").alias("event_id"),
        F.lit(None).cast("struct<" + ",".join(f"`{n}`:{APPLIED[n].dataType.simpleString()}" for n in (*R.ARRIVAL, *rest)) + ">").alias("_row"),
    )
    timed = events.select(F.explode(F.array(event, place)).alias("_e"), F.current_timestamp().alias("_seen"))
    copies = timed.select("_e.*", "_seen").groupBy("_is_event", "event_id").agg(
        F.min("_row").alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("_seen").alias("_since"),
        F.max("_seen").alias("_until"),
    )
    fresh = copies.where(~F.col("_is_event") | (F.col("_since") == F.col("_until")))
    return fresh.select("_is_event", "event_id", "_first.*", "_rows")


def start_projector(
    spark: SparkSession,
    log_root: str,
    model: ReadModel,
    trigger: dict | None = None,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Validated topic (of the file log, or ``source``) to read model; a row that does not decode
    fails the query.

    State grows with the number of ids and lives in ``state_partitions`` stores, which Spark fixes
    at the first start (``spark.sql.shuffle.partitions`` by default). Each micro-batch publishes its
    progress, so the lag of a running projector is known.
    """
    configure(spark)
    if source is None:
        source = log_stream(spark, log_root, S.TOPIC_VALIDATED, max_per_trigger)
    events = decode_envelope(source, "partition", "offset").select(APPLIED.fieldNames())
    fresh = _first_copies(events)

    def transact(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            places = batch.where(~F.col("_is_event")).select(
                F.lit(S.TOPIC_VALIDATED).alias("topic"),
                F.col("event_id").cast("int").alias("partition"),
                F.col("_rows").alias("total"),
            )
            new = batch.where("_is_event").select(APPLIED.fieldNames())
            new.write.mode("overwrite").parquet(model.batch("applied", batch_id))
            for name, table in TABLES.items():
                table.additions(new).write.mode("overwrite").parquet(model.batch(name, batch_id))
            commit = new.agg(F.count(F.lit(1)).alias("applied"))
            commit.write.mode("overwrite").parquet(model.batch("commits", batch_id))
            commit_totals(places, log_root, S.GROUP_PROJECTOR, batch_id)
        finally:
            batch.unpersist()

    writer = fresh.writeStream.outputMode("update").foreachBatch(transact)
    writer = writer.option("checkpointLocation", model.checkpoint).trigger(**(trigger or DRAIN))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions or usual)
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in names if "=" in name)


def _last_commit(spark: SparkSession, model: ReadModel) -> int:
    """Number of the newest committed batch, -1 before the first. A batch commits after all its
    tables are written, and batches run one after the other. A commit counts by its row."""
    for number in reversed(_numbers(children(spark, model.table("commits")))):
        if not spark.read.schema(_COMMIT).parquet(model.batch("commits", number)).isEmpty():
            return number
    return -1


def _stored(
    spark: SparkSession, model: ReadModel, name: str, schema: T.StructType, after: int = -1
) -> DataFrame:
    typed = T.StructType([*schema.fields, T.StructField("batch_id", _LONG)])
    last = _last_commit(spark, model)
    if last < 0:
        return spark.createDataFrame([], typed)
    rows = spark.read.schema(typed).parquet(model.table(name))
    return rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= last))


def _additions(spark: SparkSession, model: ReadModel, name: str) -> DataFrame:
    table = TABLES[name]
    columns = table.schema.fieldNames()
    folded = _numbers(children(spark, model.snapshots(name)))
    if not folded:
        return _stored(spark, model, name, table.schema).select(columns)
    snapshot = spark.read.schema(table.schema).parquet(f"{model.snapshots(name)}/upto={folded[-1]}")
    newer = _stored(spark, model, name, table.schema, after=folded[-1])
    return snapshot.unionByName(newer.select(columns))


def current(spark: SparkSession, model: ReadModel, name: str) -> DataFrame:
    """``page_activity`` or ``wiki_stats`` as of the last commit."""
    table = TABLES[name]
    return table.merged(_additions(spark, model, name)).select(table.report)


def get_page(spark: SparkSession, model: ReadModel, wiki: str, title: str) -> DataFrame:
    """The row of one page, or no row. The key reaches the Parquet scans of the snapshot and of the
    batches since; the cost follows the batches since the last :func:`compact`, not the pages."""
    return R.get_page(current(spark, model, "page_activity"), wiki, title)


def state_audit(spark: SparkSession, model: ReadModel) -> DataFrame:
    """The dedupe state held against the ledger, one row: ids in each, ids that only one has.

    Read from the checkpoint by Spark's state data source while the projector is not running. Ids
    only in the ledger would be applied again; ids only in the state were lost from the tables.
    """
    state = spark.read.format("statestore").load(model.checkpoint)
    ids = state.where("key._is_event").select("key.event_id", F.lit(1).alias("state"), F.lit(0).alias("ledger"))
    applied = ledger(spark, model).select("event_id", F.lit(0).alias("state"), F.lit(1).alias("ledger"))
    sides = ids.unionByName(applied).groupBy("event_id").agg(F.max("state").alias("s"), F.max("ledger").alias("l"))
    return sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("state_ids"),
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("ledger_ids"),
        F.count_if(F.col("s") > F.col("l")).alias("only_state"),
        F.count_if(F.col("s") < F.col("l")).alias("only_ledger"),
    )


def state_sizes(spark: SparkSession, model: ReadModel) -> DataFrame:
    """Rows of each state store (partition_id, rows). Their number is fixed at the first start; when
    they have grown too large, :func:`rebuild` with more ``state_partitions``."""
    state = spark.read.format("statestore").load(model.checkpoint)
    return state.groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows")).orderBy("partition_id")


def ledger(spark: SparkSession, model: ReadModel) -> DataFrame:
    """Processed events: id and event time."""
    applied = _stored(spark, model, "applied", APPLIED)
    return applied.select("event_id", F.col("occurred_at").alias("processed_at"))


def applied_counts(spark: SparkSession, model: ReadModel) -> DataFrame:
    """Newly applied events per batch."""
    return _stored(spark, model, "commits", _COMMIT).select("batch_id", "applied")


def compact(spark: SparkSession, model: ReadModel, name: str) -> None:
    """Fold the committed additions of a table into one snapshot, so that readers skip their
    batches. The snapshot appears by a rename, and only then are the folded folders removed; a
    crash in between leaves folders that readers already ignore.

    It is clustered by the table's key and has Bloom filters on it: a lookup of one key opens the
    file, row group and pages that can hold it (see :func:`get_page`)."""
    table = TABLES[name]
    last = _last_commit(spark, model)
    folded = _numbers(children(spark, model.snapshots(name)))
    if last < 0 or (folded and folded[-1] >= last):
        return
    building = f"{model.root}/_building/{name}"
    merged = table.merged(_additions(spark, model, name)).select(table.schema.fieldNames())
    writer = merged.repartitionByRange(*table.key).sortWithinPartitions(*table.key).write.mode("overwrite")
    for column in table.key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(building)
    rename(spark, building, f"{model.snapshots(name)}/upto={last}")
    for number in _numbers(children(spark, model.table(name))):
        if number <= last:
            remove(spark, model.batch(name, number))


def project(
    spark: SparkSession,
    log_root: str,
    model: ReadModel,
    max_per_trigger: int | None = None,
    state_partitions: int | None = None,
) -> dict[str, int]:
    """Bring the read model up to date with the log; returns how many events this run applied and
    skipped."""
    before = _last_commit(spark, model)
    drain(
        start_projector(
            spark, log_root, model, max_per_trigger=max_per_trigger, state_partitions=state_partitions
        )
    )
    return run_counts(spark, log_root, model, before)


def run_counts(
    spark: SparkSession, log_root: str, model: ReadModel, after: int = -1
) -> dict[str, int]:
    """Events that the batches after a given one applied and skipped, from what they committed."""
    rows = applied_counts(spark, model).where(F.col("batch_id") > after)
    applied = rows.agg(F.coalesce(F.sum("applied"), F.lit(0))).first()[0]
    totals = progress(spark, log_root, S.GROUP_PROJECTOR)

    def consumed(commits: DataFrame) -> int:
        highest = commits.groupBy("topic", "partition").agg(F.max("total").alias("total"))
        return highest.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]

    done = consumed(totals) - consumed(totals.where(F.col("batch_id") <= after))
    return {"applied": applied, "skipped": done - applied}


def inspect(spark: SparkSession, model: ReadModel, n: int = 10) -> dict[str, DataFrame]:
    """Counts, top pages and wiki statistics of the stored read model."""
    pages = current(spark, model, "page_activity")
    return R.inspect(pages, current(spark, model, "wiki_stats"), ledger(spark, model), n)


def reset(spark: SparkSession, model: ReadModel, log_root: str | None = None) -> bool:
    """Delete tables, checkpoint and the group's progress; False when there was nothing."""
    removed = remove(spark, model.root)
    if log_root is not None:
        forget_progress(spark, log_root, S.GROUP_PROJECTOR)
    return removed


def rebuild(
    spark: SparkSession, log_root: str, model: ReadModel, state_partitions: int | None = None
) -> dict[str, int]:
    """Drop the read model and replay the log from its beginning, with another number of state stores
    if wanted."""
    reset(spark, model, log_root)
    return project(spark, log_root, model, state_partitions=state_partitions)


def rebuild_batch(spark: SparkSession, log_root: str) -> dict[str, DataFrame]:
    """The same tables computed from the whole log in one batch."""
    validated = log_batch(spark, log_root, S.TOPIC_VALIDATED)
    events = R.dedupe(decode_envelope(validated, "partition", "offset").select(APPLIED.fieldNames()))
    return {"page_activity": R.page_activity(events), "wiki_stats": R.wiki_stats(events)}
