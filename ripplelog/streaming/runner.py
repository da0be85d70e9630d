"""Running consumers: commit after write, triggers, bounded runs, progress and run counters."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ripplelog.session import configure
from ripplelog.streaming.progress import commit_progress

DRAIN = {"availableNow": True}

#: Writes a batch; may return counters of it.
Handler = Callable[[DataFrame, int], "dict[str, int] | None"]


def trigger_for(seconds: int) -> dict[str, str]:
    """Trigger that starts a micro-batch every ``seconds``. The row limit belongs to the source:
    ``max_rows``/``seconds`` of the Kafka options, ``max_per_trigger`` of the file log."""
    return {"processingTime": f"{seconds} seconds"}


def consume(
    stream: DataFrame,
    handler: Handler,
    checkpoint: str,
    trigger: dict | None = None,
    group: str | None = None,
    log_root: str | None = None,
) -> StreamingQuery:
    """Start a consumer that calls ``handler(batch, batch_id)`` per micro-batch.

    Spark records the input of a batch before it runs and its completion afterwards, so a crash
    repeats the same batch; handlers write per ``batch_id`` or offset range and replace what a
    first try left. With ``group`` and ``log_root``, the rows handled are published for lag
    reports once the handler has succeeded, and with them the counters that it returned; the batch is
    kept meanwhile, so the source is read once.
    """
    configure(stream.sparkSession)

    def run(batch: DataFrame, batch_id: int) -> None:
        if not (group and log_root):
            handler(batch, batch_id)
            return
        batch.persist()
        try:
            counted = handler(batch, batch_id)
            commit_progress(batch, log_root, group, batch_id, counted if isinstance(counted, dict) else None)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DRAIN)).start()


def drain(*queries: StreamingQuery) -> None:
    """Wait until queries with the drain trigger have handled everything that was there."""
    for query in queries:
        query.awaitTermination()


def run_for(query: StreamingQuery, max_seconds: int = 30) -> None:
    """Let a query run for a while (0: until it is stopped), then stop it; that is no failure.

    A batch that was cut off is not committed and runs again on restart.
    """
    if max_seconds <= 0:
        query.awaitTermination()
    elif not query.awaitTermination(max_seconds):
        query.stop()


def counted(df: DataFrame, name: str, **counters: Column) -> DataFrame:
    """Count rows while they pass: ``rows`` and any named condition, as an observed metric."""
    _listen(df.sparkSession)
    sums = [F.sum(F.when(test, 1).otherwise(0)).alias(key) for key, test in counters.items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *sums)


class _Totals(StreamingQueryListener):
    """Observed counters of each run, added up as its micro-batches end."""

    def __init__(self):
        self._sums: dict[str, dict[str, dict[str, int]]] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        run = self._sums.setdefault(str(event.progress.runId), {})
        for name, row in event.progress.observedMetrics.items():
            sums = run.setdefault(name, {})
            for key, value in row.asDict().items():
                sums[key] = sums.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._ended:
            self._ended[str(event.runId)].set()

    def knows(self, query: StreamingQuery) -> bool:
        return str(query.runId) in self._ended

    def of(self, query: StreamingQuery, name: str, wait_seconds: int) -> dict[str, int]:
        run = str(query.runId)
        # Progress is reported in order and before the end, but on a thread of its own.
        if not query.isActive and not self._ended[run].wait(wait_seconds):
            raise TimeoutError(f"the end of run {run} was not reported in {wait_seconds} seconds")
        return dict(self._sums.get(run, {}).get(name, {}))


_LISTENING: dict[str, _Totals] = {}


def _listen(spark: SparkSession) -> None:
    """Add up the counters of a session's queries from the first call on."""
    session = str(spark._jsparkSession.sessionUUID())
    if session not in _LISTENING:
        _LISTENING[session] = _Totals()
        spark.streams.addListener(_LISTENING[session])


def metrics(query: StreamingQuery, name: str, wait_seconds: int = 60) -> dict[str, int]:
    """Observed counters, set by ``counted``, summed over all micro-batches of a run.

    Of a run that still goes on, over those reported so far.
    """
    for totals in _LISTENING.values():
        if totals.knows(query):
            return totals.of(query, name, wait_seconds)
    raise ValueError("the run was started before anything in its session was counted")


class EveryN(StreamingQueryListener):
    """Calls ``report(query_name, rows_so_far)`` whenever another ``every_n`` input rows are done."""

    def __init__(self, every_n: int, report: Callable[[str, int], None]):
        self._every_n = every_n
        self._report = report
        self._rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self._rows[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        before = self._rows.get(run, 0)
        self._rows[run] = before + event.progress.numInputRows
        if self._every_n > 0 and self._rows[run] // self._every_n > before // self._every_n:
            self._report(event.progress.name, self._rows[run])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._rows.pop(str(event.runId), None)
