"""Structured Streaming wiring: topic -> Bronze (append) -> Silver (keyed state).

Run modes (the replay / resume contract):
  * ``resume`` - stable checkpoint folder: committed offsets and sink state are
    reused, so a restart continues where the last committed batch ended;
  * ``replay`` - a fresh checkpoint folder and output version, reading from the
    earliest offset.  Nothing is deleted; the earlier run stays as it was.  The
    output version matters: a file sink records committed batch ids in its
    folder's ``_spark_metadata`` and skips them, so a replay into the same folder
    would write nothing.  Use ``run_folder`` for the output root as well.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.entities import EntitySpec
from tidemark.functions.envelope import decode_envelope, minimal_order_event
from tidemark.session import CODEC
from tidemark.streaming.keyed_state import keyed_updates, state_schema, state_settings

TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

INGEST_DATE = "ingest_date"
CONSOLE_ROWS = 20    # of a batch, as Spark's console sink shows
COMMIT_INTERVAL = "10 seconds"   # Bronze / Silver commit cadence
POLL_INTERVAL = "5 seconds"      # Silver polling of Bronze
RUN_MODES = ("replay", "resume")


def run_folder(root: str, name: str, mode: str) -> str:
    """Checkpoint folder for a query under a run mode."""
    if mode not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}, got {mode!r}")
    if mode == "resume":
        return f"{root.rstrip('/')}/{name}"
    return f"{root.rstrip('/')}/{name}-replay-{uuid.uuid4().hex[:12]}"


def _admission(reader, max_files: int | None, max_bytes: int | None):
    """Limit what a micro-batch takes on: a number of files, or bytes (a batch takes one file at least)."""
    if max_files and max_bytes:
        raise ValueError("limit files or bytes per trigger, not both")
    if max_files:
        return reader.option("maxFilesPerTrigger", str(max_files))
    return reader.option("maxBytesPerTrigger", str(max_bytes)) if max_bytes else reader


def read_topic(
    spark: SparkSession,
    topic: str | None = None,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming change topic as ``(key, value, timestamp)`` strings + broker time.

    ``fmt='kafka'`` subscribes to ``topic`` (needs the Kafka connector on the
    classpath); any file format (``parquet``, ``json``) reads a folder holding
    the same three columns, which is how tests and replays feed the pipeline.
    """
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic)
             .option("startingOffsets", starting_offsets))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp")
    r = _admission(spark.readStream.schema(TOPIC_SCHEMA).format(fmt), max_files_per_trigger, max_bytes_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or COMMIT_INTERVAL)


def guard_running(spark: SparkSession, name: str, if_running: str = "error") -> None:
    """Job-replacement guard over the session's active streaming queries."""
    for q in spark.streams.active:
        if q.name == name:
            if if_running == "replace":
                q.stop()
            elif if_running == "error":
                raise RuntimeError(f"streaming query {name!r} is already running")
            elif if_running != "allow":
                raise ValueError("if_running must be 'error', 'replace' or 'allow'")


def observed(topic: DataFrame, spec: EntitySpec, name: str, **decode) -> DataFrame:
    """Bronze rows that report counts with each batch, in the same pass: messages and null messages of the
    topic (``<name>_topic``); rows, null texts, null ops and cast errors of Bronze (``<name>``)."""
    one = lambda c: F.count(F.when(c, F.lit(1)))
    rows = decode_envelope(topic.observe(f"{name}_topic", F.count(F.lit(1)).alias("messages"), one(F.col("value").isNull()).alias("null_messages")),
                           spec, track_cast_errors=True, **decode)
    return rows.observe(
        name, F.count(F.lit(1)).alias("cnt"), one(F.col("raw_json").isNull()).alias("raw_json_nulls"), one(F.col("op").isNull()).alias("null_ops"),
        one(F.col("cast_errors") > 0).alias("rows_with_errors"), F.coalesce(F.sum("cast_errors"), F.lit(0)).cast("long").alias("cast_errors"),
    ).drop("cast_errors")


class BatchTotals(StreamingQueryListener):
    """Sums of the observed counts of every batch, by observation name; one small row per name is kept."""

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            mine = self.totals.setdefault(name, {})
            for k, v in row.asDict().items():
                mine[k] = mine.get(k, 0) + (v or 0)

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all events of a finished query have come in (they arrive on another thread)."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of query {query.name!r} was reported")


def start_bronze(
    topic: DataFrame,
    spec: EntitySpec,
    bronze_path: str | None,
    checkpoint: str,
    *,
    table: str | None = None,
    metrics: str | None = None,
    trigger: str | None = COMMIT_INTERVAL,
    available_now: bool = False,
    if_running: str = "error",
    strict_casts: bool = False,
    partition_by_date: bool = False,
    keep_lsn: bool = False,
) -> StreamingQuery:
    """Append-only Bronze sink; every decoded message becomes one row.

    ``partition_by_date`` adds ``ingest_date`` (UTC day of the broker time) and
    partitions the folder by it, so reads of a time range prune whole folders.
    ``keep_lsn`` adds ``source_lsn``, the tie-breaker of changes in one commit.
    ``table`` appends to a declared catalog table instead of a folder.
    ``metrics`` names counts that each batch reports (see ``observed``, ``BatchTotals``)."""
    if (bronze_path is None) == (table is None):
        raise ValueError("give a folder or a table")
    name = f"{spec.bronze_table}"
    guard_running(topic.sparkSession, name, if_running)
    decode = {"strict_casts": strict_casts, "keep_lsn": keep_lsn}
    rows = observed(topic, spec, metrics, **decode) if metrics else decode_envelope(topic, spec, **decode)
    if partition_by_date:
        rows = rows.withColumn(INGEST_DATE, F.to_date("kafka_event_ts"))
    w = _trigger(rows.writeStream.format("parquet").option("compression", CODEC).outputMode("append")
                 .option("checkpointLocation", checkpoint).queryName(name), trigger, available_now)
    if partition_by_date:
        w = w.partitionBy(INGEST_DATE)
    return w.toTable(table) if table else w.option("path", bronze_path).start()


def bronze_read_schema(spec: EntitySpec, partitioned_by_date: bool = False) -> T.StructType:
    fields = list(spec.bronze_schema.fields)
    if partitioned_by_date:
        fields.append(T.StructField(INGEST_DATE, T.DateType(), True))
    return T.StructType(fields)


def start_silver(
    spark: SparkSession,
    bronze: str,
    spec: EntitySpec,
    checkpoint: str,
    *,
    tie_breaker: Sequence[str] = (),
    changes_path: str | None = None,
    state_partitions: int | None = None,
    trigger: str | None = POLL_INTERVAL,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    if_running: str = "error",
    bronze_partitioned_by_date: bool = False,
) -> StreamingQuery:
    """Incremental scan of a Bronze folder folded into Spark's keyed state under ``checkpoint``.

    ``read_silver`` reads the current rows.  ``changes_path`` receives the newest row of each key
    that a batch touched, in one folder per batch that a repeated batch writes anew."""
    name = f"{spec.silver_table}"
    guard_running(spark, name, if_running)
    schema = bronze_read_schema(spec, bronze_partitioned_by_date)
    extra = [f for f in state_schema(spec, tie_breaker).fields if f.name not in schema.names]
    reader = _admission(spark.readStream.schema(T.StructType([*schema.fields, *extra])), max_files_per_trigger, max_bytes_per_trigger)
    updates = keyed_updates(reader.parquet(bronze), spec, tie_breaker)
    w = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).queryName(name)
    if changes_path:
        w = w.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{changes_path}/batch_id={n}"))
    else:
        w = w.format("noop")  # the state is the result
    with state_settings(spark, state_partitions):
        return _trigger(w, trigger, available_now).start()


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Barrier over live queries linked by tables, upstream first: what has arrived by now is through all of them."""
    for q in queries:
        q.processAllAvailable()


def start_minimal_events_jsonl(
    topic: DataFrame,
    out_path: str,
    checkpoint: str,
    mode: str,
    group: str,
    *,
    available_now: bool = False,
    trigger: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """JSON-lines sink of compact order events with ingest audit columns."""
    w = (minimal_order_event(topic, mode, group).writeStream
         .format("json").option("ignoreNullFields", "false").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .queryName(f"orders_jsonl_{mode}"))
    return _trigger(w, trigger, available_now).start()


def start_console(
    df: DataFrame,
    checkpoint_root: str,
    mode: str = "resume",
    *,
    name: str = "tail",
    truncate: bool = False,
    available_now: bool = False,
    trigger: str | None = POLL_INTERVAL,
    if_running: str = "error",
) -> StreamingQuery:
    """Live view to the driver console (for humans; not a data sink).

    Every message goes through the view, the first ``CONSOLE_ROWS`` of a batch are shown; no more of it comes to the driver
    (Spark's console sink collects the whole batch there).
    ``resume`` continues behind the last batch shown, ``replay`` shows the topic from its start."""
    guard_running(df.sparkSession, name, if_running)
    w = (df.writeStream.foreachBatch(lambda batch, n: _show_first(batch, n, truncate)).outputMode("append")
         .option("checkpointLocation", run_folder(checkpoint_root, name, mode)).queryName(name))
    return _trigger(w, trigger, available_now).start()


def _show_first(batch: DataFrame, batch_id: int, truncate: bool) -> None:
    # ordered by place, so one pass over all rows keeps the first few of each task
    first = batch.withColumn("_at", F.monotonically_increasing_id()).orderBy("_at").drop("_at")
    line = "-" * 43
    print(f"{line}\nBatch: {batch_id}\n{line}")
    first.show(CONSOLE_ROWS, truncate)


def start_all(starters: list[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start several queries as one unit; if one fails to start, stop the rest."""
    started: list[StreamingQuery] = []
    try:
        for s in starters:
            started.append(s())
    except Exception:
        for q in started:
            q.stop()
        raise
    return started


def await_all(queries: list[StreamingQuery], poll_seconds: float = 1) -> None:
    """Wait for queries that run as one unit; when one fails, stop the others and raise its error."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(poll_seconds)  # raises the error of a failed query
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()
