"""Registered queries over streams, catalog tables and whole change logs.

They run the layers the way a deployment does: live streams into declared tables, state
kept by Spark, tables bucketed for the marts, checks that report with each batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import ENTITIES, ORDER_COLUMNS, ORDERS
from tidemark.functions.envelope import decode_envelope, encode_envelope, envelope_view
from tidemark.operators import marts, quality
from tidemark.operators.feed import change_feed_by_digest
from tidemark.plans import queries as base
from tidemark.plans.catalog import create_entity_tables, create_layers, create_silver_views, write_bucketed, write_full_refresh
from tidemark.session import drop_staged, ensure_session_defaults, scratch_path, setting, shuffles_freed, stage
from tidemark.sources import testdata as td
from tidemark.streaming.jobs import (
    INGEST_DATE,
    TOPIC_SCHEMA,
    BatchTotals,
    bronze_read_schema,
    drain,
    read_topic,
    start_all,
    start_bronze,
    start_console,
    start_silver,
)
from tidemark.streaming.keyed_state import read_silver

ENTITY_NAMES = base.ENTITY_NAMES
BUCKETS = 8              # at least; larger tables get more, so that a bucket stays one task's work
BUCKET_ROWS = 500_000    # events of a table's log for each bucket
FILES = 4            # data files of a table written for the file-count check


def _prefix(root: str) -> str:
    """A catalog prefix of this run's own."""
    return f"tm_{root.rsplit('/', 1)[-1]}_"


# ------------------------------------------------------------- keyed state
def silver_orders_late(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes arrive first, the changes before them in a later run, then all of it once more; Silver stays the same."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_late")
    bronze = td.bronze(spark, sf, "orders")
    for part in (bronze.where("op = 'd'"), bronze.where("op <> 'd'"), bronze):
        part.write.mode("append").parquet(f"{root}/bronze")
        start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/_ckpt", available_now=True, if_running="allow").awaitTermination()
    return base.report(read_silver(spark, f"{root}/_ckpt", ORDERS))


def silver_orders_state_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What each batch cost the state: rows that came, keys the batch wrote, keys kept, and rows of Silver as of that batch."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_state_rows")
    bronze = td.bronze(spark, sf, "orders")
    rows = []
    for n, part in enumerate((bronze.where("op <> 'd'"), bronze.where("op = 'd'"))):
        part.write.mode("append").parquet(f"{root}/bronze")
        q = start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/_ckpt", changes_path=f"{root}/changes", available_now=True, if_running="allow")
        q.awaitTermination()
        p = q.lastProgress
        changed = spark.read.parquet(f"{root}/changes/batch_id={p.batchId}")
        live = read_silver(spark, f"{root}/_ckpt", ORDERS, batch_id=p.batchId)
        rows.append(changed.agg(F.count("*").alias("rows_sent")).crossJoin(live.agg(F.count("*").alias("live_keys"))).select(  # one row each
            F.lit(n).cast("long").alias("batch"), F.lit(p.numInputRows).cast("long").alias("rows_in"), "rows_sent",
            F.lit(p.stateOperators[0].numRowsUpdated).cast("long").alias("state_rows_written"),
            F.lit(p.stateOperators[0].numRowsTotal).cast("long").alias("state_rows"), "live_keys"))
    return reduce(DataFrame.unionByName, rows)


def silver_orders_live(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze and Silver run at the same time as one unit; Bronze is replaced by a second start while more arrives; a barrier drains both."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_live")
    topic = td.topic_records(spark, sf, "orders")
    late = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    topic.where(~late).write.parquet(f"{root}/topic")
    spark.createDataFrame([], ORDERS.bronze_schema).write.parquet(f"{root}/bronze")

    def bronze():
        return start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic"), ORDERS, f"{root}/bronze", f"{root}/_ckpt/bronze",
                            trigger="1 second", if_running="replace")

    def silver():
        return start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/_ckpt/silver", trigger="1 second", if_running="replace")
    running = start_all([bronze, silver])
    try:
        drain(running)
        topic.where(late).write.mode("append").parquet(f"{root}/topic")
        running = [bronze(), running[1]]  # the guard stops the one that runs
        drain(running)
    finally:
        for q in running:
            q.stop()
    return base.report(read_silver(spark, f"{root}/_ckpt/silver", ORDERS))


def console_view_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Messages the live view showed: in a first run, in one resumed after the topic came once more, and in a replay."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "console_view")
    topic = td.topic_records(spark, sf, "orders", spread=True)
    rows = []
    for run, mode in enumerate(("resume", "resume", "replay")):
        if run == 0:
            topic.write.parquet(f"{root}/topic")
        elif run == 1:
            spark.read.schema(TOPIC_SCHEMA).parquet(f"{root}/topic").write.mode("append").parquet(f"{root}/topic")
        q = start_console(envelope_view(read_topic(spark, fmt="parquet", path=f"{root}/topic"), mode), f"{root}/_ckpt", mode, name=f"orders_view_{mode}",
                          available_now=True, if_running="replace")
        q.awaitTermination()
        rows.append((run, mode, sum(p.numInputRows for p in q.recentProgress)))
    return spark.createDataFrame(rows, "run long, consumer_mode string, messages long")


# ---------------------------------------------------------- catalog tables
def catalog_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Streams fill the declared Bronze tables, Silver is a catalog view on them, the marts are written from Silver; all read by name."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "catalog_stream")
    prefix = _prefix(root)
    create_layers(spark, prefix)
    create_entity_tables(spark, prefix=prefix, layers=("bronze",), path=f"{root}/bronze")
    create_silver_views(spark, prefix=prefix)
    started = []
    for e in ENTITY_NAMES:
        stage(td.topic_records(spark, sf, e), f"{root}/topic/{e}")
        started.append(lambda e=e: start_bronze(
            read_topic(spark, fmt="parquet", path=f"{root}/topic/{e}"), ENTITIES[e], None, f"{root}/_ckpt/{e}",
            table=f"{prefix}bronze.{ENTITIES[e].bronze_table}", available_now=True, if_running="replace"))
    for q in start_all(started):
        q.awaitTermination()
    drop_staged(spark, f"{root}/topic")  # Bronze holds every message of it
    # the marts read each Silver view two or three times: it is computed once for them
    silvers = {e: stage(spark.table(f"{prefix}silver.{ENTITIES[e].silver_table}"), f"{root}/silver/{e}") for e in ENTITY_NAMES}
    gold = marts.all_marts(silvers)
    for name, df in gold.items():
        write_full_refresh(df, f"{prefix}gold.{name}", path=f"{root}/gold/{name}")
    names = ([f"bronze.{ENTITIES[e].bronze_table}" for e in ENTITY_NAMES] + [f"silver.{ENTITIES[e].silver_table}" for e in ENTITY_NAMES]
             + [f"gold.{name}" for name in gold])
    # a Silver view is reduced from its whole log: each count is written before the next one starts, so that one log's shuffle is on disk
    return reduce(DataFrame.unionByName, [
        stage(spark.sql(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {prefix}{n}"), f"{root}/counts/{n}") for n in names])


def _bucketed(spark: SparkSession, sf: str, names) -> dict[str, DataFrame]:
    m = base._layers(spark, sf)
    root = scratch_path(spark, "bucketed")
    prefix = _prefix(root)
    create_layers(spark, prefix)
    # one number for all, as tables bucketed alike join without an exchange; the counts come from Bronze's file footers
    with shuffles_freed(spark):
        buckets = max(BUCKETS, -(-max(m.bronze(e).count() for e in names) // BUCKET_ROWS))
    return {e: write_bucketed(m.silver(e), f"{prefix}silver.{e}_by_order", "order_id", buckets, path=f"{root}/{e}") for e in names}


def gold_order_payment_status_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The payment mart over Silver tables bucketed by order: its joins and ranking exchange nothing."""
    t = _bucketed(spark, sf, ("orders", "payments", "transactions"))
    return base.report(marts.order_payment_status(t["orders"], t["payments"], t["transactions"], co_located=True))


def gold_customer_order_summary_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The customer mart over orders and payments bucketed by order: only per-customer rows are exchanged."""
    t = _bucketed(spark, sf, ("orders", "payments"))
    return base.report(marts.customer_order_summary(base._layers(spark, sf).silver("customers"), t["orders"], t["payments"]))


def bronze_customers_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """Customers streamed into folders by ingest date, with a limit of bytes per batch; rows by date, from the folder names."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "customers_by_date")
    spec = ENTITIES["customers"]
    td.topic_records(spark, sf, "customers").write.parquet(f"{root}/topic")
    start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic", max_bytes_per_trigger=256 << 20), spec, f"{root}/bronze", f"{root}/_ckpt",
                 available_now=True, partition_by_date=True, if_running="allow").awaitTermination()
    return (spark.read.schema(bronze_read_schema(spec, True)).parquet(f"{root}/bronze").groupBy(INGEST_DATE)
            .agg(F.count("*").alias("cnt"), F.count_distinct("customer_id").alias("customers")))


# ------------------------------------------------------- decode and checks
def bronze_orders_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with unquoted numbers, read through VARIANT: amounts with zeros at the end, a status sent as a whole
    number of 20 digits, as a decimal, as an object and as text."""
    ensure_session_defaults(spark)
    topic = td.topic_records(spark, sf, "orders")
    kind = F.pmod(F.get_json_object("key", "$.payload.order_id").cast("long"), F.lit(4))
    order = F.get_json_object("key", "$.payload.order_id")
    status = (F.when(kind == 0, F.concat(F.lit('"status":9'), F.lpad(order, 19, "0"))).when(kind == 1, F.concat(F.lit('"status":'), order, F.lit(".50")))
              .when(kind == 2, F.lit('"status":{"v":"$1"}')).otherwise(F.lit('"status":"$1"')))
    value = F.regexp_replace(F.regexp_replace("value", '"amount":"([0-9.]+)"', '"amount":$1'), F.lit('"status":"([A-Z]+)"'), status)
    return base.report(decode_envelope(topic.withColumn("value", value), ORDERS, parser="variant").drop("raw_json"))


def dq_stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counts that the Bronze streams of two faulty topics report with their batches, summed by a listener; no table is read for them."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "stream_metrics")
    topics = {"edge_messages": td.malformed_order_records(spark, sf),
              "dirty_log": encode_envelope(td.dirty_orders_changes(spark, sf), ORDERS, lsn_col="lsn")}
    listener = BatchTotals()
    spark.streams.addListener(listener)
    try:
        for name, topic in topics.items():
            topic.write.parquet(f"{root}/{name}/topic")
            files = base._third(spark, f"{root}/{name}/topic")
            q = start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/{name}/topic", max_files_per_trigger=files), ORDERS,
                             f"{root}/{name}/bronze", f"{root}/{name}/_ckpt", metrics=name, available_now=True, if_running="allow")
            q.awaitTermination()
            listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    columns = ("messages", "null_messages", "cnt", "raw_json_nulls", "null_ops", "rows_with_errors", "cast_errors")
    rows = []
    for name in topics:
        sums = {**listener.totals.get(f"{name}_topic", {}), **listener.totals.get(name, {})}
        rows.append((name, *(sums.get(c, 0) for c in columns)))
    return spark.createDataFrame(rows, "table_name string, " + ", ".join(f"{c} long" for c in columns))


def dq_order_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Keys whose events arrive out of commit order, in the four clean logs and in one with inner inversions and a hot key."""
    m = base._layers(spark, sf)
    bad = decode_envelope(encode_envelope(td.inverted_orders_changes(spark, sf), ORDERS, lsn_col="lsn"), ORDERS)
    # the check reads its log twice, for the ranges and for the sort: what it needs is written, each message parsed once
    path = scratch_path(spark, "inverted_orders")
    bad = stage(bad.select(ORDERS.key, *ORDER_COLUMNS), path)
    logs = {f"{e}_bronze": (m.bronze(e), ENTITIES[e].key) for e in ENTITY_NAMES}
    # a log's report is written before the next log is checked, so that the shuffles of one log only are on disk
    return reduce(DataFrame.unionByName, [stage(quality.order_kept({name: log}), scratch_path(spark, "order_kept", name))
                                          for name, log in {**logs, "inverted_orders": (bad, ORDERS.key)}.items()])


def dq_pk_exists(spark: SparkSession, sf: str) -> DataFrame:
    """Key checks as EXISTS over named tables, of the layers (Bronze keys repeat) and of a log with null keys."""
    m = base._layers(spark, sf)
    root = scratch_path(spark, "pk_exists")
    prefix = _prefix(root)
    create_layers(spark, prefix)

    def write(layer: str, e: str, df: DataFrame) -> DataFrame:
        table = f"{prefix}{layer}.{e}_{layer}"
        write_full_refresh(df, table, path=f"{root}/{layer}/{e}")
        named[table] = ENTITIES[e].key
        return spark.table(table)
    named = {}
    m.write_bronze = lambda e, rows: write("bronze", e, rows)  # the named table is the plan's Bronze, not a second copy of it
    for e in ENTITY_NAMES:
        m.bronze(e)
        write("silver", e, m.silver(e))
    write_full_refresh(base._dirty_bronze(spark, sf), f"{prefix}bronze.dirty_orders", path=f"{root}/dirty")
    return quality.pk_violations_by_exists(spark, {**named, f"{prefix}bronze.dirty_orders": ORDERS.key})


def dq_table_files(spark: SparkSession, sf: str) -> DataFrame:
    """Data files and rows of Bronze tables written in a stated number of files."""
    m = base._layers(spark, sf)
    root = scratch_path(spark, "table_files")
    # the table of stated files is the plan's Bronze, not a second copy of it
    m.write_bronze = lambda e, rows: stage(rows.repartition(FILES), f"{root}/{e}")
    # rows are dealt in turn as they come: sorted by hash before, as is the default, texts that are alike lie apart, and the
    # exchange and the files take more room.  Spark then runs the whole stage again where it would repeat a task
    with setting(spark, "spark.sql.execution.sortBeforeRepartition", "false"):
        return quality.table_health({f"{e}_bronze": m.bronze(e) for e in ENTITY_NAMES})


def change_feed_orders_digest(spark: SparkSession, sf: str) -> DataFrame:
    """``change_feed_orders`` through bucket digests: only buckets that differ are joined."""
    return base.change_feed_orders(spark, sf, feed=change_feed_by_digest)


QUERIES = {f.__name__: f for f in (
    silver_orders_late, silver_orders_state_rows, silver_orders_live, console_view_runs, catalog_layer_counts, gold_order_payment_status_bucketed,
    gold_customer_order_summary_bucketed, bronze_customers_by_date, bronze_orders_variant, dq_stream_metrics, dq_order_kept,
    dq_pk_exists, dq_table_files, change_feed_orders_digest)}
