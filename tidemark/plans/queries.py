"""Registered queries over the driver tables: one per operator family.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them)
and returns a DataFrame; timestamps are reported as ``timestamp_ntz`` (UTC wall
clock) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import AMOUNT_TYPE, CUSTOMERS, ORDERS, PAYMENTS
from tidemark.functions.casts import to_ntz
from tidemark.functions.envelope import decode_envelope, encode_envelope, envelope_view, minimal_order_event, split_keyed_line
from tidemark.operators import quality
from tidemark.operators.feed import change_feed, snapshot_feed
from tidemark.operators.state import apply_changes, live_rows, merge_upsert, rank_latest, silver, to_silver_columns
from tidemark.plans.catalog import create_entity_tables, create_layers, register_views, write_full_refresh
from tidemark.plans.medallion import Medallion
from tidemark.session import drop_staged, ensure_session_defaults, scratch_path, stage
from tidemark.sources import testdata as td
from tidemark.streaming.jobs import read_topic, run_folder, start_bronze, start_minimal_events_jsonl, start_silver
from tidemark.streaming.keyed_state import read_silver

ENTITY_NAMES = ("customers", "orders", "payments", "transactions")

# Fixed values of the derived scenarios (shared with the oracle SQL).
UPSERT_TOUCH_TS = "2024-06-01 00:00:00"
UPSERT_UPDATE_PRIORITY = "1-URGENT"
UPSERT_INSERT_PRIORITY = "2-HIGH"
UPSERT_KEY_OFFSET = 1_000_000_000_000
FEED_INSERT_PRIORITY = "1-URGENT"     # only in the newer snapshot -> c
FEED_DELETE_PRIORITY = "5-LOW"        # only in the older snapshot -> d
FEED_PAID_PRIORITY = "3-MEDIUM"       # status set to PAID -> u unless already PAID
FEED_RAISE_PRIORITY = "2-HIGH"        # amount * 1.1 -> u
PRICE_FACTOR = "1.1"


def report(df: DataFrame) -> DataFrame:
    """Timestamps -> timestamp_ntz for engine-neutral output."""
    return df.select(*[
        to_ntz(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _bronze(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    return td.bronze(ensure_session_defaults(spark), sf, entity)


def _layers(spark: SparkSession, sf: str) -> Medallion:
    ensure_session_defaults(spark)
    return Medallion(spark, {e: td.topic_records(spark, sf, e) for e in ENTITY_NAMES})


# --------------------------------------------------------------------- Bronze
def bronze_query(entity: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return report(_bronze(spark, sf, entity).drop("raw_json"))
    return q


def bronze_orders_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Values read again from the kept message text, of either shape."""
    raw = lambda *paths: F.coalesce(*[F.get_json_object("raw_json", f"$.{w}{p}") for w in ("payload.", "") for p in paths])
    return report(_bronze(spark, sf, "orders").select(
        "kafka_event_ts", raw("op").alias("raw_op"), raw("before.order_id", "after.order_id").cast("long").alias("raw_order_id"),
        raw("before.status", "after.status").alias("raw_status"), raw("source.ts_ms").cast("long").alias("raw_ts_ms")))


def bronze_malformed_and_null(spark: SparkSession, sf: str) -> DataFrame:
    ensure_session_defaults(spark)
    b = decode_envelope(td.malformed_order_records(spark, sf), ORDERS)
    return report(b.select("kafka_event_ts", "op", "order_id", "customer_id", "status", "amount",
                           "created_at", "source_ts_ms", F.col("raw_json").isNotNull().alias("has_raw_json")))


def dq_cast_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze cast-error counts over the edge-message topic."""
    ensure_session_defaults(spark)
    b = decode_envelope(td.malformed_order_records(spark, sf), ORDERS, track_cast_errors=True)
    return quality.cast_error_counts({"orders_bronze": b})


# --------------------------------------------------------------------- Silver
def silver_query(entity: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return report(_layers(spark, sf).silver(entity))
    return q


def silver_payments_window(spark: SparkSession, sf: str) -> DataFrame:
    """Same Silver through the ranked-window form (row_number = 1)."""
    b = _bronze(spark, sf, "payments").drop("raw_json").where(F.col("payment_id").isNotNull())
    return report(to_silver_columns(PAYMENTS, live_rows(rank_latest(b, "payment_id"))))


def _stream_silver(spark: SparkSession, sf: str, entity: str, deliveries: int) -> DataFrame:
    """Topic files -> Bronze stream (append) -> Silver stream (keyed state), each
    drained with availableNow; ``deliveries`` > 1 delivers the whole log again
    (duplicate delivery / replay)."""
    ensure_session_defaults(spark)
    spec = td.SPECS[entity]
    root = scratch_path(spark, f"stream_{entity}")
    topic = td.topic_records(spark, sf, entity)
    for i in range(deliveries):
        # hash-spread: arrival order unrelated to event order; the number of files follows the session
        stage(topic.repartition(F.xxhash64("value")), f"{root}/topic/delivery={i}")
    # files of the topic go once a batch has taken them into Bronze, the last ones when all is through
    src = read_topic(spark, fmt="parquet", path=f"{root}/topic/*", max_files_per_trigger=_third(spark, f"{root}/topic/*"),
                     options={"cleanSource": "delete"})
    qb = start_bronze(src, spec, f"{root}/bronze", f"{root}/_ckpt/bronze", available_now=True, if_running="allow")
    qb.awaitTermination()
    drop_staged(spark, f"{root}/topic")
    qs = start_silver(spark, f"{root}/bronze", spec, f"{root}/_ckpt/silver", available_now=True,
                      max_files_per_trigger=_third(spark, f"{root}/bronze"), if_running="allow")
    qs.awaitTermination()
    return read_silver(spark, f"{root}/_ckpt/silver", spec)


def _third(spark: SparkSession, path: str) -> int:
    """Files per micro-batch for about three micro-batches, however many files there are."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // 3))


def silver_orders_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Silver through a stop, a restart from the same checkpoint, and one batch delivered again."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_resume")
    bronze = _bronze(spark, sf, "orders").repartition(F.xxhash64("order_id"))
    first = F.pmod(F.xxhash64("order_id", "kafka_event_ts"), F.lit(2)) == 0
    for part in (bronze.where(first), bronze.where(~first), bronze.where(~first)):
        part.write.mode("append").parquet(f"{root}/bronze")
        start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/_ckpt", available_now=True, if_running="allow").awaitTermination()
    return report(read_silver(spark, f"{root}/_ckpt", ORDERS))


def silver_orders_same_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Two changes in one commit: the log position decides, in whichever order the state gets them."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_same_commit")
    topic = encode_envelope(td.same_commit_orders_changes(spark, sf), ORDERS, lsn_col="lsn")
    bronze = decode_envelope(topic, ORDERS, keep_lsn=True)
    for op in ("u", "c"):
        bronze.where(F.col("op") == op).write.mode("append").parquet(f"{root}/bronze")
        start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/_ckpt", tie_breaker=("source_lsn",), available_now=True,
                     if_running="allow").awaitTermination()
    return report(read_silver(spark, f"{root}/_ckpt", ORDERS, tie_breaker=("source_lsn",)))


def silver_payments_stream(spark: SparkSession, sf: str) -> DataFrame:
    return report(_stream_silver(spark, sf, "payments", deliveries=1))


def silver_transactions_replay(spark: SparkSession, sf: str) -> DataFrame:
    return report(_stream_silver(spark, sf, "transactions", deliveries=2))


def bronze_orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    ensure_session_defaults(spark)
    root = scratch_path(spark, "bronze_orders_stream")
    td.topic_records(spark, sf, "orders").repartition(F.xxhash64("value")).write.parquet(f"{root}/topic")
    q = start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic", max_files_per_trigger=_third(spark, f"{root}/topic")),
                     ORDERS, f"{root}/bronze", f"{root}/_ckpt", available_now=True, if_running="allow")
    q.awaitTermination()
    return report(spark.read.schema(ORDERS.bronze_schema).parquet(f"{root}/bronze").drop("raw_json"))


def bronze_orders_run_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by operation of a resumed run (started twice: the second start finds nothing new) and of a replay beside it."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "bronze_run_modes")
    td.topic_records(spark, sf, "orders").write.parquet(f"{root}/topic")
    outs = {}
    for mode in ("resume", "resume", "replay"):
        outs[mode] = out = run_folder(root, "orders", mode)
        start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic"), ORDERS, f"{out}/bronze", f"{out}/_ckpt",
                     available_now=True, if_running="allow").awaitTermination()
    runs = [spark.read.schema(ORDERS.bronze_schema).parquet(f"{out}/bronze").groupBy("op").agg(F.count("*").alias("cnt"))
            .select(F.lit(mode).alias("run_mode"), "op", "cnt") for mode, out in outs.items()]
    return reduce(DataFrame.unionByName, runs)


def bronze_non_scalar_text(spark: SparkSession, sf: str) -> DataFrame:
    """Status sent as an object, as an array, as a string in brackets and as plain text; only the strings stay."""
    ensure_session_defaults(spark)
    kind = F.pmod(F.get_json_object("key", "$.payload.order_id").cast("long"), F.lit(4))
    status = (F.when(kind == 0, F.lit('"status":{"v":"$1"}')).when(kind == 1, F.lit('"status":["$1"]'))
              .when(kind == 2, F.lit('"status":"[VIP] $1"')).otherwise(F.lit('"status":"$1"')))
    topic = td.topic_records(spark, sf, "orders")
    topic = topic.withColumn("value", F.regexp_replace("value", F.lit('"status":"([A-Z]+)"'), status))
    return report(decode_envelope(topic, ORDERS).drop("raw_json"))


# ----------------------------------------------------------------------- Gold
def gold_customer_order_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report(_layers(spark, sf).customer_order_summary())


def gold_order_payment_status(spark: SparkSession, sf: str) -> DataFrame:
    return report(_layers(spark, sf).order_payment_status())


def gold_order_payment_status_latest(spark: SparkSession, sf: str) -> DataFrame:
    return report(_layers(spark, sf).order_payment_status(latest_payment_only=True))


def gold_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return report(_layers(spark, sf).daily_revenue())


def gold_daily_revenue_table(spark: SparkSession, sf: str) -> DataFrame:
    """The daily mart as a catalog table: layers and tables declared twice, the mart refreshed in full twice."""
    m = _layers(spark, sf)
    root = scratch_path(spark, "catalog")
    prefix = f"tm_{root.rsplit('/', 1)[-1]}_"
    for _ in range(2):
        create_layers(spark, prefix)
        create_entity_tables(spark, prefix=prefix)
        write_full_refresh(m.daily_revenue(), f"{prefix}gold.daily_revenue_gold", path=f"{root}/daily_revenue_gold")
    return report(spark.table(f"{prefix}gold.daily_revenue_gold"))


# ------------------------------------------------------------------- Quality
def _keys(layer: Callable[[str], DataFrame], suffix: str) -> dict[str, tuple[DataFrame, str]]:
    return {f"{e}{suffix}": (layer(e), td.SPECS[e].key) for e in ENTITY_NAMES}


def dq_silver_pk(spark: SparkSession, sf: str) -> DataFrame:
    m = _layers(spark, sf)
    return quality.pk_violations(_keys(m.staged_silver, "_silver"))


def dq_bronze_pk(spark: SparkSession, sf: str) -> DataFrame:
    m = _layers(spark, sf)
    return quality.pk_violations(_keys(m.bronze, "_bronze"))


def dq_duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    m = _layers(spark, sf)
    return quality.duplicate_key_counts({**_keys(m.staged_silver, "_silver"), **_keys(m.bronze, "_bronze")})


def dq_delete_ops(spark: SparkSession, sf: str) -> DataFrame:
    m = _layers(spark, sf)
    s = {f"{e}_silver": m.silver(e) for e in ENTITY_NAMES}
    b = {f"{e}_bronze": m.bronze(e).withColumnRenamed("op", "bronze_op") for e in ENTITY_NAMES}
    return quality.delete_ops_present({**s, **b})


def dq_bronze_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.bronze_counts({f"{e}_bronze": _bronze(spark, sf, e) for e in ENTITY_NAMES})


def dq_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    m = _layers(spark, sf)
    return quality.table_counts({**{f"{e}_silver": m.staged_silver(e) for e in ENTITY_NAMES}, **m.gold()})


def dq_gold_keys(spark: SparkSession, sf: str) -> DataFrame:
    g = _layers(spark, sf).gold()
    return quality.key_tests({
        "customer_order_summary_gold": (g["customer_order_summary_gold"], "customer_id"),
        "order_payment_status_gold": (g["order_payment_status_gold"], "order_id"),
        "daily_revenue_gold": (g["daily_revenue_gold"], "revenue_date"),
    })


def dq_table_health(spark: SparkSession, sf: str) -> DataFrame:
    """Files and rows of each written Bronze table."""
    m = _layers(spark, sf)
    return quality.table_health({f"{e}_bronze": m.bronze(e) for e in ENTITY_NAMES}).select("table_name", "row_count", "healthy")


def dq_change_log(spark: SparkSession, sf: str) -> DataFrame:
    frames = []
    m = _layers(spark, sf)
    for e in ENTITY_NAMES:
        v = quality.validate_change_log(m.bronze(e), td.SPECS[e].key)
        # a log's report is written before the next log is checked, so that the shuffles of one log only are on disk
        report = v.select(F.lit(f"{e}_bronze").alias("table_name"), "check_name", "violations")
        frames.append(stage(report, scratch_path(spark, "change_log", e)))
    return reduce(DataFrame.unionByName, frames)


def _dirty_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze of the faulty orders log, as left by a writer that lost the text of events with an unknown op."""
    ensure_session_defaults(spark)
    b = decode_envelope(encode_envelope(td.dirty_orders_changes(spark, sf), ORDERS, lsn_col="lsn"), ORDERS)
    lost = F.coalesce(F.col("op") == td.UNKNOWN_OP, F.lit(False))
    return b.withColumn("raw_json", F.when(~lost, F.col("raw_json")))


def dq_change_log_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_change_log(_dirty_bronze(spark, sf), ORDERS.key)


def dq_bronze_counts_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return quality.bronze_counts({"orders_bronze": _dirty_bronze(spark, sf)})


# ------------------------------------------------------ topic views / consumers
def minimal_order_events(spark: SparkSession, sf: str) -> DataFrame:
    """Console-consumer lines ``key|value`` -> split -> compact order events."""
    ensure_session_defaults(spark)
    topic = td.topic_records(spark, sf, "orders")
    lines = topic.select(F.concat_ws("|", "key", "value").alias("value"))
    ev = minimal_order_event(split_keyed_line(lines), "replay", "orders-jsonl-replay")
    return ev.drop("ingested_at")


def minimal_order_events_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Console lines padded with white space, some with text behind the value, single quotes or a key that is no JSON."""
    ensure_session_defaults(spark)
    kind = F.pmod(F.get_json_object("key", "$.payload.order_id").cast("long"), F.lit(5))
    key = F.when(kind == 2, F.lit("no json")).otherwise(F.col("key"))
    value = (F.when(kind == 0, F.concat("value", F.lit(" junk"))).when(kind == 1, F.lit("{'payload':{'op':'c'}}"))
             .otherwise(F.col("value")))
    lines = td.topic_records(spark, sf, "orders").select(
        F.concat(F.lit("\t "), key, F.lit("\u00a0|\t"), value, F.lit("\u3000\r")).alias("value"))
    return minimal_order_event(split_keyed_line(lines), "replay", "orders-jsonl-replay").drop("ingested_at")


def orders_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Compact events streamed to JSON lines and read back, with the number of fields on each line."""
    ensure_session_defaults(spark)
    root = scratch_path(spark, "orders_jsonl")
    topic = td.topic_records(spark, sf, "orders")
    topic.write.parquet(f"{root}/topic")
    start_minimal_events_jsonl(read_topic(spark, fmt="parquet", path=f"{root}/topic"), f"{root}/out", f"{root}/_ckpt",
                               "replay", "orders-jsonl-replay", available_now=True).awaitTermination()
    schema = minimal_order_event(topic, "", "").drop("ingested_at").schema
    lines = spark.read.text(f"{root}/out")
    return lines.select(F.from_json("value", schema).alias("_e"), F.size(F.json_object_keys("value")).alias("n_fields")).select("_e.*", "n_fields")


def envelope_view_orders(spark: SparkSession, sf: str) -> DataFrame:
    ensure_session_defaults(spark)
    v = envelope_view(td.topic_records(spark, sf, "orders"))
    return v.select("consumer_mode", "consumer_group", "key", "op", F.col("before").getItem("status").alias("before_status"),
                    F.col("after").getItem("status").alias("after_status"))


# ------------------------------------------------------- feeds / DML scenarios
def _orders_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = td.read_table(spark, sf, "orders")
    ts = F.date_trunc("millisecond", F.col("o_orderdate").cast(T.TimestampType()))
    status = td.map_values(F.col("o_orderstatus"), td.ORDER_STATUS)
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("status"),
        F.col("o_totalprice").cast(AMOUNT_TYPE).alias("amount"), ts.alias("created_at"), ts.alias("updated_at"),
        F.col("o_orderpriority").alias("_priority"),
    )


def bulk_set(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE t SET col = expr, ... WHERE predicate`` as a projection."""
    return df.withColumns({
        c: F.when(predicate, e).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, e in assignments.items()
    })


def change_feed_orders(spark: SparkSession, sf: str, feed: Callable[..., DataFrame] = change_feed) -> DataFrame:
    ensure_session_defaults(spark)
    rows = _orders_rows(spark, sf)
    before = rows.where(F.col("_priority") != FEED_INSERT_PRIORITY)
    after = rows.where(F.col("_priority") != FEED_DELETE_PRIORITY)
    after = bulk_set(after, F.col("_priority") == FEED_PAID_PRIORITY, {"status": F.lit("PAID")})
    after = bulk_set(after, F.col("_priority") == FEED_RAISE_PRIORITY,
                     {"amount": F.col("amount") * F.lit(PRICE_FACTOR).cast("decimal(2,1)")})
    changes = feed(before.drop("_priority"), after.drop("_priority"), ORDERS, source_ts_ms=F.lit(0))
    return report(changes.select(
        "op",
        F.coalesce(F.col("after.order_id"), F.col("before.order_id")).alias("order_id"),
        F.col("before.status").alias("before_status"), F.col("after.status").alias("after_status"),
        F.col("before.amount").alias("before_amount"), F.col("after.amount").alias("after_amount"),
    ))


def _customer_rows(spark: SparkSession, sf: str, with_email: bool) -> DataFrame:
    c = td.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = td.read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    email = (F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@example.com")) if with_email
             else F.lit(None).cast("string"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), email.alias("email"),
        F.col("n_name").alias("country"), F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def snapshot_feed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Initial snapshot -> r events -> envelopes -> Bronze -> Silver."""
    ensure_session_defaults(spark)
    feed = snapshot_feed(_customer_rows(spark, sf, with_email=True), CUSTOMERS, source_ts_ms=F.lit(0)).withColumn(
        "kafka_event_ts", F.timestamp_millis(F.lit(0)))
    topic = encode_envelope(feed, CUSTOMERS, wrapped=F.pmod(F.col("after.customer_id"), F.lit(2)) == 0)
    return report(silver(decode_envelope(topic, CUSTOMERS), CUSTOMERS))


def apply_changes_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer table as the base, the customers change log applied on top."""
    ensure_session_defaults(spark)
    out = apply_changes(_customer_rows(spark, sf, with_email=False), _bronze(spark, sf, "customers"), CUSTOMERS)
    return report(out)


def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    ensure_session_defaults(spark)
    rows = _orders_rows(spark, sf)
    target = rows.drop("_priority")
    upd = rows.where(F.col("_priority") == UPSERT_UPDATE_PRIORITY).select(
        "order_id", "customer_id", F.lit("PAID").alias("status"),
        (F.col("amount") * F.lit(PRICE_FACTOR).cast("decimal(2,1)")).cast(AMOUNT_TYPE).alias("amount"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))
    ins = rows.where(F.col("_priority") == UPSERT_INSERT_PRIORITY).select(
        (F.col("order_id") + F.lit(UPSERT_KEY_OFFSET)).alias("order_id"), "customer_id", "status", "amount",
        "created_at", "updated_at")
    out = merge_upsert(target, upd.unionByName(ins), "order_id", ["customer_id", "status", "amount"],
                       touch_col="updated_at", touch_value=F.lit(UPSERT_TOUCH_TS).cast("timestamp"))
    return report(out)


# ----------------------------------------------------------------- ad-hoc SQL
def _register_gold(spark: SparkSession, sf: str) -> None:
    register_views(_layers(spark, sf).gold())


def adhoc_report_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    _register_gold(spark, sf)
    return spark.sql("SELECT customer_id, total_orders, total_paid_amount FROM customer_order_summary_gold "
                     "ORDER BY customer_id")


def adhoc_report_by_date(spark: SparkSession, sf: str) -> DataFrame:
    _register_gold(spark, sf)
    return spark.sql("SELECT revenue_date, gross_revenue FROM daily_revenue_gold ORDER BY revenue_date")


QUERIES = {
    **{f"bronze_{e}": bronze_query(e) for e in ENTITY_NAMES},
    "bronze_malformed_and_null": bronze_malformed_and_null,
    "bronze_orders_stream": bronze_orders_stream,
    "bronze_orders_raw": bronze_orders_raw,
    "bronze_orders_run_modes": bronze_orders_run_modes,
    "bronze_non_scalar_text": bronze_non_scalar_text,
    "dq_cast_errors": dq_cast_errors,
    **{f"silver_{e}": silver_query(e) for e in ENTITY_NAMES},
    "silver_payments_window": silver_payments_window,
    "silver_payments_stream": silver_payments_stream,
    "silver_transactions_replay": silver_transactions_replay,
    "silver_orders_resume": silver_orders_resume,
    "silver_orders_same_commit": silver_orders_same_commit,
    "gold_customer_order_summary": gold_customer_order_summary,
    "gold_order_payment_status": gold_order_payment_status,
    "gold_order_payment_status_latest": gold_order_payment_status_latest,
    "gold_daily_revenue": gold_daily_revenue,
    "gold_daily_revenue_table": gold_daily_revenue_table,
    "dq_silver_pk": dq_silver_pk,
    "dq_bronze_pk": dq_bronze_pk,
    "dq_duplicate_counts": dq_duplicate_counts,
    "dq_delete_ops": dq_delete_ops,
    "dq_bronze_counts": dq_bronze_counts,
    "dq_table_counts": dq_table_counts,
    "dq_gold_keys": dq_gold_keys,
    "dq_table_health": dq_table_health,
    "dq_change_log": dq_change_log,
    "dq_change_log_dirty": dq_change_log_dirty,
    "dq_bronze_counts_dirty": dq_bronze_counts_dirty,
    "minimal_order_events": minimal_order_events,
    "minimal_order_events_dirty": minimal_order_events_dirty,
    "orders_jsonl": orders_jsonl,
    "envelope_view_orders": envelope_view_orders,
    "change_feed_orders": change_feed_orders,
    "snapshot_feed_customers": snapshot_feed_customers,
    "apply_changes_customers": apply_changes_customers,
    "upsert_orders": upsert_orders,
    "adhoc_report_by_customer": adhoc_report_by_customer,
    "adhoc_report_by_date": adhoc_report_by_date,
}
