"""Change logs derived from the driver's TPC-H-like tables.

The driver tables hold no change data, so each entity's log is derived from
them with fixed rules (listed below), encoded into change envelopes and then
decoded like any topic.  Every rule is a column expression over whole tables;
nothing is sampled.

customers    events JOIN customer JOIN nation (user_id = c_custkey)
             signup -> c, error -> d, other event types -> u; commit time = event ts
orders       one event per order (status F -> r/PAID, O -> c/CREATED, P -> u/SHIPPED),
             plus a delete one day later for priority '5-LOW'
payments     lineitem JOIN orders; payment_id = l_orderkey * 10 + l_linenumber
             (repeats, so a natural change log); returnflag R -> d, A -> u, N -> c
transactions lineitem JOIN orders; transaction_id = payment_id; quantity >= 45 -> d, else u
Message shape: wrapped in ``payload`` for even keys, flat for odd keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import AMOUNT_TYPE, CUSTOMERS, ORDERS, PAYMENTS, TRANSACTIONS, EntitySpec
from tidemark.functions.envelope import decode_envelope, encode_envelope

# Fixed derivation values (shared with the DuckDB oracle in __spark_entry__.py).
ORDER_STATUS = {"F": "PAID", "O": "CREATED", "P": "SHIPPED"}
ORDER_OP = {"F": "r", "O": "c", "P": "u"}
ORDER_DELETE_PRIORITY = "5-LOW"
CUSTOMER_OP = {"signup": "c", "error": "d"}  # anything else -> u
PAYMENT_METHOD = {"O": "CARD", "F": "WALLET"}
PAYMENT_OP = {"R": "d", "A": "u", "N": "c"}
TXN_TYPE = {"O": "CAPTURE", "F": "AUTH"}
TXN_STATUS = {"O": "SUCCESS", "F": "PENDING"}
TXN_DELETE_QUANTITY = 45.0
DAY_MS = 86_400_000
UNKNOWN_OP = "x"
SECOND_STATUS = "DELIVERED"
HOT_ORDER = -1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_values(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """CASE c WHEN k THEN v ... ELSE default END for a fixed mapping."""
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(default if default is not None else F.lit(None).cast("string"))


def _ts(c: Column) -> Column:
    """timestamp_ntz table column -> timestamp (session zone is UTC) at ms precision."""
    return F.date_trunc("millisecond", c.cast(T.TimestampType()))


def _row(spec: EntitySpec, values: dict[str, Column]) -> Column:
    return F.struct(*[values[n].cast(t).alias(n) for n, t in spec.columns])


def _event(op: Column, row: Column, source_ts_ms: Column, kafka_ts: Column, lsn: Column | None = None) -> Column:
    is_delete = op == "d"
    return F.struct(
        op.alias("op"),
        F.when(is_delete, row).alias("before"),
        F.when(~is_delete | op.isNull(), row).alias("after"),
        source_ts_ms.cast("long").alias("source_ts_ms"),
        kafka_ts.alias("kafka_event_ts"),
        (lsn if lsn is not None else source_ts_ms).cast("long").alias("lsn"),
    )


def _changes(df: DataFrame, event: Column) -> DataFrame:
    return df.select(event.alias("_ev")).select("_ev.*")


def customers_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = ev.join(cu, ev.user_id == cu.c_custkey).join(na, F.col("c_nationkey") == F.col("n_nationkey"))
    ts = _ts(F.col("ts"))
    row = _row(CUSTOMERS, {
        "customer_id": F.col("user_id"),
        "full_name": F.col("c_name"),
        "email": F.concat(F.lit("u"), F.col("user_id"), F.lit("."), F.col("event_id"), F.lit("@example.com")),
        "country": F.col("n_name"),
        "created_at": ts,
        "updated_at": ts,
    })
    op = map_values(F.col("event_type"), CUSTOMER_OP, F.lit("u"))
    return _changes(j, _event(op, row, F.unix_millis(ts), ts))


def _orders_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    """(orders table, its time, its order row)"""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ts = _ts(F.col("o_orderdate"))
    row = _row(ORDERS, {
        "order_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "status": map_values(F.col("o_orderstatus"), ORDER_STATUS),
        "amount": F.col("o_totalprice").cast(AMOUNT_TYPE),
        "created_at": ts,
        "updated_at": ts,
    })
    return o, ts, row


def orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, ts, row = _orders_rows(spark, sf_dir)
    first = _event(map_values(F.col("o_orderstatus"), ORDER_OP), row, F.unix_millis(ts), ts)
    del_ts = F.timestamp_millis(F.unix_millis(ts) + F.lit(DAY_MS))
    delete = _event(F.lit("d"), row, F.unix_millis(ts) + F.lit(DAY_MS), del_ts)
    events = F.when(F.col("o_orderpriority") == ORDER_DELETE_PRIORITY, F.array(first, delete)).otherwise(F.array(first))
    return o.select(F.explode(events).alias("_ev")).select("_ev.*")


def dirty_orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An orders log with one fault per priority: an unknown op (1), a duplicate (2), an older change that
    arrives a day late (3), a delete without its before image (4), no op (5)."""
    o, ts, row = _orders_rows(spark, sf_dir)
    ms = F.unix_millis(ts)
    first = _event(map_values(F.col("o_orderstatus"), ORDER_OP), row, ms, ts)
    late = _event(F.lit("u"), row, ms - F.lit(DAY_MS), F.timestamp_millis(ms + F.lit(DAY_MS)))
    blind = F.struct(F.lit("d").alias("op"), F.when(F.lit(False), row).alias("before"), F.when(F.lit(False), row).alias("after"),
                     ms.alias("source_ts_ms"), ts.alias("kafka_event_ts"), ms.alias("lsn"))
    pr = F.col("o_orderpriority")
    events = (F.when(pr == "1-URGENT", F.array(_event(F.lit(UNKNOWN_OP), row, ms, ts)))
              .when(pr == "2-HIGH", F.array(first, first)).when(pr == "3-MEDIUM", F.array(first, late))
              .when(pr == "4-NOT SPECIFIED", F.array(blind))
              .otherwise(F.array(_event(F.lit(None).cast("string"), row, ms, ts))))
    return o.select(F.explode(events).alias("_ev")).select("_ev.*")


def inverted_orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four changes per order, a day apart in arrival.  Priority 1: committed as 1, 3, 2, 4; priority 3: 4, 1, 2, 3;
    else in order.  All orders of priority 2 share the key ``HOT_ORDER``."""
    o, ts, row = _orders_rows(spark, sf_dir)
    ms, pr = F.unix_millis(ts), F.col("o_orderpriority")
    row = row.withField("order_id", F.when(pr == "2-HIGH", F.lit(HOT_ORDER)).otherwise(F.col("o_orderkey")))
    commits = (F.when(pr == "1-URGENT", F.array(*map(F.lit, (1, 3, 2, 4)))).when(pr == "3-MEDIUM", F.array(*map(F.lit, (4, 1, 2, 3))))
               .otherwise(F.array(*map(F.lit, (1, 2, 3, 4)))))
    return (o.select(row.alias("row"), ms.alias("ms"), "o_orderkey", commits.alias("commits"))
            .select("row", "ms", "o_orderkey", F.posexplode("commits").alias("at", "commit"))
            # the order's key in milliseconds keeps arrivals of the shared key apart
            .select(_event(F.lit("u"), F.col("row"), F.col("ms") + F.col("commit") * DAY_MS + F.col("o_orderkey"),
                           F.timestamp_millis(F.col("ms") + (F.col("at") + 1) * DAY_MS + F.col("o_orderkey"))).alias("_ev")).select("_ev.*"))


def same_commit_orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two changes of every order in one commit: equal times, told apart by the log position only."""
    o, ts, row = _orders_rows(spark, sf_dir)
    ms = F.unix_millis(ts)
    first = _event(F.lit("c"), row, ms, ts)
    second = _event(F.lit("u"), row.withField("status", F.lit(SECOND_STATUS)), ms, ts, ms + 1)
    return o.select(F.explode(F.array(first, second)).alias("_ev")).select("_ev.*")


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def _line_times() -> tuple[Column, Column, Column]:
    ts = _ts(F.col("l_shipdate"))
    src = F.unix_millis(ts)
    # broker time: ship time plus the part key in ms -> no ties within a key
    return ts, src, F.timestamp_millis(src + F.col("l_partkey"))


def payments_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, src, kts = _line_times()
    pid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    row = _row(PAYMENTS, {
        "payment_id": pid,
        "order_id": F.col("l_orderkey"),
        "customer_id": F.col("o_custkey"),
        "payment_method": map_values(F.col("l_linestatus"), PAYMENT_METHOD),
        "payment_status": F.when(F.col("l_returnflag") == "A", F.lit("PAID")).otherwise(F.lit("PENDING")),
        "amount": F.col("l_extendedprice").cast(AMOUNT_TYPE),
        "created_at": ts,
        "updated_at": ts,
    })
    return _changes(_lineitem_orders(spark, sf_dir), _event(map_values(F.col("l_returnflag"), PAYMENT_OP), row, src, kts))


def transactions_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, src, kts = _line_times()
    pid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    row = _row(TRANSACTIONS, {
        "transaction_id": pid,
        "payment_id": pid,
        "order_id": F.col("l_orderkey"),
        "customer_id": F.col("o_custkey"),
        "txn_type": map_values(F.col("l_linestatus"), TXN_TYPE),
        "txn_status": map_values(F.col("l_linestatus"), TXN_STATUS),
        "amount": F.col("l_extendedprice").cast(AMOUNT_TYPE),
        "created_at": ts,
        "updated_at": ts,
    })
    op = F.when(F.col("l_quantity") >= TXN_DELETE_QUANTITY, F.lit("d")).otherwise(F.lit("u"))
    return _changes(_lineitem_orders(spark, sf_dir), _event(op, row, src, kts))


CHANGE_BUILDERS = {
    "customers": customers_changes,
    "orders": orders_changes,
    "payments": payments_changes,
    "transactions": transactions_changes,
}
SPECS = {"customers": CUSTOMERS, "orders": ORDERS, "payments": PAYMENTS, "transactions": TRANSACTIONS}


def _wrapped_for_even_key(spec: EntitySpec) -> Column:
    k = F.coalesce(F.col("after").getField(spec.key), F.col("before").getField(spec.key))
    return F.pmod(k, F.lit(2)) == 0


def topic_records(spark: SparkSession, sf_dir: str, entity: str, spread: bool = False) -> DataFrame:
    """Topic records ``(key, value, timestamp)`` for an entity, as a CDC topic holds them.

    ``spread`` deals the changes by hash, so that arrival order is unrelated to event order and the number of files
    follows the session, not the tables' files.  They are dealt before they are encoded: typed rows are a fraction of
    their messages' size."""
    spec = SPECS[entity]
    changes = CHANGE_BUILDERS[entity](spark, sf_dir)
    if spread:
        changes = changes.repartition(F.xxhash64("op", "before", "after", "source_ts_ms", "kafka_event_ts"))
    return encode_envelope(changes, spec, wrapped=_wrapped_for_even_key(spec), lsn_col="lsn")


def bronze(spark: SparkSession, sf_dir: str, entity: str, **decode_opts) -> DataFrame:
    return decode_envelope(topic_records(spark, sf_dir, entity), SPECS[entity], **decode_opts)


# Edge messages built from the orders table, one kind per priority value.
MALFORMED_KIND = {
    "1-URGENT": "null_message",
    "2-HIGH": "not_json",
    "3-MEDIUM": "bad_amount",
    "4-NOT SPECIFIED": "missing_op",
    "5-LOW": "amount_overflow",
}
BAD_AMOUNT_TEXT = "abc"
OVERFLOW_AMOUNT_TEXT = "99999999999.99"


def malformed_order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders topic carrying edge messages: null value, non-JSON text, unparseable
    and overflowing amounts, and a missing op."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ts = _ts(F.col("o_orderdate"))
    pr = F.col("o_orderpriority")
    amount_text = (
        F.when(pr == "3-MEDIUM", F.lit(BAD_AMOUNT_TEXT))
        .when(pr == "5-LOW", F.lit(OVERFLOW_AMOUNT_TEXT))
        .otherwise(F.col("o_totalprice").cast(AMOUNT_TYPE).cast("string"))
    )
    after = F.struct(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        map_values(F.col("o_orderstatus"), ORDER_STATUS).alias("status"), amount_text.alias("amount"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
    )
    body = F.struct(
        F.when(pr != "4-NOT SPECIFIED", map_values(F.col("o_orderstatus"), ORDER_OP)).alias("op"),
        after.alias("after"),
        F.struct(F.unix_millis(ts).alias("ts_ms")).alias("source"),
    )
    value = (
        F.when(pr == "1-URGENT", F.lit(None).cast("string"))
        .when(pr == "2-HIGH", F.lit("not json"))
        .otherwise(F.to_json(F.struct(body.alias("payload"))))
    )
    return o.select(F.lit(None).cast("string").alias("key"), value.alias("value"), ts.alias("timestamp"))
