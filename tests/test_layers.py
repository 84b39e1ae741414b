"""Bucketed tables, catalog tables filled by streams, VARIANT decode, order check, digest feed, EXISTS checks, payment fan-out."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import order_bronze, rows_of, ts
from tidemark.entities import CUSTOMERS, ORDERS
from tidemark.functions import decode_envelope
from tidemark.operators import marts, quality
from tidemark.operators.feed import bucket_digests, change_feed, change_feed_by_digest
from tidemark.operators.state import silver
from tidemark.plans import layer_queries, queries
from tidemark.plans.catalog import create_entity_tables, create_layers, create_silver_views, write_bucketed
from tidemark.sources import testdata as td
from tidemark.streaming import read_topic, start_bronze

SF = "/root/testdata/sf0.001"


def fresh():
    return tempfile.mkdtemp(prefix="tidemark-layers-")


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan")[0]


@pytest.fixture
def settings(spark):
    before = {}

    def put(**values):
        for k, v in values.items():
            k = "spark.sql." + k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# ------------------------------------------------------------ payment fan-out
def hot_order(spark, root):
    """A third of the payments on one order."""
    orders = spark.range(3000).select(F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("PAID").alias("status"),
                                      F.lit(1).cast("decimal(12,2)").alias("amount"), F.lit(None).cast("timestamp").alias("created_at"))
    pay = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2900).cast("long").alias("order_id"),
                                     F.md5(F.col("id").cast("string")).alias("payment_status"))
    txn = spark.range(9000).select(F.col("id").alias("transaction_id"), (F.col("id") % 3000).alias("order_id"), F.lit("OK").alias("txn_status"),
                                   F.col("id").alias("bronze_source_ts_ms"), F.lit(None).cast("timestamp").alias("bronze_kafka_event_ts"))
    out = []
    for name, df in (("o", orders), ("p", pay), ("t", txn)):
        df.repartition(4).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_hot_order_is_split_in_the_marts_last_join(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", shuffle__partitions="32", adaptive__advisoryPartitionSizeInBytes="32k",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="32k", adaptive__skewJoin__skewedPartitionFactor="2")
    df = marts.order_payment_status(*hot_order(spark, fresh()))
    plan = plan_of(df)
    lines = plan.splitlines()
    split = next(i for i, line in enumerate(lines) if "SortMergeJoin(skew=true)" in line)
    assert "[order_id" in lines[split] and not any("Exchange" in line for line in lines[:split])
    assert df.where("order_id = 7").count() == 30_000 + len([i for i in range(90_000) if i % 3 and i % 2900 == 7])
    assert df.where("latest_payment_status IS NULL").count() == 100  # orders without payments


def test_marts_over_bucketed_tables_exchange_no_order(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    df = layer_queries.gold_order_payment_status_bucketed(spark, SF)
    assert "Exchange" not in plan_of(df) and "Bucketed: true" in plan_of(df)
    plan = plan_of(layer_queries.gold_customer_order_summary_bucketed(spark, SF))
    assert "hashpartitioning(order_id" not in plan and "hashpartitioning(customer_id" in plan


def test_bucketed_write_makes_one_file_per_bucket(spark):
    create_layers(spark, "tb_")
    t = write_bucketed(order_bronze(spark, [("c", k, "A", 1, 1, 1) for k in range(200)]).repartition(3), "tb_silver.by_order", "order_id", 4, path=fresh())
    assert t.count() == 200 and len(t.inputFiles()) == 4


# ------------------------------------------------------------- catalog tables
def test_stream_into_declared_tables_shows_in_silver_views(spark):
    root = fresh()
    create_layers(spark, "tc_")
    create_entity_tables(spark, prefix="tc_", layers=("bronze",), path=f"{root}/bronze")
    create_silver_views(spark, prefix="tc_")
    assert spark.table("tc_silver.orders_silver").count() == 0
    topic = td.topic_records(spark, SF, "orders")
    for _ in range(2):  # a second run of the same checkpoint adds what is new, here the log once more
        topic.write.mode("append").parquet(f"{root}/topic")
        start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic"), ORDERS, None, f"{root}/ck", table="tc_bronze.orders_bronze",
                     available_now=True).awaitTermination()
    assert spark.table("tc_bronze.orders_bronze").count() == 2 * topic.count()
    want = silver(td.bronze(spark, SF, "orders"), ORDERS)
    got = spark.table("tc_silver.orders_silver")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="folder or a table"):
        start_bronze(topic, ORDERS, None, root)


# --------------------------------------------------------------------- VARIANT
def test_variant_decode_equals_struct_decode(spark):
    for topic in (td.topic_records(spark, SF, "orders"), td.malformed_order_records(spark, SF)):
        both = [sorted(map(str, decode_envelope(topic, ORDERS, parser=p).collect())) for p in ("struct", "variant")]
        assert both[0] == both[1]
    with pytest.raises(ValueError, match="parser"):
        decode_envelope(topic, ORDERS, parser="regex")


def test_variant_keeps_digits_and_parses_once(spark, settings):
    settings(debug__maxToStringFields="10000")
    message = '{"op":"c","after":{"order_id":7,"status":%s,"amount":%s},"source":{"ts_ms":5}}'
    cases = [("98765432109876543210", "12.50"), ('"[VIP] x"', "0.10"), ('{"a":"[x"}', '"3.00"'), ('["x"]', "1e2"), ("true", "null"), ("12.5", "99999999999.99")]
    rows = [("k", message % c, ts(i)) for i, c in enumerate(cases)]
    df = decode_envelope(spark.createDataFrame(rows, "key string, value string, timestamp timestamp"), ORDERS, parser="variant")
    got = {r.kafka_event_ts: (r.status, None if r.amount is None else str(r.amount)) for r in df.collect()}
    assert [got[k] for k in sorted(got)] == [("98765432109876543210", "12.50"), ("[VIP] x", "0.10"), (None, "3.00"), (None, "100.00"), ("true", None),
                                             ("12.5", None)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


# ----------------------------------------------------------------- order check
def descents_of(df):
    return rows_of(quality.order_descents(df, "order_id"), "order_id", "events", "descents")


def test_order_check_finds_inner_inversions(spark):
    arrive = lambda key, commits: [("u", key, "S", 1, c, i) for i, c in enumerate(commits)]
    rows = (arrive(1, [1, 3, 2, 4]) + arrive(2, [1, 2, 3, 4]) + arrive(3, [4, 3, 2, 1]) + arrive(4, [5]) + arrive(5, [2, 2, 2])
            + arrive(None, [3, 1]) + [("u", 6, "S", 1, None, 1), ("u", 6, "S", 1, 1, 2)] + [("u", 8, "S", 1, 2, 1), ("u", 8, "S", 1, 1, 1)])
    assert descents_of(order_bronze(spark, rows)) == [(1, 4, 1), (3, 4, 3)]  # events that arrive together have no order of arrival
    assert descents_of(order_bronze(spark, [])) == []


def test_order_check_splits_a_hot_key(spark, settings):
    settings(shuffle__partitions="16", adaptive__coalescePartitions__enabled="false")
    n = 6000
    commit = F.when(F.col("id") % 100 == 50, F.col("id") - 40).otherwise(F.col("id"))
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("long").alias("order_id"), commit.alias("source_ts_ms"),
                               F.timestamp_millis("id").alias("kafka_event_ts")).repartition(8)
    seen, last, down = 0, None, 0
    for i in range(0, n, 3):
        c = i - 40 if i % 100 == 50 else i
        seen, down, last = seen + 1, down + (last is not None and last > c), c
    assert descents_of(df) == [(-1, seen, down)]
    sizes = (df.repartitionByRange("order_id", "kafka_event_ts", "source_ts_ms")
             .where("order_id = -1").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) >= 4  # the hot key's rows lie in several tasks


# ------------------------------------------------------------------ digest feed
def customers(spark, rows):
    return spark.createDataFrame([(k, name, None, "X", None, None) for k, name in rows], CUSTOMERS.payload_schema)


def test_digest_feed_equals_the_full_join(spark):
    old = customers(spark, [(k, f"n{k}") for k in range(300)] + [(None, "a")])
    new = customers(spark, [(k, None if k == 5 else f"n{k}" if k != 9 else "other") for k in range(3, 310)] + [(None, "a")])
    as_set = lambda df: sorted(map(str, df.collect()))
    want = change_feed(old, new, CUSTOMERS, source_ts_ms=F.lit(0)).where("coalesce(before.customer_id, after.customer_id) IS NOT NULL")
    for buckets in (1, 7, 65_536):
        got = change_feed_by_digest(old, new, CUSTOMERS, source_ts_ms=F.lit(0), buckets=buckets)
        assert as_set(got.where("coalesce(before.customer_id, after.customer_id) IS NOT NULL")) == as_set(want)
    assert change_feed_by_digest(old, old, CUSTOMERS).where("op IS NOT NULL AND op <> 'c'").count() == 0
    empty = customers(spark, [])
    assert change_feed_by_digest(empty, empty, CUSTOMERS).count() == 0


def test_digest_feed_joins_only_buckets_that_differ(spark):
    rows = [(k, f"n{k}") for k in range(4000)]
    old, new = customers(spark, rows), customers(spark, rows[:-1] + [(3999, "changed")])
    digests = [dict((r.bucket, r.digest) for r in bucket_digests(d, CUSTOMERS, 64).collect()) for d in (old, new)]
    differ = [b for b in digests[0] if digests[0][b] != digests[1][b]]
    assert len(digests[0]) == 64 and len(differ) == 1
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(64))
    root = fresh()
    for name, d in (("old", old), ("new", new)):
        d.write.parquet(f"{root}/{name}")
    feed = change_feed_by_digest(spark.read.parquet(f"{root}/old"), spark.read.parquet(f"{root}/new"), CUSTOMERS, buckets=64)
    assert rows_of(feed, "op") == [("u",)]
    assert "BroadcastHashJoin" in plan_of(feed) and "LeftSemi" in plan_of(feed)
    assert old.where(bucket == differ[0]).count() < 200  # rows that reach the join
    # a null that changes its column is a change
    a = spark.createDataFrame([(1, "x", None, "C", None, None)], CUSTOMERS.payload_schema)
    b = spark.createDataFrame([(1, None, "x", "C", None, None)], CUSTOMERS.payload_schema)
    assert rows_of(change_feed_by_digest(a, b, CUSTOMERS), "op") == [("u",)]


# ---------------------------------------------------------------- EXISTS checks
def test_exists_checks_stop_at_a_limit(spark):
    create_layers(spark, "te_")
    order_bronze(spark, [("c", 1, "A", 1, 1, 1), ("c", 1, "A", 1, 1, 1), ("c", None, "A", 1, 1, 1)]).write.mode("overwrite").saveAsTable("te_silver.bad")
    order_bronze(spark, [("c", 1, "A", 1, 1, 1), ("c", 2, "A", 1, 1, 1)]).write.mode("overwrite").saveAsTable("te_silver.good")
    df = quality.pk_violations_by_exists(spark, {"te_silver.bad": "order_id", "te_silver.good": "order_id"})
    assert rows_of(df, "test_name") == [("bad_duplicate_pk",), ("bad_null_pk",)]
    assert df._jdf.queryExecution().executedPlan().toString().count("CollectLimit 1") >= 4


def test_queries_and_oracles_are_all_named(spark):
    from tidemark.plans.oracle import oracle_sql
    assert set(layer_queries.QUERIES) | set(queries.QUERIES) == set(oracle_sql())
    assert not set(layer_queries.QUERIES) & set(queries.QUERIES)


def test_buckets_grow_with_the_log(spark, monkeypatch):
    from tidemark.plans import layer_queries as lq
    made = []
    write = lq.write_bucketed
    monkeypatch.setattr(lq, "write_bucketed", lambda df, table, key, buckets, path=None: made.append(buckets) or write(df, table, key, buckets, path))
    monkeypatch.setattr(lq, "BUCKET_ROWS", 500)
    lq._bucketed(spark, "/root/testdata/sf0.001", ("orders", "payments"))
    assert len(set(made)) == 1 and made[0] > lq.BUCKETS


def test_order_check_parses_its_faulty_log_once(spark):
    root, day = fresh(), "timestamp_ntz'2024-01-01 00:00:00'"
    tables = {"orders": f"SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 1.5D AS o_totalprice, {day} AS o_orderdate, "
                        "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), CAST(id % 4 AS INT) + 1) AS o_orderpriority FROM range(8)",
              "lineitem": "SELECT id AS l_orderkey, id AS l_partkey, 1L AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, 'N' AS l_returnflag, "
                          f"'O' AS l_linestatus, {day} AS l_shipdate FROM range(8)",
              "events": f"SELECT id AS event_id, {day} AS ts, id AS user_id, 'signup' AS event_type FROM range(8)",
              "customer": "SELECT id AS c_custkey, 'n' AS c_name, 1L AS c_nationkey FROM range(8)", "nation": "SELECT 1L AS n_nationkey, 'N' AS n_name"}
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{root}/{name}.parquet")
    out = layer_queries.dq_order_kept(spark, root)
    # two orders commit 1, 3, 2, 4, two 4, 1, 2, 3; the two of the shared key arrive in turn, in order
    assert [(r.keys_out_of_order, r.descents) for r in out.collect() if r.table_name == "inverted_orders"] == [(4, 4)]
    assert not [f for f in out.inputFiles() if f.startswith(f"file://{root}") or f.startswith(f"file:{root}")]
