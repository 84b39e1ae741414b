import datetime as dt
import tempfile
from decimal import Decimal

from tests.conftest import order_bronze, rows_of
from tidemark.entities import ORDERS
from tidemark.operators import quality
from tidemark.operators.feed import change_feed, flatten_feed, snapshot_feed
from pyspark.sql import functions as F


def test_pk_violations_and_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k long")
    ok = spark.createDataFrame([(1,), (2,)], "k long")
    got = rows_of(quality.pk_violations({"a": (df, "k"), "b": (ok, "k")}), "test_name")
    assert got == [("a_duplicate_pk",), ("a_null_pk",)]
    cnt = {r.check_name: r.cnt for r in quality.duplicate_key_counts({"a": (df, "k"), "b": (ok, "k")}).collect()}
    assert cnt == {"a_pk_duplicates": 1, "b_pk_duplicates": 0}
    assert quality.check_not_null(df, "k").count() == 1
    assert rows_of(quality.check_unique(df, "k"), "k", "n_records") == [(1, 2)]


def test_delete_ops_counts_health(spark):
    b = order_bronze(spark, [("c", 1, "A", 1, 1, 1), ("d", 1, "A", 1, 2, 2), (None, 2, "A", 1, 1, 1)])
    d = {r.check_name: r.cnt for r in quality.delete_ops_present({"o": b.withColumnRenamed("op", "bronze_op")}).collect()}
    assert d == {"o_delete_ops_present": 1}
    bc = quality.bronze_counts({"o": b}).collect()[0]
    assert (bc.cnt, bc.raw_json_nulls, bc.null_ops) == (3, 0, 1)
    assert rows_of(quality.table_counts({"o": b}), "table_name", "cnt") == [("o", 3)]
    path = tempfile.mkdtemp(prefix="tidemark-health-") + "/t"
    b.repartition(2).write.parquet(path)
    h = quality.table_health({"o": spark.read.parquet(path)}).collect()[0]
    assert (h.data_files, h.row_count, h.healthy) == (2, 3, True)


def test_validate_change_log(spark):
    ev = [("c", 1, "A", 1, 1, 1), ("c", 1, "A", 1, 1, 1), ("x", 2, "A", 1, 1, 1),
          ("u", 3, "A", 1, 5, 1), ("u", 3, "B", 1, 4, 9), ("d", None, "A", 1, 1, 1)]
    v = {r.check_name: r.violations for r in quality.validate_change_log(order_bronze(spark, ev), "order_id").collect()}
    assert v == {"unexpected_op": 1, "duplicate_event": 1, "out_of_order": 1, "delete_without_before": 1}


def test_validate_change_log_null_and_tied_commits_without_a_sort(spark):
    late, tied, null_only, null_late = 1, 2, 3, 4
    ev = [("u", late, "A", 1, None, 1), ("u", late, "A", 1, 4, 9), ("u", late, "A", 1, 5, 3),  # the newest arrived before the last
          ("u", tied, "A", 1, 5, 2), ("c", tied, "A", 1, 5, 8), ("u", tied, "A", 1, 4, 7),  # of one commit the later arrival counts
          ("u", null_only, "A", 1, None, 2), ("u", null_only, "A", 1, None, 6),
          ("u", null_late, "A", 1, 1, 2), ("u", null_late, "A", 1, None, 6)]
    out = quality.validate_change_log(order_bronze(spark, ev), "order_id")
    assert {r.check_name: r.violations for r in out.collect()}["out_of_order"] == len((late, null_late))
    assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()


def test_change_feed_ops(spark):
    t = dt.datetime(2024, 1, 1)
    sch = ORDERS.payload_schema
    before = spark.createDataFrame([(1, 1, "A", Decimal("1.00"), t, t), (2, 1, "A", Decimal("1.00"), t, t),
                                    (3, 1, None, Decimal("1.00"), t, t)], sch)
    after = spark.createDataFrame([(2, 1, "B", Decimal("1.00"), t, t), (3, 1, None, Decimal("1.00"), t, t),
                                   (4, 1, "N", Decimal("4.00"), t, t)], sch)
    feed = change_feed(before, after, ORDERS, source_ts_ms=F.lit(7))
    got = sorted((r.op, (r.after or r.before).order_id) for r in feed.collect())
    assert got == [("c", 4), ("d", 1), ("u", 2)]  # null-safe: key 3 unchanged emits nothing
    flat = rows_of(flatten_feed(feed, ORDERS), "op", "order_id", "status")
    assert flat == [("c", 4, "N"), ("d", 1, "A"), ("u", 2, "B")]


def test_snapshot_feed(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 1, "A", Decimal("1.00"), t, t)], ORDERS.payload_schema)
    r = snapshot_feed(df, ORDERS, source_ts_ms=F.lit(0)).collect()[0]
    assert (r.op, r.before, r.after.order_id, r.source_ts_ms) == ("r", None, 1, 0)
