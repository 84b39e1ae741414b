from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import order_bronze, rows_of
from tidemark.entities import ORDERS
from tidemark.operators.state import apply_changes, keyed_state, latest_per_key, merge_upsert, rank_latest, silver


def live(spark, events, **kw):
    return rows_of(silver(order_bronze(spark, events), ORDERS, **kw), "order_id", "status", "amount", "bronze_op")


# --- the twelve change scenarios, each run alone -------------------------------
def test_s1_insert_one(spark):
    assert live(spark, [("c", 1, "CREATED", 10, 1, 1)]) == [(1, "CREATED", Decimal("10.00"), "c")]


def test_s2_insert_three(spark):
    assert [r[0] for r in live(spark, [("c", i, "CREATED", 10, i, i) for i in (1, 2, 3)])] == [1, 2, 3]


def test_s3_update_status(spark):
    assert live(spark, [("c", 1, "CREATED", 10, 1, 1), ("u", 1, "PAID", 10, 2, 2)])[0][1] == "PAID"


def test_s4_amount_times_1_1(spark):
    got = live(spark, [("c", 1, "CREATED", 19.99, 1, 1), ("u", 1, "CREATED", 21.99, 2, 2)])
    assert got[0][2] == Decimal("21.99")


def test_s5_bulk_update(spark):
    ev = [("c", i, "CREATED", 1, i, i) for i in range(1, 5)] + [("u", i, "PROCESSING", 1, 10 + i, 10 + i) for i in range(1, 5)]
    assert {r[1] for r in live(spark, ev)} == {"PROCESSING"}


def test_s6_delete_one(spark):
    assert live(spark, [("c", 1, "CREATED", 1, 1, 1), ("d", 1, "CREATED", 1, 2, 2)]) == []


def test_s7_delete_by_predicate(spark):
    ev = [("c", i, "CREATED" if i % 2 else "CANCELLED", 1, i, i) for i in range(1, 7)]
    ev += [("d", i, "CANCELLED", 1, 100 + i, 100 + i) for i in range(2, 7, 2)]
    assert [r[0] for r in live(spark, ev)] == [1, 3, 5]


def test_s8_reinsert_after_delete(spark):
    ev = [("c", 1, "CREATED", 10, 1, 1), ("d", 1, "CREATED", 10, 2, 2), ("c", 1, "CREATED", 55.55, 3, 3)]
    assert live(spark, ev) == [(1, "CREATED", Decimal("55.55"), "c")]


def test_s9_insert_paid_shipped(spark):
    ev = [("c", 1, "CREATED", 1, 1, 1), ("u", 1, "PAID", 1, 2, 2), ("u", 1, "SHIPPED", 1, 3, 3)]
    assert live(spark, ev)[0][1] == "SHIPPED"


def test_s10_same_transaction_needs_tie_breaker(spark):
    # insert + update committed together: equal commit and broker time; the
    # offset column breaks the tie
    b = order_bronze(spark, [("c", 1, "CREATED", 1, 5, 5), ("u", 1, "PAID", 1, 5, 5)])
    b = b.withColumn("lsn", F.when(F.col("op") == "c", 1).otherwise(2))
    s = silver(b.drop("raw_json"), ORDERS, tie_breaker=("lsn",))
    assert rows_of(s, "status") == [("PAID",)]


def test_s11_noop_update(spark):
    ev = [("c", 1, "CREATED", 1, 1, 1), ("u", 1, "CREATED", 1, 2, 2)]
    assert live(spark, ev)[0][1] == "CREATED"


def test_s12_volume_insert(spark):
    assert len(live(spark, [("c", i, "CREATED", 1, i, i) for i in range(4000, 4011)])) == 11


# --- traps ---------------------------------------------------------------------
def test_x1_rank_before_delete_filter(spark):
    # filtering deletes first would resurrect the older insert
    assert live(spark, [("c", 1, "CREATED", 1, 1, 1), ("d", 1, "CREATED", 1, 2, 2)]) == []


def test_x2_null_op_latest_vanishes(spark):
    assert live(spark, [("c", 1, "CREATED", 1, 1, 1), (None, 1, "X", 1, 2, 2)]) == []


def test_x3_null_order_values_lose(spark):
    ev = [("c", 1, "NEW", 1, 5, 5), ("u", 1, "NULLTS", 1, None, 9)]
    assert live(spark, ev)[0][1] == "NEW"
    # kafka time decides when commit time ties
    ev = [("c", 1, "A", 1, 5, 1), ("u", 1, "B", 1, 5, 2)]
    assert live(spark, ev)[0][1] == "B"


def test_all_null_order_row_kept(spark):
    assert live(spark, [("c", 1, "ONLY", 1, None, None)])[0][1] == "ONLY"


def test_late_older_update_ignored_and_late_update_after_delete(spark):
    ev = [("c", 1, "CREATED", 1, 1, 1), ("u", 1, "PAID", 1, 3, 3), ("u", 1, "LATE", 1, 2, 9)]
    assert live(spark, ev)[0][1] == "PAID"
    ev = [("c", 2, "CREATED", 1, 1, 1), ("d", 2, "CREATED", 1, 5, 5), ("u", 2, "LATE", 1, 3, 9)]
    assert live(spark, ev) == []


def test_duplicate_delivery_and_null_key(spark):
    e = [("c", 1, "CREATED", 1, 1, 1), ("u", 1, "PAID", 1, 2, 2)]
    assert live(spark, e + e) == live(spark, e)
    assert live(spark, [("c", None, "CREATED", 1, 1, 1)]) == []


def test_tombstones_kept_in_state(spark):
    st = keyed_state(order_bronze(spark, [("c", 1, "A", 1, 1, 1), ("d", 1, "A", 1, 2, 2)]), ORDERS)
    assert rows_of(st, "order_id", "op") == [(1, "d")]


def test_window_and_reduce_agree(spark):
    ev = [("c", k, f"S{i}", i, i * 7 % 11, i) for k in range(5) for i in range(6)]
    b = order_bronze(spark, ev).drop("raw_json")
    a = rows_of(latest_per_key(b, "order_id"), "order_id", "status")
    w = rows_of(rank_latest(b, "order_id"), "order_id", "status")
    assert a == w


def test_latest_plan_combines_before_shuffle(spark):
    b = order_bronze(spark, [("c", 1, "A", 1, 1, 1)]).drop("raw_json")
    plan = latest_per_key(b, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


# --- upsert / apply changes ----------------------------------------------------
def test_merge_upsert_keeps_untouched_columns(spark):
    sch = "order_id long, status string, amount decimal(12,2), created_at timestamp, updated_at timestamp"
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = spark.createDataFrame([(1, "CREATED", Decimal("1.00"), t0, t0), (2, "CREATED", Decimal("2.00"), t0, t0)], sch)
    updates = spark.createDataFrame([(2, "PAID", Decimal("2.20"), None, None), (3, "NEW", Decimal("3.00"), t1, t1)], sch)
    out = merge_upsert(target, updates, "order_id", ["status", "amount"], touch_value=F.lit(t1))
    got = {r.order_id: r for r in out.collect()}
    assert (got[1].status, got[1].updated_at) == ("CREATED", t0)
    assert (got[2].status, got[2].amount, got[2].created_at, got[2].updated_at) == ("PAID", Decimal("2.20"), t0, t1)
    assert (got[3].status, got[3].created_at) == ("NEW", t1)


def test_apply_changes(spark):
    import datetime as dt
    base = spark.createDataFrame(
        [(i, 1001, "BASE", Decimal("1.00"), dt.datetime(2024, 1, 1), None) for i in (1, 2, 3)],
        ORDERS.payload_schema)
    ch = order_bronze(spark, [("u", 1, "PAID", 5, 1, 1), ("d", 2, "BASE", 1, 1, 1), ("c", 4, "NEW", 1, 1, 1)])
    assert rows_of(apply_changes(base, ch, ORDERS), "order_id", "status") == [(1, "PAID"), (3, "BASE"), (4, "NEW")]


def test_volume_generator_through_feed(spark):
    from tidemark.operators.feed import snapshot_feed
    from tidemark.sources.generate import volume_orders
    rows = volume_orders(spark, 4000, 4010, 1001)
    assert rows.count() == 11 and rows.where("amount < 0 OR amount >= 100").count() == 0
    assert sorted(r.amount for r in rows.collect()) == sorted(r.amount for r in volume_orders(spark, 4000, 4010, 1001).collect())
    assert snapshot_feed(rows, ORDERS).where("op = 'r'").count() == 11


def test_fanout_left_join_equals_left_join(spark):
    from tidemark.operators.joins import fanout_left_join
    left = spark.createDataFrame([(k, f"o{k}") for k in range(5)], "k long, a string")
    # key 1 is hot: a third of the right rows
    right = spark.createDataFrame([(1, i) for i in range(10)] + [(k, 0) for k in (2, 3, None)] + [(7, 1)] * 17,
                                  "k long, b long")
    got = sorted(map(tuple, fanout_left_join(left, right, "k").collect()), key=str)
    want = sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    assert got == want


def test_daily_dates_in_utc_whatever_the_session_zone(spark):
    from tidemark.plans.queries import gold_daily_revenue
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = gold_daily_revenue(spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
