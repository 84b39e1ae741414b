import datetime as dt
from decimal import Decimal

from tidemark.entities import CUSTOMERS, ORDERS, PAYMENTS, TRANSACTIONS
from tidemark.operators import marts, quality

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
D = Decimal


def silver_df(spark, spec, rows, op="c", src=1):
    sch = spec.payload_schema.simpleString()[len("struct<"):-1]
    full = [(*r, op, src + i, T0 + dt.timedelta(seconds=i)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, f"{sch},bronze_op string,bronze_source_ts_ms long,bronze_kafka_event_ts timestamp")


def sample(spark):
    c = silver_df(spark, CUSTOMERS, [(1001, "Alice Smith", "alice@example.com", "US", T0, T0),
                                     (1002, "Bob Chen", "bob@example.com", "CA", T0, T0)])
    o = silver_df(spark, ORDERS, [(2001, 1001, "CREATED", D("120.50"), T0, T0), (2002, 1002, "SHIPPED", D("80.00"), T0, T0)])
    p = silver_df(spark, PAYMENTS, [(3001, 2001, 1001, "CARD", "PAID", D("120.50"), T0, T0),
                                    (3002, 2002, 1002, "WALLET", "PENDING", D("80.00"), T0, T0)])
    t = silver_df(spark, TRANSACTIONS, [(4001, 3001, 2001, 1001, "CAPTURE", "SUCCESS", D("120.50"), T0, T0),
                                        (4002, 3002, 2002, 1002, "AUTH", "PENDING", D("80.00"), T0, T0)])
    return c, o, p, t


def test_sample_marts(spark):
    c, o, p, t = sample(spark)
    cos = sorted(tuple(r) for r in marts.customer_order_summary(c, o, p).collect())
    assert cos == [(1001, "Alice Smith", "alice@example.com", "US", 1, D("120.50"), T0),
                   (1002, "Bob Chen", "bob@example.com", "CA", 1, D("0.00"), T0)]
    ops = sorted(tuple(r) for r in marts.order_payment_status(o, p, t).collect())
    assert ops == [(2001, 1001, "CREATED", D("120.50"), "PAID", "SUCCESS", T0),
                   (2002, 1002, "SHIPPED", D("80.00"), "PENDING", "PENDING", T0)]
    dr = [tuple(r) for r in marts.daily_revenue(o, p, t).collect()]
    assert dr == [(dt.date(2024, 1, 1), 2, 2, 1, D("120.50"))]
    schema = {f.name: f.dataType.simpleString() for f in marts.customer_order_summary(c, o, p).schema.fields}
    assert schema["total_paid_amount"] == "decimal(22,2)" and schema["total_orders"] == "bigint"


def test_customer_without_orders_and_payment_fanout(spark):
    c, o, p, t = sample(spark)
    c3 = c.unionByName(silver_df(spark, CUSTOMERS, [(1003, "Cy", "c@x", "DE", T0, T0)]))
    p2 = p.unionByName(silver_df(spark, PAYMENTS, [(3003, 2001, 1001, "CARD", "PAID", D("1.00"), T0, T0),
                                                   (3004, 9999, 1001, "CARD", "PAID", D("5.00"), T0, T0)]))
    got = {r.customer_id: r for r in marts.customer_order_summary(c3, o, p2).collect()}
    assert (got[1003].total_orders, got[1003].total_paid_amount, got[1003].latest_order_ts) == (0, D("0.00"), None)
    # two payments on order 2001: counted once as an order, both amounts summed;
    # payment of an order missing from Silver (9999) is not in the summary
    assert (got[1001].total_orders, got[1001].total_paid_amount) == (1, D("121.50"))
    ops = marts.order_payment_status(o, p2, t)
    assert ops.where("order_id = 2001").count() == 2  # fan-out kept in parity mode
    keys = {(r.test_name): r.failures for r in quality.key_tests({"ops": (ops, "order_id")}).collect()}
    assert keys == {"not_null": 0, "unique": 1}
    latest = marts.order_payment_status(o, p2, t, latest_payment_only=True)
    assert latest.count() == 2
    # the payment of a missing order still counts in the daily totals
    dr = marts.daily_revenue(o, p2, t).collect()[0]
    assert dr.total_payments == 4


def test_null_created_at_rows_do_not_match(spark):
    c, o, p, t = sample(spark)
    o2 = o.unionByName(silver_df(spark, ORDERS, [(2003, 1001, "CREATED", D("1.00"), None, None)]))
    p2 = p.unionByName(silver_df(spark, PAYMENTS, [(3005, 2003, 1001, "CARD", "PAID", D("1.00"), None, None)]))
    rows = marts.daily_revenue(o2, p2, t).collect()
    nulls = [r for r in rows if r.revenue_date is None]
    assert len(nulls) == 2  # one per side; a null day never joins
    k = {r.test_name: r.failures for r in quality.key_tests({"dr": (marts.daily_revenue(o2, p2, t), "revenue_date")}).collect()}
    assert k["not_null"] == 2


def test_latest_transaction_ranked(spark):
    c, o, p, t = sample(spark)
    later = silver_df(spark, TRANSACTIONS, [(4003, 3001, 2001, 1001, "REFUND", "FAILED", D("1.00"), T0, T0)], src=50)
    r = {x.order_id: x for x in marts.order_payment_status(o, p, t.unionByName(later)).collect()}
    assert r[2001].latest_transaction_status == "FAILED"
