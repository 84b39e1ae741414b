"""Gold marts, rebuilt in full from Silver.

Each mart aggregates before it joins wherever the result allows, so the joins see
at most one row per key and a hot customer / order never lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.entities import SUM_AMOUNT_TYPE
from tidemark.operators.joins import fanout_left_join


def _zero():
    return F.lit(0).cast(SUM_AMOUNT_TYPE)


def customer_order_summary(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Per customer: distinct orders, paid amount over the orders' payments, latest order time.

    Same result as ``customers LEFT JOIN orders LEFT JOIN payments GROUP BY customer``:
    payments are summed per order first (Silver orders are unique per ``order_id``,
    so ``count(distinct order_id)`` is the count of a customer's orders), then per
    customer, then joined 1:1 to customers.  Payments whose order is absent from
    Silver drop out, as in the join chain.
    """
    paid_per_order = payments.groupBy("order_id").agg(
        F.sum(F.when(F.col("payment_status") == "PAID", F.col("amount")).otherwise(F.lit(0))).alias("_paid")
    )
    per_customer = (
        orders.select("order_id", "customer_id", "created_at")
        .join(paid_per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(F.coalesce(F.col("_paid"), F.lit(0))).alias("_paid"),
            F.max("created_at").alias("latest_order_ts"),
        )
    )
    c = customers.select("customer_id", "full_name", "email", "country")
    return (
        c.join(per_customer, "customer_id", "left")
        .select(
            "customer_id", "full_name", "email", "country",
            F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
            F.coalesce(F.col("_paid"), _zero()).cast(SUM_AMOUNT_TYPE).alias("total_paid_amount"),
            "latest_order_ts",
        )
    )


def _newest_per_order(df: DataFrame, value_col: str, alias: str, tie_breaker: str | None) -> DataFrame:
    """``row_number() = 1`` per order by Silver lineage time, newest first.
    Spark plans a partial WindowGroupLimit before the shuffle, so an order with
    very many rows sends one row per task."""
    order = [F.col("bronze_source_ts_ms").desc_nulls_last(), F.col("bronze_kafka_event_ts").desc_nulls_last()]
    if tie_breaker:
        order.append(F.col(tie_breaker).desc_nulls_last())
    w = Window.partitionBy("order_id").orderBy(*order)
    cols = ["order_id", value_col, "bronze_source_ts_ms", "bronze_kafka_event_ts", *([tie_breaker] if tie_breaker else [])]
    return (
        df.select(*cols)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("order_id", F.col(value_col).alias(alias))
    )


def latest_transaction_per_order(transactions: DataFrame, tie_breaker: str | None = "transaction_id") -> DataFrame:
    """Newest Silver transaction status per order (many transactions per order)."""
    return _newest_per_order(transactions, "txn_status", "latest_transaction_status", tie_breaker)


def latest_payment_per_order(payments: DataFrame, tie_breaker: str | None = "payment_id") -> DataFrame:
    """Newest Silver payment status per order."""
    return _newest_per_order(payments, "payment_status", "payment_status", tie_breaker)


def order_payment_status(
    orders: DataFrame,
    payments: DataFrame,
    transactions: DataFrame,
    latest_payment_only: bool = False,
    co_located: bool = False,
) -> DataFrame:
    """One row per (order, payment): order fields, that payment's status and the
    order's newest transaction status.

    Parity mode keeps every payment of an order (fan-out; the reference ranks
    transactions but not payments).  ``latest_payment_only=True`` ranks payments
    too, giving one row per order.

    The newest transaction is joined first, 1:1, and the payments last: behind the
    fan-out nothing is exchanged by order again.  That first join is keyed by the order's
    hash beside its id, so Spark exchanges its result before the fan-out: AQE splits a
    skewed join only between two exchanges.  ``co_located=True`` is for tables bucketed
    by order_id: every join then runs bucket by bucket without an exchange.
    """
    o = orders.select(
        "order_id", "customer_id",
        F.col("status").alias("order_status"),
        F.col("amount").alias("order_amount"),
        F.col("created_at").alias("order_created_at"),
    )
    txn = latest_transaction_per_order(transactions)
    if co_located:
        o = o.join(txn, "order_id", "left")
    else:
        keyed = lambda df: df.withColumn("_h", F.xxhash64("order_id"))
        o = keyed(o).join(keyed(txn), ["_h", "order_id"], "left").drop("_h")
    pay = (latest_payment_per_order(payments) if latest_payment_only else payments.select("order_id", "payment_status"))
    pay = pay.where(F.col("order_id").isNotNull()).select("order_id", F.col("payment_status").alias("latest_payment_status"))
    joined = o.join(pay, "order_id", "left") if latest_payment_only else fanout_left_join(o, pay, "order_id")
    return joined.select(
        "order_id", "customer_id", "order_status", "order_amount",
        "latest_payment_status", "latest_transaction_status", "order_created_at",
    )


def daily_revenue(orders: DataFrame, payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per UTC day of ``created_at``: orders, payments, successful transactions and
    their amount.  Each side is aggregated to one row per day first, then the three
    day tables are full-outer joined (plain ``=``, so a null day never matches and
    can appear once per side)."""
    day = F.to_date(F.col("created_at"))
    od = orders.groupBy(day.alias("revenue_date")).agg(F.count(F.lit(1)).alias("total_orders"))
    pd_ = payments.groupBy(day.alias("revenue_date")).agg(F.count(F.lit(1)).alias("total_payments"))
    ok = F.col("txn_status") == "SUCCESS"
    td = transactions.groupBy(day.alias("revenue_date")).agg(
        F.count(F.when(ok, F.lit(1))).alias("total_successful_transactions"),
        F.coalesce(F.sum(F.when(ok, F.col("amount")).otherwise(F.lit(0))), _zero()).alias("gross_revenue"),
    )
    o, p, t = od.alias("o"), pd_.alias("p"), td.alias("t")
    op_ = o.join(p, F.col("o.revenue_date") == F.col("p.revenue_date"), "full_outer")
    opt = op_.join(t, F.coalesce(F.col("o.revenue_date"), F.col("p.revenue_date")) == F.col("t.revenue_date"), "full_outer")
    return opt.select(
        F.coalesce(F.col("o.revenue_date"), F.col("p.revenue_date"), F.col("t.revenue_date")).alias("revenue_date"),
        F.coalesce(F.col("o.total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("p.total_payments"), F.lit(0)).cast("long").alias("total_payments"),
        F.coalesce(F.col("t.total_successful_transactions"), F.lit(0)).cast("long").alias("total_successful_transactions"),
        F.coalesce(F.col("t.gross_revenue"), _zero()).cast(SUM_AMOUNT_TYPE).alias("gross_revenue"),
    )


def all_marts(silvers: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every mart over the Silver tables ``customers``, ``orders``, ``payments`` and ``transactions``."""
    c, o, p, t = (silvers[e] for e in ("customers", "orders", "payments", "transactions"))
    return {
        "customer_order_summary_gold": customer_order_summary(c, o, p),
        "order_payment_status_gold": order_payment_status(o, p, t),
        "daily_revenue_gold": daily_revenue(o, p, t),
    }
