"""Row generator for volume tests: a range of new orders with random amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import AMOUNT_TYPE


def volume_orders(spark: SparkSession, start: int, end_inclusive: int, customer_id: int, seed: int = 7,
                  status: str = "CREATED") -> DataFrame:
    """``generate_series(start, end)`` as orders rows, amount ``random() * 100``
    (seeded, so reruns give the same rows), created/updated now."""
    now = F.current_timestamp()
    return spark.range(start, end_inclusive + 1).select(
        F.col("id").alias("order_id"),
        F.lit(customer_id).cast("long").alias("customer_id"),
        F.lit(status).alias("status"),
        (F.rand(seed) * 100).cast(AMOUNT_TYPE).alias("amount"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
