"""Batch medallion plan: topics -> Bronze -> Silver -> Gold, as DataFrames.

Bronze is written once per entity, when first asked for, and read back: each message
is parsed once, however many later plans use it.  ``silver`` is a lazily built DataFrame
over it; ``staged_silver`` is written once, so the log is reduced once and its shuffle is
freed before the next entity's.  Gold reads the staged Silver.  ``materialize`` writes a layer
out and reads it back, cutting lineage the way a table boundary does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.entities import ENTITIES
from tidemark.functions.envelope import decode_envelope
from tidemark.operators import marts
from tidemark.operators.state import silver
from tidemark.session import scratch_path, stage


@dataclass
class Medallion:
    spark: SparkSession
    topics: dict[str, DataFrame]
    tie_breakers: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # (entity, Bronze rows) -> the written table; without it Bronze goes to a folder of this run
    write_bronze: Callable[[str, DataFrame], DataFrame] | None = None
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def bronze(self, entity: str) -> DataFrame:
        k = f"bronze.{entity}"
        if k not in self._cache:
            rows = decode_envelope(self.topics[entity], ENTITIES[entity])
            self._cache[k] = self.write_bronze(entity, rows) if self.write_bronze else stage(rows, scratch_path(self.spark, "bronze", entity))
        return self._cache[k]

    def silver(self, entity: str) -> DataFrame:
        k = f"silver.{entity}"
        if k not in self._cache:
            self._cache[k] = silver(self.bronze(entity), ENTITIES[entity], self.tie_breakers.get(entity, ()))
        return self._cache[k]

    def staged_silver(self, entity: str) -> DataFrame:
        k = f"staged_silver.{entity}"
        if k not in self._cache:
            self._cache[k] = stage(self.silver(entity), scratch_path(self.spark, "silver", entity))
        return self._cache[k]

    def _silvers(self, *entities: str) -> list[DataFrame]:
        return [self.staged_silver(e) for e in entities]

    def materialize(self, layer_entity: str, path: str) -> DataFrame:
        """Write a layer once and continue from the written copy."""
        layer, entity = layer_entity.split(".", 1)
        df = self.bronze(entity) if layer == "bronze" else self.silver(entity)
        df.write.mode("overwrite").parquet(path)
        self._cache[layer_entity] = self.spark.read.parquet(path)
        return self._cache[layer_entity]

    def customer_order_summary(self) -> DataFrame:
        return marts.customer_order_summary(*self._silvers("customers", "orders", "payments"))

    def order_payment_status(self, latest_payment_only: bool = False) -> DataFrame:
        return marts.order_payment_status(*self._silvers("orders", "payments", "transactions"), latest_payment_only)

    def daily_revenue(self) -> DataFrame:
        return marts.daily_revenue(*self._silvers("orders", "payments", "transactions"))

    def gold(self) -> dict[str, DataFrame]:
        return marts.all_marts({e: self.staged_silver(e) for e in ("customers", "orders", "payments", "transactions")})


GOLD_KEYS = {
    "customer_order_summary_gold": "customer_id",
    "order_payment_status_gold": "order_id",
    "daily_revenue_gold": "revenue_date",
}


def build_gold(
    spark: SparkSession,
    silvers: dict[str, DataFrame],
    path_root: str,
    database: str | None = None,
) -> DataFrame:
    """Build step for the marts: each mart is rebuilt in full (overwrite) from the
    Silver tables, then its key is tested (not null, unique) on the written copy.

    ``silvers`` maps ``customers / orders / payments / transactions`` to Silver
    DataFrames.  Marts go to ``<path_root>/<mart>`` and, with ``database``, are
    registered as ``<database>.<mart>``.  Returns the key-test rows
    (model_name, column_name, test_name, failures); all failures 0 = pass.
    """
    from tidemark.operators import quality
    from tidemark.plans.catalog import write_full_refresh

    written = {}
    for name, df in marts.all_marts(silvers).items():
        path = f"{path_root.rstrip('/')}/{name}"
        if database:
            write_full_refresh(df, f"{database}.{name}", path=path)
            written[name] = spark.table(f"{database}.{name}")
        else:
            df.write.mode("overwrite").parquet(path)
            written[name] = spark.read.parquet(path)
    return quality.key_tests({name: (written[name], GOLD_KEYS[name]) for name in written})
