"""Layer catalog: databases, table DDL, views over each layer, ad-hoc SQL and
full-refresh writes.  Plain Spark catalog calls; no engine of its own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.entities import ENTITIES, LINEAGE_RENAMES, ORDER_COLUMNS, EntitySpec
from tidemark.session import CODEC, shuffles_freed

LAYERS = ("bronze", "silver", "gold")


def _ddl_type(t: T.DataType) -> str:
    return t.simpleString()


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for bronze / silver / gold."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def create_entity_tables(spark: SparkSession, specs: Mapping[str, EntitySpec] = ENTITIES, prefix: str = "",
                         fmt: str = "parquet", layers: Sequence[str] = ("bronze", "silver"), path: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for each entity's Bronze and Silver table (``path``: one folder per table under it)."""
    place = lambda table: f" LOCATION '{path}/{table}'" if path else ""
    for spec in specs.values():
        bronze_cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}" for f in spec.bronze_schema.fields)
        if "bronze" in layers:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}bronze.{spec.bronze_table} ({bronze_cols}) USING {fmt}{place(spec.bronze_table)}")
        silver_fields = [*spec.columns, ("bronze_op", T.StringType()), ("bronze_source_ts_ms", T.LongType()),
                         ("bronze_kafka_event_ts", T.TimestampType())]
        silver_cols = ", ".join(f"`{n}` {_ddl_type(t)}" for n, t in silver_fields)
        if "silver" in layers:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}silver.{spec.silver_table} ({silver_cols}) USING {fmt}{place(spec.silver_table)}")


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Declared sources: each DataFrame becomes a temp view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def sql(spark: SparkSession, query: str) -> DataFrame:
    """Ad-hoc SQL over whatever views / tables are registered."""
    return spark.sql(query)


def write_full_refresh(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Full-refresh mart write (``materialized: table``)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        w.option("compression", CODEC)
    if path:
        w.option("path", path)
    with shuffles_freed(df.sparkSession):
        w.saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Full-refresh write as a table bucketed and sorted by ``key``; joins and groupings of tables
    bucketed alike need no exchange.  Rows are dealt by the same hash first, so a bucket is one file.

    A hot key stays in one bucket: use it where keys are unique or nearly so, and size ``buckets`` for
    the executors' memory."""
    w = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("compression", CODEC).bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    with shuffles_freed(df.sparkSession):
        w.saveAsTable(table)
    return df.sparkSession.table(table)


def create_silver_views(spark: SparkSession, specs: Mapping[str, EntitySpec] = ENTITIES, prefix: str = "") -> None:
    """Silver as catalog views over the declared Bronze tables: the newest event per key, deletes removed.

    The view is the same ``max_by`` reduce as ``operators.state.silver``, in SQL, so whatever has been
    streamed into Bronze shows by name at once."""
    for spec in specs.values():
        kept = [c for c in spec.bronze_columns if c != "raw_json"]
        newest = f"max_by(named_struct({', '.join(f"'{c}', `{c}`" for c in kept)}), named_struct({', '.join(f"'{c}', `{c}`" for c in ORDER_COLUMNS)}))"
        columns = ", ".join([f"r.`{c}`" for c in spec.column_names] + [f"r.`{a}` AS `{b}`" for a, b in LINEAGE_RENAMES.items()])
        spark.sql(f"""CREATE OR REPLACE VIEW {prefix}silver.{spec.silver_table} AS
            SELECT {columns} FROM (SELECT {newest} AS r FROM {prefix}bronze.{spec.bronze_table}
                                   WHERE `{spec.key}` IS NOT NULL GROUP BY `{spec.key}`) WHERE r.op <> 'd'""")
