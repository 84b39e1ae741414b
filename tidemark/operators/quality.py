"""Data-quality operators.  Each returns a DataFrame: failing rows, labelled check
rows, or counts.  Nothing is collected; callers decide whether to assert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _as_rows(one: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """The columns of a one-row result as (name, value) rows, from a single evaluation."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return one.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is null (empty = pass)."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once, with their count (empty = pass).
    Null is not a value here, as in a SQL unique test."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def key_tests(models: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """not_null + unique on each model's key -> (model_name, column_name, test_name, failures).

    Both tests come from one grouped pass per model (counts per key, combined on
    the map side): failures are the rows with a null key and the values seen twice.
    """
    rows = []
    for name, (df, col) in models.items():
        null = F.col(col).isNull()
        both = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum(F.when(null, F.col("_n"))), F.lit(0)).cast("long").alias("not_null"),
            F.count(F.when(~null & (F.col("_n") > 1), F.lit(1))).cast("long").alias("unique"),
        )
        rows.append(_as_rows(both, ("not_null", "unique"), "test_name", "failures").select(
            F.lit(name).alias("model_name"), F.lit(col).alias("column_name"), "test_name", "failures"))
    return _union(rows)


def pk_violations(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One labelled row per failing check (``<table>_null_pk``, ``<table>_duplicate_pk``);
    an empty result is a pass.

    Both checks come from one grouped pass per table (counts per key, combined on
    the map side, then two flags), so each table is scanned once.  As in
    ``GROUP BY key HAVING count(*) > 1``, several null keys also count as a
    duplicate.
    """
    checks = []
    for name, (df, key) in tables.items():
        flags = (
            df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.max(F.col(key).isNull()).alias("_has_null"), F.max(F.col("_n") > 1).alias("_has_dup"))
        )
        labels = F.array(
            F.when(F.col("_has_null"), F.lit(f"{name}_null_pk")),
            F.when(F.col("_has_dup"), F.lit(f"{name}_duplicate_pk")),
        )
        checks.append(flags.select(F.explode(labels).alias("test_name")).where(F.col("test_name").isNotNull()))
    return _union(checks)


def pk_violations_by_exists(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``pk_violations`` as EXISTS subqueries over named tables (name -> key).

    Spark runs an EXISTS that stands alone as a subquery limited to one row.  The null check reads
    partitions only until it meets a null key; the duplicate check counts keys on the map side and
    exchanges the counts, but merges partitions only until one holds a repeated key."""
    checks = []
    for name, key in tables.items():
        label = name.rsplit(".", 1)[-1]
        checks.append(f"SELECT '{label}_null_pk' AS test_name WHERE EXISTS (SELECT 1 FROM {name} WHERE {key} IS NULL)")
        checks.append(f"SELECT '{label}_duplicate_pk' AS test_name WHERE EXISTS (SELECT {key} FROM {name} GROUP BY {key} HAVING count(*) > 1)")
    return spark.sql("\nUNION ALL\n".join(checks))


def order_descents(events: DataFrame, key: str, order_col: str = "source_ts_ms", arrival_col: str = "kafka_event_ts") -> DataFrame:
    """Keys whose events did not arrive in commit order -> (key, events, descents).

    A descent is an event that arrives right behind one committed later; a key is in order
    exactly if it has none.  Events are sorted by range of (key, arrival) over all tasks, so
    a key that holds a third of the rows spans many tasks.  Each piece of a key counts its own
    descents and keeps its first and last commit; pieces are merged in order, a few numbers
    each.  Events with a null key, commit or arrival have no place and are left out; of
    events that arrive at the same time the earlier committed comes first."""
    order = (key, arrival_col, order_col)
    rows = events.select(*order).where(F.col(key).isNotNull() & F.col(order_col).isNotNull() & F.col(arrival_col).isNotNull())
    pieces = rows.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    before = F.lag(order_col).over(Window.partitionBy(key, "_piece").orderBy(arrival_col, order_col))
    merged = (
        pieces.withColumn("_down", before > F.col(order_col))
        .groupBy(key, "_piece").agg(
            F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_down"), F.lit(1))).alias("_down"),
            F.min_by(order_col, F.struct(arrival_col, order_col)).alias("_first"), F.max_by(order_col, F.struct(arrival_col, order_col)).alias("_last"))
        .withColumn("_seam", F.lag("_last").over(Window.partitionBy(key).orderBy("_piece")) > F.col("_first"))
    )
    return (merged.groupBy(key).agg(F.sum("_n").alias("events"), (F.sum("_down") + F.count(F.when(F.col("_seam"), F.lit(1)))).alias("descents"))
            .where(F.col("descents") > 0))


def order_kept(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Change-log check "order kept per key" -> (table_name, keys_out_of_order, descents), a row per table."""
    return _union([
        order_descents(df, key).agg(F.count(F.lit(1)).alias("keys_out_of_order"), F.coalesce(F.sum("descents"), F.lit(0)).cast("long").alias("descents"))
        .select(F.lit(name).alias("table_name"), "keys_out_of_order", "descents") for name, (df, key) in tables.items()])


def duplicate_key_counts(tables: Mapping[str, tuple[DataFrame, str]], suffix: str = "_pk_duplicates") -> DataFrame:
    """Number of keys seen more than once, per table -> (check_name, cnt)."""
    rows = []
    for name, (df, key) in tables.items():
        dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        rows.append(dup.agg(F.count(F.lit(1)).cast("long").alias("cnt")).select(
            F.lit(f"{name}{suffix}").alias("check_name"), "cnt"))
    return _union(rows)


def delete_ops_present(tables: Mapping[str, DataFrame], op_col: str = "bronze_op") -> DataFrame:
    """Rows carrying a delete op (must be 0 in Silver) -> (check_name, cnt)."""
    return _union([
        df.where(F.col(op_col) == "d").agg(F.count(F.lit(1)).cast("long").alias("cnt"))
        .select(F.lit(f"{name}_delete_ops_present").alias("check_name"), "cnt")
        for name, df in tables.items()
    ])


def bronze_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per Bronze table, one pass: rows, rows with null ``raw_json``, rows with a
    null op."""
    return _union([
        df.agg(
            F.count(F.lit(1)).cast("long").alias("cnt"),
            F.count(F.when(F.col("raw_json").isNull(), F.lit(1))).cast("long").alias("raw_json_nulls"),
            F.count(F.when(F.col("op").isNull(), F.lit(1))).cast("long").alias("null_ops"),
        ).select(F.lit(name).alias("table_name"), "cnt", "raw_json_nulls", "null_ops")
        for name, df in tables.items()
    ])


def cast_error_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per Bronze table decoded with ``track_cast_errors``: rows, rows with a cast
    error and the number of failed fields -> (table_name, cnt, rows_with_errors, cast_errors)."""
    return _union([
        df.agg(
            F.count(F.lit(1)).cast("long").alias("cnt"),
            F.count(F.when(F.col("cast_errors") > 0, F.lit(1))).cast("long").alias("rows_with_errors"),
            F.coalesce(F.sum("cast_errors"), F.lit(0)).cast("long").alias("cast_errors"),
        ).select(F.lit(name).alias("table_name"), "cnt", "rows_with_errors", "cast_errors")
        for name, df in tables.items()
    ])


def table_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Row count per table -> (<label>, cnt)."""
    return _union([
        df.agg(F.count(F.lit(1)).cast("long").alias("cnt")).select(F.lit(name).alias(label), "cnt")
        for name, df in tables.items()
    ])


def table_health(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per file-backed table: number of data files and rows; healthy = both > 0.

    Uses the hidden ``_metadata.file_path`` column of file sources, so it only
    reads file paths, not data columns.
    """
    rows = []
    for name, df in tables.items():
        rows.append(
            df.select(F.col("_metadata.file_path").alias("_f"))
            .agg(F.count_distinct("_f").cast("long").alias("data_files"),
                 F.count(F.lit(1)).cast("long").alias("row_count"))
            .select(F.lit(name).alias("table_name"), "data_files", "row_count",
                    ((F.col("data_files") > 0) & (F.col("row_count") > 0)).alias("healthy"))
        )
    return _union(rows)


ALLOWED_OPS = ("c", "u", "d", "r")


def validate_change_log(bronze: DataFrame, key: str, allowed_ops: Sequence[str] = ALLOWED_OPS,
                        order_col: str = "source_ts_ms", arrival_col: str = "kafka_event_ts") -> DataFrame:
    """Change-log checklist -> (check_name, violations):

    * ``unexpected_op``   - rows whose op is null or not an allowed value;
    * ``duplicate_event`` - extra copies of the same (key, op, commit, arrival) event;
    * ``out_of_order``    - keys whose newest event (by commit order) is not the
      last to arrive, i.e. an older change arrived after it;
    * ``delete_without_before`` - deletes whose key could not be read from ``before``.

    Every check is a grouped or global aggregate (partial on the map side).
    """
    # One scan: copies per distinct event (combined on the map side).  Every check
    # is derived from these rows, so the Bronze table is read once.
    events = bronze.groupBy(key, "op", order_col, arrival_col).agg(F.count(F.lit(1)).alias("_copies"))
    bad_op = ~F.coalesce(F.col("op").isin(*allowed_ops), F.lit(False))
    totals = events.agg(
        F.coalesce(F.sum(F.when(bad_op, F.col("_copies"))), F.lit(0)).cast("long").alias("unexpected_op"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicate_event"),
        F.coalesce(F.sum(F.when((F.col("op") == "d") & F.col(key).isNull(), F.col("_copies"))), F.lit(0))
        .cast("long").alias("delete_without_before"),
    )
    # out-of-order arrival per key: the event with the newest commit time did not
    # arrive last
    # (null keys are excluded in the count, not by a filter, so this branch
    # shares the per-event exchange with the totals instead of scanning again)
    # one row per commit first: then max_by has no ties to break and compares plain numbers, which Spark
    # aggregates by hash; a maximum of structs would sort the whole log before and behind the exchange
    per_commit = events.groupBy(key, order_col).agg(F.max(arrival_col).alias("_arrival"), F.sum("_copies").alias("_copies"))
    per_key = per_commit.groupBy(key).agg(
        F.max(order_col).alias("_newest"),
        F.max_by("_arrival", order_col).alias("_arr_of_newest"),
        F.max(F.when(F.col(order_col).isNull(), F.col("_arrival"))).alias("_arr_of_null"),  # null is older than any commit
        F.max("_arrival").alias("_last_arrival"),
        F.sum("_copies").alias("_events"),
    ).withColumn("_arr_of_newest", F.when(F.col("_newest").isNull(), F.col("_arr_of_null")).otherwise(F.col("_arr_of_newest")))
    # a key with a single event cannot be out of order
    late = F.col(key).isNotNull() & (F.col("_events") > 1) & (F.col("_arr_of_newest") < F.col("_last_arrival"))
    ooo = per_key.agg(F.count(F.when(late, F.lit(1))).cast("long").alias("v"))
    return _union([
        _as_rows(totals, ("unexpected_op", "duplicate_event", "delete_without_before"), "check_name", "violations"),
        ooo.select(F.lit("out_of_order").alias("check_name"), F.col("v").alias("violations")),
    ])
