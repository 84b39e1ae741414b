"""Latest state per business key (Silver), keyed upsert and batch change application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.entities import LINEAGE_RENAMES, ORDER_COLUMNS, EntitySpec


def _order_struct(order_cols: Sequence[str]) -> Column:
    # Struct comparison ranks a null field below any value: the same as
    # ORDER BY ... DESC NULLS LAST when the maximum is taken.
    return F.struct(*[F.col(c) for c in order_cols])


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_cols: Sequence[str] = ORDER_COLUMNS,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key (tombstones included), by the event-order columns.

    Expressed as a ``max_by`` aggregate rather than a ranked window: the reduce
    is associative, so Spark combines partially on the map side before the
    shuffle, and a key holding a large share of the rows collapses to one row per
    task before it is exchanged.  The same reduce merges micro-batches into state.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    ordering = _order_struct([*order_cols, *tie_breaker])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_latest"))
        .select(*[F.col("_latest").getField(c).alias(c) for c in cols])
    )


def rank_latest(
    df: DataFrame,
    key: str | Sequence[str],
    order_cols: Sequence[str] = ORDER_COLUMNS,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Same result as :func:`latest_per_key`, as ``row_number() = 1`` over a window
    (Spark plans a partial ``WindowGroupLimit`` before the shuffle)."""
    from pyspark.sql import Window

    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order_cols, *tie_breaker)])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def live_rows(state: DataFrame) -> DataFrame:
    """Drop keys whose newest event is a delete.  ``op <> 'd'`` is null for a null
    op, so such keys vanish too, as in the reference layer."""
    return state.where(F.col("op") != F.lit("d"))


def to_silver_columns(spec: EntitySpec, df: DataFrame) -> DataFrame:
    return df.select(
        *spec.column_names,
        *[F.col(src).alias(dst) for src, dst in LINEAGE_RENAMES.items()],
    )


def keyed_state(bronze: DataFrame, spec: EntitySpec, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """Bronze -> one row per non-null key, newest event, tombstones kept."""
    cols = [c for c in bronze.columns if c != "raw_json"]
    return latest_per_key(
        bronze.select(*cols).where(F.col(spec.key).isNotNull()), spec.key, tie_breaker=tie_breaker
    )


def silver(bronze: DataFrame, spec: EntitySpec, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """Silver = rank per key first, *then* drop deletes (filtering deletes first
    would let an older row of a deleted key come back)."""
    return to_silver_columns(spec, live_rows(keyed_state(bronze, spec, tie_breaker)))


def silver_from_state(state: DataFrame, spec: EntitySpec) -> DataFrame:
    return to_silver_columns(spec, live_rows(state))


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    set_cols: Sequence[str],
    touch_col: str | None = "updated_at",
    touch_value: Column | None = None,
) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET set_cols, touch_col = now()``.

    New keys are inserted with all of their columns; existing keys take the listed
    columns from ``updates`` and keep every other column (e.g. ``created_at``).
    One full outer join on the key; ``updates`` must hold one row per key.
    """
    touch = touch_value if touch_value is not None else F.current_timestamp()
    t, u = target.alias("t"), updates.alias("u")
    joined = t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer")
    matched = F.col(f"t.{key}").isNotNull() & F.col(f"u.{key}").isNotNull()
    out = []
    for c in target.columns:
        if c == key:
            expr = F.coalesce(F.col(f"t.{key}"), F.col(f"u.{key}"))
        elif c in set_cols:
            expr = F.when(F.col(f"u.{key}").isNotNull(), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}"))
        elif c == touch_col:
            expr = (
                F.when(matched, touch.cast(target.schema[c].dataType))
                .when(F.col(f"t.{key}").isNull(), F.col(f"u.{c}") if c in updates.columns else F.lit(None))
                .otherwise(F.col(f"t.{c}"))
            )
        else:
            fallback = F.col(f"u.{c}") if c in updates.columns else F.lit(None)
            expr = F.when(F.col(f"t.{key}").isNull(), fallback).otherwise(F.col(f"t.{c}"))
        out.append(expr.cast(target.schema[c].dataType).alias(c))
    return joined.select(*out)


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    spec: EntitySpec,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Batch-apply a change log (Bronze rows) to a base table of current rows.

    The base rows enter as events older than any change (ordering columns null),
    so the newest change per key wins, deletes remove the key, and keys without
    changes pass through.  Returns the current rows with the entity columns.
    """
    cols = [c for c in changes.columns if c != "raw_json"]
    base_ev = base.select(
        *[
            (F.col(c) if c in spec.column_names else F.lit(None)).cast(changes.schema[c].dataType).alias(c)
            if c != "op" else F.lit("r").alias("op")
            for c in cols
        ],
        F.lit(0).alias("_gen"),
    )
    state = latest_per_key(
        base_ev.unionByName(changes.select(*cols, F.lit(1).alias("_gen"))).where(F.col(spec.key).isNotNull()),
        spec.key,
        order_cols=(*ORDER_COLUMNS, "_gen"),
        tie_breaker=tie_breaker,
    )
    return live_rows(state).select(*spec.column_names)
