"""Join helpers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout_left_join(unique_left: DataFrame, many_right: DataFrame, key: str) -> DataFrame:
    """``unique_left LEFT JOIN many_right USING (key)`` where the left side holds
    at most one row per key and the right side may be heavily skewed.

    A left outer sort-merge join would buffer every right row of a hot key in one
    task, and AQE cannot split the right side of a left outer join.  Written as
    an inner join (AQE may split either side of it) plus the unmatched left rows
    found by an anti join against the *distinct* right keys.  The result is the
    same rows, with the key column first as in ``USING``.
    """
    right_cols = [c for c in many_right.columns if c != key]
    matched = many_right.join(unique_left, key, "inner")
    right_keys = many_right.select(key).where(F.col(key).isNotNull()).distinct()
    unmatched = unique_left.join(right_keys, key, "left_anti").select(
        key,
        *[c for c in unique_left.columns if c != key],
        *[F.lit(None).cast(many_right.schema[c].dataType).alias(c) for c in right_cols],
    )
    cols = [key, *[c for c in unique_left.columns if c != key], *right_cols]
    return matched.select(*cols).unionByName(unmatched.select(*cols))
