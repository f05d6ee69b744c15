"""Left join to an aggregated side, safe against hot and missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skew_safe_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Plain left equi-join on ``keys``, planned so that no single key can fill one task.

    Adaptive execution splits a hot partition of the left side, be it one key or all the rows
    whose key is missing, but only where both join inputs are plain exchanges, which an
    aggregate's output is not. One extra join key, 0 on both sides, makes Spark exchange the
    aggregated side again. It is written over the keys, so no other column is kept alive by it.
    Where the right side is small Spark broadcasts it, by its own size check, and none of
    this costs a shuffle.
    """
    # Not a plain 0, which the optimizer would take out of the join keys.
    zero = F.xxhash64(*keys).bitwiseAND(F.lit(0).cast("bigint"))
    joined = left.withColumn("_zero", zero).join(
        right.withColumn("_zero", zero), [*keys, "_zero"], "left"
    )
    added = [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *added)


def same_key(left: str, right: str, columns: list[str] | tuple[str, ...]) -> Column:
    """Rows of two aliases are equal in the columns, a NULL being equal to a NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition
