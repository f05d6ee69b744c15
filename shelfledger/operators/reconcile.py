"""Two tables compared partition by partition, by checksums that no order of rows changes.

A row's hash is added up over its partition, and so is the hash of each value with the key it
stands at. Sums of parts add up to those of the whole, so one grouped sum per side moves a row
per partition, whatever the number of rows; a partition with most rows combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.operators.facts import KEYS
from shelfledger.operators.joins import same_key

# What may be wrong with a partition.
LOST, ADDED, CHANGED = "rows lost", "rows added", "values changed"


def _sum(*columns: str) -> Column:
    # a NULL changes nothing in Spark's hash, so its place is hashed beside the value
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.sum(F.xxhash64(*parts).cast("decimal(20,0)"))


def checksums(
    df: DataFrame, by: list[str], values: list[str], keys: list[str] | tuple[str, ...] = tuple(KEYS)
) -> DataFrame:
    """Per partition: ``rows``, the sum of row hashes, and one sum per value column."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), _sum(*keys).alias("keys"),
        *(_sum(*keys, v).alias(f"sum_{i}") for i, v in enumerate(values)),
    )


def reconcile(
    expected: DataFrame,
    found: DataFrame,
    by: list[str],
    values: list[str],
    keys: list[str] | tuple[str, ...] = tuple(KEYS),
) -> DataFrame:
    """(by, expected_rows, found_rows, fault, columns) of the partitions that differ.

    ``columns`` are the value columns that differ, comma-joined in the given order, where the
    rows are the same; a key that was replaced by another changes all of them. A partition that
    only one side has lost or added all its rows. Two tables that agree give no rows.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        sums = checksums(df, by, values, keys)
        return sums.select(*by, F.struct(*(c for c in sums.columns if c not in by)).alias(name))

    # a full join on keys that may be NULL, as one grouped union
    one, other = side(expected, "e"), side(found, "f")
    both = one.unionByName(other, allowMissingColumns=True)
    met = both.groupBy(*by).agg(
        F.first("e", ignorenulls=True).alias("e"), F.first("f", ignorenulls=True).alias("f")
    )
    rows = {s: F.coalesce(F.col(f"{s}.rows"), F.lit(0).cast("bigint")) for s in ("e", "f")}
    differing = F.array_compact(F.array(*(
        F.when(~F.col(f"e.sum_{i}").eqNullSafe(F.col(f"f.sum_{i}")), F.lit(v))
        for i, v in enumerate(values)
    )))
    fault = (
        F.when(rows["e"] > rows["f"], LOST).when(rows["e"] < rows["f"], ADDED)
        .when((F.size(differing) > 0) | ~F.col("e.keys").eqNullSafe(F.col("f.keys")), CHANGED)
    )
    return met.select(
        *by, rows["e"].alias("expected_rows"), rows["f"].alias("found_rows"), fault.alias("fault"),
        F.when(fault == CHANGED, F.array_join(differing, ",")).otherwise("").alias("columns"),
    ).where("fault IS NOT NULL")


def facts_of_snapshot(facts: DataFrame, snapshot: DataFrame, values: list[str]) -> DataFrame:
    """The facts that a wide table over this snapshot must hold: a row per key of the snapshot,
    zero where the key has no fact. Facts without a snapshot row are in no wide table."""
    held = snapshot.select(*KEYS).alias("s").join(
        facts.select(*KEYS, *values).alias("f"), same_key("s", "f", KEYS), "left"
    )
    return held.select(*(F.col(f"s.{k}").alias(k) for k in KEYS), *(
        F.coalesce(F.col(f"f.{v}"), F.lit(0)).alias(v) for v in values
    ))
