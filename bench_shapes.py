"""Plan shapes compared: the plain step-by-step plan against the one the library builds.

Writes the raw tables once as eight files each below the shared work folder, then times both
shapes without broadcast joins, and with the bytes they shuffle. Prints one JSON line per pair.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import bench
from entry_queries import queries, views
from shelfledger.functions.measures import derive_measures, fill_zero
from shelfledger.operators import audit, facts, inventory, validate
from shelfledger.operators.conform import conform
from shelfledger.plans.denormalize import denormalize
from shelfledger.sources.workspace import work_dir

KEYS = facts.KEYS


def shuffled_bytes(spark: SparkSession) -> int:
    no_quantiles = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(
        None, False, False, no_quantiles, None
    )
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def run_all(*frames: DataFrame) -> None:
    for df in frames:
        df.write.format("noop").mode("overwrite").save()


def adjustments_stepwise(t: dict[str, DataFrame]) -> None:
    """Each reason set aggregated on its own and joined to the totals."""
    df = t["inventory_adjustment"]
    result = facts.daily_adjustments(df, {})
    for name, codes in facts.fixed.REASONS.items():
        result = result.join(facts.reason_quantity(df, list(codes), name), KEYS, "left")
    run_all(result)


def adjustments(t: dict[str, DataFrame]) -> None:
    run_all(facts.daily_adjustments(t["inventory_adjustment"]))


def dense_stepwise(t: dict[str, DataFrame]) -> None:
    """Spine joined to the snapshot, then a window over each series."""
    df = t["inventory_snapshot"]
    filled = inventory.calendar_spine(df).join(
        inventory.inventory_snapshot(df), KEYS, "left"
    ).na.fill(0.0, ["IP_QTY_BOP_INV", "IP_QTY_BOP_INTRANS"])
    series = Window.partitionBy("SKU", "LOCATION").orderBy("DATE")
    closings = {"IP_QTY_EOP_INV": "IP_QTY_BOP_INV", "IP_QTY_EOP_INTRANS": "IP_QTY_BOP_INTRANS"}
    run_all(filled.select(*KEYS, *closings.values(), *[
        F.coalesce(F.lead(opening).over(series), F.lit(0.0)).alias(closing)
        for closing, opening in closings.items()
    ]))


def dense(t: dict[str, DataFrame]) -> None:
    run_all(inventory.densify_inventory(t["inventory_snapshot"]))


def wide_of(t: dict[str, DataFrame]) -> DataFrame:
    adjusted = facts.daily_adjustments(t["inventory_adjustment"], {})
    for name, codes in facts.fixed.REASONS.items():
        part = facts.reason_quantity(t["inventory_adjustment"], list(codes), name)
        adjusted = adjusted.join(part, KEYS, "left")
    by_code = facts.daily_transfers_by_code(t["store_transfers"])
    wide = inventory.inventory_snapshot(t["inventory_snapshot"]).join(adjusted, KEYS, "left")
    wide = wide.join(facts.daily_sales(t["sales"]), KEYS, "left")
    wide = wide.join(facts.daily_returns(t["returns"]), KEYS, "left")
    for code, name in ((30, "INTRANSIT_RECORDED"), (20, "DSD_RECORDED")):
        part = by_code.filter(F.col("TRANSFER_CODE") == code).drop("TRANSFER_CODE")
        wide = wide.join(part.withColumnRenamed("TRANSFER_UNITS", name), KEYS, "left")
    wide = wide.join(facts.daily_invoices(t["store_invoice"]), KEYS, "left")
    flags = audit.audit_schedule(t["yearly_audit_schedule"])
    wide = wide.join(flags, ["LOCATION", "DATE"], "left").join(t["sku"], "SKU", "left")
    return derive_measures(fill_zero(wide))


def wide_stepwise(t: dict[str, DataFrame]) -> None:
    """One left join per fact."""
    run_all(wide_of(t))


def wide(t: dict[str, DataFrame]) -> None:
    run_all(denormalize(t))


def validation_stepwise(t: dict[str, DataFrame]) -> None:
    """One count per rule over the rows, then valid and invalid rows."""
    df, rules = t["text"], queries.rules()
    for rule in rules:
        for type_name in rule.types:
            df.groupBy("file").agg(
                F.count(F.col(rule.column).try_cast(type_name)).alias("n")
            ).filter("n = 0").count()
        df.filter(validate._null_flag(rule)).count()
        if rule.formats:
            df.filter(validate._date_flag(rule)).count()
    flag = validate._row_flag(rules)
    run_all(df.filter(flag), df.filter(~flag), df.groupBy("file").agg(F.count_if(flag)))


def validation(t: dict[str, DataFrame]) -> None:
    result = validate.validate(t["text"], queries.rules())
    run_all(result.invalid, result.valid, result.report, result.counts)


PAIRS: dict[str, tuple[Callable, Callable]] = {
    "adjustments": (adjustments_stepwise, adjustments),
    "densify": (dense_stepwise, dense),
    "wide table": (wide_stepwise, wide),
    "validation": (validation_stepwise, validation),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = bench.session(os.environ.get("BENCH_CPUS", "8"))
    for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(f"spark.sql.{name}", "-1")
    root, t = work_dir(spark, "shapes"), {}
    raw = views.raw_tables(spark, sf_dir) | {"text": views.text_rows(spark, sf_dir)}
    for name, df in raw.items():
        df.repartition(8).write.parquet(f"{root}/{name}")
        read = spark.read.parquet(f"{root}/{name}")
        t[name] = read if name == "text" else conform(read, queries.MAPPING, name)
    for name, shapes in PAIRS.items():
        line: dict = {"pair": name}
        for label, shape in zip(("stepwise", "ours"), shapes, strict=True):
            times = []
            for _ in range(6):
                before, start = shuffled_bytes(spark), time.perf_counter()
                shape(t)
                times.append(time.perf_counter() - start)
                moved = shuffled_bytes(spark) - before
            line[f"{label}_sec"] = round(statistics.median(times[1:]), 2)
            line[f"{label}_shuffle_mb"] = round(moved / 1e6, 1)
        print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
