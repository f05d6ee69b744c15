"""The given tables seen as retail drops.

Every row of ``lineitem``, ``orders``, ``part`` and ``events`` takes part. SKUs are runs of a
hundred part keys, so their number grows with the data, while stores and days stay fixed and
let the facts of one item meet. Money is in whole cents, which keeps sums exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY = "1995-01-01"
CALENDAR_START = "2021-01-01"
FILE_EPOCH = "2020-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def folded_day(column: str, days: int, step: int = 1) -> Column:
    """Days since the first one, folded into one calendar and laid out ``step`` days apart."""
    age = F.datediff(F.to_date(column), F.to_date(F.lit(FIRST_DAY)))
    return F.date_add(F.to_date(F.lit(CALENDAR_START)), age % days * step)


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_partkey") / 100).cast("int").alias("SKU"),
        (F.col("l_suppkey") % 10 * 25).cast("int").alias("LOCATION"),
        folded_day("l_shipdate", 360).alias("DATE"),
        F.col("l_quantity").alias("UNITS"),
        F.round(F.col("l_extendedprice") * 100).alias("CENTS"),
        F.col("l_linenumber").alias("LN"),
        F.col("l_returnflag").alias("RF"),
        F.col("l_linestatus").alias("LS"),
        F.col("l_orderkey").alias("ORD"),
    )


def raw_inventory(mv: DataFrame) -> DataFrame:
    units, first = F.col("UNITS"), F.col("LN") <= 2
    return mv.groupBy("SKU", "LOCATION", "DATE").agg(
        F.sum(F.when(first, 0.0).otherwise(units)).alias("IP_QTY_BOP_SOH"),
        F.sum(F.when(first, units).otherwise(0.0)).alias("IP_QTY_BOP_INTRANS"),
        F.sum(F.when(F.col("LS") == "O", units).otherwise(0.0)).alias("IP_QTY_EOP_SOH"),
        F.sum(F.when(F.col("RF") != "N", units)).alias("IP_QTY_EOP_INTRANS"),
    )


def raw_adjustments(mv: DataFrame) -> DataFrame:
    even, ln = F.col("LN") % 2 == 0, F.col("LN")
    reason = (
        F.when(ln == 1, 1).when(ln == 2, 4).when(ln == 3, 9).when(ln == 4, 10)
        .when(ln == 5, 11).when(ln == 6, 14)
    )
    return mv.filter("RF = 'A'").select(
        "SKU", "LOCATION", F.col("DATE").alias("ADJ_DATE"),
        F.when(even, F.col("UNITS")).otherwise(-F.col("UNITS")).alias("ADJ_QTY"),
        reason.alias("REASON"),
    )


def raw_sales(mv: DataFrame) -> DataFrame:
    return mv.filter("RF <> 'R'").select(
        "SKU", "LOCATION", F.col("DATE").alias("TRAN_DATE"), "UNITS",
        F.col("CENTS").alias("TOTAL_RETAIL"),
    )


def raw_returns(mv: DataFrame) -> DataFrame:
    return mv.filter("RF = 'R'").select(
        "SKU", "LOCATION", F.date_add("DATE", 3).alias("TRAN_DATE"), "UNITS"
    )


def raw_transfers(mv: DataFrame) -> DataFrame:
    code = F.when(F.col("LN") == 7, 40).when(F.col("LS") == "F", 30).otherwise(20)
    return mv.select(
        "SKU", "LOCATION", F.date_add("DATE", F.col("LN") - 4).alias("TRAN_DATE"),
        code.alias("TRAN_CODE"), "UNITS",
    )


def raw_invoices(mv: DataFrame) -> DataFrame:
    return mv.filter("LS = 'O'").select(
        "SKU", "LOCATION", F.date_add("DATE", 1).alias("SHIPMENT_RECEIVED_DATE"),
        F.col("UNITS").alias("INVC_QTY_RCPT"),
    )


def raw_schedule(mv: DataFrame) -> DataFrame:
    """Each movement names the middle of its month, counted two or three days before."""
    middle = F.date_add(F.trunc("DATE", "month"), 14)
    counted = F.when(F.col("LS") == "O", F.date_sub(middle, 2)).otherwise(F.date_sub(middle, 3))
    return mv.select(
        "LOCATION", counted.alias("INVENTORY_DATE"), middle.alias("RECONCILIATION_DATE")
    ).distinct()


def raw_audits(mv: DataFrame) -> DataFrame:
    return mv.filter("RF = 'A'").select(
        "SKU", "LOCATION", F.date_sub("DATE", 2).alias("TRAN_DATE"), "UNITS"
    )


def raw_sku_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = F.floor(F.col("p_partkey") / 100).cast("int") + 1
    cents = F.round(F.col("p_retailprice") * 100)
    grouped = table(spark, sf_dir, "part").groupBy(sku.alias("SKU")).agg(
        F.min("p_size").cast("double").alias("SKU_WDTH"),
        F.max("p_size").cast("double").alias("SKU_HGT"),
        F.min(cents).alias("BASE_RETAIL"),
        F.max(cents).alias("ORIG_RETAIL"),
    )
    coded = {
        name: (F.col("SKU") % n).cast("int")
        for name, n in {"LOB": 7, "CDIV": 5, "CAT": 11, "DIV": 3, "DEPT": 13, "CLASS": 17}.items()
    }
    depth = F.when(F.col("SKU") % 4 != 0, F.col("SKU_HGT") - F.col("SKU_WDTH"))
    return grouped.withColumns({"SKU_DPTH": depth, **coded})


def raw_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = folded_day("o_orderdate", 33, 11)
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")

    def text(column: Column) -> Column:
        return F.date_format(column, "dd-MMM-yy")

    store = F.concat(F.lit("FD.FDS_"), F.lpad((customer % 10 * 25).cast("string"), 5, "0"))
    depot = F.col("o_orderpriority").startswith("5")
    orders = table(spark, sf_dir, "orders").withColumn("copy", F.lit(False))
    # every fifth stop is listed again, mostly without the arrival its other row states
    again = orders.filter("o_orderkey % 5 = 0").withColumn("copy", F.lit(True))
    arrived = F.when(F.col("copy"), F.when(status == "O", F.date_add(day, 1))).otherwise(
        F.when(status != "P", day)
    )
    return orders.union(again).select(
        F.when(customer % 13 != 0, customer).alias("SHIPMENT_XID"),
        F.col("o_orderkey").alias("STOP_NUM"),
        F.when(depot, "FD.9540").otherwise(store).alias("LOCATION_GID"),
        text(F.when(customer % 2 == 0, F.date_add(day, 1))).alias("ESTIMATED_ARRIVAL"),
        text(F.when(customer % 3 == 0, F.date_add(day, 2))).alias("PLANNED_ARRIVAL"),
        text(arrived).alias("ACTUAL_ARRIVAL"),
        text(F.when(status == "F", F.date_sub(day, 1)).otherwise(F.date_add(day, 1)))
        .alias("START_TIME"),
        text(F.date_add(day, 1)).alias("END_TIME"),
    )


#: Folders of raw tables that were written once, by the folder they were derived from.
WRITTEN: dict[str, str] = {}


def write_raw(spark: SparkSession, sf_dir: str, folder: str, files: int = 8) -> None:
    """Writes the raw tables and the text rows; queries then read them instead of deriving
    them from ``lineitem`` again."""
    for name, df in {**raw_tables(spark, sf_dir), "text_rows": text_rows(spark, sf_dir)}.items():
        df.repartition(files).write.parquet(f"{folder}/{name}")
    WRITTEN[sf_dir] = folder


RAW_NAMES = (
    "inventory_snapshot", "inventory_adjustment", "sales", "returns", "store_transfers",
    "store_invoice", "yearly_audit_schedule", "yearly_audit", "sku", "carrier_master",
)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw tables by logical name."""
    if sf_dir in WRITTEN:
        return {n: spark.read.parquet(f"{WRITTEN[sf_dir]}/{n}") for n in RAW_NAMES}
    mv = movements(spark, sf_dir)
    return {
        "inventory_snapshot": raw_inventory(mv),
        "inventory_adjustment": raw_adjustments(mv),
        "sales": raw_sales(mv),
        "returns": raw_returns(mv),
        "store_transfers": raw_transfers(mv),
        "store_invoice": raw_invoices(mv),
        "yearly_audit_schedule": raw_schedule(mv),
        "yearly_audit": raw_audits(mv),
        "sku": raw_sku_master(spark, sf_dir),
        "carrier_master": raw_carriers(spark, sf_dir),
    }


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped rows of dropped files with errors worked in: bad and blank dates, absent
    and blank units, and whole files whose prices are no numbers."""
    if sf_dir in WRITTEN:
        return spark.read.parquet(f"{WRITTEN[sf_dir]}/text_rows")
    mv = movements(spark, sf_dir)
    order = F.col("ORD")
    source = F.when(F.col("RF") == "R", "FD_RETURNS").otherwise("FD_SALES")
    number = F.floor(F.col("SKU") / 5) + 1
    day = F.col("DATE").cast("string")
    spelled = F.when(number % 3 == 0, F.date_format("DATE", "yyyyMMdd")).otherwise(
        F.date_format("DATE", "ddMMyyyy")
    )
    file = F.concat(
        F.lit("drop/"), source, F.lit("/"), source, F.lit("-"), spelled,
        F.lit("-"), number.cast("string"), F.lit(".csv"),
    )
    return mv.select(
        file.alias("file"),
        F.col("SKU").cast("string").alias("SKU"),
        F.col("LOCATION").cast("string").alias("LOCATION"),
        F.when(order % 211 == 0, "2021-13-01").when(order % 307 == 0, "").otherwise(day)
        .alias("TRAN_DATE"),
        F.when(order % 401 != 0, F.when(order % 503 == 0, " ").otherwise(
            F.col("UNITS").cast("bigint").cast("string"))).alias("UNITS"),
        F.when((F.dayofmonth("DATE") == 13) & (number == 1), "n/a")
        .otherwise(F.col("CENTS").cast("bigint").cast("string")).alias("TOTAL_RETAIL"),
    )


def drop_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dropped file per event, some with a wrong name or extension."""
    user, kind = F.col("user_id"), F.col("event_type")
    day = F.date_add(F.to_date(F.lit(FILE_EPOCH)), (user % 3000).cast("int"))
    source = (
        F.when((kind == "signup") & (F.hour("ts") == 0), "FD_STORE_INV")
        .when(kind == "signup", "FD_SALES").when(kind == "view", "FD_RETURNS")
        .when(kind == "click", "FD_INV_ADJ").when(kind == "error", "FD_MARKDOWNS")
        .otherwise("FD_PHYSICAL_INV_ADJUSTMENTS")
    )
    defect, number = F.col("event_id") % 11, F.col("event_id").cast("string")
    dmy, ymd = F.date_format(day, "ddMMyyyy"), F.date_format(day, "yyyyMMdd")
    name = (
        F.when(defect == 0, F.concat(source, F.lit("-"), dmy, F.lit("-"), number, F.lit(".txt")))
        .when(defect == 1, F.concat(source, F.lit("-"), dmy, F.lit("_"), number, F.lit("-23.csv")))
        .when(defect == 2, F.concat(source, F.lit("_ERROR-"), dmy, F.lit("12-"), number,
                                    F.lit(".csv")))
        .when(defect == 3, F.concat(source, F.lit("-"), ymd, F.lit("-"), number, F.lit(".csv.gz")))
        .otherwise(F.concat(source, F.lit("-"), dmy, F.lit("-"), number, F.lit(".csv")))
    )
    return table(spark, sf_dir, "events").select(F.concat(F.lit("drop/in/"), name).alias("path"))


def wanted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = (F.col("user_id") % 3000 * 2).cast("int")
    day = F.date_add(F.to_date(F.lit(FILE_EPOCH)), offset)
    return table(spark, sf_dir, "events").select(
        F.date_format(day, "yyyyMMdd").alias("file_date")
    ).distinct()


def earlier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log with one row per event."""
    kind, user = F.col("event_type"), F.col("user_id")
    file_day = F.date_sub(F.to_date("ts"), (user % 40).cast("int"))
    failed = kind.isin("error", "click")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(user % 5 == 0, "Data Validator").otherwise("Data Ingestion").alias("component"),
        F.date_format("ts", "yyyyMMdd").alias("run_date"),
        F.date_format(file_day, "yyyyMMdd").alias("file_date"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, "critical").when(kind == "view", "moderate").otherwise("")
        .alias("priority"),
        F.when(kind == "error", "['FD_STORE_INV']")
        .when(kind == "click", "['FD_STORE_INV', 'FD_SALES']")
        .when(kind == "view", "").alias("missed_files"),
    )


def requested_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events").filter("event_type = 'purchase'")
        .select(F.date_format("ts", "yyyyMMdd").alias("file_date")).distinct()
    )
