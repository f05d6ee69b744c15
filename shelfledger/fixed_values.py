"""Names, codes and messages that the results must carry as they are."""

# Logical tables, their raw file prefix, and per column the logical key,
# the raw column (None where the column is computed), the conformed column and its type.
TABLES = {
    "inventory_snapshot": ("FD_STORE_INV", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "DATE", "DATE", "date"),
        ("day_start_total_balance", None, "IP_QTY_BOP_INV", "double"),
        ("day_end_total_balance", None, "IP_QTY_EOP_INV", "double"),
        ("day_start_instrans_balance", "IP_QTY_BOP_INTRANS", "IP_QTY_BOP_INTRANS", "double"),
        ("day_end_soh_balance", "IP_QTY_EOP_SOH", "IP_QTY_EOP_SOH", "double"),
        ("day_end_intras_balance", "IP_QTY_EOP_INTRANS", "IP_QTY_EOP_INTRANS", "double"),
        ("day_begin_soh_balance", "IP_QTY_BOP_SOH", "IP_QTY_BOP_SOH", "double"),
    )),
    "inventory_adjustment": ("FD_INV_ADJ", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "ADJ_DATE", "DATE", "date"),
        ("adj_units", "ADJ_QTY", "ADJ_QTY", "double"),
        ("adj_reason", "REASON", "REASON", "int"),
        ("damage_units", None, "DAMAGE_QTY", "double"),
        ("storeuse_units", None, "STOREUSE_QTY", "double"),
        ("expired_units", None, "EXPIRED_QTY", "double"),
        ("scanerr_units", None, "SCANERR_QTY", "double"),
        ("intraday_count", None, "CC_INTRADAY_COUNT", "bigint"),
        ("pos_intraday_count", None, "POS_CC_INTRADAY_COUNT", "bigint"),
        ("neg_intraday_count", None, "NEG_CC_INTRADAY_COUNT", "bigint"),
        ("pos_adj_units", None, "POS_CC_QTY", "double"),
        ("neg_adj_units", None, "NEG_CC_QTY", "double"),
    )),
    "sales": ("FD_SALES", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "TRAN_DATE", "DATE", "date"),
        ("sales_units", "UNITS", "SALES_UNITS", "double"),
        ("sales_price_total", "TOTAL_RETAIL", "SALES_TOTAL_RETAIL", "double"),
        ("sales_count", None, "SALES_COUNT", "bigint"),
        ("bulk_sales_units", None, "BULK_SALES_UNITS", "double"),
    )),
    "returns": ("FD_RETURNS", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "TRAN_DATE", "DATE", "date"),
        ("return_units", "UNITS", "RETURN_UNITS", "double"),
    )),
    "store_transfers": ("FD_STORE_TRANSFERS_IN", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "TRAN_DATE", "DATE", "date"),
        ("transfer_code", "TRAN_CODE", "TRANSFER_CODE", "int"),
        ("transfer_units", "UNITS", "TRANSFER_UNITS", "double"),
        ("in_transit_units", None, "INTRANSIT_RECORDED", "double"),
        ("dsd_units", None, "DSD_RECORDED", "double"),
    )),
    "store_invoice": ("FD_DSD_INVOICE", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("date", "SHIPMENT_RECEIVED_DATE", "DATE", "date"),
        ("invoice_units", "INVC_QTY_RCPT", "DSD_INVC_QTY_RCPT", "double"),
    )),
    "sku": ("FD_SKU_MASTER", (
        ("sku", "SKU", "SKU", "int"),
        ("width", "SKU_WDTH", "SKU_WDTH", "double"),
        ("height", "SKU_HGT", "SKU_HGT", "double"),
        ("depth", "SKU_DPTH", "SKU_DPTH", "double"),
        ("base_price", "BASE_RETAIL", "BASE_RETAIL", "double"),
        ("orig_price", "ORIG_RETAIL", "ORIG_RETAIL", "double"),
        ("line_of_business", "LOB", "LOB", "int"),
        ("class_division", "CDIV", "CDIV", "int"),
        ("category", "CAT", "CAT", "int"),
        ("division", "DIV", "DIV", "int"),
        ("department", "DEPT", "DEPT", "int"),
        ("class", "CLASS", "CLASS", "int"),
    )),
    "yearly_audit": ("FD_PHYSICAL_INV_ADJUSTMENTS", (
        ("sku", "SKU", "SKU", "int"),
        ("location", "LOCATION", "LOCATION", "int"),
        ("audit_date", "TRAN_DATE", "AUDIT_DATE", "date"),
        ("audit_units", "UNITS", "AUDIT_UNITS", "double"),
    )),
    "yearly_audit_schedule": ("FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE", (
        ("location", "LOCATION", "LOCATION", "int"),
        ("audit_date", "INVENTORY_DATE", "AUDIT_DATE", "date"),
        ("date", "RECONCILIATION_DATE", "DATE", "date"),
        ("audit_flag", None, "YEAR_AUDIT_DAY_FLAG", "int"),
    )),
    "carrier_master": ("FD_CARRIER_DETAILS", (
        ("shipment_id", "SHIPMENT_XID", "SHIPMENT_XID", "int"),
        ("stop_num", "STOP_NUM", "STOP_NUM", "int"),
        ("location_gid", "LOCATION_GID", "LOCATION_GID", "string"),
        ("estimated_arrival", "ESTIMATED_ARRIVAL", "ESTIMATED_ARRIVAL", "date"),
        ("planned_arrival", "PLANNED_ARRIVAL", "PLANNED_ARRIVAL", "date"),
        ("actual_arrival", "ACTUAL_ARRIVAL", "ACTUAL_ARRIVAL", "date"),
        ("start_time", "START_TIME", "START_TIME", "date"),
        ("end_time", "END_TIME", "END_TIME", "date"),
    )),
    "derived_fields": (None, (
        ("dsd_transferred_units", None, "DSD_TRANSFERRED_UNITS", "double"),
        ("audit_adj_units", None, "AUDIT_ADJ_QTY", "double"),
        ("sales_units_without_return", None, "SALES_UNITS_WITHOUT_RETURN", "double"),
        ("onhand_recorded", None, "ONHAND_RECORDED", "double"),
        ("sales_unit_retail", None, "SALES_UNIT_RETAIL", "double"),
        ("dc_transferred_units", None, "DC_TRANSFERRED_UNITS", "double"),
    )),
}

# Tables kept whole under the master path instead of by store group.
MASTER_TABLES = ("FD_SKU_MASTER", "FD_CARRIER_DETAILS", "FD_LOCATION")

# Tables a day must bring, tables it may bring, and accepted extensions.
REQUIRED_TABLES = ("FD_STORE_INV",)
SPECIAL_TABLES = (
    "FD_SALES",
    "FD_CARRIER_DETAILS",
    "FD_SKU_MASTER",
    "FD_RETURNS",
    "FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE",
    "FD_INV_ADJ",
    "FD_PHYSICAL_INV_ADJUSTMENTS",
    "FD_STORE_TRANSFERS_IN",
    "FD_DSD_INVOICE",
)
PERMITTED_EXTENSIONS = ("csv", "gz")
README_NAME = "readme.txt"

# Tables the validator looks at.
VALIDATED_TABLES = (
    "FD_STORE_INV",
    "FD_RETURNS",
    "FD_SALES",
    "FD_INV_ADJ",
    "FD_STORE_TRANSFERS_IN",
    "FD_DSD_INVOICE",
    "FD_SKU_MASTER",
    "FD_PHYSICAL_INV_ADJUSTMENTS",
    "FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE",
)

# Dates (yyyyMMdd) on which no drop is expected.
HOLIDAYS = ("20230704", "20230702")

# Run-log layout, component name and error codes.
RUN_LOG_COLUMNS = (
    "sub_proc_id", "run_id", "task_id", "component", "run_date", "file_date", "status",
    "priority", "error_code", "error_message", "missed_files", "processed_files",
    "unpermitted_files", "extra",
)
INGESTION_COMPONENT = "Data Ingestion"
CRITICAL = ("critical",)
ALL_MISSED = ("DATA_ING_ERR_001", "All Files missed for the day")
SOME_MISSED = ("DATA_ING_ERR_002", "Mandatory files missed for the day")

# Adjustment reason codes, transfer codes and thresholds.
REASONS = {
    "DAMAGE_QTY": (4, 11),
    "STOREUSE_QTY": (10,),
    "EXPIRED_QTY": (14,),
    "SCANERR_QTY": (9,),
}
DEFAULT_REASON = 1
DC_TRANSFER_CODE = 30
DSD_TRANSFER_CODE = 20
BULK_OVER_UNITS = 3
ARRIVAL_TOLERANCE_DAYS = 7
STORES_PER_GROUP = 50
ERROR_THRESHOLD_PERCENT = 1.0
