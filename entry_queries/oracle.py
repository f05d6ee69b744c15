"""The same results in DuckDB SQL, written from the meaning of each query.

``PARTS`` are common table expressions; ``sql(body, ...)`` puts those a body uses in front.
"""

from __future__ import annotations

import re

PARTS = {
    "mv": """
        SELECT CAST(l_partkey // 100 AS INTEGER) AS "SKU",
               CAST(25 * (l_suppkey % 10) AS INTEGER) AS "LOCATION",
               DATE '2021-01-01' + CAST((CAST(l_shipdate AS DATE) - DATE '1995-01-01') % 360
                 AS INTEGER) AS "DATE",
               l_quantity AS "UNITS", round(l_extendedprice * 100) AS "CENTS",
               l_linenumber AS "LN", l_returnflag AS "RF", l_linestatus AS "LS",
               l_orderkey AS "ORD"
        FROM lineitem""",
    "inv": """
        SELECT "SKU", "LOCATION", "DATE",
               sum(CASE WHEN "LN" > 2 THEN "UNITS" ELSE 0 END) AS "IP_QTY_BOP_SOH",
               sum(CASE WHEN "LN" <= 2 THEN "UNITS" ELSE 0 END) AS "IP_QTY_BOP_INTRANS",
               sum(CASE WHEN "LS" = 'O' THEN "UNITS" ELSE 0 END) AS "IP_QTY_EOP_SOH",
               sum(CASE WHEN "RF" <> 'N' THEN "UNITS" END) AS "IP_QTY_EOP_INTRANS"
        FROM mv GROUP BY 1, 2, 3""",
    "adj": """
        SELECT "SKU", "LOCATION", "DATE",
               CASE WHEN "LN" % 2 = 0 THEN "UNITS" ELSE -"UNITS" END AS "ADJ_QTY",
               coalesce(CASE "LN" WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 9 WHEN 4 THEN 10
                        WHEN 5 THEN 11 WHEN 6 THEN 14 END, 1) AS "REASON"
        FROM mv WHERE "RF" = 'A'""",
    "sales": """
        SELECT "SKU", "LOCATION", "DATE", "UNITS", "CENTS" FROM mv WHERE "RF" <> 'R'""",
    "returned": """
        SELECT "SKU", "LOCATION", "DATE" + 3 AS "DATE", "UNITS" FROM mv WHERE "RF" = 'R'""",
    "transfers": """
        SELECT "SKU", "LOCATION", "DATE" + CAST("LN" - 4 AS INTEGER) AS "DATE",
               CASE WHEN "LN" = 7 THEN 40 WHEN "LS" = 'F' THEN 30 ELSE 20 END AS "CODE", "UNITS"
        FROM mv""",
    "invoices": """
        SELECT "SKU", "LOCATION", "DATE" + 1 AS "DATE", "UNITS" FROM mv WHERE "LS" = 'O'""",
    "sched": """
        SELECT DISTINCT "LOCATION", m - CASE WHEN "LS" = 'O' THEN 2 ELSE 3 END AS "AUDIT_DATE",
               m AS "DATE"
        FROM (SELECT *, CAST(date_trunc('month', "DATE") AS DATE) + 14 AS m FROM mv)""",
    "audits": """
        SELECT "SKU", "LOCATION", "DATE" - 2 AS "AUDIT_DATE", "UNITS" AS "AUDIT_UNITS"
        FROM mv WHERE "RF" = 'A'""",
    "items0": """
        SELECT CAST(p_partkey // 100 AS INTEGER) + 1 AS "SKU",
               CAST(min(p_size) AS DOUBLE) AS "SKU_WDTH", CAST(max(p_size) AS DOUBLE) AS "SKU_HGT",
               min(round(p_retailprice * 100)) AS "BASE_RETAIL",
               max(round(p_retailprice * 100)) AS "ORIG_RETAIL"
        FROM part GROUP BY 1""",
    "items": """
        SELECT *, CASE WHEN "SKU" % 4 <> 0 THEN "SKU_HGT" - "SKU_WDTH" END AS "SKU_DPTH",
               "SKU" % 7 AS "LOB", "SKU" % 5 AS "CDIV", "SKU" % 11 AS "CAT", "SKU" % 3 AS "DIV",
               "SKU" % 13 AS "DEPT", "SKU" % 17 AS "CLASS"
        FROM items0""",
    "a": """
        SELECT "SKU", "LOCATION", "DATE", sum("ADJ_QTY") AS "ADJ_QTY",
               count(*) AS "CC_INTRADAY_COUNT",
               count(CASE WHEN "ADJ_QTY" > 0 THEN 1 END) AS "POS_CC_INTRADAY_COUNT",
               count(CASE WHEN "ADJ_QTY" < 0 THEN 1 END) AS "NEG_CC_INTRADAY_COUNT",
               sum(CASE WHEN "ADJ_QTY" > 0 THEN "ADJ_QTY" ELSE 0 END) AS "POS_CC_QTY",
               sum(CASE WHEN "ADJ_QTY" < 0 THEN "ADJ_QTY" ELSE 0 END) AS "NEG_CC_QTY",
               sum("ADJ_QTY") FILTER ("REASON" IN (4, 11)) AS "DAMAGE_QTY",
               sum("ADJ_QTY") FILTER ("REASON" = 10) AS "STOREUSE_QTY",
               sum("ADJ_QTY") FILTER ("REASON" = 14) AS "EXPIRED_QTY",
               sum("ADJ_QTY") FILTER ("REASON" = 9) AS "SCANERR_QTY"
        FROM adj GROUP BY 1, 2, 3""",
    "s": """
        SELECT "SKU", "LOCATION", "DATE", count(*) AS "SALES_COUNT",
               sum(CASE WHEN "UNITS" > 3 THEN "UNITS" ELSE 0 END) AS "BULK_SALES_UNITS",
               sum("UNITS") AS "SALES_UNITS", sum("CENTS") AS "SALES_TOTAL_RETAIL"
        FROM sales GROUP BY 1, 2, 3""",
    "r": """
        SELECT "SKU", "LOCATION", "DATE", sum("UNITS") AS "RETURN_UNITS"
        FROM returned GROUP BY 1, 2, 3""",
    "t": """
        SELECT "SKU", "LOCATION", "DATE",
               sum("UNITS") FILTER ("CODE" = 30) AS "INTRANSIT_RECORDED",
               sum("UNITS") FILTER ("CODE" = 20) AS "DSD_RECORDED"
        FROM transfers WHERE "CODE" IN (20, 30) GROUP BY 1, 2, 3""",
    "v": """
        SELECT "SKU", "LOCATION", "DATE", sum("UNITS") AS "DSD_INVC_QTY_RCPT"
        FROM invoices GROUP BY 1, 2, 3""",
    "f": """SELECT DISTINCT "LOCATION", "DATE", 1 AS "YEAR_AUDIT_DAY_FLAG" FROM sched""",
    "snapshot": """
        SELECT *, "IP_QTY_EOP_INTRANS" + "IP_QTY_EOP_SOH" AS "IP_QTY_EOP_INV",
               "IP_QTY_BOP_INTRANS" + "IP_QTY_BOP_SOH" AS "IP_QTY_BOP_INV"
        FROM inv""",
    "spine": """
        SELECT "SKU", "LOCATION", CAST(unnest(generate_series(min("DATE"), max("DATE"),
               INTERVAL 1 DAY)) AS DATE) AS "DATE"
        FROM inv GROUP BY "SKU", "LOCATION" """,
    "filled": """
        SELECT p.*, coalesce(i."IP_QTY_BOP_INTRANS" + i."IP_QTY_BOP_SOH", 0) AS "IP_QTY_BOP_INV",
               coalesce(i."IP_QTY_BOP_INTRANS", 0) AS "IP_QTY_BOP_INTRANS"
        FROM spine p LEFT JOIN inv i USING ("SKU", "LOCATION", "DATE")""",
    "closed": """
        SELECT *, coalesce(lead("IP_QTY_BOP_INV") OVER w, 0) AS "IP_QTY_EOP_INV",
               coalesce(lead("IP_QTY_BOP_INTRANS") OVER w, 0) AS "IP_QTY_EOP_INTRANS"
        FROM filled WINDOW w AS (PARTITION BY "SKU", "LOCATION" ORDER BY "DATE")""",
    "dense": """
        SELECT *, "IP_QTY_BOP_INV" - "IP_QTY_BOP_INTRANS" AS "IP_QTY_BOP_SOH",
               "IP_QTY_EOP_INV" - "IP_QTY_EOP_INTRANS" AS "IP_QTY_EOP_SOH"
        FROM closed""",
    "truck0": """
        SELECT CASE WHEN o_custkey % 13 <> 0 THEN o_custkey END AS ship, o_orderkey AS stop,
               again,
               CASE WHEN o_orderpriority LIKE '5%' THEN 0
                    ELSE CAST(25 * (o_custkey % 10) AS INTEGER) END AS loc,
               DATE '2021-01-01' + CAST((CAST(o_orderdate AS DATE) - DATE '1995-01-01') % 33 * 11
                 AS INTEGER) AS d, o_orderstatus AS st, o_custkey AS c
        FROM orders, (VALUES (false), (true)) x(again) WHERE NOT again OR o_orderkey % 5 = 0""",
    "truck1": """
        SELECT *, CASE WHEN again THEN CASE WHEN st = 'O' THEN d + 1 END
                       WHEN st <> 'P' THEN d END AS actual,
               CASE WHEN c % 2 = 0 THEN d + 1 END AS estimated,
               CASE WHEN c % 3 = 0 THEN d + 2 END AS planned,
               CASE WHEN st = 'F' THEN d - 1 ELSE d + 1 END AS started, d + 1 AS ended
        FROM truck0""",
    "stop0": """
        SELECT ship, stop, max(actual) AS own FROM truck1 WHERE ship IS NOT NULL GROUP BY 1, 2""",
    "stop1": """
        SELECT *, lag(own) OVER w AS before, lead(own) OVER w AS after
        FROM stop0 WINDOW w AS (PARTITION BY ship ORDER BY stop)""",
    "truck2": """
        SELECT x.*, coalesce(actual, own, before, after, estimated, planned, ended) AS best
        FROM truck1 x LEFT JOIN stop1 y ON x.ship = y.ship AND x.stop = y.stop""",
    "trucks": """
        SELECT ship AS "SHIPMENT_XID", stop AS "STOP_NUM", loc AS "LOCATION",
               CASE WHEN best < started THEN ended ELSE best END AS "ACTUAL_ARRIVAL"
        FROM truck2""",
    "arrivals": """SELECT DISTINCT "LOCATION", "ACTUAL_ARRIVAL" FROM trucks""",
    "moved0": """
        SELECT x."LOCATION", x."DATE", min(y."ACTUAL_ARRIVAL") AS "ACTUAL_ARRIVAL"
        FROM (SELECT DISTINCT "LOCATION", "DATE" FROM transfers) x
        LEFT JOIN arrivals y ON x."LOCATION" = y."LOCATION"
             AND y."ACTUAL_ARRIVAL" BETWEEN x."DATE" AND x."DATE" + 7
        GROUP BY 1, 2""",
    "moved": """
        SELECT x."SKU", x."LOCATION", coalesce(y."ACTUAL_ARRIVAL", x."DATE") AS "DATE",
               sum(x."UNITS") AS "DC_TRANSFERRED_UNITS"
        FROM transfers x JOIN moved0 y ON x."LOCATION" = y."LOCATION" AND x."DATE" = y."DATE"
        WHERE x."CODE" = 30 GROUP BY 1, 2, 3""",
    "dated": """
        SELECT x."SKU", x."LOCATION", y."DATE", x."AUDIT_UNITS"
        FROM audits x LEFT JOIN (SELECT DISTINCT * FROM sched) y
             ON x."LOCATION" = y."LOCATION" AND x."AUDIT_DATE" = y."AUDIT_DATE" """,
    "audited": """
        SELECT "SKU", "LOCATION", "DATE", sum("AUDIT_UNITS") AS "AUDIT_UNITS"
        FROM dated WHERE "DATE" IS NOT NULL GROUP BY 1, 2, 3""",
    "raw": """
        SELECT 'drop/' || src || '/' || src || '-' || fd || '-' || CAST(no AS VARCHAR) || '.csv'
                 AS file,
               "DATE", fd, src,
               CAST("SKU" AS VARCHAR) AS "SKU", CAST("LOCATION" AS VARCHAR) AS "LOCATION",
               CASE WHEN "ORD" % 211 = 0 THEN '2021-13-01' WHEN "ORD" % 307 = 0 THEN ''
                    ELSE strftime("DATE", '%Y-%m-%d') END AS "TRAN_DATE",
               CASE WHEN "ORD" % 401 <> 0 THEN CASE WHEN "ORD" % 503 = 0 THEN ' '
                    ELSE CAST(CAST("UNITS" AS BIGINT) AS VARCHAR) END END AS "UNITS",
               CASE WHEN day("DATE") = 13 AND no = 1 THEN 'n/a'
                    ELSE CAST(CAST("CENTS" AS BIGINT) AS VARCHAR) END AS "TOTAL_RETAIL"
        FROM (SELECT *, CASE WHEN no % 3 = 0 THEN strftime("DATE", '%Y%m%d')
                             ELSE strftime("DATE", '%d%m%Y') END AS fd
              FROM (SELECT *, "SKU" // 5 + 1 AS no,
                     CASE WHEN "RF" = 'R' THEN 'FD_RETURNS' ELSE 'FD_SALES' END AS src FROM mv))""",
    "flags": """
        SELECT *, "SKU" IS NULL OR "SKU" IN ('', ' ') AS n0,
               "TRAN_DATE" IS NULL OR "TRAN_DATE" IN ('', ' ') AS n1,
               "UNITS" IS NULL OR "UNITS" IN ('', ' ') AS n2,
               "TOTAL_RETAIL" IS NULL OR "TOTAL_RETAIL" IN ('', ' ') AS n3,
               "TRAN_DATE" NOT IN ('', ' ') AND try_strptime("TRAN_DATE", '%Y-%m-%d') IS NULL AS d1
        FROM raw""",
    "stats": """
        SELECT file, any_value(fd) AS fd, any_value("DATE") AS day, any_value(src) AS src,
               count(*) AS n,
               count(*) FILTER (n0 OR n1 OR n2 OR n3 OR d1) AS bad,
               count(*) FILTER (n0) AS n0, count(*) FILTER (n1) AS n1,
               count(*) FILTER (n2) AS n2, count(*) FILTER (n3) AS n3,
               count(*) FILTER (d1) AS d1,
               CASE WHEN count(TRY_CAST("SKU" AS INTEGER)) = 0 THEN 0
                    WHEN count("TRAN_DATE") = 0 THEN 1
                    WHEN count(TRY_CAST("UNITS" AS DOUBLE)) = 0 THEN 2
                    WHEN count(TRY_CAST("TOTAL_RETAIL" AS DOUBLE)) = 0 THEN 3 END AS failed
        FROM flags GROUP BY file""",
    "judged": """
        SELECT f.*, n0 OR n1 OR n2 OR n3 OR d1
               OR file IN (SELECT file FROM stats WHERE failed IS NOT NULL) AS is_invalid
        FROM flags f""",
    "counts": """
        SELECT strftime(day, '%Y%m%d') AS file_date, file AS uri, src AS "table",
               CASE WHEN failed IS NOT NULL THEN n ELSE bad END AS error_row_count,
               n AS original_row_count
        FROM stats""",
    "rates": """
        SELECT file_date, "table", count(*) AS files,
               CAST(sum(error_row_count) AS BIGINT) AS error_row_count,
               CAST(sum(original_row_count) AS BIGINT) AS original_row_count,
               CAST(sum(error_row_count) AS DOUBLE) / CAST(sum(original_row_count) AS DOUBLE) * 100
                 AS error_percent,
               sum(error_row_count) * 100 > sum(original_row_count) AS over_threshold
        FROM counts GROUP BY 1, 2""",
    "ev": """
        SELECT *, CASE WHEN event_type = 'signup' AND hour(ts) = 0 THEN 'FD_STORE_INV'
                    WHEN event_type = 'signup' THEN 'FD_SALES'
                    WHEN event_type = 'view' THEN 'FD_RETURNS'
                    WHEN event_type = 'click' THEN 'FD_INV_ADJ'
                    WHEN event_type = 'error' THEN 'FD_MARKDOWNS'
                    ELSE 'FD_PHYSICAL_INV_ADJUSTMENTS' END AS src,
               DATE '2020-01-01' + CAST(user_id % 3000 AS INTEGER) AS d,
               event_id % 11 AS defect, CAST(event_id AS VARCHAR) AS no
        FROM events""",
    "dropped": """
        SELECT src, defect, d, CASE defect
            WHEN 0 THEN src || '-' || strftime(d, '%d%m%Y') || '-' || no || '.txt'
            WHEN 1 THEN src || '-' || strftime(d, '%d%m%Y') || '_' || no || '-23.csv'
            WHEN 2 THEN src || '_ERROR-' || strftime(d, '%d%m%Y') || '12-' || no || '.csv'
            WHEN 3 THEN src || '-' || strftime(d, '%Y%m%d') || '-' || no || '.csv.gz'
            ELSE src || '-' || strftime(d, '%d%m%Y') || '-' || no || '.csv' END AS name,
            CASE WHEN defect = 3 THEN strftime(d, '%Y%m%d')
                 ELSE strftime(d, '%d%m%Y') END AS spelled
        FROM ev""",
    "accepted": """
        SELECT 'drop/in/' || name AS path, src AS "table", strftime(d, '%Y%m%d') AS file_date,
               CAST(regexp_extract(name, '-([0-9]+)[.]', 1) AS BIGINT) % 3 AS part
        FROM dropped WHERE defect > 2 AND src <> 'FD_MARKDOWNS'""",
    "received": """
        SELECT CASE WHEN defect = 2 THEN src || '_ERROR' ELSE src END AS "table",
               CASE WHEN defect = 1 THEN split_part(name, '-', 2)
                    WHEN defect = 2 THEN spelled || '12' ELSE strftime(d, '%Y%m%d') END
                 AS file_date
        FROM dropped""",
    "days": """
        SELECT DISTINCT strftime(dd, '%Y%m%d') AS file_date, strftime(dd, '%d%m%Y') AS other
        FROM (SELECT DATE '2020-01-01' + CAST(user_id % 3000 * 2 AS INTEGER) AS dd FROM events)""",
    "hits": """
        SELECT DISTINCT file_date, name FROM days JOIN dropped
        ON contains(name, file_date) OR contains(name, other)""",
    "known": """
        SELECT unnest(['FD_STORE_INV', 'FD_SALES', 'FD_CARRIER_DETAILS', 'FD_SKU_MASTER',
               'FD_RETURNS', 'FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE', 'FD_INV_ADJ',
               'FD_PHYSICAL_INV_ADJUSTMENTS', 'FD_STORE_TRANSFERS_IN', 'FD_DSD_INVOICE']) AS ref""",
    "came": """
        SELECT DISTINCT file_date, ref FROM hits JOIN known ON contains(name, ref)
        WHERE name LIKE '%.csv' OR name LIKE '%.gz'""",
    "gone": """
        SELECT file_date, ref FROM days, (SELECT unnest(['FD_STORE_INV',
               'FD_PHYSICAL_INV_ADJUSTMENTS']) AS ref)
        WHERE (file_date, ref) NOT IN (SELECT (file_date, ref) FROM came)""",
    "logged_gap": """
        SELECT file_date, 'failed' AS status, 'critical' AS priority,
               CASE count(*) WHEN 2 THEN 'DATA_ING_ERR_001' ELSE 'DATA_ING_ERR_002' END
                 AS error_code,
               CASE count(*) WHEN 2 THEN 'All Files missed for the day'
                    ELSE 'Mandatory files missed for the day' END AS error_message,
               '[''' || string_agg(ref, ''', ''' ORDER BY ref DESC) || ''']' AS missed_files,
               '' AS processed_files, '' AS unpermitted_files
        FROM gone GROUP BY file_date""",
    "logged_ok": """
        SELECT file_date, 'success' AS status, '' AS priority, '' AS error_code,
               '' AS error_message, '' AS missed_files,
               '[''' || string_agg(ref, ''', ''' ORDER BY ref) || ''']' AS processed_files,
               '' AS unpermitted_files
        FROM came GROUP BY file_date""",
    "logged_wrong": """
        SELECT file_date, 'failed' AS status, 'moderate' AS priority, '' AS error_code,
               '' AS error_message, '' AS missed_files, '' AS processed_files,
               '[''' || name || ''']' AS unpermitted_files
        FROM hits WHERE name LIKE '%.txt'
          AND EXISTS (SELECT 1 FROM known WHERE contains(name, ref))""",
    "log_rows": """
        SELECT '' AS sub_proc_id, '' AS run_id, '' AS task_id, 'Data Ingestion' AS component,
               '20240215' AS run_date, *, '' AS extra
        FROM (FROM logged_gap UNION ALL FROM logged_ok UNION ALL FROM logged_wrong)""",
    "elog": """
        SELECT CAST(event_id AS VARCHAR) AS run_id,
               CASE WHEN user_id % 5 = 0 THEN 'Data Validator' ELSE 'Data Ingestion' END
                 AS component,
               strftime(ts, '%Y%m%d') AS run_date,
               strftime(CAST(ts AS DATE) - CAST(user_id % 40 AS INTEGER), '%Y%m%d') AS file_date,
               CASE WHEN event_type IN ('error', 'click') THEN 'failed' ELSE 'success' END
                 AS status,
               CASE WHEN event_type IN ('error', 'click') THEN 'critical'
                    WHEN event_type = 'view' THEN 'moderate' ELSE '' END AS priority,
               CASE event_type WHEN 'error' THEN '[''FD_STORE_INV'']'
                    WHEN 'click' THEN '[''FD_STORE_INV'', ''FD_SALES'']'
                    WHEN 'view' THEN '' END AS missed_files
        FROM events""",
    "latest": """
        SELECT * FROM elog WHERE component = 'Data Ingestion' AND priority = 'critical'
          AND run_date = (SELECT max(run_date) FROM elog
                          WHERE component = 'Data Ingestion' AND priority = 'critical')""",
    "asked": """
        SELECT DISTINCT strftime(ts, '%Y%m%d') AS file_date FROM events
        WHERE event_type = 'purchase'""",
    "stated": """
        SELECT CAST(strptime(file_date, '%Y%m%d') AS DATE) AS day
        FROM (SELECT file_date FROM latest UNION SELECT file_date FROM asked)""",
    "stated_log": """
        SELECT CAST(strptime(file_date, '%Y%m%d') AS DATE) AS day
        FROM (SELECT file_date FROM elog UNION SELECT file_date FROM asked)""",
    "lost": """
        SELECT DISTINCT file_date, CASE n WHEN 1 THEN 'FD_STORE_INV' ELSE 'FD_SALES' END AS ref
        FROM (SELECT file_date, unnest(CASE WHEN missed_files LIKE '%FD_SALES%' THEN [1, 2]
                                       WHEN missed_files LIKE '%FD_STORE%' THEN [1]
                                       ELSE [] END) AS n FROM elog)""",
    "mfl": """
        SELECT a.file_date, coalesce(string_agg(ref, ',' ORDER BY ref), '') AS missing
        FROM asked a LEFT JOIN lost l ON a.file_date = l.file_date GROUP BY 1""",
    "claimed": """
        SELECT file_date, CASE WHEN file_date < '20240115' THEN 'FD_SALES,FD_STORE_INV'
               ELSE 'FD_STORE_INV' END AS missing FROM asked""",
}

ITEM_COLUMNS = ["SKU_WDTH", "SKU_HGT", "SKU_DPTH"]
ZEROES = """coalesce("ADJ_QTY", 0) AS "ADJ_QTY", coalesce("DAMAGE_QTY", 0) AS "DAMAGE_QTY",
    coalesce("STOREUSE_QTY", 0) AS "STOREUSE_QTY", coalesce("EXPIRED_QTY", 0) AS "EXPIRED_QTY",
    coalesce("SCANERR_QTY", 0) AS "SCANERR_QTY",
    coalesce("CC_INTRADAY_COUNT", 0) AS "CC_INTRADAY_COUNT",
    coalesce("POS_CC_INTRADAY_COUNT", 0) AS "POS_CC_INTRADAY_COUNT",
    coalesce("NEG_CC_INTRADAY_COUNT", 0) AS "NEG_CC_INTRADAY_COUNT",
    coalesce("POS_CC_QTY", 0) AS "POS_CC_QTY", coalesce("NEG_CC_QTY", 0) AS "NEG_CC_QTY",
    coalesce("SALES_UNITS", 0) AS "SALES_UNITS",
    coalesce("SALES_TOTAL_RETAIL", 0) AS "SALES_TOTAL_RETAIL",
    coalesce("SALES_COUNT", 0) AS "SALES_COUNT",
    coalesce("BULK_SALES_UNITS", 0) AS "BULK_SALES_UNITS",
    coalesce("RETURN_UNITS", 0) AS "RETURN_UNITS",
    coalesce("INTRANSIT_RECORDED", 0) AS "INTRANSIT_RECORDED",
    coalesce("DSD_RECORDED", 0) AS "DSD_RECORDED",
    coalesce("DSD_INVC_QTY_RCPT", 0) AS "DSD_INVC_QTY_RCPT",
    coalesce("YEAR_AUDIT_DAY_FLAG", 0) AS "YEAR_AUDIT_DAY_FLAG",
    coalesce("SKU_WDTH", 0) AS "SKU_WDTH", coalesce("SKU_HGT", 0) AS "SKU_HGT",
    coalesce("SKU_DPTH", 0) AS "SKU_DPTH",
    "BASE_RETAIL", "ORIG_RETAIL", "LOB", "CDIV", "CAT", "DIV", "DEPT", "CLASS" """
KEYS = '"SKU", "LOCATION", "DATE"'


def wide(snapshot: str, columns: str = "", joins: str = "") -> str:
    return f"""
        SELECT b.*, {ZEROES}{columns}
        FROM {snapshot} b LEFT JOIN a USING ({KEYS}) LEFT JOIN s USING ({KEYS})
        LEFT JOIN r USING ({KEYS}) LEFT JOIN t USING ({KEYS}) LEFT JOIN v USING ({KEYS})
        LEFT JOIN f USING ("LOCATION", "DATE") LEFT JOIN items USING ("SKU") {joins}"""


def measured(rows: str) -> str:
    """All measures spelled out over rows that hold their inputs."""
    return f"""
        SELECT * REPLACE (CASE WHEN "DSD_TRANSFERRED_UNITS" < 0
                          THEN "ONHAND_RECORDED" + "DSD_TRANSFERRED_UNITS"
                          ELSE "ONHAND_RECORDED" END AS "ONHAND_RECORDED")
        FROM (
          SELECT *,
            CASE WHEN "DSD_RECORDED" > 0 OR "DSD_INVC_QTY_RCPT" > 0
                 THEN "IP_QTY_EOP_INV" + "SALES_UNITS" - "ADJ_QTY" - "IP_QTY_BOP_INV"
                 ELSE 0 END AS "DSD_TRANSFERRED_UNITS",
            CASE WHEN "IP_QTY_EOP_SOH" + "SALES_UNITS" - "ADJ_QTY" > "IP_QTY_BOP_SOH"
                 THEN "IP_QTY_EOP_SOH" + "SALES_UNITS" - "ADJ_QTY" - "IP_QTY_BOP_SOH"
                 ELSE 0 END AS "ONHAND_RECORDED"
          FROM (
            SELECT * REPLACE (CASE WHEN "DSD_RECORDED" > 0
                              THEN "DSD_RECORDED" - "INTRANSIT_RECORDED"
                              ELSE "DSD_RECORDED" END AS "DSD_RECORDED"),
              "SALES_UNITS" - "RETURN_UNITS" AS "SALES_UNITS_WITHOUT_RETURN",
              "ADJ_QTY" AS "AUDIT_ADJ_QTY",
              CASE WHEN "SALES_UNITS" = 0 THEN CAST(0 AS DOUBLE) ELSE
                CAST((200 * CAST("SALES_TOTAL_RETAIL" AS BIGINT) + CAST("SALES_UNITS" AS BIGINT))
                  // (2 * CAST("SALES_UNITS" AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)
                END / CAST(1 AS DOUBLE) AS "SALES_UNIT_RETAIL"
            FROM ({rows}))) """


def _uses(text: str) -> list[str]:
    return [p for p in PARTS if re.search(rf"(FROM|JOIN|,)\s+{p}\b", text)]


def sql(body: str) -> str:
    """The body with every common table expression it needs, directly or not."""
    needed: list[str] = []
    pending = _uses(body)
    while pending:
        part = pending.pop()
        if part not in needed:
            needed.append(part)
            pending.extend(_uses(PARTS[part]))
    chosen = [p for p in PARTS if p in needed]
    heads = ",\n".join(f"{p} AS ({PARTS[p]})" for p in chosen)
    return f"WITH {heads}\n{body}" if chosen else body


RAW_COLUMNS = 'file, "SKU", "LOCATION", "TRAN_DATE", "UNITS", "TOTAL_RETAIL"'
ZERO_FACTS = """
    SELECT b.*, CAST(0 AS DOUBLE) AS "ADJ_QTY", CAST(0 AS DOUBLE) AS "DAMAGE_QTY",
      CAST(0 AS DOUBLE) AS "STOREUSE_QTY", CAST(0 AS DOUBLE) AS "EXPIRED_QTY",
      CAST(0 AS DOUBLE) AS "SCANERR_QTY", CAST(0 AS BIGINT) AS "CC_INTRADAY_COUNT",
      CAST(0 AS BIGINT) AS "POS_CC_INTRADAY_COUNT", CAST(0 AS BIGINT) AS "NEG_CC_INTRADAY_COUNT",
      CAST(0 AS DOUBLE) AS "POS_CC_QTY", CAST(0 AS DOUBLE) AS "NEG_CC_QTY",
      coalesce("SALES_UNITS", 0) AS "SALES_UNITS",
      coalesce("SALES_TOTAL_RETAIL", 0) AS "SALES_TOTAL_RETAIL",
      coalesce("SALES_COUNT", 0) AS "SALES_COUNT",
      coalesce("BULK_SALES_UNITS", 0) AS "BULK_SALES_UNITS",
      CAST(0 AS DOUBLE) AS "RETURN_UNITS", CAST(0 AS DOUBLE) AS "INTRANSIT_RECORDED",
      CAST(0 AS DOUBLE) AS "DSD_RECORDED", CAST(0 AS DOUBLE) AS "DSD_INVC_QTY_RCPT",
      0 AS "YEAR_AUDIT_DAY_FLAG",
      coalesce("SKU_WDTH", 0) AS "SKU_WDTH", coalesce("SKU_HGT", 0) AS "SKU_HGT",
      coalesce("SKU_DPTH", 0) AS "SKU_DPTH",
      "BASE_RETAIL", "ORIG_RETAIL", "LOB", "CDIV", "CAT", "DIV", "DEPT", "CLASS",
      round(b."LOCATION" / 50) AS "LOCATION_GROUP"
    FROM snapshot b LEFT JOIN s USING ("SKU", "LOCATION", "DATE") LEFT JOIN items USING ("SKU")"""

BODIES = {
    "conform_projection": """
        SELECT "SKU", "LOCATION", "DATE", "UNITS" AS "DSD_INVC_QTY_RCPT",
               round("LOCATION" / 50) AS "LOCATION_GROUP" FROM invoices""",
    "conform_text": """
        SELECT CAST("SKU" AS INTEGER) AS "SKU", CAST("LOCATION" AS INTEGER) AS "LOCATION",
               CAST(try_strptime("TRAN_DATE", '%Y-%m-%d') AS DATE) AS "DATE",
               TRY_CAST("UNITS" AS DOUBLE) AS "SALES_UNITS",
               TRY_CAST("TOTAL_RETAIL" AS DOUBLE) AS "SALES_TOTAL_RETAIL" FROM raw""",
    "conform_historical": """
        SELECT "SKU", "LOCATION", "DATE", "UNITS" AS "RETURN_UNITS" FROM mv""",
    "conform_schedule": 'SELECT "LOCATION", "AUDIT_DATE", "DATE" FROM sched',
    "location_group_sizes": """
        SELECT round("LOCATION" / 50) AS "LOCATION_GROUP", count(*) AS rows FROM mv GROUP BY 1""",
    "date_format_check": """
        SELECT "TRAN_DATE", try_strptime("TRAN_DATE", '%Y-%m-%d') IS NOT NULL AS fits FROM raw""",
    "daily_adjustments": "SELECT * FROM a",
    "reason_splits": f"""
        SELECT {KEYS}, sum("ADJ_QTY") AS "QTY", "REASONS" FROM adj JOIN
          (VALUES ('damage', 4), ('damage', 11), ('storeuse', 10), ('expired', 14), ('scanerr', 9),
                  ('all', NULL)) AS x("REASONS", code) ON code = "REASON" OR code IS NULL
        GROUP BY "SKU", "LOCATION", "DATE", "REASONS" """,
    "daily_sales": "SELECT * FROM s",
    "daily_returns": "SELECT * FROM r",
    "daily_invoices": "SELECT * FROM v",
    "transfers_by_code": f"""
        SELECT {KEYS}, "CODE" AS "TRANSFER_CODE", sum("UNITS") AS "TRANSFER_UNITS"
        FROM transfers GROUP BY 1, 2, 3, 4""",
    "daily_transfers": "SELECT * FROM t",
    "daily_facts": f"""
        SELECT * FROM a FULL JOIN s USING ({KEYS}) FULL JOIN r USING ({KEYS})
        FULL JOIN t USING ({KEYS}) FULL JOIN v USING ({KEYS})""",
    "snapshot_balances": "SELECT * FROM snapshot",
    "date_bounds": """
        SELECT "SKU", "LOCATION", min("DATE") AS "MIN_DATE", max("DATE") AS "MAX_DATE"
        FROM inv GROUP BY 1, 2""",
    "calendar_spine": "SELECT * FROM spine",
    "closing_from_opening": f"""
        SELECT {KEYS}, "IP_QTY_BOP_INV", "IP_QTY_BOP_INTRANS", "IP_QTY_EOP_INV",
               "IP_QTY_EOP_INTRANS" FROM closed JOIN (SELECT {KEYS} FROM inv) USING ({KEYS})""",
    "densify_inventory": "SELECT * FROM dense",
    "audit_flag": "SELECT * FROM f",
    "audit_actuals": "SELECT * FROM dated",
    "carrier_rows": "SELECT * FROM trucks",
    "carrier_arrivals": "SELECT * FROM arrivals",
    "asof_forward_7d": """
        SELECT x."SKU", x."LOCATION", x."DATE", x."UNITS" AS "SALES_UNITS",
               x."CENTS" AS "SALES_TOTAL_RETAIL",
               CASE WHEN y."ACTUAL_ARRIVAL" <= x."DATE" + 7 THEN y."ACTUAL_ARRIVAL" END
                 AS "ACTUAL_ARRIVAL"
        FROM sales x ASOF LEFT JOIN arrivals y
          ON x."LOCATION" = y."LOCATION" AND x."DATE" <= y."ACTUAL_ARRIVAL" """,
    "transfers_rescheduled": "SELECT * FROM moved",
    "asof_forward_year": """
        SELECT x."SKU", x."LOCATION", x."DATE", x."UNITS" AS "SALES_UNITS",
               x."CENTS" AS "SALES_TOTAL_RETAIL",
               CASE WHEN y."ACTUAL_ARRIVAL" <= x."DATE" + 365 THEN y."ACTUAL_ARRIVAL" END
                 AS "ACTUAL_ARRIVAL"
        FROM sales x ASOF LEFT JOIN arrivals y
          ON x."LOCATION" = y."LOCATION" AND x."DATE" <= y."ACTUAL_ARRIVAL" """,
    "checks_while_writing": f"""
        SELECT unnest(['row_count', 'nulls_filled', 'price_units', 'delivery_balance']) AS "check",
               unnest([abs(n - (SELECT count(*) FROM inv)), nulls, price, balance]) AS failures
        FROM (SELECT count(*) AS n,
                CAST(sum(CAST("SALES_UNITS" IS NULL AS INTEGER)
                  + CAST("ADJ_QTY" IS NULL AS INTEGER)
                  + CAST("RETURN_UNITS" IS NULL AS INTEGER)) AS BIGINT) AS nulls,
                count(*) FILTER ("SALES_UNIT_RETAIL" <> 0 AND "SALES_UNITS" = 0) AS price,
                count(*) FILTER (("DSD_RECORDED" > 0 OR "DSD_INVC_QTY_RCPT" > 0)
                  AND abs("IP_QTY_EOP_INV" - ("IP_QTY_BOP_INV" - "SALES_UNITS" + "ADJ_QTY"
                    + "DSD_TRANSFERRED_UNITS")) > 1e-6) AS balance
              FROM ({measured(wide("snapshot"))}))""",
    "reconciled_partitions": """
        SELECT "LOCATION", "MONTH", n AS expected_rows,
               n + CASE "LOCATION" WHEN 25 THEN -third WHEN 50 THEN third ELSE 0 END AS found_rows,
               CASE "LOCATION" WHEN 25 THEN 'rows lost' WHEN 50 THEN 'rows added'
                    ELSE 'values changed' END AS fault,
               CASE "LOCATION" WHEN 75 THEN concat_ws(',', CASE WHEN fifth THEN 'RETURN_UNITS' END,
                                                 CASE WHEN seventh THEN 'ADJ_QTY' END)
                    WHEN 100 THEN 'SALES_UNITS,RETURN_UNITS,ADJ_QTY' ELSE '' END AS "columns"
        FROM (SELECT "LOCATION", CAST(date_trunc('month', "DATE") AS DATE) AS "MONTH",
                count(*) AS n, count(*) FILTER ("SKU" % 3 = 0) AS third,
                bool_or("SKU" % 5 = 0) AS fifth, bool_or("SKU" % 7 = 0) AS seventh,
                bool_or("SKU" % 11 = 3) AS replaced
              FROM inv GROUP BY 1, 2)
        WHERE CASE "LOCATION" WHEN 25 THEN third > 0 WHEN 50 THEN third > 0
              WHEN 75 THEN fifth OR seventh WHEN 100 THEN replaced END""",
    "reconciled_facts": """
        SELECT "SKU", count(*) AS expected_rows, count(*) AS found_rows,
               'values changed' AS fault, 'SALES_UNITS' AS "columns"
        FROM inv WHERE "SKU" = 3 GROUP BY 1""",
    "joined_facts": wide("snapshot"),
    "denormalized": measured(wide("snapshot")),
    "denormalized_historical": measured(wide("dense")),
    "denormalized_with_arrivals": measured(wide(
        "snapshot",
        ', coalesce("DC_TRANSFERRED_UNITS", 0) AS "DC_TRANSFERRED_UNITS", "AUDIT_UNITS"',
        f"LEFT JOIN moved USING ({KEYS}) LEFT JOIN audited USING ({KEYS})",
    )),
    "derived_measures": measured("""
        SELECT "ORD", "LN", "UNITS" AS "IP_QTY_BOP_INV", CAST("LN" * 7 AS DOUBLE)
                 AS "IP_QTY_EOP_INV", "UNITS" - "LN" AS "IP_QTY_BOP_SOH",
               CAST("LN" * 6 AS DOUBLE) AS "IP_QTY_EOP_SOH",
               CAST("LN" - 1 AS DOUBLE) AS "SALES_UNITS", "CENTS" AS "SALES_TOTAL_RETAIL",
               CAST(CASE WHEN "RF" = 'R' THEN 2 ELSE 0 END AS DOUBLE) AS "RETURN_UNITS",
               CASE WHEN "RF" = 'A' THEN "UNITS" - 25 ELSE 0 END AS "ADJ_QTY",
               CAST(CASE WHEN "LS" = 'O' THEN "LN" ELSE 0 END AS DOUBLE) AS "DSD_RECORDED",
               CAST(4 AS DOUBLE) AS "INTRANSIT_RECORDED",
               CAST(CASE WHEN "RF" = 'N' THEN 1 ELSE 0 END AS DOUBLE) AS "DSD_INVC_QTY_RCPT"
        FROM mv"""),
    "post_denorm_checks": """
        SELECT "check", CAST(failures AS BIGINT) AS failures FROM (
          SELECT 'duplicate_keys' AS "check", count(*) - count(DISTINCT ("SKU", "LOCATION", "DATE"))
                 AS failures FROM inv
          UNION ALL VALUES ('row_count', 0), ('nulls_filled', 0), ('price_units', 0),
                           ('delivery_balance', 0))""",
    "faulty_denorm_checks": f"""
        SELECT "check", CAST(failures AS BIGINT) AS failures FROM (
          WITH w AS (SELECT * FROM ({measured(wide("snapshot"))})),
          x AS (SELECT * REPLACE (CASE WHEN "SKU" % 7 <> 0 THEN "SALES_UNITS" END AS "SALES_UNITS",
                  "IP_QTY_EOP_INV" + CASE WHEN "LOCATION" % 3 = 0 THEN 1 ELSE 0 END
                    AS "IP_QTY_EOP_INV")
                FROM (SELECT * FROM w UNION ALL SELECT * FROM w WHERE "SKU" % 5 = 0))
          SELECT 'duplicate_keys' AS "check", count(*) - (SELECT count(*) FROM inv) AS failures
          FROM x
          UNION ALL SELECT 'row_count', count(*) - (SELECT count(*) FROM inv) FROM x
          UNION ALL SELECT 'nulls_filled', count(*) FROM x WHERE "SALES_UNITS" IS NULL
          UNION ALL SELECT 'price_units', count(*) FROM x
            WHERE "SALES_UNIT_RETAIL" <> 0 AND "SALES_UNITS" = 0
          UNION ALL SELECT 'delivery_balance', count(*) FROM x
            WHERE ("DSD_RECORDED" > 0 OR "DSD_INVC_QTY_RCPT" > 0) AND abs("IP_QTY_EOP_INV" -
              ("IP_QTY_BOP_INV" - "SALES_UNITS" + "ADJ_QTY" + "DSD_TRANSFERRED_UNITS")) > 1e-6)""",
    "validation_report": """
        SELECT file, 'SKU' AS "column", CASE WHEN failed = 0 THEN n ELSE 0 END AS data_type,
               n0 AS null_check, CAST(0 AS BIGINT) AS date_format FROM stats
        UNION ALL SELECT file, 'TRAN_DATE', CASE WHEN failed = 1 THEN n ELSE 0 END, n1, d1
        FROM stats
        UNION ALL SELECT file, 'UNITS', CASE WHEN failed = 2 THEN n ELSE 0 END, n2, 0 FROM stats
        UNION ALL SELECT file, 'TOTAL_RETAIL', CASE WHEN failed = 3 THEN n ELSE 0 END, n3, 0
        FROM stats""",
    "invalid_rows": f"SELECT {RAW_COLUMNS} FROM judged WHERE is_invalid",
    "valid_rows": f"SELECT {RAW_COLUMNS} FROM judged WHERE NOT is_invalid",
    "file_error_counts": "SELECT * FROM counts",
    "file_error_rates": "SELECT * FROM rates",
    "quarantine_routes": """
        SELECT uri, c.file_date, c."table",
               CASE WHEN late AND over_threshold THEN 'validation_threshold_error/missed_files'
                    WHEN late THEN 'missed_files'
                    WHEN over_threshold THEN 'validation_threshold_error/required_files'
                    ELSE 'pass' END AS route
        FROM counts c JOIN rates USING (file_date, "table")
        JOIN (SELECT file_date, count(DISTINCT "table") < 2 AS late FROM counts GROUP BY 1) l
          ON l.file_date = c.file_date""",
    "route_files": """
        SELECT 'drop/in/' || name AS path, name,
               CASE WHEN ok THEN src ELSE '' END AS "table",
               CASE WHEN ok THEN spelled ELSE '' END AS file_date,
               CASE WHEN ok AND defect = 0 THEN 'extension_error' WHEN ok THEN 'all_valid'
                    ELSE 'file_name_error' END AS "class",
               CASE WHEN ok AND defect = 0 THEN 'extension_error/' || src || '/' || name
                    WHEN ok THEN src || '/' || name ELSE 'file_name_error/' || name END
                 AS destination
        FROM (SELECT *, defect NOT IN (1, 2) AND src <> 'FD_MARKDOWNS' AS ok FROM dropped)""",
    "received_by_date": 'SELECT DISTINCT file_date, "table" FROM received',
    "missing_mandatory": """
        SELECT file_date, coalesce(nullif(concat_ws(',',
                 CASE WHEN NOT bool_or("table" = 'FD_PHYSICAL_INV_ADJUSTMENTS')
                      THEN 'FD_PHYSICAL_INV_ADJUSTMENTS' END,
                 CASE WHEN NOT bool_or("table" = 'FD_STORE_INV') THEN 'FD_STORE_INV' END), ''),
                 'None') AS missing
        FROM received GROUP BY 1""",
    "released_files": """
        SELECT path, "table", file_date, 'run' || part AS first_run,
               CASE WHEN whole IS NOT NULL THEN 'run' || greatest(part, whole) END AS taken_run
        FROM accepted LEFT JOIN (
          SELECT file_date, max(came) AS whole FROM (
            SELECT file_date, "table", min(part) AS came FROM accepted
            WHERE "table" IN ('FD_STORE_INV', 'FD_PHYSICAL_INV_ADJUSTMENTS') GROUP BY 1, 2)
          GROUP BY 1 HAVING count(*) = 2) USING (file_date)""",
    "latest_failures": "SELECT * FROM latest",
    "fill_dates": """
        SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
        FROM stated_log""",
    "plan_dates": """
        SELECT file_date FROM (
          SELECT strftime(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)), '%Y%m%d')
                 AS file_date FROM stated
          UNION SELECT '20240215')
        WHERE file_date NOT IN ('20240110', '20240116') ORDER BY 1""",
    "files_of_days": "SELECT * FROM hits",
    "run_log_rows": "SELECT * FROM log_rows",
    "day_paths": """
        SELECT file_date, CASE WHEN bool_or(priority = 'critical') THEN 'error' ELSE 'output' END
                 AS path
        FROM log_rows GROUP BY 1""",
    "missing_from_log": "SELECT * FROM mfl",
    "log_consistency": """
        SELECT *, 'stated' AS only_in FROM (FROM claimed EXCEPT ALL FROM mfl)
        UNION ALL SELECT *, 'logged' FROM (FROM mfl EXCEPT ALL FROM claimed)""",
    "raw_csv_scan": """
        SELECT "SKU", "LOCATION", nullif("TRAN_DATE", '') AS "TRAN_DATE", "UNITS", "TOTAL_RETAIL"
        FROM raw""",
    "typed_csv_scan": """
        SELECT CAST("SKU" AS INTEGER) AS "SKU", CAST("LOCATION" AS INTEGER) AS "LOCATION",
               CAST(try_strptime("TRAN_DATE", '%Y-%m-%d') AS DATE) AS "DATE",
               TRY_CAST("UNITS" AS DOUBLE) AS "SALES_UNITS",
               TRY_CAST("TOTAL_RETAIL" AS DOUBLE) AS "SALES_TOTAL_RETAIL" FROM raw""",
    "mixed_header_scan": """
        SELECT "SKU", "LOCATION", nullif("TRAN_DATE", '') AS "TRAN_DATE", "UNITS",
               CASE WHEN "LOCATION" <> '25' THEN "TOTAL_RETAIL" END AS "TOTAL_RETAIL" FROM raw""",
    "header_verdicts": """
        SELECT CASE "LOCATION" WHEN '25' THEN 'UNITS,NOTE,TOTAL_RETAIL,LOCATION,SKU,TRAN_DATE'
                    WHEN '50' THEN 'SKU,LOCATION,TRAN_DATE,UNITS'
                    ELSE 'SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL' END AS header,
               CASE "LOCATION" WHEN '50' THEN 'TOTAL_RETAIL' END AS lacking,
               count(*) FILTER ("LOCATION" = '50' OR coalesce("TRAN_DATE", '') IN ('', '2021-13-01')
                 OR coalesce("UNITS", ' ') = ' ') AS error_row_count,
               count(*) AS original_row_count
        FROM raw WHERE src = 'FD_SALES' GROUP BY 1, 2""",
    "malformed_lines": """
        SELECT "SKU", "LOCATION", nullif("TRAN_DATE", '') AS "TRAN_DATE", "UNITS",
               CASE WHEN "LOCATION" = '125' THEN "TOTAL_RETAIL" END AS "TOTAL_RETAIL",
               "SKU" || ',' || "LOCATION" || ',' || coalesce("TRAN_DATE", '') || ','
                 || coalesce("UNITS", '')
                 || CASE WHEN "LOCATION" = '125' THEN ',' || coalesce("TOTAL_RETAIL", '') || ',more'
                         ELSE '' END AS line
        FROM raw WHERE "LOCATION" IN ('75', '125')""",
    "manifest_tables": 'SELECT DISTINCT src AS "table" FROM raw',
    "preprocess_passed": """
        SELECT CAST("SKU" AS INTEGER) AS "SKU", CAST("LOCATION" AS INTEGER) AS "LOCATION",
               nullif("TRAN_DATE", '') AS "TRAN_DATE", TRY_CAST("UNITS" AS DOUBLE) AS "UNITS",
               "TOTAL_RETAIL", round(CAST("LOCATION" AS INTEGER) / 50) AS "LOCATION_GROUP"
        FROM raw WHERE src = 'FD_RETURNS'""",
    "invalid_rows_csv": """
        SELECT file AS dropped, "SKU", "LOCATION", nullif("TRAN_DATE", '') AS "TRAN_DATE", "UNITS",
               "TOTAL_RETAIL" FROM judged WHERE is_invalid""",
    "partitioned_table": """
        SELECT "SKU", "LOCATION", "DATE", "UNITS" AS "SALES_UNITS", "CENTS" AS "SALES_TOTAL_RETAIL",
               round("LOCATION" / 50) AS "LOCATION_GROUP"
        FROM sales WHERE round("LOCATION" / 50) IN (1, 3)""",
    "location_groups": """
        SELECT DISTINCT round("LOCATION" / 50) AS "LOCATION_GROUP" FROM inv""",
    "master_table": "SELECT * FROM items",
    "optional_sources": measured(ZERO_FACTS),
    "written_denormalized": f"""
        SELECT *, round("LOCATION" / 50) AS "LOCATION_GROUP" FROM ({measured(wide("snapshot"))})""",
    "merge_rows": """
        SELECT "SKU", "LOCATION", "DATE",
               CASE WHEN "DATE" >= DATE '2021-09-01' AND "SKU" % 2 = 0 THEN 2 ELSE 1 END
                 * "SALES_UNITS" AS "SALES_UNITS",
               round("LOCATION" / 50) AS "LOCATION_GROUP",
               CAST(date_trunc('month', "DATE") AS DATE) AS "MONTH" FROM s
        UNION ALL
        SELECT -"SKU" - 1, "LOCATION", "DATE", "SALES_UNITS", round("LOCATION" / 50),
               CAST(date_trunc('month', "DATE") AS DATE)
        FROM s WHERE "DATE" >= DATE '2021-09-01' AND "SKU" % 2 = 0""",
    "densify_batches": "SELECT * FROM dense",
    "merge_partitions": """
        SELECT "SKU", "LOCATION", "DATE",
               CASE WHEN "DATE" >= DATE '2021-09-01' THEN 2 ELSE 1 END * "SALES_UNITS"
                 AS "SALES_UNITS",
               round("LOCATION" / 50) AS "LOCATION_GROUP",
               CAST(date_trunc('month', "DATE") AS DATE) AS "MONTH" FROM s""",
}


def oracle() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
