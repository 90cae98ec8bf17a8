"""Check SQL for parsing, merge and sync history."""

from ratelens.oracle.views import big, n_where, r, with_views

# The accepted spelling of a number, and the columns in order with their kind, written out anew so that a wrong constant shows.
NUMBER = "[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"
KINDS = """Company text, Subsidiary text, State text, Product_Line text, Rate_Change_Type text, Premium_Change_Number number,
Premium_Change_Amount_Text text, Effective_Date date, Previous_Increase_Date date, Previous_Increase_Number number,
Policyholders_Affected_Number whole, Policyholders_Affected_Text text, Total_Written_Premium_Number number,
Total_Written_Premium_Text text, SERFF_Tracking_Number text, Specific_Coverages text, Filing_Method text, Current_Status text,
Date_Submitted date, Disposition_Date date, Stated_Reasons text, Population text, Impact_Score number, Renewals_Date date,
Airtable_Last_Modified time"""
FIELDS = [field.split() for field in KINDS.split(",")]


def number(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), '{NUMBER}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def iso_date(text: str) -> str:
    return f"CAST(try_strptime(trim({text}), '%Y-%m-%d') AS DATE)"


TIME = "CAST(try_strptime(last_modified_raw, '%Y-%m-%dT%H:%M:%S.%gZ') AS TIMESTAMP)"

RATE = f"TRY_CAST({number('rate_change_raw')} AS DECIMAL(10,4))"
PREMIUM = f"TRY_CAST({number('premium_raw')} AS DECIMAL(15,2))"
_N = number("policyholders_raw")
POLICIES = f"CASE WHEN ({_N}) = FLOOR({_N}) AND abs({_N}) <= 2147483647 THEN CAST({_N} AS BIGINT) END"
CUT_OFF = "(page % 10 = 3 AND split_part(id, '-', 2) = '2')"

# What the raw records hold for each column; all other columns stay empty.
GIVEN = {
    "Company": "COALESCE(parent_company, '')",
    "Subsidiary": "COALESCE(filing_company, '')",
    "State": "COALESCE(impacted_state, '')",
    "Product_Line": "COALESCE(product_line, '')",
    "Premium_Change_Number": f"CAST({RATE} AS DOUBLE)",
    "Effective_Date": iso_date("effective_date_raw"),
    "Policyholders_Affected_Number": POLICIES,
    "Total_Written_Premium_Number": f"CAST({PREMIUM} AS DOUBLE)",
    "Airtable_Last_Modified": TIME,
}
EMPTY = {"whole": "CAST(NULL AS BIGINT)", "text": "''", "number": "CAST(NULL AS DOUBLE)", "date": "CAST(NULL AS DATE)", "time": "CAST(NULL AS TIMESTAMP)"}

TYPED = ", ".join(f"{GIVEN.get(column, EMPTY[kind])} AS {column}" for column, kind in FIELDS)


def unparsed(text: str, parsed: str) -> str:
    return f"({text} IS NOT NULL AND {text} <> '' AND {parsed} IS NULL)"


LAST = """last AS (SELECT sync_id, completed_at FROM sync_history WHERE status = 'completed' AND completed_at IS NOT NULL
 ORDER BY completed_at DESC, sync_id DESC LIMIT 1)"""

MERGE = """j AS (SELECT b.Record_ID, t.Record_ID IS NULL AS is_new, b.Airtable_Last_Modified > t.Airtable_Last_Modified AS newer
 FROM sync_batch b LEFT JOIN sync_target t ON b.Record_ID = t.Record_ID)"""


def profile(column: str) -> str:
    kind = f"""CASE WHEN {column} IS NULL THEN 'null' WHEN {column} = '' THEN 'empty' WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+') THEN 'integer'
 WHEN regexp_full_match(trim({column}), '{NUMBER}') THEN 'decimal' WHEN regexp_matches(trim({column}), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date' ELSE 'text' END"""
    return f"""WITH v AS (SELECT {kind} AS value_type, {column} AS value, COUNT(*) AS n FROM raw_records GROUP BY 1, 2),
e AS (SELECT value_type, COALESCE(string_agg(value, ' | ' ORDER BY value), '') AS examples FROM
 (SELECT * FROM v QUALIFY ROW_NUMBER() OVER (PARTITION BY value_type ORDER BY value NULLS LAST) <= 3) x GROUP BY 1)
SELECT v.value_type, {big('SUM(n)')} AS records, MIN(value) AS min_value, MAX(value) AS max_value, MAX(examples) AS examples
FROM v JOIN e ON v.value_type = e.value_type GROUP BY v.value_type"""


def checked(field: str) -> str:
    parsed = number(field)
    return f"""SELECT '{field}' AS field, {n_where(f'({parsed}) IS NOT NULL')} AS valid, {n_where(unparsed(field, f'({parsed})'))} AS invalid,
 {n_where(f"COALESCE({field} = '', TRUE)")} AS empty FROM raw_records"""


SQL = {
    "filings_scan": with_views(
        "filings",
        """SELECT Record_ID, Company, State, CAST(Premium_Change_Number AS DOUBLE) AS Premium_Change_Number FROM filings
WHERE Effective_Date >= DATE '2000-06-17' AND Premium_Change_Number > 0""",
    ),
    "raw_to_filings": with_views("raw_records", f"SELECT id AS Record_ID, {TYPED} FROM raw_records WHERE NOT {CUT_OFF}"),
    "parse_number": with_views(
        "raw_records", f"SELECT id, rate_change_raw AS raw, {number('rate_change_raw')} AS parsed FROM raw_records"
    ),
    "parse_date": with_views(
        "date_texts",
        "SELECT id, raw, CASE WHEN raw NOT IN ('', 'invalid') THEN Effective_Date END AS parsed FROM date_texts",
    ),
    "parse_timestamp": with_views(
        "raw_records", f"SELECT id, last_modified_raw AS raw, {TIME} AS parsed FROM raw_records"
    ),
    "parse_error_count": with_views(
        "raw_records",
        f"""SELECT page, {big('COUNT(*)')} AS records, {n_where(' OR '.join([
            CUT_OFF,
            unparsed('rate_change_raw', RATE),
            unparsed('effective_date_raw', iso_date('effective_date_raw')),
            unparsed('policyholders_raw', f"({POLICIES})"),
            unparsed('premium_raw', PREMIUM),
        ]))} AS parsing_errors FROM raw_records GROUP BY page""",
    ),
    "sync_run": with_views(
        "raw_records",
        f"""WITH known AS (SELECT *, {TIME} AS modified, {CUT_OFF} AS cut_off, ({' OR '.join([
            CUT_OFF,
            unparsed('rate_change_raw', RATE),
            unparsed('effective_date_raw', iso_date('effective_date_raw')),
            unparsed('policyholders_raw', f"({POLICIES})"),
            unparsed('premium_raw', PREMIUM),
        ])}) AS broken FROM raw_records),
a AS (SELECT * FROM known WHERE page % 3 <> 0),
stored AS (SELECT {big('COUNT(*)')} AS n, CAST(SUM({RATE}) AS DOUBLE) AS rates, {big(f'SUM({POLICIES})')} AS policies FROM known WHERE NOT cut_off)
SELECT CAST(1 AS BIGINT) AS sync_id, 'full' AS sync_mode, 'completed' AS status, {n_where('NOT cut_off')} AS records_processed, {n_where('NOT cut_off')} AS records_inserted,
 {big('0')} AS records_updated, {big('0')} AS records_skipped, {n_where('broken')} AS parsing_errors, (SELECT n FROM stored) AS stored_rows,
 (SELECT rates FROM stored) AS stored_rates, (SELECT policies FROM stored) AS stored_policies FROM a
UNION ALL SELECT 2, 'manual', 'completed', {n_where('NOT cut_off')}, {n_where('NOT cut_off AND page % 3 = 0')}, 0, {n_where('NOT cut_off AND page % 3 <> 0')}, {n_where('broken')},
 (SELECT n FROM stored), (SELECT rates FROM stored), (SELECT policies FROM stored) FROM known""",
    ),
    "sync_mode_resolve": with_views(
        "sync_history",
        f"""WITH {LAST} SELECT 'default' AS asked, CASE WHEN COUNT(*) = 0 THEN 'full' ELSE 'incremental' END AS sync_mode, MAX(completed_at) AS since FROM last
UNION ALL SELECT 'manual', 'manual', TIMESTAMP '2024-01-01 00:00:00' UNION ALL SELECT 'full', 'full', NULL""",
    ),
    "incremental_filter": with_views(
        "raw_records",
        f"SELECT id, {TIME} AS modified FROM raw_records WHERE {TIME} > TIMESTAMP '2001-06-17 10:35:00' - INTERVAL 5 MINUTE",
    ),
    "duplicate_id_guard": with_views(
        "raw_pages", f"SELECT id, {big('COUNT(*)')} AS copies FROM raw_pages GROUP BY id HAVING COUNT(*) > 1"
    ),
    "upsert_newer_wins": with_views(
        "sync_target sync_batch",
        """SELECT COALESCE(t.Record_ID, b.Record_ID) AS Record_ID, CASE WHEN w THEN b.Company ELSE t.Company END AS Company, CASE WHEN w THEN b.State ELSE t.State END AS State,
 CAST(CASE WHEN w THEN b.Premium_Change_Number ELSE t.Premium_Change_Number END AS DOUBLE) AS Premium_Change_Number,
 CASE WHEN w THEN b.Effective_Date ELSE t.Effective_Date END AS Effective_Date, t.SERFF_Tracking_Number,
 CASE WHEN w THEN b.Airtable_Last_Modified ELSE t.Airtable_Last_Modified END AS Airtable_Last_Modified
FROM (SELECT t.Record_ID AS tid, b.Record_ID AS bid, COALESCE(t.Record_ID IS NULL OR b.Airtable_Last_Modified > t.Airtable_Last_Modified, FALSE) AS w
  FROM sync_target t FULL OUTER JOIN sync_batch b ON t.Record_ID = b.Record_ID) k
 LEFT JOIN sync_target t ON k.tid = t.Record_ID LEFT JOIN sync_batch b ON k.bid = b.Record_ID""",
    ),
    "upsert_change_counts": with_views(
        "sync_target sync_batch",
        f"""WITH {MERGE} SELECT {big('COUNT(*)')} AS records_processed, {n_where('is_new')} AS records_inserted, {n_where('NOT is_new AND newer')} AS records_updated,
 {n_where('NOT is_new AND NOT newer')} AS records_skipped, {big('COUNT(CASE WHEN is_new THEN 1 END) + (SELECT COUNT(*) FROM sync_target)')} AS total_records FROM j""",
    ),
    "sync_status": with_views(
        "sync_history filings_ext",
        f"""WITH l AS (SELECT * FROM sync_history ORDER BY started_at DESC, sync_id DESC LIMIT 1),
t AS (SELECT {big('COUNT(*)')} AS total_filings, {big('COUNT(Airtable_Last_Modified)')} AS with_timestamps FROM filings_ext)
SELECT sync_id, started_at, completed_at, sync_mode, status, records_processed, total_filings, with_timestamps,
 {r('CAST(with_timestamps AS DOUBLE) / total_filings * 100', 1)} AS with_timestamps_pct FROM l, t""",
    ),
    "sync_history_recent": with_views(
        "sync_history",
        """SELECT sync_id, started_at, sync_mode, status, COALESCE(records_processed, 0) AS records_processed FROM sync_history
ORDER BY started_at DESC, sync_id DESC LIMIT 10""",
    ),
    "last_successful_sync": with_views("sync_history", f"WITH {LAST} SELECT * FROM last"),
    "sync_mode_backfill": with_views(
        "sync_history",
        """SELECT * REPLACE (CASE WHEN sync_mode = 'unknown' THEN CASE WHEN sync_id = 1 THEN 'full' ELSE 'incremental' END ELSE sync_mode END AS sync_mode)
FROM sync_history""",
    ),
    "schema_conform": with_views(
        "old_filings",
        f"""SELECT Record_ID, Company, CAST(NULL AS STRING) AS Subsidiary, State, CAST(NULL AS STRING) AS Product_Line, CAST(NULL AS STRING) AS Rate_Change_Type,
 CAST(Premium_Change_Number AS DOUBLE) AS Premium_Change_Number, CAST(NULL AS STRING) AS Premium_Change_Amount_Text, Effective_Date,
 CAST(NULL AS DATE) AS Previous_Increase_Date,
 CAST(CAST(CAST({number("replace(Previous_Increase_Percentage, '%', '')")} AS DECIMAL(18,6)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(10,4)) AS DOUBLE) AS Previous_Increase_Number,
 CAST(NULL AS BIGINT) AS Policyholders_Affected_Number, CAST(NULL AS STRING) AS Policyholders_Affected_Text,
 CAST(NULL AS DOUBLE) AS Total_Written_Premium_Number, CAST(NULL AS STRING) AS Total_Written_Premium_Text,
 CAST(NULL AS STRING) AS SERFF_Tracking_Number, CAST(NULL AS STRING) AS Specific_Coverages, CAST(NULL AS STRING) AS Stated_Reasons,
 CAST(NULL AS STRING) AS Population, CAST(NULL AS DOUBLE) AS Impact_Score, CAST(NULL AS DATE) AS Renewals_Date,
 CAST(NULL AS TIMESTAMP) AS Created_At, CAST(NULL AS TIMESTAMP) AS Updated_At, CAST(NULL AS TIMESTAMP) AS Airtable_Last_Modified FROM old_filings""",
    ),
    "field_value_profile": with_views("raw_records", profile("policyholders_raw")),
    "diagnose_rate_change": with_views(
        "raw_records",
        f"""WITH s AS (SELECT id, rate_change_raw AS raw FROM raw_records ORDER BY id LIMIT 1000)
SELECT {n_where(f"({number('raw')}) IS NOT NULL")} AS valid_count,
 COALESCE(string_agg(CASE WHEN {unparsed('raw', f"({number('raw')})")} THEN concat(id, '=', raw) END, '|' ORDER BY id, raw), '') AS issues FROM s""",
    ),
    "validate_numeric_fields": with_views(
        "raw_records",
        " UNION ALL ".join(checked(f) for f in ("rate_change_raw", "policyholders_raw", "premium_raw")),
    ),
    "updated_since": with_views(
        "filings_ext",
        f"SELECT {big('COUNT(*)')} AS total, {n_where("Updated_At > TIMESTAMP '2001-06-17 00:00:00'")} AS updated FROM filings_ext",
    ),
    "timestamp_coverage": with_views(
        "filings_ext",
        f"""SELECT {big('COUNT(*)')} AS total, {big('COUNT(Airtable_Last_Modified)')} AS with_timestamp,
 {n_where('Airtable_Last_Modified IS NULL')} AS without_timestamp FROM filings_ext""",
    ),
}
