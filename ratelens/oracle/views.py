"""The stand-in tables of ``ratelens.sources.tables`` as SQL for the result checks."""

from __future__ import annotations

from ratelens.functions.states import STATE_ABBREVIATIONS

AS_OF = "DATE '2001-06-17'"

_LINE = "split_part(Record_ID, '-', 2)"
_STATE_NAMES = ", ".join(f"'{n}'" for n in [*STATE_ABBREVIATIONS, "PUERTO RICO"])

# name -> (views it builds on, text)
VIEWS: dict[str, tuple[list[str], str]] = {
    "filings": (
        [],
        """SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
       CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING)) AS Record_ID,
  s_name AS Company, p_brand AS Subsidiary, n_name AS State, p_type AS Product_Line,
  CAST((CAST(round(l_discount*100) AS INT)-4)*3*0.01 AS DECIMAL(10,4)) AS Premium_Change_Number,
  CAST(l_shipdate AS DATE) AS Effective_Date,
  CASE WHEN l_linenumber=7 THEN NULL ELSE CAST(l_quantity AS INT)*100 END AS Policyholders_Affected_Number,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS Total_Written_Premium_Number,
  CASE WHEN l_linenumber=6 THEN NULL ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS Impact_Score
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN nation ON c_nationkey=n_nationkey JOIN supplier ON l_suppkey=s_suppkey JOIN part ON l_partkey=p_partkey""",
    ),
    "filings_ext": (
        ["filings"],
        """SELECT f.*,
 CASE WHEN Premium_Change_Number > 0 THEN 'increase' WHEN Premium_Change_Number < 0 THEN 'decrease' ELSE 'no change' END AS Rate_Change_Type,
 concat('SERFF-', Record_ID) AS SERFF_Tracking_Number,
 CAST(Effective_Date - INTERVAL '365' DAY AS DATE) AS Previous_Increase_Date,
 CAST(Premium_Change_Number * 0.5 AS DECIMAL(10,4)) AS Previous_Increase_Number,
 CAST(Effective_Date + INTERVAL '30' DAY AS DATE) AS Renewals_Date,
 CAST(Effective_Date AS TIMESTAMP) AS Airtable_Last_Modified,
 CAST(Effective_Date AS TIMESTAMP) + INTERVAL '1' DAY AS Updated_At
FROM filings f""",
    ),
    "filings_gap": (
        ["filings"],
        "SELECT * FROM filings WHERE NOT (State = 'NATION_7' AND Effective_Date >= DATE '2001-01-01')",
    ),
    "filings_copies": (
        ["filings"],
        f"""SELECT * FROM filings UNION ALL
SELECT * REPLACE (concat(Record_ID, '-copy') AS Record_ID) FROM filings WHERE {_LINE} = '3'""",
    ),
    "filings_unnamed": (
        ["filings"],
        f"""SELECT * REPLACE (
 CASE {_LINE} WHEN '3' THEN 'Not specified in document' WHEN '4' THEN '' WHEN '5' THEN NULL ELSE Company END AS Company,
 CASE WHEN {_LINE} = '4' THEN NULL ELSE Subsidiary END AS Subsidiary) FROM filings""",
    ),
    "old_filings": (
        ["filings"],
        f"""SELECT Record_ID, Company, State, CAST(Premium_Change_Number AS DECIMAL(10,2)) AS Premium_Change_Number, Effective_Date,
 CASE {_LINE} WHEN '1' THEN '' WHEN '2' THEN 'n/a'
  ELSE concat(CAST(CAST(Premium_Change_Number * 50 AS DECIMAL(10,1)) AS STRING), '%') END AS Previous_Increase_Percentage
FROM filings""",
    ),
    "raw_records": (
        ["filings"],
        f"""SELECT Record_ID AS id, CAST(FLOOR(CAST(split_part(Record_ID, '-', 1) AS BIGINT) / 100) AS BIGINT) AS page,
 Company AS parent_company, Subsidiary AS filing_company, State AS impacted_state, Product_Line AS product_line,
 CASE {_LINE} WHEN '1' THEN '' WHEN '2' THEN 'invalid'
   WHEN '3' THEN concat(' ', CAST(Premium_Change_Number AS STRING), ' ') WHEN '6' THEN '12345678'
   ELSE CAST(Premium_Change_Number AS STRING) END AS rate_change_raw,
 CASE {_LINE} WHEN '4' THEN '' WHEN '5' THEN 'invalid' ELSE CAST(Effective_Date AS STRING) END AS effective_date_raw,
 concat(CAST(Effective_Date AS STRING), 'T10:30:00.000Z') AS last_modified_raw,
 CASE {_LINE} WHEN '5' THEN '1_000' WHEN '6' THEN 'about 500' WHEN '7' THEN '9999999999' WHEN '4' THEN '12.9'
   ELSE CAST(Policyholders_Affected_Number AS STRING) END AS policyholders_raw,
 CASE {_LINE} WHEN '7' THEN '1e14' ELSE CAST(Total_Written_Premium_Number AS STRING) END AS premium_raw
FROM filings""",
    ),
    "raw_pages": (
        [],
        """SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS id,
 CAST(FLOOR(l_partkey / 20) AS BIGINT) AS page FROM lineitem""",
    ),
    "date_texts": (
        ["filings"],
        f"""SELECT Record_ID AS id, Effective_Date, CASE {_LINE}
 WHEN '1' THEN strftime(Effective_Date, '%m/%d/%Y') WHEN '2' THEN concat(CAST(Effective_Date AS STRING), 'T10:30:00.000Z')
 WHEN '3' THEN concat(' ', CAST(Effective_Date AS STRING), ' ') WHEN '4' THEN '' WHEN '5' THEN 'invalid'
 ELSE CAST(Effective_Date AS STRING) END AS raw FROM filings""",
    ),
    "sync_target": (["filings_ext"], "SELECT * FROM filings_ext WHERE Effective_Date < DATE '2001-01-01'"),
    "sync_batch": (
        ["filings_ext"],
        f"""SELECT Record_ID, Company, State, CAST(Premium_Change_Number * 2 AS DECIMAL(10,4)) AS Premium_Change_Number, Effective_Date,
 CASE WHEN {_LINE} IN ('2', '4', '6') THEN Airtable_Last_Modified + INTERVAL '1' DAY
      ELSE Airtable_Last_Modified - INTERVAL '1' DAY END AS Airtable_Last_Modified
FROM filings_ext WHERE Effective_Date >= DATE '2000-12-01'""",
    ),
    "sync_history": (
        [],
        """SELECT event_id AS sync_id, ts AS started_at,
 CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE ts + INTERVAL '90' SECOND END AS completed_at,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(FLOOR(value * 10) AS BIGINT) END AS records_processed,
 CAST(event_id % 4 AS BIGINT) AS parsing_errors,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'completed' END AS status,
 CASE WHEN event_id % 10 = 0 THEN 'full' WHEN event_id % 10 = 1 THEN 'unknown' ELSE 'incremental' END AS sync_mode
FROM events""",
    ),
    "reports": (
        ["filings"],
        """SELECT concat('rep-', State, '-', CAST(ym AS STRING)) AS report_id,
 concat(State, ' ', strftime(ym, '%B %Y')) AS Name, State,
 CASE CAST(split_part(State, '_', 2) AS INT) % 3 WHEN 0 THEN strftime(ym, '%m') WHEN 1 THEN strftime(ym, '%B') ELSE strftime(ym, '%b') END AS Month,
 CAST(EXTRACT(YEAR FROM ym) AS STRING) AS Year,
 CASE CAST(EXTRACT(MONTH FROM ym) AS INT) % 3 WHEN 0 THEN 'Generated' WHEN 1 THEN 'Approved' ELSE 'Sent' END AS Status
FROM (SELECT DISTINCT State, CAST(date_trunc('month', Effective_Date) AS DATE) AS ym FROM filings) t
WHERE (EXTRACT(YEAR FROM ym) * 12 + EXTRACT(MONTH FROM ym) + 3 * CAST(split_part(State, '_', 2) AS INT)) % 7 <> 0""",
    ),
    "subscribers": (
        [],
        """SELECT concat('sub-', CAST(c_custkey AS STRING)) AS subscriber_id,
 CASE WHEN c_custkey % 10 = 0 AND n_name <> 'NATION_1' THEN concat(n_name, ',NATION_1') ELSE n_name END AS State,
 CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'bad-address'
   ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS Email,
 c_acctbal > 0 AS Active, c_custkey % 50 = 0 AS Test
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "emails": (
        [],
        """SELECT concat('msg-', CAST(user_id AS STRING)) AS message_id, concat('sub-', CAST(user_id AS STRING)) AS subscriber_id
FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    ),
    "email_events": (
        [],
        """SELECT event_id, ts, CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('msg-', CAST(user_id AS STRING)) END AS message_id,
 CASE event_type WHEN 'signup' THEN 'Delivery' WHEN 'view' THEN 'Open' WHEN 'click' THEN 'Open'
   WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Bounce' ELSE 'SpamComplaint' END
   ELSE CASE WHEN event_id % 5 = 0 THEN 'Unsubscribe' ELSE 'Click' END END AS record_type,
 CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'HardBounce' END AS bounce_type,
 CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN concat('mailbox ', CAST(user_id AS STRING)) END AS description
FROM events""",
    ),
    "agents": (
        [],
        """SELECT concat('agent-', CAST(s_suppkey AS STRING)) AS agent_id, s_name AS name, lower(n_name) AS state,
 CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat('a', CAST(s_suppkey AS STRING), '@example.com') END AS email
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "carrier_names": (
        [],
        """SELECT CASE s_suppkey % 10
 WHEN 0 THEN concat('State Farm MutualAutomobileInsuranceCompany ', s_suppkey)
 WHEN 1 THEN concat('Progressive PropertyandCasualtyInsuranceCompany ', s_suppkey)
 WHEN 2 THEN concat('Allstate Fire and Casualty ', s_suppkey)
 WHEN 3 THEN concat('Geico ', s_suppkey)
 WHEN 4 THEN concat('Farmers InsuranceCompany ', s_suppkey)
 WHEN 5 THEN concat('Liberty Mutual Fire and Marine ', s_suppkey)
 WHEN 6 THEN concat('Property and Home InsuranceCompany of Region ', s_suppkey)
 WHEN 7 THEN concat('Auto', s_suppkey)
 WHEN 8 THEN concat(' acme mutual ', s_suppkey)
 ELSE s_name END AS Company FROM supplier""",
    ),
    "state_texts": (
        [],
        f"""SELECT CASE c_custkey % 4 WHEN 0 THEN lower(name)
 WHEN 1 THEN concat(' ', array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(lower(name), ' ')], ' '), ' ')
 WHEN 2 THEN substring(name, 1, 2) ELSE name END AS state_text
FROM (SELECT c_custkey, list_extract([{_STATE_NAMES}], CAST(c_custkey % {len(STATE_ABBREVIATIONS) + 1} + 1 AS INT)) AS name FROM customer) c""",
    ),
    "month_texts": (
        [],
        """SELECT CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%B') WHEN 1 THEN strftime(o_orderdate, '%b')
 WHEN 2 THEN strftime(o_orderdate, '%m') ELSE 'soon' END AS month_text FROM orders""",
    ),
    "unsubscribe_requests": (
        [],
        """SELECT concat('sub-', CAST(c_custkey AS STRING)) AS subscriber_id,
 CASE c_custkey % 3 WHEN 0 THEN md5(concat('sub-', CAST(c_custkey AS STRING), '-letters'))
   WHEN 1 THEN md5(concat('sub-', CAST(c_custkey AS STRING))) END AS token FROM customer""",
    ),
    "source_filings": (
        ["filings"],
        f"""SELECT CASE {_LINE} WHEN '6' THEN '' WHEN '5' THEN NULL ELSE Record_ID END AS filing_id,
 concat('  ', Company, ' ') AS company_name, lower(State) AS state,
 CASE {_LINE} WHEN '1' THEN 'auto' WHEN '2' THEN 'home' WHEN '3' THEN 'boat' END AS filing_type,
 CASE {_LINE} WHEN '1' THEN 'approved' WHEN '4' THEN 'lost' END AS status,
 Effective_Date AS effective_date,
 CASE WHEN {_LINE} = '2' THEN NULL ELSE CAST(Effective_Date AS TIMESTAMP) END AS last_updated,
 CAST(Premium_Change_Number * 100 AS DOUBLE) AS rate_change_percent FROM filings""",
    ),
}


def _needed(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for part in [*_needed(VIEWS[name][0]), name]:
            if part not in ordered:
                ordered.append(part)
    return ordered


def with_views(names: str, body: str) -> str:
    """``body`` with the named views put before it; ``body`` may begin with its own WITH."""
    parts = [f"{name} AS ({VIEWS[name][1]})" for name in _needed(names.split())]
    body = body.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def r(value: str, digits: int) -> str:
    """Half-up rounding on a decimal copy."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def avg_pct(where: str | None = None, value: str = "Premium_Change_Number") -> str:
    kept = value if where is None else f"CASE WHEN {where} THEN {value} END"
    return f"(CAST(SUM({kept}) AS DOUBLE) * 100 / COUNT({kept}))"


def n_where(condition: str) -> str:
    return f"CAST(COUNT(CASE WHEN {condition} THEN 1 END) AS BIGINT)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def short_number(value: str) -> str:
    def scaled(factor: str, suffix: str) -> str:
        return (
            f"concat(regexp_replace(CAST(ROUND(CAST({value} AS DECIMAL(18,0)) * CAST({factor} AS DECIMAL(18,9)), 1)"
            f" AS STRING), '\\.0$', ''), '{suffix}')"
        )

    return (
        f"CASE WHEN {value} IS NULL THEN 'N/A' WHEN {value} < 1000 THEN CAST({value} AS STRING)"
        f" WHEN {value} < 1000000 THEN {scaled('0.001', 'K')} WHEN {value} < 1000000000 THEN {scaled('0.000001', 'M')}"
        f" ELSE {scaled('0.000000001', 'B')} END"
    )


def state_abbr(value: str) -> str:
    cases = " ".join(f"WHEN '{n}' THEN '{a}'" for n, a in STATE_ABBREVIATIONS.items())
    return f"CASE upper(trim({value})) {cases} ELSE substring(upper(trim({value})), 1, 2) END"


def one_decimal(value: str) -> str:
    return f"CAST(CAST(ROUND(CAST({value} AS DECIMAL(18,8)), 1) AS DECIMAL(18,1)) AS STRING)"
