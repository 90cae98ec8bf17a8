"""Check SQL for data health."""

from ratelens.oracle.views import big, n_where, r, with_views

P = "Premium_Change_Number"
COLUMNS = [
    "Company",
    "Subsidiary",
    "State",
    "Product_Line",
    P,
    "Effective_Date",
    "Policyholders_Affected_Number",
    "Total_Written_Premium_Number",
    "Impact_Score",
]
WIDER = {P: "DOUBLE", "Policyholders_Affected_Number": "BIGINT", "Total_Written_Premium_Number": "DOUBLE", "Impact_Score": "DOUBLE"}

MISSING = f"""names AS (SELECT concat('NATION_', CAST(i AS STRING)) AS State, concat('N', CAST(i AS STRING)) AS state_abbr FROM range(25) t(i)),
years AS (SELECT {big('y')} AS year FROM range(1995, 2003) t(y)),
missing AS (SELECT n.State, n.state_abbr, y.year FROM names n, years y WHERE NOT EXISTS
 (SELECT 1 FROM filings_gap f WHERE f.State = n.State AND EXTRACT(YEAR FROM f.Effective_Date) = y.year))"""

SEEN = """seen AS (SELECT id, page, COUNT(*) AS n FROM raw_pages GROUP BY id, page),
first AS (SELECT id, MIN(page) AS first_page, SUM(n) AS copies FROM seen GROUP BY id)"""


def _v(body: str, views: str = "filings") -> str:
    return with_views(views, body)


def _top(column: str) -> str:
    return f"SELECT {column}, {big('COUNT(*)')} AS filings FROM filings GROUP BY {column} ORDER BY filings DESC, {column} NULLS LAST LIMIT 10"


SQL = {
    "missing_state_years": _v(f"WITH {MISSING} SELECT State, state_abbr, year FROM missing", "filings_gap"),
    "missing_states_by_year": _v(
        f"""WITH {MISSING} SELECT year, {big('COUNT(*)')} AS missing_count, string_agg(State, '|' ORDER BY State) AS missing_states
FROM missing GROUP BY year""",
        "filings_gap",
    ),
    "perfect_duplicates": _v(
        "SELECT "
        + ", ".join(f"CAST({c} AS {WIDER[c]}) AS {c}" if c in WIDER else c for c in COLUMNS)
        + f", copies FROM (SELECT {', '.join(COLUMNS)}, {big('COUNT(*)')} AS copies FROM filings_copies GROUP BY {', '.join(COLUMNS)} HAVING COUNT(*) > 1) x",
        "filings_copies",
    ),
    "year_overview": _v(
        f"""SELECT {big('EXTRACT(YEAR FROM Effective_Date)')} AS year, {big('COUNT(*)')} AS filings, COUNT(DISTINCT Company) AS companies,
 COUNT(DISTINCT State) AS states, MIN(Effective_Date) AS first_date, MAX(Effective_Date) AS last_date FROM filings GROUP BY 1"""
    ),
    "record_count": _v(f"SELECT {big('COUNT(*)')} AS total_records FROM filings"),
    "top_states": _v(_top("State")),
    "rate_statistics": _v(
        f"""SELECT {big('COUNT(*)')} AS total, {r(f'CAST(SUM({P}) AS DOUBLE) / COUNT({P})', 6)} AS avg_change, CAST(MIN({P}) AS DOUBLE) AS min_change,
 CAST(MAX({P}) AS DOUBLE) AS max_change FROM filings WHERE {P} IS NOT NULL"""
    ),
    "top_companies": _v(_top("Company")),
    "date_range": _v("SELECT MIN(Effective_Date) AS earliest_date, MAX(Effective_Date) AS latest_date FROM filings"),
    "completeness": _v(
        f"SELECT {big('COUNT(*)')} AS total, {big(f'COUNT({P})')} AS with_rate, {big('COUNT(Effective_Date)')} AS with_date FROM filings"
    ),
    "sync_outcomes": _v(
        f"SELECT status, {big('COUNT(*)')} AS syncs, {n_where('parsing_errors > 0')} AS with_errors FROM sync_history GROUP BY status",
        "sync_history",
    ),
    "cross_page_duplicates": _v(
        f"""WITH {SEEN} SELECT s.id, first_page, page AS repeat_page, {big('n - CASE WHEN page = first_page THEN 1 ELSE 0 END')} AS repeats
FROM seen s JOIN first f ON s.id = f.id WHERE copies > 1 AND n - CASE WHEN page = first_page THEN 1 ELSE 0 END > 0""",
        "raw_pages",
    ),
    "page_totals": _v(
        f"SELECT {big('COUNT(DISTINCT id)')} AS total_unique, {big('COUNT(*) - COUNT(DISTINCT id)')} AS total_duplicates FROM raw_pages",
        "raw_pages",
    ),
}
