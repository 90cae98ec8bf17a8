"""Check SQL for the dashboard data sets."""

from ratelens.oracle.views import big, r, with_views

P = "Premium_Change_Number"
AVG = f"CAST(SUM({P}) AS DOUBLE) / COUNT({P})"
DAYS = "Effective_Date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"
STATES = [f"NATION_{i}" for i in range(25)]

MATRIX = f"""q AS (SELECT Company, {AVG} AS avg, SUM(Total_Written_Premium_Number) AS premium, COUNT(*) AS n FROM filings
 WHERE DATE_TRUNC('quarter', Effective_Date) = (SELECT MAX(DATE_TRUNC('quarter', Effective_Date)) FROM filings) GROUP BY Company),
matrix AS (SELECT Company, {r('avg', 6)} AS avg_rate_change, CAST(premium AS DOUBLE) AS premium_volume, {big('n')} AS filing_activity,
 {r('50.0 * PERCENT_RANK() OVER (ORDER BY avg) + 50.0 * PERCENT_RANK() OVER (ORDER BY n)', 4)} AS aggressiveness_score,
 {r('CAST(premium AS DOUBLE) / MAX(CAST(premium AS DOUBLE)) OVER () * 100', 4)} AS bubble_size FROM q)"""


def _v(body: str) -> str:
    return with_views("filings", body)


SQL = {
    "dashboard_kpis": _v(
        f"""SELECT COUNT(DISTINCT Company) AS carriers_analyzed, {big('COUNT(*)')} AS total_filings, {r(AVG, 6)} AS avg_rate_change,
 {big('SUM(Policyholders_Affected_Number)')} AS total_customers_affected FROM filings WHERE {DAYS}"""
    ),
    "state_carrier_rates": _v(
        f"SELECT State, Company, {r(AVG, 6)} AS avg_rate_change FROM filings WHERE {DAYS} AND State IS NOT NULL GROUP BY State, Company"
    ),
    "state_heatmap": _v(
        "SELECT Company, "
        + ", ".join(
            r(f"CAST(SUM({P}) FILTER (WHERE State = '{s}') AS DOUBLE) / COUNT({P}) FILTER (WHERE State = '{s}')", 6) + f" AS {s}"
            for s in STATES
        )
        + f" FROM filings WHERE {DAYS} GROUP BY Company"
    ),
    "carrier_performance_index": _v(
        f"""WITH m AS (SELECT Company, CAST(DATE_TRUNC('month', Effective_Date) AS DATE) AS month, {AVG} AS avg, {big('COUNT(*)')} AS n
 FROM filings WHERE Effective_Date >= DATE '1995-01-01' GROUP BY 1, 2)
SELECT Company, month, {r('100.0 * EXP(COALESCE(SUM(LN(1.0 + avg)) OVER (PARTITION BY Company ORDER BY month), 0))', 4)} AS performance_index,
 {r('avg', 6)} AS avg_rate_change, n AS filing_count FROM m"""
    ),
    "market_share_evolution": _v(
        f"""WITH p AS (SELECT Company, CAST(DATE_TRUNC('quarter', Effective_Date) AS DATE) AS quarter, SUM(Total_Written_Premium_Number) AS premium FROM filings GROUP BY 1, 2)
SELECT Company, quarter, {r('CAST(premium AS DOUBLE) * 100 / CAST(SUM(premium) OVER (PARTITION BY quarter) AS DOUBLE)', 6)} AS market_share_pct FROM p"""
    ),
    "positioning_matrix": _v(f"WITH {MATRIX} SELECT * FROM matrix"),
    "positioning_quadrant": _v(
        f"""WITH {MATRIX} SELECT Company, avg_rate_change, aggressiveness_score,
 concat(CASE WHEN aggressiveness_score >= 50 THEN 'Aggressive' ELSE 'Conservative' END, ' ',
  CASE WHEN avg_rate_change >= 0 THEN 'Growth' ELSE 'Competition' END) AS quadrant FROM matrix"""
    ),
    "competitive_alerts": _v(
        f"""SELECT Record_ID, Effective_Date, Company, State, Product_Line, CAST({P} AS DOUBLE) AS {P}, CAST(COALESCE(Impact_Score, 0) AS DOUBLE) AS impact_score,
 CASE WHEN {P} >= 0.1 THEN 'Major Increase' WHEN {P} > 0 THEN 'Increase' WHEN {P} <= -0.1 THEN 'Major Decrease' WHEN {P} < 0 THEN 'Decrease' ELSE 'No Change' END AS move_type
FROM filings ORDER BY Effective_Date DESC NULLS LAST, COALESCE(Impact_Score, 0) DESC, Record_ID LIMIT 20"""
    ),
}
