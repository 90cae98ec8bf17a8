"""Check SQL for records and the read facade."""

from ratelens.oracle.agents import POSITION
from ratelens.oracle.views import AS_OF, avg_pct, big, n_where, r, with_views

P = "Premium_Change_Number"
AGE = f"DATEDIFF('day', Effective_Date, {AS_OF})"

REASON = "CASE WHEN COALESCE(filing_id, '') = '' THEN 'filing_id is required'"

SQL = {
    "normalize_filing": with_views(
        "source_filings",
        f"""SELECT filing_id, trim(company_name) AS company_name, upper(state) AS state, filing_type, status, effective_date,
 COALESCE(last_updated, CAST({AS_OF} AS TIMESTAMP)) AS last_updated, rate_change_percent, {REASON} END AS reject_reason FROM source_filings""",
    ),
    "filing_json": with_views(
        "source_filings",
        f"""SELECT filing_id, company_name, state, COALESCE(filing_type, 'other') AS filing_type, COALESCE(status, 'pending') AS status, effective_date, last_updated,
 rate_change_percent, {REASON} WHEN COALESCE(filing_type, 'other') NOT IN ('auto', 'home', 'life', 'health', 'commercial', 'other') THEN 'unknown filing_type'
  WHEN COALESCE(status, 'pending') NOT IN ('pending', 'approved', 'rejected', 'withdrawn', 'active') THEN 'unknown status' END AS reject_reason FROM source_filings""",
    ),
    "normalize_agent": with_views(
        "agents",
        """SELECT agent_id, name, upper(state) AS state, email, CASE WHEN COALESCE(agent_id, '') = '' THEN 'agent_id is required'
 WHEN COALESCE(email, '') = '' THEN 'email is required' END AS reject_reason FROM agents""",
    ),
    "personalized_filings": with_views(
        "agents filings",
        f"""SELECT agent_id, upper(a.state) AS state, {big('COALESCE(n, 0)')} AS total_filings FROM agents a
 LEFT JOIN (SELECT State, COUNT(*) AS n FROM filings GROUP BY State) f ON upper(a.state) = upper(f.State) WHERE email IS NOT NULL""",
    ),
    "filings_of_agent": with_views(
        "agents filings",
        f"""SELECT Record_ID, Company, State, CAST({P} AS DOUBLE) AS {P}, Effective_Date FROM filings
WHERE upper(State) IN (SELECT upper(state) FROM agents WHERE agent_id = 'agent-1' AND email IS NOT NULL)""",
    ),
    "get_filings": with_views(
        "filings",
        f"""SELECT Record_ID, Company, Subsidiary, State, Product_Line, CAST({P} AS DOUBLE) AS {P}, Effective_Date,
 {big('Policyholders_Affected_Number')} AS Policyholders_Affected_Number, CAST(Total_Written_Premium_Number AS DOUBLE) AS Total_Written_Premium_Number,
 CAST(Impact_Score AS DOUBLE) AS Impact_Score FROM filings WHERE State = 'NATION_5' ORDER BY Effective_Date DESC NULLS LAST, Record_ID LIMIT 100""",
    ),
    "filing_stats": with_views(
        "filings_ext",
        f"""SELECT {big('COUNT(*)')} AS total_filings,
 {n_where(f"CAST(Updated_At AS DATE) > {AS_OF} - INTERVAL 30 DAY AND CAST(Updated_At AS DATE) <= {AS_OF}")} AS recent_updates FROM filings_ext""",
    ),
    "market_trends": with_views(
        "filings",
        f"""WITH s AS (SELECT *, {AGE} AS age FROM filings WHERE {AGE} >= 0 AND {AGE} < 60),
g AS (SELECT State, {avg_pct('age < 30')} AS avg, {avg_pct('age >= 30')} AS avg_before, {n_where('age < 30')} AS n, {n_where('age >= 30')} AS n_before FROM s GROUP BY State),
c AS (SELECT State, string_agg(Company, '|' ORDER BY n DESC, Company) AS names FROM (SELECT State, Company, COUNT(*) AS n FROM s WHERE age < 30 GROUP BY 1, 2
  QUALIFY ROW_NUMBER() OVER (PARTITION BY State ORDER BY COUNT(*) DESC, Company) <= 5) x GROUP BY State)
SELECT g.State, {r('COALESCE(avg, 0)', 4)} AS average_rate_change,
 CASE WHEN avg - avg_before > 0.5 THEN 'rising' WHEN avg - avg_before < -0.5 THEN 'falling' ELSE 'stable' END AS trend_direction,
 COALESCE(names, '') AS most_active_companies,
 CASE WHEN (n - n_before) * 10 > n_before THEN 'rising' WHEN (n - n_before) * 10 < -n_before THEN 'falling' ELSE 'stable' END AS filing_volume_trend,
 n AS filings FROM g LEFT JOIN c ON g.State = c.State""",
    ),
    "competitive_landscape": with_views(
        "filings",
        f"""WITH {POSITION},
own AS (SELECT State, Company, {avg_pct()} AS avg, SUM(Total_Written_Premium_Number) AS premium FROM filings
  WHERE Effective_Date >= {AS_OF} - INTERVAL 12 MONTH GROUP BY 1, 2),
st AS (SELECT State, {avg_pct()} AS avg, SUM(Total_Written_Premium_Number) AS premium FROM filings
  WHERE Effective_Date >= {AS_OF} - INTERVAL 12 MONTH GROUP BY 1),
j AS (SELECT o.State, o.Company, o.avg - st.avg AS gap, CAST(o.premium AS DOUBLE) * 100 / CAST(st.premium AS DOUBLE) AS share,
  {big('COALESCE(position, 1)')} AS pos, {big('COALESCE(total, 1)')} AS tot
 FROM own o JOIN st ON o.State = st.State LEFT JOIN ranked k ON o.State = k.State AND o.Company = k.Company)
SELECT State, Company, CASE WHEN tot < 3 THEN 'middle' WHEN pos * 3 <= tot THEN 'low' WHEN pos * 3 > tot * 2 THEN 'high' ELSE 'middle' END AS company_position,
 {r('gap', 4)} AS rate_comparison, {r('share', 6)} AS market_share_estimate, pos - 1 AS competitive_threats, tot - pos AS opportunities FROM j""",
    ),
}
