"""Check SQL for the market operators."""

from ratelens.oracle.views import AS_OF, avg_pct, big, n_where, one_decimal, r, with_views

P = "Premium_Change_Number"
LAST_12 = f"Effective_Date >= {AS_OF} - INTERVAL 12 MONTH AND Effective_Date <= {AS_OF}"
SINCE_12 = f"Effective_Date >= {AS_OF} - INTERVAL 12 MONTH"
SINCE_6 = f"Effective_Date >= {AS_OF} - INTERVAL 6 MONTH"

OVERVIEW = f"""SELECT {big('COUNT(*)')} AS total_filings, COUNT(DISTINCT Company) AS unique_companies,
 COUNT(DISTINCT State) AS states_affected, {r(avg_pct(f'{P} > 0'), 2)} AS avg_increase_pct,
 {r(avg_pct(f'{P} < 0'), 2)} AS avg_decrease_pct, {n_where(f'{P} > 0')} AS increases, {n_where(f'{P} < 0')} AS decreases,
 {n_where(f'{P} = 0')} AS no_change, {r(f'MAX({P}) * 100', 2)} AS max_increase_pct, {r(f'MIN({P}) * 100', 2)} AS max_decrease_pct
FROM filings WHERE {LAST_12}"""

STATES = f"""SELECT State, {big('COUNT(*)')} AS filing_count, {r(avg_pct(), 2)} AS avg_change_pct,
 {r(f'PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST({P} * 100 AS DOUBLE))', 2)} AS median_change_pct,
 COUNT(DISTINCT Company) AS companies_filing, {n_where(f'{P} > 0.1')} AS large_increases,
 {n_where(f'{P} > 0')} AS total_increases, {n_where(f'{P} < 0')} AS total_decreases,
 {r(f'MAX({P}) * 100', 2)} AS max_increase_pct, {r(f'MIN({P}) * 100', 2)} AS max_decrease_pct
FROM filings WHERE {LAST_12} GROUP BY State"""

COMPANIES = f"""SELECT Company, {big('COUNT(*)')} AS filing_count, COUNT(DISTINCT State) AS states_active,
 {r(avg_pct(), 2)} AS avg_change_pct, {r(avg_pct(f'{P} > 0'), 2)} AS avg_increase_pct,
 {n_where(f'{P} > 0')} AS increase_count, {n_where(f'{P} > 0.1')} AS large_increase_count,
 {big('SUM(Policyholders_Affected_Number)')} AS total_policyholders_affected
FROM filings WHERE {LAST_12} GROUP BY Company HAVING COUNT(*) >= 5"""

HOT = f"""SELECT State, Company, {big('COUNT(*)')} AS filing_count, {r(avg_pct(), 2)} AS avg_increase_pct,
 {r(f'MAX({P} * 100)', 2)} AS max_increase_pct, {big('SUM(Policyholders_Affected_Number)')} AS policyholders_affected,
 STRING_AGG(DISTINCT Product_Line, ', ' ORDER BY Product_Line) AS product_lines
FROM filings WHERE {SINCE_6} AND {P} > 0 GROUP BY State, Company
HAVING COUNT(*) >= 2 AND SUM({P}) > 0.05 * COUNT(*)
ORDER BY avg_increase_pct DESC, State, Company LIMIT 20"""

TREND = f"""SELECT CAST(DATE_TRUNC('month', Effective_Date) AS DATE) AS month, {big('COUNT(*)')} AS filing_count,
 {r(avg_pct(), 2)} AS avg_change_pct, COUNT(DISTINCT Company) AS unique_companies, COUNT(DISTINCT State) AS states_affected,
 {n_where(f'{P} > 0')} AS increases, {n_where(f'{P} < 0')} AS decreases,
 {r(f'CAST({n_where(f"{P} > 0")} AS DOUBLE) / NULLIF(COUNT(*), 0) * 100', 1)} AS increase_rate_pct
FROM filings WHERE Effective_Date >= {AS_OF} - INTERVAL 24 MONTH AND Effective_Date <= {AS_OF} GROUP BY 1"""

FINDINGS_CTES = f"""o AS ({OVERVIEW}), st AS ({STATES}), co AS ({COMPANIES}), hz AS ({HOT})"""

FINDINGS = f"""
SELECT CAST(1 AS BIGINT) AS finding_no, 'market_increase' AS finding,
 concat('Market shows ', {one_decimal('avg_increase_pct')}, '% average rate increase across ', unique_companies, ' companies') AS value FROM o
UNION ALL SELECT 2, 'increase_share', concat(increases, ' rate increases vs ', decreases, ' decreases (',
 {one_decimal('CAST(increases AS DOUBLE) / total_filings * 100')}, '% increase rate)') FROM o
UNION ALL (SELECT 3, 'top_state', concat(State, ' leads with ', filing_count, ' filings and ', {one_decimal('avg_change_pct')}, '% average change')
 FROM st ORDER BY filing_count DESC, State LIMIT 1)
UNION ALL SELECT 4, 'aggressive_states', concat('Aggressive rate increases in: ', names, ' (all >10% average)') FROM
 (SELECT string_agg(State, ', ' ORDER BY filing_count DESC, State) AS names, COUNT(*) AS n FROM
   (SELECT * FROM st WHERE avg_change_pct > 10 ORDER BY filing_count DESC, State LIMIT 3) a) b WHERE n > 0
UNION ALL (SELECT 5, 'top_company', concat(split_part(trim(Company), ' ', 1), '... leads with ', {one_decimal('avg_increase_pct')},
 '% average increase across ', states_active, ' states') FROM co ORDER BY avg_increase_pct DESC NULLS LAST, Company LIMIT 1)"""

INSIGHTS = """
SELECT CAST(1 AS BIGINT) AS finding_no, 'Geographic Opportunities' AS finding, concat('High-activity states (', names,
 ') show consistent filing patterns, suggesting mature markets with established rate adjustment cycles.') AS value FROM
 (SELECT string_agg(State, ', ' ORDER BY filing_count DESC, State) AS names, COUNT(*) AS n FROM
   (SELECT * FROM st WHERE filing_count > 50 ORDER BY filing_count DESC, State LIMIT 5) a) b WHERE n > 0
UNION ALL SELECT 2, 'Competitive Landscape', concat(n, ' companies are pursuing aggressive rate increases (>10% average),',
 ' potentially creating market opportunities for competitive positioning.') FROM
 (SELECT COUNT(*) AS n FROM (SELECT * FROM co WHERE avg_increase_pct > 10 LIMIT 5) a) b WHERE n > 0
UNION ALL SELECT 3, 'Risk Areas', concat(n, ' state/company combinations show concentrated rate increase activity.',
 ' These ''hot zones'' may face regulatory scrutiny or customer retention challenges.') FROM
 (SELECT COUNT(*) AS n FROM hz) b WHERE n > 0"""


def _v(body: str, views: str = "filings") -> str:
    return with_views(views, body)


SQL = {
    "market_overview": _v(OVERVIEW),
    "state_analysis": _v(STATES),
    "company_rankings": _v(COMPANIES),
    "hot_zones": _v(HOT),
    "trend_analysis": _v(TREND),
    "outlier_filings": _v(
        f"""SELECT Record_ID, Company, State, Product_Line, {r(f'{P} * 100', 2)} AS change_pct, Effective_Date,
 {big('Policyholders_Affected_Number')} AS Policyholders_Affected_Number, SERFF_Tracking_Number,
 CASE WHEN {P} > 0.15 THEN 'Large Increase' WHEN {P} < -0.15 THEN 'Large Decrease' END AS outlier_type
FROM filings_ext WHERE ABS({P}) > 0.15 AND {SINCE_6} ORDER BY ABS({P}) DESC, Record_ID LIMIT 50""",
        "filings_ext",
    ),
    "competitive_positioning": _v(
        f"""WITH m AS (SELECT State, Product_Line, {avg_pct()} AS market_avg, COUNT(DISTINCT Company) AS competitor_count
 FROM filings WHERE {SINCE_12} GROUP BY State, Product_Line),
c AS (SELECT State, Product_Line, Company, {avg_pct()} AS own_avg, {big('COUNT(*)')} AS filing_count, MAX(Effective_Date) AS latest_filing
 FROM filings WHERE {SINCE_12} GROUP BY State, Product_Line, Company)
SELECT c.Company, c.State, c.Product_Line, {r('own_avg', 4)} AS company_avg_pct, {r('market_avg', 4)} AS market_avg_pct,
 {r('own_avg - market_avg', 2)} AS vs_market_pct,
 CASE WHEN own_avg > market_avg + 2 THEN 'Above Market' WHEN own_avg < market_avg - 2 THEN 'Below Market' ELSE 'At Market' END AS position,
 competitor_count, filing_count, latest_filing
FROM c JOIN m ON c.State = m.State AND c.Product_Line = m.Product_Line"""
    ),
    "company_search": _v(
        "SELECT DISTINCT Company FROM filings WHERE Company LIKE '%0001%' ORDER BY Company LIMIT 5"
    ),
    "key_findings": _v(f"WITH {FINDINGS_CTES} {FINDINGS}"),
    "strategic_insights": _v(f"WITH {FINDINGS_CTES} {INSIGHTS}"),
    "trend_bars": _v(
        f"""WITH t AS ({TREND}), b AS (SELECT *, (filing_count * 30) // (SELECT MAX(filing_count) FROM t) AS len FROM t)
SELECT month, filing_count, CAST(len AS BIGINT) AS bar_length, concat(strftime(month, '%Y-%m'), ' | ', repeat('█', CAST(len AS INT)), ' ',
 filing_count, ' filings (', {one_decimal('avg_change_pct')}, '% avg)') AS line FROM b"""
    ),
    "insights": _v(
        f"""WITH {FINDINGS_CTES}, f AS ({FINDINGS}), s AS ({INSIGHTS}), i AS (SELECT
 least(1, (SELECT avg_increase_pct FROM o) / 10) AS i1, (SELECT CAST(increases AS DOUBLE) / total_filings FROM o) AS i2,
 (SELECT CAST(MAX(filing_count) AS DOUBLE) FROM st) / (SELECT total_filings FROM o) AS i3,
 least(1, (SELECT COUNT(*) FROM st WHERE avg_change_pct > 10) / 3.0) AS i4, least(1, (SELECT MAX(avg_increase_pct) FROM co) / 10) AS i5,
 least(1, (SELECT COUNT(*) FROM st WHERE filing_count > 50) / 5.0) AS j1, least(5, (SELECT COUNT(*) FROM co WHERE avg_increase_pct > 10)) / 5.0 AS j2,
 (SELECT COUNT(*) FROM hz) / 20.0 AS j3,
 (SELECT CAST(COUNT(Premium_Change_Number) AS DOUBLE) / COUNT(*) FROM filings WHERE {LAST_12}) AS known)
SELECT finding AS insight, value AS description, {r('CASE finding_no WHEN 1 THEN i1 WHEN 2 THEN i2 WHEN 3 THEN i3 WHEN 4 THEN i4 ELSE i5 END', 4)} AS impact_score,
 {r('known', 4)} AS confidence, 'market_trend' AS category FROM f, i
UNION ALL SELECT finding, value, {r('CASE finding_no WHEN 1 THEN j1 WHEN 2 THEN j2 ELSE j3 END', 4)}, {r('known', 4)}, 'strategy' FROM s, i"""
    ),
}
