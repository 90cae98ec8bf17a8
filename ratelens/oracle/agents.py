"""Check SQL for the agent reports: the plain pairwise join that the operators avoid."""

from ratelens.oracle.views import AS_OF, avg_pct, big, n_where, r, with_views

# Fixed values, written out a second time so that a wrong one in the operators shows: spelling fixes, longest name, brands.
CLEANING = {
    "v1": (
        {"InsuranceCompany": " Insurance Company", "MutualAutomobile": " Mutual Automobile", "andCasualty": " and Casualty"},
        40,
        {},
    ),
    "v2": (
        {"InsuranceCompany": " Insurance", "MutualAutomobile": " Mutual Auto", "andCasualty": " & Casualty", "Fire and": "Fire &"},
        25,
        {
            "State Farm": "State Farm",
            "Progressive": "Progressive",
            "Allstate": "Allstate",
            "Geico": "GEICO",
            "GEICO": "GEICO",
            "Farmers": "Farmers",
            "Liberty Mutual": "Liberty Mutual",
        },
    ),
    "refined": (
        {
            "InsuranceCompany": " Insurance Company",
            "MutualAutomobile": " Mutual Automobile",
            "andCasualty": " and Casualty",
            "Fire and": "Fire &",
            "Property and": "Property &",
        },
        35,
        {},
    ),
    "v3": ({"InsuranceCompany": " Insurance", "MutualAutomobile": " Mutual"}, 25, {}),
}
BRAND_INITIALS = {"State Farm": "SF", "Progressive": "PG", "Allstate": "AS", "GEICO": "GE", "Farmers": "FM", "Liberty": "LM"}

P = "Premium_Change_Number"
SINCE_6 = f"Effective_Date >= {AS_OF} - INTERVAL 6 MONTH"
CARRIER = "Supplier#000000001"

RATES = f"""rates AS (SELECT State, Company,
 COALESCE({avg_pct(SINCE_6)}, 0) AS avg_rate, MAX(CASE WHEN {SINCE_6} THEN Effective_Date END) AS latest_date,
 {n_where(SINCE_6)} AS filing_count FROM filings GROUP BY State, Company)"""


def coming(above: str, days: int) -> str:
    return f"""comp AS (SELECT State, Company AS competitor, {r(avg_pct(), 1)} AS avg_increase, MAX(Effective_Date) AS effective_date,
 {big('SUM(Policyholders_Affected_Number)')} AS policies_affected, {big('COUNT(*)')} AS filing_count,
 {big(f"DATEDIFF('day', {AS_OF}, MAX(Effective_Date))")} AS days_until
 FROM filings WHERE {P} > {above} AND Effective_Date >= {AS_OF} AND Effective_Date <= {AS_OF} + INTERVAL {days} DAY
 GROUP BY State, Company)"""


def picked(order: str, k: int, extra: str = "") -> str:
    return f"""opp AS (SELECT * FROM (SELECT a.State, a.Company, a.avg_rate, c.* EXCLUDE (State), c.avg_increase - a.avg_rate AS adv{extra},
  ROW_NUMBER() OVER (PARTITION BY a.State, a.Company ORDER BY {order}) AS rank
 FROM rates a JOIN comp c ON a.State = c.State AND c.competitor <> a.Company AND c.avg_increase > a.avg_rate + 2) x WHERE rank <= {k})"""


WIN = ", CASE WHEN c.avg_increase - a.avg_rate > 10 THEN 85 WHEN c.avg_increase - a.avg_rate > 7 THEN 75 WHEN c.avg_increase - a.avg_rate > 5 THEN 65 WHEN c.avg_increase - a.avg_rate > 3 THEN 55 ELSE 45 END AS win"

COMP_V1 = f"""comp AS (SELECT State, Company AS competitor, {r(avg_pct(), 1)} AS avg_increase, {r(f'MAX({P}) * 100', 2)} AS max_increase,
 MAX(Effective_Date) AS effective_date, {big('COUNT(*)')} AS filing_count, {big('SUM(Policyholders_Affected_Number)')} AS policies_affected,
 {r('CAST(SUM(Impact_Score) AS DOUBLE) / COUNT(Impact_Score)', 4)} AS avg_impact_score,
 MAX(Previous_Increase_Date) AS last_increase_date, {r('MAX(Previous_Increase_Number) * 100', 2)} AS last_increase,
 STRING_AGG(DISTINCT Product_Line, ', ' ORDER BY Product_Line) AS product_lines
 FROM filings_ext WHERE {P} > 0 AND Effective_Date >= {AS_OF} GROUP BY State, Company)"""

V1 = f"{RATES}, {COMP_V1}, {picked('c.avg_increase DESC, c.avg_impact_score DESC NULLS LAST, c.competitor', 10)}"
V2 = f"{RATES}, {coming('0.02', 90)}, {picked('c.avg_increase DESC, c.policies_affected DESC NULLS LAST, c.competitor', 12, WIN)}"
V3 = f"{RATES}, {coming('0.03', 60)}, {picked('c.days_until, c.avg_increase DESC, c.competitor', 6)}"

POSITION = f"""ranked AS (SELECT State, Company, {big('ROW_NUMBER() OVER (PARTITION BY State ORDER BY avg NULLS LAST, md5(Company), Company)')} AS position,
 {big('COUNT(*) OVER (PARTITION BY State)')} AS total FROM
 (SELECT State, Company, {avg_pct()} AS avg FROM filings WHERE {SINCE_6} GROUP BY State, Company) x),
everyone AS (SELECT DISTINCT State, Company FROM filings)"""

COMMISSION = "(COALESCE(policies_affected, 100) * 1200 * 15 * win) // 10000"

RAISING = f"""{P} > 0.02 AND Company NOT LIKE '%{CARRIER}%'
 AND Effective_Date >= {AS_OF} - INTERVAL 30 DAY AND Effective_Date <= {AS_OF} + INTERVAL 90 DAY"""

REFINED = f"""refined AS (SELECT *, {big('ROW_NUMBER() OVER (PARTITION BY State ORDER BY days_until, avg_increase DESC, Company)')} AS rank FROM
 (SELECT State, Company, {big('COUNT(*)')} AS filing_count, {r(avg_pct(), 1)} AS avg_increase, MAX(Effective_Date) AS effective_date,
  {big('SUM(Policyholders_Affected_Number)')} AS policies_affected, {big(f"DATEDIFF('day', {AS_OF}, MAX(Effective_Date))")} AS days_until,
  STRING_AGG(DISTINCT Product_Line, ', ' ORDER BY Product_Line) AS product_lines,
  array_to_string(array_slice(array_agg(CAST(CAST({P} * 100 AS DECIMAL(10,1)) AS STRING) ORDER BY Effective_Date DESC, Record_ID DESC), 1, 3), '|') AS recent_changes
  FROM filings WHERE {RAISING} GROUP BY State, Company HAVING SUM({P}) > 0.03 * COUNT(*)) x QUALIFY rank <= 15)"""


def cleaned(name: str, variant: str) -> str:
    replacements, longest, brands = CLEANING[variant]
    fixed = name
    for old, new in replacements.items():
        fixed = f"replace({fixed}, '{old}', '{new}')"
    cut = f"trim(CASE WHEN length({fixed}) > {longest} THEN concat(substring({fixed}, 1, {longest - 3}), '...') ELSE {fixed} END)"
    if not brands:
        return cut
    cases = " ".join(f"WHEN contains({fixed}, '{found}') THEN '{brand}'" for found, brand in brands.items())
    return f"CASE {cases} ELSE {cut} END"


def _v(body: str, views: str = "filings") -> str:
    return with_views(views, body)


def _timeline(variant: str, days: str, keep: str, urgent: str) -> str:
    return f"""SELECT '{variant}' AS variant, State, Company, {big('step')} AS step, competitor, effective_date, {big('d')} AS days_until, {urgent} AS urgent FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY State, Company ORDER BY d, rank) AS step FROM
  (SELECT *, {days} AS d FROM {variant}) x WHERE {keep}) y WHERE step <= 5"""


_DAYS = f"DATEDIFF('day', {AS_OF}, effective_date)"

SUMMARY = f"""{big('COUNT(competitor)')} AS total_opportunities, {big(f'COALESCE(SUM({COMMISSION}) FILTER (WHERE competitor IS NOT NULL), 0)')} AS potential_revenue,
 {big('COALESCE(SUM(COALESCE(policies_affected, 100)) FILTER (WHERE competitor IS NOT NULL), 0)')} AS total_policies,
 COALESCE({r('CAST(SUM(CAST(adv AS DECIMAL(18,8))) AS DOUBLE) / COUNT(adv)', 1)}, 0) AS your_advantage,
 {n_where('days_until <= 30')} AS urgent_count, {big('COALESCE(SUM(win) // NULLIF(COUNT(win), 0), 0)')} AS win_rate"""

SQL = {
    "carrier_resolve": _v(
        "SELECT State, MIN(Company) AS Company FROM filings WHERE Company LIKE '%0001%' GROUP BY State"
    ),
    "agent_rate": _v(
        f"WITH {RATES} SELECT State, Company, ROUND(avg_rate, 6) AS avg_rate, latest_date, filing_count FROM rates"
    ),
    "opportunities_v1": _v(
        f"""WITH {V1} SELECT State, Company, {r('avg_rate', 4)} AS avg_rate, rank, competitor, avg_increase, max_increase,
 effective_date, filing_count, policies_affected, avg_impact_score, last_increase_date, last_increase, product_lines, {r('adv', 4)} AS rate_advantage FROM opp""",
        "filings_ext",
    ),
    "market_summary_v1": _v(
        f"""SELECT State, COUNT(DISTINCT Company) AS total_carriers, {r(avg_pct(f'{P} > 0'), 4)} AS avg_increase, {big('COUNT(*)')} AS total_filings,
 {big('SUM(Policyholders_Affected_Number)')} AS total_affected,
 CASE WHEN {avg_pct(f'{P} > 0')} > 5 THEN 'Hardening (Rates Rising)' ELSE 'Stable' END AS market_direction
FROM filings WHERE {SINCE_6} GROUP BY State"""
    ),
    "market_position": _v(
        f"""WITH {POSITION} SELECT e.State, e.Company, position, concat('#', COALESCE(CAST(position AS STRING), 'N/A')) AS your_position
FROM everyone e LEFT JOIN ranked k ON e.State = k.State AND e.Company = k.Company"""
    ),
    "market_position_total": _v(
        f"""WITH {POSITION} SELECT e.State, e.Company, {big('COALESCE(position, 1)')} AS position, {big('COALESCE(total, 1)')} AS total_carriers
FROM everyone e LEFT JOIN ranked k ON e.State = k.State AND e.Company = k.Company"""
    ),
    "opportunities_v2": _v(
        f"""WITH {V2} SELECT State, Company, {r('avg_rate', 4)} AS avg_rate, rank, competitor, avg_increase, effective_date, policies_affected,
 filing_count, days_until, {r('adv', 4)} AS rate_advantage, {big('win')} AS win_probability FROM opp"""
    ),
    "commission_opportunity": _v(
        f"""WITH {V2} SELECT State, Company, rank, competitor, {big('COALESCE(policies_affected, 100)')} AS policies, {big('win')} AS win_probability,
 {big(COMMISSION)} AS commission_opportunity FROM opp"""
    ),
    "target_segments": _v(
        f"""WITH {V2} SELECT State, Company, rank, competitor, array_to_string(array_slice([x FOR x IN [
 CASE WHEN avg_increase > 10 THEN 'Multi-car households' END, CASE WHEN avg_increase > 10 THEN 'Long-term customers' END,
 CASE WHEN avg_increase > 7 THEN 'Good drivers' END, CASE WHEN avg_increase > 7 THEN 'Bundle opportunities' END,
 CASE WHEN avg_increase > 5 THEN 'Price-sensitive' END,
 CASE WHEN contains(competitor, 'State Farm') THEN 'Loyalty seekers' WHEN contains(competitor, 'Progressive') THEN 'Tech-savvy'
  WHEN contains(competitor, 'Allstate') THEN 'Full coverage' END] IF x IS NOT NULL], 1, 3), '|') AS segments FROM opp"""
    ),
    "action_window": _v(
        f"""WITH {V2} SELECT State, Company, rank, competitor, days_until, CASE WHEN days_until <= 30 THEN 'Contact immediately - renewal notices going out'
 WHEN days_until <= 45 THEN 'Prime time - customers shopping for alternatives' WHEN days_until <= 60 THEN 'Early outreach - build awareness'
 ELSE 'Plan campaign - prepare materials' END AS action_window FROM opp"""
    ),
    "agent_summary_v2": _v(
        f"""WITH {V2} SELECT a.State, a.Company, {SUMMARY}
FROM rates a LEFT JOIN opp o ON a.State = o.State AND a.Company = o.Company GROUP BY a.State, a.Company"""
    ),
    "rate_increases_refined": _v(f"WITH {REFINED} SELECT * FROM refined"),
    "refined_summary": _v(
        f"""SELECT State, COUNT(DISTINCT Company) AS companies_raising, {r(avg_pct(), 1)} AS avg_increase, {r(f'MAX({P}) * 100', 1)} AS max_increase,
 {big('COALESCE(SUM(Policyholders_Affected_Number), 0)')} AS total_policies,
 CASE WHEN SUM(Policyholders_Affected_Number) > 0 THEN format('{{:,}}', {big('SUM(Policyholders_Affected_Number)')}) ELSE '5,000+' END AS estimated_policies
FROM filings WHERE {RAISING} GROUP BY State"""
    ),
    "urgency": _v(
        f"""WITH {REFINED} SELECT State, rank, Company, {cleaned('Company', 'refined')} AS competitor, avg_increase AS rate_increase,
 {big('GREATEST(days_until, 0)')} AS days_until,
 CASE WHEN policies_affected > 0 THEN format('{{:,}}', policies_affected) ELSE 'N/A' END AS policies_affected,
 CASE WHEN length(COALESCE(product_lines, 'Auto')) > 30 THEN concat(substring(product_lines, 1, 27), '...') ELSE COALESCE(product_lines, 'Auto') END AS product_lines,
 {r('GREATEST(0.0, (90 - days_until) * 100 / CAST(90 AS DOUBLE))', 1)} AS urgency_percent,
 CASE WHEN days_until <= 30 THEN '#dc2626' ELSE '#10b981' END AS urgency_color,
 {big('COUNT(CASE WHEN days_until <= 30 THEN 1 END) OVER (PARTITION BY State)')} AS urgent_opportunities FROM refined"""
    ),
    "outreach_timeline": _v(
        f"""WITH {REFINED} SELECT State, {big('ROW_NUMBER() OVER (PARTITION BY State ORDER BY days_until, rank)')} AS step,
 {cleaned('Company', 'refined')} AS carrier, strftime(effective_date, '%b %d') AS effective_date,
 strftime(effective_date - INTERVAL 30 DAY, '%b %d') AS outreach_date, days_until FROM refined WHERE days_until >= 0 QUALIFY step <= 6"""
    ),
    "opportunities_v3": _v(
        f"""WITH {V3} SELECT State, Company, {r('avg_rate', 4)} AS avg_rate, rank, competitor, avg_increase, effective_date, policies_affected,
 days_until, {r('adv', 4)} AS rate_advantage FROM opp"""
    ),
    "weekly_filing_trend": _v(
        f"""SELECT State, CAST(DATE_TRUNC('week', Effective_Date) AS DATE) AS week, {big('COUNT(*)')} AS filings FROM filings
WHERE Effective_Date >= {AS_OF} - INTERVAL 90 DAY AND Effective_Date <= {AS_OF} GROUP BY 1, 2"""
    ),
    "agent_revenue_v3": _v(
        f"""WITH {V3} SELECT a.State, a.Company, {big('COUNT(competitor)')} AS win_back_count,
 {big('COALESCE(SUM((COALESCE(policies_affected, 100) * 1200 * 15 * 65) // 10000) FILTER (WHERE competitor IS NOT NULL), 0)')} AS revenue_opportunity,
 {n_where('days_until <= 7')} AS urgent_actions
FROM rates a LEFT JOIN opp o ON a.State = o.State AND a.Company = o.Company GROUP BY a.State, a.Company"""
    ),
    "agent_timeline": _v(
        f"""WITH v1 AS (WITH {V1} SELECT State, Company, rank, competitor, effective_date FROM opp),
v2 AS (WITH {V2} SELECT State, Company, rank, competitor, effective_date FROM opp),
v3 AS (WITH {V3} SELECT State, Company, rank, competitor, effective_date FROM opp)
{_timeline('v1', _DAYS, 'TRUE', 'd > 0 AND d <= 60')} UNION ALL {_timeline('v2', _DAYS, 'd <= 60', 'd <= 30')}
UNION ALL {_timeline('v3', _DAYS, 'd <= 30', 'd <= 7')}""",
        "filings_ext",
    ),
    "clean_company_name": _v(
        "SELECT DISTINCT Company, "
        + ", ".join(f"{cleaned('Company', v)} AS name_{v}" for v in ("v1", "v2", "refined", "v3"))
        + " FROM carrier_names",
        "carrier_names",
    ),
    "company_initials": _v(
        f"""WITH n AS (SELECT DISTINCT Company, {cleaned('Company', 'v2')} AS c FROM carrier_names)
SELECT Company, CASE {' '.join(f"WHEN contains(c, '{f}') THEN '{i}'" for f, i in BRAND_INITIALS.items())}
 WHEN contains(c, ' ') THEN concat(substring(c, 1, 1), substring(split_part(c, ' ', 2), 1, 1)) ELSE upper(substring(c, 1, 2)) END AS initials FROM n""",
        "carrier_names",
    ),
    "agent_report_batch": _v(
        f"""WITH {V2}, {POSITION}, s AS (SELECT a.State, a.Company, {r('MAX(a.avg_rate)', 4)} AS avg_rate, {SUMMARY},
 COALESCE(string_agg(concat(competitor, ':', {big(COMMISSION)}), '|' ORDER BY rank) FILTER (WHERE rank <= 6), '') AS top_opportunities
 FROM rates a LEFT JOIN opp o ON a.State = o.State AND a.Company = o.Company GROUP BY a.State, a.Company)
SELECT s.*, {big('COALESCE(position, 1)')} AS position, {big('COALESCE(total, 1)')} AS total_carriers
FROM s LEFT JOIN ranked k ON s.State = k.State AND s.Company = k.Company"""
    ),
}
