"""Check SQL for the newsletter figures."""

from ratelens.oracle.views import AS_OF, avg_pct, big, one_decimal, r, short_number, state_abbr, with_views

P = "Premium_Change_Number"
MONTH = "CAST(DATE_TRUNC('month', Effective_Date) AS DATE)"

ACTIVITY = f"activity AS (SELECT State, {MONTH} AS month, {big('COUNT(*)')} AS filings FROM filings GROUP BY 1, 2)"
LINES = f"""lines AS (SELECT State, month, product_line, filings FROM
 (SELECT State, {MONTH} AS month, Product_Line AS product_line, {big('COUNT(*)')} AS filings FROM filings GROUP BY 1, 2, 3) x
 QUALIFY ROW_NUMBER() OVER (PARTITION BY State, month ORDER BY filings DESC, product_line NULLS LAST) = 1)"""
SUMMARY = f"""summary AS (SELECT State, {MONTH} AS month, COUNT(DISTINCT Company) FILTER (WHERE {P} > 0) AS companies,
 COALESCE({r(avg_pct(f'{P} > 0'), 1)}, 0) AS avg_increase_pct,
 {big(f'COALESCE(SUM(Policyholders_Affected_Number) FILTER (WHERE {P} > 0), 0)')} AS policies FROM filings GROUP BY 1, 2)"""


def cards(source: str) -> str:
    return f"""cards AS (SELECT State, {MONTH} AS month,
 {big(f'ROW_NUMBER() OVER (PARTITION BY State, {MONTH} ORDER BY Impact_Score DESC NULLS LAST, {P} DESC, Record_ID)')} AS place,
 Record_ID, Company, Subsidiary, CAST(Impact_Score AS DOUBLE) AS impact_score, CAST({P} * 100 AS DECIMAL(10,1)) AS change_pct,
 {big('COALESCE(Policyholders_Affected_Number, 0)')} AS policies, Effective_Date FROM {source} WHERE {P} > 0 QUALIFY place <= 3)"""


SHOWN = f"""shown AS (SELECT State, month, place, Record_ID, CASE WHEN Company IS NOT NULL AND Company NOT IN ('', 'Not specified in document') THEN Company
 ELSE COALESCE(NULLIF(Subsidiary, ''), 'N/A') END AS company, CAST(change_pct AS STRING) AS change_pct, {short_number('policies')} AS policies,
 COALESCE(strftime(Effective_Date, '%b %d'), '-') AS effective_date FROM cards)"""

TOTALS = f"""totals AS (SELECT {big('COUNT(*)')} AS total_filings, {big('COALESCE(SUM(Policyholders_Affected_Number), 0)')} AS policyholders,
 COUNT(DISTINCT Company) AS carriers FROM filings)"""


def escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


DAY = "%B %d, %Y"
# One page per state and month, as text.
PAGES = f"""{LINES}, {SUMMARY}, {cards('filings')}, {SHOWN}, {TOTALS},
rows_of AS (SELECT State, month, string_agg(Record_ID, '|' ORDER BY place) AS filings,
 string_agg(concat(CASE WHEN place % 2 = 0 THEN '<tr class="even"><td>' ELSE '<tr><td>' END, {escaped('company')}, '</td><td style="color:#ef4444">+',
  change_pct, '%</td><td>', policies, '</td><td>', effective_date, '</td></tr>'), '' ORDER BY place) AS cards FROM shown GROUP BY 1, 2),
pages_of AS (SELECT s.State, s.month, {state_abbr('s.State')} AS state_abbr, COALESCE(c.filings, '') AS filings,
 concat('<!DOCTYPE html><html><head><title>', {escaped('s.State')}, ' ', strftime(s.month, '%B %Y'), '</title></head><body><div class="edition"><b>', strftime(s.month, '%B %Y'),
 '</b> <span>', {escaped('s.State')}, '</span> <i>', COALESCE({escaped('product_line')}, ''), '</i></div><h2>Highest Impact Changes</h2><table><tr><th>Company</th>',
 '<th>Rate Change</th><th>Policies Affected</th><th>Effective Date</th></tr>', COALESCE(c.cards, ''), '</table><div class="summary"><h3>', {escaped('s.State')},
 ' Market Summary</h3><p>', CAST(companies AS VARCHAR), ' Companies Taking Rate</p><p>', {one_decimal('avg_increase_pct')}, '% Average Rate Increase</p><p>',
 {short_number('s.policies')}, ' Policyholders Affected</p><p>', strftime(s.month, '{DAY}'), ' - ', strftime(last_day(s.month), '{DAY}'),
 '</p></div><div class="stats"><p>', {short_number('t.total_filings')}, ' Rate Filings Tracked</p><p>', {short_number('t.policyholders')},
 ' Affected Policyholders</p><p>', {short_number('t.carriers')}, ' Carriers Tracked</p></div></body></html>') AS html
FROM summary s JOIN lines l ON s.State = l.State AND s.month = l.month LEFT JOIN rows_of c ON s.State = c.State AND s.month = c.month, totals t)"""


def _v(body: str, views: str = "filings") -> str:
    return with_views(views, body)


SQL = {
    "month_bounds": _v(
        f"""WITH t AS (SELECT DISTINCT concat(strftime(Effective_Date, '%Y-%m'), suffix) AS month_text FROM filings, (VALUES (''), ('-15'), ('?')) s(suffix)),
u AS (SELECT month_text, COALESCE(CAST(try_strptime(month_text, '%Y-%m') AS DATE), CAST(try_strptime(month_text, '%Y-%m-%d') AS DATE),
 CAST(DATE_TRUNC('month', {AS_OF}) AS DATE)) AS start_date FROM t)
SELECT month_text, start_date, CAST(DATE_TRUNC('month', start_date) + INTERVAL 1 MONTH AS DATE) AS end_date, strftime(start_date, '%B %Y') AS label FROM u"""
    ),
    "state_activity": _v(f"WITH {ACTIVITY} SELECT * FROM activity"),
    "top_product_line": _v(f"WITH {LINES} SELECT * FROM lines"),
    "newsletter_summary": _v(f"WITH {SUMMARY} SELECT * FROM summary"),
    "rate_cards": _v(
        f"WITH {cards('filings')} SELECT * REPLACE (CAST(change_pct AS DOUBLE) AS change_pct) FROM cards"
    ),
    "overall_stats": _v(f"WITH {TOTALS} SELECT * FROM totals"),
    "format_number_short": _v(
        f"""WITH p AS (SELECT State, Company, {big('SUM(Policyholders_Affected_Number)')} AS policies FROM filings GROUP BY ROLLUP (State, Company))
SELECT State, Company, policies, {short_number('policies')} AS short FROM p"""
    ),
    "state_abbr": _v(
        f"SELECT state_text, {big('COUNT(*)')} AS n, {state_abbr('state_text')} AS abbr FROM state_texts GROUP BY state_text",
        "state_texts",
    ),
    "card_display": _v(f"WITH {cards('filings_unnamed')}, {SHOWN} SELECT * FROM shown", "filings_unnamed"),
    "newsletter_batch": _v(
        f"""WITH {LINES}, {SUMMARY}, {cards('filings')}, {SHOWN}, {TOTALS},
c AS (SELECT State, month, string_agg(concat(company, ':', change_pct, ':', policies, ':', effective_date), '|' ORDER BY place) AS cards FROM shown GROUP BY 1, 2)
SELECT s.State, s.month, {state_abbr('s.State')} AS state_abbr, product_line, companies, avg_increase_pct, {short_number('s.policies')} AS policies_affected,
 COALESCE(c.cards, '') AS cards, {short_number('t.total_filings')} AS total_filings, {short_number('t.policyholders')} AS total_policyholders,
 {short_number('t.carriers')} AS carriers_tracked
FROM summary s JOIN lines l ON s.State = l.State AND s.month = l.month LEFT JOIN c ON s.State = c.State AND s.month = c.month, totals t"""
    ),
    "newsletter_html": _v(f"WITH {PAGES} SELECT State, month, state_abbr, filings, html FROM pages_of"),
    "report_sink": _v(
        f"""WITH {PAGES} SELECT State, concat(state_abbr, '/', strftime(month, '%Y'), '/', strftime(month, '%B'), '/', state_abbr, '_', strftime(month, '%m'), '_',
 strftime(month, '%Y'), '.html') AS path, {big('octet_length(encode(html))')} AS n_bytes FROM pages_of"""
    ),
    "pending_reports": _v(
        f"""WITH {ACTIVITY} SELECT a.* FROM activity a WHERE NOT EXISTS (SELECT 1 FROM reports p WHERE p.State = a.State
 AND p.Month IN (strftime(a.month, '%m'), strftime(a.month, '%B'), strftime(a.month, '%b')) AND p.Year = strftime(a.month, '%Y'))""",
        "filings reports",
    ),
    "report_log": _v(
        f"""WITH {cards('filings')}, g AS (SELECT State, month, string_agg(Record_ID, '|' ORDER BY place) AS Filings FROM cards GROUP BY 1, 2)
SELECT concat_ws(' ', State, strftime(month, '%B'), strftime(month, '%Y')) AS Name, State, strftime(month, '%B') AS Month, strftime(month, '%Y') AS Year,
 concat({state_abbr('State')}, '/', strftime(month, '%Y'), '/', strftime(month, '%B'), '/', {state_abbr('State')}, '_', strftime(month, '%m'), '_', strftime(month, '%Y'), '.html') AS Report_URL,
 'Generated' AS Status, Filings FROM g"""
    ),
}
