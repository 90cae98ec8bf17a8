"""Check SQL for subscribers, reports and mail."""

from ratelens.oracle.newsletter import PAGES
from ratelens.oracle.views import big, state_abbr, with_views

# Fixed values, written out anew so that a wrong constant of the operators shows.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
SCRIPT_BLOCK = r"(?is)<script\b.*?</script>"
EMAIL_CSS = (
    "<style>body{margin:0;padding:0;-webkit-text-size-adjust:100%;-ms-text-size-adjust:100%;}"
    "table{border-collapse:collapse;mso-table-lspace:0pt;mso-table-rspace:0pt;}"
    "img{border:0;height:auto;line-height:100%;outline:none;text-decoration:none;-ms-interpolation-mode:bicubic;}</style>"
)
NOTE_SPAM, NOTE_UNSUBSCRIBED = "Recipient marked email as spam", "Recipient unsubscribed"
MONTH_NAMES = "January February March April May June July August September October November December".split()

SECRET = "letters"
_KEY = SECRET.encode().ljust(64, b"\0")
_INNER = "".join(f"{b ^ 0x36:02x}" for b in _KEY)
_OUTER = "".join(f"{b ^ 0x5C:02x}" for b in _KEY)


def hmac(text: str) -> str:
    return f"sha256(from_hex('{_OUTER}') || from_hex(sha256(from_hex('{_INNER}') || encode({text}))))"


OUTCOME = f"""CASE WHEN Email IS NULL OR Email = '' THEN 'skipped' WHEN NOT regexp_full_match(Email, '{EMAIL}') THEN 'invalid' ELSE 'queued' END"""

QUEUE = f"""queue AS (SELECT report_id, p.State, Month, Year, subscriber_id, Email,
 concat(p.State, ' Insurance Market Update - ', Month, ' ', Year) AS subject, {OUTCOME} AS outcome
 FROM (SELECT subscriber_id, Email, Active, UNNEST(string_split(State, ',')) AS State FROM subscribers) s
 JOIN reports p ON s.State = p.State WHERE p.Status = 'Approved' AND s.Active)"""


def month_number(text: str) -> str:
    cases = " ".join(
        f"WHEN lower(trim({text})) IN ('{n.lower()}', '{n[:3].lower()}', '{i:02d}', '{i}') THEN '{i:02d}'"
        for i, n in enumerate(MONTH_NAMES, 1)
    )
    return f"CASE {cases} END"


def loose_number(text: str) -> str:
    cases = " ".join(
        f"WHEN starts_with('{n.lower()}', substring(lower({text}), 1, 3)) THEN '{i:02d}'" for i, n in enumerate(MONTH_NAMES, 1)
    )
    return f"CASE {cases} ELSE '01' END"


def month_name(number: str) -> str:
    return f"strftime(make_date(2000, CAST({number} AS INT), 1), '%B')"


# Gaps and islands over the known events of each message.
FOLD = f"""k AS (SELECT *, lower(record_type) AS kind FROM email_events WHERE message_id IS NOT NULL
  AND lower(record_type) IN ('delivery', 'open', 'bounce', 'spamcomplaint', 'unsubscribe')),
i AS (SELECT *, SUM(CASE WHEN kind <> 'open' THEN 1 ELSE 0 END) OVER (PARTITION BY message_id ORDER BY ts, event_id) AS run,
  ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY ts DESC, event_id DESC) AS from_end FROM k),
opens AS (SELECT message_id, run, COUNT(*) AS n, MIN(ts) AS started FROM i WHERE kind = 'open' GROUP BY 1, 2
  QUALIFY ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY run DESC) = 1),
latest AS (SELECT message_id, kind FROM i WHERE from_end = 1),
notes AS (SELECT message_id, CASE kind WHEN 'bounce' THEN concat('Bounce: ', COALESCE(description, 'No description'))
   WHEN 'spamcomplaint' THEN '{NOTE_SPAM}' ELSE '{NOTE_UNSUBSCRIBED}' END AS notes FROM i WHERE kind IN ('bounce', 'spamcomplaint', 'unsubscribe')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY from_end) = 1),
bounces AS (SELECT message_id, COALESCE(bounce_type, 'Unknown') AS bounce_type FROM i WHERE kind = 'bounce'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY from_end) = 1),
deliveries AS (SELECT message_id, MAX(ts) AS delivered_at FROM i WHERE kind = 'delivery' GROUP BY 1),
fold AS (SELECT e.message_id, e.subscriber_id, CASE l.kind WHEN 'delivery' THEN 'Delivered' WHEN 'open' THEN 'Opened' WHEN 'bounce' THEN 'Bounced'
   WHEN 'spamcomplaint' THEN 'Spam Complaint' WHEN 'unsubscribe' THEN 'Unsubscribed' END AS status, d.delivered_at, o.started AS opened_at,
  {big('o.n')} AS open_count, b.bounce_type, n.notes
 FROM emails e LEFT JOIN latest l ON e.message_id = l.message_id LEFT JOIN opens o ON e.message_id = o.message_id
 LEFT JOIN notes n ON e.message_id = n.message_id LEFT JOIN bounces b ON e.message_id = b.message_id
 LEFT JOIN deliveries d ON e.message_id = d.message_id)"""


def path_of(table: str = "") -> str:
    abbr, month, year = state_abbr(f"{table}State"), month_number(f"{table}Month"), f"{table}Year"
    return f"concat({abbr}, '/', {year}, '/', {month_name(month)}, '/', {abbr}, '_', {month}, '_', {year}, '.html')"



SQL = {
    "subscribers_by_state": with_views(
        "subscribers", "SELECT * FROM subscribers WHERE Active AND list_contains(string_split(State, ','), 'NATION_1')"
    ),
    "test_subscribers": with_views("subscribers", "SELECT * FROM subscribers WHERE Test"),
    "reports_by_status": with_views(
        "reports", "SELECT * FROM reports WHERE Status = 'Approved' AND Year = '2001'"
    ),
    "report_lookup": with_views(
        "reports",
        """SELECT State, Month, Year, report_id, Name, Status FROM reports
QUALIFY ROW_NUMBER() OVER (PARTITION BY State, Month, Year ORDER BY report_id) = 1""",
    ),
    "report_status_update": with_views(
        "reports",
        f"""SELECT report_id, CASE WHEN {month_number('Month')} = '05' THEN concat('May in ', State) ELSE Name END AS Name, State, Month, Year,
 CASE Status WHEN 'Generated' THEN 'Approved' WHEN 'Approved' THEN 'Sent' ELSE Status END AS Status FROM reports""",
    ),
    "email_valid": with_views(
        "subscribers",
        f"SELECT subscriber_id, Email, COALESCE(regexp_full_match(Email, '{EMAIL}'), FALSE) AS valid FROM subscribers",
    ),
    "send_queue": with_views("reports subscribers", f"WITH {QUEUE} SELECT * FROM queue"),
    "test_send_queue": with_views(
        "reports subscribers",
        f"""WITH p AS (SELECT * FROM reports WHERE Status = 'Approved' ORDER BY report_id LIMIT 1)
SELECT report_id, p.State, Month, Year, subscriber_id, Email, concat('[TEST] ', p.State, ' Insurance Market Update - ', Month, ' ', Year) AS subject,
 {OUTCOME} AS outcome FROM subscribers s, p WHERE s.Test""",
    ),
    "sent_reports": with_views(
        "reports subscribers",
        f"WITH {QUEUE} SELECT DISTINCT report_id, 'Sent' AS new_status, CAST(NULL AS STRING) AS new_name FROM queue WHERE outcome = 'queued'",
    ),
    "unsubscribe_token": with_views(
        "subscribers", f"SELECT subscriber_id, {hmac('subscriber_id')} AS token FROM subscribers"
    ),
    "unsubscribe_link_check": with_views(
        "unsubscribe_requests",
        f"SELECT subscriber_id, token, COALESCE(token = md5(concat(subscriber_id, '-{SECRET}')), FALSE) AS accepted FROM unsubscribe_requests",
    ),
    "clean_html": f"""SELECT page_id, replace(replace(regexp_replace(html, '{SCRIPT_BLOCK}', '', 'g'), 'file://', 'https://'), '<head>',
 concat('<head>', chr(10), '{EMAIL_CSS}')) AS html FROM pages""",
    "email_status_fold": with_views("email_events emails", f"WITH {FOLD} SELECT * FROM fold"),
    "email_status_stream": with_views("email_events emails", f"WITH {FOLD} SELECT * FROM fold"),
    "subscriber_deactivate": with_views(
        "subscribers email_events emails",
        """WITH gone AS (SELECT e.subscriber_id, CAST(MAX(v.ts) AS DATE) AS unsubscribe_date FROM emails e JOIN email_events v ON e.message_id = v.message_id
 WHERE lower(v.record_type) = 'unsubscribe' GROUP BY 1)
SELECT s.* REPLACE (Active AND unsubscribe_date IS NULL AS Active), unsubscribe_date FROM subscribers s LEFT JOIN gone g ON s.subscriber_id = g.subscriber_id""",
    ),
    "personalized_html": with_views(
        "reports subscribers filings",
        f"""WITH {PAGES}, {QUEUE}, clean AS (SELECT State, month, replace(replace(regexp_replace(html, '{SCRIPT_BLOCK}', '', 'g'), 'file://', 'https://'), '<head>',
 concat('<head>', chr(10), '{EMAIL_CSS}')) AS html FROM pages_of),
mails AS (SELECT q.*, c.html, concat('<hr><div class="footer"><p>This letter goes to subscribers of the monthly rate news for ', q.State,
 '.</p><p><a href="https://example.com/unsubscribe?id=', subscriber_id, '&token=', {hmac('subscriber_id')}, '">Stop these letters</a></p></div>') AS footer,
 concat('https://reports.example.com/', {path_of('q.')}) AS address
 FROM queue q LEFT JOIN (SELECT * FROM clean WHERE EXTRACT(MONTH FROM month) <> 10) c
 ON q.State = c.State AND q.Year = strftime(c.month, '%Y') AND {month_number('q.Month')} = strftime(c.month, '%m') WHERE outcome = 'queued')
SELECT report_id, subscriber_id, Email, subject, CASE WHEN html IS NOT NULL THEN replace(html, '</body>', concat(footer, '</body>'))
 ELSE concat('<p>The rate report for ', State, ' is ready.</p><p><a href="', address, '">Read the report</a></p>', footer) END AS html FROM mails""",
    ),
    "email_log": with_views(
        "reports subscribers",
        f"WITH {QUEUE} SELECT subscriber_id, report_id, md5(concat(report_id, '/', subscriber_id)) AS message_id FROM queue WHERE outcome = 'queued'",
    ),
    "month_normalize": with_views(
        "month_texts",
        f"""WITH t AS (SELECT month_text, {big('COUNT(*)')} AS n, {month_number('month_text')} AS month_number, {loose_number('month_text')} AS loose_number
 FROM month_texts GROUP BY month_text)
SELECT month_text, n, month_number, {month_name('month_number')} AS month_name, loose_number, {month_name('loose_number')} AS loose_name FROM t""",
    ),
    "report_path": with_views("reports", f"SELECT report_id, {path_of()} AS path FROM reports"),
    "mark_opened": with_views(
        "email_events emails",
        f"""WITH {FOLD}, m AS (SELECT DISTINCT message_id FROM email_events WHERE record_type = 'Open' AND event_id % 2 = 0 AND message_id IS NOT NULL)
SELECT f.message_id, CASE WHEN m.message_id IS NOT NULL THEN 'Opened' ELSE status END AS status,
 CASE WHEN m.message_id IS NOT NULL THEN TIMESTAMP '2024-03-01 12:00:00' ELSE opened_at END AS opened_at
FROM fold f LEFT JOIN m ON f.message_id = m.message_id""",
    ),
}
