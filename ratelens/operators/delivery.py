"""Subscribers, report status, the send queue and the status of sent mails."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.dates import month_name, month_number, month_number_by_prefix
from ratelens.functions.states import state_abbr

# Accepted addresses, script blocks, end of a page's body, mail style sheet.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
SCRIPT_BLOCK = r"(?is)<script\b.*?</script>"
BODY_END = "</body>"
EMAIL_CSS = (
    "<style>body{margin:0;padding:0;-webkit-text-size-adjust:100%;-ms-text-size-adjust:100%;}"
    "table{border-collapse:collapse;mso-table-lspace:0pt;mso-table-rspace:0pt;}"
    "img{border:0;height:auto;line-height:100%;outline:none;text-decoration:none;-ms-interpolation-mode:bicubic;}"
    "</style>"
)


# --- subscribers --------------------------------------------------------------------------------------


def states_of(column: str = "State") -> Column:
    """The members of a comma-separated multi-select."""
    return F.transform(F.split(column, ","), lambda s: F.trim(s))


def subscribers_by_state(subscribers: DataFrame, state: str) -> DataFrame:
    """Active subscribers of a state; a state whose name merely contains the text does not count."""
    return subscribers.filter(F.col("Active") & F.array_contains(states_of(), state))


def test_subscribers(subscribers: DataFrame) -> DataFrame:
    return subscribers.filter("Test")


def email_valid(subscribers: DataFrame) -> DataFrame:
    return subscribers.select(
        "subscriber_id", "Email", F.coalesce(F.col("Email").rlike(EMAIL), F.lit(False)).alias("valid")
    )


# --- report status ------------------------------------------------------------------------------------


def reports_by_status(
    reports: DataFrame, status: str | None = None, month: str | None = None, year: str | None = None
) -> DataFrame:
    kept = reports
    for column, value in (("Status", status), ("Year", year)):
        if value is not None:
            kept = kept.filter(F.col(column) == value)
    if month is not None:
        kept = kept.filter(month_number(F.col("Month")) == month_number(F.lit(month)))
    return kept


def report_lookup(reports: DataFrame) -> DataFrame:
    """First report, by id, of every (state, month, year)."""
    rest = F.struct("report_id", "Name", "Status")
    return (
        reports.groupBy("State", "Month", "Year").agg(F.min(rest).alias("r")).select("State", "Month", "Year", "r.*")
    )


def report_status_update(reports: DataFrame, changes: DataFrame) -> DataFrame:
    """New snapshot of the reports after ``changes(report_id, new_status, new_name)``; NULL keeps a value."""
    return reports.join(changes, "report_id", "left").select(
        *[
            F.coalesce("new_status", "Status").alias("Status")
            if c == "Status"
            else F.coalesce("new_name", "Name").alias("Name")
            if c == "Name"
            else F.col(c)
            for c in reports.columns
        ]
    )


def sent_reports(queue: DataFrame) -> DataFrame:
    """Status changes after sending: a report is sent once at least one mail was queued for it."""
    return (
        queue.filter(F.col("outcome") == "queued")
        .select("report_id")
        .distinct()
        .select("report_id", F.lit("Sent").alias("new_status"), F.lit(None).cast("string").alias("new_name"))
    )


def report_log(cards: DataFrame) -> DataFrame:
    """One log row per generated newsletter; at most three linked filings each (the rate cards)."""
    linked = F.sort_array(F.collect_list(F.struct("place", "Record_ID")))
    month = F.date_format("month", "MMMM")
    year = F.date_format("month", "yyyy")
    return (
        cards.groupBy("State", "month")
        .agg(linked.alias("linked"))
        .select(
            F.concat_ws(" ", "State", month, year).alias("Name"),
            "State",
            month.alias("Month"),
            year.alias("Year"),
            report_path(F.col("State"), F.date_format("month", "MM"), year).alias("Report_URL"),
            F.lit("Generated").alias("Status"),
            F.col("linked.Record_ID").alias("Filings"),
        )
    )


def report_path(state: Column, month: Column, year: Column) -> Column:
    """'<abbr>/<year>/<Month>/<abbr>_<mm>_<year>.html'; the month in any spelling."""
    abbr, number = state_abbr(state), month_number(month)
    name = F.concat(F.concat_ws("_", abbr, number, year), F.lit(".html"))
    return F.concat_ws("/", abbr, year, month_name(number), name)


def report_paths(reports: DataFrame) -> DataFrame:
    return reports.select(
        "report_id", report_path(F.col("State"), F.col("Month"), F.col("Year")).alias("path")
    )


def month_normalize(months: DataFrame, column: str) -> DataFrame:
    """Two-digit month and full name of each distinct spelling, strictly and by the looser rule."""
    strict, loose = month_number(F.col(column)), month_number_by_prefix(F.col(column))
    return (
        months.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            column,
            "n",
            strict.alias("month_number"),
            month_name(strict).alias("month_name"),
            loose.alias("loose_number"),
            month_name(loose).alias("loose_name"),
        )
    )


# --- sending ------------------------------------------------------------------------------------------


def _outcome() -> Column:
    return (
        F.when(F.col("Email").isNull() | (F.col("Email") == ""), "skipped")
        .when(~F.col("Email").rlike(EMAIL), "invalid")
        .otherwise("queued")
    )


def _subject(prefix: str = "") -> Column:
    return F.concat(
        F.lit(prefix), F.col("State"), F.lit(" Insurance Market Update - "), F.col("Month"), F.lit(" "), F.col("Year")
    )


QUEUE = ["report_id", "State", "Month", "Year", "subscriber_id", "Email"]


def send_queue(
    reports: DataFrame, subscribers: DataFrame, *, month: str | None = None, year: str | None = None
) -> DataFrame:
    """One row per approved report and active subscriber of its state: the mails themselves.

    The side with the reports is small (one per state and month); AQE broadcasts it, or splits a state that
    holds much of the subscribers.
    """
    approved = reports_by_status(reports, "Approved", month, year).select("report_id", "State", "Month", "Year")
    members = subscribers.filter("Active").select(
        "subscriber_id", "Email", F.explode(F.array_distinct(states_of())).alias("State")
    )
    return members.join(approved, "State").select(*QUEUE, _subject().alias("subject"), _outcome().alias("outcome"))


def test_send_queue(reports: DataFrame, subscribers: DataFrame, *, state: str | None = None) -> DataFrame:
    """One approved report, the first or that of ``state``, to every test subscriber."""
    approved = reports_by_status(reports, "Approved")
    if state is not None:
        approved = approved.filter(F.col("State") == state)
    report = approved.agg(F.min(F.struct("report_id", "State", "Month", "Year"))).scalar()
    rows = test_subscribers(subscribers).select("subscriber_id", "Email", report.alias("r"))
    return (
        rows.filter(F.col("r").isNotNull())
        .select("subscriber_id", "Email", "r.*")
        .select(*QUEUE, _subject("[TEST] ").alias("subject"), _outcome().alias("outcome"))
    )


def hmac_sha256(secret: str, message: Column) -> Column:
    """HMAC-SHA256 in hex, put together from ``sha2`` so that it stays inside the JVM."""
    key = secret.encode()
    if len(key) > 64:  # longer than one hash block: its digest stands for it
        key = hashlib.sha256(key).digest()
    padded = key.ljust(64, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in padded))
    outer = F.lit(bytes(b ^ 0x5C for b in padded))
    digest = F.sha2(F.concat(inner, message.cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(digest)), 256)


def unsubscribe_tokens(subscribers: DataFrame, secret: str) -> DataFrame:
    return subscribers.select("subscriber_id", hmac_sha256(secret, F.col("subscriber_id")).alias("token"))


def unsubscribe_link_check(requests: DataFrame, secret: str) -> DataFrame:
    """Requests of the link page: accepted only with md5(id-secret), which is not the token of the mails."""
    expected = F.md5(F.concat(F.col("subscriber_id"), F.lit(f"-{secret}")))
    good = F.coalesce(F.col("token") == expected, F.lit(False))
    return requests.select("subscriber_id", "token", good.alias("accepted"))


def clean_html(html: Column) -> Column:
    """Page text fit for mail: no scripts, no file links, mail style sheet in the head."""
    text = F.regexp_replace(html, SCRIPT_BLOCK, "")
    text = F.replace(text, F.lit("file://"), F.lit("https://"))
    return F.replace(text, F.lit("<head>"), F.lit(f"<head>\n{EMAIL_CSS}"))


def clean_pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", clean_html(F.col("html")).alias("html"))


def link_body(state: Column, address: Column) -> Column:
    """Body of a mail whose report has an address but no page; NULL without an address."""
    return F.concat(
        F.lit("<p>The rate report for "), state, F.lit(' is ready.</p><p><a href="'), address, F.lit('">Read the report</a></p>')
    )


def _pieces(html: Column) -> Column:
    """A page cut at the ends of its body, once per page; mails only put a footer between the pieces."""
    return F.split(html, BODY_END)


def personalized_html(
    queue: DataFrame,
    newsletters: DataFrame,
    secret: str,
    link: str = "https://example.com/unsubscribe",
    addresses: DataFrame | None = None,
) -> DataFrame:
    """One HTML body per queued mail: the state's newsletter with the subscriber's unsubscribe footer.

    ``addresses`` (report_id, Report_URL) gives mails whose edition has no page a body with the link alone. Mails with
    neither page nor address have no body and no row.
    """
    editions = newsletters.select(
        "State",
        F.date_format("month", "MM").alias("month_number"),
        F.date_format("month", "yyyy").alias("Year"),
        _pieces(clean_html(F.col("html"))).alias("page"),
    )
    footer = F.concat(
        F.lit('<hr><div class="footer"><p>This letter goes to subscribers of the monthly rate news for '),
        F.col("State"),
        F.lit(f'.</p><p><a href="{link}?id='),
        F.col("subscriber_id"),
        F.lit("&token="),
        hmac_sha256(secret, F.col("subscriber_id")),
        F.lit('">Stop these letters</a></p></div>'),
    )
    closed = F.call_function("array_join", F.col("pieces"), F.concat(footer, F.lit(BODY_END)))
    body = F.when(F.size("pieces") > 1, closed).otherwise(F.concat(F.col("pieces")[0], footer))
    mails = (
        queue.filter(F.col("outcome") == "queued")
        .withColumn("month_number", month_number(F.col("Month")))
        .join(editions, ["State", "month_number", "Year"], "left")
        .withColumn("pieces", F.col("page"))
    )
    if addresses is not None:
        mails = mails.join(addresses.select("report_id", "Report_URL"), "report_id", "left").withColumn(
            "pieces", F.coalesce("page", _pieces(link_body(F.col("State"), F.col("Report_URL"))))
        )
    return mails.filter(F.col("pieces").isNotNull()).select(
        "report_id", "subscriber_id", "Email", "subject", body.alias("html")
    )


def message_id(report: Column, subscriber: Column) -> Column:
    """Id of the mail of one report to one subscriber; the same on every run."""
    return F.md5(F.concat_ws("/", report, subscriber))


def email_log(queue: DataFrame) -> DataFrame:
    return queue.filter(F.col("outcome") == "queued").select(
        "subscriber_id", "report_id", message_id(F.col("report_id"), F.col("subscriber_id")).alias("message_id")
    )


# --- mail events --------------------------------------------------------------------------------------

# Event type in lower case -> status of the mail.
STATUS = {
    "delivery": "Delivered",
    "open": "Opened",
    "bounce": "Bounced",
    "spamcomplaint": "Spam Complaint",
    "unsubscribe": "Unsubscribed",
}
NOTE_SPAM = "Recipient marked email as spam"
NOTE_UNSUBSCRIBED = "Recipient unsubscribed"


def known_events(events: DataFrame) -> DataFrame:
    """Events with a message id and a known type; ``kind`` is the type in lower case."""
    kind = F.lower("record_type")
    return events.filter(F.col("message_id").isNotNull() & kind.isin(list(STATUS))).withColumn("kind", kind)


def period_of(ts: Column | str) -> Column:
    """Start of the hour that events are summed up by."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def email_periods(events: DataFrame) -> DataFrame:
    """What each hour does to a message: its last status, dates and notes, and its runs of opens.

    A run is named by the last other event before it in the hour. Only the run at the start of the hour, which may
    go on from the hour before, and the last run can matter later. Events of one time are in order of event_id and, where
    the table has it, of ``part``.
    """
    kind, key = F.col("kind"), F.col("key")
    part = F.col("part") if "part" in events.columns else F.lit(0)
    known = (
        known_events(events)
        .withColumn("key", F.struct("ts", "event_id", part.alias("part")))
        .withColumn("period", period_of("ts"))
    )
    other = F.when(kind != "open", key)
    opened = F.when(kind == "open", key)
    so_far = (
        Window.partitionBy("message_id", "period")
        .orderBy("key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    note = (
        F.when(kind == "bounce", F.concat(F.lit("Bounce: "), F.coalesce("description", F.lit("No description"))))
        .when(kind == "spamcomplaint", NOTE_SPAM)
        .when(kind == "unsubscribe", NOTE_UNSUBSCRIBED)
    )
    status = F.lit(None).cast("string")
    for name, text in STATUS.items():
        status = F.when(kind == name, text).otherwise(status)
    pieces = (
        known.withColumn("after", F.max(other).over(so_far))
        .groupBy("message_id", "period", "after")
        .agg(
            F.max(key).alias("last"),
            F.max_by(status, key).alias("status"),
            F.max(F.when(kind == "delivery", F.col("ts"))).alias("delivered_at"),
            F.max(F.when(kind == "bounce", F.struct(key, F.coalesce("bounce_type", F.lit("Unknown")).alias("v")))).alias("bounce"),
            F.max(F.when(note.isNotNull(), F.struct(key, note.alias("v")))).alias("note"),
            F.count(opened).alias("opens"),
            F.min(opened).alias("first"),
            F.max(opened).alias("last_open"),
        )
    )
    run = F.when(
        F.col("opens") > 0, F.struct("after", "opens", "first", F.col("last_open").alias("last"))
    )
    no_other = F.col("after").isNull()
    return pieces.groupBy("message_id", "period").agg(
        F.max("last").alias("last"),
        F.max_by("status", "last").alias("status"),
        F.max("delivered_at").alias("delivered_at"),
        F.max("bounce").getField("v").alias("bounce_type"),
        F.max("note").getField("v").alias("notes"),
        F.max("after").alias("last_other"),
        F.array_compact(
            F.array(F.max(F.when(no_other, run)), F.max(F.when(~no_other, run)))
        ).alias("runs"),
    )


def merge_periods(periods: DataFrame, emails: DataFrame) -> DataFrame:
    """Status of every logged mail from its periods.

    A run at the start of an hour goes on from the last other event of the earlier hours, so runs with
    the same such event are one run; the last one counts.
    """
    earlier = Window.partitionBy("message_id").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)

    def dated(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.struct("period", F.col(column).alias("value")))

    fold = (
        periods.withColumn("carried", F.max("last_other").over(earlier))
        .withColumn("run", F.explode_outer("runs"))
        .groupBy("message_id", F.coalesce("run.after", "carried").alias("after"))
        .agg(
            F.sum("run.opens").alias("opens"),
            F.min("run.first").alias("first"),
            F.max("run.last").alias("last"),
            F.max(dated("status")).alias("status"),
            F.max("delivered_at").alias("delivered_at"),
            F.max(dated("bounce_type")).alias("bounce_type"),
            F.max(dated("notes")).alias("notes"),
        )
        .groupBy("message_id")
        .agg(
            F.max("status").getField("value").alias("status"),
            F.max("delivered_at").alias("delivered_at"),
            F.max_by(F.col("first.ts"), "last").alias("opened_at"),
            F.max_by("opens", "last").alias("open_count"),
            F.max("bounce_type").getField("value").alias("bounce_type"),
            F.max("notes").getField("value").alias("notes"),
        )
    )
    return emails.join(fold, "message_id", "left").select(
        "message_id",
        "subscriber_id",
        "status",
        "delivered_at",
        "opened_at",
        "open_count",
        "bounce_type",
        "notes",
    )


def email_status_fold(events: DataFrame, emails: DataFrame) -> DataFrame:
    """Status of every logged mail after all its events in order of (ts, event_id).

    Status is that of the last event; the dates and notes come from the last event of their own kind. An open
    counts on from the open before it, and starts again at one after any other event, so the open count is
    the length of the last unbroken run of opens.

    Each hour of a message is summed up on its own first, so that a message with a large part of all events is
    worked on by many tasks.
    """
    return merge_periods(email_periods(events), emails)


def subscriber_deactivate(subscribers: DataFrame, emails: DataFrame, events: DataFrame) -> DataFrame:
    """Subscribers after unsubscribe events of logged mails: inactive, with the day. Spam complaints change nothing."""
    left = known_events(events).filter(F.col("kind") == "unsubscribe").groupBy("message_id").agg(F.max("ts").alias("ts"))
    gone = (
        emails.join(left, "message_id")
        .groupBy("subscriber_id")
        .agg(F.to_date(F.max("ts")).alias("unsubscribe_date"))
    )
    return subscribers.join(gone, "subscriber_id", "left").withColumn(
        "Active", F.col("Active") & F.col("unsubscribe_date").isNull()
    )


def mark_opened(statuses: DataFrame, opened: DataFrame, moment: datetime) -> DataFrame:
    """Mail statuses after the given message ids were marked as opened."""
    marked = opened.select("message_id").distinct().withColumn("marked", F.lit(True))
    hit = F.col("marked").isNotNull()
    return statuses.join(marked, "message_id", "left").select(
        "message_id",
        F.when(hit, "Opened").otherwise(F.col("status")).alias("status"),
        F.when(hit, F.lit(moment).cast("timestamp_ntz")).otherwise(F.col("opened_at")).alias("opened_at"),
    )
