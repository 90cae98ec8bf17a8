import hashlib
import hmac
import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ratelens.operators import delivery, newsletter
from ratelens.streaming import email_status

EVENTS = "event_id bigint, ts timestamp_ntz, message_id string, record_type string, bounce_type string, description string"
START = datetime(2024, 1, 1)


def replay(events):
    """The fold one event at a time, as the mail handler would do it."""
    state = {}
    for event_id, ts, message, kind, bounce, text in sorted(events, key=lambda e: (e[1], e[0])):
        if message is None:
            continue
        s = state.setdefault(message, dict.fromkeys(["status", "delivered", "opened", "count", "bounce", "notes"]))
        kind = kind.lower()
        if kind == "delivery":
            s.update(status="Delivered", delivered=ts)
        elif kind == "open":
            if s["status"] == "Opened":
                s["count"] += 1
            else:
                s.update(status="Opened", opened=ts, count=1)
        elif kind == "bounce":
            s.update(status="Bounced", bounce=bounce or "Unknown", notes=f"Bounce: {text or 'No description'}")
        elif kind == "spamcomplaint":
            s.update(status="Spam Complaint", notes="Recipient marked email as spam")
        elif kind == "unsubscribe":
            s.update(status="Unsubscribed", notes="Recipient unsubscribed")
    return {m: tuple(s.values()) for m, s in state.items()}


def found(df):
    return {
        r.message_id: (r.status, r.delivered_at, r.opened_at, r.open_count, r.bounce_type, r.notes) for r in df.collect()
    }


def random_events(n, seed):
    rng = random.Random(seed)
    kinds = ["Open"] * 6 + ["Delivery", "Bounce", "SpamComplaint", "Unsubscribe", "Click", "OPEN"]
    rows = []
    for i in range(n):
        message = "hot" if rng.random() < 0.4 else f"m{rng.randrange(12)}"
        ts = START + timedelta(hours=rng.randrange(24 * 40))
        rows.append((i, ts, message, rng.choice(kinds), rng.choice([None, "Hard"]), rng.choice([None, "full"])))
    return rows


def mails(spark, events):
    ids = sorted({e[2] for e in events if e[2]})
    return spark.createDataFrame([(m, f"s-{m}") for m in ids], "message_id string, subscriber_id string")


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_replay(spark, seed):
    events = random_events(600, seed)
    got = found(delivery.email_status_fold(spark.createDataFrame(events, EVENTS), mails(spark, events)))
    nothing = (None,) * 6
    assert got == {m: replay(events).get(m, nothing) for m in got}


def test_fold_cases(spark):
    def at(i):
        return START + timedelta(days=i)

    events = [
        (1, at(1), "a", "Open", None, None), (2, at(2), "a", "Open", None, None), (3, at(3), "a", "Delivery", None, None),
        (4, at(4), "a", "Open", None, None), (5, at(5), "a", "Bounce", None, None),
        (6, at(6), "b", "Unsubscribe", None, None), (7, at(7), "b", "Open", None, None), (8, at(30), "b", "Open", None, None),
        (9, at(8), None, "Open", None, None), (10, at(9), "unknown", "Open", None, None), (11, at(9), "c", "Click", None, None),
    ]
    log = spark.createDataFrame([(m, m) for m in "abcd"], "message_id string, subscriber_id string")
    got = found(delivery.email_status_fold(spark.createDataFrame(events, EVENTS), log))
    assert got["a"] == ("Bounced", at(3), at(4), 1, "Unknown", "Bounce: No description")
    assert got["b"] == ("Opened", None, at(7), 2, None, "Recipient unsubscribed")
    assert got["c"] == got["d"] == (None,) * 6 and set(got) == set("abcd")


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch(spark, tmp_path, files):
    events = random_events(300, 5)
    random.Random(files).shuffle(events)
    size = -(-len(events) // files)
    for i in range(files):
        part = spark.createDataFrame(events[i * size : (i + 1) * size], EVENTS)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = mails(spark, events)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "out")
    email_status.run_to_table(stream, log, folder)
    got = found(email_status.latest_status(spark, folder, log))
    assert got == found(delivery.email_status_fold(spark.createDataFrame(events, EVENTS), log))


def test_payloads_single_and_list(spark):
    one = {"MessageID": "m", "RecordType": "Delivery", "DeliveredAt": "2024-01-01T00:00:05Z"}
    lines = [(1, json.dumps(one)), (2, json.dumps([{**one, "RecordType": "Open", "DeliveredAt": None, "ReceivedAt": "2024-01-02T00:00:00Z"}] * 2))]
    rows = email_status.read_payloads(spark.createDataFrame(lines, "event_id bigint, value string")).orderBy("event_id", "part").collect()
    assert [(r.event_id, r.part, r.record_type) for r in rows] == [(1, 0, "Delivery"), (2, 0, "Open"), (2, 1, "Open")]
    assert rows[0].ts == datetime(2024, 1, 1, 0, 0, 5) and rows[2].ts == datetime(2024, 1, 2)


def test_long_payload_lists_keep_their_events_apart(spark):
    one = {"MessageID": "m", "RecordType": "Open", "ReceivedAt": "2024-01-01T00:00:05Z"}
    lines = [(i, json.dumps([one] * 1001)) for i in (1, 2)]
    events = email_status.read_payloads(spark.createDataFrame(lines, "event_id bigint, value string"))
    assert events.select("event_id", "part").distinct().count() == 2002
    mails_ = spark.createDataFrame([("m", "s")], "message_id string, subscriber_id string")
    assert delivery.email_status_fold(events, mails_).first().open_count == 2002


def test_many_events_of_one_message_spread_over_periods(spark):
    start = datetime(2024, 1, 1)
    events = spark.range(100_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "'m' AS message_id",
        "CASE WHEN id % 1000 = 7 THEN 'Delivery' ELSE 'Open' END AS record_type", "CAST(NULL AS STRING) AS bounce_type",
        "CAST(NULL AS STRING) AS description",
    )
    periods = delivery.email_periods(events)
    assert periods.count() == 28 and max(len(r.runs) for r in periods.collect()) <= 2
    row = delivery.merge_periods(periods, spark.createDataFrame([("m", "s")], "message_id string, subscriber_id string")).first()
    assert (row.status, row.open_count) == ("Opened", 992) and row.delivered_at > start


@pytest.mark.parametrize("secret", ["secret", "x" * 64, "y" * 65, "é" * 70])
def test_hmac(spark, secret):
    df = spark.createDataFrame([("sub-1",), ("é",)], "subscriber_id string")
    for r in delivery.unsubscribe_tokens(df, secret).collect():
        assert r.token == hmac.new(secret.encode(), r.subscriber_id.encode(), hashlib.sha256).hexdigest()


def test_log_is_read_back_and_no_mail_is_lost(spark, make):
    filings = make(*[{"Effective_Date": date(2024, m, 3), "State": s} for m in (3, 4) for s in ("Ohio", "Iowa")])
    log = delivery.report_log(newsletter.rate_cards(filings))
    assert newsletter.pending_reports(filings, log).count() == 0
    assert newsletter.pending_reports(filings, log.filter("State = 'Ohio'")).count() == 2
    approved = log.withColumn("Status", F.lit("Approved")).withColumn("report_id", F.concat_ws("/", "State", "Month"))
    people = spark.createDataFrame([("s1", "Ohio,Iowa", "a@b.co", True, False)], "subscriber_id string, State string, Email string, Active boolean, Test boolean")
    queue = delivery.send_queue(approved, people, month="03", year="2024")
    letters = newsletter.newsletter_html(newsletter.newsletter_batch(filings))
    assert queue.count() == delivery.personalized_html(queue, letters, "k").count() == 2


def test_state_is_matched_whole(spark):
    rows = [("1", "Virginia", True), ("2", "West Virginia", True), ("3", "Ohio, Virginia", True), ("4", "Virginia", False)]
    df = spark.createDataFrame(rows, "subscriber_id string, State string, Active boolean")
    got = delivery.subscribers_by_state(df, "Virginia").collect()
    assert sorted(r.subscriber_id for r in got) == ["1", "3"]


def test_queue_and_status(spark):
    reports = spark.createDataFrame(
        [("r1", "n", "Ohio", "06", "2024", "Approved"), ("r2", "n", "Iowa", "06", "2024", "Approved"), ("r3", "n", "Ohio", "05", "2024", "Sent")],
        "report_id string, Name string, State string, Month string, Year string, Status string",
    )
    subscribers = spark.createDataFrame(
        [("s1", "Ohio,Iowa", "a@b.co", True, False), ("s2", "Ohio", None, True, True), ("s3", "Ohio", "bad", True, False), ("s4", "Ohio", "x@y.zz", False, False)],
        "subscriber_id string, State string, Email string, Active boolean, Test boolean",
    )
    queue = delivery.send_queue(reports, subscribers)
    got = {(r.report_id, r.subscriber_id): r.outcome for r in queue.collect()}
    assert got == {("r1", "s1"): "queued", ("r2", "s1"): "queued", ("r1", "s2"): "skipped", ("r1", "s3"): "invalid"}
    assert queue.first().subject.endswith("Insurance Market Update - 06 2024")
    after = delivery.report_status_update(reports, delivery.sent_reports(queue))
    assert {r.report_id: r.Status for r in after.collect()} == {"r1": "Sent", "r2": "Sent", "r3": "Sent"}
    test = delivery.test_send_queue(reports, subscribers).collect()
    assert [(r.report_id, r.subscriber_id, r.subject[:6]) for r in test] == [("r1", "s2", "[TEST]")]
    assert delivery.test_send_queue(reports, subscribers, state="Utah").count() == 0


def test_clean_html(spark):
    html = '<HEAD><head><SCRIPT type="x">if (a<b) {}</script ></SCRIPT><script>1</script>\n<a href="file://x"><scripted>'
    df = spark.createDataFrame([(html,)], "h string")
    text = df.select(delivery.clean_html(F.col("h"))).first()[0]
    assert "if (a" not in text and ">1<" not in text and "https://x" in text and "<scripted>" in text
    assert "<head>\n<style>" in text


def test_months(spark):
    df = spark.createDataFrame([(m,) for m in ("March", "mar", "03", "3", "Ma", "zzz", "")], "m string")
    rows = {r.m: (r.month_number, r.month_name, r.loose_number) for r in delivery.month_normalize(df, "m").collect()}
    assert rows["March"] == rows["mar"] == ("03", "March", "03") and rows["03"] == ("03", "March", "01")
    assert rows["Ma"] == (None, None, "03") and rows["zzz"] == rows[""] == (None, None, "01")


def test_footer(spark):
    queue = spark.createDataFrame(
        [("r", "s", "a@b.co", "sub", "Ohio", "06", "2024", "queued")],
        "report_id string, subscriber_id string, Email string, subject string, State string, Month string, Year string, outcome string",
    )
    for html, tail in (("<body>x</body>", "</div></body>"), ("x", "</div>")):
        pages = spark.createDataFrame([("Ohio", datetime(2024, 6, 1).date(), html)], "State string, month date, html string")
        body = delivery.personalized_html(queue, pages, "k").first().html
        assert body.endswith(tail) and "monthly rate news for Ohio" in body and "?id=s&token=" in body


def test_link_only_body(spark):
    queue = spark.createDataFrame(
        [("r1", "s", "a@b.co", "sub", "Ohio", "June", "2024", "queued"), ("r2", "s", "a@b.co", "sub", "Iowa", "June", "2024", "queued")],
        "report_id string, subscriber_id string, Email string, subject string, State string, Month string, Year string, outcome string",
    )
    pages = spark.createDataFrame([], "State string, month date, html string")
    addresses = spark.createDataFrame([("r1", "https://x/r1")], "report_id string, Report_URL string")
    assert delivery.personalized_html(queue, pages, "k").count() == 0
    (row,) = delivery.personalized_html(queue, pages, "k", addresses=addresses).collect()
    assert row.report_id == "r1" and 'href="https://x/r1"' in row.html and "?id=s&token=" in row.html


def test_pages_are_cut_once_and_not_per_mail(spark):
    queue = spark.createDataFrame(
        [("r", f"s{i}", "a@b.co", "sub", "Ohio", "06", "2024", "queued") for i in range(2)],
        "report_id string, subscriber_id string, Email string, subject string, State string, Month string, Year string, outcome string",
    )
    for html, footers in (("<body>x</body>y</body>", 2), ("</body>", 1), ("", 1), ("x", 1)):
        pages = spark.createDataFrame([("Ohio", datetime(2024, 6, 1).date(), html)], "State string, month date, html string")
        mails = delivery.personalized_html(queue, pages, "k")
        for mail in mails.collect():
            footer = mail.html[mail.html.index("<hr>") : mail.html.index("</div>") + 6]
            assert f"?id={mail.subscriber_id}&token=" in footer and mail.html.count(footer) == footers
            assert mail.html.replace(footer, "") == html
        plan = mails._jdf.queryExecution().optimizedPlan().toString()
        assert "split(" in plan.split("Join", 1)[1] and "split(" not in plan.split("Join", 1)[0]
