"""Every operator as a runnable query over a folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.dates import month_number
from ratelens.functions.states import state_abbr
from ratelens.operators import agents, dashboard, delivery, health, ingest, market, newsletter, records
from ratelens.plans import findings
from ratelens.plans.sync import read_history, sync
from ratelens.session import configure, work_dir
from ratelens.sources import report_files, tables
from ratelens.sources.stored import read_filings
from ratelens.streaming import email_status

AS_OF = date(2001, 6, 17)
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)
STATES = {f"NATION_{i}": f"N{i}" for i in range(25)}
CARRIER = "Supplier#000000001"
SECRET = "letters"

Query = Callable[[SparkSession, str], DataFrame]


def _on(source: Callable[[SparkSession, str], DataFrame], operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return operator(source(spark, sf_dir))

    return run


def _on_two(
    first: Callable[[SparkSession, str], DataFrame],
    second: Callable[[SparkSession, str], DataFrame],
    operator: Callable[[DataFrame, DataFrame], DataFrame],
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return operator(first(spark, sf_dir), second(spark, sf_dir))

    return run


def _joined(df: DataFrame, *columns: str, by: str = "|") -> DataFrame:
    """List columns as text, so that results compare by value."""
    for column in columns:
        df = df.withColumn(column, F.array_join(F.col(column).cast("array<string>"), by))
    return df


def _sync_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two syncs: two thirds of the pages, then all of them; what each did, and what is stored in the end."""
    configure(spark)
    base = work_dir(spark, "sync")
    records = _raw_maps(spark, sf_dir)
    sync(spark, records.filter("page % 3 <> 0"), base, now=datetime(2001, 7, 1))
    sync(spark, records, base, now=datetime(2001, 7, 2), since=datetime(1990, 1, 1))
    stored = read_filings(spark, f"{base}/filings").agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.sum("Premium_Change_Number").cast("double").alias("stored_rates"),
        F.sum("Policyholders_Affected_Number").alias("stored_policies"),
    )
    counts = [f"records_{c}" for c in ("processed", "inserted", "updated", "skipped")]
    history = read_history(spark, base)
    return history.select("sync_id", "sync_mode", "status", *counts, "parsing_errors").crossJoin(stored)  # one row


def _sync_modes(history: DataFrame) -> DataFrame:
    cases = {"default": None, "manual": datetime(2024, 1, 1), "full": datetime(1900, 1, 1)}
    rows = None
    for name, since in cases.items():
        row = ingest.sync_mode_resolve(history, since).select(F.lit(name).alias("asked"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _months(filings: DataFrame) -> DataFrame:
    """Month texts as users give them: with and without a day, and one that cannot be read."""
    month = F.date_format("Effective_Date", "yyyy-MM")
    texts = F.array(month, F.concat(month, F.lit("-15")), F.concat(month, F.lit("?")))
    return filings.select(F.explode(texts).alias("month_text")).distinct()


def _policy_totals(filings: DataFrame) -> DataFrame:
    """Policyholder sums from single companies in a state up to the whole table, so that every unit occurs."""
    return (
        filings.groupBy("State", "Company")
        .agg(F.sum("Policyholders_Affected_Number").alias("policies"))
        .rollup("State", "Company")
        .agg(F.sum("policies").alias("policies"))
    )


def _report_changes(reports: DataFrame) -> DataFrame:
    """Generated reports get approved, approved ones are sent, and the reports of May get a new name."""
    new_status = F.when(F.col("Status") == "Generated", "Approved").when(F.col("Status") == "Approved", "Sent")
    new_name = F.when(month_number(F.col("Month")) == "05", F.concat(F.lit("May in "), F.col("State")))
    changes = reports.select("report_id", new_status.alias("new_status"), new_name.alias("new_name"))
    return changes.filter("new_status IS NOT NULL OR new_name IS NOT NULL")


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.send_queue(tables.reports(spark, sf_dir), tables.subscribers(spark, sf_dir))


def _test_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.test_send_queue(tables.reports(spark, sf_dir), tables.subscribers(spark, sf_dir))


def _newsletters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newsletter.newsletter_html(newsletter.newsletter_batch(tables.filings(spark, sf_dir)))


def _report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    editions = _newsletters(spark, sf_dir)
    return report_files.report_sink(editions, work_dir(spark, "newsletters"))


def _personalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails of all queued reports; the editions of October have no page, only an address."""
    configure(spark)
    reports = tables.reports(spark, sf_dir)
    address = F.concat(F.lit("https://reports.example.com/"), F.col("path"))
    addresses = delivery.report_paths(reports).select("report_id", address.alias("Report_URL"))
    pages = _newsletters(spark, sf_dir).filter(F.month("month") != 10)
    return delivery.personalized_html(_queue(spark, sf_dir), pages, SECRET, addresses=addresses)


def _fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.email_status_fold(tables.email_events(spark, sf_dir), tables.emails(spark, sf_dir))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of JSON texts, and the status after the last of them."""
    configure(spark)
    from ratelens.sources.schemas import EMAIL_EVENTS

    raw = spark.readStream.schema(EMAIL_EVENTS).parquet(f"{sf_dir}/events.parquet*")
    emails = tables.emails(spark, sf_dir)
    folder = work_dir(spark, "email-status")
    texts = email_status.payload_text(raw.selectExpr(*tables.EVENT_COLUMNS))
    email_status.run_to_table(email_status.read_payloads(texts), emails, folder)
    return email_status.latest_status(spark, folder, emails)


def _mark_opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a tracked open are marked by hand."""
    configure(spark)
    opened = tables.email_events(spark, sf_dir).filter("record_type = 'Open' AND event_id % 2 = 0")
    return delivery.mark_opened(_fold(spark, sf_dir), opened, datetime(2024, 3, 1, 12))


def _deactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return delivery.subscriber_deactivate(
        tables.subscribers(spark, sf_dir), tables.emails(spark, sf_dir), tables.email_events(spark, sf_dir)
    )


def _tokens(subscribers: DataFrame) -> DataFrame:
    return delivery.unsubscribe_tokens(subscribers, SECRET)


def _unsubscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return delivery.unsubscribe_link_check(tables.unsubscribe_requests(spark, sf_dir, SECRET), SECRET)


def _raw_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.raw_field_maps(tables.raw_records(spark, sf_dir))


def _raw_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tables.raw_records(spark, sf_dir)
    return records.withColumn("modified", F.to_timestamp_ntz(F.substring("last_modified_raw", 1, 19)))


def _refined(df: DataFrame) -> DataFrame:
    return agents.rate_increases_refined(df, CARRIER, as_of=AS_OF)


def _round_trip(filings: DataFrame) -> DataFrame:
    return records.filing_from_json(records.filing_to_json(filings))


def _diagnosis(raw: DataFrame) -> DataFrame:
    found = ingest.diagnose_rate_change(raw, "rate_change_raw", sample_size=1000)
    issues = F.transform("issues", lambda i: F.concat_ws("=", i["id"], i["raw"]))
    return found.select("valid_count", F.array_join(issues, "|").alias("issues"))


def _agent_batch(filings: DataFrame) -> DataFrame:
    batch = agents.agent_report_batch(filings, as_of=AS_OF)
    names = F.transform("top_opportunities", lambda o: F.concat_ws(":", o["competitor"], o["commission"]))
    return batch.withColumn("top_opportunities", F.array_join(names, "|"))


def _newsletter_batch(filings: DataFrame) -> DataFrame:
    batch = newsletter.newsletter_batch(filings)
    card = F.transform(
        "cards", lambda c: F.concat_ws(":", c["company"], c["change_pct"], c["policies"], c["effective_date"])
    )
    return batch.select(
        "State",
        "month",
        state_abbr(F.col("State")).alias("state_abbr"),
        "product_line",
        "companies",
        "avg_increase_pct",
        "policies_affected",
        F.array_join(card, "|").alias("cards"),
        "stats.*",
    )


_v2 = lambda df: agents.opportunities_v2(df, as_of=AS_OF)
_text_v2 = ["State", "Company", "rank", "competitor"]

QUERIES: dict[str, Query] = {
    # ingest
    "filings_scan": _on(
        tables.filings,
        lambda f: ingest.filings_scan(
            f,
            ["Record_ID", "Company", "State", "Premium_Change_Number"],
            (F.col("Effective_Date") >= F.lit(date(2000, 6, 17))) & (F.col("Premium_Change_Number") > 0),
        ).withColumn("Premium_Change_Number", F.col("Premium_Change_Number").cast("double")),
    ),
    "raw_to_filings": _on(_raw_maps, lambda r: _as_doubles(ingest.raw_to_filings(r))),
    "parse_number": _on(tables.raw_records, lambda r: ingest.parse_numbers(r, "rate_change_raw")),
    "parse_date": _on(tables.date_texts, lambda r: ingest.parse_dates(r, "raw")),
    "parse_timestamp": _on(tables.raw_records, lambda r: ingest.parse_timestamps(r, "last_modified_raw")),
    "parse_error_count": _on(_raw_maps, ingest.parse_error_count),
    "sync_mode_resolve": _on(tables.sync_history, _sync_modes),
    "incremental_filter": _on(
        _raw_with_time,
        lambda r: ingest.incremental_filter(r, datetime(2001, 6, 17, 10, 35), "modified").select("id", "modified"),
    ),
    "duplicate_id_guard": _on(tables.raw_pages, lambda p: ingest.duplicate_ids(p, "id")),
    "upsert_newer_wins": _on_two(
        tables.sync_target,
        tables.sync_batch,
        lambda t, b: ingest.upsert(t, b).select(
            "Record_ID",
            "Company",
            "State",
            F.col("Premium_Change_Number").cast("double").alias("Premium_Change_Number"),
            "Effective_Date",
            "SERFF_Tracking_Number",
            "Airtable_Last_Modified",
        ),
    ),
    "upsert_change_counts": _on_two(tables.sync_target, tables.sync_batch, ingest.upsert_change_counts),
    "sync_run": _sync_run,
    "sync_status": _on_two(tables.sync_history, tables.filings_ext, ingest.sync_status),
    "sync_history_recent": _on(tables.sync_history, ingest.sync_history_recent),
    "last_successful_sync": _on(tables.sync_history, ingest.last_successful_sync),
    "sync_mode_backfill": _on(tables.sync_history, ingest.sync_mode_backfill),
    "schema_conform": _on(tables.old_filings, lambda o: _as_doubles(ingest.schema_conform(o))),
    "field_value_profile": _on(tables.raw_records, lambda r: ingest.field_value_profile(r, "policyholders_raw")),
    "diagnose_rate_change": _on(tables.raw_records, _diagnosis),
    "validate_numeric_fields": _on(
        tables.raw_records,
        lambda r: ingest.validate_numeric_fields(r, ["rate_change_raw", "policyholders_raw", "premium_raw"]),
    ),
    "updated_since": _on(tables.filings_ext, lambda f: ingest.updated_since(f, datetime(2001, 6, 17))),
    "timestamp_coverage": _on(tables.filings_ext, ingest.timestamp_coverage),
    "report_sink": _report_sink,
    "report_log": _on(
        tables.filings, lambda f: _joined(delivery.report_log(newsletter.rate_cards(f)), "Filings")
    ),
    # market
    "market_overview": _on(tables.filings, lambda f: market.market_overview(f, as_of=AS_OF)),
    "state_analysis": _on(tables.filings, lambda f: market.state_analysis(f, as_of=AS_OF)),
    "company_rankings": _on(tables.filings, lambda f: market.company_rankings(f, as_of=AS_OF)),
    "hot_zones": _on(tables.filings, lambda f: market.hot_zones(f, as_of=AS_OF)),
    "trend_analysis": _on(tables.filings, lambda f: market.trend_analysis(f, as_of=AS_OF)),
    "outlier_filings": _on(tables.filings_ext, lambda f: market.outlier_filings(f, as_of=AS_OF)),
    "competitive_positioning": _on(tables.filings, lambda f: market.competitive_positioning(f, as_of=AS_OF)),
    "company_search": _on(tables.filings, lambda f: market.company_search(f, "0001")),
    "key_findings": _on(tables.filings, lambda f: findings.key_findings(f, as_of=AS_OF)),
    "strategic_insights": _on(tables.filings, lambda f: findings.strategic_insights(f, as_of=AS_OF)),
    "trend_bars": _on(tables.filings, lambda f: market.trend_bars(market.trend_analysis(f, as_of=AS_OF))),
    # agents
    "carrier_resolve": _on(tables.filings, lambda f: agents.carrier_resolve(f, "0001")),
    "agent_rate": _on(
        tables.filings,
        lambda f: agents.agent_rate(f, as_of=AS_OF).withColumn("avg_rate", F.round("avg_rate", 6)),
    ),
    "opportunities_v1": _on(tables.filings_ext, lambda f: agents.opportunities_v1(f, as_of=AS_OF)),
    "market_summary_v1": _on(tables.filings, lambda f: agents.market_summary_v1(f, as_of=AS_OF)),
    "market_position": _on(tables.filings, lambda f: agents.market_position(f, as_of=AS_OF)),
    "market_position_total": _on(tables.filings, lambda f: agents.market_position_total(f, as_of=AS_OF)),
    "opportunities_v2": _on(tables.filings, _v2),
    "commission_opportunity": _on(
        tables.filings,
        lambda f: agents.commission_opportunity(_v2(f)).select(
            *_text_v2, "policies", "win_probability", "commission_opportunity"
        ),
    ),
    "target_segments": _on(
        tables.filings,
        lambda f: _joined(agents.opportunity_segments(_v2(f)).select(*_text_v2, "segments"), "segments"),
    ),
    "action_window": _on(
        tables.filings,
        lambda f: agents.opportunity_windows(_v2(f)).select(*_text_v2, "days_until", "action_window"),
    ),
    "agent_summary_v2": _on(tables.filings, lambda f: agents.agent_summary_v2(f, as_of=AS_OF)),
    "rate_increases_refined": _on(tables.filings, lambda f: _joined(_refined(f), "recent_changes")),
    "refined_summary": _on(tables.filings, lambda f: agents.refined_summary(f, CARRIER, as_of=AS_OF)),
    "urgency": _on(tables.filings, lambda f: agents.urgency(_refined(f))),
    "outreach_timeline": _on(tables.filings, lambda f: agents.outreach_timeline(_refined(f))),
    "opportunities_v3": _on(tables.filings, lambda f: agents.opportunities_v3(f, as_of=AS_OF)),
    "weekly_filing_trend": _on(tables.filings, lambda f: agents.weekly_filing_trend(f, as_of=AS_OF)),
    "agent_revenue_v3": _on(tables.filings, lambda f: agents.agent_revenue_v3(f, as_of=AS_OF)),
    "agent_timeline": _on(tables.filings_ext, lambda f: agents.agent_timeline(f, as_of=AS_OF)),
    "clean_company_name": _on(tables.carrier_names, agents.cleaned_names),
    "company_initials": _on(tables.carrier_names, agents.initials),
    "agent_report_batch": _on(tables.filings, _agent_batch),
    # newsletter
    "month_bounds": _on(
        tables.filings, lambda f: newsletter.month_bounds(_months(f), "month_text", as_of=AS_OF)
    ),
    "state_activity": _on(tables.filings, newsletter.state_activity),
    "top_product_line": _on(tables.filings, newsletter.top_product_line),
    "newsletter_summary": _on(tables.filings, newsletter.newsletter_summary),
    "rate_cards": _on(
        tables.filings,
        lambda f: newsletter.rate_cards(f).withColumn("change_pct", F.col("change_pct").cast("double")),
    ),
    "overall_stats": _on(tables.filings, newsletter.overall_stats),
    "format_number_short": _on(
        tables.filings, lambda f: newsletter.short_numbers(_policy_totals(f), "policies", "short")
    ),
    "state_abbr": _on(tables.state_texts, lambda s: newsletter.state_abbreviations(s, "state_text")),
    "card_display": _on(
        tables.filings_unnamed, lambda f: newsletter.card_display(newsletter.rate_cards(f))
    ),
    "newsletter_batch": _on(tables.filings, _newsletter_batch),
    "pending_reports": _on_two(tables.filings, tables.reports, newsletter.pending_reports),
    "newsletter_html": lambda spark, sf_dir: _joined(_newsletters(configure(spark), sf_dir), "filings"),
    # dashboard
    "dashboard_kpis": _on(tables.filings, lambda f: dashboard.dashboard_kpis(f, None, FIRST_DAY, LAST_DAY)),
    "state_carrier_rates": _on(
        tables.filings, lambda f: dashboard.state_carrier_rates(f, None, FIRST_DAY, LAST_DAY)
    ),
    "state_heatmap": _on(
        tables.filings, lambda f: dashboard.state_heatmap(f, None, FIRST_DAY, LAST_DAY, list(STATES))
    ),
    "carrier_performance_index": _on(
        tables.filings,
        lambda f: dashboard.carrier_performance_index(f, None, FIRST_DAY, LAST_DAY, base=FIRST_DAY),
    ),
    "market_share_evolution": _on(
        tables.filings, lambda f: dashboard.market_share_evolution(f, None, FIRST_DAY, LAST_DAY)
    ),
    "positioning_matrix": _on(tables.filings, lambda f: dashboard.positioning_matrix(f, None)),
    "positioning_quadrant": _on(
        tables.filings, lambda f: dashboard.positioning_quadrant(dashboard.positioning_matrix(f, None))
    ),
    "competitive_alerts": _on(tables.filings, lambda f: dashboard.competitive_alerts(f, None)),
    # health
    "missing_state_years": _on(
        tables.filings_gap, lambda f: health.missing_state_years(f, STATES, 1995, 2002)
    ),
    "missing_states_by_year": _on(
        tables.filings_gap,
        lambda f: _joined(health.missing_states_by_year(f, STATES, 1995, 2002), "missing_states"),
    ),
    "perfect_duplicates": _on(tables.filings_copies, lambda f: _as_doubles(health.perfect_duplicates(f))),
    "year_overview": _on(tables.filings, health.year_overview),
    "record_count": _on(tables.filings, health.record_count),
    "top_states": _on(tables.filings, health.top_states),
    "rate_statistics": _on(tables.filings, health.rate_statistics),
    "top_companies": _on(tables.filings, health.top_companies),
    "date_range": _on(tables.filings, health.date_range),
    "completeness": _on(tables.filings, health.completeness),
    "sync_outcomes": _on(tables.sync_history, health.sync_outcomes),
    "cross_page_duplicates": _on(tables.raw_pages, health.cross_page_duplicates),
    "page_totals": _on(tables.raw_pages, health.page_totals),
    # subscribers, reports, mail
    "subscribers_by_state": _on(
        tables.subscribers, lambda s: delivery.subscribers_by_state(s, "NATION_1")
    ),
    "test_subscribers": _on(tables.subscribers, delivery.test_subscribers),
    "reports_by_status": _on(
        tables.reports, lambda r: delivery.reports_by_status(r, "Approved", year="2001")
    ),
    "report_lookup": _on(tables.reports, delivery.report_lookup),
    "report_status_update": _on(
        tables.reports, lambda r: delivery.report_status_update(r, _report_changes(r))
    ),
    "email_valid": _on(tables.subscribers, delivery.email_valid),
    "send_queue": lambda spark, sf_dir: _queue(configure(spark), sf_dir),
    "test_send_queue": lambda spark, sf_dir: _test_queue(configure(spark), sf_dir),
    "sent_reports": lambda spark, sf_dir: delivery.sent_reports(_queue(configure(spark), sf_dir)),
    "unsubscribe_token": _on(tables.subscribers, _tokens),
    "unsubscribe_link_check": _unsubscribe,
    "clean_html": _on(lambda spark, d: tables.table(spark, d, "pages"), delivery.clean_pages),
    "personalized_html": _personalized,
    "email_status_fold": lambda spark, sf_dir: _fold(configure(spark), sf_dir),
    "email_status_stream": _stream,
    "subscriber_deactivate": _deactivate,
    "email_log": lambda spark, sf_dir: delivery.email_log(_queue(configure(spark), sf_dir)),
    "month_normalize": _on(tables.month_texts, lambda m: delivery.month_normalize(m, "month_text")),
    "report_path": _on(tables.reports, delivery.report_paths),
    "mark_opened": _mark_opened,
    # records
    "normalize_filing": _on(
        tables.source_filings, lambda r: records.normalize_filing(r, as_of=AS_OF)
    ),
    "filing_json": _on(tables.source_filings, _round_trip),
    "normalize_agent": _on(tables.agents, records.normalize_agent),
    "personalized_filings": _on_two(tables.agents, tables.filings, records.personalized_filings),
    "filings_of_agent": _on_two(
        tables.agents,
        tables.filings,
        lambda a, f: records.filings_of_agent(a, f, "agent-1").select(
            "Record_ID", "Company", "State", F.col("Premium_Change_Number").cast("double").alias("Premium_Change_Number"), "Effective_Date"
        ),
    ),
    "get_filings": _on(
        tables.filings, lambda f: _as_doubles(records.get_filings(f, state="NATION_5"))
    ),
    "filing_stats": _on(tables.filings_ext, lambda f: records.filing_stats(f, as_of=AS_OF)),
    "market_trends": _on(
        tables.filings, lambda f: _joined(records.market_trends(f, as_of=AS_OF), "most_active_companies")
    ),
    "competitive_landscape": _on(tables.filings, lambda f: records.competitive_landscape(f, as_of=AS_OF)),
    "insights": _on(tables.filings, lambda f: findings.insights(f, as_of=AS_OF)),
}


def _as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles and integers as bigint, so that both engines name the same types."""
    wider = {"decimal": "double", "int": "bigint"}
    return df.select(
        *[F.col(c).cast(wider[t.split("(")[0]]).alias(c) if t.split("(")[0] in wider else F.col(c) for c, t in df.dtypes]
    )
