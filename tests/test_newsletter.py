from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ratelens.functions.numeric import short_number
from ratelens.functions.states import state_abbr
from ratelens.operators import newsletter
from ratelens.sources.report_files import report_sink


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_short_numbers(spark):
    given = [None, 999, 1000, 1250, 999_999, 1_000_000, 8_200_000_000, -5, 10_000]
    assert values(spark, given, "v bigint", short_number(F.col("v"))) == [
        "N/A", "999", "1K", "1.3K", "1000K", "1M", "8.2B", "-5", "10K",
    ]


def test_state_abbreviations(spark):
    given = ["Florida", " ohio ", "TX", "Puerto Rico", "West Virginia"]
    assert values(spark, given, "v string", state_abbr(F.col("v"))) == ["FL", "OH", "TX", "PU", "WV"]


def test_month_bounds(spark, as_of):
    df = spark.createDataFrame([("2024-12",), ("2024-02-29",), ("bad",)], "m string")
    rows = {r.m: (r.start_date, r.end_date, r.label) for r in newsletter.month_bounds(df, "m", as_of=as_of).collect()}
    assert rows["2024-12"] == (date(2024, 12, 1), date(2025, 1, 1), "December 2024")
    assert rows["2024-02-29"] == (date(2024, 2, 29), date(2024, 3, 1), "February 2024")
    assert rows["bad"] == (date(2024, 6, 1), date(2024, 7, 1), "June 2024")


def test_cards_go_by_impact_with_unknown_last(make):
    df = make(
        {"Record_ID": "a", "Impact_Score": None, "Premium_Change_Number": "0.9"},
        {"Record_ID": "b", "Impact_Score": "2", "Premium_Change_Number": "0.01"},
        {"Record_ID": "c", "Impact_Score": "2", "Premium_Change_Number": "0.02"},
        {"Record_ID": "d", "Impact_Score": "1", "Premium_Change_Number": "0.03"},
        {"Record_ID": "e", "Impact_Score": "9", "Premium_Change_Number": "-0.03"},
    )
    cards = newsletter.rate_cards(df).orderBy("place").collect()
    assert [c.Record_ID for c in cards] == ["c", "b", "d"]


def test_card_names(make):
    df = make(
        {"Record_ID": "a", "Company": "", "Subsidiary": "Sub"},
        {"Record_ID": "b", "Company": "Not specified in document", "Subsidiary": None},
        {"Record_ID": "c", "Company": None, "Subsidiary": "", "Policyholders_Affected_Number": None},
    )
    rows = {r.Record_ID: r for r in newsletter.card_display(newsletter.rate_cards(df)).collect()}
    assert [rows[k].company for k in "abc"] == ["Sub", "N/A", "N/A"]
    assert rows["c"].policies == "0" and rows["a"].effective_date == "Jun 15" and rows["a"].change_pct == "5.0"


def test_batch_agrees_with_its_parts(make, as_of):
    rows = [
        {
            "State": s,
            "Company": f"C{i % 4}" if i % 7 else None,
            "Product_Line": ["Auto", "Home", None][(i + len(s)) % 3],
            "Effective_Date": as_of - timedelta(days=i * 9),
            "Premium_Change_Number": ["0.05", "-0.01", None, "0"][i % 4],
        }
        for s in ("Ohio", "Texas")
        for i in range(25)
    ]
    df = make(*rows)
    batch = {(r.State, r.month): r for r in newsletter.newsletter_batch(df).collect()}
    summary = {(r.State, r.month): r for r in newsletter.newsletter_summary(df).collect()}
    lines = {(r.State, r.month): r.product_line for r in newsletter.top_product_line(df).collect()}
    assert set(batch) == set(summary) == set(lines)
    for key, row in batch.items():
        assert row.companies == summary[key].companies
        assert row.avg_increase_pct == summary[key].avg_increase_pct
        assert row.policies_affected == str(summary[key].policies)
        assert row.product_line == lines[key]
        assert len(row.cards) <= 3 and row.stats.total_filings == "50"


def test_empty_edition_raises(make, as_of):
    batch = newsletter.newsletter_batch(make({}))
    assert newsletter.require_edition(batch, "Ohio", date(2024, 6, 1)).count() == 1
    with pytest.raises(newsletter.NoDataError):
        newsletter.require_edition(batch, "Iowa", date(2024, 6, 1))


def test_html_and_files(make, spark, tmp_path):
    df = make({"Company": "A <b> & Co", "Premium_Change_Number": "0.16", "Policyholders_Affected_Number": 81_900})
    pages = newsletter.newsletter_html(newsletter.newsletter_batch(df))
    html = pages.first().html
    assert "A &lt;b&gt; &amp; Co" in html and "+16.0%" in html and "81.9K" in html and "June 30, 2024" in html
    rows = report_sink(pages, str(tmp_path)).collect()
    assert [r.path for r in rows] == ["OH/2024/June/OH_06_2024.html"]
    assert (tmp_path / rows[0].path).read_text(encoding="utf-8") == html
    assert len(list((tmp_path / "OH/2024/June").iterdir())) == 1


def test_pending(make, spark):
    df = make({}, {"State": "Iowa"})
    reports = spark.createDataFrame([("Ohio", "06", "2024")], "State string, Month string, Year string")
    assert [r.State for r in newsletter.pending_reports(df, reports).collect()] == ["Iowa"]


def test_editions_count_companies_that_raise_rates(make):
    rows = [("Acme", "0.05", "Auto"), ("Acme", "0.07", "Home"), ("Beta", "-0.05", "Auto"), (None, "0.03", None), ("Cora", None, "Home"), ("Dora", "0.01", "Auto")]
    df = make(*[{"Company": c, "Premium_Change_Number": r, "Product_Line": p} for c, r, p in rows])
    editions = newsletter._editions(df, None, None)
    (row,) = editions.collect()
    assert (row.companies, row.avg_increase_pct, row.policies_affected, row.product_line) == (2, 4.0, "40", "Auto")
    # no second copy of the filings that raise no rate, and no sums per company
    assert "Expand" not in editions._jdf.queryExecution().optimizedPlan().toString()
