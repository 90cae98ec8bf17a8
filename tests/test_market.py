from datetime import date, timedelta

from ratelens.operators import market
from ratelens.plans import findings


def test_overview_counts_signs_and_ignores_the_future(make, as_of):
    df = make(
        {"Premium_Change_Number": "0.10"},
        {"Premium_Change_Number": "0"},
        {"Premium_Change_Number": "-0.04", "State": "Iowa", "Company": "Best"},
        {"Premium_Change_Number": None},
        {"Effective_Date": as_of + timedelta(days=1)},
    )
    row = market.market_overview(df, as_of=as_of).first()
    assert (row.total_filings, row.unique_companies, row.states_affected) == (4, 2, 2)
    assert (row.increases, row.decreases, row.no_change) == (1, 1, 1)
    assert (row.avg_increase_pct, row.avg_decrease_pct, row.max_increase_pct, row.max_decrease_pct) == (10, -4, 10, -4)


def test_overview_of_nothing(make, as_of):
    row = market.market_overview(make().limit(0), as_of=as_of).first()
    assert row.total_filings == 0 and row.avg_increase_pct is None


def test_state_median_between_and_on_a_value(make, as_of):
    df = make(
        *[{"State": "A", "Premium_Change_Number": v} for v in ("0.10", "0.1001")],
        *[{"State": "B", "Premium_Change_Number": v} for v in ("0.01", "0.02", "0.90")],
        {"State": "C", "Premium_Change_Number": None},
    )
    rows = {r.State: r for r in market.state_analysis(df, as_of=as_of).collect()}
    assert rows["A"].median_change_pct == 10.01 and rows["A"].large_increases == 1
    assert rows["B"].median_change_pct == 2.0
    assert rows["C"].avg_change_pct is None and rows["C"].filing_count == 1


def test_rankings_need_five_filings(make, as_of):
    df = make(*[{"Company": "Four"}] * 4, *[{"Company": "Five"}] * 5)
    assert [r.Company for r in market.company_rankings(df, as_of=as_of).collect()] == ["Five"]


def test_hot_zone_thresholds_are_strict(make, as_of):
    df = make(
        *[{"Company": "Exactly", "Premium_Change_Number": "0.05"}] * 2,
        *[{"Company": "Above", "Premium_Change_Number": "0.0501", "Product_Line": p} for p in ("Home", "Auto")],
        {"Company": "Single", "Premium_Change_Number": "0.5"},
        *[{"Company": "Future", "Premium_Change_Number": "0.06", "Effective_Date": as_of + timedelta(days=400)}] * 2,
    )
    rows = market.hot_zones(df, as_of=as_of).collect()
    assert [r.Company for r in rows] == ["Future", "Above"]
    assert rows[1].product_lines == "Auto, Home"


def test_outliers_are_strictly_beyond_the_threshold(make, as_of):
    df = make(*[{"Premium_Change_Number": v} for v in ("0.15", "-0.15", "0.1501", "-0.2")])
    rows = market.outlier_filings(df, as_of=as_of).collect()
    assert [(r.change_pct, r.outlier_type) for r in rows] == [(-20.0, "Large Decrease"), (15.01, "Large Increase")]


def test_positioning_of_one_company(make, as_of):
    df = make(
        {"Company": "Acme Mutual", "Premium_Change_Number": "0.10"},
        {"Company": "Best", "Premium_Change_Number": "0.02"},
    )
    rows = market.competitive_positioning(df, as_of=as_of, company_term="Acme").collect()
    assert [(r.Company, r.position, r.vs_market_pct, r.competitor_count) for r in rows] == [
        ("Acme Mutual", "Above Market", 4.0, 2)
    ]
    assert market.competitive_positioning(df, as_of=as_of, company_term="none").count() == 0


def test_month_end_is_clamped(make):
    df = make({"Effective_Date": date(2024, 2, 29)}, {"Effective_Date": date(2024, 2, 28)})
    kept = market.hot_zones  # six months before 31 August is 29 February
    df = df.unionAll(df)
    assert kept(df, as_of=date(2024, 8, 31)).count() == 0
    steep = df.selectExpr("* except (Premium_Change_Number)", "CAST(0.2 AS DECIMAL(10,4)) AS Premium_Change_Number")
    assert kept(steep, as_of=date(2024, 8, 31)).first().filing_count == 2


def test_findings_need_data(make, as_of):
    assert findings.key_findings(make().limit(0), as_of=as_of).count() == 0
    df = make(*[{"Company": "Steep Home", "Premium_Change_Number": "0.2"}] * 5)
    texts = {r.finding: r.value for r in findings.key_findings(df, as_of=as_of).collect()}
    assert texts["top_company"] == "Steep... leads with 20.0% average increase across 1 states"
    assert texts["aggressive_states"] == "Aggressive rate increases in: Ohio (all >10% average)"
    assert {r.finding for r in findings.strategic_insights(df, as_of=as_of).collect()} == {
        "Competitive Landscape",
        "Risk Areas",
    }
