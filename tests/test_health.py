from datetime import date

from ratelens.functions.states import STATE_ABBREVIATIONS
from ratelens.operators import dashboard, health, records

YEAR = date(2024, 1, 1)


def test_missing_state(make):
    states = {n.title(): a for n, a in STATE_ABBREVIATIONS.items() if "D" != n[0] and "." not in n and n != "WASHINGTON DC"}
    df = make(*[{"State": n, "Effective_Date": YEAR} for n, a in states.items() if a != "WA"])
    missing = health.missing_state_years(df, states, 2024, 2024).collect()
    assert [(m.state_abbr, m.year) for m in missing] == [("WA", 2024)]
    both = {r.year: (r.missing_count, r.missing_states) for r in health.missing_states_by_year(df, states, 2023, 2024).collect()}
    assert both[2024] == (1, ["Washington"]) and both[2023][0] == len(states)


def test_duplicates_ignore_id_but_not_nulls(make):
    df = make({}, {}, {"Company": None}, {"Company": None}, {"Company": "Other"}, {"Impact_Score": "2"})
    found = {r.Company: r.copies for r in health.perfect_duplicates(df).collect()}
    assert found == {"Acme": 2, None: 2}


def test_cross_page_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("b", 2), ("c", 5), ("c", 4)], "id string, page bigint")
    rows = sorted(tuple(r) for r in health.cross_page_duplicates(df).collect())
    assert rows == [("a", 1, 1, 1), ("a", 1, 3, 1), ("c", 4, 5, 1)]
    assert tuple(health.page_totals(df).first()) == (3, 3)


def test_dashboard_filters_and_order(make):
    df = make(
        *[{"Record_ID": f"n{i:02d}", "Company": "New", "Effective_Date": date(2024, 6, 2)} for i in range(20)],
        {"Company": "Old", "Effective_Date": date(2024, 6, 1)},
    )
    assert dashboard.competitive_alerts(df, ["Old"]).count() == 0
    assert dashboard.competitive_alerts(df, ["New"]).count() == 20
    kpis = dashboard.dashboard_kpis(df, ["Old"], date(2024, 1, 1), date(2024, 12, 31)).first()
    assert (kpis.carriers_analyzed, kpis.total_filings, kpis.avg_rate_change) == (1, 1, 0.05)


def test_performance_index_compounds(make):
    df = make(
        {"Effective_Date": date(2024, 1, 5), "Premium_Change_Number": "0.10"},
        {"Effective_Date": date(2024, 2, 5), "Premium_Change_Number": "0.10"},
        {"Effective_Date": date(2023, 2, 5), "Premium_Change_Number": "0.90"},
    )
    rows = dashboard.carrier_performance_index(df, None, date(2024, 1, 1), date(2024, 12, 31), base=date(2024, 1, 1))
    assert [r.performance_index for r in rows.orderBy("month").collect()] == [110.0, 121.0]


def test_positioning_ties_and_single_carrier(make):
    rows = [{"Company": f"C{i}", "Premium_Change_Number": v, "Total_Written_Premium_Number": str(i + 1)} for i, v in enumerate(("0.01", "0.02", "0.02", "0.05"))]
    got = {r.Company: r for r in dashboard.positioning_matrix(make(*rows), None).collect()}
    assert got["C0"].aggressiveness_score == 0 and got["C3"].aggressiveness_score == 50
    assert got["C1"].aggressiveness_score == got["C2"].aggressiveness_score == 16.6667
    assert got["C3"].bubble_size == 100
    alone = dashboard.positioning_quadrant(dashboard.positioning_matrix(make({}), None)).first()
    assert (alone.aggressiveness_score, alone.quadrant) == (0, "Conservative Growth")


def test_records(spark, make, as_of):
    raw = spark.createDataFrame(
        [("1", " A ", "oh", "auto", "lost", None, None, 1.0), ("", "B", "tx", None, None, None, None, None)],
        records.RECORD_JSON,
    )
    rows = {r.company_name: r for r in records.normalize_filing(raw, as_of=as_of).collect()}
    assert rows["A"].state == "OH" and rows["A"].last_updated.date() == as_of and rows["A"].reject_reason is None
    assert rows["B"].reject_reason == "filing_id is required"
    back = {r.filing_id: r for r in records.filing_from_json(records.filing_to_json(raw)).collect()}
    assert back["1"].reject_reason == "unknown status" and back[""].filing_type == "other"
    agents = spark.createDataFrame([("a", "ohio", "x@y.zz"), ("b", "iowa", None), ("c", "utah", "u@v.ww")], "agent_id string, state string, email string")
    df = make({}, {})
    assert {r.agent_id: r.total_filings for r in records.personalized_filings(agents, df).collect()} == {"a": 2, "c": 0}
    assert records.filings_of_agent(agents, df, "a").count() == 2
    assert records.filings_of_agent(agents, df, "b").count() == 0
