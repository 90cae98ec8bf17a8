"""Agent reports against plain Python over all pairs, and the edge cases."""

from datetime import timedelta
from decimal import Decimal


import pytest
from pyspark.sql import functions as F

from ratelens.operators import agents


def crowd(make, as_of, companies=40, states=("Ohio", "Iowa")):
    """Many companies with few distinct averages, so that ties and thresholds occur."""
    rows = []
    for s, state in enumerate(states):
        for c in range(companies):
            rows.append(
                {
                    "State": state,
                    "Company": f"C{c:02d}",
                    "Premium_Change_Number": str(Decimal((c * 7 + s) % 11) / 100),
                    "Effective_Date": as_of + timedelta(days=(c * 13 + s) % 70),
                    "Policyholders_Affected_Number": None if c % 5 == 0 else c % 4,
                }
            )
            rows.append(
                {
                    "State": state,
                    "Company": f"C{c:02d}",
                    "Premium_Change_Number": str(Decimal((c * 3) % 5) / 100),
                    "Effective_Date": as_of - timedelta(days=10 + c * 20),
                }
            )
    return rows


def by_pairs(rows, as_of, above, days, order, k):
    """The report of every agent by comparing it with every other company of the state."""
    recent, coming, everyone = {}, {}, set()
    cutoff = as_of.replace(year=as_of.year - 1, month=12)
    for r in rows:
        key, rate = (r["State"], r["Company"]), Decimal(r["Premium_Change_Number"])
        everyone.add(key)
        if r["Effective_Date"] >= cutoff:
            recent.setdefault(key, []).append(rate)
        if rate > Decimal(above) and as_of <= r["Effective_Date"] <= as_of + timedelta(days=days):
            coming.setdefault(key, []).append((rate, r["Effective_Date"], r["Policyholders_Affected_Number"]))
    result = {}
    for (state, company) in everyone:
        rates = recent.get((state, company), [])
        own = float(sum(rates)) * 100 / len(rates) if rates else 0.0
        found = []
        for (other_state, other), filed in coming.items():
            avg = float(round(sum(f[0] for f in filed) * 100 / len(filed), 1))
            if other_state == state and other != company and avg > own + 2:
                known = [f[2] for f in filed if f[2] is not None]
                last = max(f[1] for f in filed)
                found.append((other, avg, sum(known) if known else None, (last - as_of).days))
        result[state, company] = [f[0] for f in sorted(found, key=order)[:k]]
    return result


def listed(df):
    out = {}
    for r in df.orderBy("State", "Company", "rank").collect():
        out.setdefault((r.State, r.Company), []).append(r.competitor)
    return out


def test_v2_equals_all_pairs(make, as_of):
    rows = crowd(make, as_of)
    want = by_pairs(rows, as_of, "0.02", 90, lambda f: (-f[1], f[2] is None, -(f[2] or 0), f[0]), 12)
    got = listed(agents.opportunities_v2(make(*rows), as_of=as_of))
    assert got == {k: v for k, v in want.items() if v}


def test_v3_equals_all_pairs(make, as_of):
    rows = crowd(make, as_of)
    want = by_pairs(rows, as_of, "0.03", 60, lambda f: (f[3], -f[1], f[0]), 6)
    got = listed(agents.opportunities_v3(make(*rows), as_of=as_of))
    assert got == {k: v for k, v in want.items() if v}


def test_batch_agrees_with_its_parts(make, as_of):
    df = make(*crowd(make, as_of))
    batch = {(r.State, r.Company): r for r in agents.agent_report_batch(df, as_of=as_of).collect()}
    for r in agents.agent_summary_v2(df, as_of=as_of).collect():
        b = batch[r.State, r.Company]
        assert (b.total_opportunities, b.potential_revenue, b.urgent_count) == (
            r.total_opportunities,
            r.potential_revenue,
            r.urgent_count,
        )
    for r in agents.market_position_total(df, as_of=as_of).collect():
        assert batch[r.State, r.Company].position == r.position
    assert all(len(b.top_opportunities) <= 6 for b in batch.values())


def test_positions_are_a_ranking(make, as_of):
    """Many equal averages: places are 1..n without gaps and never fall as the average rises."""
    rows = [
        {"Company": f"C{i:03d}", "Premium_Change_Number": "0.03" if i % 3 else str(Decimal(i) / 1000)} for i in range(120)
    ]
    df = make(*rows)
    got = agents.market_position(df, as_of=as_of).join(agents.agent_rate(df, as_of=as_of), ["State", "Company"])
    ordered = [r.avg_rate for r in got.orderBy("position").collect()]
    assert ordered == sorted(ordered)
    assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 121))


def test_unranked_agent(make, as_of):
    df = make({"Company": "Old", "Effective_Date": as_of - timedelta(days=900)}, {"Company": "New"})
    places = {r.Company: r for r in agents.market_position(df, as_of=as_of).collect()}
    assert places["Old"].your_position == "#N/A" and places["New"].your_position == "#1"
    totals = {r.Company: (r.position, r.total_carriers) for r in agents.market_position_total(df, as_of=as_of).collect()}
    assert totals == {"Old": (1, 1), "New": (1, 1)}
    rates = {r.Company: (r.avg_rate, r.filing_count) for r in agents.agent_rate(df, as_of=as_of).collect()}
    assert rates == {"Old": (0.0, 0), "New": (5.0, 1)}


@pytest.mark.parametrize(
    ("policies", "win", "want"), [(None, 45, 8100), (0, 85, 0), (1, 55, 99), (333, 65, 38961)]
)
def test_commission_is_exact_and_cut(spark, policies, win, want):
    df = spark.createDataFrame([(policies, win)], "p bigint, w bigint")
    assert df.select(agents.commission(F.col("p"), F.col("w"))).first()[0] == want


def test_refined_list(make, as_of):
    day = timedelta(days=1)
    df = make(
        {"Company": "Own Carrier Inc", "Premium_Change_Number": "0.5"},
        {"Company": None, "Premium_Change_Number": "0.5"},
        {"Company": "Low", "Premium_Change_Number": "0.03"},
        {"Company": "First", "Premium_Change_Number": "0.04", "Effective_Date": as_of - 30 * day},
        {"Company": "Out", "Premium_Change_Number": "0.04", "Effective_Date": as_of - 31 * day},
        {"Company": "Last", "Premium_Change_Number": "0.04", "Effective_Date": as_of + 90 * day},
        *[
            {"Company": "Many", "Premium_Change_Number": f"0.0{i}", "Effective_Date": as_of + i * day}
            for i in range(4, 9)
        ],
    )
    rows = agents.rate_increases_refined(df, "Own Carrier", as_of=as_of).orderBy("rank").collect()
    assert [r.Company for r in rows] == ["First", "Many", "Last"]
    assert [str(c) for c in rows[1].recent_changes] == ["8.0", "7.0", "6.0"]
    shown = {r.Company: r for r in agents.urgency(agents.rate_increases_refined(df, "Own Carrier", as_of=as_of)).collect()}
    assert (shown["First"].days_until, shown["First"].urgency_percent, shown["Last"].urgency_percent) == (0, 133.3, 0.0)
    assert shown["Last"].urgent_opportunities == 2
    steps = agents.outreach_timeline(agents.rate_increases_refined(df, "Own Carrier", as_of=as_of)).orderBy("step").collect()
    assert [(s.carrier, s.outreach_date) for s in steps] == [("Many", "May 24"), ("Last", "Aug 14")]
    summary = agents.refined_summary(df, "Own Carrier", as_of=as_of).first()
    assert (summary.companies_raising, summary.estimated_policies) == (4, "80")


def test_refined_summary_without_policies(make, as_of):
    df = make({"Policyholders_Affected_Number": None})
    assert agents.refined_summary(df, "Other", as_of=as_of).first().estimated_policies == "5,000+"


@pytest.mark.parametrize(
    ("days", "start"), [(30, "Contact"), (31, "Prime"), (45, "Prime"), (60, "Early"), (61, "Plan")]
)
def test_action_window(spark, days, start):
    assert spark.range(1).select(agents.action_window(F.lit(days))).first()[0].startswith(start)


def test_segments(spark):
    df = spark.createDataFrame([("State Farm", 11.0), ("Progressive Co", 6.0), ("X", 5.0)], "c string, i double")
    got = [r[0] for r in df.select(agents.target_segments(F.col("c"), F.col("i"))).collect()]
    assert got == [
        ["Multi-car households", "Long-term customers", "Good drivers"],
        ["Price-sensitive", "Tech-savvy"],
        [],
    ]


def test_names(spark):
    df = spark.createDataFrame([("State Farm MutualAutomobileInsuranceCompany of the whole Middle West",), ("ab",)], "Company string")
    rows = {r.Company[:2]: r for r in agents.cleaned_names(df).collect()}
    assert rows["St"].name_v2 == "State Farm" and len(rows["St"].name_v1) == 40 and rows["St"].name_v1.endswith("...")
    assert rows["ab"].name_v1 == "ab"
    assert {r.initials for r in agents.initials(df).collect()} == {"SF", "AB"}


def test_carrier_resolve(make):
    df = make({"Company": "Zeta Mutual"}, {"Company": "Alpha Mutual"}, {"Company": "Other", "State": "Iowa"})
    assert [tuple(r) for r in agents.carrier_resolve(df, "Mutual").collect()] == [("Ohio", "Alpha Mutual")]


def test_product_pairs_are_not_built(make, as_of):
    """The plans hold no cartesian or nested-loop join."""
    df = make(*crowd(make, as_of, companies=3))
    for query in (agents.opportunities_v1, agents.opportunities_v2, agents.opportunities_v3):
        plan = query(df, as_of=as_of)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert "WindowGroupLimit" in plan


