"""What the plans look like: reads, shuffles, pushed filters, no work while a query is built."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ratelens.functions.numeric import one_decimal, rounded
from ratelens.functions.ranking import bounded_bands, values_below
from ratelens.operators import agents, dashboard, health, market, newsletter, records
from ratelens.sources import tables
from ratelens.sources.report_files import writer_uri

AS_OF = date(2024, 6, 15)


@pytest.fixture(scope="module")
def stored(spark, make, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("filings") / "t")
    rows = [
        {"Company": f"C{i % 17}", "State": f"S{i % 3}", "Premium_Change_Number": f"0.{i % 20:02d}", "Product_Line": f"L{i % 5}",
         "Effective_Date": date(2024, 5 + i % 4, 1 + i % 28)}
        for i in range(400)
    ]
    make(*rows).write.parquet(path)
    return lambda: spark.read.parquet(path)


def ran(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(df):
    return ran(df).count("FileScan parquet")


@pytest.mark.parametrize(
    "build",
    [
        lambda f: agents.opportunities_v2(f, as_of=AS_OF),
        lambda f: agents.opportunities_v3(f, as_of=AS_OF),
        lambda f: agents.agent_summary_v2(f, as_of=AS_OF),
        lambda f: agents.agent_report_batch(f, as_of=AS_OF),
        lambda f: agents.market_position_total(f, as_of=AS_OF),
        lambda f: agents.opportunities_v1(f, as_of=AS_OF),
        lambda f: market.hot_zones(f, as_of=AS_OF),
    ],
)
def test_filings_are_read_once(stored, build):
    assert scans(build(stored())) == 1


def test_the_refined_report_reads_twice(stored):
    """Once for sums and product lines, once for the latest changes."""
    assert scans(agents.rate_increases_refined(stored(), "C1", as_of=AS_OF)) == 2


def test_building_a_query_starts_no_job(spark, stored):
    filings = stored()
    spark.sparkContext.setJobGroup("building", "nothing may run")
    for build in (
        lambda: agents.market_position(filings, as_of=AS_OF),
        lambda: agents.agent_report_batch(filings, as_of=AS_OF),
        lambda: dashboard.positioning_matrix(filings, None),
        lambda: records.competitive_landscape(filings, as_of=AS_OF),
    ):
        build()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext._jsc.clearJobGroup()


def test_wide_rows_of_duplicates_are_shuffled_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = ran(health.perfect_duplicates(stored()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.split("\n") if " Exchange hashpartitioning" in line]
    assert len(wide) == 2 and all("hashpartitioning(row_hash" in line for line in wide)


@pytest.mark.parametrize(
    "build",
    [
        lambda f: records.market_trends(f, as_of=AS_OF),
        lambda f: health.missing_state_years(f, {"S0": "S0"}, 2023, 2024),
        lambda f: health.year_overview(f, 2024),
        lambda f: newsletter.newsletter_summary(f, date(2024, 6, 9), date(2024, 7, 1)),
    ],
)
def test_dates_reach_the_reader(stored, build):
    assert "GreaterThanOrEqual(Effective_Date" in ran(build(stored()))


def test_months_limit_the_editions(stored):
    rows = newsletter.newsletter_batch(stored(), date(2024, 6, 9), date(2024, 7, 30)).collect()
    assert {r.month for r in rows} == {date(2024, 6, 1), date(2024, 7, 1)}
    every = {(r.State, r.month): r for r in newsletter.newsletter_batch(stored()).collect()}
    assert all(every[r.State, r.month] == r for r in rows)


def test_large_values_do_not_end_a_query(spark, make):
    df = spark.createDataFrame([(1e11 + 0.126,), (1e40,), (-1e15,), (1.005,)], "v double")
    assert [r[0] for r in df.select(rounded(F.col("v"), 2)).collect()] == [1e11 + 0.13, 1e40, -1e15, 1.01]
    assert df.select(one_decimal(F.col("v"))).collect()[0][0] == "100000000000.1"
    months = [date(1999 + i // 12, 1 + i % 12, 5) for i in range(300)]
    filings = make(*[{"Effective_Date": m, "Premium_Change_Number": "0.12"} for m in months])
    index = dashboard.carrier_performance_index(filings, None, months[0], months[-1], base=months[0])
    last = index.orderBy(F.desc("month")).first()
    assert last.performance_index == pytest.approx(100 * 1.12**300, rel=1e-9)


def test_bounded_bands_keep_the_order(spark):
    values = [(float(v),) for v in (-5e9, -3.0, -0.001, 0.0, 0.002, 0.5, 1.0, 1.001, 7.0, 1e6, 1e12)]
    df = spark.createDataFrame(values + values[:2], "v double")
    got = {r.v: r.below for r in values_below(df, [], "v", bounded_bands("v", 0.001), "below").collect()}
    ordered = sorted(v for v, in values + values[:2])
    assert got == {v: sum(w < v for w in ordered) for v in ordered}
    assert df.select(bounded_bands("v", 0.001).alias("b")).agg(F.max("b")).first()[0] < 50_000


def test_product_lines_only_of_shown_zones(stored):
    rows = market.hot_zones(stored(), as_of=AS_OF).collect()
    assert rows and all(r.product_lines for r in rows)


def test_hadoop_paths_of_the_sink():
    assert writer_uri("s3a://bucket/x") == "s3://bucket/x" and writer_uri("hdfs://n/x") == "hdfs://n/x"
    assert writer_uri("/mnt/x") == writer_uri("file:/mnt/x") == writer_uri("file:///mnt/x") == "file:///mnt/x"


def test_reports_are_spelled_per_month_and_not_per_filing(spark, tmp_path):
    day = datetime(2001, 5, 3)
    given = {
        "nation": ([(1, "NATION_1")], "n_nationkey int, n_name string"),
        "customer": ([(1, 1)], "c_custkey bigint, c_nationkey int"),
        "orders": ([(1, 1)], "o_orderkey bigint, o_custkey bigint"),
        "supplier": ([(1, "S")], "s_suppkey bigint, s_name string"),
        "part": ([(1, "B", "T")], "p_partkey bigint, p_brand string, p_type string"),
        "lineitem": (
            [(1, 1, 1, n, 1.0, 1.0, 0.05, when) for n, when in enumerate([day, day + timedelta(days=9), None, day + timedelta(days=31)])],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    reports = tables.reports(spark, str(tmp_path))
    assert [(r.Month, r.Year, r.Status) for r in reports.orderBy("report_id").collect()] == [
        ("May", "2001", "Sent"), ("June", "2001", "Generated"),
    ]
    pending = newsletter.pending_reports(tables.filings(spark, str(tmp_path)), reports)
    assert pending.count() == 0
    below = pending._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[-1]  # the months of the reports
    assert "l_shipdate" in below and "date_format" not in below
