"""Data sets of the carrier dashboard.

The dashboard reads four views whose formulas are not published; the ones below are this library's own:

* performance index: 100 x product of (1 + average monthly change) from the base month on
* market share: premium of the company / premium of the quarter, in percent
* aggressiveness: 50 x percent rank of the average change + 50 x percent rank of the filing count in the quarter
* moves: by sign, "Major" from 10 percent on; impact is the impact score, 0 where unknown
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.dates import EFFECTIVE, month_of
from ratelens.functions.numeric import RATE, dec, mean_of, rate, rounded
from ratelens.functions.ranking import bounded_bands, values_below


def _chosen(
    df: DataFrame, companies: list[str] | None, start: date, end: date, day: str = EFFECTIVE
) -> DataFrame:
    """The carriers picked (all if None) and the days from ``start`` to ``end``."""
    kept = df.filter(F.col(day).between(F.lit(start), F.lit(end)))
    return kept if companies is None else kept.filter(F.col("Company").isin(companies))


def _avg_fraction() -> Column:
    return mean_of(F.sum(rate()), F.count(rate()))


def dashboard_kpis(filings: DataFrame, companies: list[str] | None, start: date, end: date) -> DataFrame:
    """The average is a fraction, not a percentage."""
    return (
        _chosen(filings, companies, start, end)
        .filter(F.col("Company").isNotNull())
        .agg(
            F.countDistinct("Company").alias("carriers_analyzed"),
            F.count(F.lit(1)).alias("total_filings"),
            rounded(_avg_fraction(), 6).alias("avg_rate_change"),
            F.sum("Policyholders_Affected_Number").alias("total_customers_affected"),
        )
    )


def state_carrier_rates(
    filings: DataFrame, companies: list[str] | None, start: date, end: date
) -> DataFrame:
    return (
        _chosen(filings, companies, start, end)
        .filter(F.col("State").isNotNull() & F.col("Company").isNotNull())
        .groupBy("State", "Company")
        .agg(rounded(_avg_fraction(), 6).alias("avg_rate_change"))
        .orderBy("State", "Company")
    )


def state_heatmap(
    filings: DataFrame, companies: list[str] | None, start: date, end: date, states: list[str]
) -> DataFrame:
    """Company x state; the given state list saves the job that would look for the columns."""
    kept = _chosen(filings, companies, start, end).filter(F.col("Company").isNotNull())
    pivoted = kept.groupBy("Company").pivot("State", states).agg(
        F.sum(rate()).alias("total"), F.count(rate()).alias("rates")
    )
    return pivoted.select(
        "Company",
        *[rounded(mean_of(F.col(f"{s}_total"), F.col(f"{s}_rates")), 6).alias(s) for s in states],
    )


def carrier_performance_index(
    filings: DataFrame,
    companies: list[str] | None,
    start: date,
    end: date,
    *,
    base: date = date(2020, 1, 1),
) -> DataFrame:
    """The window runs over the months of one company, so it stays short whatever the number of filings."""
    monthly = (
        filings.filter((F.col(EFFECTIVE) >= F.lit(base)) & F.col("Company").isNotNull())
        .groupBy("Company", month_of(EFFECTIVE).alias("month"))
        .agg(_avg_fraction().alias("avg_rate"), F.count(F.lit(1)).alias("filing_count"))
    )
    so_far = (
        Window.partitionBy("Company").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    growth = F.ln(F.when(F.col("avg_rate") > -1, F.lit(1.0) + F.col("avg_rate")))
    index = monthly.select(
        "Company",
        "month",
        rounded(F.lit(100.0) * F.exp(F.coalesce(F.sum(growth).over(so_far), F.lit(0.0))), 4).alias(
            "performance_index"
        ),
        rounded(F.col("avg_rate"), 6).alias("avg_rate_change"),
        "filing_count",
    )
    return _chosen(index, companies, start, end, "month")


def _quarter() -> Column:
    return F.trunc(EFFECTIVE, "quarter").alias("quarter")


def market_share_evolution(
    filings: DataFrame, companies: list[str] | None, start: date, end: date
) -> DataFrame:
    """Quarter totals are summed from the company sums and joined back, so no task holds a whole quarter."""
    premium = (
        filings.filter(F.col(EFFECTIVE).isNotNull())
        .groupBy("Company", _quarter())
        .agg(F.sum("Total_Written_Premium_Number").alias("premium"))
    )
    quarters = premium.groupBy("quarter").agg(F.sum("premium").alias("quarter_premium"))
    share = F.try_divide(F.col("premium").cast("double") * 100, F.col("quarter_premium").cast("double"))
    shares = premium.join(quarters, "quarter").select(
        "Company", "quarter", rounded(share, 6).alias("market_share_pct")
    )
    return _chosen(shares, companies, start, end, "quarter")


def positioning_matrix(filings: DataFrame, companies: list[str] | None) -> DataFrame:
    """The carriers of the latest quarter; the ranks are taken over all carriers, the bubble over the picked.

    The percent rank of a value is the share of the other carriers below it.
    """
    latest = filings.agg(F.max(F.trunc(EFFECTIVE, "quarter"))).scalar()
    quarter = (
        filings.filter(F.col("Company").isNotNull() & (F.col(EFFECTIVE) >= latest))
        .groupBy("Company")
        .agg(
            F.coalesce(_avg_fraction(), F.lit(0.0)).alias("avg"),
            F.sum("Total_Written_Premium_Number").cast("double").alias("premium_volume"),
            F.count(F.lit(1)).alias("filing_activity"),
        )
    )
    picked = F.lit(True) if companies is None else F.col("Company").isin(companies)
    totals = quarter.agg(
        F.struct(
            (F.count(F.lit(1)) - 1).alias("others"), F.max(F.when(picked, F.col("premium_volume"))).alias("largest")
        )
    )
    total = F.col("totals")

    def rank(below: str) -> Column:
        return F.coalesce(F.try_divide(F.col(below).cast("double"), total["others"]), F.lit(0.0))

    score = F.lit(50.0) * rank("below_avg") + F.lit(50.0) * rank("below_activity")
    return (
        quarter.filter(picked)
        .join(values_below(quarter, [], "avg", bounded_bands("avg", 0.001), "below_avg"), "avg")
        .join(values_below(quarter, [], "filing_activity", bounded_bands("filing_activity", 1), "below_activity"), "filing_activity")
        .withColumn("totals", totals.scalar())
        .select(
            "Company",
            rounded(F.col("avg"), 6).alias("avg_rate_change"),
            "premium_volume",
            "filing_activity",
            rounded(score, 4).alias("aggressiveness_score"),
            rounded(F.try_divide(F.col("premium_volume"), total["largest"]) * 100, 4).alias("bubble_size"),
        )
    )


def positioning_quadrant(matrix: DataFrame) -> DataFrame:
    """Quadrant of each carrier: split at no change and at a score of 50."""
    strength = F.when(F.col("aggressiveness_score") >= 50, "Aggressive").otherwise("Conservative")
    aim = F.when(F.col("avg_rate_change") >= 0, "Growth").otherwise("Competition")
    return matrix.select(
        "Company",
        "avg_rate_change",
        "aggressiveness_score",
        F.concat_ws(" ", strength, aim).alias("quadrant"),
    )


def competitive_alerts(filings: DataFrame, companies: list[str] | None, *, limit: int = 20) -> DataFrame:
    """The newest moves; the carriers are picked only after the limit."""
    impact = F.coalesce("Impact_Score", F.lit(0).cast("decimal(10,2)"))
    size = F.when(F.abs(rate()) >= dec("0.1"), "Major ").otherwise("")
    move = (
        F.when(rate() > 0, F.concat(size, F.lit("Increase")))
        .when(rate() < 0, F.concat(size, F.lit("Decrease")))
        .otherwise("No Change")
    )
    newest = (
        filings.orderBy(F.desc_nulls_last(EFFECTIVE), impact.desc(), "Record_ID")
        .limit(limit)
        .select(
            "Record_ID",
            EFFECTIVE,
            "Company",
            "State",
            "Product_Line",
            rate().cast("double").alias(RATE),
            impact.cast("double").alias("impact_score"),
            move.alias("move_type"),
        )
    )
    return newest if companies is None else newest.filter(F.col("Company").isin(companies))
