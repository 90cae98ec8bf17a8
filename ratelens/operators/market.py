"""Market analytics over all filings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.dates import between_months, month_of, since_months
from ratelens.functions.numeric import (
    avg_pct,
    count_where,
    dec,
    one_decimal,
    pct,
    pct_of,
    rate,
    rounded,
    sum_where,
    summed_with_set,
)


def per_carrier(filings: DataFrame, *keys: str) -> DataFrame:
    """Counts and exact sums per key, state and company.

    Distinct companies and states are then counted on these few rows; two distinct counts over the
    filings themselves would double every filing.
    """
    return filings.groupBy(*keys, "State", "Company").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(rate()).alias("rates"),
        F.sum(rate()).alias("total"),
        count_where(rate() > 0).alias("ups"),
        sum_where(rate() > 0, rate()).alias("up_total"),
        count_where(rate() < 0).alias("downs"),
        sum_where(rate() < 0, rate()).alias("down_total"),
        count_where(rate() == 0).alias("flat"),
        F.max(rate()).alias("highest"),
        F.min(rate()).alias("lowest"),
    )


def market_overview(filings: DataFrame, *, as_of: date, months_back: int = 12) -> DataFrame:
    recent = per_carrier(filings.filter(between_months(as_of, months_back)))
    return recent.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_filings"),
        F.countDistinct("Company").alias("unique_companies"),
        F.countDistinct("State").alias("states_affected"),
        rounded(pct_of(F.sum("up_total"), F.sum("ups")), 2).alias("avg_increase_pct"),
        rounded(pct_of(F.sum("down_total"), F.sum("downs")), 2).alias("avg_decrease_pct"),
        F.sum("ups").alias("increases"),
        F.sum("downs").alias("decreases"),
        F.sum("flat").alias("no_change"),
        rounded(F.max("highest") * 100, 2).alias("max_increase_pct"),
        rounded(F.min("lowest") * 100, 2).alias("max_decrease_pct"),
    )


def state_analysis(filings: DataFrame, *, as_of: date, months_back: int = 12) -> DataFrame:
    """The median is exact: its buffer holds one entry per distinct rate, not per filing."""
    return (
        filings.filter(between_months(as_of, months_back))
        .groupBy("State")
        .agg(
            F.count(F.lit(1)).alias("filing_count"),
            rounded(avg_pct(), 2).alias("avg_change_pct"),
            rounded(F.percentile(pct().cast("double"), F.lit(0.5)), 2).alias("median_change_pct"),
            F.countDistinct("Company").alias("companies_filing"),
            count_where(rate() > dec("0.1")).alias("large_increases"),
            count_where(rate() > 0).alias("total_increases"),
            count_where(rate() < 0).alias("total_decreases"),
            rounded(F.max(rate()) * 100, 2).alias("max_increase_pct"),
            rounded(F.min(rate()) * 100, 2).alias("max_decrease_pct"),
        )
        .orderBy(F.desc("filing_count"), F.asc_nulls_last("State"))
    )


def company_rankings(
    filings: DataFrame, *, as_of: date, months_back: int = 12, min_filings: int = 5
) -> DataFrame:
    return (
        filings.filter(between_months(as_of, months_back))
        .groupBy("Company")
        .agg(
            F.count(F.lit(1)).alias("filing_count"),
            F.countDistinct("State").alias("states_active"),
            rounded(avg_pct(), 2).alias("avg_change_pct"),
            rounded(avg_pct(where=rate() > 0), 2).alias("avg_increase_pct"),
            count_where(rate() > 0).alias("increase_count"),
            count_where(rate() > dec("0.1")).alias("large_increase_count"),
            F.sum("Policyholders_Affected_Number").alias("total_policyholders_affected"),
        )
        .filter(F.col("filing_count") >= min_filings)
        .orderBy(F.desc_nulls_last("avg_increase_pct"), F.asc_nulls_last("Company"))
    )


def hot_zones(filings: DataFrame, *, as_of: date, limit: int = 20) -> DataFrame:
    """Filings with future dates count. The thresholds compare exact decimals."""
    rising = filings.filter(since_months(as_of, 6) & (rate() > 0))
    sums = {"filing_count": F.lit(1), "total": rate(), "policyholders_affected": F.col("Policyholders_Affected_Number")}
    zones = summed_with_set(rising, ["State", "Company"], F.col("Product_Line"), sums, {"largest": pct()}, "product_lines")
    return (
        zones.filter((F.col("filing_count") >= 2) & (F.col("total") > F.col("filing_count") * dec("0.05")))
        .select(
            "State",
            "Company",
            "filing_count",
            rounded(pct_of(F.col("total"), F.col("filing_count")), 2).alias("avg_increase_pct"),
            rounded(F.col("largest"), 2).alias("max_increase_pct"),
            "policyholders_affected",
            "product_lines",
        )
        .orderBy(F.desc_nulls_last("avg_increase_pct"), F.asc_nulls_last("State"), F.asc_nulls_last("Company"))
        .limit(limit)
    )


def trend_analysis(filings: DataFrame, *, as_of: date, months_back: int = 24) -> DataFrame:
    monthly = per_carrier(
        filings.filter(between_months(as_of, months_back)).withColumn("month", month_of("Effective_Date")),
        "month",
    )
    return (
        monthly.groupBy("month")
        .agg(
            F.sum("n").alias("filing_count"),
            rounded(pct_of(F.sum("total"), F.sum("rates")), 2).alias("avg_change_pct"),
            F.countDistinct("Company").alias("unique_companies"),
            F.countDistinct("State").alias("states_affected"),
            F.sum("ups").alias("increases"),
            F.sum("downs").alias("decreases"),
        )
        .withColumn(
            "increase_rate_pct",
            rounded(F.try_divide(F.col("increases").cast("double"), F.col("filing_count")) * 100, 1),
        )
        .orderBy("month")
    )


def outlier_filings(
    filings: DataFrame, *, as_of: date, threshold_pct: int = 15, limit: int = 50
) -> DataFrame:
    threshold = dec(str(threshold_pct)) / 100
    return (
        filings.filter(since_months(as_of, 6) & (F.abs(rate()) > threshold))
        .orderBy(F.abs(rate()).desc(), "Record_ID")
        .limit(limit)
        .select(
            "Record_ID",
            "Company",
            "State",
            "Product_Line",
            rounded(pct(), 2).alias("change_pct"),
            "Effective_Date",
            F.col("Policyholders_Affected_Number").cast("bigint").alias("Policyholders_Affected_Number"),
            "SERFF_Tracking_Number",
            F.when(rate() > threshold, "Large Increase").otherwise("Large Decrease").alias("outlier_type"),
        )
    )


def company_search(filings: DataFrame, term: str, *, limit: int = 5) -> DataFrame:
    """Companies whose name contains ``term``, in name order."""
    return (
        filings.filter(F.col("Company").contains(term))
        .select("Company")
        .distinct()
        .orderBy("Company")
        .limit(limit)
    )


def competitive_positioning(
    filings: DataFrame, *, as_of: date, company_term: str | None = None, months_back: int = 12
) -> DataFrame:
    """Every company against the market of each (state, product line); one company if a term is given.

    The market averages come from the company sums, so the filings are read and shuffled once.
    """
    market = ["State", "Product_Line"]
    companies = (
        filings.filter(since_months(as_of, months_back))
        .groupBy(*market, "Company")
        .agg(
            F.count(F.lit(1)).alias("filing_count"),
            F.sum(rate()).alias("total"),
            F.count(rate()).alias("rates"),
            F.max("Effective_Date").alias("latest_filing"),
        )
    )
    markets = companies.groupBy(*market).agg(
        pct_of(F.sum("total"), F.sum("rates")).alias("market_avg"),
        F.count("Company").alias("competitor_count"),
    )
    own = companies.withColumn("own_avg", pct_of(F.col("total"), F.col("rates")))
    if company_term is not None:
        own = own.join(company_search(filings, company_term, limit=1), "Company", "left_semi")
    else:
        own = own.filter(F.col("Company").isNotNull())
    gap = F.col("own_avg") - F.col("market_avg")
    position = (
        F.when(F.col("own_avg") > F.col("market_avg") + 2, "Above Market")
        .when(F.col("own_avg") < F.col("market_avg") - 2, "Below Market")
        .otherwise("At Market")
    )
    return own.join(markets, market).select(
        "Company",
        *market,
        rounded(F.col("own_avg"), 4).alias("company_avg_pct"),
        rounded(F.col("market_avg"), 4).alias("market_avg_pct"),
        rounded(gap, 2).alias("vs_market_pct"),
        position.alias("position"),
        "competitor_count",
        "filing_count",
        "latest_filing",
    )


def trend_bars(trend: DataFrame, *, width: int = 30) -> DataFrame:
    """A text bar per month of ``trend_analysis``; the longest month fills the width."""
    longest = trend.agg(F.max("filing_count")).scalar()
    length = F.floor(F.col("filing_count") * F.lit(width) / longest).cast("int")
    bar = F.repeat(F.lit("█"), length)
    month = F.date_format("month", "yyyy-MM")
    line = F.concat(
        month,
        F.lit(" | "),
        bar,
        F.lit(" "),
        F.col("filing_count").cast("string"),
        F.lit(" filings ("),
        one_decimal(F.col("avg_change_pct")),
        F.lit("% avg)"),
    )
    return trend.select("month", "filing_count", length.cast("bigint").alias("bar_length"), line.alias("line"))
