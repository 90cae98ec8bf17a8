"""Completeness and quality of the stored filings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.dates import EFFECTIVE, in_years
from ratelens.functions.numeric import mean_of, rate, rounded
from ratelens.sources.schemas import BUSINESS_COLUMNS


def missing_state_years(filings: DataFrame, states: dict[str, str], first: int, last: int) -> DataFrame:
    """Every (state, year) of the range without a filing; ``states`` maps full names to abbreviations."""
    known = F.array(*[F.struct(F.lit(n).alias("State"), F.lit(a).alias("state_abbr")) for n, a in states.items()])
    spark = filings.sparkSession
    wanted = (
        spark.range(1)
        .select(F.explode(known).alias("s"))
        .select("s.*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    )
    year = F.year(EFFECTIVE)
    filed = filings.filter(in_years(first, last)).select("State", year.alias("year")).distinct()
    return wanted.join(filed, ["State", "year"], "left_anti").select(
        "State", "state_abbr", F.col("year").cast("bigint").alias("year")
    )


def missing_states_by_year(filings: DataFrame, states: dict[str, str], first: int, last: int) -> DataFrame:
    """The list holds at most all states of the map."""
    missing = missing_state_years(filings, states, first, last)
    return missing.groupBy("year").agg(
        F.count(F.lit(1)).alias("missing_count"),
        F.sort_array(F.collect_list("State")).alias("missing_states"),
    )


def perfect_duplicates(filings: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Groups that agree on all business columns, with their size.

    An eight-byte hash of each row is counted to find the candidates. The wide rows are shuffled once at most, by that hash:
    the join with the repeated hashes and the grouping by all columns use the same partitioning.
    """
    columns = columns or [c for c in BUSINESS_COLUMNS if c in filings.columns]
    marked = filings.select(*columns).withColumn("row_hash", F.xxhash64(*columns))
    repeated = (
        marked.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row_hash")
    )
    return (
        marked.join(repeated, "row_hash", "left_semi")
        .groupBy("row_hash", *columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .drop("row_hash")
    )


def year_overview(filings: DataFrame, year: int | None = None) -> DataFrame:
    dated = filings.filter(F.col(EFFECTIVE).isNotNull())
    if year is not None:
        dated = dated.filter(in_years(year, year))
    per_carrier = dated.groupBy(F.year(EFFECTIVE).alias("year"), "State", "Company").agg(
        F.count(F.lit(1)).alias("n"), F.min(EFFECTIVE).alias("first"), F.max(EFFECTIVE).alias("last")
    )
    return per_carrier.groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.sum("n").alias("filings"),
        F.countDistinct("Company").alias("companies"),
        F.countDistinct("State").alias("states"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )


def record_count(filings: DataFrame) -> DataFrame:
    return filings.agg(F.count(F.lit(1)).alias("total_records"))


def _most_frequent(filings: DataFrame, column: str, k: int) -> DataFrame:
    return (
        filings.groupBy(column)
        .agg(F.count(F.lit(1)).alias("filings"))
        .orderBy(F.desc("filings"), F.asc_nulls_last(column))
        .limit(k)
    )


def top_states(filings: DataFrame, *, k: int = 10) -> DataFrame:
    return _most_frequent(filings, "State", k)


def top_companies(filings: DataFrame, *, k: int = 10) -> DataFrame:
    return _most_frequent(filings, "Company", k)


def rate_statistics(filings: DataFrame) -> DataFrame:
    return filings.filter(rate().isNotNull()).agg(
        F.count(F.lit(1)).alias("total"),
        rounded(mean_of(F.sum(rate()), F.count(rate())), 6).alias("avg_change"),
        F.min(rate()).cast("double").alias("min_change"),
        F.max(rate()).cast("double").alias("max_change"),
    )


def date_range(filings: DataFrame) -> DataFrame:
    return filings.agg(F.min(EFFECTIVE).alias("earliest_date"), F.max(EFFECTIVE).alias("latest_date"))


def completeness(filings: DataFrame) -> DataFrame:
    return filings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(rate()).alias("with_rate"),
        F.count(EFFECTIVE).alias("with_date"),
    )


def sync_outcomes(history: DataFrame) -> DataFrame:
    return history.groupBy("status").agg(
        F.count(F.lit(1)).alias("syncs"), F.count_if(F.col("parsing_errors") > 0).alias("with_errors")
    )


def cross_page_duplicates(pages: DataFrame) -> DataFrame:
    """Repeats of an id: the page it was first seen on and, per page, how often it came again.

    One row per id and page, so an id that fills many pages never becomes one long list.
    """
    seen = pages.groupBy("id", "page").agg(F.count(F.lit(1)).alias("n"))
    first = seen.groupBy("id").agg(F.min("page").alias("first_page"), F.sum("n").alias("copies"))
    repeated = first.filter("copies > 1")
    repeats = F.col("n") - F.when(F.col("page") == F.col("first_page"), 1).otherwise(0)
    return (
        seen.join(repeated, "id")
        .select("id", "first_page", F.col("page").alias("repeat_page"), repeats.cast("bigint").alias("repeats"))
        .filter("repeats > 0")
    )


def page_totals(pages: DataFrame) -> DataFrame:
    """Unique and repeated ids over all pages."""
    per_id = pages.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.count(F.lit(1)).alias("total_unique"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("total_duplicates"),
    )
