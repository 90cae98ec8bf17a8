"""Averages, rounding and typed totals that do not depend on the order of the rows.

Sums run over decimals, so they are exact; a division comes last. That makes every result the same for
any partitioning of the input.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE = "Premium_Change_Number"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str) -> Column:
    """An exact decimal constant."""
    return F.lit(Decimal(value))


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding on a decimal copy; binary rounding would differ at ties.

    Doubles too large for the copy have no digits after the point and stay as they are.
    """
    return F.coalesce(F.round(value.try_cast("decimal(38,8)"), digits).cast("double"), value.cast("double"))


def rate() -> Column:
    """The rate change of a filing, a fraction."""
    return F.col(RATE)


def pct() -> Column:
    """The rate change of a filing in percent."""
    return F.col(RATE) * 100


def mean_of(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def pct_of(total: Column, count: Column) -> Column:
    """Average rate change in percent from a decimal sum of fractions and a count."""
    return F.try_divide(total.cast("double") * 100, count)


def avg_pct(rate: Column | str = RATE, where: Column | None = None) -> Column:
    """Average of fractions in percent; ``where`` limits the rows that count."""
    kept = col(rate) if where is None else F.when(where, col(rate))
    return pct_of(F.sum(kept), F.count(kept))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, col(value)))


def joined_set(value: Column | str) -> Column:
    """Distinct values in order, joined by a comma; NULL where there are none."""
    values = F.sort_array(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, ", "))


def summed_with_set(
    rows: DataFrame, keys: list[str], value: Column | None, sums: dict[str, Column], maxima: dict[str, Column], name: str
) -> DataFrame:
    """Sums and maxima by ``keys``, and as ``name`` the distinct values joined by a comma (NULL where there are none), from one read.

    First one row per key and value, by fixed-size aggregates that are combined in the tasks; then these few rows by key. A group's list
    holds each value once and never sees the rows themselves.
    """
    totals = [F.sum(c).alias(n) for n, c in sums.items()] + [F.max(c).alias(n) for n, c in maxima.items()]
    if value is None:  # one step and no list
        return rows.groupBy(*keys).agg(*totals)
    each = rows.groupBy(*keys, value.alias("one_value")).agg(*totals)
    values = F.sort_array(F.collect_list("one_value"))
    return each.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.max(n).alias(n) for n in maxima],
        F.when(F.size(values) > 0, F.array_join(values, ", ")).alias(name),
    )


def short_number(value: Column) -> Column:
    """Whole number in short form: 950, 1.3K, 12M, 8.2B; NULL gives N/A."""

    def scaled(factor: str, suffix: str) -> Column:
        text = F.round(value.cast("decimal(20,0)") * dec(factor), 1).cast("decimal(20,1)").cast("string")
        return F.concat(F.regexp_replace(text, r"\.0$", ""), F.lit(suffix))

    return (
        F.when(value.isNull(), F.lit("N/A"))
        .when(value < 1_000, value.cast("bigint").cast("string"))
        .when(value < 1_000_000, scaled("0.001", "K"))
        .when(value < 1_000_000_000, scaled("0.000001", "M"))
        .otherwise(scaled("0.000000001", "B"))
    )


def one_decimal(value: Column) -> Column:
    """Text with one digit after the point; doubles too large for a decimal show as they are."""
    return F.coalesce(
        F.round(value.try_cast("decimal(38,8)"), 1).cast("decimal(38,1)").cast("string"), value.cast("string")
    )


def with_commas(value: Column) -> Column:
    """Whole number as text with thousands separators."""
    return F.format_number(value, 0)
