"""Date arithmetic around an explicit as-of date, and month spellings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

EFFECTIVE = "Effective_Date"

# English month names.
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]


def months_before(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def between_months(as_of: date, months: int) -> Column:
    """Effective within the last ``months`` months and not after ``as_of``."""
    effective = F.col(EFFECTIVE)
    return (effective >= months_before(as_of, months)) & (effective <= F.lit(as_of))


def since_months(as_of: date, months: int) -> Column:
    """Effective in the last ``months`` months or in the future."""
    return F.col(EFFECTIVE) >= months_before(as_of, months)


def within_days(as_of: date, before: int, after: int) -> Column:
    effective = F.col(EFFECTIVE)
    return (effective >= F.date_sub(F.lit(as_of), before)) & (effective <= F.date_add(F.lit(as_of), after))


def in_years(first: int, last: int) -> Column:
    """Effective in these years, as a range of dates that a file reader can use."""
    return F.col(EFFECTIVE).between(F.lit(date(first, 1, 1)), F.lit(date(last, 12, 31)))


def in_months(first: date | None, last: date | None) -> Column:
    """Effective from the month of ``first`` to the month of ``last``; an open end has no limit."""
    kept = F.lit(True)
    if first is not None:
        kept = kept & (F.col(EFFECTIVE) >= F.lit(first.replace(day=1)))
    if last is not None:
        kept = kept & (F.col(EFFECTIVE) < F.add_months(F.lit(last.replace(day=1)), 1))
    return kept


def month_of(value: Column | str) -> Column:
    return F.trunc(value, "month")


def month_start(text: Column, as_of: date) -> Column:
    """First day of 'YYYY-MM', the day itself for 'YYYY-MM-DD', else the first day of the current month."""
    return F.coalesce(
        F.try_to_date(text, "yyyy-MM"), F.try_to_date(text, "yyyy-MM-dd"), F.lit(as_of.replace(day=1))
    )


def next_month(start: Column) -> Column:
    return F.add_months(F.trunc(start, "month"), 1)


def month_number(text: Column) -> Column:
    """'March', 'Mar' or '03' as two digits; NULL for anything else."""
    lower = F.lower(F.trim(text))
    number = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(MONTH_NAMES, start=1))):
        spellings = [name.lower(), name[:3].lower(), f"{i:02d}", str(i)]
        number = F.when(lower.isin(spellings), F.lit(f"{i:02d}")).otherwise(number)
    return number


def month_number_by_prefix(text: Column) -> Column:
    """Looser reading: the first three letters decide, and January stands for the unknown."""
    prefix = F.substring(F.lower(text), 1, 3)
    number = F.lit("01")
    for i, name in reversed(list(enumerate(MONTH_NAMES, start=1))):
        number = F.when(F.lit(name.lower()).startswith(prefix), F.lit(f"{i:02d}")).otherwise(number)
    return number


def month_name(number: Column) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.try_element_at(names, number.cast("int"))
