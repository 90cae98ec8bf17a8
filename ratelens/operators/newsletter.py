"""Monthly newsletter figures, every state and month of a range in one pass.

``first`` and ``last`` are any days of the first and the last month; without them all months count.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.dates import EFFECTIVE, in_months, month_number, month_of, month_start, next_month
from ratelens.functions.names import display_company
from ratelens.functions.numeric import RATE, avg_pct, one_decimal, pct_of, rate, rounded, short_number, sum_where
from ratelens.functions.ranking import top_per_group
from ratelens.functions.states import state_abbr

EDITION = ["State", "month"]


class NoDataError(Exception):
    """No filings exist for the requested state and month."""


def _dated(filings: DataFrame, first: date | None, last: date | None) -> DataFrame:
    known = F.col("State").isNotNull() & F.col(EFFECTIVE).isNotNull()
    return filings.filter(known & in_months(first, last)).withColumn("month", month_of(EFFECTIVE))


def month_bounds(months: DataFrame, column: str, *, as_of: date) -> DataFrame:
    """First day, day after the last, and label of each month text."""
    start = month_start(F.col(column), as_of)
    return months.select(
        column,
        start.alias("start_date"),
        next_month(start).alias("end_date"),
        F.date_format(start, "MMMM yyyy").alias("label"),
    )


def state_activity(filings: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    return _dated(filings, first, last).groupBy(*EDITION).agg(F.count(F.lit(1)).alias("filings"))


def top_product_line(filings: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Most frequent product line; among equals the first by name."""
    counted = _dated(filings, first, last).groupBy(*EDITION, "Product_Line").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(-F.col("n"), F.col("Product_Line").isNull(), "Product_Line")
    return counted.groupBy(*EDITION).agg(
        F.min_by("Product_Line", order).alias("product_line"), F.max("n").alias("filings")
    )


def newsletter_summary(filings: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Companies that raise rates, their average increase and the policyholders affected."""
    up = rate() > 0
    return (
        _dated(filings, first, last)
        .groupBy(*EDITION)
        .agg(
            F.countDistinct(F.when(up, F.col("Company"))).alias("companies"),
            F.coalesce(rounded(avg_pct(where=up), 1), F.lit(0.0)).alias("avg_increase_pct"),
            F.coalesce(sum_where(up, "Policyholders_Affected_Number"), F.lit(0)).alias("policies"),
        )
    )


def rate_cards(
    filings: DataFrame, first: date | None = None, last: date | None = None, *, limit: int = 3
) -> DataFrame:
    """Highest-impact increases of each state and month; the impact score decides, then the rate."""
    order = [F.desc_nulls_last("Impact_Score"), F.desc(RATE), F.asc("Record_ID")]
    best = top_per_group(_dated(filings, first, last).filter(rate() > 0), EDITION, order, limit, "place")
    return best.select(
        *EDITION,
        "place",
        "Record_ID",
        "Company",
        "Subsidiary",
        F.col("Impact_Score").cast("double").alias("impact_score"),
        (rate() * 100).cast("decimal(10,1)").alias("change_pct"),
        F.coalesce("Policyholders_Affected_Number", F.lit(0)).cast("bigint").alias("policies"),
        EFFECTIVE,
    )


def card_display(cards: DataFrame) -> DataFrame:
    """Texts of a rate card."""
    return cards.select(
        *EDITION,
        "place",
        "Record_ID",
        display_company(F.col("Company"), F.col("Subsidiary")).alias("company"),
        F.col("change_pct").cast("string").alias("change_pct"),
        short_number(F.col("policies")).alias("policies"),
        F.coalesce(F.date_format(EFFECTIVE, "MMM dd"), F.lit("-")).alias("effective_date"),
    )


def overall_stats(filings: DataFrame) -> DataFrame:
    return filings.agg(
        F.count(F.lit(1)).alias("total_filings"),
        F.coalesce(F.sum("Policyholders_Affected_Number"), F.lit(0)).alias("policyholders"),
        F.countDistinct("Company").alias("carriers"),
    )


def short_numbers(values: DataFrame, column: str, out: str) -> DataFrame:
    return values.withColumn(out, short_number(F.col(column)))


def state_abbreviations(states: DataFrame, column: str) -> DataFrame:
    """Abbreviation of each distinct spelling."""
    return (
        states.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("abbr", state_abbr(F.col(column)))
    )


def pending_reports(
    filings: DataFrame, reports: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Active states and months for which no report was logged; reports may spell the month in any way.

    A report whose month or year cannot be read stands for no edition.
    """
    day = F.concat_ws("-", "Year", month_number(F.col("Month")), F.lit("01"))
    logged = reports.select("State", F.try_to_date(day, "yyyy-MM-dd").alias("month"))
    return state_activity(filings, first, last).join(logged, EDITION, "left_anti")


def _editions(filings: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Summary and top product line of each state and month from one read of the filings.

    A filing counts for its product line, with the sums, and, if it raises a rate, once more for its company, without them: rows
    per line give the sums and the most frequent line, rows per company only the number of companies that raise rates.
    """
    up = rate() > 0
    names = F.array(
        F.struct(F.lit(True).alias("is_line"), F.col("Product_Line").alias("name")),
        F.struct(F.lit(False).alias("is_line"), F.when(up, F.col("Company")).alias("name")),
    )
    line = F.col("is_line")
    groups = (
        _dated(filings, first, last)
        .select(*EDITION, RATE, "Policyholders_Affected_Number", F.inline(names))
        .filter(line | F.col("name").isNotNull())
        .groupBy(*EDITION, "is_line", "name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(line & up).alias("ups"),
            sum_where(line & up, rate()).alias("up_total"),
            sum_where(line & up, "Policyholders_Affected_Number").alias("up_policies"),
        )
    )
    most = F.struct(-F.col("n"), F.col("name").isNull(), F.col("name"))
    return groups.groupBy(*EDITION).agg(
        F.count_if(~line).alias("companies"),
        F.coalesce(rounded(pct_of(F.sum("up_total"), F.sum("ups")), 1), F.lit(0.0)).alias("avg_increase_pct"),
        short_number(F.coalesce(F.sum("up_policies"), F.lit(0))).alias("policies_affected"),
        F.min_by("name", F.when(line, most)).alias("product_line"),
    )


def newsletter_batch(filings: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Everything a newsletter shows, one row per state and month that has filings.

    A month without filings has no row; ``require_edition`` turns that into an error for a single edition.
    """
    cards = card_display(rate_cards(filings, first, last))
    card = F.struct("place", "Record_ID", "company", "change_pct", "policies", "effective_date")
    card_lists = cards.groupBy(*EDITION).agg(F.sort_array(F.collect_list(card)).alias("cards"))
    no_cards = F.array().cast(
        "array<struct<place:bigint,Record_ID:string,company:string,change_pct:string,policies:string,"
        "effective_date:string>>"
    )
    stats = overall_stats(filings).select(
        F.struct(
            short_number(F.col("total_filings")).alias("total_filings"),
            short_number(F.col("policyholders")).alias("total_policyholders"),
            short_number(F.col("carriers")).alias("carriers_tracked"),
        ).alias("stats")
    )
    return (
        _editions(filings, first, last)
        .join(card_lists, EDITION, "left")
        .withColumn("cards", F.coalesce("cards", no_cards))
        .withColumn("stats", stats.scalar())
    )


def require_edition(batch: DataFrame, state: str, month: date) -> DataFrame:
    """The row of one state and month."""
    edition = batch.filter((F.col("State") == state) & (F.col("month") == F.lit(month)))
    if edition.isEmpty():
        raise NoDataError(f"no filings for {state} in {month:%B %Y}")
    return edition


_PAGE = (
    "<!DOCTYPE html><html><head><title>{state} {label}</title></head><body>"
    '<div class="edition"><b>{label}</b> <span>{state}</span> <i>{product_line}</i></div>'
    "<h2>Highest Impact Changes</h2><table><tr><th>Company</th><th>Rate Change</th><th>Policies Affected</th>"
    "<th>Effective Date</th></tr>{cards}</table>"
    '<div class="summary"><h3>{state} Market Summary</h3><p>{companies} Companies Taking Rate</p>'
    "<p>{avg_increase}% Average Rate Increase</p><p>{policies} Policyholders Affected</p>"
    "<p>{start} - {end}</p></div>"
    '<div class="stats"><p>{total_filings} Rate Filings Tracked</p><p>{total_policyholders} Affected Policyholders</p>'
    "<p>{carriers} Carriers Tracked</p></div></body></html>"
)


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _fill(page: str, values: dict[str, Column]) -> Column:
    """The page text with each ``{name}`` replaced by a column; a NULL shows as nothing."""
    pieces, rest = [], page
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(text), F.coalesce(values[name].cast("string"), F.lit(""))]
    return F.concat(*pieces, F.lit(rest))


def newsletter_html(batch: DataFrame) -> DataFrame:
    """One HTML page per row of ``newsletter_batch``, built where the row is."""
    card = lambda c, i: F.concat(
        F.when(i % 2 == 1, F.lit('<tr class="even"><td>')).otherwise(F.lit("<tr><td>")),
        _escaped(c["company"]),
        F.lit('</td><td style="color:#ef4444">+'),
        c["change_pct"],
        F.lit("%</td><td>"),
        c["policies"],
        F.lit("</td><td>"),
        c["effective_date"],
        F.lit("</td></tr>"),
    )
    end = F.date_sub(next_month(F.col("month")), 1)
    html = _fill(
        _PAGE,
        {
            "state": _escaped(F.col("State")),
            "label": F.date_format("month", "MMMM yyyy"),
            "product_line": _escaped(F.col("product_line")),
            "cards": F.array_join(F.transform("cards", card), ""),
            "companies": F.col("companies"),
            "avg_increase": one_decimal(F.col("avg_increase_pct")),
            "policies": F.col("policies_affected"),
            "start": F.date_format("month", "MMMM dd, yyyy"),
            "end": F.date_format(end, "MMMM dd, yyyy"),
            "total_filings": F.col("stats.total_filings"),
            "total_policyholders": F.col("stats.total_policyholders"),
            "carriers": F.col("stats.carriers_tracked"),
        },
    )
    return batch.select(
        *EDITION,
        state_abbr(F.col("State")).alias("state_abbr"),
        F.col("cards.Record_ID").alias("filings"),
        html.alias("html"),
    )
