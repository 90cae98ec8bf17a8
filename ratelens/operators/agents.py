"""Competitor rate increases for every agent, an agent being one company in one state.

The opportunities of an agent are the competitors of its state that raise rates more than two points above the
agent's own rate, best first. The order of the competitors does not depend on the agent, so the best ``k`` of
an agent are always among the best ``k + 1`` of its state (one of which may be the agent itself). Each
state therefore keeps one short sorted array, and each agent filters that array: no pairs of companies
are built, whatever the number of companies in a state.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.dates import EFFECTIVE, since_months, within_days
from ratelens.functions.names import clean_company_name, company_initials, shortened
from ratelens.functions.numeric import (
    avg_pct,
    count_where,
    dec,
    mean_of,
    pct_of,
    rate,
    rounded,
    summed_with_set,
    with_commas,
)
from ratelens.functions.ranking import one_shuffle, positions, top_per_group

AGENT = ["State", "Company"]
UPCOMING = ["avg_increase", "effective_date", "policies_affected", "filing_count", "days_until"]
# Agents are ranked by average rate in percent; bands of a tenth of a point.
RANK_BAND = 0.1


def _placed(filings: DataFrame) -> DataFrame:
    return filings.filter(F.col("State").isNotNull() & F.col("Company").isNotNull())


def carrier_resolve(filings: DataFrame, carrier: str) -> DataFrame:
    """First company of each state whose name contains ``carrier``; states without one are left out."""
    return (
        filings.filter(F.col("Company").contains(carrier) & F.col("State").isNotNull())
        .groupBy("State")
        .agg(F.min("Company").alias("Company"))
    )


def agent_rate(filings: DataFrame, *, as_of: date, months_back: int = 6) -> DataFrame:
    """Average rate change of every company in every state it ever filed in; 0 without recent filings."""
    recent = since_months(as_of, months_back)
    return (
        _placed(filings)
        .groupBy(*AGENT)
        .agg(
            F.coalesce(avg_pct(where=recent), F.lit(0.0)).alias("avg_rate"),
            F.max(F.when(recent, F.col(EFFECTIVE))).alias("latest_date"),
            count_where(recent).alias("filing_count"),
        )
    )


def _rivals(competitors: DataFrame, place: Column, fields: list[str]) -> DataFrame:
    """One row per state: its competitors as an array in the order of ``place``."""
    rival = F.struct(place.alias("place"), *[F.col(c) for c in fields])
    return competitors.groupBy("State").agg(F.sort_array(F.collect_list(rival)).alias("rivals"))


def _pick(agents: DataFrame, rivals: DataFrame, k: int) -> DataFrame:
    """Per agent the first ``k`` rivals that are another company and at least two points above its rate."""
    own, own_rate = F.col("Company"), F.col("avg_rate")
    better = F.filter(
        "rivals", lambda r: (r["competitor"] != own) & (r["avg_increase"] > own_rate + F.lit(2.0))
    )
    return agents.join(rivals, "State", "left").withColumn(
        "opportunities", F.slice(F.coalesce(better, F.array()), 1, k)
    ).drop("rivals")


def _exploded(picked: DataFrame, *extra: Column) -> DataFrame:
    """One row per agent and opportunity, with its rank and the advantage over the agent's rate."""
    rows = picked.select(
        *AGENT, "avg_rate", F.posexplode("opportunities").alias("seq", "o")
    ).select(*AGENT, "avg_rate", (F.col("seq") + 1).cast("bigint").alias("rank"), "o.*")
    return rows.drop("place").withColumn("rate_advantage", F.col("avg_increase") - F.col("avg_rate"))


# --- first report ---------------------------------------------------------------------------------


def _picked_v1(filings: DataFrame, *, as_of: date, months_back: int, k: int, lines: bool = True) -> DataFrame:
    """Best competitors of each agent; ``lines`` adds their product lines."""
    recent = since_months(as_of, months_back)
    coming = (rate() > 0) & recent & (F.col(EFFECTIVE) >= F.lit(as_of))

    def kept(value: Column | str) -> Column:
        return F.when(coming, F.col(value) if isinstance(value, str) else value)

    def one(value: Column) -> Column:
        return F.when(value.isNotNull(), 1).otherwise(0)

    recent_rate = F.when(recent, rate())
    sums = {
        "recent_total": recent_rate,
        "recent_count": one(recent_rate),
        "coming_total": kept(rate()),
        "filing_count": one(kept(F.lit(1))),
        "policies_affected": kept("Policyholders_Affected_Number"),
        "impact_total": kept("Impact_Score"),
        "impact_count": one(kept("Impact_Score")),
    }
    maxima = {
        "largest": kept(rate()),
        "effective_date": kept(EFFECTIVE),
        "last_increase_date": kept("Previous_Increase_Date"),
        "last_increase": kept("Previous_Increase_Number"),
    }
    grouped = summed_with_set(_placed(filings), AGENT, kept("Product_Line") if lines else None, sums, maxima, "product_lines")
    rows = one_shuffle(
        grouped.select(
            *AGENT,
            F.coalesce(pct_of(F.col("recent_total"), F.col("recent_count")), F.lit(0.0)).alias("avg_rate"),
            rounded(pct_of(F.col("coming_total"), F.col("filing_count")), 1).alias("avg_increase"),
            rounded(F.col("largest") * 100, 2).alias("max_increase"),
            "effective_date",
            "filing_count",
            "policies_affected",
            rounded(mean_of(F.col("impact_total"), F.col("impact_count")), 4).alias("avg_impact_score"),
            "last_increase_date",
            rounded(F.col("last_increase") * 100, 2).alias("last_increase"),
            *(["product_lines"] if lines else []),
        )
    )
    competitors = rows.filter("filing_count > 0").withColumnRenamed("Company", "competitor").drop("avg_rate")
    order = [F.desc("avg_increase"), F.desc_nulls_last("avg_impact_score"), F.asc("competitor")]
    best = top_per_group(competitors, ["State"], order, k + 1)
    rivals = _rivals(best, F.col("place"), [c for c in best.columns if c not in ("State", "place")])
    return _pick(rows.select(*AGENT, "avg_rate"), rivals, k)


def opportunities_v1(
    filings: DataFrame, *, as_of: date, months_back: int = 6, k: int = 10
) -> DataFrame:
    rows = _exploded(_picked_v1(filings, as_of=as_of, months_back=months_back, k=k))
    return rows.withColumn("rate_advantage", rounded(F.col("rate_advantage"), 4)).withColumn(
        "avg_rate", rounded(F.col("avg_rate"), 4)
    )


def market_summary_v1(filings: DataFrame, *, as_of: date, months_back: int = 6) -> DataFrame:
    rising = avg_pct(where=rate() > 0)
    return (
        filings.filter(since_months(as_of, months_back) & F.col("State").isNotNull())
        .groupBy("State")
        .agg(
            F.countDistinct("Company").alias("total_carriers"),
            rounded(rising, 4).alias("avg_increase"),
            F.count(F.lit(1)).alias("total_filings"),
            F.sum("Policyholders_Affected_Number").alias("total_affected"),
            F.when(rising > 5, "Hardening (Rates Rising)").otherwise("Stable").alias("market_direction"),
        )
    )


# --- market position ------------------------------------------------------------------------------


def _carriers(filings: DataFrame, as_of: date, *extra: Column) -> DataFrame:
    """One row per agent: its average over six months, NULL without recent filings.

    A company whose recent rates are all unknown gets an average above all others, so that it ranks last.
    """
    recent = since_months(as_of, 6)
    average = F.coalesce(avg_pct(where=recent), F.lit(1e12))
    recent_average = F.when(F.count_if(recent) > 0, average).alias("recent_avg")
    return one_shuffle(_placed(filings).groupBy(*AGENT).agg(recent_average, *extra))


def _places(carriers: DataFrame) -> DataFrame:
    """Place of the carriers with recent filings in their state, lowest average first."""
    ranked = carriers.filter(F.col("recent_avg").isNotNull()).select(*AGENT, "recent_avg")
    return positions(ranked, ["State"], "recent_avg", "Company", RANK_BAND).select(*AGENT, "position")


def _places_of_all(carriers: DataFrame) -> DataFrame:
    """Every agent with its place and the number of ranked carriers of the state; 1 of 1 if it is not ranked."""
    totals = carriers.groupBy("State").agg(F.count("recent_avg").alias("total"))
    ranked = F.col("position").isNotNull()
    return (
        carriers.join(_places(carriers), AGENT, "left")
        .join(totals, "State")
        .withColumn("total_carriers", F.when(ranked, F.col("total")).otherwise(F.lit(1)).cast("bigint"))
        .withColumn("position", F.coalesce("position", F.lit(1)).cast("bigint"))
        .drop("total", "recent_avg")
    )


def market_position(filings: DataFrame, *, as_of: date) -> DataFrame:
    """Place of every agent among the carriers of its state; unranked agents get N/A."""
    carriers = _carriers(filings, as_of)
    label = F.concat(F.lit("#"), F.coalesce(F.col("position").cast("string"), F.lit("N/A")))
    return carriers.join(_places(carriers), AGENT, "left").select(
        *AGENT, "position", label.alias("your_position")
    )


def market_position_total(filings: DataFrame, *, as_of: date) -> DataFrame:
    """Place and number of ranked carriers; 1 of 1 for an agent that is not ranked."""
    return _places_of_all(_carriers(filings, as_of)).select(*AGENT, "position", "total_carriers")


# --- revenue report -------------------------------------------------------------------------------


def _upcoming_columns(as_of: date, where: Column | None = None) -> list[Column]:
    """Increases that take effect soon: average, last date, policies, filings and days to go."""

    def kept(value: Column | str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return value if where is None else F.when(where, value)

    return [
        rounded(avg_pct(where=where), 1).alias("avg_increase"),
        F.max(kept(EFFECTIVE)).alias("effective_date"),
        F.sum(kept("Policyholders_Affected_Number")).alias("policies_affected"),
        F.count(kept(F.lit(1))).alias("filing_count"),
        F.datediff(F.max(kept(EFFECTIVE)), F.lit(as_of)).cast("bigint").alias("days_until"),
    ]


def _is_upcoming(as_of: date, above: str, days: int) -> Column:
    return (rate() > dec(above)) & within_days(as_of, 0, days)


def _agents_and_upcoming(filings: DataFrame, as_of: date, above: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Every agent with its rate, and per state and company the increases above a threshold that take effect soon.

    Both come from one aggregate, so the filings are read and shuffled once.
    """
    recent = since_months(as_of, 6)
    average = F.coalesce(avg_pct(where=recent), F.lit(0.0)).alias("avg_rate")
    upcoming = _upcoming_columns(as_of, _is_upcoming(as_of, above, days))
    rows = one_shuffle(_placed(filings).groupBy(*AGENT).agg(average, *upcoming))
    agents = rows.select(*AGENT, "avg_rate")
    competitors = rows.filter("filing_count > 0").select(
        "State", F.col("Company").alias("competitor"), *UPCOMING
    )
    return agents, competitors


# The steps of the chance to win, the names of the customer groups and of the time windows.


def win_probability(advantage: Column) -> Column:
    """Percent chance to win a customer back, by points of rate advantage."""
    return (
        F.when(advantage > 10, 85)
        .when(advantage > 7, 75)
        .when(advantage > 5, 65)
        .when(advantage > 3, 55)
        .otherwise(45)
        .cast("bigint")
    )


def commission(
    policies: Column, win_pct: Column, avg_premium: int = 1200, commission_rate: str = "0.15"
) -> Column:
    """Whole commission; unknown policy counts stand for 100. Exact decimals, cut, not rounded."""
    known = F.coalesce(policies, F.lit(100)).cast("decimal(18,0)")
    per_policy = F.lit(Decimal(avg_premium) * Decimal(commission_rate) / 100).cast("decimal(10,4)")
    return (known * per_policy * win_pct.cast("decimal(3,0)")).cast("bigint")


def target_segments(company: Column, increase: Column) -> Column:
    """Customer groups worth calling: by size of the increase, then by brand; at most three."""
    named = (
        F.when(company.contains("State Farm"), "Loyalty seekers")
        .when(company.contains("Progressive"), "Tech-savvy")
        .when(company.contains("Allstate"), "Full coverage")
    )
    wanted = F.array(
        F.when(increase > 10, "Multi-car households"),
        F.when(increase > 10, "Long-term customers"),
        F.when(increase > 7, "Good drivers"),
        F.when(increase > 7, "Bundle opportunities"),
        F.when(increase > 5, "Price-sensitive"),
        named,
    )
    return F.slice(F.array_compact(wanted), 1, 3)


def action_window(days: Column) -> Column:
    return (
        F.when(days <= 30, "Contact immediately - renewal notices going out")
        .when(days <= 45, "Prime time - customers shopping for alternatives")
        .when(days <= 60, "Early outreach - build awareness")
        .otherwise("Plan campaign - prepare materials")
    )


def _best_v2(agents: DataFrame, competitors: DataFrame, k: int = 12) -> DataFrame:
    order = [F.desc("avg_increase"), F.desc_nulls_last("policies_affected"), F.asc("competitor")]
    best = top_per_group(competitors, ["State"], order, k + 1)
    return _pick(agents, _rivals(best, F.col("place"), [c for c in competitors.columns if c != "State"]), k)


def _picked_v2(filings: DataFrame, *, as_of: date, k: int = 12) -> DataFrame:
    agents, competitors = _agents_and_upcoming(filings, as_of, "0.02", 90)
    return _best_v2(agents, competitors, k)


def opportunities_v2(filings: DataFrame, *, as_of: date, k: int = 12) -> DataFrame:
    rows = _exploded(_picked_v2(filings, as_of=as_of, k=k))
    return (
        rows.withColumn("win_probability", win_probability(F.col("rate_advantage")))
        .withColumn("rate_advantage", rounded(F.col("rate_advantage"), 4))
        .withColumn("avg_rate", rounded(F.col("avg_rate"), 4))
    )


def commission_opportunity(
    opportunities: DataFrame, *, avg_premium: int = 1200, commission_rate: str = "0.15"
) -> DataFrame:
    """``opportunities_v2`` with policies (100 if unknown) and commission."""
    return opportunities.withColumn(
        "commission_opportunity",
        commission(F.col("policies_affected"), F.col("win_probability"), avg_premium, commission_rate),
    ).withColumn("policies", F.coalesce("policies_affected", F.lit(100)).cast("bigint"))


def opportunity_segments(opportunities: DataFrame) -> DataFrame:
    return opportunities.withColumn(
        "segments", target_segments(F.col("competitor"), F.col("avg_increase"))
    )


def opportunity_windows(opportunities: DataFrame) -> DataFrame:
    return opportunities.withColumn("action_window", action_window(F.col("days_until")))


def _valued(
    picked: DataFrame, avg_premium: int = 1200, commission_rate: str = "0.15", win_pct: int | None = None
) -> DataFrame:
    """Opportunity arrays with advantage, win probability and commission added to each entry."""
    own_rate = F.col("avg_rate")

    def value(o: Column) -> Column:
        advantage = o["avg_increase"] - own_rate
        win = win_probability(advantage) if win_pct is None else F.lit(win_pct)
        return F.struct(
            o["competitor"].alias("competitor"),
            o["avg_increase"].alias("avg_increase"),
            o["effective_date"].alias("effective_date"),
            o["days_until"].alias("days_until"),
            advantage.cast("decimal(18,8)").alias("rate_advantage"),
            win.cast("bigint").alias("win_probability"),
            F.coalesce(o["policies_affected"], F.lit(100)).cast("bigint").alias("policies"),
            commission(o["policies_affected"], win, avg_premium, commission_rate).alias("commission"),
        )

    return picked.withColumn("opportunities", F.transform("opportunities", value))


def _total(field: str, kind: str = "bigint") -> Column:
    return F.aggregate(
        F.transform("opportunities", lambda o: o[field]), F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind)
    )


def _count_days(limit: int) -> Column:
    return F.size(F.filter("opportunities", lambda o: o["days_until"] <= limit)).cast("bigint")


def _summary_columns() -> list[Column]:
    n = F.size("opportunities").cast("bigint")
    advantage = mean_of(_total("rate_advantage", "decimal(28,8)"), n)
    return [
        n.alias("total_opportunities"),
        _total("commission").alias("potential_revenue"),
        _total("policies").alias("total_policies"),
        F.coalesce(rounded(advantage, 1), F.lit(0.0)).alias("your_advantage"),
        _count_days(30).alias("urgent_count"),
        F.coalesce(F.floor(F.try_divide(_total("win_probability"), n)), F.lit(0)).cast("bigint").alias("win_rate"),
    ]


def agent_summary_v2(filings: DataFrame, *, as_of: date, avg_premium: int = 1200) -> DataFrame:
    """Totals per agent over its opportunities, taken from the arrays without another shuffle."""
    return _valued(_picked_v2(filings, as_of=as_of), avg_premium).select(*AGENT, *_summary_columns())


# --- refined report: one carrier term, all states ---------------------------------------------------


def _raising(filings: DataFrame, carrier: str, as_of: date) -> DataFrame:
    return _placed(filings).filter(
        (rate() > dec("0.02")) & within_days(as_of, 30, 90) & ~F.col("Company").contains(carrier)
    )


def rate_increases_refined(filings: DataFrame, carrier: str, *, as_of: date, k: int = 15) -> DataFrame:
    """Per state the companies other than the carrier that raise rates soon, with their three latest changes.

    The latest changes come from a top-3 per company that is cut before its shuffle, not from a list of
    all changes.
    """
    raising = _raising(filings, carrier, as_of)
    sums = {"total": rate(), "filing_count": F.lit(1), "policies_affected": F.col("Policyholders_Affected_Number")}
    grouped = summed_with_set(raising, AGENT, F.col("Product_Line"), sums, {"effective_date": F.col(EFFECTIVE)}, "product_lines")
    companies = grouped.filter(F.col("total") > F.col("filing_count") * dec("0.03")).select(
        *AGENT,
        "filing_count",
        rounded(pct_of(F.col("total"), F.col("filing_count")), 1).alias("avg_increase"),
        "effective_date",
        "policies_affected",
        F.datediff("effective_date", F.lit(as_of)).cast("bigint").alias("days_until"),
        "product_lines",
    )
    order = [F.asc("days_until"), F.desc("avg_increase"), F.asc("Company")]
    first = top_per_group(companies, ["State"], order, k, "rank")
    latest = top_per_group(
        raising.select(*AGENT, EFFECTIVE, "Record_ID", (rate() * 100).cast("decimal(10,1)").alias("change")),
        AGENT,
        [F.desc(EFFECTIVE), F.desc("Record_ID")],
        3,
    )
    changes = latest.groupBy(*AGENT).agg(
        F.sort_array(F.collect_list(F.struct("place", "change"))).alias("changes")
    )
    return first.join(changes, AGENT).withColumn("recent_changes", F.col("changes.change")).drop("changes")


def refined_summary(filings: DataFrame, carrier: str, *, as_of: date) -> DataFrame:
    """Unlike the list, the summary has no minimum average."""
    total = F.sum("Policyholders_Affected_Number")
    return (
        _raising(filings, carrier, as_of)
        .groupBy("State")
        .agg(
            F.countDistinct("Company").alias("companies_raising"),
            rounded(avg_pct(), 1).alias("avg_increase"),
            rounded(F.max(rate()) * 100, 1).alias("max_increase"),
            F.coalesce(total, F.lit(0)).alias("total_policies"),
        )
        .withColumn(
            "estimated_policies",
            F.when(F.col("total_policies") > 0, with_commas(F.col("total_policies"))).otherwise("5,000+"),
        )
    )


def urgency(increases: DataFrame) -> DataFrame:
    """Display columns of ``rate_increases_refined`` and the number of urgent rows among the few of each state."""
    days = F.col("days_until")
    lines = F.coalesce("product_lines", F.lit("Auto"))
    return increases.select(
        "State",
        "rank",
        "Company",
        clean_company_name(F.col("Company"), "refined").alias("competitor"),
        F.col("avg_increase").alias("rate_increase"),
        F.greatest(days, F.lit(0)).cast("bigint").alias("days_until"),
        F.when(F.col("policies_affected") > 0, with_commas(F.col("policies_affected")))
        .otherwise("N/A")
        .alias("policies_affected"),
        shortened(lines, 30).alias("product_lines"),
        rounded(F.greatest(F.lit(0.0), (F.lit(90) - days) * 100 / F.lit(90)), 1).alias("urgency_percent"),
        F.when(days <= 30, "#dc2626").otherwise("#10b981").alias("urgency_color"),
        count_where(days <= 30).over(Window.partitionBy("State")).alias("urgent_opportunities"),
    )


def outreach_timeline(increases: DataFrame, *, k: int = 6) -> DataFrame:
    """Per state the next effective dates, each with the day to start calling: 30 days before."""
    coming = increases.filter(F.col("days_until") >= 0)
    first = top_per_group(coming, ["State"], [F.asc("days_until"), F.asc("rank")], k, "step")
    return first.select(
        "State",
        "step",
        clean_company_name(F.col("Company"), "refined").alias("carrier"),
        F.date_format("effective_date", "MMM dd").alias("effective_date"),
        F.date_format(F.date_sub("effective_date", 30), "MMM dd").alias("outreach_date"),
        "days_until",
    )


# --- third report ---------------------------------------------------------------------------------


def _picked_v3(filings: DataFrame, *, as_of: date, k: int = 6, days: int = 60) -> DataFrame:
    """Nearest date first. Whoever passes on a given day is a prefix of that day's list by size of the increase,
    so ``k + 1`` companies per state and day hold every agent's first ``k``: at most (days + 1) x (k + 1)
    entries for a state.
    """
    agents, competitors = _agents_and_upcoming(filings, as_of, "0.03", days)
    competitors = competitors.drop("filing_count")
    best = top_per_group(
        competitors, ["State", "days_until"], [F.desc("avg_increase"), F.asc("competitor")], k + 1, "day_place"
    )
    place = F.struct("days_until", -F.col("avg_increase"), "competitor")
    rivals = _rivals(best, place, [c for c in competitors.columns if c != "State"])
    return _pick(agents, rivals, k)


def opportunities_v3(filings: DataFrame, *, as_of: date, k: int = 6) -> DataFrame:
    rows = _exploded(_picked_v3(filings, as_of=as_of, k=k))
    return rows.withColumn("rate_advantage", rounded(F.col("rate_advantage"), 4)).withColumn(
        "avg_rate", rounded(F.col("avg_rate"), 4)
    )


def weekly_filing_trend(filings: DataFrame, *, as_of: date) -> DataFrame:
    """Filings per state and week (Monday) of the last 90 days."""
    return (
        filings.filter(within_days(as_of, 90, 0) & F.col("State").isNotNull())
        .groupBy("State", F.trunc(EFFECTIVE, "week").alias("week"))
        .agg(F.count(F.lit(1)).alias("filings"))
    )


def agent_revenue_v3(filings: DataFrame, *, as_of: date) -> DataFrame:
    valued = _valued(_picked_v3(filings, as_of=as_of), win_pct=65)
    return valued.select(
        *AGENT,
        F.size("opportunities").cast("bigint").alias("win_back_count"),
        _total("commission").alias("revenue_opportunity"),
        _count_days(7).alias("urgent_actions"),
    )


def agent_timeline(filings: DataFrame, *, as_of: date, k: int = 5) -> DataFrame:
    """Next effective dates per agent in each of the three reports."""

    def steps(picked: DataFrame, variant: str, horizon: int | None, urgent) -> DataFrame:
        days = lambda o: F.datediff(o["effective_date"], F.lit(as_of)).cast("bigint")
        events = F.transform(
            "opportunities",
            lambda o, i: F.struct(
                days(o).alias("days_until"),
                i.alias("seq"),
                o["competitor"].alias("competitor"),
                o["effective_date"].alias("effective_date"),
            ),
        )
        if horizon is not None:
            events = F.filter(events, lambda e: e["days_until"] <= horizon)
        first = F.slice(F.sort_array(events), 1, k)
        rows = picked.select(*AGENT, F.posexplode(first).alias("step", "e"))
        return rows.select(
            F.lit(variant).alias("variant"),
            *AGENT,
            (F.col("step") + 1).cast("bigint").alias("step"),
            "e.competitor",
            "e.effective_date",
            "e.days_until",
            urgent(F.col("e.days_until")).alias("urgent"),
        )

    v1 = _picked_v1(filings, as_of=as_of, months_back=6, k=10, lines=False)
    v2 = _picked_v2(filings, as_of=as_of)
    v3 = _picked_v3(filings, as_of=as_of)
    return (
        steps(v1, "v1", None, lambda d: (d > 0) & (d <= 60))
        .unionByName(steps(v2, "v2", 60, lambda d: d <= 30))
        .unionByName(steps(v3, "v3", 30, lambda d: d <= 7))
    )


# --- names and the batch ----------------------------------------------------------------------------


def cleaned_names(companies: DataFrame) -> DataFrame:
    """Display name of each distinct company in every report variant."""
    name = F.col("Company")
    return companies.select("Company").distinct().select(
        "Company",
        *[clean_company_name(name, v).alias(f"name_{v}") for v in ("v1", "v2", "refined", "v3")],
    )


def initials(companies: DataFrame) -> DataFrame:
    return companies.select("Company").distinct().select(
        "Company", company_initials(F.col("Company")).alias("initials")
    )


def agent_report_batch(filings: DataFrame, *, as_of: date, avg_premium: int = 1200, shown: int = 6) -> DataFrame:
    """The revenue report of every agent at once: rate, place, totals and the first opportunities.

    The filings are read once, into one row per agent that also holds its own upcoming increases.
    """
    recent = since_months(as_of, 6)
    carriers = _carriers(
        filings,
        as_of,
        F.coalesce(avg_pct(where=recent), F.lit(0.0)).alias("avg_rate"),
        *_upcoming_columns(as_of, _is_upcoming(as_of, "0.02", 90)),
    )
    competitors = carriers.filter("filing_count > 0").select(
        "State",
        F.col("Company").alias("competitor"),
        "avg_increase",
        "effective_date",
        "policies_affected",
        "filing_count",
        "days_until",
    )
    placed = _places_of_all(carriers.select(*AGENT, "avg_rate", "recent_avg"))
    valued = _valued(_best_v2(placed, competitors), avg_premium)
    return valued.select(
        *AGENT,
        rounded(F.col("avg_rate"), 4).alias("avg_rate"),
        *_summary_columns(),
        F.slice("opportunities", 1, shown).alias("top_opportunities"),
        "position",
        "total_carriers",
    )
