"""Sentences of the market report, put together in one pass over the filings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.dates import between_months
from ratelens.functions.numeric import mean_of, one_decimal, pct_of, rounded
from ratelens.operators import market


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _first(states: Column, k: int) -> Column:
    """Names of the first ``k`` entries of a sorted array of (order, State)."""
    return F.array_join(F.transform(F.slice(states, 1, k), lambda s: s["State"]), ", ")


def headline_figures(filings: DataFrame, *, as_of: date) -> DataFrame:
    """One row with what the sentences need: the market, the leading states and the leading company.

    The figures per state, per company and overall are grouping sets of the per-carrier sums of the last twelve
    months, so the filings are read once. The state lists hold at most all states.
    """
    carriers = market.per_carrier(filings.filter(between_months(as_of, 12)))
    keys = [F.col("State"), F.col("Company")]
    groups = carriers.groupingSets([[keys[0]], [keys[1]], []], *keys).agg(
        F.grouping_id().alias("level"),
        F.sum("n").alias("n"),
        F.sum("rates").alias("rates"),
        F.count(F.lit(1)).alias("members"),
        rounded(pct_of(F.sum("total"), F.sum("rates")), 2).alias("avg"),
        F.sum("ups").alias("ups"),
        F.sum("downs").alias("downs"),
        rounded(pct_of(F.sum("up_total"), F.sum("ups")), 2).alias("avg_up"),
    )
    of_state, of_company, of_all = (F.col("level") == x for x in (1, 2, 3))
    ranked_company = of_company & (F.col("n") >= 5)
    busiest = F.struct((-F.col("n")).alias("order"), F.col("State").isNull().alias("unknown"), "State")
    state = F.struct("State", "n", "avg")
    company = F.struct("Company", "avg_up", "members")
    steepest = F.struct(-F.col("avg_up"), F.col("Company").isNull(), "Company")
    return groups.agg(
        F.max(F.when(of_all, F.struct("n", "rates", "ups", "downs", "avg_up"))).alias("market"),
        F.count_if(of_company & F.col("Company").isNotNull()).alias("companies"),
        F.min_by(state, F.when(of_state, busiest)).alias("top_state"),
        F.sort_array(F.collect_list(F.when(of_state & (F.col("avg") > 10), busiest))).alias("steep_states"),
        F.sort_array(F.collect_list(F.when(of_state & (F.col("n") > 50), busiest))).alias("busy_states"),
        F.min_by(company, F.when(ranked_company & F.col("avg_up").isNotNull(), steepest)).alias("top_company"),
        F.least(F.count_if(ranked_company & (F.col("avg_up") > 10)), F.lit(5)).alias("steep_companies"),
    )


def _finding(number: int, name: str, text: Column, when: Column) -> Column:
    entry = F.struct(
        F.lit(number).cast("bigint").alias("finding_no"), F.lit(name).alias("finding"), text.alias("value")
    )
    return F.when(when, entry)


def _finding_entries() -> list[Column]:
    """Headline sentences: market, share of increases, busiest state, steep states, steepest company.

    Fixed values: the words of the sentences, here and in the advice.
    """
    m, s, c = F.col("market"), F.col("top_state"), F.col("top_company")
    any_filings = F.coalesce(m["n"], F.lit(0)) > 0
    share = mean_of(m["ups"], m["n"]) * 100
    return [
        _finding(
            1,
            "market_increase",
            _text(
                "Market shows ",
                one_decimal(m["avg_up"]),
                "% average rate increase across ",
                F.col("companies"),
                " companies",
            ),
            any_filings,
        ),
        _finding(
            2,
            "increase_share",
            _text(
                m["ups"], " rate increases vs ", m["downs"], " decreases (", one_decimal(share), "% increase rate)"
            ),
            any_filings,
        ),
        _finding(
            3,
            "top_state",
            _text(
                s["State"], " leads with ", s["n"], " filings and ", one_decimal(s["avg"]), "% average change"
            ),
            s.isNotNull(),
        ),
        _finding(
            4,
            "aggressive_states",
            _text("Aggressive rate increases in: ", _first(F.col("steep_states"), 3), " (all >10% average)"),
            F.size("steep_states") > 0,
        ),
        _finding(
            5,
            "top_company",
            _text(
                F.split(F.trim(c["Company"]), r"\s+")[0],
                "... leads with ",
                one_decimal(c["avg_up"]),
                "% average increase across ",
                c["members"],
                " states",
            ),
            c.isNotNull(),
        ),
    ]


def _advice_entries() -> list[Column]:
    """Sections of advice; a section without matching states, companies or zones is left out."""
    return [
        _finding(
            1,
            "Geographic Opportunities",
            _text(
                "High-activity states (",
                _first(F.col("busy_states"), 5),
                ") show consistent filing patterns, suggesting mature markets with established rate adjustment"
                " cycles.",
            ),
            F.size("busy_states") > 0,
        ),
        _finding(
            2,
            "Competitive Landscape",
            _text(
                F.col("steep_companies"),
                " companies are pursuing aggressive rate increases (>10% average), potentially creating market"
                " opportunities for competitive positioning.",
            ),
            F.col("steep_companies") > 0,
        ),
        _finding(
            3,
            "Risk Areas",
            _text(
                F.col("zones"),
                " state/company combinations show concentrated rate increase activity. These 'hot zones' may face"
                " regulatory scrutiny or customer retention challenges.",
            ),
            F.col("zones") > 0,
        ),
    ]


def _rows(figures: DataFrame, entries: list[Column]) -> DataFrame:
    return figures.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _with_zones(filings: DataFrame, as_of: date) -> DataFrame:
    zones = market.hot_zones(filings, as_of=as_of).agg(F.count(F.lit(1)))
    return headline_figures(filings, as_of=as_of).withColumn("zones", zones.scalar())


def key_findings(filings: DataFrame, *, as_of: date) -> DataFrame:
    return _rows(headline_figures(filings, as_of=as_of), _finding_entries())


def strategic_insights(filings: DataFrame, *, as_of: date) -> DataFrame:
    return _rows(_with_zones(filings, as_of), _advice_entries())


def _impacts() -> list[Column]:
    """Weight of each finding, then of each advice, between 0 and 1."""
    m, s, c = F.col("market"), F.col("top_state"), F.col("top_company")
    points = lambda value: F.least(F.lit(1.0), value / 10)
    share = lambda part, whole: F.least(F.lit(1.0), mean_of(part, whole))
    return [
        points(m["avg_up"]),
        share(m["ups"], m["n"]),
        share(s["n"], m["n"]),
        share(F.size("steep_states"), F.lit(3)),
        points(c["avg_up"]),
        share(F.size("busy_states"), F.lit(5)),
        share(F.col("steep_companies"), F.lit(5)),
        share(F.col("zones"), F.lit(20)),
    ]


def insights(filings: DataFrame, *, as_of: date) -> DataFrame:
    """Findings and advice as scored insights.

    The shape is published, the scores are this library's own. Impact: ten points of average increase, or all of the
    filings, of the three states shown, of the five states or companies shown or of the twenty zones shown, weigh 1, less
    weighs in proportion. Confidence: the share of the filings of the last twelve months whose rate is known.
    """
    confidence = rounded(mean_of(F.col("market.rates"), F.col("market.n")), 4)

    def scored(entry: Column, score: Column, category: str) -> Column:
        insight = F.struct(
            entry["finding"].alias("insight"),
            entry["value"].alias("description"),
            rounded(F.coalesce(score, F.lit(0.0)), 4).alias("impact_score"),
            confidence.alias("confidence"),
            F.lit(category).alias("category"),
        )
        return F.when(entry.isNotNull(), insight)

    named = [(e, "market_trend") for e in _finding_entries()] + [(e, "strategy") for e in _advice_entries()]
    entries = [scored(e, impact, kind) for (e, kind), impact in zip(named, _impacts())]
    return _rows(_with_zones(filings, as_of), entries)
