"""Secret scans with DataFrame functions only.

Base patterns find assignments, access keys and long hex runs. The method adds spans of high entropy: candidate strings of
a character class are read by a sliding window whose character counts change by the one character that enters and the one
that leaves, and with them the sum of c * log2(c) from which the window's Shannon entropy follows. Candidates on the allow-list add nothing.

Offsets are code points, ends are exclusive. A regular expression gives no offsets in Spark; they follow from the lengths
of the matches and of the texts between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in their fixed order: pattern, group whose length counts, least length.
BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


class CharacterClass(NamedTuple):
    """Candidates of one alphabet, the window and the least entropy in bits per character."""

    kind: str
    candidate: str
    alphabet: str
    window: int
    limit: float
    needs: tuple[str, ...]


_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", r"(?<![A-Za-z0-9+/_-])[0-9a-fA-F]{16,}+(?![A-Za-z0-9+/_-])", _DIGITS + "abcdefABCDEF", 16, 2.9, (r"[0-9]", r"[a-fA-F]")),
    CharacterClass(
        "entropy_base64",
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
        _LOWER.upper() + _LOWER + _DIGITS + "+/_-",
        20,
        3.6,
        (r"[0-9]", r"[a-z]", r"[A-Z]"),
    ),
)
#: Strings that look random but are none: UUIDs, dotted or slashed paths of words, digests of well-known empty inputs, samples.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z]+[/_-])+[A-Za-z]+/?$",
    r"(?i)example|sample|placeholder|xxxx|0123456789|abcdefgh",
    r"^(?i)(d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709)$",
)
_BLOCK = 256


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _starts(lengths: Column) -> Column:
    """Running sums before each element, by blocks so that a text with very many matches stays cheap."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
        lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    return F.transform(
        lengths,
        lambda _, i: _sum(F.slice(blocks, F.lit(1), F.floor(i / _BLOCK).cast("int")))
        + _sum(F.slice(lengths, (F.floor(i / _BLOCK) * _BLOCK).cast("int") + 1, i % _BLOCK)),
    )


def _matches(df: DataFrame, text: str, pattern: str, out: str, group: int = 0) -> DataFrame:
    """Adds ``out``: leftmost non-overlapping matches as array of (start, end, found, part)."""
    found, parts, lengths = f"{out}_found", f"{out}_parts", f"{out}_lengths"
    columns = df.columns
    df = df.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    between = F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(found))
    some = F.size(found) > 0
    df = df.withColumn(
        lengths,
        F.when(some, F.zip_with(between, F.col(found), lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("own")))),
    )
    df = df.withColumn(parts, F.when(some, _starts(F.transform(lengths, lambda x: x["gap"] + x["own"]))))
    group_text = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)) if group else F.col(found)
    rows = F.zip_with(
        F.arrays_zip(F.col(found).alias("found"), F.col(lengths).alias("l"), F.col(parts).alias("at")),
        group_text,
        lambda m, g: F.struct(
            (m["at"] + m["l"]["gap"]).alias("start"),
            (m["at"] + m["l"]["gap"] + m["l"]["own"]).alias("end"),
            m["found"].alias("found"),
            g.alias("part"),
        ),
    )
    return df.select(*columns, F.when(some, rows).alias(out))


def _spans(matches: str, least: int, number: int, kind: str) -> Column:
    span = lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind"))
    return F.coalesce(F.transform(F.filter(F.col(matches), lambda m: F.length(m["part"]) >= least), span), F.array().cast(SPANS))


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def _random_parts(candidate: Column, kind: CharacterClass) -> Column:
    """Joined windows of the candidate whose entropy reaches the limit: array of (start, end) within it."""
    w, letters = kind.window, len(kind.alphabet)
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)])
    most = w * (math.log2(w) - kind.limit) + 1e-9  # entropy >= limit where the sum of c log2 c is at most this
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, i: Column) -> Column:
        """Character i enters, character i - w leaves."""
        entering = F.get(state["codes"], i)
        leaving = F.when(i >= w, F.get(state["codes"], i - w)).otherwise(F.lit(-1))
        n_in = F.get(state["counts"], entering)
        added = F.get(weight, n_in + 1) - F.get(weight, n_in)
        n_out = F.get(state["counts"], leaving) + F.when(leaving == entering, 1).otherwise(0)
        removed = F.when(leaving >= 0, F.get(weight, n_out) - F.get(weight, n_out - 1)).otherwise(F.lit(0.0))
        counts = F.transform(
            state["counts"], lambda c, k: c + F.when(k == entering, 1).otherwise(0) - F.when(k == leaving, 1).otherwise(0)
        )
        total = state["total"] + added - removed
        first = i - (w - 1)
        random = (first >= 0) & (total <= most)
        joins = F.try_element_at(state["out"], F.lit(-1))["end"] >= first
        last = F.try_element_at(state["out"], F.lit(-1))
        grown = F.when(
            joins,
            F.concat(
                F.slice(state["out"], F.lit(1), F.size(state["out"]) - 1),
                F.array(F.struct(last["start"].alias("start"), (i + 1).alias("end"))),
            ),
        ).otherwise(F.concat(state["out"], F.array(F.struct(first.alias("start"), (i + 1).alias("end")))))
        return F.struct(
            state["codes"].alias("codes"),
            counts.alias("counts"),
            total.alias("total"),
            F.when(random, grown).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), letters).alias("counts"),
        F.lit(0.0).alias("total"),
        empty.alias("out"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.length(candidate) - 1), start, step, lambda s: s["out"])


def _wanted(kind: CharacterClass) -> Callable[[Column], Column]:
    """Whether a candidate has the characters that the class asks for and is on no allow-list."""

    def keep(m: Column) -> Column:
        tests = [m["found"].rlike(p) for p in kind.needs] + [~m["found"].rlike(p) for p in ALLOWED]
        return reduce(and_, tests)

    return keep


def _shifted(kind: CharacterClass, number: int) -> Callable[[Column], Column]:
    """Random parts of a candidate as spans of the text."""

    def spans(m: Column) -> Column:
        return F.transform(
            _random_parts(m["found"], kind),
            lambda p: F.struct(
                (m["start"] + p["start"]).alias("start"),
                F.lit(number).alias("order"),
                (m["start"] + p["end"]).alias("end"),
                F.lit(kind.kind).alias("kind"),
            ),
        )

    return spans


def secret_spans(df: DataFrame, *, text: str = "text", spans: str = "secrets") -> DataFrame:
    """Adds ``spans``: array of (start, order, end, kind), sorted by start, then kind as listed here, then end.

    The kinds are assign, access and hex (whole matches, leftmost and non-overlapping per kind, too short ones dropped after
    matching) and entropy_hex, entropy_base64. A null or empty text has none. Spans of different kinds may overlap. Equal
    rows get equal spans, an empty table gives an empty one, a column named ``spans`` is replaced and the others stay.
    """
    kept = [c for c in df.columns if c.lower() != spans.lower()]
    renamed = [f"c{i}" for i in range(len(kept))]
    work = df.select(*[F.col(f"`{c}`").alias(r) for c, r in zip(kept, renamed)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("scanned"))
    base = renamed + ["scanned"]
    lists = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        work = _matches(work, "scanned", pattern, f"m_{kind}", group)
        lists.append(_spans(f"m_{kind}", least, number, kind))
    for number, kind in enumerate(CLASSES, len(BASE)):
        out = f"m_{kind.kind}"
        work = _matches(work, "scanned", kind.candidate, out)

        lists.append(F.coalesce(F.flatten(F.transform(F.filter(F.col(out), _wanted(kind)), _shifted(kind, number))), F.array().cast(SPANS)))
    ordered = F.array_sort(F.concat(*lists))
    return work.select(*[F.col(r).alias(c) for r, c in zip(renamed, kept)], ordered.alias(spans))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones joined) replaced by ``mark``; null stays null."""
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("cut"), F.array().cast("array<struct<start:int,end:int>>").alias("gaps"))

    def step(state: Column, s: Column) -> Column:
        gap = F.array(F.struct(state["at"].alias("start"), s["start"].alias("end")))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.lit(0).alias("cut"),
            F.when((s["start"] > state["at"]) | (F.size(state["gaps"]) == 0), F.concat(state["gaps"], gap)).otherwise(state["gaps"]).alias("gaps"),
        )

    gaps = F.aggregate(spans, begin, step, lambda s: F.concat(s["gaps"], F.array(F.struct(s["at"].alias("start"), F.length(text).alias("end")))))
    pieces = F.transform(gaps, lambda g: F.substring(text, g["start"] + 1, g["end"] - g["start"]))
    return F.when(F.size(spans) > 0, F.array_join(pieces, mark)).otherwise(text)
