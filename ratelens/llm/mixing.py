"""Mixing sources to target weights by soft membership.

A classifier that learns from a labelled table gives every document a posterior over domains. A document counts in each domain with its tokens
times the posterior. Projected-gradient least squares then looks for rates, none negative, at which the expected tokens of the
domains meet their targets: all documents start at rate 1; in each step one aggregation sums the domains' tokens at the current rates,
and every document moves its rate along its posteriors against the deviations, but not below 0. The deviations are scaled by how the totals
respond to a move, and a step that brings the totals no nearer is halved. A document's rate follows from its own posterior and
the moves so far, so no table of rates is kept and only twelve numbers a step come to the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.frames import free_name, utf8, with_arrow_columns, written
from ratelens.llm.hashing import EMPTY, word_hashes

#: Domains of the labels table, in the order of the posteriors.
DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.96, "poor": 0.03, "toxic": 0.01}
WORDS = 1024
LEAST_TEXTS = 5
#: A word counts where texts of one domain hold it this many times as often as the others.
TELLING = 6.0
SHARDS = 8
_CLASSES = np.zeros(256, dtype=np.int64)  # digit, upper, lower, space, newline, punctuation, symbol, other bytes
for _i, _set in enumerate((b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b" \t\r", b"\n", b".,;:?'\"()-", b"#*$%&|<>!@{}[]/\\=+_~^`")):
    _CLASSES[list(_set)] = _i + 1


class Classifier(NamedTuple):
    """Words that count (sorted hashes), mean and spread of the other features, and weights: one column per domain."""

    words: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray


def shape_of(text: bytes, words: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Shares of kinds of characters, share of distinct words and mean length of a word."""
    kinds = np.bincount(_CLASSES[np.frombuffer(text, dtype=np.uint8)], minlength=8) / max(1, len(text))
    return np.append(np.sqrt(kinds), (len(distinct) / max(1, len(words)), len(text) / max(1, len(words)) / 10))


def features(text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, distinct hashes of the words in lower case, other features."""
    words = word_hashes(text.lower()) if text else EMPTY
    distinct = np.unique(words)
    return len(words), distinct, shape_of(text or b"", words, distinct)


def posteriors(model: Classifier, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row per text, one column per domain; each row sums to 1."""
    x = np.zeros((len(rows), model.weights.shape[0]))
    for i, (_, distinct, shape) in enumerate(rows):
        if len(model.words):
            at = np.searchsorted(model.words, distinct)
            at[at == len(model.words)] = 0
            x[i, at[model.words[at] == distinct]] = 1
        x[i, len(model.words) : -1] = (shape - model.mean) / model.spread
    x[:, -1] = 1
    scores = x @ model.weights
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def fit(sample: list[tuple[int, np.ndarray, np.ndarray]], domains: list[int], *, ridge: float = 2e-4, steps: int = 600) -> Classifier:
    """Softmax regression on the words that tell the domains apart best, and the other features."""
    k, n = len(DOMAINS), len(sample)
    shapes = np.stack([s for *_, s in sample]) if n else np.zeros((0, 10))
    mean = shapes.mean(axis=0) if n else np.zeros(10)
    spread = shapes.std(axis=0) + 1e-3 if n else np.ones(10)
    target = np.eye(k)[domains] if n else np.zeros((0, k))
    hashes = np.concatenate([d for _, d, _ in sample]) if n else EMPTY
    owner = np.repeat(np.arange(n), [len(d) for _, d, _ in sample]) if n else np.empty(0, np.int64)
    vocabulary, index, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    often = counts >= LEAST_TEXTS
    held = np.stack([np.bincount(index, target[owner, d], len(vocabulary)) for d in range(k)], axis=1)
    size = np.maximum(target.sum(axis=0), 1)
    rate = (held + 0.5) / (size + 1)
    rest = (held.sum(axis=1, keepdims=True) - held + 0.5) / (size.sum() - size + 1)
    telling = np.where(rate >= TELLING * rest, np.sqrt(rate) - np.sqrt(rest), 0)
    gain = np.where(often, telling.max(axis=1), 0)
    best = np.sort(np.argsort(-gain, kind="stable")[: min(WORDS, int((gain > 0).sum()))])
    words = vocabulary[best]
    model = Classifier(words, mean, spread, np.zeros((len(words) + len(mean) + 1, k)))
    if not n:
        return model
    x = np.zeros((n, len(words) + len(mean) + 1))
    for i, (_, distinct, shape) in enumerate(sample):
        x[i, : len(words)] = np.isin(words, distinct)
        x[i, len(words) : -1] = (shape - mean) / spread
    x[:, -1] = 1
    weight = (target / size).sum(axis=1, keepdims=True) / k  # every domain weighs the same
    weights, first, second = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        scores = x @ weights
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        slope = x.T @ (weight * (chance - target)) + ridge / 10 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights = weights - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model._replace(weights=weights)


def fit_domains(docs: DataFrame, labels: DataFrame, *, bound: int = 1200, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Classifier from a bounded sample of the labelled documents: at most ``bound`` of each domain.

    Of several texts of one id the one with the least hash counts, and null texts take no places.

    ``labels`` has doc_id, quality and toxic (0 or 1): toxic 1 is the domain toxic, else quality 1 good and 0 poor. Rows
    with a null do not count. Without rows every posterior is the same.
    """
    from pyspark.sql import Window

    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    known = labels.select(F.col("doc_id").alias("id"), domain.alias("domain"), hashed.alias("h"), F.pmod(hashed, F.lit(SHARDS)).alias("shard"))
    order = Window.partitionBy("domain", "shard").orderBy("h", "id")
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    one_text = texts.groupBy("id").agg(F.min(F.xxhash64("text")).alias("text_hash"))
    chosen = (
        known.filter("id IS NOT NULL AND domain IS NOT NULL")
        .distinct()
        .join(one_text, "id")  # only documents with a text take places
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= max(1, bound // SHARDS))
        .select("id", "domain", "text_hash")
    )
    # at most ``bound`` ids per domain
    sample = texts.withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "text_hash"]).drop("text_hash")
    added = T.StructType([T.StructField(c, T.BinaryType()) for c in ("words", "shape")] + [T.StructField("n", T.LongType())])

    def compute():
        def slice_(column: pa.Array) -> list[pa.Array]:
            rows = [features(t) for t in utf8(column)]
            return [
                pa.array([d.tobytes() for _, d, _ in rows], pa.binary()),
                pa.array([s.tobytes() for *_, s in rows], pa.binary()),
                pa.array([n for n, *_ in rows], pa.int64()),
            ]

        return slice_

    coded = with_arrow_columns(sample, ["text"], added, compute).drop("text").dropDuplicates(["id", "domain"])  # repeated rows
    found = sorted(((r["id"], r["domain"], r["n"], bytes(r["words"]), bytes(r["shape"])) for r in coded.collect()), key=lambda r: (str(r[0]), *r[1:]))
    rows = [(n, np.frombuffer(w, dtype=np.uint64), np.frombuffer(s)) for _, _, n, w, s in found]
    return fit(rows, [r[1] for r in found])


def with_posteriors(df: DataFrame, model: Classifier, *, text: str = "text", tokens: str = "tokens", prefix: str = "p_") -> DataFrame:
    """Adds the number of words and a posterior per domain to all columns of ``df``; a null text has 0 words."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most WORDS words
    added = [T.StructField(tokens, T.LongType())] + [T.StructField(prefix + d, T.DoubleType()) for d in DOMAINS]

    def compute():
        def slice_(column: pa.Array) -> list[pa.Array]:
            rows = [features(t) for t in utf8(column)]
            chances = posteriors(shared.value, rows) if rows else np.zeros((0, len(DOMAINS)))
            return [pa.array([n for n, *_ in rows], pa.int64())] + [pa.array(chances[:, d]) for d in range(len(DOMAINS))]

        return slice_

    return with_arrow_columns(df, [text], T.StructType(added), compute, rows=200)


def rate_after(moves: list[list[float]], chances: list[Column]) -> Column:
    """Rate of a document after the moves: from 1 on, each move times its posteriors off, never below 0."""
    rate = F.lit(1.0)
    if not moves:
        return rate
    steps = F.array(*[F.array(*[F.lit(float(m)) for m in move]) for move in moves])

    def step(rate: Column, move: Column) -> Column:
        off = sum((F.get(move, F.lit(d)) * chances[d] for d in range(1, len(chances))), F.get(move, F.lit(0)) * chances[0])
        return F.greatest(F.lit(0.0), rate - off)

    return F.aggregate(steps, rate, step)


class Fit(NamedTuple):
    """Moves of the steps, targets and reached tokens per domain."""

    moves: list[list[float]]
    targets: list[float]
    reached: list[float]


def fit_rates(
    members: DataFrame, targets: dict[str, float], *, keep: tuple[str, ...] = (), steps: int = 40, tolerance: float = 1e-4, prefix: str = "p_"
) -> Fit:
    """Projected-gradient steps over (tokens, posteriors) until every domain is within ``tolerance`` of its target.

    Targets are shares of the total; the total is that of the table, or, with ``keep``, the one at which the kept domain
    that is shortest of its share stays as it is, so the others give way. Domains without tokens cannot be reached.
    """
    chances = [F.col(prefix + d) for d in DOMAINS]
    k = len(DOMAINS)

    def sums(moves: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens per domain, and how they change with a move: over the documents whose rate is above 0."""
        rate = rate_after(moves, chances)
        moving = F.when(rate > 0, F.col("tokens")).otherwise(0)
        totals = [F.sum(F.col("tokens") * rate * c) for c in chances]
        slopes = [F.sum(moving * chances[i] * chances[j]) for i in range(k) for j in range(k)]
        row = [float(v or 0) for v in members.agg(*totals, *slopes).first()]
        return np.array(row[:k]), np.array(row[k:]).reshape(k, k)

    weights = np.array([targets.get(d, 0.0) for d in DOMAINS])
    weights = weights / max(weights.sum(), 1e-12)
    held, slope = sums([])
    total = held.sum()
    if keep:
        kept = [i for i, d in enumerate(DOMAINS) if d in keep and weights[i] > 0]
        total = max((held[i] / weights[i] for i in kept), default=total)
    goal = weights * total
    scale = np.maximum(held, 1e-6 * max(total, 1e-9))
    moves: list[list[float]] = []
    reached, step = held, 1.0
    for _ in range(steps):
        off = reached - goal
        if np.all(np.abs(off) <= tolerance * max(total, 1e-9)) or step < 1e-3:
            break
        move = step * np.linalg.solve(slope + 1e-6 * np.diag(scale), off)
        then, slope_then = sums([*moves, move.tolist()])
        if ((then - goal) ** 2 / scale).sum() < (off**2 / scale).sum():
            moves.append(move.tolist())
            reached, slope, step = then, slope_then, min(1.0, 2 * step)
        else:
            step /= 2
    return Fit(moves, goal.tolist(), reached.tolist())


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    *,
    targets: dict[str, float] = TARGETS,
    keep: tuple[str, ...] = ("good",),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` without the text, and tokens, p_good, p_poor, p_toxic and rate of every document.

    Expected tokens of a domain are the sum of rate * tokens * posterior. Documents with equal texts get equal rates; null and empty texts
    have no tokens and posteriors like any other. Tables without labels give equal posteriors; an empty table an empty one.
    """
    model = fit_domains(docs, labels, doc_id=doc_id, text=text)
    members = written(with_posteriors(docs, model, text=text).drop(text), "members")
    found = fit_rates(members, targets, keep=keep)
    return members.withColumn("rate", rate_after(found.moves, [F.col(f"p_{d}") for d in DOMAINS]))


def draws(rate: Column, *key: Column) -> Column:
    """Whole number of copies with the rate as its mean: the fraction is decided by a hash of the key."""
    chance = F.pmod(F.xxhash64(F.lit("draw"), *key), F.lit(1_000_003)) / 1_000_003.0
    return F.floor(rate + chance).cast("int")


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    *,
    targets: dict[str, float] = TARGETS,
    keep: tuple[str, ...] = ("good",),
    once: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says (see ``mixing_rates`` and ``draws``), with all their columns.

    With ``once`` no row comes twice, and rows whose posterior of the ``keep`` domains is that or more come exactly once: only the
    others give way, so the totals differ from the targets by what the rates of these rows differ from 1.
    """
    model = fit_domains(docs, labels, doc_id=doc_id, text=text)
    prefix, tokens = free_name(docs, "p_"), free_name(docs, "mixing_tokens")
    narrow = docs.select(F.col(f"`{text}`").alias("text"))
    found = fit_rates(written(with_posteriors(narrow, model).drop("text"), "members"), targets, keep=keep)
    members = with_posteriors(docs, model, text=text, tokens=tokens, prefix=prefix)
    rate = rate_after(found.moves, [F.col(prefix + d) for d in DOMAINS])
    copies = draws(rate, F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    if once is not None:
        kept = reduce(Column.__add__, [F.col(prefix + d) for d in keep])
        copies = F.when(kept >= once, 1).otherwise(F.least(copies, F.lit(1)))
    times = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))
    return members.select(*[f"`{c}`" for c in docs.columns], F.explode(times).alias(tokens)).drop(tokens)
