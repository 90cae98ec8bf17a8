"""Language identification with a string kernel, Nyström landmarks and one-versus-rest kernel ridge regression.

The blended-spectrum presence kernel of two texts counts the n-grams of 1 to 3 bytes (lower case, UTF-8) that both hold,
over the root of the product of their numbers of n-grams. Landmarks are some of the training texts; an n-gram counts
where a landmark holds it. With K the kernel against the landmarks and L the landmarks' own, ridge regression on
K L^(-1/2) gives one output per language; as the kernel is a product of presence rows, all texts of a slice
are scored by a matrix product with weights into which the landmarks are multiplied.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.frames import with_arrow_columns

UNKNOWN = "und"
SHARDS = 8
_LETTER = regex.compile(r"\p{L}")
_PAIRS, _TRIPLES, _ALL = 256, 256 + 65536, 256 + 65536 + 16777216


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 bytes, with repeats."""
    raw = np.frombuffer(text.lower().encode(), dtype=np.uint8).astype(np.int32)
    pairs = raw[:-1] * 256 + raw[1:]
    return np.concatenate((raw, pairs + _PAIRS, pairs[:-1] * 256 + raw[2:] + _TRIPLES))


class Model(NamedTuple):
    """Languages, the n-grams that count, and weights: one row per n-gram, one column per language.

    The weights are the product of the landmarks' presence rows and the weights of the landmarks, so that one product scores a text.
    """

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray


def training_rows(
    labelled: DataFrame, *, text: str, lang: str, doc_id: str, bound: int
) -> list[tuple[str, np.ndarray]]:
    """At most ``bound`` rows per language (``SHARDS`` times the smallest hashes of ids), as language and n-gram codes.

    Ids are ranked without their texts; ranks run per language and shard, so a common language is split. Of several texts of one id the one
    with the least hash counts, and null texts take no places.
    """
    from pyspark.sql import Window

    rows = labelled.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    hashed = F.xxhash64(F.col("id").cast("string"))
    ids = rows.groupBy("lang", "id").agg(F.min("text_hash").alias("text_hash")).withColumns({"h": hashed, "shard": F.pmod(hashed, F.lit(SHARDS))})
    order = Window.partitionBy("lang", "shard").orderBy("h", "id")
    chosen = ids.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= max(1, bound // SHARDS)).select("lang", "id", "text_hash")
    rows = rows.join(F.broadcast(chosen), ["lang", "id", "text_hash"]).select("id", "lang", "text")  # at most ``bound`` ids per language
    added = T.StructType([T.StructField("codes", T.BinaryType())])

    def compute():
        return lambda texts: [pa.array([np.unique(grams(t or "")).astype(np.int32).tobytes() for t in texts.to_pylist()], pa.binary())]

    coded = with_arrow_columns(rows, ["text"], added, compute).select("id", "lang", "codes").dropDuplicates(["id", "lang"])  # repeated rows
    found = sorted(((r["lang"], r["id"], bytes(r["codes"])) for r in coded.collect()), key=lambda r: (r[0], str(r[1]), r[2]))
    return [(language, np.frombuffer(codes, dtype=np.int32)) for language, _, codes in found]


def fit(rows: list[tuple[str, np.ndarray]], *, landmarks: int, ridge: float = 1e-3) -> Model:
    """Model of the rows; every language gives the same number of landmarks, as far as it has rows."""
    languages = sorted({language for language, _ in rows})
    if not languages:
        return Model([], np.empty(0, np.int32), np.empty((0, 0), np.float32))
    per_language = max(1, landmarks // len(languages))
    chosen = [c for l in languages for c in [c for k, c in rows if k == l and len(c)][:per_language]]
    counted = np.unique(np.concatenate(chosen)) if chosen else np.empty(0, np.int32)

    def presence(codes: np.ndarray) -> np.ndarray:
        row = np.zeros(len(counted), dtype=np.float32)
        at = np.searchsorted(counted, codes)
        at = at[at < len(counted)]
        row[at[counted[at] == codes[: len(at)]]] = 1
        return row / np.sqrt(max(1, row.sum()))

    marks = np.stack([presence(c) for c in chosen]) if chosen else np.zeros((1, len(counted)), np.float32)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    kernel = np.concatenate([np.stack([presence(c) for _, c in rows[i : i + 64]]) @ marks.T for i in range(0, len(rows), 64)])
    mapped = kernel.astype(np.float64) @ root
    target = np.array([[float(language == k) for k in languages] for language, _ in rows])
    share = target.sum(axis=0)
    balance = (target / share).sum(axis=1)[:, None]  # every language weighs the same
    gram = mapped.T @ (balance * mapped) + ridge * np.eye(mapped.shape[1])
    weights = root @ np.linalg.solve(gram, mapped.T @ (balance * target))
    return Model(languages, counted, (marks.T.astype(np.float64) @ weights).astype(np.float32))


class Scorer:
    """Presence rows and scores of whole texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.place = np.zeros(_ALL, dtype=np.int32)
        self.place[model.grams] = np.arange(1, len(model.grams) + 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language, between 0 and 1."""
        size = len(self.model.grams)
        present = np.zeros((len(texts), size + 1), dtype=np.float32)
        for i, text in enumerate(texts):
            present[i, self.place[grams(text)]] = 1
        present = present[:, 1:]
        norm = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return np.clip((present @ self.model.weights) / norm, 0, 1)


def identify(
    df: DataFrame,
    model: Model,
    *,
    text: str = "text",
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Adds the best language of every whole text and its score in 0..1; ties go to the first language in order.

    A null text or one without a letter gives ``und`` with score 0, so does a model without languages. Only the text is
    read. Equal texts get equal rows, an empty table gives an empty one; columns of these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks

    added = T.StructType([T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])

    def compute():
        scorer = Scorer(shared.value)
        languages = scorer.model.languages

        def slice_(texts: pa.Array) -> list[pa.Array]:
            values = texts.to_pylist()
            readable = [i for i, t in enumerate(values) if t and languages and _LETTER.search(t)]
            names, points = [UNKNOWN] * len(values), [0.0] * len(values)
            if readable:
                scores = scorer.scores([values[i] for i in readable])
                for i, row, best in zip(readable, scores, scores.argmax(axis=1)):
                    names[i], points[i] = languages[best], float(row[best])
            return [pa.array(names, pa.string()), pa.array(points, pa.float64())]

        return slice_

    return with_arrow_columns(df, [text], added, compute, rows=64)


def fit_language_model(
    labelled: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = 240,
    landmarks: int = 160,
) -> Model:
    """Model from a bounded sample of labelled rows: at most ``per_language`` rows of each language, ``landmarks`` in all.

    Rows with a null language or text do not count. Without any, the model knows no language.
    """
    return fit(training_rows(labelled, text=text, lang=lang, doc_id=doc_id, bound=per_language), landmarks=landmarks)
