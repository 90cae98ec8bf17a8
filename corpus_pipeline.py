"""The corpus pipeline: from raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on; the last returns one row per document with its ids.
``run`` writes each stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import language, mixing, pieces, secrets, setjoin
from ratelens.llm.frames import free_name, written
from ratelens.llm.queries import PIECE_MODEL
from ratelens.session import configure

#: Below this score a text reads like none of the languages: Japanese scores 0.12 to 0.15, the least of a real document is 0.31.
LEAST_SCORE = 0.25
#: Shares of the words that good, poor and toxic documents shall have.
TARGETS = {"good": 0.97, "poor": 0.03, "toxic": 0.0}
#: Documents that are good with this chance or a higher one stay, once.
SURELY_GOOD = 0.9


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a known language stay: null texts, texts without a letter and scores below ``LEAST_SCORE`` go."""
    model = language.fit_language_model(docs)
    found, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    read = language.identify(docs, model, language=found, score=score)
    return read.filter((F.col(found) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 on shingles of five words the smallest id stays."""
    return setjoin.one_of_each(docs, size=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` is counted anew."""
    spans = free_name(docs, "secrets")
    clean = secrets.secret_spans(docs, spans=spans).withColumn("text", secrets.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents stay, once each; poor and toxic ones are drawn by their rates, at most once each."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels, targets=TARGETS, once=SURELY_GOOD)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids; the ids decode to the text again."""
    coded = pieces.piece_encode(docs.select("doc_id", "lang", "source", "text"), PIECE_MODEL, decoded="decoded")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("same_text")
    )


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("secret_scans", secret_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", token_stage),
]
ORACLE_SQL = None  # language models, near copies and tokens cannot be written in SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
