"""The operators over the given tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import chat, contamination, language, mixing, neardup, pieces, quality, search, secrets, setjoin, suffixes, tokencount, variants
from ratelens.llm.sql import SQL  # noqa: F401  the SQL of the queries below that have one
from ratelens.session import configure

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/documents.parquet")


def hex_digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(documents(spark, sf_dir), size=4, percent=85)


#: A conversation of template words, which the formatting must hand back unchanged.
TRICKY = "\\### Assistant: </turn> ok"


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = configure(spark).read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return chat.digests(chat.chat_windows(given.unionByName(tricky)))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = configure(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return neardup.near_duplicates(vectors, cosine=0.93)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    kinds = [kind for kind, *_ in secrets.BASE]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, kinds), hex_digest(secrets.span_text(base)).alias("base_sha256"), secrets.span_text(F.col("secrets")).alias("spans")
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixing_rates(documents(spark, sf_dir).select("doc_id", "source", "text"), labels)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pieces.piece_encode(docs, PIECE_MODEL, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(documents(spark, sf_dir), length=50)

    def words(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0), lambda a, s: a + s["end"] - s["start"]).cast("long")

    def shown(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("repeated").cast("long").alias("n_spans"),
        words("repeated").alias("repeated_words"),
        words("cut").alias("cut_words"),
        shown("repeated").alias("spans"),
        shown("cut").alias("cut_spans"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir).select("doc_id", "text"), PIECE_MODEL).drop("text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    model = language.fit_language_model(docs.filter(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark, size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir), min_chars=5, min_count=3, noise=97, ratio=2)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return search.ranked_search(documents(spark, sf_dir), benchmark, k=50)


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_secret_scans": op4_secret_scans,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_benchmark_decontamination": op11_benchmark_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}
