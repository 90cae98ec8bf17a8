import pytest
from pyspark.sql import functions as F

from ratelens.llm import language
from ratelens.llm.language import UNKNOWN, fit_language_model, identify
from ratelens.llm.queries import op10_language_id

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return fit_language_model(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_held_out_accuracy(spark):
    rows = op10_language_id(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out AND lang_pred <> 'und'").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert rows.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_only_the_training_part_is_read(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).write.parquet(str(tmp_path / "documents.parquet"))
    mine, theirs = ({r.doc_id: tuple(r) for r in op10_language_id(spark, f).collect()} for f in (str(tmp_path), FOLDER))
    assert mine == theirs


def test_unknown_texts_whole_texts_and_clashing_columns(spark, model):
    german = "und die der ung ein nicht zu auch ich den heit keit " * 30
    rows = [(1, None, 0), (2, "", 0), (3, "123 !? \n", 0), (4, "日本語", 0), (5, "Der Ä", 0), (6, german, 0), (7, german, 0)]
    got = {r["id"]: r for r in identify(spark.createDataFrame(rows, "id long, text string, SCORE int"), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == [UNKNOWN] * 3 and got[1]["score"] == 0
    assert got[4]["lang_pred"] in model.languages  # it has letters
    assert got[6]["lang_pred"] == "de" and got[6]["score"] == got[7]["score"]
    flooded = german + " the of and to in that which was with for thing " * 3000
    late = spark.createDataFrame([(1, flooded)], "id long, text string")
    assert identify(late, model).first()["lang_pred"] == "en"  # the whole text decides, not its start


def test_no_labels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "ein text", None), (None, None, "de")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in identify(df, fit_language_model(df)).collect()] == [UNKNOWN] * 2
    empty = df.limit(0)
    assert identify(empty, fit_language_model(empty)).count() == 0


def test_the_sample_is_bounded_in_rows_and_skips_null_texts(spark):
    rows = [(7, f"one id with many texts {i}", "en") for i in range(3000)] + [(i, "the of and to in " * 9, "en") for i in range(100, 160)]
    rows += [(i, None, "en") for i in range(1000, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = language.training_rows(df, text="text", lang="lang", doc_id="doc_id", bound=240)
    assert len(found) == 61

