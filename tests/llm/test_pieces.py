import os
import random
import sys

import pytest
import sentencepiece

from ratelens.llm import pieces
from ratelens.llm.pieces import PieceEncoder, piece_decode, piece_encode
from ratelens.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="needs the public vocabulary")
TEXTS = [
    None, "", " ", "\n", "\n\n x", "  two  blanks ", "a\n b \n", "<s> </s> <unk> <0x41>", "▁▁ marks▁", "\x00\x01 control",
    "é日本語😀́", "a" * 3000, " " * 50 + "x", "tab\there\r\n", "Ünïcode " * 40, "|!! ##$% 1234567890" * 5,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_ids_and_round_trip_equal_the_library(spark, library):
    given = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + TEXTS
    df = spark.createDataFrame([(i, t, "keep", [1]) for i, t in enumerate(given)], "doc_id long, text string, decoded string, IDS array<int>")
    out = piece_encode(df.repartition(4), PIECE_MODEL, decoded="decoded")
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for row in out.collect():
        want = library.encode(row["text"] or "", add_eos=True)
        assert row["ids"] == want and row["decoded"] == library.decode(want)
    again = piece_decode(out.drop("decoded"), PIECE_MODEL).collect()
    assert {r["doc_id"]: r["decoded"] for r in again} == {r["doc_id"]: r["decoded"] for r in out.collect()}


def test_random_texts_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 20)
    encoder, rnd = PieceEncoder(PIECE_MODEL), random.Random(7)
    for _ in range(500):
        text = "".join(rnd.choice("aaetinos  \n▁éß日.!0") for _ in range(rnd.randint(1, 80)))
        assert encoder.encode(text) == library.encode(text, add_eos=True)
    encoder.check()


def test_a_wrong_merge_is_noticed(monkeypatch):
    encoder = PieceEncoder(PIECE_MODEL)
    monkeypatch.setattr(encoder, "merge", lambda chunk: [5])
    encoder.encode("hello world")
    with pytest.raises(ValueError, match="other ids"):
        encoder.check()


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in piece_decode(df, PIECE_MODEL).collect()] == ["", ""]
    assert piece_encode(spark.createDataFrame([], "text string"), PIECE_MODEL).count() == 0


def test_kept_chunks_leave_room_beside_the_heap():
    entry = sys.getsizeof(" letters") + sys.getsizeof(bytes(8)) + 3 * 24  # chunk, two ids, its place in a dictionary two thirds full
    assert 2 * pieces.KEPT_CHUNKS * entry < 110e6
