import os
import random

import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram
from tokenizers.pre_tokenizers import Metaspace

from ratelens.llm.queries import PIECE_MODEL
from ratelens.llm.tokencount import PieceCounter, token_counts, unigram_vocabulary

SMALL = [("▁", -3.0), ("a", -1.0), ("b", -1.5), ("ab", -2.5), ("aba", -3.5), ("▁a", -4.0), ("ba", -2.5), ("bab", -4.0), ("é", -2.0)]


def library(vocabulary):
    low = min(s for _, s in vocabulary)
    extra = [("<unk>", low)] + [(f"<0x{b:02X}>", low) for b in range(256)]
    tokenizer = Tokenizer(Unigram(extra + vocabulary, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = Metaspace(prepend_scheme="always", split=True)
    return tokenizer


def test_small_vocabulary_with_ties_equals_the_library():
    mine, theirs, rnd = PieceCounter(SMALL), library(SMALL), random.Random(3)
    for _ in range(2000):
        text = "".join(rnd.choice("aaabbbé  z\n😀") for _ in range(rnd.randint(1, 25)))
        assert mine.count(text)[1] == len(theirs.encode(text).ids), text


@pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="needs the public vocabulary")
def test_public_vocabulary_equals_the_library(spark):
    vocabulary = unigram_vocabulary(PIECE_MODEL)
    theirs = library(vocabulary)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [None, "", " ", "\n", "a\n\nb", "  two  blanks ", "日本語 😀 text", "x" * 3000, " ".join(["word"] * 5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for row in token_counts(df, PIECE_MODEL).collect():
        assert row["n_tokens"] == (len(theirs.encode(row["text"]).ids) if row["text"] else 0)
        assert (row["token_score"] == 0) == (not row["text"])


def test_clashing_columns_empty_table_and_empty_vocabulary(spark):
    df = spark.createDataFrame([("a", 1)], "text string, N_TOKENS int")
    assert token_counts(df, PIECE_MODEL).columns == ["text", "n_tokens", "token_score"]
    assert token_counts(df.limit(0), PIECE_MODEL).count() == 0
    assert PieceCounter([]).count("aé")[1] == 6  # the word mark has three bytes
