import random
import re
from collections import Counter

import pytest
import zstandard

from ratelens.llm.quality import quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
        n < 50 or 100 * len(inside) > 50 * n,
    )


def prose(rnd, n):
    return " ".join("".join(rnd.choice(("the", "on", "er", "ti", "ha", "es", "wh", "in")) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rated(spark):
    rnd = random.Random(1)
    texts = {
        "null": None, "empty": "", "blank": " \n\t", "short": "a b", "few": "a a a a", "unicode": "é ß #\x1cx 日本|" * 9,
        "lines": "one two\none two\n\n \none two\nthree" * 12, "prose": prose(rnd, 400), "long": prose(rnd, 30000),
        "again": "This line comes again. " * 300, "random": "".join(chr(rnd.randrange(33, 0x2FFF)) + " " * (i % 5 == 0) for i in range(9000)),
        "half": prose(rnd, 2500) + " x" * 20000,
    }
    df = spark.createDataFrame([(k, t, True) for k, t in texts.items()], "doc_id string, text string, KEPT boolean").repartition(3)
    return texts, {r["doc_id"]: r for r in quality_rules(df).collect()}


def test_base_counts_equal_brute_force(rated):
    texts, rows = rated
    for name, text in texts.items():
        r = rows[name]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), name


def test_bands_reject_repetitive_and_incompressible_text(rated):
    _, rows = rated
    assert rows["prose"].kept and rows["long"].kept
    assert rows["again"].zstd_verdict == "repetitive" and not rows["again"].kept
    assert rows["half"].zstd_verdict == "repetitive" and rows["half"].n_bad_chunks > 0
    assert rows["random"].zstd_verdict == "incompressible"
    assert all(not r.kept for r in rows.values() if r.base_failed)


def plain_verdict(text):
    """The bands written out, from the whole text and 4,096-byte chunks, the last one ending with the text."""
    data = (text or "").encode()
    ratio = lambda b: len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(b)) / len(b) if b else 1.0
    n = len(data)
    low, high = next((a, b) for size, a, b in ((16384, 0.10, 0.70), (4096, 0.14, 0.70), (1024, 0.20, 0.75), (256, 0.25, 0.95), (0, 0, 9)) if n >= size)
    places = [i * 4096 for i in range(n // 4096)] + ([n - 4096] if n > 4096 and n % 4096 else [])
    found = [ratio(data[i : i + 4096]) for i in places]
    few, many = sum(r < 0.20 for r in found), sum(r > 0.59 for r in found)
    if ratio(data) < low or 5 * few > len(found):
        return len(found), few + many, "repetitive"
    return len(found), few + many, "incompressible" if ratio(data) > high or 5 * many > len(found) else "ok"


def test_verdicts_equal_plain_ones(rated):
    texts, rows = rated
    for name, text in texts.items():
        r = rows[name]
        assert (r.n_chunks, r.n_bad_chunks, r.zstd_verdict) == plain_verdict(text), name


def test_junk_in_a_part_of_a_longer_text_is_found(spark):
    rnd = random.Random(3)
    letters = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    clean = lambda n: prose(rnd, n)[:n]
    texts = {
        "45 % letters": clean(21_000) + letters(17_800), "end": clean(8000) + letters(4000), "40 % of one": clean(12_000) + "z" * 8000,
        "one chunk": clean(2000) + "z" * 3000, "clean": clean(12_000), "clean short": clean(5000),
    }
    rows = quality_rules(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()
    assert {r.doc_id: r.zstd_verdict for r in rows} == {
        "45 % letters": "incompressible", "end": "incompressible", "40 % of one": "repetitive", "one chunk": "repetitive", "clean": "ok", "clean short": "ok",
    }


def test_labelled_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    good = docs.join(labels.filter("quality = 1"), "doc_id")
    rows = quality_rules(good).filter("NOT base_failed").collect()
    assert len(rows) > 50 and all(r.kept for r in rows)


def test_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], "text string")).count() == 0
