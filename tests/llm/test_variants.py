import random
import re
import zlib
from collections import Counter

import pytest

from ratelens.llm import variants
from ratelens.llm.variants import Block, spelling_groups, spelling_variants, word_counts

UPPER = {c: c + 32 for c in range(65, 91)}


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i:] for i in range(len(word) + 1)}
    return out - {word}


def brute(counts, ratio=2):
    letters = set("".join(counts))
    near = {w: [v for v in edits(w, letters) if v in counts] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def brute_counts(docs, noise=97):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def vocabulary(seed=3, size=1500):
    rnd = random.Random(seed)
    words = set()
    for alphabet, lengths in (("ab", (5, 6, 7, 8, 9)), ("abcdeé÷", (5, 6, 7)), ("xyzÀ", (5, 8, 12))):
        words |= {"".join(rnd.choices(alphabet, k=rnd.choice(lengths))) for _ in range(size // 3)}
    base = "".join(rnd.choices("abc", k=300))
    words |= {base, base[:90] + base[91:], base[:-1] + "q", "q" + base, base + "cc"}
    return {w: rnd.choice((3, 3, 4, 6, 7, 12, 40, 100)) for w in sorted(words)}


@pytest.mark.parametrize(("segments", "block"), [(1, 8192), (2, 8192), (3, 8192), (3, 5), (4, 8192)])
def test_groups_equal_brute_force(spark, monkeypatch, segments, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    counts = vocabulary()
    if segments != variants.SEGMENTS:  # a worker has the module's own number, so other ones are tried on the index itself
        monkeypatch.setattr(variants, "SEGMENTS", segments)
        got = {w: 0 for w in counts}
        buckets = {}
        for w, n in counts.items():
            for size in {len(w), len(w) - 1} - {4}:
                for s in range(segments):
                    a, b = size * s // segments, size * (s + 1) // segments + len(w) - size
                    buckets.setdefault((size, s, w[:a], w[b:]), []).append((-n, w))
        for (size, s, *_), words in buckets.items():
            index = Block(sorted(words), size, s)
            for _, w in words:
                got[w] += index.near(w).bit_count()
        assert got == {r[0]: r[4] for r in brute(counts)}
        return
    rows = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = sorted(tuple(r) for r in spelling_groups(rows).select("word", "form", "root", "n", "n_near", "form_n").collect())
    want = brute(counts)
    assert got == want
    assert any(r[2] not in (r[0], r[1]) for r in want)  # chains of forms are there


def corpus():
    rnd = random.Random(5)
    stems = ["garden", "gardens", "gardén", "window", "windows", "widow", "ÉCOLE", "école", "cole", "aaaaa", "aaaaaa", "ab÷cd", "Garden"]
    docs = []
    for i in range(300):
        text = rnd.choice((" ", "\n", "-1 ")).join(rnd.choices(stems, k=rnd.choice((0, 3, 60))))
        docs.append((i, text))
    long = " ".join(rnd.choices(stems + ["".join(rnd.choices("abc", k=5)) for _ in range(60)], k=40000))
    return docs + [(900, long), (901, None), (902, ""), (None, docs[3][1]), (None, None), (3, docs[3][1]), (3, docs[4][1]), (903, "z" * 100_000 + " " + "z" * 100_000 + "," + "z" * 100_000)]


@pytest.mark.parametrize("noise", [97, 5, None])
def test_counts_and_variants_equal_brute_force(spark, noise):
    docs = corpus()
    df = spark.createDataFrame([(d, t, "x", 4) for d, t in docs], "doc_id long, text string, word string, n int").repartition(5)
    want = brute_counts(docs, noise)
    assert {r["word"]: r["n"] for r in word_counts(df, noise=noise).collect()} == want
    got = sorted(tuple(r) for r in spelling_variants(df, noise=noise).select("word", "form", "root", "n", "n_near", "form_n").collect())
    short = lambda rows: [r for r in rows if len(r[0]) < 99_000]  # noqa: E731  the plain version takes too long for the others
    assert short(got) == brute({w: n for w, n in want.items() if len(w) < 99_000})
    assert sorted((r[0], r[3]) for r in got) == sorted(want.items())


def test_ties_and_long_chains(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "baaaa": 6, "ccccc": 5}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r for r in spelling_groups(rows).collect()}
    assert got["aaaaa"]["form"] == "aaaab" and got["aaaaa"]["root"] == "bbbbb" and got["ccccc"]["root"] == "ccccc" and got["ccccc"]["n_near"] == 0
    with pytest.raises(ValueError):
        spelling_groups(rows, ratio=1)


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert spelling_variants(df).count() == 0 and spelling_variants(df.limit(0)).count() == 0
