import math
import random
import re
from collections import Counter

import pytest

from ratelens.llm import search
from ratelens.llm.search import ranked_search, term_counts

UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(bags), sum(c.total() for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in wanted.items():
        found = []
        for d, c in bags:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        rows += [(item, i, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=str)


def corpus():
    rnd = random.Random(13)
    vocabulary = [f"w{i}" for i in range(80)] + ["The", "été", "Über", "x9", "İ"]
    docs = []
    for i in range(300):
        body = rnd.choices(vocabulary, k=rnd.choice((0, 2, 9, 40)))
        docs.append((i * 7 % 311, rnd.choice((" ", "\n", ", ")).join(body)))
    docs += [(1000 + i, docs[5][1]) for i in range(90)]  # copies, more than k
    docs += [(2000 - i, "w1 w2 other" + " w3" * (i % 2)) for i in range(80)]
    docs += [(3, docs[9][1]), (3, docs[9][1]), (None, docs[9][1]), (None, docs[5][1]), (None, None), (4, None), (5, ""), (6, "...")]
    docs.append((9000, "w5 " * 40000 + "rare " + "filler " * 300000))
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice((1, 5, 30))))) for i in range(25)]
    items += [(None, "w1 W1 rare"), (30, None), (31, ""), (32, "nowhere"), (33, "w2"), (33, "w7")]
    return docs, items


@pytest.mark.parametrize(("k", "block"), [(50, 200_000), (3, 60), (1, 200_000)])
def test_equals_brute_force(spark, monkeypatch, k, block):
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, rank int, item string").repartition(5)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = ranked_search(df, bench, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def test_small_steps_give_the_same(monkeypatch):
    text = "The café w1 w1 İ 9z " * 50
    whole = term_counts(text.encode())
    monkeypatch.setattr(search, "SLICE", 7)
    assert term_counts(text.encode()) == whole == Counter(t.encode() for t in terms(text))
    rng = search.np.random.default_rng(1)
    scores = rng.integers(1, 9, (40, 3))
    best = search.Best(3, 5)
    for at in range(0, 40, 8):
        rows, items = search.np.nonzero(scores[at : at + 8] >= best.least)
        best.add(items, scores[at + rows, items], at + rows)
    want = [(i, s, d) for i in range(3) for s, d in sorted(((int(scores[d, i]), d) for d in range(40)), key=lambda x: (-x[0], x[1]))[:5]]
    assert list(zip(best.item.tolist(), best.score.tolist(), best.doc.tolist())) == want


def test_string_items_and_empty_tables(spark):
    docs, _ = corpus()
    df = spark.createDataFrame(docs[:60], "doc_id int, text string")
    bench = spark.createDataFrame([("a", "w1 w2"), ("b", "été")], "item_id string, text string")
    assert sorted((tuple(r) for r in ranked_search(df, bench).collect()), key=str) == brute(docs[:60], [("a", "w1 w2"), ("b", "été")])
    assert ranked_search(df.limit(0), bench).count() == 0 and ranked_search(df, bench.limit(0)).count() == 0
    assert ranked_search(df, bench.limit(0)).dtypes == ranked_search(df, bench).dtypes
