import math
import random
import re
from itertools import combinations

import numpy as np
import pytest

from ratelens.llm import setjoin
from ratelens.llm.components import components
from ratelens.llm.setjoin import allocation, bands, jaccard_components, most_different, spaces_of


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = words_of(text)
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "Ünï", "x.y"]
    passage = rnd.choices(vocabulary, k=40)
    rows = []
    for _ in range(60):
        base = rnd.choices(vocabulary, k=rnd.choice((1, 2, 3, 5, 8, 12, 30, 60, 120, 300)))
        if rnd.random() < 0.4:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        rows.append(base)
        for _ in range(rnd.choice((0, 0, 1, 2, 6))):
            copy = list(rnd.choice(rows[-3:]))
            for _ in range(max(1, int(len(copy) * rnd.choice((0, 0.005, 0.02, 0.05, 0.1))))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(copy)
    rows += [passage + rnd.choices(vocabulary, k=rnd.randint(0, 8)) for _ in range(40)]
    texts = [(" " if rnd.random() < 0.8 else "\n\t ").join(w).replace("w1", "W1", rnd.randint(0, 2)) for w in rows]
    texts += texts[:5] + [None, "", " \n ", "a", "A", "a b", "b a"]
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("size, percent, hot", [(4, 85, 8192), (5, 80, 8192), (2, 60, 8192), (3, 80, 0)])
def test_equals_brute_force(spark, monkeypatch, size, percent, hot):
    monkeypatch.setattr(setjoin, "HOT", hot)
    monkeypatch.setattr(setjoin, "HOT_IN_SLICE", 4)
    monkeypatch.setattr(setjoin, "TILE", 5)
    rows = corpus(size * 100 + percent)
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, name string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df, size=size, percent=percent).collect()}
    assert got == brute(rows, size, percent)
    assert len({c for _, c in got.values()}) < len(rows) - 20


def test_bands_reach_every_linked_size():
    for percent in (60, 80, 85):
        lows = bands(percent)
        for small in list(range(1, 300)) + [999, 5000]:
            space = spaces_of(small, percent)[0]
            for large in range(small, small * 100 // percent + 1):
                assert space in spaces_of(large, percent)
                assert most_different(small + large, percent) < allocation(space, percent).segments
        assert np.all(np.diff(lows) > 0)


def test_repeated_rows_null_ids_clashing_columns_and_empty_table(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 0), (None, "a b c d e f", 0), (None, "z", 0), (3, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_components(df).collect()), key=str)
    assert got == [(1, 1), (1, 1), (3, 3), (None, 1), (None, None)]
    assert jaccard_components(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3), (61, 59), (None, 4)]
    rnd = random.Random(1)
    rnd.shuffle(links)
    got = dict(components(spark.createDataFrame(links, "x long, y long")).collect())
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [*range(7, 60), 61]}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_lower_bound_never_exceeds_the_difference():
    rnd = np.random.default_rng(3)
    for n in (3, 40, 300):
        a = np.sort(rnd.integers(0, 2**64, n, dtype=np.uint64))
        keep = rnd.random(n) < 0.9
        b = np.unique(np.concatenate((a[keep], rnd.integers(0, 2**64, n - keep.sum(), dtype=np.uint64))))
        x, y = (np.frombuffer(setjoin.sketch(s), dtype="<u2") for s in (a, b))
        assert setjoin.least_difference(x, y[None, :])[0] <= len(np.setxor1d(a, b))


def test_sketches_part_loose_relatives_and_large_sets():
    rnd = np.random.default_rng(5)

    def bound(a, b, groups):
        x, y = (np.frombuffer(setjoin.sketch(np.sort(s), groups), dtype="<u2") for s in (a, b))
        least = setjoin.least_difference(x, y[None, :])[0]
        assert least <= len(np.setxor1d(a, b))
        return least > most_different(len(a) + len(b), 80)

    base = rnd.integers(0, 2**64, 400, dtype=np.uint64)  # two copies of it share 70 per cent of their tokens or less
    copies = [np.concatenate((rnd.permutation(base)[:365], rnd.integers(0, 2**64, 35, dtype=np.uint64))) for _ in range(40)]
    assert np.mean([bound(a, b, setjoin.GROUPS) for a, b in combinations(copies, 2) if len(np.intersect1d(a, b)) <= 335]) > 0.9
    for n in (1500, 3000, 6000):
        groups = setjoin.groups_of(spaces_of(n, 80)[0], 80)
        sets = [rnd.integers(0, 2**64, n, dtype=np.uint64) for _ in range(8)]
        assert groups * 2 <= 1024 and all(bound(a, b, groups) for a, b in combinations(sets, 2))


def family(seed, copies):
    """Short near copies of one text, two words apart at most, in one slice."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(30)]
    rows = []
    for i in range(copies):
        copy = list(base)
        for _ in range(rnd.choice((1, 1, 2))):
            copy[rnd.choice((0, 1, 28, 29, rnd.randrange(30)))] = f"n{rnd.randrange(20)}"
        rows.append(" ".join(copy))
    return list(enumerate(dict.fromkeys(rows), 1))


def shared_keys(spark, rows, size, percent):
    """The table of shared keys, and the documents, of one task."""
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    part_ids = setjoin._part_ids(spark)
    return docs, setjoin._shared(setjoin._keys(docs.select("text"), size, percent, part_ids), len(part_ids)), part_ids


def test_salted_keys_keep_their_identity(spark):
    rows = family(4, 200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    try:
        _, shared, _ = shared_keys(spark, rows, 5, 80)
        got = {}
        for r in shared.collect():
            got.setdefault(r["key"], set()).add((r["name"], r["deletion"]))
        want = {}
        for _, text in rows:
            tokens = setjoin.shingle_set(text.encode(), 5)
            for key, tag in zip(*setjoin.signature_rows(tokens, 80)):
                want.setdefault(int(key), set()).add((setjoin.set_hash(tokens), bool(tag & 2)))
        want = sorted(sorted(v) for v in want.values() if len(v) > 1)
        assert max(map(len, want)) > 100
        assert sorted(sorted(v) for v in got.values()) == want
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == brute(rows, 5, 80)


@pytest.mark.parametrize("hot", [0, 8192])
def test_hot_keys_find_every_link_without_leaders(spark, monkeypatch, hot):
    monkeypatch.setattr(setjoin, "HOT", hot)
    rows = family(5, 60) + [(i + 1000, f"{t} tail") for i, t in family(6, 60)]
    docs, shared, part_ids = shared_keys(spark, rows, 5, 80)
    sets = {setjoin.set_hash(s): set(s.tolist()) for s in (setjoin.shingle_set(t.encode(), 5) for _, t in rows)}
    tokens = setjoin._token_table(docs, setjoin._sized(docs, 5), shared.select("name").distinct(), 5)
    met = setjoin._crossing(shared, spark.createDataFrame([], "node long, root long"), tokens, 80, part_ids)
    got = {(r["a"], r["b"]) for r in setjoin._verified(met, tokens, 80).collect()}
    want = {(min(a, b), max(a, b)) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(want) > 100 and got == want


@pytest.mark.parametrize("probing", [True, False])
def test_tiles_cover_all_needed_pairs_and_deal_a_family_once(spark, monkeypatch, probing):
    monkeypatch.setattr(setjoin, "TILE", 16)
    rnd = random.Random(9)
    rows = [(1, i, 0, 500, False, probing) for i in range(600)]  # one family
    rows += [(1, 1000 + i, 0, 1000 + i, False, True) for i in range(20)]  # loose relatives
    rows += [(2, i, 0, rnd.randrange(4), False, rnd.random() < 0.3) for i in range(90)]
    rows += [(3, i, 0, i, False, True) for i in range(5)] + [(4, i, 0, 9, False, True) for i in range(50)]
    df = spark.createDataFrame(rows, "key long, name long, tag int, root long, deletion boolean, probe boolean")
    dealt = setjoin._dealt(df).collect()
    root, probe = ({(r[0], r[1]): r[i] for r in rows} for i in (3, 5))
    tiles, met = {}, set()
    for r in dealt:
        x, y = tiles.setdefault((r["key"], r["x"], r["y"]), (set(), set()))
        if r["in_x"]:
            x.add(r["name"])
        if r["in_y"]:
            y.add(r["name"])
    for (key, *_), (x, y) in tiles.items():
        met |= {(key, min(a, b), max(a, b)) for a in x for b in y}
    for k in (1, 2, 3):
        names = sorted(r[1] for r in rows if r[0] == k)
        needed = {(k, a, b) for a, b in combinations(names, 2) if root[k, a] != root[k, b] and (probe[k, a] or probe[k, b])}
        assert needed <= met
    assert sum(r["key"] == 1 for r in dealt) < 600 * 2 + 20 * 50
    assert not [r for r in dealt if r["key"] == 4]


def test_allocation_of_very_long_texts():
    for size in (10_000, 800_000, 1_500_000, 20_000_000):
        space = spaces_of(size, 80)[0]
        setjoin.allocation.cache_clear()
        plan = allocation(space, 80)
        low = int(bands(80)[space])
        empty = plan.segments * math.exp(-low / plan.segments)
        assert plan.reserve == plan.spare + 1
        # nearly all sets make do with the deletions of the reserve, which is far from all segments
        assert empty < plan.spare < empty + 12 * math.sqrt(empty) + 30 < plan.segments / 2


def test_a_text_of_very_many_words(spark):
    rnd = random.Random(12)
    words = [f"{rnd.random():.7f}" for _ in range(200_000)]
    other = words[:]
    for i in range(0, 200_000, 100):
        other[i] = "x"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:150_000])), (4, " ".join(words[100:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()} == brute(rows, 5, 80)
