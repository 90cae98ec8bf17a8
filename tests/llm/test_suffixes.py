import random

import pytest

from ratelens.llm import suffixes
from ratelens.llm.suffixes import merged, repeated_passages


def brute(rows, length):
    words = {i: (t or "").split() for i, t in rows}
    seen = {}
    for i, w in words.items():
        for p in range(len(w) - length + 1):
            seen.setdefault(tuple(w[p : p + length]), set()).add(i)
    out = {}
    for i, w in words.items():
        every, cut = [], []
        for p in range(len(w) - length + 1):
            owners = seen[tuple(w[p : p + length])]
            if len(owners) > 1:
                every.append((p, p + length))
                if min(owners) < i:
                    cut.append((p, p + length))
        out[i] = (merged(every), merged(cut))
    return out


def corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passages = [rnd.choices(vocabulary, k=n) for n in (49, 50, 51, 60, 75, 130, 400)]
    rows = []
    for _ in range(120):
        body = rnd.choices(vocabulary, k=rnd.choice((0, 3, 20, 80, 300)))
        for _ in range(rnd.choice((0, 1, 1, 2))):
            at = rnd.randint(0, len(body))
            body = body[:at] + rnd.choice(passages) + body[at:]
        rows.append(" ".join(body))
    rows += rows[:6] + [None, "", "a b", " ".join(["x"] * 90), " ".join(["x"] * 70), "\n".join(passages[6])]
    return list(enumerate(rows, 5))


@pytest.mark.parametrize("partitions", [2, 23])
def test_equals_brute_force(spark, partitions):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "n", 0) for i, t in rows], "doc_id long, text string, name string, key int").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["doc_id"]: ([tuple(s) for s in r["repeated"]], [tuple(s) for s in r["cut"]]) for r in repeated_passages(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(rows, suffixes.LENGTH)
    assert len(got) == len(rows)
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert {i: v[1] for i, v in got.items()} == {i: v[1] for i, v in want.items()}


def test_hot_passage_over_many_tasks(spark):
    rnd = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"{' '.join(f'{rnd.random():.9f}' for _ in range(9))} {passage} t{i}") for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert {tuple(map(tuple, r["repeated"])) for r in got} == {((9, 64),)}
    assert all([tuple(s) for s in r["cut"]] == ([(9, 64)] if r["doc_id"] else []) for r in got)


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(str(i) for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], len(r["repeated"]), len(r["cut"])) for r in repeated_passages(df).collect()), key=str)
    assert got == [(1, 1, 0), (1, 1, 0), (None, 0, 0), (None, 1, 1)]
    assert repeated_passages(df.limit(0)).count() == 0


def test_every_copy_of_a_hot_passage_is_cut(spark):
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(51)]
    noise = lambda: [f"{rnd.random():.9f}" for _ in range(9)]
    rows = [(i, " ".join(noise() + passage + noise())) for i in range(600)]
    rows.append((600, " ".join(w for _ in range(30) for w in noise() + passage)))
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = brute(rows, suffixes.LENGTH)
    assert {r["doc_id"]: ([tuple(s) for s in r["repeated"]], [tuple(s) for s in r["cut"]]) for r in got} == want
    assert all(v[1] for i, v in want.items() if i)


def test_texts_of_one_id_keep_one_copy(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, f"a {passage}"), (None, f"b {passage}"), (None, f"c {passage}")]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [len(r["repeated"]) for r in got] == [1, 1, 1] and sum(len(r["cut"]) for r in got) == 2


def test_slices_change_nothing(monkeypatch):
    words = suffixes.words_of(" ".join(str(i % 97) for i in range(500)))
    whole, kept = suffixes.window_hashes(words, 50), suffixes.minimisers(words, 50, 16)
    monkeypatch.setattr(suffixes, "SLICE", 40)
    assert (suffixes.window_hashes(words, 50) == whole).all()
    assert all((a == b).all() for a, b in zip(suffixes.minimisers(words, 50, 16), kept))
    assert len(whole) == 451 and len(set(whole.tolist())) == 97 and (whole[:-97] == whole[97:]).all()


def plain_reaches(rows, words):
    """What each row shares with the best row of another name and the same key, by trying all."""

    def shares(a, b):
        n = 0
        while n < words and a[n] == b[n] and a[n]:
            n += 1
        return n

    return [max((shares(side, s) for k, s, m in rows if k == key and m != name), default=-1) for key, side, name in rows]


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_reaches_across_borders_equal_brute_force(spark, partitions):
    rnd = random.Random(partitions)
    rows = set()
    for key in range(4):
        for _ in range(120):
            rows.add((key, tuple(rnd.choice((1, 2)) for _ in range(rnd.choice((2, 6)))), rnd.choice((1, 1, 1, 1, 2, 3))))
    rows |= {(9, tuple(rnd.choice((1, 2)) for _ in range(6)), 5) for _ in range(60)} | {(9, (3,), 6)}  # one name over whole tasks
    rows = sorted((k, (s + (0,) * 6)[:6], n) for k, s, n in rows)
    data = [(k, b"".join(w.to_bytes(4, "big") for w in s), n, [i]) for i, (k, s, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "key long, right binary, name long, at array<int>")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["at"][0]: r["reach"] for r in suffixes._reaches(df, "right", 22, 16).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [got[i] for i in range(len(rows))] == plain_reaches(rows, 6)


def test_many_texts_without_ids(spark):
    rnd = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, f"{rnd.random()} {passage} {rnd.random()}") for _ in range(200)] + [(7, f"x {passage}")]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert [len(r["repeated"]) for r in got] == [1] * 201
    assert {len(r["cut"]) for r in got if r["doc_id"] == 7} == {0} and sum(len(r["cut"]) for r in got) == 200
