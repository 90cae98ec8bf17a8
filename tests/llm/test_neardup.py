import numpy as np
import pytest

from ratelens.llm import neardup
from ratelens.llm.neardup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows, cosine):
    ok = [
        (i, np.array(v, dtype=np.float32).astype(float), l)
        for i, v, l, _ in rows
        if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: 0 for i, *_ in rows}
    root = {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a, l) in enumerate(ok):
        for j, b, m in ok[:n]:
            if l == m and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (links[i], find(i), find(i) == i) for i, *_ in rows}


def vectors(dims):
    rnd = np.random.default_rng(dims)
    rows = []
    for label in (1, 2, None):
        for _ in range(25):
            base = rnd.standard_normal(dims)
            for _ in range(rnd.integers(1, 5)):
                rows.append((base + rnd.standard_normal(dims) * rnd.choice([0, 0.05, 0.2, 0.27, 0.4]), label))
    near = rnd.standard_normal(dims)
    rows += [(near + rnd.standard_normal(dims) * 0.2, 7) for _ in range(60)] + [(near, 7)] * 20 + [(near * 3, 7)] * 2
    rows = [(v.astype(np.float32).tolist(), l) for v, l in rows]
    rows += [(None, 1), ([], 1), ([0.0] * dims, 1), ([float("nan")] * dims, 1), ([1.0] * (dims - 1) + [None], 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1)]
    return [(i + 3, v, l, "x") for i, (v, l) in enumerate(rows)]


@pytest.mark.parametrize("dims, chunk", [(64, 1024), (64, 7), (10, 9)])
def test_equals_brute_force(spark, monkeypatch, dims, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rows = vectors(dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    assert got == brute(rows, 0.93)
    assert max(n for n, *_ in got.values()) > 20


def test_empty_table_null_ids_and_repeated_rows(spark):
    rows = [(1, [1.0, 0.0], 1, ""), (1, [1.0, 0.0], 1, ""), (None, [1.0, 0.01], 1, ""), (None, [0.0, 1.0], 1, "")]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, False), (None, 2, 1, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [40, 400])
def test_a_vector_travels_to_few_tiles_however_many_share_its_label(spark, monkeypatch, n):
    monkeypatch.setattr(neardup, "CHUNK", 4)
    rows = [((i, 0), 1 + i % 2, 1, [float(i), 1.0]) for i in range(n)]
    classes = spark.createDataFrame(rows, "node struct<h: long, g: int>, label int, size long, vector array<float>")
    copies = [r["count"] for r in neardup._dealt(classes).groupBy("h").count().collect()]
    assert len(copies) == n and max(copies) <= neardup.PARTS


def test_a_chunk_is_cut_where_a_task_could_not_hold_it(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MOST_BYTES", 10 * 2 * 8)
    rows = [((i, 0), 1, 1, [float(i), 1.0]) for i in range(400)]
    classes = spark.createDataFrame(rows, "node struct<h: long, g: int>, label int, size long, vector array<float>")
    assert neardup._dealt(classes).groupBy("h").count().agg({"count": "max"}).first()[0] == 40


@pytest.mark.parametrize("noise", [0.02, 0.25, 3.0])
@pytest.mark.parametrize("same", [True, False])
def test_pairs_in_strips_and_runs(monkeypatch, noise, same):
    monkeypatch.setattr(neardup, "STRIP", 700)
    monkeypatch.setattr(neardup, "RUN", 50)
    rnd = np.random.default_rng(5)
    left = (rnd.standard_normal((6, 24))[rnd.integers(0, 6, 90)] + rnd.standard_normal((90, 24)) * noise) * 7
    right = left if same else left[::-1][:70] + rnd.standard_normal((70, 24)) * noise
    lengths = [np.sqrt((v * v).sum(1)) for v in (left, right)]
    cosines = left @ right.T / np.outer(*lengths)
    wanted = {(i, j) for i, j in zip(*np.nonzero(cosines >= 0.93)) if not same or i < j}
    runs = list(neardup.linked_pairs(left, right, 0.93, same=same))
    got = [(i, j) for run in runs for i, j in zip(*run)]
    assert len(got) == len(set(got)) and set(got) == wanted and all(len(i) <= 50 for i, _ in runs)
    assert noise > 1 or len(wanted) > 50
    forest = neardup._Forest(160)
    for i, j in runs:
        forest.add(i, j if same else j + 90)
    root = list(range(160))
    for i, j in forest.pairs:
        a, b = root[i], root[j]
        assert a != b
        root = [a if r == b else r for r in root]
    assert all(root[i] == root[j if same else j + 90] for i, j in wanted)
