import random
import re

import pytest

from ratelens.llm import contamination
from ratelens.llm.contamination import decontaminated

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for p in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[p : p + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit), sorted(hit)))
    return sorted(out, key=str)


def spread(rows):
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"], [p for s in r["spans"] for p in range(s["start"], s["end"])]) for r in rows),
        key=str,
    )


def corpus():
    rnd = random.Random(7)
    vocabulary = ["a", "B", "Ça", "été", "x9", "the", "İ", "ΑΒ", "end"] + [f"w{i}" for i in range(40)]
    passage = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, ", ".join(passage(n))) for i, n in enumerate((1, 3, 9, 10, 11, 25, 40))]
    items[0] = (0, "Rare-")
    items += [(5, items[3][1]), ("7b", items[4][1].upper()), (None, " ".join(passage(12))), (8, None), (9, "?!"), (10, "")]
    items = [(None if i is None else str(i), t) for i, t in items]
    docs = []
    for i in range(150):
        body = passage(rnd.choice((0, 1, 9, 30, 120)))
        for _ in range(rnd.choice((0, 0, 1, 2))):
            at = rnd.randint(0, len(body))
            text = rnd.choice([t for _, t in items if t])
            copy = [w for w in re.split(r"[, ]+", text) if w]
            cut = rnd.randint(0, len(copy) // 3)
            body = body[:at] + copy[cut:] + body[at:]
        docs.append((i, rnd.choice((" ", "\n", " - ", "... ")).join(body)))
    long = passage(30000)
    long[20000:20000] = items[6][1].split(", ")
    docs += [(900, " ".join(long)), (901, None), (902, ""), (903, " .;"), (None, items[5][1]), (None, None), (3, docs[3][1]), (3, "rare other"), (3, "rare other")]
    return docs, items


@pytest.mark.parametrize("slices", [500_000, 7])
def test_equals_brute_force(spark, monkeypatch, slices):
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", slices)
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, items string, hash int").repartition(5)
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, words int")
    got = contamination.contamination(df, bench)
    want = brute(docs, items)
    assert spread(got.collect()) == want
    assert sum(w[4] for w in want) > 40 and not all(w[4] for w in want)


def test_repeated_rows_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(contamination, "COPIES", 3)
    docs = [(1, "one two three")] * 8 + [(2, "four")] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(4, "two")], "item_id long, text string")
    assert spread(contamination.contamination(df, bench).collect()) == brute(docs, [(4, "two")])


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(4, "a")], "item_id long, text string")
    assert spread(contamination.contamination(df, bench.limit(0)).collect()) == brute([(1, "a b"), (2, None)], [])
    assert contamination.contamination(df.limit(0), bench).count() == 0
    assert decontaminated(df.limit(0), bench).count() == 0
    assert sorted(decontaminated(df, bench.limit(0)).collect(), key=str) == sorted(df.collect(), key=str)


def test_passages_and_documents_go(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, hit_id string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = brute(docs, items)
    kept = decontaminated(df, bench, remove="documents")
    assert kept.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(w[0]) for w in want if not w[4])
    cut = decontaminated(df, bench, remove="spans")
    left = sorted(((r["doc_id"], words(r["text"])) for r in cut.collect()), key=str)
    hits = {(d, t): h for (d, t), h in ((x, brute([x], items)[0][5]) for x in set(docs))}
    assert left == sorted(((d, [w for p, w in enumerate(words(t)) if p not in set(hits[d, t])]) for d, t in docs), key=str)
    clean = {(d, t) for d, t in docs if not hits[d, t]}
    assert clean <= {(r["doc_id"], r["text"]) for r in cut.collect()}
    with pytest.raises(ValueError):
        decontaminated(df, bench, remove="rows")


def test_text_around_a_passage_stays(spark):
    df = spark.createDataFrame([(1, " One, two. THREE four - five! ")], "doc_id long, text string")
    bench = spark.createDataFrame([(4, "three FOUR")], "item_id long, text string")
    assert decontaminated(df, bench).first()["text"] == " One, two.  - five! "


def test_no_python_in_tasks(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(4, "a")], "item_id long, text string")
    for found in (contamination.contamination(df, bench), decontaminated(df, bench)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
