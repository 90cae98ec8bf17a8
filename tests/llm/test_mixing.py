import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm.mixing import DOMAINS, draws, fit_domains, fit_rates, mixing_rates, rate_after, with_posteriors

FOLDER = "/root/testdata/sf0.01"


def project(tokens, chances, goal, steps=4000):
    """Least squares with nonnegative rates, one document at a time."""
    rates, held = np.ones(len(tokens)), (tokens[:, None] * chances).sum(axis=0)
    for _ in range(steps):
        off = ((rates * tokens)[:, None] * chances).sum(axis=0) - goal
        rates = np.maximum(0, rates - chances @ (off / held))
    return rates


@pytest.fixture(scope="module")
def members(spark):
    rnd = np.random.default_rng(4)
    chances = rnd.dirichlet((3, 0.5, 0.2), 500)
    tokens = rnd.integers(0, 400, 500)
    rows = [(i, int(t), *map(float, p)) for i, (t, p) in enumerate(zip(tokens, chances))]
    return spark.createDataFrame(rows, "doc_id long, tokens long, p_good double, p_poor double, p_toxic double"), tokens, chances


@pytest.mark.parametrize("shares", [(0.9, 0.05, 0.05), (0.3, 0.6, 0.1), (0.97, 0.03, 0.0)])
def test_rates_equal_plain_projected_gradient(members, shares):
    df, tokens, chances = members
    found = fit_rates(df, dict(zip(DOMAINS, shares)), steps=60)
    rates = [r[0] for r in df.orderBy("doc_id").select(rate_after(found.moves, [F.col(f"p_{d}") for d in DOMAINS])).collect()]
    assert min(rates) >= 0
    want = project(tokens.astype(float), chances, np.array(found.targets))
    reached = ((np.array(rates) * tokens)[:, None] * chances).sum(axis=0)
    best = ((want * tokens)[:, None] * chances).sum(axis=0)
    total = sum(found.targets)
    assert np.abs(reached - found.targets).max() <= np.abs(best - found.targets).max() + 0.01 * total


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 0)
    model = fit_domains(docs, train)
    held = docs.join(labels.join(train.select("doc_id"), "doc_id", "left_anti"), "doc_id")
    rows = with_posteriors(held, model).collect()
    right = [max(DOMAINS, key=lambda d: r[f"p_{d}"]) == ("toxic" if r["toxic"] else "good" if r["quality"] else "poor") for r in rows]
    assert len(right) > 50 and np.mean(right) > 0.85


def test_targets_are_met_and_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    out = mixing_rates(docs, labels, targets={"good": 0.98, "poor": 0.01, "toxic": 0.01}).cache()
    held = out.agg(*[F.sum(F.col("tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in DOMAINS]).first()
    assert abs(held["good"] / sum(held) - 0.98) < 0.01
    assert out.filter("p_good > 0.99").agg(F.min("rate")).first()[0] > 0.95
    assert "text" not in out.columns and out.count() == docs.count()


def test_draws_have_the_rate_as_mean(spark):
    row = spark.range(20000).select(draws(F.lit(1.3), F.col("id")).alias("n")).agg(F.avg("n"), F.min("n"), F.max("n")).first()
    assert abs(row[0] - 1.3) < 0.02 and (row[1], row[2]) == (1, 2)


def test_nulls_clashing_columns_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, None, 9), (None, "", 9), (2, "a b", 9)], "doc_id long, text string, rate int")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = mixing_rates(docs, labels).collect()
    assert len(got) == 3 and all(abs(r["p_good"] - 1 / 3) < 1e-9 for r in got)
    assert mixing_rates(docs.limit(0), labels).count() == 0
