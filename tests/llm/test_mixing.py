import numpy as np
import pytest
from pyspark.sql import functions as F

from sarweave.llm import mixing as m

SF = "/root/testdata/sf0.01"


def solved(tokens, p, want, ridge=m.RIDGE):
    """The rates nearest to 1 that match, by many plain projected-gradient steps and moves of the aims."""
    own = tokens @ p
    scale, r, aim = np.maximum(own, want), np.ones(len(p)), want.copy()
    for _ in range(40):
        for _ in range(3000):
            r = np.maximum(0, r - (p @ (((tokens * r) @ p - aim) / scale) + ridge * (r - 1)) / (1 + ridge))
        aim = aim + want - (tokens * r) @ p
    return r


@pytest.mark.parametrize("repeat", [True, False])
def test_rates_match_plain_descent(spark, repeat):
    r = np.random.default_rng(4)
    p = r.dirichlet((0.3, 0.3, 0.3), 200)
    tokens = r.integers(0, 500, 200)
    rows = spark.createDataFrame([(int(t), [float(v) for v in x]) for t, x in zip(tokens, p, strict=True)], "tokens long, posterior array<double>")
    share = dict(zip(m.DOMAINS, (0.6, 0.1, 0.3), strict=True))
    past, own, want = m.fit_rates(rows, share, repeat)
    got = m.replay(p, past, m.RIDGE)[0]
    assert np.allclose(own, tokens @ p) and got.min() >= 0
    assert np.abs((tokens * got) @ p / want - 1).max() < 0.01
    assert np.abs(got - solved(tokens, p, want)).max() < 0.05


def test_scarce_domains(spark):
    """Of 1000 tokens 2 % are toxic and almost none junk: with repeats the targets are met, without them the shortfall is told."""
    rows = [(10, [0.97, 0.02, 0.01])] * 97 + [(10, [0.1, 0.85, 0.05])] * 2 + [(10, [0.1, 0.1, 0.8])]
    share = {"clean": 0.8, "toxic": 0.1, "junk": 0.1}
    members = spark.createDataFrame(rows, "tokens long, posterior array<double>")
    p, tokens = np.array([x for _, x in rows]), np.array([t for t, _ in rows])
    totals = {}
    for repeat in (True, False):
        past, own, want = m.fit_rates(members, share, repeat)
        rate = m.replay(p, past, m.RIDGE)[0]
        rated = spark.createDataFrame([(t, x, float(r)) for (t, x), r in zip(rows, rate, strict=True)], "tokens long, posterior array<double>, rate double")
        totals[repeat] = {r.domain: r for r in m.domain_totals(rated, share).collect()}
        assert np.allclose([totals[repeat][d].own_tokens for d in m.DOMAINS], tokens @ p)
        assert np.abs((tokens * rate) @ p / want - 1).max() < 0.01
    assert max(abs(r.shortfall) / r.target_tokens for r in totals[True].values()) < 0.01
    assert totals[False]["junk"].shortfall > 0.5 * totals[False]["junk"].target_tokens


def test_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    mixed = m.mix(docs, labels)
    out = mixed.drop("text").toPandas()
    p = np.array(out.posterior.tolist())
    total = (out.tokens.to_numpy() * out.rate.to_numpy()) @ p
    want = np.array([m.TARGETS[d] for d in m.DOMAINS])
    assert np.abs(total / total.sum() / want - 1).max() < 0.02 and len(out) == docs.count()
    assert all(abs(r.shortfall) < 0.02 * r.target_tokens for r in m.domain_totals(mixed).collect())
    told = out.merge(labels.toPandas(), on="doc_id")
    clean = told[(told.quality == 1) & (told.toxic == 0)]
    assert (clean.copies >= 1).mean() > 0.98 and told[told.toxic == 1].copies.mean() < 0.5


def test_posteriors_and_copies_against_plain_ones(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = m.train(docs, labels)
    out = {r.doc_id: r for r in m.posteriors(docs.orderBy("doc_id").limit(40), model).collect()}
    for r in out.values():
        words = r.text.encode().split()
        assert r.tokens == len(words)
        raw = np.frombuffer(r.text.encode(), np.uint8)
        bucket, of, dense, _ = m.text_features(raw, np.array([0, len(raw)]))
        z = dense[0] @ model[1] + sum(model[0][b] for b in sorted(set(bucket.tolist())))
        assert len(set(bucket.tolist())) == len(bucket) and np.allclose(r.posterior, np.exp(z - z.max()) / np.exp(z - z.max()).sum())
    mixed = m.mix(docs, labels).select("doc_id", "rate", "copies").collect()
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in mixed)


def test_training_takes_one_row_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(i, f"text {i % 3} of words") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 > 1)) for i in range(30)], "doc_id long, quality int, toxic int")
    many = docs.unionByName(spark.range(20_000).selectExpr("4L AS doc_id", "'text 1 of words' AS text"))
    assert all(np.allclose(a, b) for a, b in zip(m.train(docs, labels), m.train(many, labels), strict=True))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 5), (2, "a b " * 20000, 5), (2, "a b " * 20000, 5)], "doc_id long, text string, rate int")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    out = m.mix(docs, labels)
    assert out.count() == 4 and out.where(F.col("rate").isNull() | F.isnan("rate")).count() == 0
    assert m.mix(docs.limit(0), labels.limit(0)).count() == 0
