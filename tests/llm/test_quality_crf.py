import itertools

import numpy as np
from pyspark.sql import functions as F

from sarweave.llm import quality_crf as q

SF = "/root/testdata/sf0.01"


def test_marginals_against_all_labellings():
    r = np.random.default_rng(1)
    emit, trans = r.normal(size=9), r.normal(size=(2, 2))
    bounds = np.array([0, 4, 4, 5, 9])
    p, pairs, log_z = q.marginals(emit, trans, bounds)
    want, want_pairs, want_z = np.zeros(9), np.zeros((2, 2)), 0.0
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        total, good, moves = 0.0, np.zeros(hi - lo), np.zeros((2, 2))
        for ys in itertools.product((0, 1), repeat=hi - lo):
            s = np.exp(sum(e * y for e, y in zip(emit[lo:hi], ys, strict=True)) + sum(trans[a, b] for a, b in itertools.pairwise(ys)))
            total, good = total + s, good + s * np.array(ys)
            for a, b in itertools.pairwise(ys):
                moves[a, b] += s
        if hi > lo:
            want[lo:hi], want_pairs, want_z = good / total, want_pairs + moves / total, want_z + np.log(total)
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = q.quality(docs, labels)
    assert out.count() == docs.count()
    told = out.join(labels, "doc_id").where("held_out").toPandas()
    assert (told.predicted == told.quality).mean() > 0.95
    assert told.score.between(0, 1).all()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "A line.\n\nAnother one.", "x"), (3, "word " * 30000, "x"), (3, "word " * 30000, "x"), (4, "\n\n \n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None), (9, 1)], "doc_id long, quality int")
    out = {(r.doc_id, r.score) for r in q.quality(docs, labels).collect()}
    assert len([s for d, s in out if d == 3]) == 1 and (1, 0.0) in out and (2, 0.0) in out and (4, 0.0) in out
    assert q.quality(docs.limit(0), labels.limit(0)).count() == 0
    assert q.score(docs, q.train(docs, labels)).where(F.col("score").isNull()).count() == 0


def plain_lines(text):
    return [x for x in (text or "").split("\n") if x.split()]


def test_line_features_against_plain_counts():
    texts = ["One line.\nTWO LINES, 12!\n\n#a $b", "", "x\nx\nx x"]
    raw = [t.encode() for t in texts]
    x, size, bounds = q.line_features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert np.diff(bounds).tolist() == [len(plain_lines(t)) for t in texts]
    lines = [ln for t in texts for ln in plain_lines(t)]
    assert np.allclose(x[:, 1], [np.log1p(len(ln.split())) / 5 for ln in lines], atol=1e-6)
    assert np.allclose(x[:, 3], [sum(c.isupper() for c in ln) / max(1, sum(c.isalpha() for c in ln)) for ln in lines], atol=1e-6)
    assert x[:, 14].tolist() == [0, 0, 0, 0, 1, 0]
    # The features of the line before and after, within the text.
    assert (x[1, 20:40] == x[0, :20]).all() and (x[0, 40:60] == x[1, :20]).all() and not x[3, 20:40].any() and not x[2, 40:60].any()


def test_lines_of_mixed_documents_are_told_apart(spark):
    r = np.random.default_rng(3)
    word = lambda: "".join(r.choice(list("abcdefgh"), 5))
    good = lambda: " ".join(word() for _ in range(10)).capitalize() + "."
    junk = lambda: " ".join(f"#{word()[:2].upper()}$$ | {r.integers(1000)} !!" for _ in range(6))
    rows = []
    for d in range(240):
        n = int(r.integers(4, 12))
        k = 0 if d % 2 else int(np.ceil(n * 0.6))
        at = int(r.integers(0, n - k + 1))
        rows.append((d, "\n".join(junk() if at <= i < at + k else good() for i in range(n)), d % 2, [at <= i < at + k for i in range(n)]))
    docs = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y, _ in rows], "doc_id long, quality int")
    w, trans = q.train(docs, labels)
    raw = [t.encode() for _, t, *_ in rows]
    x, _, bounds = q.line_features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw]))))
    p = q.marginals(x @ w, trans, bounds)[0]
    is_junk = np.array([j for *_, js in rows for j in js])
    assert ((p < 0.5) == is_junk).mean() > 0.97
    assert sum((p[a:b] < 0.5).any() and (p[a:b] > 0.5).any() for a, b in itertools.pairwise(bounds)) > 100


def test_score_against_a_plain_mean(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = q.train(docs, labels)
    some = docs.orderBy("doc_id").limit(60)
    got = {r.doc_id: r.score for r in q.score(some, model).collect()}
    for r in some.collect():
        lines = r.text.encode()
        x, size, bounds = q.line_features(np.frombuffer(lines, np.uint8), np.array([0, len(lines)]))
        p = q.marginals(x @ model[0], model[1], bounds)[0]
        assert np.isclose(got[r.doc_id], (p * size).sum() / max(size.sum(), 1), atol=1e-9)


def test_training_takes_one_row_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(i, f"Text {i}.\nOf two lines." if i % 2 else "## $$ !!\n|| ||") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    many = docs.unionByName(spark.range(30_000).selectExpr("3L AS doc_id", "'Text 3.\nOf two lines.' AS text"))
    once, again = q.train(docs, labels), q.train(many, labels)
    assert all(np.allclose(a, b) for a, b in zip(once, again, strict=True))
    assert q.one_text_each(many, labels.withColumnRenamed("quality", "y"), "y").count() == 40


def test_a_run_of_lines_of_long_documents(spark, monkeypatch):
    monkeypatch.setattr(q, "TRAIN_LINES", 5)
    docs = spark.createDataFrame([(1, "good line here.\n" * 5000), (2, "## $$\n" * 5000)], "doc_id long, text string")
    w, _ = q.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert np.isfinite(w).all()
