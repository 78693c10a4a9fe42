import random

import numpy as np
from pyspark.sql import functions as F

from sarweave.llm import decontaminate as dc
from sarweave.llm import kernels as K
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def brute_leaks(docs, items, least=dc.SIMILARITY):
    """All pairs with a window of the item's words (or the whole shorter text) that is similar enough, and the best similarity."""
    from collections import Counter

    words = lambda t: brute.WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = lambda ws, k: [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)]
    out = {}
    for item, t in items:
        n = len(words(t))
        if not n:
            continue
        k = min(5, n)
        want = Counter(grams(words(t), k))
        m = want.total()
        for d, text in docs:
            g = grams(words(text), k)
            if not set(g) & set(want):
                continue
            for s in range(max(1, len(g) - m + 1)):
                got = Counter(g[s : s + m])
                both = (got & want).total()
                sim = both / (m + got.total() - both)
                if sim >= least:
                    out[d, item] = max(out.get((d, item), 0), sim)
    return out


def pairs(docs, bench):
    out = dc.flag_leaks(docs, bench)
    return {(r.doc_id, r.item_id): r.similarity for r in out.select("doc_id", F.inline("leaks")).collect()}


def test_documents(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_leaks([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    assert want and pairs(docs, bench) == want


def test_edited_passages(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 7, 20, 40, 40, 60, 90])] + [(20, ""), (21, None), (None, "x y")]
    docs = []
    for d in range(80):
        ws = r.choice(items[:9])[1].split()
        for _ in range(r.randint(0, 2)):
            ws[r.randrange(len(ws))] = word()
        around = [[word() for _ in range(r.choice([0, 0, 30]))] for _ in range(2)]
        docs.append((d, " ".join(around[0] + [w.upper() if r.random() < 0.2 else w for w in ws] + around[1])))
    docs += [(100, ""), (101, None), (102, " ")]
    got = pairs(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute_leaks(docs, [x for x in items if x[0] is not None])


def test_items_with_null_ids(spark):
    r = random.Random(5)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(30)) for _ in range(3)]
    docs = spark.createDataFrame([(0, f"so {texts[0]} on"), (1, f"{texts[1]} and {texts[2]} {texts[0]}"), (2, "none of it at all here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (7, texts[2])], "item_id long, text string")
    got = {x.doc_id: [(y.item_id, y.start_word) for y in x.leaks] for x in dc.flag_leaks(docs, bench).collect()}
    assert got == {0: [(None, 1)], 1: [(7, 31), (None, 0), (None, 61)], 2: []} or got == {0: [(None, 1)], 1: [(7, 31), (None, 61), (None, 0)], 2: []}


def test_long_repetitive_passages(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items, docs = [], []
    for n, run in ((200, 17), (300, 26), (500, 43)):
        for _ in range(6):
            plain = [word() for _ in range(n - run)]
            items.append((len(items), " ".join([*plain, *["same"] * run])))
            # The run is cut away, as much as the threshold lets go.
            docs.append((len(docs), " ".join([*plain, *[word() for _ in range(run)]])))
    docs += [(99, "same " * 3000)]
    want = brute_leaks(docs, items)
    assert len(want) == 18 and pairs(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == want


def test_blocks_and_columns(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = pairs(docs, bench)
    monkeypatch.setattr(dc, "GROUP_ITEMS", 2)
    monkeypatch.setattr(dc, "BLOCK_GROUPS", 3)
    assert len(list(dc.blocks(bench))) > 2
    out = dc.flag_leaks(docs.withColumn("leaks", F.lit(1)).withColumn("similarity", F.lit("x")), bench)
    assert {(r.doc_id, x.item_id) for r in out.collect() for x in r.leaks} == set(whole)
    assert set(out.columns) == {*docs.columns, "leaks", "similarity"}
    assert dc.flag_leaks(docs, bench.limit(0)).where(F.size("leaks") > 0).count() == 0


def test_all_within_radius_are_found():
    r = np.random.default_rng(2)
    prints = r.integers(0, 2**63, 20000, dtype=np.uint64)
    g = dc.Group(9, [(i, r.integers(0, 2**63, 5).astype(np.uint64)) for i in range(40)], 19)
    near = prints.copy()
    for i in range(0, len(near), 2):
        near[i] = g.prints[i % 40] ^ K.U(sum(1 << int(b) for b in r.choice(64, i % 26, replace=False)))
    w, i = g.near(near)
    want = {(a, b) for b in range(40) for a in np.flatnonzero(np.bitwise_count(near ^ g.prints[b]) <= 19)}
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == want
