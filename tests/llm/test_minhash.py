import random

import numpy as np
import pytest

from sarweave.llm import minhash
from sarweave.llm.components import components
from sarweave.llm.minhash import least_matches, near_duplicates
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows(out):
    return sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def made(seed):
    """Chains of near copies, copies, groups around one text, short and empty texts, nulls."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(4))
    out = []
    for _ in range(6):
        ws = [word() for _ in range(80)]
        for _ in range(r.randint(1, 14)):
            out.append(" ".join(ws))
            if r.random() < 0.8:
                ws = list(ws)
                ws[r.randrange(len(ws))] = word()
    star = [word() for _ in range(120)]
    for _ in range(40):
        ws = list(star)
        for _ in range(r.randint(1, 4)):
            ws[r.randrange(len(ws))] = word()
        out.append(" ".join(ws))
    out += ["", "one two", "One  TWO", "a b c d e", None, "one two"]
    r.shuffle(out)
    ids = [i if r.random() < 0.95 else None for i in range(len(out))]
    return list(zip(ids, out, strict=True)) + [(5, "one two"), (5, "one two")]


@pytest.mark.parametrize(("percent", "long", "block"), [(80, 12, 1 << 20), (85, 1, 2000), (85, 10**6, 1)])
def test_small(spark, monkeypatch, percent, long, block):
    monkeypatch.setattr(minhash, "LONG", long)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block)
    data = made(percent)
    out = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), percent)
    assert rows(out) == sorted(brute.op8(data, percent), key=repr)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = [tuple(x) for x in docs.select("doc_id", "text").collect()]
    assert rows(near_duplicates(docs, 85)) == sorted(brute.op8(data), key=repr)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string, node int, key int")).count() == 0


def test_long_path(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(1, n + 1)} | {(101, 100)}


def test_least_matches():
    assert least_matches(0.85) > least_matches(0.8) > 25


def family(n, own, seed=4):
    """Texts around one boilerplate, of whose words each replaces a share by own ones."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(100)]
    out = []
    for i in range(n):
        ws = list(base)
        for k in r.sample(range(100), own):
            ws[k] = f"x{i}_{k}"
        out.append((i, " ".join(ws)))
    return out


def test_work_of_a_family_grows_in_proportion(spark, monkeypatch):
    """Texts that share long lists but no link: the rows written for them double with their number."""
    written = {}
    plain = minhash.materialize

    def counted(df, label):
        out = plain(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(minhash, "materialize", counted)
    totals = []
    for n in (200, 400):
        written.clear()
        data = family(n, 7)
        out = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 85)
        assert rows(out) == sorted(brute.op8(data, 85), key=repr)
        assert not written.get("clusters")
        totals.append(sum(written.values()))
    assert totals[1] < 2.3 * totals[0], totals


def test_recall_of_the_signatures():
    """Share of pairs a little above the threshold that have the matches asked for."""
    r = random.Random(2)
    found = total = 0
    t = least_matches(0.85)
    for i in range(400):
        a = [f"w{r.randrange(10**6)}" for _ in range(200)]
        b = list(a)
        for k in r.sample(range(200), 3):
            b[k] = f"y{i}_{k}"
        x, y = brute.shingles(" ".join(a)), brute.shingles(" ".join(b))
        if 0.85 <= len(x & y) / len(x | y) <= 0.9:
            sets = [minhash.shingle_sets(np.frombuffer(s.encode(), np.uint8), np.array([0, len(s.encode())]))[0] for s in (" ".join(a), " ".join(b))]
            sig = minhash.signatures(sets)
            total += 1
            found += (sig[0] == sig[1]).sum() >= t
    assert total > 200 and found / total >= 0.99
