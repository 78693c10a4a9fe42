import random

import ahocorasick
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sarweave.llm import kernels as K
from sarweave.llm import suffix_dedup, winnow
from sarweave.llm.substring_dedup import Passages, substring_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def made(seed):
    """Documents of few words that share passages, with runs, copies, nulls and repeated rows."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 3)))
    shared = [" ".join(word() for _ in range(r.randint(8, 30))) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = [r.choice(shared) if r.random() < 0.5 else " ".join(word() for _ in range(r.randint(1, 15))) for _ in range(r.randint(0, 5))]
        rows.append((d if r.random() < 0.9 else None, r.choice([" ", "\n", "\t "]).join(parts)))
    rows += [rows[3], rows[4], (99, None), (100, ""), (101, "a" * 400), (102, "a" * 300), (103, "ab " * 120), (104, "ab " * 90)]
    return rows


def got(df, *cols):
    return sorted(df.select(*cols).collect(), key=repr)


def same(a, b):
    assert sorted(map(tuple, a), key=repr) == sorted(b, key=repr)


@pytest.mark.parametrize(("limit", "size"), [(300_000, 1 << 20), (20, 2000), (300, 400)])
def test_substrings_small(spark, limit, size):
    rows = made(1) + [(50, "ab ba " * 40)] * 30 + [(None, "ab ba " * 20)] * 30
    out = substring_dedup(spark.createDataFrame(rows, SCHEMA), window=8, gram=3, shard_windows=limit, shard_bytes=size)
    same(got(out, "doc_id", "n_words", "n_removed", F.sha2("kept", 256)), brute.op1(rows, 8))


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_suffixes_small(spark, limit):
    rows = made(2)
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA), window=24, gram=6, shard_windows=limit)
    same(got(out, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)), brute.op2(rows, 24))


def test_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same(got(substring_dedup(docs), "doc_id", "n_words", "n_removed", F.sha2("kept", 256)), brute.op1(rows))
    same(got(suffix_dedup.suffix_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)), brute.op2(rows))


def test_occurrences_of_the_automaton_decide():
    """Without its phrases a shard's automaton finds nothing, and nothing goes."""
    scheme = winnow.Scheme("words", 8, 3, 100)
    texts = [f"w{i} " * 3 + " ".join(f"p{k}" for k in range(20)) + f" x{i}" for i in range(2)]
    data, offsets = K.text_bytes(pa.array(texts))
    values, bounds, *_ = scheme.tokens(data, offsets)
    g = winnow.segments(values, bounds, scheme)
    own = g["doc"] == 0
    p1, p2 = winnow.phrases(values, (g["pos"] + bounds[g["doc"]] + g["at"])[own], 3)
    cols = {"p1": p1, "p2": p2, "at": g["at"][own], "wins": g["wins"][own], "c1": g["c1"][own], "c2": g["c2"][own], "first": np.zeros(own.sum(), np.int64)}
    runs = pa.array([[] for _ in p1], pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())])))
    passages = Passages(pa.table({**{k: pa.array(v) for k, v in cols.items()}, "runs": runs}), scheme)
    gone = passages.removed(values, bounds, np.array([0, 1]))
    assert gone[: bounds[1]].sum() == 0 and 8 <= gone[bounds[1] :].sum() <= 20
    passages.automaton = ahocorasick.Automaton()
    assert not passages.removed(values, bounds, np.array([0, 1])).any()


def test_long_texts(spark):
    r = random.Random(8)
    long = " ".join(r.choice("abcdefghij") * r.randint(1, 9) for _ in range(60_000))
    rows = [(3, long), (1, long[100_000:150_000]), (2, "x" * 3_000_000 + " " + long[:1000])]
    docs = spark.createDataFrame(rows, SCHEMA)
    same(got(substring_dedup(docs), "doc_id", "n_words", "n_removed", F.sha2("kept", 256)), brute.op1(rows))


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, rank string, th int, spans int")
    assert substring_dedup(empty).count() == 0
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_equal_suffixes():
    r = random.Random(5)
    text = bytes(r.choice(b"ab") for _ in range(3000)) + b"x" * 300
    starts = np.arange(len(text) - 40 + 1)
    seen = {}
    for s in starts:
        seen.setdefault(text[s : s + 40], []).append(s)
    want = np.array([len(seen[text[s : s + 40]]) > 1 for s in starts])
    assert (suffix_dedup.equal_suffixes(text, starts, 40, 8) == want).all()
    trie = suffix_dedup.BlindTrie(text, 0, 40)
    for s in starts.tolist():
        trie.insert(s)
    order = [s for leaf in trie.leaves() for s in leaf[:1]]
    assert [text[s : s + 40] for s in order] == sorted(text[s : s + 40] for s in order)
    assert len(order) == len(seen)


def test_multikey_groups():
    r = np.random.default_rng(6)
    text = r.integers(97, 99, 4000).astype(np.uint8)
    starts = np.arange(0, 3900, 3)
    order, begin = suffix_dedup.multikey_groups(suffix_dedup.characters(text), starts, 16)
    cut = [text[s : s + 16].tobytes() for s in starts]
    want = sorted(x for x in cut if cut.count(x) > 1)
    assert [cut[i] for i in order] == want
    assert begin.tolist() == [i for i in range(len(want)) if not i or want[i] != want[i - 1]]
    one = suffix_dedup.multikey_groups(suffix_dedup.characters(text), starts[:1], 16)
    assert not len(one[0]) and not len(suffix_dedup.multikey_groups(suffix_dedup.characters(text), starts[:0], 16)[1])
    assert not suffix_dedup.equal_suffixes(b"", np.empty(0, np.int64), 200).any()


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(3)
    values = np.tile(r.integers(0, 2**63, 37).astype(np.uint64), 9)
    s = winnow.Scheme("words", 12, 4, 1000)
    g = winnow.segments(values, np.array([0, 100, 100, len(values)]), s)
    assert (g["wins"] * g["reps"]).sum() == (100 - 11) + (len(values) - 100 - 11)
