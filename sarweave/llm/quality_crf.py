"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line that has a word gets features of its characters and words and those of its neighbours. The
field labels each line bad (0) or good (1). Only documents have labels, so that the lines' labels are latent: training
starts from lines labelled like their document and judged by their own features alone, then takes turns. Given the field, each document's lines
get the marginals nearest to the field's own whose mean, weighted by bytes, suits its label (at least GOOD_SHARE good in
a good document, at most BAD_SHARE in a bad one; a document that suits already is left as the field sees it); given these,
the field is fitted to them, transitions included. So a bad document may have good lines. The
score of a document is the mean of its lines' forward-backward marginals for good, weighted by the
lines' bytes. Training takes at most SAMPLE labelled documents, those least by hash, one row of each (the least text)
and a run of at most TRAIN_LINES lines of it; only their features go to the driver. Scoring runs over all documents and lines.

A null or empty text, or one without words, has no lines and the score 0. If no labelled document is
given, or only one label, the score is the share of label 1 (or 0.5). Rows with equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarweave.llm import kernels as K
from sarweave.session import text_batches

#: Labelled documents to train on, at most.
SAMPLE = 2000
#: Lines of a labelled document to train on, at most: a run that begins at a place by hash.
TRAIN_LINES = 512
STEPS = 200
#: Turns of labelling lines and fitting, and steps of each.
TURNS = 6
TURN_STEPS = 40
#: Least share of good lines, by bytes, in a good document, and the greatest in a bad one.
GOOD_SHARE = 0.97
BAD_SHARE = 0.4
RIDGE = 1e-4
THRESHOLD = 0.7


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, dtype=np.int32)
    t[list(chars.encode())] = 1
    return t


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LETTER[128:] = 1
CLASSES = (UPPER, LETTER, _class("0123456789"), _class("#*$%&<>"), _class("|"), _class("!"), _class(".,;:?"))
N_OWN = 20


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line that has a word, its length in bytes, and line bounds of the texts."""
    n = len(data)
    is_start = np.zeros(n + 1, dtype=bool)
    is_start[offsets[:-1]] = True
    is_start[np.flatnonzero(data == 10) + 1] = True
    start = np.flatnonzero(is_start[:n])
    end = np.append(start[1:], n)
    word_at, word_end, _ = K.words(data, offsets)
    in_words = np.zeros(n + 1, dtype=np.int32)
    in_words[word_at + 1] = 1
    words = np.cumsum(in_words, dtype=np.int32)
    value = K.word_hashes(data, word_at, word_end)
    twice = np.zeros(len(value) + 1)
    if len(value) > 1:
        np.cumsum(value[1:] == value[:-1], out=twice[2:])
    twice = twice[words[end]] - twice[words[start]]
    words = words[end] - words[start]
    keep = words > 0
    start, end, twice, words = start[keep], end[keep], twice[keep], words[keep].astype(np.float64)
    doc = np.searchsorted(offsets, start, side="right") - 1
    counts = []
    for c in CLASSES:
        total = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(c[data], out=total[1:])
        counts.append((total[end] - total[start]).astype(np.float64))
    upper, letter, digit, symbol, pipe, bang, stop = counts
    size = (end - start).astype(np.float64)
    same = K.RangeHash(K.TABLE[data]).of(start, end)
    order = np.lexsort((np.arange(len(doc)), same, doc))
    again = np.zeros(len(doc))
    if len(doc):
        s, d = same[order], doc[order]
        again[order[1:]] = (s[1:] == s[:-1]) & (d[1:] == d[:-1])
    up, sy, ba, pi = upper / np.maximum(letter, 1), symbol / words, bang / words, pipe / words
    own = [
        np.ones(len(doc)), np.log1p(words) / 5, np.log1p(size) / 7, up, up > 0.5, np.minimum(sy, 2), sy > 0.3, np.minimum(ba, 2), ba > 0.3,
        np.minimum(pi, 2), pi > 0.3, digit / size, stop / words, np.minimum(letter / words, 30) / 10, again, words < 4, letter / size,
        twice / words, twice / words > 0.2, twice > 2,
    ]
    x = np.stack(own, axis=1).astype(np.float32) if len(doc) else np.zeros((0, N_OWN), np.float32)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(doc):
        before[1:] = np.where((doc[1:] == doc[:-1])[:, None], x[:-1], 0)
        after[:-1] = np.where((doc[1:] == doc[:-1])[:, None], x[1:], 0)
    return np.concatenate((x, before, after), axis=1), size, bounds


N_FEATURES = 3 * N_OWN


def marginals(emit: np.ndarray, trans: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of log potentials: P(good) of each line, the expected counts of transitions, and the log partition sum."""
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    first, length = bounds[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    pot = np.stack((np.zeros_like(emit), emit), axis=1)
    top = pot.max(axis=1, keepdims=True)
    pot = np.exp(pot - top)
    move = np.exp(trans - trans.max())
    alpha, beta, scale = np.empty_like(pot), np.ones_like(pot), np.empty(len(emit))
    now = np.ones((len(length), 2))
    for t in range(steps):
        at = first[: active[t]] + t
        now = (now[: active[t]] @ move if t else now[: active[t]]) * pot[at]
        c = now.sum(axis=1)
        now = now / c[:, None]
        alpha[at], scale[at] = now, c
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        at = first[:n] + t
        ahead = pot[at + 1] * beta[at + 1] / scale[at + 1][:, None]
        beta[at] = ahead @ move.T
        pairs += (alpha[at].T @ ahead) * move
    both = alpha * beta
    both /= both.sum(axis=1, keepdims=True)
    many = max(0, len(emit) - int((length > 0).sum()))
    return both[:, 1], pairs, float(np.log(scale).sum() + top.sum() + many * trans.max())


def _ascend(x: np.ndarray, bounds: np.ndarray, q: np.ndarray, pairs: np.ndarray, w: np.ndarray, steps: int, only: slice = slice(None)) -> None:
    """Adam on the expected likelihood, in place: q are the lines' chances to be good, pairs the counts of transitions. Only some weights move."""
    free = np.zeros(len(w))
    free[only] = 1
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        p, own, _ = marginals(x @ w[:-4], w[-4:].reshape(2, 2), bounds)
        g = np.append(x.T @ (q - p), (pairs - own).ravel()) / len(q) - RIDGE * w
        g *= free
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += 0.3 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)


def line_labels(emit: np.ndarray, trans: np.ndarray, bounds: np.ndarray, size: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of the lines to be good, given their documents' labels, and the expected counts of transitions.

    All lines of a document get the one shift of their potentials, found by halving, that makes the mean suit.
    """
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    whole = np.maximum(np.bincount(of, size, len(n)), 1)
    share = lambda p: np.bincount(of, p * size, len(n)) / whole
    p, pairs, _ = marginals(emit, trans, bounds)
    wrong = (n > 0) & np.where(label == 1, share(p) < GOOD_SHARE, share(p) > BAD_SHARE)
    if not wrong.any():
        return p, pairs
    low, high = np.where(label == 1, 0.0, -40.0), np.where(label == 1, 40.0, 0.0)
    aim = np.where(label == 1, GOOD_SHARE, BAD_SHARE)
    for _ in range(14):
        mid = (low + high) / 2
        got = share(marginals(emit + np.where(wrong, mid, 0.0)[of], trans, bounds)[0])
        low, high = np.where(got < aim, mid, low), np.where(got < aim, high, mid)
    p, pairs, _ = marginals(emit + np.where(wrong, (low + high) / 2, 0.0)[of], trans, bounds)
    return p, pairs


def fit(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, size: np.ndarray | None = None, steps: int = STEPS, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features for good, and 2 x 2 transition scores. y: of each line, its document's label."""
    w = np.zeros(x.shape[1] + 4)
    if not len(y) or y.min() == y.max():
        if len(y):
            w[0] = 3.0 if y[0] else -3.0
        return w[:-4], w[-4:].reshape(2, 2)
    x64 = x.astype(np.float64)
    # At first by a line's own features: neighbours would tell the document, not the line.
    _ascend(x64, bounds, y.astype(np.float64), np.zeros((2, 2)), w, steps, slice(0, min(N_OWN, x.shape[1])))
    size = np.ones(len(y)) if size is None else size
    label = np.zeros(len(bounds) - 1, dtype=np.int64)
    some = np.diff(bounds) > 0
    label[some] = y[bounds[:-1][some]]
    for _ in range(turns):
        q, pairs = line_labels(x64 @ w[:-4], w[-4:].reshape(2, 2), bounds, size, label)
        _ascend(x64, bounds, q, pairs, w, TURN_STEPS)
    return w[:-4], w[-4:].reshape(2, 2)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def one_text_each(docs: DataFrame, some: DataFrame, label: str) -> DataFrame:
    """doc_id, text and label of the labelled documents some: of a doc_id that many rows have, the least text.

    some is broadcast: its rows are bounded by the sample that is asked for.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    return rows.groupBy("doc_id", label).agg(F.min("text").alias("text")).select("doc_id", "text", label)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The field, from at most sample documents whose label is not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    some = known.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(sample)
    taken = one_text_each(docs, some, "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            place = b.column(3).to_numpy()
            for i, j in K.pieces(offsets):
                x, size, bounds = line_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n = np.diff(bounds)
                lo = bounds[:-1] + place[i:j] % np.maximum(n - TRAIN_LINES + 1, 1)
                each = [(x[a : a + c].tobytes(), size[a : a + c].astype(np.float32).tobytes()) for a, c in zip(lo.tolist(), np.minimum(n, TRAIN_LINES).tolist(), strict=True)]
                xs, sizes = (pa.array([e[k] for e in each], pa.binary()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), xs, sizes], names=["doc_id", "quality", "x", "size"])

    placed = taken.select("doc_id", "text", "quality", F.pmod(F.xxhash64(F.lit(90), "doc_id"), F.lit(1 << 31)).alias("place"))
    got = placed.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, x binary, size binary").toArrow()
    got = got.sort_by("doc_id")
    parts = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in got["x"].to_pylist()]
    x = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float32)
    size = np.concatenate([np.frombuffer(b, np.float32) for b in got["size"].to_pylist()]).astype(np.float64) if parts else np.zeros(0)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    y = np.repeat(got["quality"].to_numpy().astype(np.int64), sizes)
    return fit(x, y, np.concatenate(([0], np.cumsum(sizes))), size)


def text_scores(data: np.ndarray, offsets: np.ndarray, w: np.ndarray, trans: np.ndarray) -> np.ndarray:
    x, size, bounds = line_features(data, offsets)
    p, *_ = marginals(x @ w, trans, bounds)
    good, whole = (np.concatenate(([0], np.cumsum(v))) for v in (p * size, size))
    total = whole[bounds[1:]] - whole[bounds[:-1]]
    return np.clip((good[bounds[1:]] - good[bounds[:-1]]) / np.maximum(total, 1), 0, 1)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], name: str = "score") -> DataFrame:
    """docs with a column of scores; one of that name is replaced."""
    text_batches(docs.sparkSession)
    w, trans = model
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(b.schema.get_field_index("text")))
            for i, j in K.pieces(offsets):
                s = text_scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], w, trans)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7)."""
    out = score(docs.select("doc_id", "text"), train(docs, labels, sample))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
