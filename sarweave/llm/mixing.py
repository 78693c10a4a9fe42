"""Mixing to target weights with soft memberships.

A classifier learns domains from the label table (clean, toxic, junk) and gives every document a
posterior over them. Rates r >= 0 of documents are then fitted so that the expected tokens of each
domain, the sum of rate * tokens * posterior, match targets in least squares, with a small pull of
every rate towards 1:

    min 1/2 sum_k (S_k - T_k)^2 / c_k + ridge/2 sum_d tokens_d (r_d - 1)^2,  c_k = max(T_k, tokens of k)

by accelerated projected gradient. All rates start at 1 and their gradient depends on the posterior and the
domains' residuals only, so that a step needs one distributed sum of K numbers, and the state
of the fit is the list of past residuals. The pull leaves the totals off; when the steps have nearly settled,
the aims are moved by what is missing (the method of multipliers), and the steps go on, until the totals match: the
rates then are those nearest to 1 that match.

The domain of the greatest share sets the total by its own tokens. A domain with less than its share is repeated, with
rates above 1; where that is not wanted (repeat=False, as in the pipeline, which has just removed copies), it is asked for
what it has, and domain_totals() gives the shortfall against the targets.

A null or empty text has no tokens; its posterior is that of a text without features and its rate is
given like any other's. Rows with equal texts get equal rates; repeated rows count each time. Without labels all
posteriors are equal. All columns are kept; those named like added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarweave.llm import kernels as K
from sarweave.llm.quality_crf import N_OWN, line_features, one_text_each
from sarweave.session import materialize, text_batches

DOMAINS = ("clean", "toxic", "junk")
#: Wanted shares of the tokens.
TARGETS = {"clean": 0.98, "toxic": 0.01, "junk": 0.01}
#: Labelled documents to train on, at most.
SAMPLE = 6000
BUCKETS = 1 << 14
RIDGE = 3e-2
STEPS = 60
#: The aims move when a step changes no total by more than this share of what is missing; the fit ends when each total is
#: this near to its target, and steps change none by more than SETTLED of the domain's tokens.
MOVE = 0.2
NEAR = 0.005
SETTLED = 1e-3


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word buckets (flat, with bounds), dense features, and the number of words of each text."""
    starts, ends, bounds = K.words(data, offsets)
    tokens = np.diff(bounds)
    bucket = (K.word_hashes(data, starts, ends, lower=True) >> K.U(50)).astype(np.int64)
    pair = np.unique(np.repeat(np.arange(len(tokens)), tokens) * BUCKETS + bucket)
    of = np.searchsorted(pair, np.arange(len(tokens) + 1) * BUCKETS)
    x, size, lines = line_features(data, offsets)
    x = x[:, :N_OWN].astype(np.float64) * size[:, None]
    sums = np.concatenate((np.zeros((1, N_OWN)), np.cumsum(x, axis=0)))
    total = np.concatenate(([0], np.cumsum(size)))
    dense = (sums[lines[1:]] - sums[lines[:-1]]) / np.maximum(total[lines[1:]] - total[lines[:-1]], 1)[:, None]
    return pair % BUCKETS, of, np.column_stack((np.ones(len(tokens)), dense)), tokens


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def logits(model: tuple[np.ndarray, np.ndarray], bucket: np.ndarray, of: np.ndarray, dense: np.ndarray) -> np.ndarray:
    words, rest = model
    out = dense @ rest
    for k in range(words.shape[1]):
        sums = np.concatenate(([0.0], np.cumsum(words[bucket, k])))
        out[:, k] += sums[of[1:]] - sums[of[:-1]]
    return out


def fit_classifier(bucket: np.ndarray, of: np.ndarray, dense: np.ndarray, y: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression on word presence and dense features, by Adagrad with a ridge."""
    k = len(DOMAINS)
    words, rest = np.zeros((BUCKETS, k)), np.zeros((dense.shape[1], k))
    if not len(y):
        return words, rest
    target = np.eye(k)[y]
    row = np.repeat(np.arange(len(y)), np.diff(of))
    gw, gr = np.full(words.shape, 1e-8), np.full(rest.shape, 1e-8)
    for _ in range(steps):
        diff = (target - softmax(logits((words, rest), bucket, of, dense))) / len(y)
        dw = np.stack([np.bincount(bucket, diff[row, c], BUCKETS) for c in range(k)], axis=1) - 1e-5 * words
        dr = dense.T @ diff - 1e-5 * rest
        gw, gr = gw + dw * dw, gr + dr * dr
        words += 0.3 * dw / np.sqrt(gw)
        rest += 0.3 * dr / np.sqrt(gr)
    return words, rest


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The classifier, from at most sample labelled documents; only their features go to the driver."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min(F.struct("quality", "toxic")).alias("l"))
    domain = F.when(F.col("l.toxic") == 1, 1).when(F.col("l.quality") == 1, 0).otherwise(2)
    some = known.select("doc_id", domain.alias("domain")).orderBy(F.xxhash64(F.lit(10), "doc_id"), "doc_id").limit(sample)
    taken = one_text_each(docs, some, "domain").select("doc_id", "domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(2))
            for i, j in K.pieces(offsets):
                bucket, of, dense, _ = text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                lists = [bucket[x:y].astype(np.int16).tobytes() for x, y in zip(of[:-1], of[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:2]), pa.array(lists, pa.binary()), pa.array([r.tobytes() for r in dense], pa.binary())], names=["doc_id", "domain", "bucket", "dense"])

    got = taken.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, domain int, bucket binary, dense binary").toArrow().sort_by("doc_id")
    buckets = [np.frombuffer(x, np.int16).astype(np.int64) for x in got["bucket"].to_pylist()]
    dense = np.array([np.frombuffer(x) for x in got["dense"].to_pylist()]).reshape(len(buckets), N_OWN + 1)
    of = np.concatenate(([0], np.cumsum([len(x) for x in buckets]))).astype(np.int64)
    return fit_classifier(np.concatenate(buckets) if buckets else np.empty(0, np.int64), of, dense, got["domain"].to_numpy().astype(np.int64))


def posteriors(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """docs with tokens and posterior, an array in the order of DOMAINS."""
    text_batches(docs.sparkSession)
    docs = docs.drop("tokens", "posterior")
    handle = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(b.schema.get_field_index("text")))
            for i, j in K.pieces(offsets):
                bucket, of, dense, tokens = text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                p = softmax(logits(handle.value, bucket, of, dense))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * len(DOMAINS)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(tokens), lists], names=[*b.schema.names, "tokens", "posterior"])

    return docs.mapInArrow(run, schema)


def replay(p: np.ndarray, residuals: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps whose residuals (a row for each) are known, and the point of the next gradient."""
    r = y = np.ones(len(p))
    momentum = (1 - np.sqrt(ridge)) / (1 + np.sqrt(ridge))
    for e in residuals:
        new = np.maximum(0, y - (p @ e + ridge * (y - 1)) / (1 + ridge))
        y = new + momentum * (new - r)
        r = new
    return r, y


def target_tokens(own: np.ndarray, targets: dict[str, float], repeat: bool = True) -> np.ndarray:
    """Tokens that the domains are asked for, of which they have own."""
    share = np.array([targets[d] for d in DOMAINS], dtype=float)
    share = share / share.sum()
    lead = int(share.argmax())
    want = share * own[lead] / share[lead]
    return want if repeat else np.minimum(own, want)


def fit_rates(members: DataFrame, targets: dict[str, float], repeat: bool = True, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows with tokens and posterior: the residuals of all steps, the domains' tokens, and the targets."""
    k = len(DOMAINS)
    own = members.agg(*(F.coalesce(F.sum(F.col("tokens") * F.col("posterior")[c]), F.lit(0.0)) for c in range(k))).first()
    own = np.array(own, dtype=float)
    want = target_tokens(own, targets, repeat)
    scale = np.maximum(np.maximum(own, want), 1.0)
    past, aim, before = np.zeros((0, k)), want.copy(), np.full(k, np.inf)
    for _ in range(steps):

        def run(batches: Iterator[pa.RecordBatch], past=past) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k)
            for b in batches:
                p = b.column(1).flatten().to_numpy().reshape(-1, k)
                total += (b.column(0).to_numpy() * replay(p, past, ridge)[1]) @ p
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=[f"s{c}" for c in range(k)])

        parts = members.select("tokens", "posterior").mapInArrow(run, ", ".join(f"s{c} double" for c in range(k)))
        sums = np.array(parts.agg(*(F.coalesce(F.sum(f"s{c}"), F.lit(0.0)) for c in range(k))).first(), dtype=float)
        gap, change = want - sums, np.abs(sums - before) / scale
        if len(past) > 2 and (np.abs(gap) <= NEAR * np.maximum(want, 1.0)).all() and change.max() < SETTLED:
            break
        if change.max() < MOVE * (np.abs(gap) / scale).max():
            aim = aim + gap
        before, past = sums, np.vstack((past, (sums - aim) / scale))
    return past, own, want


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, sample: int = SAMPLE, seed: int = 10, repeat: bool = True) -> DataFrame:
    """docs with tokens, posterior, rate and copies.

    copies is the whole part of the rate, plus one with the chance of its fraction (by a seeded hash of doc_id and text).
    """
    names = [c for c in docs.columns if c not in ("tokens", "posterior", "rate", "copies")]
    members = materialize(posteriors(docs.select(*names), train(docs, labels, sample)), "posteriors")
    past, _, _ = fit_rates(members, targets or TARGETS, repeat)
    schema = T.StructType([*members.schema.fields, T.StructField("rate", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(b.schema.get_field_index("posterior")).flatten().to_numpy().reshape(-1, len(DOMAINS))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(replay(p, past, RIDGE)[0])], names=[*b.schema.names, "rate"])

    rated = members.mapInArrow(run, schema)
    chance = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) / F.lit(float(1 << 53))).cast("double")
    return rated.withColumn("copies", F.floor("rate").cast("int") + (chance < F.col("rate") - F.floor("rate")).cast("int"))


def domain_totals(mixed: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Of mix()'s rows: for each domain its own expected tokens, those of the target, those at the fitted rates, and the shortfall."""
    sums = [F.coalesce(F.sum(F.col("tokens") * F.col("posterior")[c] * r), F.lit(0.0)) for r in (F.lit(1.0), F.col("rate")) for c in range(len(DOMAINS))]
    got = np.array(mixed.agg(*(x.alias(f"s{i}") for i, x in enumerate(sums))).first(), dtype=float).reshape(2, -1)
    want = target_tokens(got[0], targets or TARGETS)
    rows = [(d, *map(float, x)) for d, *x in zip(DOMAINS, got[0], want, got[1], want - got[1], strict=True)]
    return mixed.sparkSession.createDataFrame(rows, "domain string, own_tokens double, target_tokens double, fitted_tokens double, shortfall double")
