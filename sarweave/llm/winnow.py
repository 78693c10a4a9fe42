"""Finding repeated strings of a fixed length in all documents, exactly and without quadratic work.

A window is W neighbouring tokens (words or bytes). Its anchor is the least of its k-token grams
by hash, the leftmost of equals, so that equal windows have equal anchors at equal offsets.
Neighbouring windows that share an anchor form a segment, some 2 / (W - k + 2) of them per token;
two equal windows never lie in one segment. Each segment is known by a 128-bit digest of its
tokens (its content), so that copies are settled by counting contents: only contents that share
an anchor with other contents are compared window by window, in shards that hold all contents of
an anchor. An anchor with more windows than a shard should hold is settled by digests of single
windows instead, which Spark aggregates on both sides of the shuffle.

Rows are known by rank (doc_id, or the greatest long for null, so that no document comes after
one without an id) and a hash of the text; rows equal in both are the same document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarweave.llm import kernels as K
from sarweave.session import drop_materialized, materialize, release, text_batches

#: Bits of a place in a batch; a text holds fewer bytes than that.
PLACE = K.U((1 << 31) - 1)
LAST = 2**63 - 1


@dataclass(frozen=True)
class Scheme:
    """What a token is, and how long windows and grams are."""

    unit: str
    window: int
    gram: int
    #: Windows that one shard holds, and beyond which an anchor is settled by digests.
    shard_windows: int

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token values, token bounds of the texts, byte starts and byte ends of the tokens."""
        if self.unit == "words":
            starts, ends, bounds = K.words(data, offsets)
            return K.word_hashes(data, starts, ends), bounds, starts, ends
        at = np.arange(len(data))
        return K.TABLE[data], offsets, at, at + 1


def segments(values: np.ndarray, bounds: np.ndarray, s: Scheme) -> dict[str, np.ndarray]:
    """Per segment: doc (index), pos (first window, from its document), wins, reps (equal neighbours merged), at (offset of the anchor), anchor, c1, c2."""
    n = len(values) - s.window + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return dict.fromkeys(("doc", "pos", "wins", "reps", "at", "anchor", "c1", "c2"), none)
    one = K.RangeHash(values, 0)
    places = np.arange(len(values) - s.gram + 1)
    grams = one.of(places, places + s.gram)
    least = K.sliding_min((grams & ~PLACE) | places.astype(np.uint64), s.window - s.gram + 1)
    place = (least & PLACE).astype(np.int64)
    first = np.zeros(n, dtype=bool)
    first[0] = True
    first[1:] = place[1:] != place[:-1]
    edges = np.concatenate((bounds[:-1], bounds[1:] - s.window + 1))
    first[edges[(edges >= 0) & (edges < n)]] = True
    start = np.flatnonzero(first)
    wins = np.diff(np.append(start, n))
    doc = np.searchsorted(bounds, start, side="right") - 1
    ok = start + s.window <= bounds[doc + 1]
    start, wins, doc = start[ok], wins[ok], doc[ok]
    end = start + wins + s.window - 1
    c1, c2 = one.of(start, end), K.RangeHash(values, 1).of(start, end)
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(fresh)
    return {
        "doc": doc[at], "pos": (start - bounds[doc])[at], "wins": wins[at], "reps": np.diff(np.append(at, len(start))),
        "at": (place[start] - start)[at], "anchor": K.signed(grams[place[start]])[at], "c1": K.signed(c1)[at], "c2": K.signed(c2)[at],
    }


def ranked(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the key of a row: rank and th."""
    text_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(text).alias("th"))


def scan(docs: DataFrame, s: Scheme) -> DataFrame:
    """All segments of ranked documents."""
    schema = "rank long, th long, pos int, wins int, reps int, at int, anchor long, c1 long, c2 long"
    ints = {"pos", "wins", "reps", "at"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(0))
            keys = [b.column(i).to_numpy() for i in (1, 2)]
            for i, j in K.pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                values, bounds, *_ = s.tokens(part, offsets[i : j + 1] - offsets[i])
                g = segments(values, bounds, s)
                cols = [k[i:j][g["doc"]] for k in keys]
                cols += [g[c].astype(np.int32) if c in ints else g[c] for c in ("pos", "wins", "reps", "at", "anchor", "c1", "c2")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["rank", "th", "pos", "wins", "reps", "at", "anchor", "c1", "c2"])

    return docs.select("text", "rank", "th").mapInArrow(run, schema)


def _windows(s: Scheme) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each content its windows: i (from the start of the content) and two digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(b.schema.get_field_index("body")))
            for i, j in K.pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                values, bounds, *_ = s.tokens(part, offsets[i : j + 1] - offsets[i])
                counts = np.diff(bounds) - s.window + 1
                of = np.repeat(np.arange(j - i), counts)
                k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = bounds[:-1][of] + k
                w = [K.signed(K.RangeHash(values, lane).of(start, start + s.window)) for lane in (0, 1)]
                rows = b.slice(i, j - i).take(pa.array(of))
                at = [rows.column(rows.schema.get_field_index(c)) for c in ("c1", "c2", "first", "n")]
                yield pa.RecordBatch.from_arrays([*at, pa.array(k.astype(np.int32)), *map(pa.array, w)], names=["c1", "c2", "first", "n", "i", "w1", "w2"])

    return run


def letters(values: np.ndarray) -> np.ndarray:
    """A letter for each word: 20 bits of its hash."""
    return (values >> K.U(44)).astype(np.int64)


def fetch(docs: DataFrame, wanted: DataFrame, s: Scheme, carry: dict[str, str], phrase: bool = False) -> DataFrame:
    """The tokens of contents, as body, and what is carried of wanted: rank, th and an array segs of pos, wins, at and more.

    carry: names and types of the fields of segs to carry. Where a field open is false, body is null. phrase: adds p1
    and p2, the letters of the anchor, up to three in each.
    """
    schema = ", ".join(f"{n} {t}" for n, t in (carry | ({"p1": "long", "p2": "long"} if phrase else {}) | {"body": "binary"}).items())
    names = [*carry, *(("p1", "p2") if phrase else ()), "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(0))
            lists, flat = b.column(1).offsets.to_numpy(), b.column(1).flatten()
            lists = lists - lists[0]
            col = {f.name: flat.field(k) for k, f in enumerate(flat.type)}
            pos, wins, at = (col[c].to_numpy() for c in ("pos", "wins", "at"))
            is_open = col["open"].to_numpy(zero_copy_only=False) if "open" in col else np.ones(len(flat), dtype=bool)
            for i, j in K.pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                values, bounds, starts, ends = s.tokens(part, offsets[i : j + 1] - offsets[i])
                lo, hi = int(lists[i]), int(lists[j])
                doc = np.repeat(np.arange(j - i), np.diff(lists[i : j + 1]))
                first = bounds[doc] + pos[lo:hi]
                raw = part.tobytes()
                a, z = starts[first], ends[first + wins[lo:hi] + s.window - 2]
                for p in range(0, hi - lo, 20_000):
                    q = min(p + 20_000, hi - lo)
                    out = [col[c].slice(lo + p, q - p) for c in carry]
                    if phrase:
                        out += [pa.array(x) for x in phrases(values, first[p:q] + at[lo + p : lo + q], s.gram)]
                    body = [raw[x:y] if o else None for x, y, o in zip(a[p:q].tolist(), z[p:q].tolist(), is_open[lo + p : lo + q].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*out, pa.array(body, pa.binary())], names=names)

    joined = docs.join(wanted, ["rank", "th"]).select("text", "segs")
    return joined.mapInArrow(run, schema)


def phrases(values: np.ndarray, place: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The letters of the grams at places, three in a long."""
    out = np.zeros((2, len(place)), dtype=np.int64)
    for k in range(gram):
        out[k // 3] |= letters(values[place + k]) << (20 * (k % 3))
    return out[0], out[1]


def shard_groups(bodies: DataFrame, s: Scheme, in_shard: Callable[[pa.Table], pa.Table], by_digest: Column) -> DataFrame:
    """c1, c2, b and e: ranges of windows that in_shard finds among the contents (with anchor and windows) of each shard.

    All contents of an anchor meet in one shard. Those of an anchor with more windows than a shard should hold are
    told apart by digests of single windows instead: by_digest, over first and n of a content's window and least
    and total of all equal ones.
    """
    spark = bodies.sparkSession
    sizes = bodies.groupBy("anchor").agg(F.max("windows").alias("windows"))
    total, largest = sizes.agg(F.sum("windows"), F.max("windows")).first()
    n_shards = max(1, -(-(total or 0) // s.shard_windows), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    few = F.col("windows") <= s.shard_windows
    shared = bodies.where(few).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n_shards)))
    found = shared.groupBy("shard").applyInArrow(lambda t: in_shard(t), "c1 long, c2 long, b int, e int")
    if (largest or 0) > s.shard_windows:
        each = bodies.where(~few).mapInArrow(_windows(s), "c1 long, c2 long, first long, n long, i int, w1 long, w2 long")
        each = materialize(each, "windows")
        equal = each.groupBy("w1", "w2").agg(F.min("first").alias("least"), F.sum("n").alias("total"))
        found = found.unionByName(each.join(equal, ["w1", "w2"]).where(by_digest).select("c1", "c2", F.col("i").alias("b"), (F.col("i") + 1).alias("e")))
    return found


def collapsed(docs: DataFrame, limit: int) -> tuple[DataFrame, int, bool]:
    """Ranked docs with copies, their bytes, and whether rows were put together: those that repeat one row for more than limit bytes."""
    size = F.sum(F.octet_length("text").cast("long") + 1)
    sizes = docs.groupBy("rank", "th").agg(size.alias("bytes"), F.count("*").alias("n"))
    total, largest = sizes.agg(F.sum("bytes"), F.max(F.when(F.col("n") > 1, F.col("bytes")))).first()
    if (largest or 0) <= limit:
        return docs.withColumn("copies", F.lit(1).cast("long")), total or 0, False
    hot = materialize(sizes.where((F.col("bytes") > limit) & (F.col("n") > 1)).select("rank", "th"), "repeated-rows")
    same = docs.join(hot, ["rank", "th"], "left_semi").groupBy("doc_id", "rank", "th").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    rest = docs.join(hot, ["rank", "th"], "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return rest.unionByName(same), total, True


def repeats(
    docs: DataFrame,
    s: Scheme,
    settled: Column,
    is_open: Column,
    anchor_open: Column,
    in_shard: Callable[[pa.Table], pa.Table],
    by_digest: Column,
) -> DataFrame:
    """Of ranked docs: rank, th and spans, an array of (b, e), ranges of the windows that go.

    settled, over cand: all windows of the row go. is_open, over cand: its windows are to be compared
    with those of other contents of the anchor. anchor_open, over the sums of an anchor: it
    has open contents. in_shard: of a shard's contents (anchor, at, c1, c2, first, n, body) gives c1, c2,
    b, e. by_digest, over first and n of a content's window and least and total of all equal ones: it goes.
    """
    spark = docs.sparkSession
    every = materialize(scan(docs, s), "segments")
    twice = every.groupBy("anchor").agg(F.sum("reps").alias("copies")).where("copies >= 2").select("anchor")
    rows = materialize(every.join(twice, "anchor", "left_semi"), "repeated")
    drop_materialized(every)
    release(spark)
    least = F.min(F.struct("rank", "th", "pos"))
    contents = rows.groupBy("c1", "c2").agg(
        F.min("anchor").alias("anchor"), least.alias("owner"), F.max("rank").alias("last"), F.sum("reps").alias("n"), F.min("wins").alias("wins")
    )
    contents = materialize(contents, "contents")
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum("wins").alias("windows"), F.min("n").alias("fewest"))
    # Written first, so that the join's two sides are plain shuffles, whose hot anchors Spark can split.
    anchors = materialize(anchors.select("anchor", "windows", ((F.col("contents") >= 2) & anchor_open).alias("mixed")), "anchors")
    live = materialize(contents.join(anchors, "anchor").select("c1", "c2", "owner", "n", "mixed", "windows"), "live")
    cand = materialize(rows.join(live, ["c1", "c2"]), "candidates")
    for done in (rows, contents, anchors, live):
        drop_materialized(done)
    release(spark)
    segs = F.collect_set(F.struct("pos", "wins", "at", "anchor", "windows", "c1", "c2", F.col("owner.rank").alias("first"), "n"))
    owners = cand.where("mixed AND rank = owner.rank AND th = owner.th AND pos = owner.pos")
    carry = {"anchor": "long", "windows": "long", "at": "int", "c1": "long", "c2": "long", "first": "long", "n": "long"}
    bodies = materialize(fetch(docs, owners.groupBy("rank", "th").agg(segs.alias("segs")), s, carry), "bodies")
    release(spark)
    found = shard_groups(bodies, s, in_shard, by_digest)
    full = cand.where(settled).select("rank", "th", F.col("pos").alias("b"), (F.col("pos") + F.col("wins") * F.col("reps")).alias("e"))
    opened = cand.where(F.col("mixed") & is_open).select("c1", "c2", "rank", "th", F.explode(F.transform(F.sequence(F.lit(0), F.col("reps") - 1), lambda r: F.col("pos") + r * F.col("wins"))).alias("pos"))
    some = opened.join(found, ["c1", "c2"]).select("rank", "th", (F.col("pos") + F.col("b")).alias("b"), (F.col("pos") + F.col("e")).alias("e"))
    return full.unionByName(some).groupBy("rank", "th").agg(F.collect_set(F.struct("b", "e")).alias("spans"))


def apply_spans(docs: DataFrame, spans: DataFrame, s: Scheme, kept: Callable[[bytes, np.ndarray, np.ndarray, np.ndarray], tuple], schema: str, names: list[str], types: list[pa.DataType]) -> DataFrame:
    """doc_id and what kept(text, removed, starts, ends) gives for each text; removed: True for tokens that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            ids, lists = b.column(0), b.column(2)
            at = lists.offsets.to_numpy()
            flat = lists.flatten()
            at = at - at[0]
            begin, end = (flat.field(k).to_numpy() for k in (0, 1))
            for i, j in K.pieces(offsets, 8 * K.CHUNK_BYTES):
                out = []
                for r in range(i, j):
                    text = data[offsets[r] : offsets[r + 1]]
                    lo, hi = at[r], at[r + 1]
                    if lo == hi:
                        out.append(kept(text.tobytes(), None, None, None))
                        continue
                    _, bounds, starts, ends = s.tokens(text, np.array([0, len(text)]))
                    edge = np.zeros(bounds[1] + 1, np.int32)
                    np.add.at(edge, begin[lo:hi], 1)
                    np.add.at(edge, end[lo:hi] + s.window - 1, -1)
                    out.append(kept(text.tobytes(), np.cumsum(edge[:-1]) > 0, starts, ends))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], names=["doc_id", *names])

    joined = docs.join(spans, ["rank", "th"], "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<b:int,e:int>>")).alias("spans"))
    return joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")
