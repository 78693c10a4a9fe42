"""Substring dedup: words covered by 50-word windows that an earlier document also has go.

Recurring passages are proposed by winnowing (see winnow) and confirmed: a content that occurs in documents of
different doc_ids recurs whole; of contents that share an anchor phrase with different ones the windows
are compared in shards. A confirmed passage is known by its anchor phrase, its place around it, a 128-bit
digest of its words, the least doc_id that has it, and the ranges of windows that have come before that one.

Documents are dealt to shards of bounded bytes by a hash, and each passage to the shards that have a document
with it. There the phrases are compiled into an Aho-Corasick automaton over words (each word a letter) and all
documents of the shard stream through it, whole. Only its occurrences propose places: around each the
words are checked against the passages of the phrase, and those of a passage that a smaller doc_id has go.
Windows are judged on the input. A phrase with any number of passages or occurrences is treated alike.

Nulls and empty texts have no words. A null doc_id counts as greater than all others, equal to
other nulls. Rows with the same doc_id never remove each other's words; rows equal in doc_id and text are
worked on once where they are many. Of all columns doc_id is carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarweave.llm import kernels as K
from sarweave.llm import winnow
from sarweave.session import drop_materialized, materialize, release

WINDOW = 50
GRAM = 6
#: Text bytes of the documents of a shard.
SHARD_BYTES = 16 << 20
PASSAGE = {"p1": "long", "p2": "long", "at": "int", "wins": "int", "c1": "long", "c2": "long", "first": "long", "runs": "array<struct<b:int,e:int>>"}


def equal_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by keys, and in this order the number of the group of equals."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def confirm(scheme: winnow.Scheme):
    """Of the contents of a shard of anchors: the ranges of windows that a smaller doc_id than the content's first one has."""
    w = scheme.window

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        data, offsets = K.text_bytes(t["body"])
        values, bounds, *_ = scheme.tokens(data, offsets)
        first = t["first"].to_numpy()
        counts = np.diff(bounds) - w + 1
        of = np.repeat(np.arange(len(first)), counts)
        base = np.cumsum(counts) - counts
        start = np.arange(len(of)) - base[of] + bounds[:-1][of]
        order, group = equal_groups(*(K.RangeHash(values, lane).of(start, start + w) for lane in (0, 1)))
        owner = np.full(group[-1] + 1 if len(group) else 0, winnow.LAST)
        np.minimum.at(owner, group, first[of[order]])
        goes = np.zeros(len(of), dtype=bool)
        goes[order] = owner[group] < first[of[order]]
        edge = np.flatnonzero(np.diff(of)) + 1
        begin, stop = K.runs_of(np.insert(goes, edge, False)) if len(goes) else (np.empty(0, int), np.empty(0, int))
        # Inserted gaps keep runs of different contents apart; take them out of the places again.
        shift = np.arange(len(edge)) + edge
        begin, stop = begin - np.searchsorted(shift, begin), stop - np.searchsorted(shift, stop - 1)
        d = of[begin] if len(begin) else np.empty(0, int)
        return pa.table({"c1": t["c1"].take(pa.array(d)), "c2": t["c2"].take(pa.array(d)), "b": pa.array((begin - base[d]).astype(np.int32)), "e": pa.array((stop - base[d]).astype(np.int32))})

    return run


def as_text(letters: np.ndarray) -> str:
    """Letters from the planes above the first."""
    return (letters + 0x10000).astype(np.uint32).tobytes().decode("utf-32-le")


class Passages:
    """The confirmed passages of a shard: an automaton of their phrases, and what tells the passages of a phrase apart."""

    def __init__(self, t: pa.Table | None, scheme: winnow.Scheme):
        self.scheme, self.automaton = scheme, ahocorasick.Automaton()
        if t is None or not len(t):
            return
        t = t.combine_chunks()
        col = {c: t[c].combine_chunks().to_numpy() for c in PASSAGE if c != "runs"}
        self.by_digest = np.argsort(col["c1"])
        self.c1, self.c2, self.first = (col[c][self.by_digest] for c in ("c1", "c2", "first"))
        runs = t["runs"].combine_chunks()
        ends = np.cumsum(np.diff(runs.offsets.to_numpy()))
        self.run_end, self.run_begin = ends[self.by_digest], (ends - np.diff(runs.offsets.to_numpy()))[self.by_digest]
        self.b, self.e = (runs.flatten().field(k).to_numpy() for k in (0, 1))
        # The distinct places of passages around each phrase.
        order = np.lexsort((col["wins"], col["at"], col["p2"], col["p1"]))
        keys = np.stack([col[c][order].astype(np.int64) for c in ("p1", "p2", "at", "wins")])
        new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
        p1, p2, self.at, self.wins = keys[:, new]
        head = np.append(True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]))
        self.shape_begin = np.flatnonzero(head)
        self.shapes = np.diff(np.append(self.shape_begin, len(p1)))
        k = scheme.gram
        table = np.stack([((p1, p2)[j // 3][head] >> (20 * (j % 3))) & 0xFFFFF for j in range(k)], axis=1)
        text = as_text(table.ravel())
        for i in range(len(self.shape_begin)):
            self.automaton.add_word(text[i * k : i * k + k], i)
        self.automaton.make_automaton()

    def removed(self, values: np.ndarray, bounds: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """For the words of texts, one after another, whether they go."""
        edge = np.zeros(len(values) + 1, np.int32)
        if not len(self.automaton):
            return edge[:-1] > 0
        w, k = self.scheme.window, self.scheme.gram
        text = as_text(winnow.letters(values))
        ends, what, n = [], [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            before = len(ends)
            if hi - lo >= w:
                for end, phrase in self.automaton.iter(text[lo:hi]):
                    ends.append(lo + end)
                    what.append(phrase)
            n.append(len(ends) - before)
        place, phrase = np.array(ends, dtype=np.int64) - k + 1, np.array(what, dtype=np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        one, two = (K.RangeHash(values, lane) for lane in (0, 1))
        # A phrase has few shapes as a rule, and 1000 or so at most; occurrences are taken in pieces for those.
        upto = np.cumsum(self.shapes[phrase]) if len(phrase) else np.empty(0, np.int64)
        cuts = np.append(np.unique(np.searchsorted(upto, np.arange(0, upto[-1], 1 << 18), side="right")), len(phrase)) if len(phrase) else []
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            many = self.shapes[phrase[x:y]]
            hit = np.repeat(np.arange(x, y), many)
            shape = np.repeat(self.shape_begin[phrase[x:y]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            start = place[hit] - self.at[shape]
            stop = start + self.wins[shape] + w - 1
            inside = (start >= bounds[doc[hit]]) & (stop <= bounds[doc[hit] + 1])
            hit, start, stop = hit[inside], start[inside], stop[inside]
            c1 = K.signed(one.of(start, stop))
            m = np.minimum(np.searchsorted(self.c1, c1), len(self.c1) - 1)
            equal = self.c1[m] == c1
            hit, start, stop, m = hit[equal], start[equal], stop[equal], m[equal]
            equal = K.signed(two.of(start, stop)) == self.c2[m]
            hit, start, stop, m = hit[equal], start[equal], stop[equal], m[equal]
            mine = rank[doc[hit]]
            later = self.first[m] < mine
            np.add.at(edge, start[later], 1)
            np.add.at(edge, stop[later], -1)
            same = np.flatnonzero(self.first[m] == mine)
            many = (self.run_end - self.run_begin)[m[same]]
            r = np.repeat(self.run_begin[m[same]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            at = np.repeat(start[same], many)
            np.add.at(edge, at + self.b[r], 1)
            np.add.at(edge, at + self.e[r] + w - 1, -1)
        return np.cumsum(edge[:-1]) > 0


def locate(scheme: winnow.Scheme):
    """Of rows by shard, its passages before its documents: n_words, n_removed and kept of each document."""

    def documents(passages: Passages, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = K.text_bytes(b.column("text"))
        rank = b.column("rank").to_numpy()
        for i, j in K.pieces(offsets):
            part = data[offsets[i] : offsets[j]]
            values, bounds, *_ = scheme.tokens(part, offsets[i : j + 1] - offsets[i])
            gone = passages.removed(values, bounds, rank[i:j])
            total = np.concatenate(([0], np.cumsum(gone)))
            removed = total[bounds[1:]] - total[bounds[:-1]]
            kept = []
            for r, n in zip(range(i, j), removed.tolist(), strict=True):
                ws = data[offsets[r] : offsets[r + 1]].tobytes().split()
                if n:
                    ws = [ws[x] for x in np.flatnonzero(~gone[bounds[r - i] : bounds[r - i + 1]]).tolist()]
                kept.append(b" ".join(ws))
            ids = [b.column(c).slice(i, j - i) for c in ("doc_id", "copies")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(np.diff(bounds)), pa.array(removed), pa.array(kept, pa.binary())], names=["doc_id", "copies", "n_words", "n_removed", "kept"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, passages = None, [], None
        for b in batches:
            shard, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
                if lo == hi:
                    continue
                if shard[lo] != now:
                    now, parts, passages = shard[lo], [], None
                piece = b.slice(lo, hi - lo)
                if kind[lo] == 0:
                    parts.append(piece.select(list(PASSAGE)))
                    continue
                if passages is None:
                    passages, parts = Passages(pa.Table.from_batches(parts) if parts else None, scheme), []
                yield from documents(passages, piece)

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_windows: int = 20_000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, and kept: the words that stay, joined by one space, as UTF-8.

    gram: words of a phrase, six at most. shard_windows: windows that are compared in one task; see winnow.shard_groups.
    """
    spark = docs.sparkSession
    scheme = winnow.Scheme("words", window, gram, shard_windows)
    docs = winnow.ranked(docs)
    once, total, repeated = winnow.collapsed(docs, shard_bytes)
    n_shards = max(1, -(-total // shard_bytes))
    shard = F.pmod(F.xxhash64("rank", "th"), F.lit(n_shards)).cast("int").alias("shard")
    every = materialize(winnow.scan(docs, scheme), "segments")
    twice = every.groupBy("anchor").agg(F.min("rank").alias("lowest"), F.max("rank").alias("highest")).where("lowest < highest").select("anchor")
    keys = ["c1", "c2"]
    # For each content and shard of documents one row, so that a content that all documents have is not kept for each.
    held = every.join(twice, "anchor", "left_semi").groupBy(*keys, shard).agg(
        F.min(F.struct("rank", "th", "pos")).alias("owner"), F.max("rank").alias("last"), F.min("anchor").alias("anchor"), F.min("at").alias("at"), F.min("wins").alias("wins")
    )
    held = materialize(held, "held")
    drop_materialized(every)
    release(spark)
    contents = held.groupBy(*keys).agg(F.min("owner").alias("owner"), F.max("last").alias("last"), *(F.min(c).alias(c) for c in ("anchor", "at", "wins")))
    contents = materialize(contents, "contents")
    anchors = contents.groupBy("anchor").agg(F.sum("wins").alias("windows"), F.min("owner.rank").alias("lowest"), F.max("owner.rank").alias("newest"))
    anchors = materialize(anchors.select("anchor", "windows", (F.col("lowest") < F.col("newest")).alias("open")), "anchors")
    wanted = contents.join(anchors, "anchor").where(F.col("open") | (F.col("owner.rank") < F.col("last")))
    carry = {"anchor": "long", "windows": "long", "at": "int", "wins": "int", "c1": "long", "c2": "long", "first": "long", "last": "long", "open": "boolean"}
    segs = wanted.select("owner.rank", "owner.th", F.struct("owner.pos", F.col("owner.rank").alias("first"), *(c for c in carry if c != "first")).alias("seg"))
    bodies = winnow.fetch(once, segs.groupBy("rank", "th").agg(F.collect_list("seg").alias("segs")), scheme, carry, phrase=True)
    bodies = materialize(bodies, "bodies")
    for done in (contents, anchors):
        drop_materialized(done)
    release(spark)
    opened = bodies.where("open").withColumn("n", F.lit(1).cast("long"))
    found = winnow.shard_groups(opened, scheme, confirm(scheme), F.col("least") < F.col("first"))
    runs = found.groupBy(*keys).agg(F.collect_set(F.struct("b", "e")).alias("runs"))
    none = F.array().cast(PASSAGE["runs"])
    passages = bodies.drop("body").join(runs, keys, "left").withColumn("runs", F.coalesce("runs", none)).where((F.col("first") < F.col("last")) | (F.size("runs") > 0))
    passages = materialize(passages.select(*PASSAGE), "passages")
    drop_materialized(bodies)
    release(spark)
    dealt = held.select(*keys, "shard", F.col("owner.rank").alias("lowest"), "last").join(passages, keys)
    dealt = dealt.where((F.col("last") > F.col("first")) | ((F.col("lowest") == F.col("first")) & (F.size("runs") > 0)))
    dealt = dealt.select("shard", F.lit(0).alias("kind"), *PASSAGE)
    stream = once.select(shard, F.lit(1).alias("kind"), "doc_id", "rank", "copies", "text")
    rows = stream.unionByName(dealt, allowMissingColumns=True).repartitionById(n_shards, "shard").sortWithinPartitions("shard", "kind")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(locate(scheme), f"doc_id {kind}, copies long, n_words long, n_removed long, kept binary")
    if repeated:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select("doc_id", "n_words", "n_removed", "kept")
