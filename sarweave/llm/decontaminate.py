"""Benchmark decontamination by SimHash of item-sized windows.

Texts are sequences of five-word shingles (A-Z taken as a-z). For each item length, every window of that
many words with at least one shingle of the benchmark (no other can be similar) gets a 64-bit
SimHash, in which each shingle weighs as often as it occurs. Fingerprints are cut into four
blocks of 16 bits; two fingerprints within RADIUS bits differ by at most a quarter of it in some
block, so that tables of all block values so near to an item's give every item within the radius.
Candidates within it are verified by the weighted shingle similarity, the sum of
least counts over the sum of greatest, of the window and the item.

A pair at the threshold is beyond the radius with a chance near 1e-5 per window of plain edits, but often
where a long passage repeats a word, since shingles weigh by their count. So windows with as many
of a group's shingles as the threshold needs are verified too, with the items that have so many of
them; no pair at the threshold is lost.

Items of fewer than five words are one shingle of their length and match exactly. A
text shorter than an item is one window. Items without words match nothing; neither do null and
empty texts. Items with null ids are searched, each for itself, and give leaks with a null item_id. Rows are judged one by one, repeated ones alike, and keep all their columns; a column named leaks is
replaced. Items are taken in blocks of bounded size, each passed over all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarweave.llm import kernels as K
from sarweave.session import text_batches

SHINGLE = 5
RADIUS = 23
SIMILARITY = 0.8
#: Items of one length that share tables, and such groups in a block (2 MB of tables each).
GROUP_ITEMS = 64
BLOCK_GROUPS = 48
LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("similarity", T.DoubleType())]))


def near_values(distance: int) -> np.ndarray:
    """All 16-bit masks of at most distance bits."""
    return np.array([sum(1 << b for b in bits) for d in range(distance + 1) for bits in combinations(range(16), d)], dtype=np.uint16)


def bit_sums(grams: np.ndarray) -> np.ndarray:
    """Prefix sums, for each of 64 bits, of +1 where it is set and -1 where not (modulo 2**32)."""
    bits = np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    out = np.zeros((len(grams) + 1, 64), dtype=np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=out[1:])
    return out


def simhash(sums: np.ndarray, start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    """Fingerprints of the windows of count shingles at start."""
    out = np.empty(len(start), dtype=np.uint64)
    for i in range(0, len(start), 8192):
        s = start[i : i + 8192]
        c = count if np.isscalar(count) else count[i : i + 8192]
        out[i : i + 8192] = np.packbits(sums[s + c] > sums[s], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


class Group:
    """Items of one length in words, with the tables that find those near to a fingerprint."""

    def __init__(self, n_words: int, items: list[tuple[object, np.ndarray]], radius: int):
        self.n_words, self.k = n_words, min(SHINGLE, n_words)
        self.ids = [i for i, _ in items]
        self.counts = [Counter(g.tolist()) for _, g in items]
        self.shingles = n_words - self.k + 1
        self.prints = np.array([simhash(bit_sums(g), np.array([0]), self.shingles)[0] for _, g in items], dtype=np.uint64)
        self.has: dict[int, list[int]] = {}
        for i, c in enumerate(self.counts):
            for x in c:
                self.has.setdefault(x, []).append(i)
        self.own = np.sort(np.array(list(self.has), dtype=np.uint64))
        self.radius = radius
        self.tables = np.zeros((4, 1 << 16), dtype=np.uint64)
        masks = near_values(radius // 4)
        for i, p in enumerate(self.prints):
            for b in range(4):
                self.tables[b][masks ^ np.uint16((int(p) >> 16 * b) & 0xFFFF)] |= K.U(1 << i)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items whose fingerprints are within the radius."""
        blocks = prints.view(np.uint16).reshape(-1, 4)
        hit = self.tables[0][blocks[:, 0]]
        for b in range(1, 4):
            hit = hit | self.tables[b][blocks[:, b]]
        some = np.flatnonzero(hit)
        w, i = [], []
        for item in range(len(self.ids)):
            at = some[(hit[some] >> K.U(item)) & K.U(1) > 0]
            at = at[np.bitwise_count(prints[at] ^ self.prints[item]) <= self.radius]
            w.append(at)
            i.append(np.full(len(at), item))
        return np.concatenate(w), np.concatenate(i)

    def sharing(self, g: np.ndarray, some: np.ndarray, start: np.ndarray, count: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
        """Windows and items that share as many shingles as the similarity needs; some are the places of known ones."""
        mine = some[np.isin(g[some], self.own)]
        if not len(mine):
            return
        need = np.ceil(least * (count + self.shingles) / (1 + least) - 1e-9)
        got = np.zeros(len(g) + 1, dtype=np.int32)
        got[mine + 1] = 1
        np.cumsum(got, out=got)
        before = None
        for w in np.flatnonzero(got[start + count] - got[start] >= np.maximum(need, 1)).tolist():
            window = g[start[w] : start[w] + count[w]]
            # The same window one place on is not better.
            if before is not None and np.array_equal(window, before):
                continue
            before = window
            votes: Counter = Counter()
            for x, n in Counter(window.tolist()).items():
                for i in self.has.get(x, ()):
                    votes[i] += min(n, self.counts[i][x])
            yield from ((w, i) for i, n in votes.items() if n >= need[w])


class Block:
    """Groups of items, and by shingle length the hashes of all their shingles."""

    def __init__(self, groups: list[Group]):
        self.groups = groups
        self.known, self.bloom = {}, {}
        for k in {g.k for g in groups}:
            self.known[k] = np.unique(np.array([x for g in groups if g.k == k for c in g.counts for x in c], dtype=np.uint64))
            self.bloom[k] = np.zeros(1 << 20, dtype=bool)
            self.bloom[k][self.known[k] & K.U((1 << 20) - 1)] = True

    def hits(self, grams: np.ndarray, k: int) -> np.ndarray:
        out = self.bloom[k][grams & K.U((1 << 20) - 1)]
        at = np.flatnonzero(out)
        known = self.known[k]
        out[at] = known[np.minimum(np.searchsorted(known, grams[at]), len(known) - 1)] == grams[at]
        return out

    def find(self, data: np.ndarray, offsets: np.ndarray, least: float) -> dict[int, list[dict]]:
        """By row of the texts its leaks: for each item its best window."""
        starts, ends, bounds = K.words(data, offsets)
        values = K.word_hashes(data, starts, ends, lower=True)
        best: dict[tuple[int, tuple[int, int]], tuple[float, int, int]] = {}
        for k, known in self.known.items():
            grams = K.gram_hashes(values, k)
            if not len(grams) or not len(known):
                continue
            hit = self.hits(grams, k)
            # A shingle that runs over the end of a text belongs to none.
            last = np.repeat(bounds[1:] - k, np.diff(bounds))[: len(grams)]
            hit &= np.arange(len(grams)) <= last
            if not hit.any():
                continue
            # Only texts with a hit are gone through, laid side by side.
            doc_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            docs = np.unique(doc_of[np.flatnonzero(hit)])
            n = bounds[docs + 1] - k + 1 - bounds[docs]
            base = np.cumsum(n) - n
            take = np.arange(n.sum()) + np.repeat(bounds[docs] - base, n)
            g, h = grams[take], hit[take]
            sums = bit_sums(g)
            so_far = np.concatenate(([0], np.cumsum(h)))
            some = np.flatnonzero(h)
            of = np.repeat(np.arange(len(docs)), n)
            room = np.repeat(base + n, n) - np.arange(len(take))
            for group in (x for x in self.groups if x.k == k):
                m = group.shingles
                full = np.flatnonzero((room >= m) & (so_far[np.minimum(np.arange(len(g)) + m, len(g))] > so_far[:-1]))
                short = base[n < m]
                at = np.concatenate((full, short))
                count = np.concatenate((np.full(len(full), m), n[n < m]))
                pairs = list(zip(*(x.tolist() for x in group.near(simhash(sums, at, count))), strict=True))
                for w, i in dict.fromkeys(chain(pairs, group.sharing(g, some, at, count, least))):
                    s, c = int(at[w]), int(count[w])
                    got, want = Counter(g[s : s + c].tolist()), group.counts[i]
                    both = (got & want).total()
                    sim = both / (c + group.shingles - both)
                    if sim >= least:
                        d = int(docs[of[s]])
                        key, new = (d, group.ids[i]), (sim, int(base[of[s]]) - s, c + k - 1)
                        if new > best.get(key, (0.0, 0, 0)):
                            best[key] = new
        out: dict[int, list[dict]] = {}
        for (d, item), (sim, start, words) in sorted(best.items()):
            out.setdefault(d, []).append({"item_id": item[1] if item[0] == 0 else None, "start_word": -start, "n_words": words, "similarity": sim})
        return out


def blocks(benchmark: DataFrame, radius: int = RADIUS) -> Iterator[Block]:
    """The items in blocks of bounded size; items without words are left out. Their ids are (0, item_id), or (1, a number) where it is null."""
    groups: list[Group] = []
    same: list[tuple[int, np.ndarray]] = []
    length = 0
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    rows = rows.select("*", F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("n")).where("n > 0").orderBy("n", "item_id", "text")
    for number, r in enumerate(rows.toLocalIterator()):
        if same and (r.n != length or len(same) == GROUP_ITEMS):
            groups.append(Group(length, same, radius))
            same = []
        if len(groups) == BLOCK_GROUPS:
            yield Block(groups)
            groups = []
        length = r.n
        raw = np.frombuffer(r.text.encode(), np.uint8)
        starts, ends, _ = K.words(raw, np.array([0, len(raw)]))
        same.append(((0, r.item_id) if r.item_id is not None else (1, number), K.gram_hashes(K.word_hashes(raw, starts, ends, lower=True), min(SHINGLE, r.n))))
    if same:
        groups.append(Group(length, same, radius))
    if groups:
        yield Block(groups)


def flag_leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """docs with a column leaks: for each item found its best window as (item_id, start_word, n_words, similarity)."""
    text_batches(docs.sparkSession)
    docs = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAK))
    for block in blocks(benchmark, radius):
        handle = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = b.schema.get_field_index("leaks")
                data, offsets = K.text_bytes(b.column(b.schema.get_field_index("text")))
                for i, j in K.pieces(offsets):
                    found = handle.value.find(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least)
                    part = b.slice(i, j - i)
                    if found:
                        before = part.column(at).to_pylist()
                        part = part.set_column(at, b.schema.field(at), pa.array([x + found.get(r, []) for r, x in enumerate(before)], b.schema.field(at).type))
                    yield part

        docs = docs.mapInArrow(run, docs.schema)
    return docs
