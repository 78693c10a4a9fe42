"""MinHash near-dedup by an inverted join of signature coordinates.

A document is the set of its distinct five-word shingles; equal sets are one node. Nodes are posted
under each (coordinate, value) pair of a signature of K coordinates. Pairs of similarity s share
each coordinate with probability s; pairs with fewer than t matches are dropped, where t is so low
that a pair at the threshold has a chance of MISS to be lost. A pair with t matches must share
one of the K - t + 1 rarest coordinates of either node (the prefix, which also skips the long posting
lists), so that only those are joined; nodes with fewer than t coordinates that any other
node has take no part. Matches are counted on the whole signatures, and pairs that have t are
confirmed on the full sets.

Only components are wanted, so that pairs inside one are skipped: rounds first compare each node with
one leader of its lists and merge what is confirmed; at the end all pairs of lists that
still lie in different components are compared. Lists of up to LONG nodes are joined for that. Nodes
that share longer lists, such as texts around one boilerplate, are posted again, under the rarest
shingles of their full sets (as many as two sets at the threshold can't do without; shingles that no other of these
nodes has are skipped), which sends each node's set through one shuffle, however many nodes there are. Short lists
of these are joined like the others. What still shares long ones forms clusters, cut into blocks of bounded bytes;
each two blocks of a cluster meet in one task that merges the posting lists of their sets, counts
the matches of what these propose, and gives links only, one at most for each two components. Matches are counted
for every pair, whatever proposed it. No pair of texts above the threshold is left out.

A null or empty text has an empty set and is linked with nothing. A null doc_id ranks after all
others; its component_id is null if no document with an id is reached. Rows with equal sets are in
one component, and all rows that carry its least doc_id are kept. Of all columns doc_id is carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarweave.llm import kernels as K
from sarweave.llm.components import components
from sarweave.llm.winnow import LAST, ranked
from sarweave.session import Scratch, materialize

SHINGLE = 5
COORDINATES = 64
#: Chance to lose a pair that is just at the threshold.
MISS = 1e-7
#: Most rounds with leaders before all pairs that are left are compared.
ROUNDS = 2
#: Nodes of a posting list that may be paired by a join, and bytes of sets in a block of a cluster.
LONG = 12
BLOCK_BYTES = 16 << 20
_RNG = np.random.Generator(np.random.PCG64(64))
MASKS = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
FACTORS = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * K.U(2) + K.U(1)


def least_matches(similarity: float, k: int = COORDINATES, miss: float = MISS) -> int:
    """The greatest t for which a pair of this similarity has fewer than t of k matches with chance miss at most."""
    below, t = 0.0, 0
    while below + (p := comb(k, t) * similarity**t * (1 - similarity) ** (k - t)) <= miss:
        below, t = below + p, t + 1
    return t


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, A-Z taken as a-z; of fewer words the sequence."""
    starts, ends, bounds = K.words(data, offsets)
    values = K.word_hashes(data, starts, ends, lower=True)
    grams = K.gram_hashes(values, k)
    short = K.RangeHash(values)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(grams[lo : hi - k + 1]))
        else:
            out.append(short.of(np.array([lo]), np.array([hi])) if hi > lo else values[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of coordinates for each set (none may be empty): the value above, the coordinate in the low six bits."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), dtype=np.uint64)
    for c in range(COORDINATES):
        out[:, c] = (np.minimum.reduceat((flat ^ MASKS[c]) * FACTORS[c], at) & ~K.U(63)) | K.U(c)
    return out


def sign(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Of ranked docs: doc_id, rank, th, n (size of the set), s1 and s2 (digest of the set), sig."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, rank long, th long, n long, s1 long, s2 long, sig array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(0))
            for i, j in K.pieces(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                n = np.array([len(x) for x in sets])
                lanes = [np.array([K.mix(x ^ m).sum(dtype=np.uint64) if len(x) else 0 for x in sets], dtype=np.uint64) for m in MASKS[:2]]
                full = [x for x in sets if len(x)]
                sig = K.signed(signatures(full).ravel()) if full else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum((n > 0) * COORDINATES))).astype(np.int32)), pa.array(sig))
                cols = [b.column(c).slice(i, j - i) for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n), *(pa.array(K.signed(x)) for x in lanes), lists], names=["doc_id", "rank", "th", "n", "s1", "s2", "sig"])

    return docs.select("text", "doc_id", "rank", "th").mapInArrow(run, schema)


def full_sets(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Of ranked docs: rank, th and hashes, the sorted set as 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(0))
            for i, j in K.pieces(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), b.column(2).slice(i, j - i), pa.array([x.tobytes() for x in sets], pa.binary())], names=["rank", "th", "hashes"])

    return docs.select("text", "rank", "th").mapInArrow(run, "rank long, th long, hashes binary")


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, x, y) with sets x and y: a and b where 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(u) > len(v):
                    u, v = v, u
                if 100 * len(u) < percent * len(v):
                    ok.append(False)
                    continue
                at = np.searchsorted(v, u)
                both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                ok.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, pairs.select("a", "b").schema)


def _links(pairs: DataFrame, nodes: DataFrame, t: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those with t matches whose sets are similar enough."""
    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("p"), F.col("hashes").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("q"), F.col("hashes").alias("y"))
    both = pairs.join(right, "b").join(left, "a").where(F.size(F.array_intersect("p", "q")) >= t)
    return confirmed(both, percent)


def merged_links(sets: list[np.ndarray], sig: np.ndarray, comp: np.ndarray, left: int, same: bool, t: int, percent: int) -> list[tuple[int, int]]:
    """Links that join components among sets: of the first left ones with the others, or (same) of all with all.

    For each set the posting lists of its rarest shingles (its prefix) propose partners in other
    components. Of those with t matches or more of the signatures (rows of sig) overlaps are counted by merging all lists
    of the set, or set by set where few are proposed.
    """
    n = np.array([len(x) for x in sets])
    at = np.concatenate(([0], np.cumsum(n)))
    _, of, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    posted = np.repeat(np.arange(len(sets)), n)[np.argsort(of, kind="stable")]
    ends = np.cumsum(df)
    begins = ends - df
    up = np.arange(comp.max() + 1)

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    out = []
    for x in range(len(sets) if same else left):
        mine = of[at[x] : at[x + 1]]
        order = mine[np.argsort(df[mine], kind="stable")]
        prefix = order[: len(order) + (-percent * len(order) // 100) + 1]
        near = np.unique(np.concatenate([posted[begins[k] : ends[k]] for k in prefix]))
        near = near[(near > x) if same else (near >= left)]
        near = near[(100 * n[near] >= percent * n[x]) & (100 * n[x] >= percent * n[near]) & (comp[near] != comp[x])]
        near = near[(sig[near] == sig[x]).sum(axis=1) >= t]
        if not len(near):
            continue
        if len(near) > 24:
            both = np.bincount(np.concatenate([posted[begins[k] : ends[k]] for k in mine]), minlength=len(sets))[near]
        else:
            both = np.array([np.isin(mine, of[at[y] : at[y + 1]], assume_unique=True).sum() for y in near])
        for y in near[100 * both >= percent * (n[x] + n[near] - both)].tolist():
            a, b = root(comp[x]), root(comp[y])
            if a != b:
                up[a] = b
                out.append((x, y))
    return out


def _mixed(at: DataFrame) -> DataFrame:
    """Of posting lists (key, node, comp) those with several components: key, lead (least comp and its least node), length.

    Written, so that its join with the lists has two plain shuffles, whose long lists Spark can split.
    """
    lists = at.groupBy("key").agg(F.min(F.struct("comp", "node")).alias("lead"), F.max("comp").alias("high"), F.count("*").alias("length"))
    return materialize(lists.where("lead.comp < high").select("key", "lead", "length"), "mixed")


def _set_lists(long: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """For the nodes of long lists: key, node and comp, posted under the rarest shingles of their full sets.

    Two sets at the threshold share one of the n - ceil(percent * n / 100) + 1 rarest of either; of these, shingles
    that no other of the nodes has are left out.
    """
    members = materialize(long.select("node", "comp").distinct().join(nodes.select("node", "hashes"), "node"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = K.text_bytes(b.column(1))
            lists = pa.ListArray.from_arrays(pa.array((offsets // 8).astype(np.int32)), pa.array(data.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["node", "keys"])

    each = members.select("node", "hashes").mapInArrow(run, "node struct<rank:long,th:long>, keys array<long>").select("node", F.explode("keys").alias("key"))
    each = materialize(each, "shingles")
    frequent = materialize(each.groupBy("key").agg(F.count("*").alias("df")).where("df >= 2"), "frequent")
    size = F.octet_length("hashes") / 8
    prefix = size - F.ceil(size * percent / 100) + 1
    shared = each.join(frequent, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("keys"))
    rarest = shared.join(members, "node").withColumn("take", (prefix - (size - F.size("keys"))).cast("int")).where("take > 0")
    return materialize(rarest.select(F.explode(F.slice("keys", 1, F.col("take"))).alias("k"), "node", "comp").select("k.key", "node", "comp"), "set-lists")


def _short_pairs(at: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes in different components of the lists (key, node, comp, length) that are short."""
    short = at.where(F.col("length") <= LONG)
    other = short.select("key", F.col("node").alias("b"), F.col("comp").alias("other"))
    pairs = short.select("key", F.col("node").alias("a"), "comp").join(other, "key").where("comp < other").select("a", "b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _cluster_links(lists: DataFrame, nodes: DataFrame, t: int, percent: int) -> DataFrame:
    """Links (a, b) between components of nodes (key, node, comp) that share long lists."""
    first = lists.groupBy("key").agg(F.min("node").alias("b"))
    cluster = components(lists.join(first, "key").select(F.col("node").alias("a"), "b"))
    members = lists.select("node", "comp").distinct().join(cluster, "node", "left").select("node", "comp", F.coalesce("root", "node").alias("cluster"))
    members = materialize(members.join(nodes, "node"), "clusters")
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("hashes")) / BLOCK_BYTES).cast("int").alias("blocks"))
    own = members.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = own.select("cluster", "node", "comp", "sig", "hashes", "own", other).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    least = t

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        same = t["i"][0].as_py() == t["j"][0].as_py()
        order = np.argsort(t["own"].to_numpy() != t["i"][0].as_py(), kind="stable")
        left = int((t["own"].to_numpy() == t["i"][0].as_py()).sum())
        raw = t["hashes"].combine_chunks()
        sets = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in order.tolist()]
        comp = pd.factorize(pd.MultiIndex.from_arrays([t["comp"].combine_chunks().field(c).to_numpy() for c in (0, 1)]))[0][order]
        sig = t["sig"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)[order]
        links = [] if not same and left == len(sets) else merged_links(sets, sig, comp, left, same, least, percent)
        x, y = (pa.array(order[np.array([p[c] for p in links], dtype=np.int64)]) for c in (0, 1))
        return pa.table({"a": t["node"].take(x), "b": t["node"].take(y)})

    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, "a struct<rank:long,th:long>, b struct<rank:long,th:long>")


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after links between nodes."""
    of = comp.select(F.col("node").alias("b"), F.col("comp").alias("y"))
    between = links.join(comp.withColumnRenamed("node", "a"), "a").join(of, "b").select(F.col("comp").alias("a"), F.col("y").alias("b"))
    roots = components(between).withColumnRenamed("node", "comp")
    return materialize(comp.join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "components")


def near_groups(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """Of each document doc_id, rank, th, n (size of its set) and root, the least (rank, th) that it reaches (null where n is 0).

    Only this table stays in the scratch folder.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.keep(materialize(_near_groups(docs, percent, shingle), "groups"))


def _near_groups(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    t = least_matches(percent / 100)
    docs = ranked(docs)
    signed = materialize(sign(docs, shingle), "signatures")
    own = F.struct("rank", "th")
    sets = signed.where("n > 0").groupBy("s1", "s2").agg(F.min(own).alias("node"), F.first("sig").alias("sig"))
    sets = materialize(sets, "sets")
    posted = sets.select("node", F.explode("sig").alias("key"))
    frequent = posted.groupBy("key").agg(F.count("*").alias("df")).where("df >= 2")
    lists = posted.join(frequent, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("keys")).where(F.size("keys") >= t)
    lists = materialize(lists, "postings")
    prefix = lists.select("node", F.explode(F.slice("keys", 1, F.size("keys") - t + 1)).alias("k")).select("node", "k.key")
    alive = lists.select("node.rank", "node.th")
    hashes = full_sets(docs.join(alive, ["rank", "th"]), shingle).groupBy("rank", "th").agg(F.first("hashes").alias("hashes"))
    nodes = materialize(hashes.select(own.alias("node"), "hashes").join(sets.select("node", "sig"), "node"), "nodes")
    comp = lists.select("node", F.col("node").alias("comp"))
    tested = None
    for turn in range(ROUNDS + 1):
        at = prefix.join(comp, "node") if turn else prefix.withColumn("comp", F.col("node"))
        at = at.join(_mixed(at), "key")
        if turn < ROUNDS:
            pairs = at.where("comp != lead.comp").groupBy(F.col("node").alias("b")).agg(F.min("lead.node").alias("a"))
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            at = materialize(at.drop("lead"), "lists")
            long = at.where(F.col("length") > LONG)
            again = _set_lists(long, nodes, percent)
            again = materialize(again.join(_mixed(again), "key").drop("lead"), "lists")
            pairs = _short_pairs(at).unionByName(_short_pairs(again)).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        links = _links(pairs, nodes, t, percent)
        if turn == ROUNDS:
            long = again.where(F.col("length") > LONG)
            if not long.isEmpty():
                links = links.unionByName(_cluster_links(long, nodes, t, percent))
        comp = _merged(comp, materialize(links, "confirmed"))
        tested = pairs if tested is None else tested.unionByName(pairs)
    of_set = sets.select("s1", "s2", "node").join(comp, "node", "left").select("s1", "s2", F.coalesce("comp", "node").alias("root"))
    joined = signed.drop("sig").join(of_set, ["s1", "s2"], "left")
    return joined.select("doc_id", "rank", "th", "n", F.when(F.col("n") > 0, F.col("root")).alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable), kept (doc_id = component_id)."""
    least = F.coalesce("root.rank", "rank")
    return near_groups(docs, percent, shingle).select(
        "doc_id", F.col("n").alias("n_shingles"), F.nullif(least, F.lit(LAST)).alias("component_id"), (least == F.col("rank")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs, with all their columns, but one of each group: the first by doc_id, then by hash of the text.

    Texts without words are in no group, but of rows equal in doc_id and text one stays, whatever else they hold.
    """
    groups = near_groups(docs, percent, shingle)
    stay = groups.where("n = 0 OR (rank = root.rank AND th = root.th)").select(F.col("rank").alias("__sw_rank"), F.col("th").alias("__sw_th")).distinct()
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({"__sw_rank": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "__sw_th": F.xxhash64(text)})
    keys = ["__sw_rank", "__sw_th"]
    return keyed.join(stay, keys, "left_semi").dropDuplicates(keys).drop(*keys)
