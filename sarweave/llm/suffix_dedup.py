"""Suffix-array dedup: bytes covered by 200-byte strings that start anywhere else go.

Candidates are found by winnowing (see winnow); a content that occurs twice or more goes whole, by its digest. The
others are sorted with the contents that share their anchor, as suffixes of one text cut at 200
bytes: multikey quicksort over eight-byte characters to a shallow depth, all groups of a shard
at once, then a blind trie for each group that is still tied. Suffixes that a trie finds equal in
all 200 bytes repeat. Anchors with more windows than a shard should hold are settled by
digests of their windows instead. Overlapping occurrences and those in the same document count. Strings are
judged on the input; matches never cross documents.

A null text counts as empty. Repeated rows repeat each other's strings. The kept bytes may end
inside a character, so that they are binary. Of all columns doc_id is carried.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarweave.llm import kernels as K
from sarweave.llm import winnow

WINDOW = 200
GRAM = 24
#: Bytes that multikey quicksort orders before blind tries take over.
SHALLOW = 32


def characters(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one character."""
    n = max(0, len(text) - 7)
    chars = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        chars = (chars << K.U(8)) | text[j : j + n]
    return chars


def multikey_groups(chars: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of starts whose suffixes agree in depth bytes with another one, in suffix order, and where their groups begin.

    Suffixes are bucketed by their first character. Then multikey quicksort, all groups at once: a round parts
    each group into the suffixes below, at and above the middle one's character; those at it go on to the next character.
    """
    order = np.argsort(chars[starts], kind="stable")
    c = chars[starts[order]]
    head = np.append(True, c[1:] != c[:-1])[: len(order)]
    # Of each tied suffix: its place in the order, its group, and the depth in bytes to which the group agrees.
    place, level = np.arange(len(order)), np.full(len(order), 8)
    group = np.cumsum(head)
    ties: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        size = np.bincount(group, minlength=group[-1] + 1 if len(group) else 1)
        tied = size[group] > 1
        done = tied & (level >= depth)
        if done.any():
            ties.append((place[done], order[done], head[done]))
        going = tied & ~done
        if not going.any():
            break
        order, place, level, head = order[going], place[going], level[going], head[going]
        begin = np.flatnonzero(head)
        end = np.append(begin[1:], len(order))
        of = np.repeat(np.arange(len(begin)), end - begin)
        c = chars[starts[order] + level]
        pivot = c[(begin + end) // 2][of]
        key = 3 * of + 1 + (c > pivot) - (c < pivot)
        by = np.argsort(key, kind="stable")
        order, key = order[by], key[by]
        level = np.where(key % 3 == 1, level[by] + 8, level[by])
        head = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(head)
    if not ties:
        return order[:0], order[:0]
    place, order, head = (np.concatenate(x) for x in zip(*ties, strict=True))
    by = np.argsort(place)
    return order[by], np.flatnonzero(head[by])


class BlindTrie:
    """A Patricia trie of suffixes: nodes hold only the depth at which their suffixes part.

    A suffix goes down by the bytes at these depths alone, is compared once with the leaf that it
    comes to, and is put in where the two part. Leaves hold all suffixes that are equal to the end.
    """

    __slots__ = ("depth", "length", "root", "text")

    def __init__(self, text: bytes, depth: int, length: int):
        self.text, self.depth, self.length, self.root = text, depth, length, None

    def insert(self, s: int) -> None:
        text = self.text
        if self.root is None:
            self.root = [s]
            return
        node, path = self.root, []
        while type(node) is tuple:
            path.append(node)
            node = node[1].get(text[s + node[0]]) or next(iter(node[1].values()))
        a, b = text[s + self.depth : s + self.length], text[node[0] + self.depth : node[0] + self.length]
        if a == b:
            node.append(s)
            return
        apart = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        common = self.length - (apart.bit_length() + 7) // 8
        i = 0
        while i < len(path) and path[i][0] < common:
            i += 1
        if i < len(path) and path[i][0] == common:
            path[i][1][text[s + common]] = [s]
            return
        below = path[i] if i < len(path) else node
        branch = (common, {text[s + common]: [s], text[node[0] + common]: below})
        if i:
            path[i - 1][1][text[s + path[i - 1][0]]] = branch
        else:
            self.root = branch

    def leaves(self):
        """The lists of equal suffixes, in suffix order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                yield node
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))


def equal_suffixes(text: bytes, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """For each of starts whether another one begins the same length bytes."""
    depth = max(8, min(shallow, length // 8 * 8))
    order, begin = multikey_groups(characters(np.frombuffer(text, np.uint8)), starts, depth)
    at = starts[order].tolist()
    equal: list[int] = []
    for lo, hi in pairwise([*begin.tolist(), len(at)]):
        trie = BlindTrie(text, depth, length)
        for s in at[lo:hi]:
            trie.insert(s)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                equal += leaf
    out = np.zeros(len(text) + 1, dtype=bool)
    out[equal] = True
    return out[starts]


def in_shard(scheme: winnow.Scheme):
    w = scheme.window

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        data, bounds = K.text_bytes(t["body"])
        single = t["n"].to_numpy() == 1
        counts = np.diff(bounds) - w + 1
        of = np.repeat(np.arange(len(counts)), counts)
        base = np.cumsum(counts) - counts
        start = np.arange(len(of)) - base[of] + bounds[:-1][of]
        goes = equal_suffixes(data.tobytes(), start, w) & single[of]
        edge = np.flatnonzero(np.diff(of)) + 1
        begin, stop = K.runs_of(np.insert(goes, edge, False)) if len(goes) else (np.empty(0, int), np.empty(0, int))
        shift = np.arange(len(edge)) + edge
        begin, stop = begin - np.searchsorted(shift, begin), stop - np.searchsorted(shift, stop - 1)
        d = of[begin] if len(begin) else np.empty(0, int)
        return pa.table({"c1": t["c1"].take(pa.array(d)), "c2": t["c2"].take(pa.array(d)), "b": pa.array((begin - base[d]).astype(np.int32)), "e": pa.array((stop - base[d]).astype(np.int32))})

    return run


def _kept(text: bytes, removed, starts, ends) -> tuple[int, int, int, bytes]:
    if removed is None:
        return len(text), 0, 0, text
    begin, _ = K.runs_of(removed)
    return len(text), int(removed.sum()), len(begin), np.frombuffer(text, np.uint8)[~removed].tobytes()


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_windows: int = 200_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), and kept: the remaining bytes."""
    scheme = winnow.Scheme("bytes", window, gram, shard_windows)
    docs = winnow.ranked(docs)
    spans = winnow.repeats(
        docs,
        scheme,
        settled=F.col("n") >= 2,
        is_open=F.col("n") == 1,
        anchor_open=F.col("fewest") == 1,
        in_shard=in_shard(scheme),
        by_digest=(F.col("n") == 1) & (F.col("total") >= 2),
    )
    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    return winnow.apply_spans(docs, spans, scheme, _kept, "n_bytes long, n_removed long, n_spans long, kept binary", names, [pa.int64()] * 3 + [pa.binary()])
