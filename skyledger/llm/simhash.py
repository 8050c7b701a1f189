"""SimHash near-dedup: fingerprints of word shingles, linked by a binary trie self-join.

Fingerprints are made in Arrow batches: a text's words, without a copy of the text for each shingle, become
shingle hashes, and bits are counted by numpy.

Distinct fingerprints are joined with themselves as a binary trie. Two fingerprints that differ in at most
three of 64 bits agree on one of four 16-bit quarters, so each fingerprint goes into four tries, each of which
begins with another quarter. In the first 16 levels of a trie only a node and itself can be a pair (their error
budget is spent on the other quarters), so each such node is dealt out as a unit: tasks hold whole nodes. From
there on a task walks down all its node pairs together, one bit a level: each pair of nodes gives the pairs of
their children, the differing bits so far are kept, and pairs beyond the budget are pruned.

Pairs of nodes whose leaves all hang together already are pruned as well, so that a large group of near copies
costs about its size: a node with many leaves first links those that differ in one bit, by lookups. Tasks return
links of a spanning forest, never all pairs of a group; components are then joined over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, fresh, stage

BITS, QUARTER = 64, 16
#: Node pairs a task walks at once; what is over waits on a stack. Few at once let links found early prune the rest.
FRONTIER = 1 << 15
#: Leaves that a task walks together.
LEAVES = 250_000
#: A node of the sixteenth level with more leaves is cut into sub-nodes, whose pairs are dealt to different tasks.
SPLIT = 1 << 18
#: Nodes of the sixteenth level with so many leaves link leaves of distance 1 before the walk.
CROWDED = 64


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Hashes of the text's shingles, repeated ones too. Up to ``words`` words make one shingle; no words make none."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both are for ASCII only on bytes
    if not w:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([digest(b" ".join(w), 42)], np.uint64)
    joined = b" ".join(w)
    size = [len(x) + 1 for x in w]
    ends = np.cumsum(size) - 1
    starts = (ends - np.asarray(size) + 1)[: len(w) - words + 1].tolist()
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    n, total = len(hashes), np.zeros(BITS, np.int64)
    h = hashes.astype(">u8")
    for at in range(0, n, 1 << 16):
        part = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8)).reshape(-1, BITS)
        total += part.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprint(text: str | None, words: int) -> int:
    """Fingerprint of one text: a bit is 1 if set in over half of the hashes of its shingles."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint long): the 64 bits as a signed number. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                prints = np.array([fingerprint(t.as_py(), words) for t in part.column(1)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(prints)], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long")


class Forest:
    """Union-find over positions, for many unions at once."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.of[self.of]
            if np.array_equal(up, self.of):
                return self.of
            self.of = up

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            of = self.roots()
            x, y = of[a], of[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if len(a):
                np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))


    def links(self) -> tuple[np.ndarray, np.ndarray]:
        of = self.roots()
        linked = np.flatnonzero(of != np.arange(len(of)))
        return linked, of[linked]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def trie_links(prints: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of a spanning forest over sorted distinct prints; only prints with equal first quarter pair."""
    n = len(prints)
    forest = Forest(n)
    top = prints >> np.uint64(BITS - QUARTER)
    first = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    size = np.diff(np.r_[first, n])
    crowd = np.flatnonzero(np.repeat(size >= CROWDED, size))
    for bit in range(BITS - QUARTER) if len(crowd) else ():
        other = prints[crowd] ^ np.uint64(1 << bit)
        at = np.minimum(np.searchsorted(prints, other), n - 1)
        hit = prints[at] == other
        forest.union(crowd[hit], at[hit])

    keep = size > 1
    lo, hi = first[keep].astype(np.int32), (first + size)[keep].astype(np.int32)
    walk(prints, forest, (QUARTER, lo, hi, lo, hi, np.zeros(len(lo), np.int8)), budget)
    return forest.links()


def cross_links(one: np.ndarray, two: np.ndarray, level: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two nodes of one level, each with sorted distinct prints, that lie ``level`` bits deep."""
    prints = np.concatenate([one, two] if one[0] < two[0] else [two, one])
    n = len(one) if one[0] < two[0] else len(two)
    top = np.uint64(BITS - level)
    forest, diff = Forest(len(prints)), popcount((one[:1] ^ two[:1]) >> top).astype(np.int8)
    at = lambda x: np.array([x], np.int32)
    walk(prints, forest, (level, at(0), at(n), at(n), at(len(prints)), diff), budget)
    of = forest.links()
    return prints[of[0]], prints[of[1]]


def walk(prints: np.ndarray, forest: Forest, start: tuple, budget: int) -> None:
    """Join in the forest what pairs of trie nodes hold, from ``start`` on: (bits walked, two ranges of sorted prints for each
    pair of nodes, bits in which they differ so far)."""
    stack = [start]
    while stack:
        level, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > FRONTIER:
            for at in range(0, len(a0), FRONTIER):
                stack.append((level, *(v[at : at + FRONTIER].copy() for v in (a0, a1, b0, b1, diff))))
            continue
        # Leaf pairs are compared at once.
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        x, y = a0[leaf], b0[leaf]
        near = popcount(prints[x] ^ prints[y]) <= budget
        forest.union(x[near], y[near])
        rest = ~leaf
        if level == BITS or not rest.any():
            continue
        a0, a1, b0, b1, diff = (v[rest] for v in (a0, a1, b0, b1, diff))
        # Nodes whose leaves all hang together have one root from their first leaf to their last.
        of = forest.roots()
        change = np.r_[0, np.cumsum(of[1:] != of[:-1])]
        open_ = ~((change[a0] == change[a1 - 1]) & (change[b0] == change[b1 - 1]) & (of[a0] == of[b0]))
        a0, a1, b0, b1, diff = (v[open_] for v in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        bit = np.uint64(1 << (BITS - 1 - level))
        below = np.uint64((1 << (BITS - 1 - level)) - 1)
        cut = lambda lo: np.searchsorted(prints, (prints[lo] & ~(bit | below)) | bit)  # noqa: E731  where the node's 1 child begins
        am = np.clip(cut(a0), a0, a1).astype(np.int32)
        bm = np.clip(cut(b0), b0, b1).astype(np.int32)
        same = a0 == b0
        cases = [(a0, am, b0, bm, 0, slice(None)), (am, a1, bm, b1, 0, slice(None)), (a0, am, bm, b1, 1, slice(None)), (am, a1, b0, bm, 1, ~same)]
        parts = []
        for p0, p1, q0, q1, more, which in cases:
            d = diff + np.int8(more)
            ok = (p0 < p1) & (q0 < q1) & (d <= budget)
            if not isinstance(which, slice):
                ok &= which  # a node paired with itself has its two children paired once
            ok &= ~((p1 - p0 == 1) & (p0 == q0))
            parts.append(tuple(v[ok] for v in (p0, p1, q0, q1, d)))
        stack.append((level + 1, *(np.concatenate(v) for v in zip(*parts))))


def rotated(prints: np.ndarray, quarter: int) -> np.ndarray:
    turn = np.uint64(quarter * QUARTER)
    return prints if not quarter else (prints << turn) | (prints >> np.uint64(BITS - quarter * QUARTER))


def links(distinct: DataFrame, budget: int = 3, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that join exactly the prints that a chain of prints at most ``budget`` bits apart joins."""
    if budget > 3:
        raise ValueError("four quarters leave a shared one for at most three differing bits")
    # Signed numbers: a shift without sign gives the bits.
    quarter = F.explode(F.array(*[F.lit(i) for i in range(4)]))
    four = distinct.select("fingerprint", quarter.alias("quarter"))
    turned = F.expr("shiftleft(fingerprint, quarter * 16) | if(quarter = 0, 0L, shiftrightunsigned(fingerprint, 64 - quarter * 16))")
    four = stage(four.select("quarter", turned.alias("print")).withColumn("node", F.shiftrightunsigned("print", 48)), "quarters")
    # A node of more than ``split`` prints is cut into its sub-nodes ``deep`` bits further down, and each pair of those
    # within the budget is a cell of its own: (low, high), a print on the side of its own sub-node.
    crowded = four.groupBy("quarter", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split)
    deep = F.least(F.ceil(F.log2(F.col("n") / split)), F.lit(12)).cast("int")
    four = four.join(crowded.select("quarter", "node", deep.alias("deep")), ["quarter", "node"], "left").fillna(0, ["deep"])
    own = F.expr("if(deep = 0, 0, cast(shiftrightunsigned(shiftleft(print, 16), 64 - deep) as int))")
    masks = F.filter(F.sequence(F.lit(0), F.expr("cast(shiftleft(1, deep) - 1 as int)")), lambda x: F.bit_count(x) <= budget)
    cells = four.withColumn("own", own).withColumn("mask", F.explode(masks)).withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
    cells = cells.select("quarter", "node", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "deep", "print")
    key = ["quarter", "node", "low", "high"]
    cells = cells.repartition(*key).sortWithinPartitions(*key)

    def rows(quarter: int, found: Iterator[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rotated(x, (4 - quarter) % 4).view(np.int64)) for x in found], names=["a", "b"])

    def found_in(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        quarters, _, low, high, own, deep, prints = (np.concatenate(v) for v in zip(*held))
        prints = prints.view(np.uint64)
        for quarter in np.unique(quarters).tolist():
            mine = np.sort(prints[(quarters == quarter) & (low == high)])
            if len(mine):
                yield rows(quarter, [mine[x] for x in trie_links(mine, budget)])
        for at in np.flatnonzero((low != high) & np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]).tolist():
            cell = (quarters == quarters[at]) & (low == low[at]) & (high == high[at])
            one, two = (np.sort(prints[cell & (own == x)]) for x in (low[at], high[at]))
            if len(one) and len(two):
                yield rows(int(quarters[at]), cross_links(one, two, QUARTER + int(deep[at]), budget))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come cell by cell. Whole nodes are walked together, some LEAVES leaves at a time; cells of two sides alone.
        held, count, last = [], 0, None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            quarters, nodes, low, high = columns[:4]
            new = np.flatnonzero(np.r_[True, (quarters[1:] != quarters[:-1]) | (nodes[1:] != nodes[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            for a, b in zip(new, [*new[1:], len(quarters)]):
                key = (quarters[a], nodes[a], low[a], high[a])
                pairs = low[a] != high[a]
                if held and key != last and (count >= LEAVES or pairs or last[2] != last[3]):
                    yield from found_in(held)
                    held, count = [], 0
                held.append([c[a:b] for c in columns])
                count, last = count + b - a, key
        if held:
            yield from found_in(held)

    return cells.mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, words: int = 3, budget: int = 3) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for each row of docs.

    Documents link when their fingerprints differ in at most ``budget`` bits; component_id is the smallest
    doc_id that links lead to, the document's own included. Texts without words, null ones too, have fingerprint
    0 and link like any other. Documents with equal fingerprints meet once in the join however many they are.
    Repeated rows give repeated results. A null doc_id counts in no minimum; a component of null ids has a null
    id. A very long text is one fingerprint of all its shingles. An empty table gives an empty result. Other columns of
    docs are not read, whatever their names.
    """
    own = stage(fingerprints(docs, words), "fingerprints")
    least = stage(own.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(links(least.select("fingerprint"), budget))
    joined = least.join(roots, least.fingerprint == roots.node, "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = joined.join(ids, "root").select("fingerprint", "component_id")
    return own.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, budget: int = 3) -> DataFrame:
    """docs without near copies: of each component the document with the smallest doc_id stays.

    Documents with a null doc_id stay. Of rows that repeat a kept doc_id all stay. Texts without words, null ones too,
    are copies of one another. A very long text is compared whole. An empty table gives an empty one. Other columns pass
    through, whatever their names.
    """
    groups = near_groups(docs, words, budget)
    doc = fresh("doc")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(doc)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(doc), "left_semi")
    return named.unionByName(docs.where("doc_id is null"))
