"""Near copies by exact resemblance: texts link when their sets of word shingles are 0.8 alike (Jaccard) or more.

No number of differing bits holds all such pairs, so fingerprints only go first: each text of a SimHash group is compared
with the group's first one, which links most copies at a cost of the group's size. The other pairs come from a prefix
join that misses none: sets that are 0.8 alike share one of the first fifth of their shingles in any order that is the
same for all texts. The order puts common shingles last; it changes the cost only. The texts of a shingle are first compared
with one of them. Then pairs of what does not hang together yet leave the join only if their parities allow it: sets that
differ in d shingles differ in at most d parity bits, so no pair is lost by that. The texts of a crowded shingle are dealt to
parts: pairs of one part come first, then pairs of two parts, each two in a task of their own, without what hangs together
by then. Every pair is checked on its whole sets before it links. Sets of long texts are large, and parities of a fixed length
say little about them, so pairs are sieved first by parities that grow with the set: whole sets meet for few pairs that do not link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import connected_components, fresh, stage

#: Shared shingles of two sets, as a ratio of whole numbers: 4 of 5.
SHARE, OF = 4, 5
#: Shingles are counted by so many buckets, and so many of the fullest are known as common.
BUCKETS, COMMON = 1 << 22, 1 << 16
#: A shingle with more texts than this is crowded: its texts are dealt to parts, and pairs of parts to different tasks.
PART = 2_000
#: Rows of a crowded shingle are looked over in so many windows.
SALTS = 64
#: Longs of a set's parity, 64 bits each.
LANES = 8
PARITY = [f"p{i}" for i in range(LANES)]


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes)


def set_key(own: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(own.tobytes(), 7)


def parity(own: np.ndarray) -> np.ndarray:
    """A bit for each of 64 * LANES classes of shingles: whether the set has an odd number of the class."""
    odd = np.bincount((own >> np.uint64(24)).astype(np.int64) % (64 * LANES), minlength=64 * LANES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def may_link(a: str, b: str) -> str:
    """SQL: sets that are alike enough differ in at most a ninth of both sizes, so at most in so many parity bits."""
    apart = " + ".join(f"bit_count({p}{a} ^ {p}{b})" for p in PARITY)
    return f"{SHARE + OF} * ({apart}) <= {OF - SHARE} * (n{a} + n{b})"


def _signed(x) -> pa.Array:
    return pa.array(np.array(x, dtype=np.uint64).view(np.int64))


def described(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fingerprint, key, n, p0, p1, ...) a row of docs; key names the shingle set, n is its size, p its parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                prints, keys, sizes, odd = [], [], [], []
                for t in part.column(1):
                    h = simhash.shingle_hashes(t.as_py(), words)
                    own = shingle_set(h)
                    prints.append(simhash.majority(h))
                    keys.append(set_key(own))
                    sizes.append(len(own))
                    odd.append(parity(own))
                columns = [part.column(0).cast(pa.int64()), _signed(prints), _signed(keys), pa.array(sizes, pa.int64()), *map(_signed, np.array(odd).reshape(-1, LANES).T)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint", "key", "n", *PARITY])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, fingerprint long, key long, n long, {', '.join(f'{p} long' for p in PARITY)}")


def common_buckets(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the commonest shingles, ascending, with their counts: at most COMMON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for t in batch.column(0):
                own = shingle_set(simhash.shingle_hashes(t.as_py(), words))
                np.add.at(counts, (own % np.uint64(BUCKETS)).astype(np.int64), 1)
        full = np.flatnonzero(counts > 1 + 4 * counts.mean())
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(counts[full].astype(np.int64))], names=["bucket", "n"])

    found = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    top = sorted(tuple(r) for r in found.orderBy(F.desc("n"), "bucket").limit(COMMON).collect())
    return np.array([b for b, _ in top], np.int64), np.array([n for _, n in top], np.int64)


def in_order(own: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A shingle set by the order of all texts: common ones last, else by hash."""
    rank = np.zeros(len(own), np.int64)
    if len(buckets):
        b = (own % np.uint64(BUCKETS)).astype(np.int64)
        at = np.minimum(np.searchsorted(buckets, b), len(buckets) - 1)
        rank = np.where(buckets[at] == b, counts[at], 0)
    return own[np.lexsort((own, rank))]


def prefix_length(n: int) -> int:
    """Sets of n that are alike enough share at least ceil(0.8 n): one of them is among so many first ones."""
    return n - -(-SHARE * n // OF) + 1 if n else 0


def prefixes(docs: DataFrame, words: int) -> DataFrame:
    """(h, key, n, at, salt): the first shingles of each row's set in the common order, at their places. salt is 0 but for
    shingles of a bucket that is crowded, where it depends on the key."""
    buckets, counts = common_buckets(docs, words)
    crowded = buckets[counts > PART]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                hs, keys, sizes = [np.empty(0, np.uint64)], [], []
                for t in batch.column(0).slice(lo, 128):
                    own = shingle_set(simhash.shingle_hashes(t.as_py(), words))
                    hs.append(in_order(own, buckets, counts)[: prefix_length(len(own))])
                    keys.append(set_key(own))
                    sizes.append(len(own))
                lengths = [len(h) for h in hs[1:]]
                at = np.concatenate([np.arange(x) for x in lengths])
                h, key = np.concatenate(hs), np.repeat(np.array(keys, np.uint64), lengths)
                salt = np.where(np.isin((h % np.uint64(BUCKETS)).astype(np.int64), crowded), 1 + key % np.uint64(SALTS), 0)
                columns = [_signed(h), _signed(key), *(pa.array(x.astype(np.int32)) for x in (np.repeat(sizes, lengths), at, salt))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "n", "at", "salt"])

    return docs.select("text").mapInArrow(run, "h long, key long, n int, at int, salt int")


def fine_parity(own: np.ndarray) -> bytes:
    """As parity, with at least as many classes as the set has shingles: a power of two, so that a longer one can be folded."""
    bits = max(64, 1 << (len(own) - 1).bit_length()) if len(own) else 64
    return np.packbits((np.bincount(((own >> np.uint64(24)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def parities_apart(a: bytes, b: bytes) -> int:
    """In how many bits two fine parities differ, the longer one folded: never more than shingles are in one set only."""
    x, y = (np.frombuffer(p, np.uint8) for p in (a, b))
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(p.reshape(-1, width), axis=0) for p in (x, y))
    return int(np.unpackbits(x ^ y).sum())


def texts_of(pairs: DataFrame, docs: DataFrame, least: DataFrame) -> DataFrame:
    """The texts that the keys of pairs (a, b) name, with some more where doc_id is null or repeated."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    ids = stage(least.join(needed, "key").select(F.col("least").alias("_doc")).distinct(), "candidate-ids")
    return docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi").select("text")


def of_sets(texts: DataFrame, words: int, make, kind: pa.DataType, schema: str) -> DataFrame:
    """(key, n, own) of the distinct shingle sets of texts, own as ``make`` gives it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                sets = [shingle_set(simhash.shingle_hashes(t.as_py(), words)) for t in batch.column(0).slice(lo, 64)]
                yield pa.RecordBatch.from_arrays([_signed([set_key(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()), pa.array([make(s) for s in sets], kind)], names=["key", "n", "own"])

    return texts.mapInArrow(run, f"key long, n long, own {schema}").dropDuplicates(["key"])


def joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with both sides' n and own."""
    a, b = (sets.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("own").alias(f"own_{k}")) for k in ("a", "b"))
    return pairs.join(a, "a").join(b, "b")


def sieved(pairs: DataFrame, docs: DataFrame, least: DataFrame, words: int) -> DataFrame:
    """Those pairs (a, b) that their fine parities allow; no pair that is alike enough is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, own_a, own_b = (c.to_pylist() for c in batch.columns)
            keep = [(SHARE + OF) * parities_apart(x, y) <= (OF - SHARE) * (m + n) for m, n, x, y in zip(n_a, n_b, own_a, own_b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = stage(of_sets(texts_of(pairs, docs, least), words, fine_parity, pa.binary(), "binary"), "candidate-parities")
    return joined(pairs, sets).select("a", "b", "n_a", "n_b", "own_a", "own_b").mapInArrow(run, "a long, b long")


def checked(pairs: DataFrame, docs: DataFrame, least: DataFrame, words: int) -> DataFrame:
    """Those pairs (a, b) of keys whose sets are alike enough. Sets are made for the keys of pairs that the sieve leaves."""
    close = stage(sieved(pairs, docs, least, words), "close-pairs")
    sets = stage(of_sets(texts_of(close, docs, least), words, lambda s: s.view(np.int64), pa.list_(pa.int64()), "array<long>"), "candidate-sets")
    both = F.size(F.array_intersect("own_a", "own_b"))
    sized = joined(close, sets).select("a", "b", both.alias("both"), (F.col("n_a") + F.col("n_b")).alias("all"))
    return sized.where(OF * F.col("both") >= SHARE * (F.col("all") - F.col("both"))).select("a", "b")


def regrouped(shared: DataFrame, roots: DataFrame, least: DataFrame) -> DataFrame:
    """Rows of the shingles whose texts do not all hang together yet: h, key, n, at, group, parts and the set's parity.

    What a shingle's rows have together is summed up before it is joined back, so Spark can split a crowded one's rows.
    """
    x = shared.select("h", "key", "n", "at").join(roots, F.col("key") == F.col("node"), "left").select("h", "key", "n", "at", F.coalesce("root", "key").alias("group"))
    per_h = x.groupBy("h").agg(F.min("group").alias("_low"), F.max("group").alias("_high"), F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).where("_low < _high")
    return stage(x.join(per_h.select("h", "parts"), "h").join(least.select("key", *PARITY), "key"), "shared-shingles")


#: What is left of both sets from a shared shingle on must hold enough.
ENOUGH = f"{SHARE + OF} * least(n_a - at_a, n_b - at_b) >= {SHARE} * (n_a + n_b)"


def sides(x: DataFrame, y: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(d.select([F.col(c).alias(c + k) for c in d.columns]) for d, k in ((x, "_a"), (y, "_b")))


def candidates(pairs: DataFrame) -> DataFrame:
    return stage(pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct(), "candidate-pairs")


def pairs_within(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys that share a shingle and a part of it and may be alike enough."""
    cells = rows.withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    x, y = sides(cells, cells)
    return candidates(x.join(y, F.expr(f"h_a = h_b and part_a = part_b and group_a < group_b and {ENOUGH} and {may_link('_a', '_b')}")))


def pairs_across(rows: DataFrame) -> DataFrame:
    """The same for two parts of a crowded shingle: each pair of parts is a cell of its own."""
    mine, other = F.pmod(F.xxhash64("key"), "parts"), F.col("other")
    cells = rows.select("*", mine.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).where("part <> other")
    cells = cells.withColumns({"low": F.least("part", other), "high": F.greatest("part", other)})
    x, y = sides(cells.where("part = low"), cells.where("part = high"))
    return candidates(x.join(y, F.expr(f"h_a = h_b and low_a = low_b and high_a = high_b and group_a <> group_b and {ENOUGH} and {may_link('_a', '_b')}")))


def alike_groups(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, component_id) a row of docs; texts link when their shingle sets are 0.8 alike or more.

    component_id is the smallest doc_id that links lead to. Texts without words, null ones too, are alike one another. A
    null doc_id counts in no minimum. Repeated rows give repeated results. A very long text is compared by its whole set. An
    empty table gives an empty result. Other columns are not read, whatever their names.
    """
    own = stage(described(docs, words), "shingle-sets")
    same = [F.max(c).alias(c) for c in ("fingerprint", "n", *PARITY)]
    least = stage(own.groupBy("key").agg(F.min("doc_id").alias("least"), *same), "distinct-sets")
    # First the SimHash groups, each text with the first of its group.
    near = connected_components(simhash.links(least.select("fingerprint").distinct()))
    grouped = least.join(near, least.fingerprint == near.node, "left").select("key", F.coalesce("root", "fingerprint").alias("root"))
    first = grouped.groupBy("root").agg(F.min("key").alias("a"))
    stars = stage(grouped.join(first, "root").where("key <> a").select("a", F.col("key").alias("b")), "simhash-pairs")
    links = stage(checked(stars, docs, least, words), "simhash-links")
    # Then what shares a first shingle and does not hang together yet.
    hangs = links.groupBy("b").agg(F.min("a").alias("of"))
    by_h = F.expr("salt > 0 or min(key) over (partition by h, salt) < max(key) over (partition by h, salt)")
    shared = prefixes(docs, words).withColumn("_two", by_h).where("_two").drop("_two", "salt").distinct()
    shared = stage(shared.join(hangs, shared.key == hangs.b, "left").select("h", "key", "n", "at", F.coalesce("of", "key").alias("group")), "shared-shingles")
    # Each text with the first one of its shingle, so that a large group of near copies hangs together before pairs are made.
    lead = shared.groupBy("h").agg(F.min_by(F.struct("key", "n", "at", "group"), F.struct("group", "key")).alias("lead"))
    led = shared.join(lead, "h").where("group <> lead.group").where(F.expr(f"{SHARE + OF} * least(n - at, lead.n - lead.at) >= {SHARE} * (n + lead.n)"))
    led = stage(led.select(F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")).distinct(), "lead-pairs")
    links = stage(links.unionByName(checked(led, docs, least, words)), "lead-links")
    rows = regrouped(shared, connected_components(links), least)
    links = stage(links.unionByName(checked(pairs_within(rows), docs, least, words)), "links")
    if rows.where("parts > 1").limit(1).count():
        # What hangs together by the pairs of a part is not compared across parts.
        rows = regrouped(rows.where("parts > 1"), connected_components(links), least)
        links = links.unionByName(checked(pairs_across(rows), docs, least, words))
    roots = connected_components(links)
    rooted = least.join(roots, least.key == roots.node, "left").select("key", F.coalesce("root", "key").alias("root"), "least")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = rooted.join(ids, "root").select("key", "component_id")
    return own.join(by_key, "key").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, words: int = 5) -> DataFrame:
    """docs without near copies: of each component the document with the smallest doc_id stays.

    Documents with a null doc_id stay. Of rows that repeat a kept doc_id all stay. Texts without words, null ones too,
    are copies of one another. A very long text is compared whole. An empty table gives an empty one. Other columns pass
    through, whatever their names.
    """
    doc = fresh("doc")
    kept = alike_groups(docs, words).where("doc_id = component_id").select(F.col("doc_id").alias(doc)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(doc), "left_semi")
    return named.unionByName(docs.where("doc_id is null"))
