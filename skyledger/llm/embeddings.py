"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are scaled to length 1; a cosine of at least c is then a distance of at most sqrt(2 - 2c). A table hashes a
vector by ``width`` random normal projections, each moved by a random offset and cut into cells of ``cell``; vectors
with equal cells in a table share a bucket. Vectors of one bucket are compared exactly, in double precision.

With cells of 1.5, a projection keeps two vectors of cosine 0.95 in one cell with chance p = 0.83 and two at right angles
with chance q = 0.39. ``setting_for`` takes the width from the number n of vectors, so that an unrelated vector meets
about ``CROWD`` others in a table whatever n is, and as many tables as keep the chance to miss a link of cosine 0.95 under
``MISS``: work grows as n^1.2 and not as n^2.

Hashes are exact: vectors and projections are rounded to whole multiples of 2^-18, whose products and sums doubles hold
without error. So a vector has the same cells in every task, and whatever batch it is hashed in.

Equal vectors are one *class* that is hashed once and counts as often as it occurs. A link that several tables find
counts in the first of them only, which both vectors' hashes tell, so links are counted where they are found and never
listed; a task returns sums and a spanning forest of its links. A bucket with more than ``part`` classes is split into
parts, and pairs of parts are compared in different tasks, so no bucket is too large for a task and none is cut short.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stage

CELL, PART, SEED = 1.5, 2_000, 31
#: Chances that one projection keeps two vectors of cosine 0.95, or two at right angles, in one cell of 1.5.
TOGETHER, APART = 0.83, 0.39
CROWD, MISS, UNIT = 8, 1e-3, 1 << 18
#: Bytes of vectors that a task deals out, or compares, at once.
OUT = 16 << 20


def setting_for(n: int) -> tuple[int, int]:
    """(width, tables) for n distinct vectors."""
    width = max(4, math.ceil(math.log(max(n, 1) / CROWD) / -math.log(APART)) if n > CROWD else 4)
    return width, math.ceil(math.log(MISS) / math.log(1 - TOGETHER**width))


@lru_cache(maxsize=8)
def projections(dim: int, width: int, tables: int, cell: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    a, shift = np.rint(rng.standard_normal((dim, width * tables)) * UNIT), np.rint(rng.uniform(0, cell, width * tables) * UNIT * UNIT)
    return a, shift, rng.integers(1, 1 << 62, width, dtype=np.int64) * 2 + 1


def buckets(unit: np.ndarray, width: int, tables: int, cell: float, seed: int) -> np.ndarray:
    """Bucket of each unit vector in each table, as a 64-bit digest of its cells and its dimension."""
    a, shift, odd = projections(unit.shape[1], width, tables, cell, seed)
    cells = np.floor((np.rint(unit * UNIT) @ a + shift) / (cell * UNIT * UNIT)).astype(np.int64).reshape(len(unit), tables, width)
    x = (cells * odd).sum(axis=2) + unit.shape[1]  # wraps around
    x = x.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))).view(np.int64)


def units(raw: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision of vectors of one dimension; components are first scaled by the largest."""
    v = np.stack([np.frombuffer(r, np.float32, offset=1) if len(r) % 4 == 1 else np.frombuffer(r, np.float64, offset=2) for r in raw], dtype=np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def packed(v: np.ndarray) -> bytes:
    """A vector in single precision after one byte where that holds it, else in double precision after two."""
    with np.errstate(over="ignore"):
        single = v.astype(np.float32)
    return b"\0" + single.tobytes() if np.array_equal(single.astype(np.float64), v) else b"\0\0" + v.tobytes()


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, class long, vec binary): class and vec are null for vectors that link with nothing.

    vec has 4 bytes a component where they are single-precision numbers, else 8, see ``packed``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, raw = [], []
            for x in batch.column(1):
                v = np.array([np.nan if c is None else c for c in x.as_py()], dtype=np.float64) if x.is_valid else np.zeros(0)
                if len(v) and np.isfinite(v).all() and v.any():
                    raw.append(packed(v + 0.0))  # -0 is 0
                    classes.append(int.from_bytes(hashlib.md5(raw[-1]).digest()[:8], "little", signed=True))
                else:
                    raw.append(None)
                    classes.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(classes, pa.int64()), pa.array(raw, pa.binary())], names=["vec_id", "class", "vec"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, class long, vec binary")


def by_dimension(raw: list[bytes]) -> Iterator[np.ndarray]:
    size = np.fromiter((len(r) // 4 if len(r) % 4 == 1 else len(r) // 8 for r in raw), np.int64, len(raw))
    for s in np.unique(size):
        yield np.flatnonzero(size == s)


def near_pairs(unit: np.ndarray, size: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of rows with at least this cosine in the same cell; cells are runs of ``size`` rows.

    Small cells of one size are multiplied together, large ones by blocks of rows.
    """
    start = np.cumsum(size) - size
    for s in np.unique(size):
        first = start[size == s]
        if s <= 64:
            step = max(1, (1 << 20) // int(s * max(s, unit.shape[1])))
            for lo in range(0, len(first), step):
                at = first[lo : lo + step, None] + np.arange(s)
                v = unit[at]
                k, i, j = np.nonzero(v @ v.transpose(0, 2, 1) >= cosine)
                keep = i < j
                yield at[k[keep], i[keep]], at[k[keep], j[keep]]
        else:
            for b in first:
                for lo in range(0, s, 512):
                    i, j = np.nonzero(unit[b + lo : b + min(lo + 512, s)] @ unit[b : b + s].T >= cosine)
                    keep = i + lo < j
                    yield b + lo + i[keep], b + j[keep]


def near_groups(
    vectors: DataFrame, cosine: float = 0.95, width: int | None = None, tables: int | None = None, cell: float = CELL, part: int = PART, seed: int = SEED
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding).

    n_links counts the other rows linked directly, equal vectors included; component_id is the smallest vec_id that
    links lead to, the row's own included; kept tells whether it is the row's own. Null or zero vectors and those
    with null or non-finite components link with nothing. Vectors of different dimensions do not link. Rows that
    repeat a vec_id are vectors of their own and link by their embeddings. A null vec_id counts in no minimum; its
    component's id is null if it has no other, and kept is then true. Vectors of any length are taken. An empty table
    gives an empty result; other columns are not read, whatever their names. ``width`` and ``tables`` follow from the
    number of distinct vectors unless both are given.
    """
    own = stage(prepared(vectors), "vectors")
    classes = own.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("times"), F.first("vec").alias("vec"))
    classes = stage(classes, "classes")
    if width is None or tables is None:
        width, tables = setting_for(classes.count())
    setting = (width, tables, cell, seed)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for which in by_dimension(raw):
                b = buckets(units([raw[i] for i in which]), *setting)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[which], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(which))), pa.array(b.ravel())], names=["class", "table", "bucket"]
                )

    keys = stage(classes.select("class", "vec").mapInArrow(hashed, "class long, table int, bucket long"), "keys")
    large = keys.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part)
    parts = keys.join(large, ["table", "bucket"]).groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("table", F.ceil(F.col("n") / part).cast("int")))).alias("parts"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = pc.max(pc.binary_length(batch.column("vec"))).as_py() or 1
            step = max(1, OUT // (tables * longest))
            for lo in range(0, batch.num_rows, step):
                rows = batch.slice(lo, step)
                raw, split, ids = rows.column("vec").to_pylist(), rows.column("parts"), rows.column("class").to_numpy()
                n = np.ones((len(raw), tables), np.int64)
                for i in np.flatnonzero(split.is_valid().to_numpy(zero_copy_only=False)):
                    for t, x in split[i].as_py():
                        n[i, t] = x
                for which in by_dimension(raw):
                    times = n[which].ravel()  # each row goes to the pairs of its part with every part of its bucket
                    flat = np.repeat(np.arange(len(times)), times)
                    other, times = np.arange(len(flat)) - np.repeat(np.cumsum(times) - times, times), times[flat]
                    at, mine = which[flat // tables], ids[which[flat // tables]] % times
                    low, high = np.minimum(mine, other), np.maximum(mine, other)
                    side = np.where(low == high, 0, 1 + (mine != low)).astype(np.int32)
                    bucket = buckets(units([raw[i] for i in which]), *setting).ravel()[flat]
                    same = [rows.column(c).take(pa.array(at)) for c in ("class", "times", "vec")]
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(low * times + high), pa.array(side), pa.array((flat % tables).astype(np.int32)), *same], names=list(names))

    names = ("bucket", "cell", "side", "table", "class", "times", "vec")
    fields = "bucket long, cell long, side int, table int, class long, times long, vec binary"
    cells = classes.join(parts, "class", "left").select("class", "times", "vec", "parts").mapInArrow(dealt, fields)
    cells = cells.repartition("table", "bucket", "cell").sortWithinPartitions("table", "bucket", "cell")

    def linked(unit: np.ndarray, size: np.ndarray, side: np.ndarray, table: np.ndarray, ids: np.ndarray, times: np.ndarray) -> pa.RecordBatch | None:
        """Sums and a spanning forest of the links in cells of so many rows; side is 0 in a cell of one part, else 1 or 2."""
        i, j = (np.concatenate(x) for x in zip(*near_pairs(unit, size, cosine)))
        keep = (side[i] == 0) | (side[i] != side[j])
        i, j = i[keep], j[keep]
        rows = np.unique(np.concatenate([i, j]))
        if not len(rows):
            return None
        hashes, at = buckets(unit[rows], *setting), np.zeros(len(unit), np.int64)
        at[rows] = np.arange(len(rows))
        first = np.concatenate([(hashes[at[i[lo : lo + 50_000]]] == hashes[at[j[lo : lo + 50_000]]]).argmax(axis=1) for lo in range(0, len(i), 50_000)])
        fresh = first == table[i]
        i, j = i[fresh], j[fresh]
        counts = np.zeros(len(unit), np.int64)
        np.add.at(counts, i, times[j])
        np.add.at(counts, j, times[i])
        root = np.arange(len(unit))
        while True:  # smallest position that links lead to
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        hit = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(counts[hit]), pa.array(ids[root[hit]])], names=["a", "n", "b"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begins(rows: pa.RecordBatch, which: np.ndarray | slice) -> np.ndarray:
            """Positions at which a new cell begins, the first one left out."""
            x = [rows.column(c).to_numpy()[which] for c in ("table", "bucket", "cell")]
            return np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in x])) + 1

        def links(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Rows are those of whole cells, in order."""
            raw = rows.column("vec").to_pylist()
            columns = [rows.column(c).to_numpy() for c in ("side", "table", "class", "times")]
            for which in by_dimension(raw):
                size = np.diff(np.concatenate([[0], begins(rows, which), [len(which)]]))
                which, size = which[np.repeat(size > 1, size)], size[size > 1]
                most = max(1, OUT // len(raw[which[0]])) if len(which) else 1
                run = (np.cumsum(size) - size) // most  # so many rows are compared at once, or one cell
                for r in np.unique(run):
                    here = which[np.repeat(run == r, size)]
                    found = linked(units([raw[i] for i in here]), size[run == r], *[c[here] for c in columns])
                    if found is not None:
                        yield found

        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            ends = begins(held, slice(None))
            if len(ends):  # the last cell may go on in the next batch
                yield from links(held.slice(0, ends[-1]))
                held = held.slice(ends[-1])
        if held is not None and held.num_rows:
            yield from links(held)

    found = stage(cells.mapInArrow(compared, "a long, n long, b long"), "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select("a", "b"))
    known = classes.select("class", "times").join(counts, classes["class"] == counts.a, "left").join(roots, classes["class"] == roots.node, "left")
    known = known.select("class", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "class").alias("root"))
    joined = own.select("vec_id", "class").join(known, "class", "left")
    least = joined.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    out = joined.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
