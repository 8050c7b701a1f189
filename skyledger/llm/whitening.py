"""Whitening of embeddings by shifted CholeskyQR.

Components become whole numbers x = floor(1024 c) + 100000, so counts and sums are exact. The rows of n*x - S, S being
the sums over all n rows, are the centred rows; divided by n they make a tall matrix A that is never held: each pass reads
the embeddings again. A *Gram pass* sends every row through the triangular solves found so far and adds up Q'Q. The
Cholesky factor of that matrix is the next solve; the first one is shifted, so that it exists however ill-conditioned A
is, and the later ones make Q's columns orthonormal to working precision. The composed factors are A's R; an SVD of R (as
wide as a vector) gives the components without ever squaring A's condition number: singular values are sqrt(n e).

A pass returns one row of Q'Q for each dimension and task, added up dimension by dimension in Spark; only the sum, as many
numbers as a vector's length squared, comes to the driver, and only the factors go to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .common import fresh, stage

SCALE, OFFSET, LARGEST = 1024.0, 100_000, 2**62
EPS = np.finfo(np.float64).eps
#: Passes end when Q'Q is the unit matrix to so many roundings of its width, or after so many passes.
ROUNDS = 8
#: Rows of a batch that are worked on together.
BLOCK = 4096
#: Whole numbers below this are exact in 64 bits also after a sum of a few of them.
SAFE = 2.0**62


def whole_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, x as an integer matrix) for each length of the vectors that are neither null nor hold a null or
    non-finite component. Entries beyond +-2^62 stand at that bound."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (bad[ends] == bad[ends - lengths]) & pc.is_valid(column).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[good]):
        which = np.flatnonzero(good & (lengths == size))
        for lo in range(0, len(which), BLOCK):
            at = which[lo : lo + BLOCK]
            c = flat[(ends[at] - size)[:, None] + np.arange(size)]
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c) + OFFSET, -float(LARGEST), float(LARGEST))
            yield at, x.astype(np.int64)


def added(x: np.ndarray) -> list[int]:
    """Column sums as exact Python numbers."""
    if np.abs(x.astype(np.float64)).max(initial=0.0) * len(x) >= SAFE:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: 64-bit numbers where they hold it, else Python's."""
    largest = max(np.abs(x.astype(np.float64)).max(initial=0.0) * n, float(max(map(abs, sums), default=0)))
    if largest >= SAFE / 2:
        return n * x.astype(object) - np.array(sums, dtype=object)
    return n * x - np.array(sums, dtype=np.int64)


def squares(y: np.ndarray) -> list[int]:
    """Row sums of squares, exact."""
    if y.dtype == object or np.abs(y.astype(np.float64)).max(initial=0.0) ** 2 * y.shape[1] >= SAFE:
        y = y.astype(object)
    return [int(s) for s in (y * y).sum(axis=1)]


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a times the inverse of the upper triangular r, by substitution from the first column on."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def cholesky(gram: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """The upper triangular factor of gram plus a shift: in the first pass always, later where gram is singular."""
    d = len(gram)
    norm = float(np.linalg.eigvalsh(gram)[-1])
    shift = 11 * (rows * d + d * (d + 1)) * (EPS / 2) * norm
    for s in (*([] if first else [0.0]), shift, 100 * shift, 1e4 * shift, norm):
        try:
            return np.linalg.cholesky(gram + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("no shift makes the Gram matrix positive definite")


class Space:
    """What is known of the vectors of one length: their number, sums and factors, at last the components."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.factors: list[np.ndarray] = []
        self.components, self.values, self.total = np.zeros((len(sums), 0)), np.zeros(0), 0.0
        self.done = False

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows in double precision: x - S/n with one rounding."""
        return centred(x, self.n, self.sums).astype(np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        a = self.rows(x)
        for r in self.factors:
            a = solved(a, r)
        return a

    def take(self, gram: np.ndarray) -> None:
        """Use a pass's Gram matrix: one more factor, or none if Q is orthonormal (or A is zero)."""
        self.done = not gram.any() or bool(self.factors and np.abs(gram - np.eye(len(gram))).max() <= 16 * len(gram) * EPS)
        if not self.done:
            self.factors.append(cholesky(gram, self.n, first=not self.factors))

    def finish(self, most: int) -> None:
        """Components with a positive variance, at most ``most``, by the singular values of the composed factors."""
        d = len(self.sums)
        if not self.factors:
            return
        r = np.eye(d)
        for f in self.factors:
            r = f @ r
        _, s, vt = np.linalg.svd(r)
        e = s * s / self.n
        keep = min(most, int((s > 8 * d * EPS * s[0]).sum()))
        vt = vt * np.where(np.take_along_axis(vt, np.abs(vt).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)
        self.components, self.values, self.total = vt[:keep].T, e[:keep], float(e.sum())


def sums_of(vectors: DataFrame, column: str) -> dict[int, Space]:
    """A Space for each length of the vectors, from one pass of exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}
        for batch in batches:
            for at, x in whole_rows(batch.column(0)):
                n, sums = known.get(x.shape[1], (0, [0] * x.shape[1]))
                known[x.shape[1]] = [n + len(at), [a + b for a, b in zip(sums, added(x))]]
        for size, (n, sums) in known.items():
            # Place 0 has the number of rows, place i the sum of the i-th component.
            values = [Decimal(v) for v in (n, *sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["size", "place", "value"]
            )

    found = vectors.select(column).mapInArrow(run, "size int, place int, value decimal(38,0)").groupBy("size", "place")
    spaces: dict[int, dict[int, int]] = {}
    for r in found.agg(F.sum("value").cast(DecimalType(38, 0)).alias("value")).collect():
        spaces.setdefault(r.size, {})[r.place] = int(r.value)
    return {size: Space(v[0], [v[i] for i in range(1, size + 1)]) for size, v in spaces.items()}


def gram_pass(vectors: DataFrame, column: str, spaces: dict[int, Space]) -> dict[int, np.ndarray]:
    """Q'Q for each length that is not done, Q being the centred rows after all solves so far."""
    todo = {size: s for size, s in spaces.items() if not s.done}
    schema = "size int, place int, part int, value binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        grams: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_rows(batch.column(0)):
                if x.shape[1] in todo:
                    q = todo[x.shape[1]].orthogonal(x)
                    grams[x.shape[1]] = grams.get(x.shape[1], 0.0) + q.T @ q
        for size, g in grams.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([TaskContext.get().partitionId()] * size, pa.int32()), pa.array([row.tobytes() for row in g], pa.binary())],
                names=["size", "place", "part", "value"],
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, place, value in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                sums[size, place] = sums.get((size, place), 0.0) + np.frombuffer(value)
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([-1] * len(keys), pa.int32()), pa.array([sums[k].tobytes() for k in keys], pa.binary())],
            names=["size", "place", "part", "value"],
        )

    # A task's rows arrive in the order of parts, so a rerun adds in the same order.
    parts = vectors.select(column).mapInArrow(partial, schema).repartition("size", "place").sortWithinPartitions("size", "place", "part")
    out = {size: np.zeros((size, size)) for size in todo}
    for r in parts.mapInArrow(total, schema).collect():
        out[r.size][r.place] = np.frombuffer(r.value)
    return out


def fitted(vectors: DataFrame, column: str = "embedding", components: int = 8) -> dict[int, Space]:
    """A fitted Space for each length of the vectors: see the module."""
    spaces = sums_of(vectors, column)
    for s in spaces.values():
        s.done = s.n < 2 or not s.sums
    for _ in range(ROUNDS):
        if all(s.done for s in spaces.values()):
            break
        for size, gram in gram_pass(vectors, column, spaces).items():
            spaces[size].take(gram)
    for s in spaces.values():
        s.finish(components)
    return spaces


def projected(vectors: DataFrame, spaces: dict[int, Space], key: str, column: str) -> DataFrame:
    """(key, size, deviation decimal(38,0), whitened array<double>) for each vector that counts, in one scan."""
    most = 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole_rows(batch.column(1)):
                s = spaces[x.shape[1]]
                deviation = [Decimal(v) if v < most else None for v in squares(centred(x, s.n, s.sums))]
                white = s.rows(x) @ s.components / np.sqrt(s.values)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(deviation, pa.decimal128(38, 0)), lists], names=["key", "size", "deviation", "whitened"]
                )

    kind = dict(vectors.dtypes)[key]
    return vectors.select(key, column).mapInArrow(run, f"key {kind}, size int, deviation decimal(38,0), whitened array<double>")


def identity_errors(white: DataFrame, components: int) -> dict[int, float]:
    """For each length the largest absolute entry of whitened's covariance (divisor n, centred first) less the unit matrix."""
    value = lambda i: F.get("whitened", F.lit(i))
    means = {r.size: r for r in white.groupBy("size").agg(*[F.avg(value(i)).alias(f"m{i}") for i in range(components)]).collect()}
    if not means:
        return {}
    centre = F.broadcast(white.sparkSession.createDataFrame([Row(size=s, **{f"m{i}": r[f"m{i}"] for i in range(components)}) for s, r in means.items()], "size int, " + ", ".join(f"m{i} double" for i in range(components))))
    off = lambda i: value(i) - F.col(f"m{i}")
    entries = [F.abs(F.avg(off(i) * off(j)) - F.lit(float(i == j))).alias(f"c{i}_{j}") for i in range(components) for j in range(i + 1)]
    got = white.join(centre, "size").groupBy("size").agg(*entries).collect()
    return {r.size: max((v for v in r[1:] if v is not None), default=None) for r in got}


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    deviation is the exact sum of (n*x - S)^2 as decimal(38,0), null where 38 digits do not hold it. Vectors that are null
    or hold a null or non-finite component are left out. Components have a positive variance: fewer than ``components``
    where the vectors span less, so one vector alone, equal vectors and empty ones give no row. Each component's largest
    entry is positive. Vectors of different lengths are different spaces, each fitted alone (there should be few). Ties of
    variance are numbered as the SVD leaves them. Rows that repeat a key are vectors of their own, a null key stays null.
    A very long vector is taken whole: the driver holds its length squared. An empty table gives an empty result; other
    columns are not read, whatever their names. The embeddings are read once for the sums, once for each Gram pass (three
    as a rule) and once for the result, which is staged to measure identity_error.
    """
    spark = vectors.sparkSession
    spaces = fitted(vectors, column, components)
    white = stage(projected(vectors, spaces, key, column), "whitened")
    errors = identity_errors(white, components)
    rows = [(size, k + 1, s.n, float(e / s.total), errors.get(size)) for size, s in spaces.items() for k, e in enumerate(s.values)]
    # One row for each length and component, whatever the number of vectors.
    facts = F.broadcast(spark.createDataFrame(rows, "size int, component int, n long, explained double, identity_error double"))
    place = fresh("place")
    long = white.select("key", "size", "deviation", F.posexplode("whitened").alias(place, "whitened")).withColumn("component", F.col(place) + 1)
    return long.join(facts, ["size", "component"]).select(F.col("key").alias(key), "component", "n", "deviation", "whitened", "explained", "identity_error")
