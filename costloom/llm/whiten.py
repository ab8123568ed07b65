"""Embedding whitening from an exact covariance, found by bit-sliced scatter.

Every entry c becomes the integer x = floor(64 c) + 1000000 (``quantise``). In blocks of rows, each dimension is shifted by its least
value there and its bits are turned into planes, packed across rows into 64-bit words. The sum of products of two dimensions
is the sum over pairs of planes of the AND's popcount times the planes' weights: whole numbers, without rounding. Blocks
and tasks add up to exact sums of products, which are centred as integers of any size before the eigenvectors are found,
so the large offset costs no digit. A second pass projects every row.

A task holds one block and one sum for each pair of dimensions; the driver gets as many numbers as there are pairs of dimensions,
however many rows there are. The components go to the workers with the function, at most dimensions squared numbers.

Vectors that are null or hold null or non-finite entries are dropped; so are vectors of another length than the most frequent
one (of equally frequent ones the longest), as they have no place in the covariance, and empty vectors. Entries so large that 64 c
passes 2**62 are taken as that bound. Repeated rows count repeatedly; equal eigenvalues keep the order of the solver. Components
without variance (constant or dependent dimensions, fewer rows than dimensions) have whitened null, and explained 0. Empty
tables give empty results. Texts play no part. All other columns, also null ones, are kept; new columns get underscores
behind their names where a column has the name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 62
COMPONENTS = 32
BLOCK = 1 << 13
_LIMB = 20  # bits of a plane weight that stay exact in 64-bit sums over a block
_HALF = 60


def quantise(c: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(c * SCALE), -LIMIT, LIMIT - 1024).astype(np.int64) + OFFSET


def vectors(column, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether a row stays, the entries of the rows that stay, as doubles) of an Arrow column of lists."""
    import pyarrow as pa

    lists = column.cast(pa.large_list(pa.float64()))
    stays = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False), bool)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    stays &= sizes == dimensions
    flat = lists.filter(pa.array(stays)).flatten()
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(axis=1)
    stays[np.flatnonzero(stays)[~finite]] = False
    return stays, values[finite]


class Scatter:
    """Number of rows, sums and sums of products of the rows' integers, exact."""

    def __init__(self, dimensions: int):
        self.n, self.sums = 0, np.zeros(dimensions, object)
        self.products = np.zeros((dimensions, dimensions), object)

    def add(self, x: np.ndarray) -> None:
        rows, dims = x.shape
        if not rows:
            return
        low = x.min(axis=0)
        y = (x - low).astype(np.uint64)  # a span of 2**63 still fits
        planes, owner, shift = self._planes(y)
        counts = np.zeros((len(planes), len(planes)), np.int64)
        for i in range(len(planes)):  # ANDs of one plane with itself and all later ones
            counts[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
        counts = counts + np.triu(counts, 1).T
        limbs = [self._weights(dims, owner, shift, k) for k in range(0, int(shift.max(initial=0)) + 1, _LIMB)]
        shifted = np.zeros((dims, dims), object)
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                shifted += (a @ counts @ b.T).astype(object) << (_LIMB * (i + j))
        totals = np.zeros(dims, object)
        for i, a in enumerate(limbs):
            totals += (a @ np.diag(counts)).astype(object) << (_LIMB * i)
        low = low.astype(object)
        self.n += rows
        self.sums = self.sums + totals + rows * low
        self.products = self.products + shifted + np.outer(low, totals) + np.outer(totals, low) + rows * np.outer(low, low)

    @staticmethod
    def _planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bit planes of all dimensions, packed across rows into words, with their dimension and bit."""
        rows, dims = y.shape
        bits = [int(v).bit_length() for v in y.max(axis=0).tolist()]
        owner = np.repeat(np.arange(dims), bits)
        shift = np.concatenate([np.arange(b) for b in bits]).astype(np.int64) if dims else np.zeros(0, np.int64)
        words = np.zeros((len(owner), -(-rows // 64) * 8), np.uint8)
        for p, (d, s) in enumerate(zip(owner.tolist(), shift.tolist())):
            packed = np.packbits((y[:, d] >> np.uint64(s) & np.uint64(1)).astype(np.uint8))
            words[p, :len(packed)] = packed
        return words.view(np.uint64), owner, shift

    @staticmethod
    def _weights(dims: int, owner: np.ndarray, shift: np.ndarray, begin: int) -> np.ndarray:
        """Weights of the planes in the dimensions, of the bits from ``begin`` on."""
        out = np.zeros((dims, len(owner)), np.int64)
        here = (shift >= begin) & (shift < begin + _LIMB)
        out[owner[here], np.flatnonzero(here)] = np.int64(1) << (shift[here] - begin)
        return out

    def rows(self):
        """(first, second, high, low) of all sums, in halves that longs hold: first -1 stands for rows and sums."""
        half = 1 << _HALF
        yield -1, -1, 0, self.n
        for a, s in enumerate(self.sums):
            yield -1, a, s // half, s % half
            for b in range(a, len(self.sums)):
                v = self.products[a, b]
                yield a, b, v // half, v % half


@dataclass
class Whitener:
    """``mean`` as whole part and rest over n, ``matrix``: a row per component over the root of its eigenvalue (zeros without
    variance), ``explained`` per component, ``real``: components with variance."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    explained: np.ndarray
    real: int
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return ((x - whole).astype(np.float64) - rest) @ self.matrix.T

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)**2, exact: with y = x - S // n and r = S % n it is n n y.y - 2 n r.y + r.r."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        y = x - whole
        most = int(np.abs(y).max(initial=0))
        if most * most * y.shape[1] < 1 << 62 and most * self.n * y.shape[1] < 1 << 62:
            yy, ry = (y * y).sum(axis=1).tolist(), (y @ np.array(rest, np.int64)).tolist()
        else:
            wide = y.astype(object)
            yy, ry = (wide * wide).sum(axis=1).tolist(), (wide @ np.array(rest, object)).tolist()
        rr = sum(r * r for r in rest)
        return [self.n * self.n * a - 2 * self.n * b + rr for a, b in zip(yy, ry)]


def solve(n: int, sums: list[int], products: np.ndarray, components: int = COMPONENTS) -> Whitener:
    """Components of the covariance, centred as integers: n * products - sums x sums, over n * n."""
    dims = len(sums)
    centred = n * products - np.outer(np.array(sums, object), np.array(sums, object))
    cov = np.array([[int(v) / (n * n) for v in row] for row in centred])
    values, vectors_ = np.linalg.eigh(cov)
    values, vectors_ = values[::-1], vectors_[:, ::-1].T
    # The solver's values are off by some units in the last place of the largest one; Rayleigh quotients are not, by much.
    wide = cov.astype(np.longdouble)
    values = np.array([float(v @ wide @ v / (v @ v)) for v in vectors_.astype(np.longdouble)])
    real = int((values[:components] > values.max(initial=0) * dims * np.finfo(float).eps).sum()) if dims else 0
    matrix = np.zeros((min(components, dims), dims))
    matrix[:real] = vectors_[:real] / np.sqrt(values[:real])[:, None]
    total = np.trace(wide)
    explained = np.array([float(v / total) for v in values[:real]] + [0.0] * (len(matrix) - real))
    got = matrix[:real].astype(np.longdouble) @ wide @ matrix[:real].astype(np.longdouble).T
    error = float(np.abs(got - np.eye(real)).max(initial=0))
    return Whitener(n, sums, matrix, explained, real, error)


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of a vector, 0 if there is none."""
    counts = df.select(F.size(vector).alias("d")).filter("d > 0").groupBy("d").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.desc("d")).first()
    return top.d if top else 0


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """The whitening of all vectors, None without any."""
    dims = dimension(df, vector)
    if not dims:
        return None

    def run(batches):
        import pyarrow as pa

        total = Scatter(dims)
        for batch in batches:
            _, entries = vectors(batch.column(0), dims)
            for at in range(0, len(entries), BLOCK):
                total.add(quantise(entries[at:at + BLOCK]))
        if total.n:
            columns = zip(*total.rows())
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64())
            made = (map(str, c) if t == pa.string() else c for c, t in zip(columns, types))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(made, types)], names=["a", "b", "high", "low"])

    parts = df.select(F.col(vector).alias("v")).mapInArrow(run, "a int, b int, high string, low long")
    sums = parts.groupBy("a", "b").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    value = {(r.a, r.b): (int(r.high) << _HALF) + int(r.low) for r in sums}
    if not value:
        return None
    products = np.zeros((dims, dims), object)
    for a in range(dims):
        for b in range(a, dims):
            products[a, b] = products[b, a] = value[a, b]
    return solve(value[-1, -1], [value[-1, a] for a in range(dims)], products, components)


def transform(df: DataFrame, whitener: Whitener | None, vector: str = "embedding") -> DataFrame:
    """The rows of ``df`` whose vectors stay, with ``whitened``, an array with an entry per component, and ``deviation``."""
    kept = df.columns
    names = [fresh("whitened", kept), fresh("deviation", kept)]
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.ArrayType(T.DoubleType())), T.StructField(names[1], T.StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches if whitener else ():
            at = kept.index(vector)
            stays, entries = vectors(batch.column(at), len(whitener.sums))
            x = quantise(entries)
            out = whitener.whitened(x)
            real = np.tile(np.arange(out.shape[1]) < whitener.real, len(out))
            flat = pa.array(out.reshape(-1), mask=~real)
            offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            left = batch.filter(pa.array(stays))
            yield pa.RecordBatch.from_arrays(
                [*left.columns, pa.ListArray.from_arrays(offsets, flat), pa.array(map(str, whitener.deviation(x)), pa.string())],
                names=[*kept, *names])

    return df.mapInArrow(run, schema).withColumn(names[1], F.col(names[1]).try_cast("decimal(38,0)"))


def whiten(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component, numbered from 1 by falling eigenvalue. A deviation past the long range is null."""
    whitener = fit(df, vector, components)
    rows = transform(df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), whitener, "vector")
    n, error, explained = (whitener.n, whitener.identity_error, whitener.explained.tolist()) if whitener else (0, 0.0, [])
    shares = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    return rows.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
