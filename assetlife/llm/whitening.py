"""Whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers.  A task shifts each dimension's integers to be
non-negative, packs every bit plane of every dimension across rows into 64-bit
words and counts the set bits of each pair of planes' AND; weighted by the powers
of two of its planes a count is an exact part of a cross-product.  A plane of ones
rides along, so sums and counts fall out of the same products, and the shift is
taken back exactly.  Tasks send sums of products only, in 32-bit limbs that add
without overflow; the driver holds one (dimensions x dimensions) matrix, centres
it as integers (n times products minus products of sums) and only then divides
and calls eigh.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.session import materialize

#: Rows whose planes are packed at a time (a multiple of 64).
ROWS = 4096
SCALE, LIFT = 1024, 100_000
LIMBS = 4
_MASK = (1 << 32) - 1


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 as 64-bit integers (at their ends, beyond them)."""
    with np.errstate(over="ignore"):
        x = np.floor(vectors.astype(np.float64) * SCALE)
    top = float((1 << 63) - (1 << 20))
    return np.clip(x, -float(1 << 63), top).astype(np.int64) + LIFT


def planes(y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Bit planes of the columns of ``y`` (unsigned): packed words, and (column,
    bit) of each plane; columns have as many planes as their largest value."""
    rows, dims = y.shape
    which = [(i, b) for i, top in enumerate(y.max(axis=0).tolist()) for b in range(int(top).bit_length())]
    packed = np.zeros((len(which), -(-rows // 64) * 8), np.uint8)
    for at, (i, b) in enumerate(which):
        bits = np.packbits((y[:, i] >> np.uint64(b)).astype(np.uint8) & 1)
        packed[at, :len(bits)] = bits
    return packed.view(np.uint64), which


def products(x: np.ndarray) -> np.ndarray:
    """Exact sums of x_i x_j over the rows of ``x`` (64-bit integers), a column
    of ones added at the end, as Python integers."""
    rows, dims = x.shape
    shift = [int(m) for m in x.min(axis=0)] + [0]
    y = np.ones((rows, dims + 1), np.uint64)
    y[:, :dims] = (x - x.min(axis=0)).view(np.uint64)  # modulo 2^64, where it fits
    packed, which = planes(y)
    column = np.array([i for i, _ in which], np.int64)
    bit = [b for _, b in which]
    out = np.zeros((dims + 1, dims + 1), object)
    narrow = 2 * max(bit) + 2 + rows.bit_length() < 63
    power = np.array([1 << b for b in bit], np.int64 if narrow else object)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1))
    for at in range(len(which)):
        counts = np.bitwise_count(packed & packed[at]).sum(axis=1, dtype=np.int64)
        weighted = counts * power if narrow else counts.astype(object) * power
        sums = np.add.reduceat(weighted, starts) * power[at]
        out[column[at], column[starts]] += sums.astype(object)
    m, s, n = np.array(shift, object), out[:, dims].copy(), rows
    return out + np.outer(m, s) + np.outer(s, m) + n * np.outer(m, m)


def limbs(v: np.ndarray) -> list[np.ndarray]:
    """``v`` (Python integers) as LIMBS numbers of 32 bits, the last one signed."""
    return [np.array((v >> (32 * k)) & _MASK if k < LIMBS - 1 else v >> (32 * k), np.int64) for k in range(LIMBS)]


def _clean(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v) of the rows whose vector has no null or non-finite entry, and any entry."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.select(F.col(key).alias("k"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) of a batch's list column, by length."""
    lists = batch.column(column)
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, flat[ends[rows][:, None] + np.arange(d)]


@dataclass
class Whitener:
    """Principal components of one length's integer vectors."""

    n: int
    sums: list[int]
    components: np.ndarray  # one a row, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    def deviation(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n x - S)^2, exact."""
        most = float(np.abs(x.astype(np.float64) * self.n).max() + max(map(abs, self.sums)))
        widest = float(np.abs(x.astype(np.float64) * self.n - np.array(self.sums, np.float64)).max()) + most * 1e-12
        narrow = most < 2.0**62 and widest * widest * x.shape[1] < 2.0**62
        kind = np.int64 if narrow else object
        centred = x.astype(kind) * self.n - np.array(self.sums, kind)
        return (centred * centred).sum(axis=1).tolist()

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        """x - S/n on the first ``k`` components, over sqrt(eigenvalue); NaN
        where a component has no variance."""
        mean = [divmod(s, self.n) for s in self.sums]
        centred = (x - np.array([q for q, _ in mean])).astype(np.float64) - np.array([r / self.n for _, r in mean])
        least = len(self.sums) * np.finfo(float).eps * max(float(self.eigenvalues[0]), 0.0)
        some = self.eigenvalues[:k] > least
        root = np.sqrt(np.where(some, self.eigenvalues[:k], np.nan))
        return np.einsum("rd,kd->rk", centred, self.components[:k]) / root


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> dict[int, Whitener]:
    """A ``Whitener`` of all vectors of each length (usually there is one).

    Rows whose vector is null, empty or holds a null or non-finite entry count
    for nothing; repeated rows count each; an empty table gives no whitener.
    The driver holds (length + 1)^2 sums of each length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for d, _, v in _by_length(batch, 0):
                for a in range(0, len(v), ROWS):
                    for k, limb in enumerate(limbs(products(integers(v[a:a + ROWS])))):
                        sums.setdefault(d, [np.zeros((d + 1, d + 1), np.int64) for _ in range(LIMBS)])[k] += limb
        for d, parts in sums.items():
            for i in range(d + 1):  # the upper triangle
                j = np.arange(i, d + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), c, np.int32)) for c in (d, i)] + [pa.array(j.astype(np.int32))] + [pa.array(p[i, i:]) for p in parts], names=["d", "i", "j", *[f"p{k}" for k in range(LIMBS)]])

    each = _clean(vectors, key, vector).select("v").mapInArrow(run, "d int, i int, j int, " + ", ".join(f"p{k} bigint" for k in range(LIMBS)))
    total = each.groupBy("d", "i", "j").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(LIMBS)])
    matrices: dict[int, np.ndarray] = {}
    for r in total.collect():  # (length + 1)^2 / 2 rows
        m = matrices.setdefault(r["d"], np.zeros((r["d"] + 1, r["d"] + 1), object))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = sum(r[f"p{k}"] << (32 * k) for k in range(LIMBS))
    return {d: _decompose(m) for d, m in matrices.items()}


def _decompose(m: np.ndarray) -> Whitener:
    n, sums = m[-1, -1], m[-1, :-1].tolist()
    centred = n * m[:-1, :-1] - np.outer(m[-1, :-1], m[-1, :-1])  # n^2 times the covariance, whole numbers
    cov = np.array([[c / (n * n) for c in row] for row in centred.tolist()], np.float64)  # each rounded once
    values, components = np.linalg.eigh(cov)
    return Whitener(n, sums, components.T[::-1].copy(), values[::-1].copy(), sum(centred.diagonal().tolist()) / (n * n))


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding", fitted: dict[int, Whitener] | None = None) -> DataFrame:
    """(key, n, deviation, whitened, explained, identity_error) of each row that
    ``fit`` counts; ``whitened`` and ``explained`` are arrays of the first
    ``components`` components, at most as many as dimensions.

    ``deviation`` is decimal(38, 0) (null beyond).  ``identity_error`` is the
    largest absolute entry of the covariance of ``whitened``, over all rows of
    the vector's length, minus the identity.  Components without variance
    (constant columns, fewer rows than dimensions) are null in ``whitened`` and
    left out of ``identity_error``, which is null if none is left; ``explained``
    is null if nothing varies.  Vectors of several lengths are whitened each
    among those of their own length.  Null and repeated keys are rows like any
    other; other columns are not read.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(fit(vectors, key, vector) if fitted is None else fitted)  # components x dimensions
    rows = _clean(vectors, key, vector)
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, v in _by_length(batch, 1):
                w = shared.value.get(d)
                if w is None:
                    continue
                x = integers(v)
                white = w.whiten(x, components)
                flat = pa.array(white.ravel(), from_pandas=True)  # NaN: null
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), d, np.int32)), pa.array([str(v) for v in w.deviation(x)], pa.string()), lists], names=["k", "d", "deviation", "whitened"])

    done = materialize(rows.mapInArrow(run, f"k {kind}, d int, deviation string, whitened array<double>"), "whitened")
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    at = lambda i: F.try_element_at("whitened", F.lit(i + 1))
    errors = [F.abs(F.covar_pop(at(i), at(j)) - float(i == j)) for i, j in pairs]
    worst = {r["d"]: r["e"] for r in done.groupBy("d").agg(F.array_max(F.array(*errors)).alias("e")).collect()}  # one row a length
    facts = [(d, w.n, [float(e) / w.trace if w.trace > 0 else None for e in w.eigenvalues[:components]], worst.get(d)) for d, w in shared.value.items()]
    facts = spark.createDataFrame(facts, "d int, n long, explained array<double>, identity_error double")
    return done.join(F.broadcast(facts), "d").select(F.col("k").alias(key), "n", F.expr("try_cast(deviation AS decimal(38, 0))").alias("deviation"), "whitened", "explained", "identity_error")
