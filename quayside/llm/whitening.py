"""Embedding whitening with an exact covariance: bit-sliced scatter.

Vectors become whole numbers, x = floor(256 * c).  A batch's numbers are shifted by each dimension's smallest, and
each bit of a dimension is packed across rows into words.  The sum of products of two dimensions is then a weighted
sum of popcounts: for bits p and q the number of rows where both are set counts 2**(p + q).  Shifts are undone in whole
numbers, tasks are added up in Spark as decimals, and the products are centred as whole numbers of any size,
n * sum(x_a * x_b) - S_a * S_b, before anything is rounded: neither a large mean nor many rows cost a digit.  ``eigh`` of
the covariance gives the components.

What comes to the driver is one number per pair of dimensions.  Statistics are taken over the different x vectors (the
fit list); copies fold in a partial aggregate, so a vector that a third of all rows share is one row a task.

Rows whose vector is null or has null or non-finite entries are dropped, all others get a result; rows without an id
and repeated rows are rows like others, and no other column is looked at.  Vectors of different lengths, and entries
whose x does not fit 53 bits, are errors.  Vectors without entries have no components and so no rows.  Components along which the fit list does not vary (an eigenvalue below
rounding) get explained 0 and whitened null and are left out of the identity; with no variance at all (one vector, or
copies of one) identity_error is null.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import scratch
from .shared import batch, by_batch, drop_shuffles, table, tidy

SCALE = 256
COMPONENTS = 4
LARGEST = 1 << 53
ROWS = 1 << 13  # rows whose bits are packed at a time
_WIDTHS = {2: np.int16, 4: np.int32, 8: np.int64}


def _numbers(column: pa.Array) -> np.ndarray:
    """x of a column of vectors without nulls, one row each."""
    sizes = pc.unique(pc.list_value_length(column))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes.to_pylist())}")
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError("an entry times 256 does not fit 53 bits")
    return scaled.astype(np.int64).reshape(len(column), sizes[0].as_py() if len(sizes) else 0)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there and has finite entries only; the vector as doubles."""
    whole = rows.withColumn(vector, F.col(vector).cast("array<double>"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return whole.filter(F.col(vector).isNotNull() & ~F.exists(vector, odd))


def fit_list(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Each x vector once, as bytes: a byte that says how wide a number is, and the numbers."""

    def work(found):
        x = _numbers(found.column("v"))
        most = np.abs(x).max(1, initial=0)
        out = np.empty(len(x), object)
        for width, kind in _WIDTHS.items():
            own = np.flatnonzero((most < 1 << (8 * width - 1)) & np.equal(out, None))
            for k, row in zip(own.tolist(), x[own].astype(kind)):
                out[k] = bytes([width]) + row.tobytes()
        yield batch(x=pa.array(out.tolist(), pa.binary()))

    return by_batch(rows.select(F.col(vector).alias("v")), work, "x binary").distinct()


def _unpacked(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    first = raw[0]
    if all(r[0] == first[0] and len(r) == len(first) for r in raw):
        return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)[:, 1:].copy().view(_WIDTHS[first[0]]).astype(np.int64)
    rows = [np.frombuffer(r, _WIDTHS[r[0]], offset=1) for r in raw]
    if len({len(r) for r in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return np.stack(rows).astype(np.int64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the columns of ``x``, as whole numbers of any size."""
    n, d = x.shape
    if not d:
        return np.zeros(0, object), np.zeros((0, 0), object)
    low = x.min(0)
    shifted = (x - low).astype(np.uint64)
    k = max(1, int(shifted.max(initial=0)).bit_length())
    rows = np.pad(shifted, ((0, -n % 64), (0, 0)))
    # plane p of dimension a, 64 rows to a word, at a * k + p
    planes = np.stack([
        np.packbits(np.ascontiguousarray((rows >> np.uint64(p)).T.astype(np.uint8) & 1), axis=1).view(np.uint64)
        for p in range(k)
    ], 1).reshape(d * k, -1)
    both = np.zeros((d * k, d * k), np.int64)
    for a in range(d * k):
        both[a, a:] = np.bitwise_count(planes[a] & planes[a:]).sum(1, dtype=np.int64)
    both += np.triu(both, 1).T
    exact = np.int64 if 2 * k + n.bit_length() < 63 else object
    weight = np.array([1 << p for p in range(k)], exact)
    product = (both.astype(exact).reshape(d, k, d, k) * weight[:, None, None] * weight).sum((1, 3)).astype(object)
    total = (both.diagonal().astype(exact).reshape(d, k) * weight).sum(1).astype(object)
    shift = low.astype(object)
    product = product + np.outer(shift, total) + np.outer(total, shift) + n * np.outer(shift, shift)
    return total + n * shift, product


@dataclass(frozen=True)
class Whitening:
    """What a fit list says: its size, sums, components and eigenvalues."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # one column a component
    values: np.ndarray  # their eigenvalues, 0 below rounding
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as whole numbers."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if bound < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (centred.astype(np.float64) / max(1, self.n)) @ self.axes / np.sqrt(self.values)
        return np.where(self.values > 0, out, np.nan)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of a fit list, or None if it is empty.  The list is read once."""

    def work(batches):
        n, sums, products = 0, 0, 0
        for found in batches:
            column = found.column("x")
            for at in range(0, len(column), ROWS):
                x = _unpacked(column.slice(at, ROWS))
                total, product = scatter(x)
                n, sums, products = n + len(x), sums + total, products + product
        if n:
            d = len(sums)
            a, b = np.triu_indices(d)
            kind = pa.decimal128(38, 0)
            yield batch(a=a.astype(np.int32), b=b.astype(np.int32), total=pa.array(_decimals(products[a, b]), kind))
            # sums stand in row -1, the number of rows before them
            yield batch(a=np.full(d + 1, -1, np.int32), b=np.arange(-1, d, dtype=np.int32),
                        total=pa.array(_decimals([n, *sums]), kind))

    found = vectors.mapInArrow(tidy(work), "a int, b int, total decimal(38,0)").groupBy("a", "b").agg(
        F.sum("total").alias("total")).collect()
    if not found:
        return None
    got = {(r["a"], r["b"]): int(r["total"]) for r in found}
    d = len({b for a, b in got if a == -1}) - 1
    n, sums = got[-1, -1], [got[-1, k] for k in range(d)]
    cov = np.zeros((d, d))
    for a in range(d):
        for b in range(a, d):
            # whole numbers up to here: this division is the only rounding
            cov[a, b] = cov[b, a] = (n * got[a, b] - sums[a] * sums[b]) / (n * n)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(components, d)]
    trace = float(cov.trace())
    values, axes = values[order], axes[:, order]
    values = np.where(values > d * np.finfo(np.float64).eps * max(trace, 0.0), values, 0.0)
    return Whitening(n, tuple(sums), axes, values, trace)


def _decimals(values):
    from decimal import Decimal

    return [Decimal(int(v)) for v in values]


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, from its rows."""
    kept = np.flatnonzero(model.values > 0)

    def work(batches):
        total = np.zeros((len(kept), len(kept)))
        for found in batches:
            column = found.column("x")
            for at in range(0, len(column), ROWS):
                white = model.whiten(model.centred(_unpacked(column.slice(at, ROWS))))[:, kept]
                total += white.T @ white
        a, b = np.indices(total.shape)
        yield batch(a=a.ravel().astype(np.int32), b=b.ravel().astype(np.int32), total=total.ravel())

    if not len(kept):
        return None
    found = vectors.mapInArrow(tidy(work), "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("t"))
    return max(abs(r["t"] / model.n - (r["a"] == r["b"])) for r in found.collect())


def whitened(
    rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """id, component, n, deviation decimal(38,0), whitened, explained, identity_error: a row per usable vector and component."""
    good = usable(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v")
    with scratch(rows.sparkSession) as files:
        vectors = files.keep(fit_list(good, "v"), "fit-list")
    drop_shuffles(rows.sparkSession)
    model = fit(vectors, components)
    error = None if model is None else identity_error(vectors, model)
    schema = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")

    def work(found):
        for at in range(0, found.num_rows, ROWS):
            part = found.slice(at, ROWS)
            centred = model.centred(_numbers(part.column("v")))
            m, k = len(centred), len(model.values)
            bound = max(abs(int(centred.max(initial=0))), abs(int(centred.min(initial=0)))) ** 2 * max(1, centred.shape[1])
            square = centred if bound < 1 << 62 else centred.astype(object)
            deviation = (square * square).sum(1)
            white = model.whiten(centred).ravel()
            share = model.values / model.trace if model.trace > 0 else np.zeros(k)
            each = pa.array(np.repeat(np.arange(m), k))
            yield batch(
                id=part.column("id").take(each),
                component=np.tile(np.arange(1, k + 1, dtype=np.int32), m), n=np.full(m * k, model.n, np.int64),
                deviation=pa.array(_decimals(deviation), pa.decimal128(38, 0)).take(each),
                whitened=pa.array(white, mask=np.isnan(white)), explained=np.tile(share, m),
                identity_error=pa.array([error] * (m * k), pa.float64()),
            )

    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    return by_batch(good.select(F.col("id").cast("long").alias("id"), "v"), work, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it does not fit a long."""
    return whitened(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened", "explained", "identity_error")
