"""Whitening against exact arithmetic and numpy on small tables."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from quayside.llm import queries as llm, whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v int, id long"


def x_of(vector):
    return tuple(math.floor(256 * c) for c in vector)


def good(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def vectors(n=150, d=6):
    r = random.Random(12)
    rows = [[float(np.float32(r.gauss(3 * k, 1 + k))) for k in range(d)] for _ in range(n)]
    rows += [rows[0]] * 60 + [rows[5]] * 3  # copies count once
    rows += [[c + 1e-5 for c in rows[7]]]  # another vector, perhaps the same x
    rows += [None, [None] * d, [float("nan")] * d, [1.0] * (d - 1) + [float("inf")], [-math.inf] + [0.0] * (d - 1)]
    rows += [[-0.0] * d, [-0.001] * d]
    return [(k if k % 9 else None, v, 1, "x", 2, 3) for k, v in enumerate(rows)]


def expected(rows):
    """x of the fit list, its exact sums and covariance."""
    fit = sorted({x_of(np.float32(v).astype(float)) for _, v, *_ in rows if good(v)})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit), n**3) for b in range(d)] for a in range(d)]
    return fit, sums, np.array([[float(c) for c in row] for row in cov])


def test_query_against_exact_arithmetic(spark, tmp_path):
    rows = vectors()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = llm.QUERIES["op12_whitening"](spark, str(tmp_path)).collect()
    fit, sums, cov = expected(rows)
    n = len(fit)
    values = np.linalg.eigvalsh(cov)[::-1][:4]
    usable = [(k, x_of(np.float32(v).astype(float))) for k, v, *_ in rows if good(v)]
    assert len(got) == 4 * len(usable) and {r["n"] for r in got} == {n}
    dev = {x: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in usable}
    assert sorted((repr(r["vec_id"]), r["component"], r["deviation"]) for r in got) == sorted(
        (repr(k), c, dev[x]) for k, x in usable for c in (1, 2, 3, 4))
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    # whitened values: those of numpy, but for one sign a component
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    axes = np.linalg.eigh(cov)[1][:, ::-1][:, :4]
    named = [(k, x) for k, x in usable if k is not None]
    want = np.array([[a - s / n for a, s in zip(x, sums)] for _, x in named]) @ axes / np.sqrt(values)
    have = np.array([[by_id[k][c] for c in (1, 2, 3, 4)] for k, _ in named])
    signs = np.sign((want * have).sum(0))
    assert np.abs(have - want * signs).max() < 1e-9


def test_bit_slices_give_exact_products():
    r = random.Random(1)
    for d, n, size in ((1, 1, 5), (3, 63, 2**9), (2, 64, 2**20), (4, 65, 2**40), (2, 200, 2**52), (5, 10, 1)):
        x = np.array([[r.randrange(-size, size) for _ in range(d)] for _ in range(n)])
        total, product = wh.scatter(x)
        exact = x.astype(object)
        assert list(total) == list(exact.sum(0)) and (product == exact.T @ exact).all()


def test_large_means_and_wide_numbers_cost_nothing(spark):
    r = random.Random(2)
    rows = [(k, [1e9 + r.random(), -3e11 + 1e3 * r.random(), r.random() / 100]) for k in range(500)]
    got = wh.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    fit = {x_of(v) for _, v in rows}
    n, sums = len(fit), [sum(x[k] for x in fit) for k in range(3)]
    assert {r["id"]: int(r["deviation"]) for r in got} == {
        k: sum((n * a - s) ** 2 for a, s in zip(x_of(v), sums)) for k, v in rows}
    assert max(r["identity_error"] for r in got) < 1e-9


def test_without_variance(spark, tmp_path):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None)]
    flat = wh.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["id"], r["component"]) for r in flat) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert {(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in flat} == {
        (1, 0, None, 0.0, None)}
    line = wh.whitened(spark.createDataFrame([(k, [k / 4, 1.0]) for k in range(9)], "vec_id long, embedding array<float>")).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-12 for r in line)
    for name, rows in (("none", []), ("null", [(1, None), (None, [None])]), ("short", [(1, []), (2, [])])):
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        assert llm.QUERIES["op12_whitening"](spark, f"{tmp_path}/{name}").collect() == []


@pytest.mark.parametrize("odd", [[0.5], [1e300, 0.0]])
def test_errors(spark, odd):
    frame = spark.createDataFrame([(1, [0.5, 0.25]), (2, odd)], "vec_id long, embedding array<double>").coalesce(1)
    with pytest.raises(Exception, match="vectors of different lengths|does not fit"):
        wh.whitened(frame).collect()
