from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from assetlife.llm import whitening
from assetlife.llm.common import ship
from assetlife.llm.queries import QUERIES
from assetlife.llm.whitening import Whitener, fit, integers, limbs, products, whiten

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shape, low, high", [((5000, 9), 98_000, 102_000), ((70, 3), -2**63, 2**63 - 1), ((3, 2), 7, 8), ((129, 5), -5, 2**40), ((1, 4), 0, 2)])
def test_products_and_limbs_are_exact(shape, low, high):
    x = np.random.default_rng(1).integers(low, high, shape)
    ones = np.hstack([x.astype(object), np.ones((len(x), 1), object)])
    p = products(x)
    assert (p == ones.T @ ones).all()
    assert (sum(l.astype(object) << (32 * k) for k, l in enumerate(limbs(p))) == p).all()


def test_integers():
    assert integers(np.array([[0.0, -0.5, 1.0 / 3, -1.0 / 3, 1e300, -1e300]]))[0].tolist()[:4] == [100_000, 99_488, 100_341, 99_658]
    assert integers(np.array([[1e300, -1e300]]))[0].tolist() == [2**63 - 2**20 + 100_000, -2**63 + 100_000]


def exact(vectors):
    """n, sums and covariance of the integer vectors, as fractions."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    mean = [Fraction(t, n) for t in s]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]
    return x, n, s, cov


def check(got, vectors, k):
    """Rows of (key, n, deviation, whitened, explained, identity_error) against exact sums."""
    x, n, s, cov = exact(list(vectors.values()))
    v = np.array([[float(c) for c in row] for row in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    white = np.array([r["whitened"] for r in got], float)
    for r, row in zip(got, [x[list(vectors).index(r["vec_id"])] for r in got]):
        assert r["n"] == n and int(r["deviation"]) == sum((n * a - b) ** 2 for a, b in zip(row, s))
        assert r["explained"] == pytest.approx((e / sum(e)).tolist()[:k], rel=1e-9)
        want = ((np.array(row) - np.array(s) / n) @ u[:, :k]) / np.sqrt(e[:k])
        assert np.abs(np.array(r["whitened"], float)) == pytest.approx(np.abs(want), abs=1e-6)
    error = np.abs(white.T @ white / n - np.outer(white.mean(0), white.mean(0)) - np.eye(white.shape[1])).max()
    assert error < 1e-9 and all(abs(r["identity_error"] - error) < 1e-9 for r in got)


def test_whiten(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(whitening, "ROWS", 64)
    rng = np.random.default_rng(2)
    data = (rng.normal(size=(300, 12)) * np.arange(1, 13) + rng.normal(size=12)).astype(np.float32)
    vectors = {i: list(map(float, v)) for i, v in enumerate(data)}
    odd = [(900, None), (901, [None] * 12), (902, [1.0, float("nan")] * 6), (903, [float("-inf")] * 12), (904, [])]
    df = spark.createDataFrame([(k, v, "x") for k, v in [*vectors.items(), *odd]], "vec_id long, embedding array<float>, n string")
    for frame in (df.repartition(1), df.repartition(7)):
        out = whiten(frame, 8)
        assert out.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
        check(out.collect(), vectors, 8)
    assert whiten(df.where("vec_id >= 900")).count() == 0 and fit(df.limit(0)) == {}


def test_lengths_repeats_and_flat_columns(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    two = [(i, rng.normal(size=2).tolist()) for i in range(40)]
    flat = [(100 + i, [float(i % 5), 3.0, float(i % 5)]) for i in range(20)]  # rank 1
    rows = [*two, *flat, (None, [1.0]), (5, [1.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    by = {n: [r for r in got if len(r["whitened"]) == n] for n in (1, 2, 3)}
    check(by[2], dict(two), 2)
    assert [r["n"] for r in by[1]] == [2, 2] and all(r["whitened"] == [None] and r["explained"] == [None] and r["identity_error"] is None for r in by[1])
    assert all(r["whitened"][1:] == [None, None] and r["whitened"][0] is not None and r["identity_error"] < 1e-9 for r in by[3])


def test_deviation_beyond_longs():
    n = 10**9
    w = Whitener(n, [n * 100_000] * 3, np.eye(3), np.ones(3), 3.0)
    x = np.array([[101_024, 98_976, 100_000], [2**62, -2**62, 5]])
    assert w.deviation(x) == [sum((n * int(a) - n * 100_000) ** 2 for a in row) for row in x]


def test_query_against_exact_sums(spark):
    rows = QUERIES["op12_whitening"](spark, SF).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    good = {k: v for k, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(k, c) for k in sorted(good) for c in range(1, 9)]
    by: dict = {}
    for r in sorted(rows, key=lambda r: r["component"]):
        by.setdefault(r["vec_id"], []).append(r)
    check([{"vec_id": k, "n": r[0]["n"], "deviation": r[0]["deviation"], "identity_error": r[0]["identity_error"],
            "whitened": [x["whitened"] for x in r], "explained": [x["explained"] for x in r]} for k, r in by.items()], good, 8)
