from __future__ import annotations

import math

import numpy as np
import pytest

from assetlife.llm import embed_dedup
from assetlife.llm.embed_dedup import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n long, part string"


def brute(rows, threshold=0.93):
    ok = [i for i, (k, v, lab) in enumerate(rows) if k is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) / np.linalg.norm(np.array(rows[i][1], np.float32).astype(float)) for i in ok}
    links = {i: [j for j in ok if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold] for i in ok}
    root = {i: rows[i][0] for i in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for i, js in links.items():
            low = min([root[i], *(root[j] for j in js)])
            for j in [i, *js]:
                if root[j] != low:
                    root[j], changed = low, True
    return sorted(((rows[i][0], len(links.get(i, [])), root[i]) for i in range(len(rows))), key=str)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(k, v, lab, 3, "x") for k, v, lab in rows], SCHEMA)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in near_vectors(frame, **kw).collect()), key=str)


def clusters(seed, groups, spread, d=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g, size in enumerate(groups):
        centre = rng.standard_normal(d)
        for _ in range(size):
            rows.append((len(rows) * 2, (centre + spread * rng.standard_normal(d)).tolist(), g % 3))
    return rows


def test_matches_brute_force(spark):
    rows = clusters(1, [1] * 60 + [2] * 20 + [5] * 6 + [30], 0.12)
    rows += [(1001 + 2 * i, rows[0][1], rows[0][2]) for i in range(5)]  # copies
    rows += [(2001, None, 1), (2003, [0.0] * 16, 1), (2005, [float("nan")] * 16, 1), (2007, [1.0, None] * 8, 1), (2009, [float("inf")] + [0.0] * 15, 1), (2011, rows[0][1], None), (None, rows[0][1], rows[0][2]), (2013, [], 1)]
    rows += [(2015, [1.0, 2.0], 1), (2017, [2.0, 4.0], 1), (2019, [1e-30, 2e-30], 1)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [4, 16])
def test_groups_larger_than_the_window(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rows = clusters(2, [150, 40, 1, 1, 1, 60], 0.05)
    assert run(spark, rows, passes=3) == brute(rows)


def test_recall_in_a_large_label(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):  # pairs just over the threshold among many strangers
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        u = rng.standard_normal(64)
        u -= (u @ v) * v
        u /= np.linalg.norm(u)
        rows += [(2 * i, v.tolist(), 1), (2 * i + 1, (0.97 * v + math.sqrt(1 - 0.97**2) * u).tolist(), 1)]
    got, want = run(spark, rows), brute(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert true >= 3000 and 0.9 * true <= found <= true
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_empty_and_ties(spark):
    assert run(spark, []) == []
    rows = [(5, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (9, [-1.0, 0.0], 1)]
    got = run(spark, rows)
    assert [r for r in got if r[0] == 5] == [(5, 2, 3)] and [r for r in got if r[0] == 9] == [(9, 0, 9)] and len(got) == 5


def test_links_of_a_hot_group_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)
    rng = np.random.default_rng(5)
    d, hot, strangers = 64, 2000, 4000  # the group spans 62 blocks
    centre = rng.standard_normal(d)
    centre /= np.linalg.norm(centre)
    noise = rng.standard_normal((hot, d))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    v = np.concatenate((centre + noise * rng.uniform(0.2, 0.32, (hot, 1)), rng.standard_normal((strangers, d)))).astype(np.float32)
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.93).sum(axis=1) - 1
    got = {r[0]: r[1] for r in run(spark, [(i, x.tolist(), 1) for i, x in enumerate(v)])}
    found = np.array([got[i] for i in range(len(v))])
    assert 10**6 < want.sum() < 0.98 * hot * hot and (found <= want).all() and found.sum() >= 0.999 * want.sum()


def test_passes_follow_the_largest_label():
    few, many = embed_dedup._passes(10**4, 0.93), embed_dedup._passes(10**7, 0.93)
    assert few <= embed_dedup.PASSES < many and embed_dedup._passes(0, 0.93) == 1 and embed_dedup._passes(10**6, 1.0) == 1
