from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from assetlife.llm.mixing import cycled_weights, mix, water_fill

SCHEMA = "doc_id long, text string, source string, size string, extra int"


def fill(sizes, weights, share, most):
    """Clamp and share again, one source at a time."""
    caps = [most * s for s in sizes]
    total, target, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        level = (total - sum(caps[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        above = {i for i in free if level * weights[i] >= caps[i]}
        if not above:
            for i in free:
                target[i] = level * weights[i]
            break
        free -= above
    for i in range(len(sizes)):
        if i not in free:
            target[i] = caps[i]
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100, 100], [1000, 1, 1, 1, 1], [5, 0, 80, 3000, 12, 7, 7], [10], [1, 10_000]])
def test_water_fill(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes))]
    table = cycled_weights(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"))
    got = {r["source"]: r["target"] for r in water_fill(table, 1.5, 2.0).collect()}
    want = fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2.0)
    for n, w in zip(names, want):
        assert got[n] == pytest.approx(w)
    assert sum(want) == pytest.approx(1.5 * sum(sizes))


def test_weights_follow_code_points_null_last(spark):
    table = spark.createDataFrame([("b", 1), (None, 1), ("B", 1), ("é", 1), ("", 1)], "source string, source_size long")
    assert {r["source"]: r["weight"] for r in cycled_weights(table).collect()} == {"": 3, "B": 1, "b": 2, "é": 3, None: 1}


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 40))), rng.choice(["a"] * 8 + ["b", "c", None, "d"]), "s", i) for i in range(3000)]
    rows += [(5000, None, "a", "s", 0), (5001, "", "e", "s", 0), (5002, "x\x0by\x1fz", "f", "s", 0), (None, "p q", "a", "s", 0), (7, rows[7][1], rows[7][2], "s", 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mix(docs)
    assert out.columns == ["doc_id", "text", "source", "extra", "size", "source_size", "target", "taken"]
    got = out.toPandas()
    assert len(got) == len(rows) and (got["size"] == [len((t or "").encode().split()) for t in got["text"]]).all()
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] % got["size"].clip(lower=1) == 0).all()
    for _, g in got.groupby("source", dropna=False):
        assert g["source_size"].eq(g["size"].sum()).all() and abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
    again = mix(docs.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, got[key].itertuples(index=False))) == sorted(map(str, again[key].itertuples(index=False)))
    other = mix(docs, seed=8).toPandas()
    assert sorted(map(str, got[key].itertuples(index=False))) != sorted(map(str, other[key].itertuples(index=False)))


def test_fractions_and_empty(spark):
    docs = spark.createDataFrame([(i, "a b", "s", "", 0) for i in range(100)], SCHEMA)
    for share, want in ((0.25, 50), (1.0, 200), (1.5, 300), (5.0, 400)):
        assert mix(docs, share=share).agg(F.sum("taken")).first()[0] == want
    assert mix(docs.limit(0)).count() == 0
    assert mix(docs.withColumn("text", F.lit(None).cast("string"))).agg(F.sum("taken"), F.count("*")).first()[0:2] == (0, 100)
