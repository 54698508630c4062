"""Histogram forests: splits by brute force, weights, predictions, MLlib's margin."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlife.operators import forest as hist
from assetlife.operators import model as ml
from assetlife.plans.registry import li_features
from assetlife.session import materialize
from tests.conftest import SF


def drawn(key: str, tree: int, seed: int) -> int:
    """A Poisson(1) count by its distribution, from 8 hex digits of a digest."""
    u = int(hashlib.md5(f"{seed}:{tree // 4}:{key}".encode()).hexdigest()[8 * (tree % 4):8 * (tree % 4) + 8], 16)
    k, total = 0, math.exp(-1)
    while u >= int(total * 2**32) and k < 10:
        k += 1
        total += math.exp(-1) / math.factorial(k)
    return k


def grown(x, y, w, edges, depth, least):
    """{node: (n, mean, feature, threshold)} of one tree, by trying every edge."""
    out, todo = {}, [(1, np.ones(len(y), bool))]
    while todo:
        node, here = todo.pop()
        n, s = w[here].sum(), (w * y)[here].sum()
        if not n:
            continue
        best = None
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left = here & (x[:, f] <= cut)
                ln, ls = w[left].sum(), (w * y)[left].sum()
                if ln >= least and n - ln >= least:
                    gain = ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut)
        split = best is not None and node < 1 << depth
        out[node] = (n, s / n, best[1] if split else None, best[2] if split else None)
        if split:
            todo += [(2 * node, here & (x[:, best[1]] <= best[2])), (2 * node + 1, here & (x[:, best[1]] > best[2]))]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.column_stack([rng.normal(size=600), rng.integers(0, 5, 600), rng.normal(size=600), np.full(600, 2.5)]), 3)
    y = np.round(40 * (x[:, 0] > 0.2) + 10 * x[:, 1] + rng.normal(size=600) * 3).astype(int)
    rows = [(i % 20, i // 20, int(v), *map(float, r)) for i, (v, r) in enumerate(zip(y, x))]
    return x, y, materialize(spark.createDataFrame(rows, "engine_id long, cycle long, rul long, a double, b double, c double, flat double"), "forest-test")


@pytest.mark.parametrize("trees, depth, bins, least, cells", [(5, 3, 8, 1, 1 << 21), (2, 4, 64, 25, 1), (1, 0, 4, 1, 1 << 21)])
def test_trees_are_those_of_brute_force(spark, data, monkeypatch, trees, depth, bins, least, cells):
    monkeypatch.setattr(hist, "CELLS", cells)  # one tree a pass
    x, y, df = data
    fitted = hist.fit_forest(df.repartition(7), ["a", "b", "c", "flat"], trees=trees, depth=depth, bins=bins, least_rows=least, seed=9)
    ranks = sorted({i * 600 // bins for i in range(1, bins)})
    assert fitted.edges == [sorted(set(np.sort(x[:, f])[ranks].tolist())) for f in range(4)]
    got: dict = {}
    for r in fitted.table(spark).collect():
        got.setdefault(r["tree"], {})[r["node"]] = (r["n"], r["mean"], r["feature"], r["threshold"])
    total = np.zeros(600)
    for t in range(trees):
        w = np.array([drawn(f"{i % 20}:{i // 20}", t, 9) for i in range(600)])
        want = grown(x, y, w, fitted.edges, depth, least)
        assert got[t] == {k: (n, m, None if f is None else "a b c flat".split()[f], cut) for k, (n, m, f, cut) in want.items()}
        for i in range(600):
            node = 1
            while want[node][2] is not None:
                node = 2 * node + (x[i, want[node][2]] > want[node][3])
            total[i] += want[node][1]
    scored = hist.predict_forest(fitted, df).orderBy("cycle", "engine_id").collect()
    assert [r["prediction"] for r in scored] == pytest.approx((total / trees).tolist(), abs=1e-9)


def test_same_trees_whatever_the_partitions(spark, data):
    tables = [hist.fit_forest(data[2].repartition(n), ["a", "b"], trees=2, depth=3).table(spark).collect() for n in (1, 9)]
    assert tables[0] == tables[1]


def test_weights_are_poisson(spark):
    rows = spark.range(20_000).select(F.col("id").alias("engine_id"), F.lit(1).alias("cycle"))
    w = rows.select(hist.tree_weight(6, 1, ["engine_id", "cycle"]).alias("w")).groupBy("w").count().collect()
    share = {r["w"]: r["count"] / 20_000 for r in w}
    assert all(abs(share[k] - math.exp(-1) / math.factorial(k)) < 0.012 for k in range(4))


def test_missing_values_and_empty_tables(spark, data):
    _, _, df = data
    odd = df.withColumn("a", F.when(F.col("cycle") == 3, None).otherwise(F.col("a"))).withColumn("prediction", F.lit("x"))
    fitted = hist.fit_forest(odd, ["a", "b"], trees=2, depth=2)
    scored = hist.predict_forest(fitted, odd)
    assert scored.columns == [*[c for c in odd.columns if c != "prediction"], "prediction"]
    assert scored.where("(prediction is null) <> (a is null)").count() == 0
    none = hist.fit_forest(df.limit(0), ["a"], trees=1, depth=2)
    assert none.table(spark).count() == 0 and hist.predict_forest(none, df.limit(3)).agg(F.sum("prediction")).first()[0] == 0.0


def test_no_worse_than_mllib(spark):
    """On the held-out engines the error is within 5 % of MLlib's forest of the same size."""
    rows = materialize(ml.complete_cases(li_features(spark, SF)), "forest-li")
    train, test = ml.grouped_holdout(rows)
    features = ml.model_feature_columns(rows)
    mine = ml.regression_metrics(hist.predict_forest(hist.fit_forest(train, features, trees=20, depth=5), test)).first()
    other = ml.regression_metrics(ml.predict(ml.fit_random_forest(train, features, num_trees=20, max_depth=5), test)).first()
    assert mine["n_test"] == other["n_test"] > 0
    assert mine["rmse"] <= 1.05 * other["rmse"] and mine["mae"] <= 1.05 * other["mae"] and mine["r2"] >= other["r2"] - 0.05


def test_prediction_conditions_do_not_multiply(spark):
    """Known rows are told from the values: what Spark derives of the plan stays as small as the features are many."""
    names = [f"f{i}" for i in range(14)]
    train = spark.createDataFrame([(e, c, 10 - c, *[float(e * c + i) for i in range(14)]) for e in range(3) for c in range(10)],
                                  "engine_id long, cycle long, rul long, " + ", ".join(f"{n} double" for n in names))
    forest = hist.fit_forest(train, names, trees=2, depth=2, bins=4)
    holed = train.withColumn("f3", F.when(F.col("cycle") != 4, F.col("f3"))).withColumn("f13", F.when(F.col("cycle") != 6, F.col("f13")))
    out = hist.predict_forest(forest, holed)
    assert out._jdf.queryExecution().optimizedPlan().children().apply(0).constraints().size() < 200
    assert {r["cycle"] for r in out.where("prediction is null").collect()} == {4, 6}
    assert out.where("prediction is not null").count() == 24


def test_large_forest_keeps_nodes_between_levels(spark):
    """Rows keep their node in every tree, and the trees are those of a fit that walks them from their roots."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rows = spark.range(400).selectExpr("cast(id * 7 % 13 as double) as a", "cast(id % 5 as double) as b", "id % 17 as rul").coalesce(1)
    kept = ml.fit_random_forest(rows, ["a", "b"], num_trees=3, max_depth=4).stages[-1]
    assert kept.getCacheNodeIds()
    table = VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(materialize(rows, "walked"))
    walked = RandomForestRegressor(featuresCol="_features", labelCol="rul", numTrees=3, maxDepth=4, seed=42).fit(table)
    assert kept.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1]


def test_weights_of_all_trees_are_those_of_each(spark):
    keys = [(3, 1), (None, 2), (4, None), (None, None), (-7, 10**12)]
    rows = spark.createDataFrame(keys, "engine_id long, cycle long").coalesce(1)
    each = [tuple(r) for r in rows.select(*[hist.tree_weight(t, 9, ["engine_id", "cycle"]) for t in range(6)]).collect()]
    texts = ["".join(f":{k}" for k in key if k is not None) for key in keys]
    assert [tuple(r) for r in hist.tree_weights(texts, 6, 9).tolist()] == each
    assert hist.tree_weights([], 3, 9).shape == (0, 3)


def test_a_written_table_is_not_copied(spark, data, monkeypatch):
    """The passes read the caller's table; the only table written has a row's label, weights and bins as three values."""
    made = []
    monkeypatch.setattr(hist, "materialize", lambda df, name: made.append((name, df.dtypes)) or materialize(df, name))
    monkeypatch.setattr(hist, "materialize_observed", None)
    fitted = hist.fit_forest(data[2], ["a", "b"], trees=2, depth=2, seed=9, written=True)
    assert made == [("forest-bins", [("label", "double"), ("weights", "binary"), ("bins", "binary")])]
    monkeypatch.undo()
    assert fitted.table(spark).collect() == hist.fit_forest(data[2], ["a", "b"], trees=2, depth=2, seed=9).table(spark).collect()


def test_many_bins_are_wider_than_a_byte(spark):
    rows = spark.range(700).selectExpr("id as engine_id", "id as cycle", "id as rul", "cast(id as double) as a")
    fitted = hist.fit_forest(rows, ["a"], trees=1, depth=1, bins=600)
    assert len(fitted.edges[0]) > 255 and 250 < fitted.splits[0, 1][1] < 450


def test_only_the_kept_columns_come_back(spark, data):
    fitted = hist.fit_forest(data[2], ["a", "b"], trees=2, depth=2)
    whole = hist.predict_forest(fitted, data[2])
    some = hist.predict_forest(fitted, data[2], keep=["rul"])
    assert some.columns == ["rul", "prediction"]
    assert sorted(some.collect()) == sorted(whole.select("rul", "prediction").collect())
