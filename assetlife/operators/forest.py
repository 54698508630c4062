"""Regression forests by histogram split search.

Every feature is cut at exact quantiles of the training rows, so a row is a few
small bin numbers.  A level of all trees is one pass: tasks route their rows
through the splits made so far and count weight and label sum of every (tree,
node, feature, bin); a shuffle adds them up, running sums over the bins give the
gain of every split, and one row per node, its best split, reaches the driver.
Rows never leave their tasks, and the work of a pass is bounded by ``CELLS``.

A tree's rows are drawn with Poisson(1) weights from a digest of the row's key, so
a forest is the same whatever the partitioning, and SQL can recompute it: with
whole-number labels all sums are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlife.config import CYCLE, ENGINE
from assetlife.operators.stats import order_statistics
from assetlife.session import materialize, materialize_observed, ship

#: (tree, node, feature, bin) cells that a task counts in one pass.
CELLS = 1 << 21
#: Trees whose weights come from one digest (8 hex digits each).
PER_DIGEST = 4


def poisson_steps(most: int = 10) -> list[int]:
    """Upper bounds, in 2^-32, of a Poisson(1) count of 0, 1, 2...: a 32-bit
    number above k of them stands for the count k."""
    total, steps = 0.0, []
    for k in range(most):
        total += math.exp(-1) / math.factorial(k)
        steps.append(int(total * 2**32))
    return steps


def tree_weight(tree: int, seed: int, key: list[str]) -> Column:
    """How often a row counts in a tree: Poisson(1), from md5 of seed, block of
    trees and the row's key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(tree // PER_DIGEST)), *[F.col(k).cast("string") for k in key]))
    draw = F.conv(F.substring(digest, 1 + 8 * (tree % PER_DIGEST), 8), 16, 10).cast("bigint")
    return reduce(lambda a, b: a + b, [(draw >= F.lit(s)).cast("int") for s in poisson_steps()])


def tree_weights(keys: list[str], trees: int, seed: int) -> np.ndarray:
    """``tree_weight`` of all trees (columns) for rows whose key columns, as text
    and each behind a colon, are ``keys``: one digest a row and block of trees."""
    draws = []
    for block in range(-(-trees // PER_DIGEST)):
        start = hashlib.md5(f"{seed}:{block}".encode())
        digests = []
        for key in keys:
            digest = start.copy()
            digest.update(key.encode())
            digests.append(digest.digest())
        draws.append(np.frombuffer(b"".join(digests), ">u4").reshape(len(keys), PER_DIGEST))
    drawn = np.hstack(draws)[:, :trees].astype(np.int64)
    return np.searchsorted(np.array(poisson_steps()), drawn, side="right").astype(np.uint8)


@dataclass
class Forest:
    """Trees as arrays over heap-numbered nodes (root 1, children 2n, 2n + 1)."""

    features: list[str]
    edges: list[list[float]]  # of each feature: the values at which it may be split, ascending
    depth: int
    split_feature: np.ndarray  # (trees, nodes): -1 at leaves
    split_bin: np.ndarray  # rows of at most this bin go left
    value: np.ndarray  # mean label of the node's rows
    weight: np.ndarray  # their number, repeats counted
    splits: dict[tuple[int, int], tuple[str, float, float]] = field(default_factory=dict)  # (tree, node): feature, threshold, gain

    @property
    def trees(self) -> int:
        return len(self.value)

    def nodes(self, tree: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row (bins: rows x features) in a tree, at most
        ``depth`` levels down."""
        node, every = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = self.split_feature[tree, node]
            right = bins[every, np.maximum(f, 0)] > self.split_bin[tree, node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node

    def predictions(self, bins: np.ndarray) -> np.ndarray:
        """Mean of the trees' leaf values, added tree by tree."""
        total = np.zeros(len(bins))
        for t in range(self.trees):
            total = total + self.value[t, self.nodes(t, bins, self.depth)]
        return total / self.trees

    def table(self, spark) -> DataFrame:
        """(tree, node, n, mean, feature, threshold, gain) of every node; the last
        three are null at leaves."""
        rows = [(int(t), int(node), int(self.weight[t, node]), float(self.value[t, node]), *self.splits.get((t, node), (None,) * 3)) for t, node in np.argwhere(self.weight > 0)]
        return spark.createDataFrame(rows, "tree int, node int, n bigint, mean double, feature string, threshold double, gain double")


def quantile_edges(rows: DataFrame, features: list[str], bins: int, counts: dict[str, int] | None = None) -> list[list[float]]:
    """The distinct values at the ranks i n / bins of each feature (``rows`` is a
    written table, ``counts`` the number of values of each feature if known)."""
    ranks = lambda n: {i * n // bins for i in range(1, bins)} if n else ()
    counts, values = order_statistics(rows, features, ranks, counts)
    return [sorted({float(values[f, k]) for k in ranks(counts[f])}) for f in features]


def _bin_type(edges: list[list[float]]) -> type:
    """Bin numbers are bytes where every feature has few enough edges."""
    return np.uint8 if all(len(cuts) < 256 for cuts in edges) else np.int16


def _packed(matrix: np.ndarray) -> pa.Array:
    """A row's numbers as one binary value: lists would be copied number by number
    between Spark's rows, Parquet and Arrow."""
    matrix = np.ascontiguousarray(matrix)
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1] * matrix.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(matrix)])


def _unpacked(column: pa.Array, width: int, kind: type) -> np.ndarray:
    column = column.cast(pa.binary())
    size = width * np.dtype(kind).itemsize
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[column.offset * size:(column.offset + len(column)) * size]
    return data.view(kind).reshape(len(column), width)


def _matrix(batch: pa.RecordBatch, first: int, edges: list[list[float]]) -> np.ndarray:
    """Bin numbers of the feature columns from ``first`` on: how many edges lie
    below the value."""
    out = np.zeros((batch.num_rows, len(edges)), _bin_type(edges))
    for i, cuts in enumerate(edges):
        x = batch.column(first + i).to_numpy(zero_copy_only=False)
        out[:, i] = np.searchsorted(np.array(cuts), x, side="left")
    return out


def _cells(coded: DataFrame, forest: Forest, trees: list[int], level: int, bins: int) -> DataFrame:
    """(tree, node, feature, bin, n, s): weight and label sum of the rows of the
    level's nodes."""
    shared = coded.sparkSession.sparkContext.broadcast(forest)  # bounded by trees and depth
    width, base = len(forest.features), 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, size = shared.value, base * width * bins
        n, s = np.zeros((len(trees), size)), np.zeros((len(trees), size))
        offset = np.arange(width) * bins
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            weights = _unpacked(batch.column(1), f.trees, np.uint8)
            coded_bins = _unpacked(batch.column(2), width, _bin_type(f.edges))
            for i, t in enumerate(trees):
                nodes = f.nodes(t, coded_bins, level)
                here = (nodes >= base) & (weights[:, t] > 0)
                w = weights[here, t].astype(np.float64)
                at = (((nodes[here] - base) * width * bins)[:, None] + offset + coded_bins[here]).ravel()
                n[i] += np.bincount(at, np.repeat(w, width), size)
                s[i] += np.bincount(at, np.repeat(w * label[here], width), size)
        n, s = n.ravel(), s.ravel()
        some = np.flatnonzero(n)
        cell, at_bin = np.divmod(some, bins)
        cell, feature = np.divmod(cell, width)
        tree, node = np.divmod(cell, base)
        cols = [np.array(trees, np.int32)[tree], (node + base).astype(np.int32), feature.astype(np.int32), at_bin.astype(np.int32), n[some].astype(np.int64), s[some]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tree", "node", "feature", "bin", "n", "s"])

    each = coded.mapInArrow(run, "tree int, node int, feature int, bin int, n bigint, s double")
    return each.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def best_splits(cells: DataFrame, least_rows: int) -> DataFrame:
    """(tree, node, n, s, gain, feature, bin, left_n, left_s): of each node its
    weight and label sum, and the split that lowers the squared error most (null
    if none does); of equal ones the first feature's first bin."""
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    n, s, left_n, left_s = (F.col(c) for c in ("n", "s", "left_n", "left_s"))
    sums = cells.select("tree", "node", "feature", "bin", F.sum("n").over(upto).alias("left_n"), F.sum("s").over(upto).alias("left_s"),
                        F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"))
    lower = F.try_divide(left_s * left_s, left_n) + F.try_divide((s - left_s) * (s - left_s), n - left_n) - F.try_divide(s * s, n)
    gain = F.when((left_n >= least_rows) & (n - left_n >= least_rows) & (lower > 0), lower)
    rated = sums.withColumn("gain", gain)
    order = F.struct(F.coalesce("gain", F.lit(0.0)), -F.col("feature"), -F.col("bin"))
    best = rated.groupBy("tree", "node").agg(F.max_by(F.struct("n", "s", "gain", "feature", "bin", "left_n", "left_s"), order).alias("b"))
    return best.select("tree", "node", "b.*")


def fit_forest(train: DataFrame, features: list[str], label: str = "rul", trees: int = 20, depth: int = 6, bins: int = 32,
               least_rows: int = 1, seed: int = 42, key: list[str] | None = None, written: bool = False) -> Forest:
    """A forest of ``trees`` trees of at most ``depth`` levels, every split chosen
    among all features.

    ``key`` identifies a row (its weights are drawn from it).  Rows with a
    missing label or feature are left out; an empty table gives trees of one
    leaf whose value is 0.  The driver holds the trees, at most
    ``trees`` x 2^(``depth`` + 1) nodes.  ``train`` is read six times: its columns
    are written first unless it is ``written`` already (or as cheap to read again).
    """
    ship(train.sparkSession)
    key = list(key or [ENGINE, CYCLE])
    used = list(dict.fromkeys([*features, label]))
    rows = train.dropna(subset=used).select(F.col(label).cast("double").alias("_label"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)],
                                            *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    total = F.count(F.lit(1)).alias("n")
    if written:
        n = rows.agg(total).first()["n"]
    else:
        rows, seen = materialize_observed(rows, [total], "forest-rows")
        n = seen["n"]
    inputs = [f"_f{i}" for i in range(len(features))]
    edges = quantile_edges(rows, inputs, bins, dict.fromkeys(inputs, n))  # no row lacks a value
    missing = F.lit("")  # missing parts of a key leave no colon
    named = F.concat(missing, *[F.coalesce(F.concat(F.lit(":"), F.col(f"_key{i}").cast("string")), missing) for i in range(len(key))])
    nodes = 1 << (depth + 1)
    forest = Forest(list(features), edges, depth, np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes), np.int32), np.zeros((trees, nodes)), np.zeros((trees, nodes), np.int64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = tree_weights(batch.column(1).to_pylist(), trees, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(drawn), _packed(_matrix(batch, 2, edges))], names=["label", "weights", "bins"])

    coded = materialize(rows.select("_label", named.alias("_named"), *inputs).mapInArrow(code, "label double, weights binary, bins binary"), "forest-bins")
    sums: dict[tuple[int, int], tuple[int, float]] = {}  # of nodes whose parent was split
    for level in range(max(depth, 1)):
        open_trees = sorted({t for t, node in sums if node >> level}) if level else list(range(trees))
        chunk = max(1, CELLS // ((1 << level) * len(features) * bins))
        for a in range(0, len(open_trees), chunk):
            for r in best_splits(_cells(coded, forest, open_trees[a:a + chunk], level, bins), least_rows).collect():  # one row a node
                t, node, f = r["tree"], r["node"], r["feature"]
                sums[t, node] = (r["n"], r["s"])
                if r["gain"] is not None and level < depth:
                    forest.split_feature[t, node], forest.split_bin[t, node] = f, r["bin"]
                    forest.splits[t, node] = (features[f], edges[f][r["bin"]], r["gain"])
                    sums[t, 2 * node] = (r["left_n"], r["left_s"])
                    sums[t, 2 * node + 1] = (r["n"] - r["left_n"], r["s"] - r["left_s"])
    for (t, node), (n, s) in sums.items():
        forest.value[t, node] = s / n
        forest.weight[t, node] = n
    return forest


def predict_forest(forest: Forest, df: DataFrame, name: str = "prediction", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the forest's prediction; null where a feature is missing.  Of the
    columns only those in ``keep`` (default: all) are carried through the tasks."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(forest)  # bounded by trees and depth
    kept = [c for c in (df.columns if keep is None else keep) if c != name]
    inputs = [F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(forest.features)]
    schema = df.select(*kept, F.lit(0.0).alias(name)).schema
    schema[name].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            n = len(kept)
            out = f.predictions(_matrix(batch, n, f.edges))
            # told from the values: one condition over all features, beside their
            # copies, has 2^features forms that Spark's optimizer would all write out
            known = np.ones(batch.num_rows, bool)
            for i in range(len(f.features)):
                known &= batch.column(n + i).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n)], pa.array(out, mask=~known)], names=[*kept, name])

    return df.select(*kept, *inputs).mapInArrow(run, schema)
