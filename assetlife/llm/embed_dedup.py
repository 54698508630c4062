"""Embedding near-dedup by sorted projection passes.

Every pass gives each vector the concatenation of random hyperplane bits as its
key and orders the vectors of a label by it; vectors near each other on the
sphere share long prefixes and end up close.  Each vector is compared with the
rest of its block and the next block of ``BLOCK`` places (every pair at most
``BLOCK`` places apart, so the window is bounded), verified by its cosine in
double precision, and the verified pairs of all passes are united.  The number
of passes follows the size of the largest label.

Vectors that are equal are collapsed first.  The windows only have to find the
groups: a pass gives the edges of each block's spanning forest, at most one per
vector, and their components are the groups.  Links are then counted exactly,
from all pairs of each group, whatever its size: groups larger than a chunk are
cut into chunks and every two chunks are compared in a task of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlife.llm.components import components
from assetlife.session import materialize

#: Passes at least; large labels get more (see _passes).
PASSES = 12
#: Share of the pairs just at the threshold that the passes are to bring together.
RECALL = 0.99
KEY_BITS = 48
BLOCK = 512
#: Blocks that are compared in one go (their first block also closes the group before).
GROUP = 8


def _usable(vector: str) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0), F.lit(False))


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors as rows; shorter ones are filled up with zeros."""
    sizes = np.asarray(pc.list_value_length(column))
    x = np.zeros((len(sizes), int(sizes.max(initial=1))))
    x[np.arange(x.shape[1]) < sizes[:, None]] = np.asarray(column.flatten(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projection_keys(vectors: DataFrame, passes: int, seed: int) -> DataFrame:
    """(id, part, keys array<long>): the sort key of each pass.  The planes
    follow from the seed, the pass and the number of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch.column(2)))
            for d in np.unique(sizes).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, passes * KEY_BITS))
                rows = batch.filter(pa.array(sizes == d))
                for a in range(0, rows.num_rows, 4096):
                    part = rows.slice(a, 4096)
                    bits = (_unit(part.column(2)) @ planes[d] > 0).reshape(part.num_rows, passes, KEY_BITS)
                    keys = bits @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(keys), pa.list_(pa.int64()))], names=["id", "part", "keys"])

    return vectors.select("id", "part", "v").mapInArrow(run, "id bigint, part bigint, keys array<bigint>")


def _places(keys: DataFrame, passes: int) -> DataFrame:
    """(id, blocks array<long>): the number of each vector's block in each pass."""
    each = keys.select("id", "part", F.posexplode("keys").alias("pass", "key"))
    tie = F.xxhash64("pass", "id")  # equal keys lie in another order in each pass
    ordered = each.orderBy("pass", "part", "key", tie, "id").select("pass", "id", F.monotonically_increasing_id().alias("at"))
    ordered = materialize(ordered, "embed-order")
    task = F.shiftright("at", 33)
    sizes = ordered.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()  # one row per task
    offset, total = {}, 0
    for r in sizes:
        offset[r["task"]] = total
        total += r["n"]
    if not offset:
        return keys.select("id", F.array().cast("array<bigint>").alias("blocks")).limit(0)
    offsets = ordered.sparkSession.createDataFrame([(int(k), int(v)) for k, v in offset.items()], "task long, before long")
    placed = ordered.withColumn("task", task).join(F.broadcast(offsets), "task")
    block = F.floor((F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))) / BLOCK)
    return placed.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", block.cast("long").alias("b")))), lambda s: s["b"]).alias("blocks"))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For linked pairs of rows: each row's root in a spanning forest."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


_OUT = "id bigint, root bigint"
_DEGREE = "id bigint, n bigint"


def _compare(rows: pa.Table, pairs: list[tuple[int, int]], threshold: float) -> pa.Table:
    """The edges of a spanning forest of the verified links among blocks of
    ``rows``; ``pairs`` has the block numbers to compare."""
    unit, part, ids, own = _unit(rows["v"].combine_chunks()), np.asarray(rows["part"]), np.asarray(rows["id"]), np.asarray(rows["block"])
    of = {int(b): np.flatnonzero(own == b) for b in np.unique(own)}
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in pairs:
        if x not in of or y not in of:
            continue
        i, j = of[x], of[y]
        hit = (unit[i] @ unit[j].T >= threshold) & (part[i][:, None] == part[j][None, :])
        if x == y:
            hit = np.triu(hit, 1)
        p, q = np.nonzero(hit)
        left.append(i[p])
        right.append(j[q])
    root = _forest(np.concatenate(left), np.concatenate(right), len(ids))
    some = np.flatnonzero(root != np.arange(len(ids)))
    return pa.table([pa.array(ids[some]), pa.array(ids[root[some]])], names=["id", "root"])


def _window_pass(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, root): links that join the groups of every pass's windows."""
    spots = F.posexplode("blocks").alias("pass", "block")
    each = rows.select("id", "part", "v", spots)
    group = F.floor(F.col("block") / GROUP).cast("long")
    # the first block of a group also closes the group before it
    seats = F.when(F.col("block") % GROUP == 0, F.array(group, group - 1)).otherwise(F.array(group))
    dealt = each.withColumn("group", F.explode(seats))

    def run(key, table):
        first = key[1].as_py() * GROUP
        return _compare(table, [(b, c) for b in range(first, first + GROUP) for c in (b, b + 1)], threshold)

    return dealt.groupBy("pass", "group").applyInArrow(run, _OUT)


def _degrees(rows: pa.Table, low: int, high: int, threshold: float) -> pa.Table:
    """(id, n): each vector's links, by weight, with the vectors of its group
    between chunks ``low`` and ``high`` (inside the chunk if they are one)."""
    part, component = np.asarray(rows["part"]), np.asarray(rows["component"])
    order = np.lexsort((part, component))
    new = (np.diff(component[order]) != 0) | (np.diff(part[order]) != 0)
    code = np.concatenate(([0], np.cumsum(new)))
    rows = rows.take(pa.array(order))
    unit, weight, chunk = _unit(rows["v"].combine_chunks()), np.asarray(rows["n"]).astype(np.float64), np.asarray(rows["chunk"])
    links = np.zeros(len(order))
    left = np.flatnonzero(chunk == low)
    right = left if low == high else np.flatnonzero(chunk == high)
    for a in range(0, len(left), BLOCK):
        i = left[a:a + BLOCK]
        for b in range(a if low == high else 0, len(right), BLOCK):
            j = right[b:b + BLOCK]
            if code[j[0]] > code[i[-1]]:
                break  # sorted by group: none beyond shares one
            if code[j[-1]] < code[i[0]]:
                continue
            hit = unit[i] @ unit[j].T >= threshold
            if code[i[0]] != code[i[-1]] or code[j[0]] != code[j[-1]]:
                hit &= code[i][:, None] == code[j][None, :]
            if low == high and a == b:
                np.fill_diagonal(hit, False)
                links[i] += hit @ weight[j]
            else:
                links[i] += hit @ weight[j]
                links[j] += weight[i] @ hit
    some = np.flatnonzero(links)
    return pa.table([rows["id"].combine_chunks().take(pa.array(some)), pa.array(links[some].astype(np.int64))], names=["id", "n"])


def _all_links(members: DataFrame, threshold: float) -> DataFrame:
    """(id, n): the links of each of ``members`` (id, part, component, n, v),
    from every pair of a component.

    Components of up to ``GROUP`` blocks share chunks; larger ones are cut into
    chunks, and every two chunks of one meet in a task of their own."""
    size = GROUP * BLOCK
    groups = members.groupBy("component", "part").agg(F.count("*").alias("members"))
    groups = materialize(groups.where("members > 1"), "embed-groups")
    few = groups.where(F.col("members") <= size).agg(F.sum("members")).first()[0] or 0
    shared = F.pmod(F.xxhash64("component", "part"), F.lit(max(1, 2 * few // size)))
    cuts = F.ceil(F.col("members") / size)
    met = members.join(groups, ["component", "part"]).withColumn("whole", F.col("members") <= size)
    own = F.pmod(F.xxhash64("id", F.lit(5)), cuts)
    met = met.withColumn("chunk", F.when(F.col("whole"), shared).otherwise(own))
    # the chunk itself and every other chunk of the group
    other = F.explode(F.when(F.col("whole"), F.array("chunk")).otherwise(F.sequence(F.lit(0), cuts - 1)))
    dealt = met.withColumn("other", other).select(
        "id", "part", "component", "n", "v", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        F.when(F.col("whole"), 0).otherwise(F.col("component")).alias("of"), F.when(F.col("whole"), 0).otherwise(F.col("part")).alias("at"), "whole")

    def run(key, table):
        return _degrees(table, key[3].as_py(), key[4].as_py(), threshold)

    return dealt.groupBy("whole", "of", "at", "low", "high").applyInArrow(run, _DEGREE).groupBy("id").agg(F.sum("n").alias("n"))


def _passes(largest: int, threshold: float) -> int:
    """Passes after which a pair just at the threshold shared a window with
    ``RECALL``, in a label of ``largest`` vectors spread over the sphere: keys
    must agree in log2(largest / BLOCK) bits, each of which parts the pair
    with probability angle / pi."""
    bits = max(0.0, math.log2(max(1, largest) / BLOCK))
    meet = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return 1 if meet >= 1 else math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def near_vectors(table: DataFrame, threshold: float = 0.93, passes: int = PASSES, seed: int = 11, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id), one row per row of ``table``.

    Vectors link if their labels are equal and not null and their cosine is
    ``threshold`` or more.  Vectors that are null, zero or hold null or
    non-finite components, rows without a label and rows without an id link
    with nothing; vectors of different lengths never link.  Equal vectors of a
    label link with each other; rows repeating an id count as vectors of their
    own.  component_id is the smallest id reachable, the own one without
    links; an empty table gives an empty result.  ``passes`` are made at least,
    more where the largest label asks for them.
    """
    plain = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).alias("label"), (_usable(vector) & F.col(label).isNotNull() & F.col(key).isNotNull()).alias("ok"))
    plain = plain.withColumn("part", F.xxhash64(F.col("label").cast("string"), F.size("v")))
    plain = plain.withColumn("same", F.when(F.col("ok"), F.sha2(F.concat_ws(",", F.col("part"), F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))), 256)))
    good = materialize(plain.where("ok").select("vec_id", "same", "part", "v"), "embed")
    heads = good.groupBy("same").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    firsts = good.groupBy("same", "part").agg(F.min("vec_id").alias("id"), F.first("v").alias("v"))
    vectors = firsts.join(heads.select("same", "n"), "same").select("id", "part", "n", "v", "same")
    # an id may head several vectors: the vectors get numbers of their own
    vectors = vectors.withColumn("vec", F.col("id")).withColumn("id", F.xxhash64("same", "id"))
    vectors = materialize(vectors, "embed-vectors")
    largest = vectors.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    passes = max(passes, _passes(largest, threshold))
    placed = vectors.join(_places(projection_keys(vectors, passes, seed), passes), "id")
    rows = materialize(placed.select("id", "part", "v", "blocks"), "embed-places")
    links = materialize(_window_pass(rows, threshold), "embed-links")
    named = vectors.select(F.col("id").alias("_id"), F.col("vec").alias("_vec"))
    edges = links.distinct().join(named, F.col("id") == F.col("_id")).select("root", F.col("_vec").alias("u")).join(named, F.col("root") == F.col("_id")).select("u", F.col("_vec").alias("v"))
    found_in = components(edges)
    # heads of components are not in found_in; vectors that found nobody drop out with groups of one
    members = vectors.join(found_in, F.col("vec") == F.col("node"), "left").select("id", "part", F.coalesce("component", "vec").alias("component"), "n", "v")
    degree = _all_links(members, threshold).select("id", F.col("n").alias("far"))
    result = vectors.join(degree, "id", "left").join(found_in, F.col("vec") == F.col("node"), "left")
    result = result.select(F.col("same").alias("_same"), (F.coalesce("far", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "vec").alias("component_id"))
    out = plain.select("vec_id", "same").join(result, F.col("same") == F.col("_same"), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
