"""Quality classifier: naive Bayes support vectors (NB-SVM).

Indicators of hashed n-grams (of bytes, and of word shapes) are scaled by the
log-count ratio of the two classes; a linear hinge-loss model is fitted on
them by dual coordinate descent, in parallel on disjoint parts of the training
sample, and the parts' weights are averaged.  The model is one array of
2^``BITS`` weights, whatever the size of the corpus; every document is scored
in the task that reads it, without a shuffle.

The training sample is bounded: of each class, the ``max_per_class`` labelled
rows whose ids have the smallest hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts, steps, text_rows
from assetlife.llm.grams import bucket, byte_grams, distinct, joined
from assetlife.session import materialize

BITS = 18
#: Bytes of text whose features a task holds at a time (some 150 bytes for each).
STEP = 1 << 18
_PARTS = 6

# byte -> shape class: 0 blank, 1 lower case, 2 upper case, 3 digit, 4 non-ASCII, others by themselves
_SHAPE = np.array([0 if b in (9, 10, 11, 12, 13, 32) else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b >= 128 else b for b in range(256)], np.uint8)


def _word_codes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shape code, content code) of every word between white space."""
    shape = _SHAPE[data]
    solid = shape != 0
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    head[np.concatenate(([0], ends[:-1]))[ends > np.concatenate(([0], ends[:-1]))]] |= solid[np.concatenate(([0], ends[:-1]))[ends > np.concatenate(([0], ends[:-1]))]]
    at = np.flatnonzero(head)
    if not len(at):
        return at, at.astype(np.uint64), at.astype(np.uint64)
    text = np.searchsorted(ends, at, side="right")
    # runs of one class inside a word count once
    turn = solid.copy()
    turn[1:] &= (shape[1:] != shape[:-1]) | head[1:]
    power = np.cumsum(turn) - 1
    word = np.cumsum(head) - 1
    place = np.minimum(power - power[at][np.maximum(word, 0)], 7).astype(np.uint64)
    with np.errstate(over="ignore"):
        form = np.add.reduceat(np.where(turn, shape.astype(np.uint64) << (place * np.uint64(8)), np.uint64(0)), at)
        offset = (np.arange(len(data)) - at[np.maximum(word, 0)]).astype(np.uint64)
        content = np.add.reduceat(np.where(solid, (data.astype(np.uint64) + np.uint64(1)) * ((offset * np.uint64(2) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)), np.uint64(0)), at)
    return text, form, content


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) indicators: byte 1-, 3- and 4-grams, and 1- to 3-grams of
    word shapes, where a word that repeats the one before is a shape of its own."""
    data, ends = joined(texts)
    found = [byte_grams(data, ends, n, BITS) for n in (1, 3, 4)]
    if len(data):
        text, form, content = _word_codes(data, ends)
        form = np.where(np.concatenate(([False], (content[1:] == content[:-1]) & (text[1:] == text[:-1])))[:len(form)], np.uint64(255), form)
        code = form
        for n in (1, 2, 3):
            if n > 1:
                code = code[:-1] * np.uint64(0x100000001B3) + form[n - 1:]
            same = text[n - 1:] == text[:len(text) - n + 1]
            found.append((text[:len(text) - n + 1][same], bucket(code[same] ^ np.uint64(n << 60), BITS)))
    return distinct(np.concatenate([t for t, _ in found]), np.concatenate([f for _, f in found]), BITS)


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights of the linear hinge-loss model over indicators ``rows`` whose
    values are ``scale``; y is +1 or -1, ``cost`` bounds each row's dual."""
    w, dual = np.zeros(len(scale)), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norm = np.array([float(v @ v) for v in values])
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order.tolist():
            if norm[i] <= 0:
                continue
            slope = y[i] * float(w[rows[i]] @ values[i]) - 1.0
            new = min(max(dual[i] - slope / norm[i], 0.0), cost[i])
            if new != dual[i]:
                w[rows[i]] += (new - dual[i]) * y[i] * values[i]
                moved = max(moved, abs(new - dual[i]) * norm[i])
                dual[i] = new
        if moved < 1e-3:
            break
    return w


def training_rows(labels: DataFrame, learn: Column, max_per_class: int, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(_id, _label): a bounded sample of labelled ids, the smallest hashes of
    each class; ids with rows of both labels are left out."""
    one = labels.where(learn & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("_id")).agg(F.min(label).alias("_label"), F.max(label).alias("_most")).where("_label = _most").select("_id", "_label")
    part = [one.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(max_per_class) for c in (0, 1)]
    return part[0].unionAll(part[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_per_class: int = 4000, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """The weights (2^BITS), learned from the texts of the sampled rows of
    ``labels``; ``learn`` says which of its rows may be learned from.

    Without rows of both classes all weights are zero (every score is 0.5).
    Of rows that repeat an id one text is learned from (the one with the smallest
    hash); labels without a document, null ids and other columns are not read.
    """
    sample = F.broadcast(training_rows(labels, learn, max_per_class, key))  # 2 * max_per_class rows at most
    picked = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_t")).join(sample, "_id")
    picked = picked.groupBy("_id", "_label").agg(F.min_by("_t", F.xxhash64("_t")).alias("_t"))  # one text for each id

    def make():
        def work(keys, texts):
            t, f = features(texts)
            edge = np.searchsorted(t, np.arange(len(texts) + 1)).astype(np.int32)
            return [pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int32()), pa.ListArray.from_arrays(pa.array(edge), pa.array(f.astype(np.int32)))]

        return work

    rows = materialize(map_texts(picked, ["_id", "_label"], make, "id bigint, label int, f array<int>", "_t", STEP), "nbsvm")
    counts = rows.select("label", F.explode("f").alias("f")).groupBy("f").agg(F.sum("label").alias("n1"), F.count("*").alias("n")).toPandas()
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("n1")).first()
    if not 0 < totals["n1"] < totals["n"]:
        return np.zeros(1 << BITS)
    one, none = np.ones(1 << BITS), np.ones(1 << BITS)
    one[counts["f"]] += counts["n1"]
    none[counts["f"]] += counts["n"] - counts["n1"]
    ratio = np.log(one / one.sum()) - np.log(none / none.sum())
    ratio[(one + none) <= 3] = 0.0  # seen once or never: no evidence
    balance = {1: totals["n"] / (2 * totals["n1"]), 0: totals["n"] / (2 * (totals["n"] - totals["n1"]))}
    shipped = docs.sparkSession.sparkContext.broadcast(ratio)

    def descend(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "label"])
        y = np.where(part["label"].to_numpy() == 1, 1.0, -1.0)
        cost = np.array([balance[int(x)] for x in part["label"]])
        w = dual_coordinate_descent([np.asarray(f) for f in part["f"]], shipped.value, y, cost)
        return pd.DataFrame({"n": [len(part)], "w": [w.astype(np.float32).tobytes()]})

    parts = rows.groupBy(part_of("id").alias("part")).applyInPandas(descend, "n long, w binary").collect()
    weights = sum(np.frombuffer(p["w"], np.float32).astype(np.float64) * p["n"] for p in sorted(parts, key=lambda p: (p["n"], bytes(p["w"])))) / sum(p["n"] for p in parts)
    return weights * ratio


def part_of(key: str) -> Column:
    """The part, 0 to _PARTS - 1, of a sampled row."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(_PARTS))


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of ``docs``, 0 to 1.

    Null and empty texts have no features and score 0.0; a model without
    evidence gives every other text 0.5.  Texts are read whole, however long;
    equal texts score alike; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shipped.value

        def work(keys, texts):
            t, f = features(texts)
            margin = np.bincount(t, w[f], len(texts)) if len(t) else np.zeros(len(texts))
            empty = np.array([not x for x in texts])
            return [pa.array(keys[0], pa.int64()), pa.array(np.where(empty, 0.0, 1 / (1 + np.exp(-np.clip(margin, -500, 500)))))]

        return work

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), [key], make, "doc_id bigint, score double", text, STEP)


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, max_per_class: int = 4000) -> DataFrame:
    """``docs`` without the rows whose text scores under 0.5; columns, whatever
    their names, stay as they are, and equal texts go or stay together."""
    shipped = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, max_per_class))
    return keep_rows(docs, shipped)


def keep_rows(docs: DataFrame, shipped) -> DataFrame:
    """The rows that the model accepts, filtered batch by batch where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shipped.value
        for batch in batches:
            texts = text_rows(batch, "text")
            for a, b in steps(texts, STEP):
                t, f = features(texts[a:b])
                margin = np.bincount(t, w[f], b - a) if len(t) else np.zeros(b - a)
                keep = (margin >= 0) & np.array([len(x) > 0 for x in texts[a:b]])
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
