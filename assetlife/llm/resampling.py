"""Importance resampling towards a target distribution.

Words fall into hashed buckets; the counts of the buckets in the target and in
all documents make an array of integer gains, one lookup for each feature of a
document.  Weight plus seeded Gumbel noise is the score; the highest scores are
a draw without replacement.

The draw's cutoff is found by numeric threshold bisection over the written score
table: exact count jobs narrow the score, then the doc_id among tied scores,
then the row number among rows equal in both, each job counting above several
thresholds at once.  Only the drawn rows are range-partitioned for their ranks;
all others keep their place, so nothing joins the whole table.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts
from assetlife.session import materialize

#: Bytes of one text that are split at a time, words that a task remembers, and
#: thresholds that one count job counts above.
SPAN, MEMORY, THRESHOLDS = 1 << 20, 1 << 18, 15
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Bytes of characters beyond ASCII are all 0x80 or more, so this holds for UTF-8.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LAST = (1 << 63) - 1


def _spans(text: bytes) -> Iterator[bytes]:
    """``text`` in spans of about SPAN bytes, cut between words."""
    at = 0
    while len(text) - at > SPAN:
        cut = _GAP.search(text, at + SPAN)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Bucketer(dict):
    """The bucket of a feature (bytes), remembered."""

    def __init__(self, buckets: int, runs: int):
        self.buckets, self.runs = buckets, runs

    def __missing__(self, feature: bytes) -> int:
        self[feature] = b = zlib.crc32(feature) % self.buckets
        return b

    def spans(self, text: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """Number of words and buckets of all features, span by span; the runs
        across two spans come with the second."""
        before: list[bytes] = []
        for span in _spans(text):
            words = _WORDS.findall(span.translate(_UPPER))
            found = list(map(self.__getitem__, words))
            joined = before + words
            for n in range(2, self.runs + 1):
                first = max(0, len(before) - n + 1)
                found += [self[b" ".join(joined[i:i + n])] for i in range(first, len(joined) - n + 1)]
            before = joined[max(0, len(joined) - self.runs + 1):]
            if len(self) > MEMORY:
                self.clear()
            yield len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, buckets: int = 10_000, runs: int = 1, text: str = "text") -> np.ndarray:
    """How often the features of all texts fall into each bucket; every task
    sends its sums only (``buckets`` numbers)."""
    n_buckets, n_runs = buckets, runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = Bucketer(n_buckets, n_runs), np.zeros(n_buckets, np.int64)
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()):
                for _, found in at.spans(t.as_py() or b""):
                    sums += np.bincount(found, minlength=n_buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "n"])

    each = texts.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) of each bucket."""
    b, s_all, t_all = len(docs), int(docs.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b)))) for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def noise(seed: int, key: object) -> int:
    """Gumbel noise in thousandths, from 32 bits of a digest of seed and key."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, runs: int = 1, seed: int = 2024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``.

    Null and empty texts have no features and weight 0; a null key's noise is
    that of an empty one; texts of any length are read span by span; equal rows
    get equal scores; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def make() -> Callable:
        gain = shared.value
        at = Bucketer(len(gain), runs)

        def work(keys: list[list], texts: list[bytes]) -> list:
            words, features, weight = [], [], []
            for t in texts:
                w = f = s = 0
                for n, found in at.spans(t):
                    w, f, s = w + n, f + len(found), s + int(gain[found].sum())
                words.append(w)
                features.append(f)
                weight.append(s)
            total = [w + noise(seed, k) for w, k in zip(weight, keys[0])]
            return [pa.array(c, pa.int64()) for c in (keys[0], words, features, weight, total)]

        return work

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), [key], make, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint", text)


def threshold(rows: DataFrame, value: Column, k: int, low: int, high: int) -> tuple[int, int]:
    """The largest v with at least ``k`` rows of ``value`` >= v, which lies in
    [low, high], and the number of rows above v.

    Count jobs shrink the range sixteenfold each, until it is one value.
    """
    above = 0
    while low < high:
        step = -(-(high - low) // (THRESHOLDS + 1))
        cuts = list(range(low + step, high + 1, step))
        counts = rows.agg(*[F.count_if(value >= F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        enough = sum(n >= k for n in counts)  # counts fall as thresholds rise
        if enough < len(cuts):
            high, above = cuts[enough] - 1, counts[enough]
        if enough:
            low = cuts[enough - 1]
    return low, above


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """``scored`` (as ``score`` gives it) with ``rank``: of the N rows with at
    least ``least_words`` words the floor(``percent`` N / 100) highest scores get
    1, 2, 3...; all others null.  Every row stays.

    Ties go to the smaller doc_id, null last; rows equal in both are ranked in
    the order in which they lie in the written table.
    """
    spark = scored.sparkSession
    table = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "resample-scores")
    open_ = table.where(F.col("n_words") >= least_words)
    n, low, high = open_.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    k = percent * n // 100
    result = [F.col(c) for c in scored.columns]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return table.select(*result, none)
    # complements, so that every bisection looks for the highest
    by_id, by_row = F.bitwise_not(F.coalesce(F.col("doc_id"), F.lit(_LAST))), F.bitwise_not(F.col("_row"))
    cut, above = threshold(open_, F.col("score"), k, low, high)
    tied, left = open_.where(F.col("score") == cut), k - above
    id_cut, above = threshold(tied, by_id, left, *tied.agg(F.min(by_id), F.max(by_id)).first())
    equal, left = tied.where(by_id == id_cut), left - above
    row_cut, _ = threshold(equal, by_row, left, *equal.agg(F.min(by_row), F.max(by_row)).first())
    inside = (F.col("n_words") >= least_words) & (
        (F.col("score") > cut) | ((F.col("score") == cut) & ((by_id > id_cut) | ((by_id == id_cut) & (by_row >= row_cut)))))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = table.where(inside).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = materialize(laid.withColumn("_at", F.monotonically_increasing_id()), "resample-drawn")  # partition, place in it
    part = F.shiftright("_at", 33)
    before, rows = 0, []
    for r in laid.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        rows.append((r["part"], before))
        before += r["count"]
    starts = spark.createDataFrame(rows, "_part long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = laid.join(F.broadcast(starts), part == F.col("_part")).select(*result, rank.alias("rank"))
    return drawn.unionAll(table.where(~F.coalesce(inside, F.lit(False))).select(*result, none))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10_000, runs: int = 1, seed: int = 2024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``, drawn towards the texts of ``target`` (which may be empty, as may
    ``docs``; its other columns are not read)."""
    gain = gains(bucket_counts(docs, buckets, runs, text), bucket_counts(target, buckets, runs, text))
    return draw(score(docs, gain, runs, seed, key, text), percent, least_words)
