from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from assetlife.llm import resampling
from assetlife.llm.common import ship
from assetlife.llm.resampling import resample, score, threshold

SCHEMA = "doc_id long, text string, rank string, score int"


def features(text, runs):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return w, [" ".join(w[i:i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent, least, buckets, runs, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    src, tgt = Counter(), Counter()
    for _, t in rows:
        src.update(map(bucket, features(t, runs)[1]))
    for t in target:
        tgt.update(map(bucket, features(t, runs)[1]))
    s_all, t_all = sum(src.values()), sum(tgt.values())
    out = []
    for k, t in rows:
        w, f = features(t, runs)
        weight = sum(math.floor(1000 * math.log((tgt[b] + 1) * (s_all + buckets) / ((src[b] + 1) * (t_all + buckets)))) for b in map(bucket, f))
        h = int(sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks.setdefault((r[0], r[4]), []).append(place)
    return out, ranks


def documents(n):
    rng = random.Random(n)
    vocabulary = ["alpha", "Beta", "gamma", "straße", "delta", "x1", "don't", "中文"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def held(spark, rows, target, runs=1, percent=10, least=20, buckets=97, partitions=5):
    docs = spark.createDataFrame([(k, t, "r", 1) for k, t in rows], SCHEMA).repartition(partitions)
    goal = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    got = resample(docs, goal, percent, least, buckets, runs).collect()
    want, ranks = brute(rows, target, percent, least, buckets, runs, 2024)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(map(tuple, want), key=key)
    mine = {}
    for r in got:
        if r["rank"] is not None:
            mine.setdefault((r["doc_id"], r["score"]), []).append(r["rank"])
    assert {k: sorted(v) for k, v in mine.items()} == ranks


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_against_brute_force(spark, runs, monkeypatch):
    ship(spark)
    rows = documents(400) + [(1000, None), (1001, ""), (1002, "alpha " * 900), (None, "beta " * 30), (7, "gamma " * 25)]
    for percent, least in ((10, 20), (100, 0), (37, 1)):
        held(spark, rows, ["alpha alpha beta gamma", None, "straße x1"], runs, percent, least)


def test_long_texts_come_in_spans(monkeypatch):
    monkeypatch.setattr(resampling, "SPAN", 11)
    text = "Some words; and more-words are hereé now " * 20
    for runs in (1, 2, 4):
        at, want = resampling.Bucketer(1009, runs), features(text, runs)
        found = list(at.spans(text.encode()))
        assert sum(n for n, _ in found) == len(want[0])
        assert Counter(b for _, f in found for b in f.tolist()) == Counter(zlib.crc32(f.encode()) % 1009 for f in want[1])


def test_ties_and_equal_rows(spark):
    """One key holds most rows: equal scores, equal ids, null ids."""
    ship(spark)
    same = "alpha beta gamma " * 10
    held(spark, [(5, same)] * 300 + [(None, same)] * 200 + documents(50), ["alpha"], percent=35)
    held(spark, [(None, same)] * 100, ["alpha"], percent=10)


def test_empty(spark):
    ship(spark)
    held(spark, documents(9), [], percent=10)  # fewer than one to draw
    held(spark, documents(60), [])
    docs = spark.createDataFrame([], SCHEMA)
    assert resample(docs, docs).count() == 0


def test_threshold(spark):
    rng = random.Random(0)
    values = [rng.choice([rng.randint(-50, 50), -10**12, 2**62]) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 77, 250, 499, 500):
        cut = sorted(values, reverse=True)[k - 1]
        assert threshold(rows, F.col("v"), k, min(values), max(values)) == (cut, sum(v > cut for v in values))


def test_drawn_rows_lean_to_the_target(spark):
    ship(spark)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["red", "green"] if i % 10 == 0 else ["one", "two", "three"]) for _ in range(30))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = resample(docs, spark.createDataFrame([("red green green red",)] * 50, "text string")).where("rank is not null")
    assert [r["doc_id"] % 10 for r in drawn.collect()] == [0] * 100
    assert score(docs, resampling.gains(*[resampling.bucket_counts(docs)] * 2)).agg(F.min("weight"), F.max("weight")).first()[0:2] == (0, 0)
