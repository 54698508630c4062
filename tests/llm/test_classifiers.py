from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetlife.llm import langid, lm_score, quality
from assetlife.llm.common import held_out, most_frequent

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, symbol-only, very long and repeated texts; clashing column names."""
    rows = [(1, None), (2, ""), (3, " \n"), (4, "12 !! 34"), (5, "the and of " * 200_000), (6, "le de la"), (6, "le de la"), (None, "x"), (7, "﷽ 語 \U0001F600")]
    return spark.createDataFrame([(i, t, 5, "f", 0.1) for i, t in rows], "doc_id long, text string, n int, f string, score double")


def test_held_out_follows_crc32(spark):
    import zlib

    rows = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_descent_separates_and_meets_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(200)]
    y = np.array([1.0 if 3 in r or 5 in r else -1.0 for r in rows])
    scale = rng.uniform(0.5, 1.5, 30)
    cost = np.full(200, 0.05)
    w = quality.dual_coordinate_descent(rows, scale, y, cost, epochs=400)

    def primal(v):
        return 0.5 * v @ v + sum(c * max(0.0, 1 - t * (v[r] @ scale[r])) for r, t, c in zip(rows, y, cost))

    best = primal(w)
    for _ in range(200):
        assert primal(w + rng.normal(0, 0.02, 30)) >= best - 1e-3


def test_quality_held_out_accuracy(docs, labels):
    weights = quality.fit(docs, labels, ~held_out(), max_per_class=300)
    got = quality.score(docs, weights).join(labels, "doc_id").where(held_out()).select((F.col("score") >= 0.5).cast("int").alias("p"), "quality").toPandas()
    assert len(got) > 50 and (got["p"] == got["quality"]).mean() > 0.97


def test_quality_odd_rows(spark, odd, labels):
    some = spark.createDataFrame([(4, 0), (5, 1), (5, 1), (6, 1), (6, 0), (None, 1), (9, None)], "doc_id long, quality int")
    weights = quality.fit(odd, some, F.lit(True), max_per_class=10)
    got = quality.score(odd, weights).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (1, 2)} == {0.0}
    nothing = quality.fit(odd, some.limit(0), F.lit(True))
    assert not nothing.any() and {r["score"] for r in quality.score(odd, nothing).collect()} == {0.0, 0.5}
    assert quality.score(odd.limit(0), weights).count() == 0
    kept = quality.keep_good(odd, some, F.lit(True), max_per_class=10)
    assert kept.schema == odd.schema and not {1, 2} & {r["doc_id"] for r in kept.collect()}


def test_shapes_see_repeated_words():
    t, f = quality.features([b"ab cd ab cd", b"ab ab ab ab", b"", b"A1-b\tA1-b"])
    own = [set(f[t == i].tolist()) for i in range(4)]
    assert own[1] - own[0] and own[3] and not own[2]
    alone = [set(quality.features([x])[1].tolist()) for x in (b"ab cd ab cd", b"ab ab ab ab", b"", b"A1-b\tA1-b")]
    assert own == alone  # neighbours in a step do not matter


def test_codewords_are_apart():
    for n in (1, 2, 3, 4, 6, 9, 30):
        code = langid.codewords(n)
        assert len({tuple(c) for c in code}) == n
        if n >= 3:
            distance = (code.shape[1] - code @ code.T) / 2
            assert distance[~np.eye(n, dtype=bool)].min() >= 2


def test_language_held_out_accuracy(docs):
    out = langid.predict(docs, langid.learn(docs, ~held_out())).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.98
    assert out["score"].between(0, 1).all()


def test_language_ambiguity_and_one_flipped_bit(docs):
    model = langid.learn(docs, F.lit(True))
    k = len(model.languages)
    for i in range(k):
        margins = 3.0 * model.code[i][None, :]
        assert langid.decode(margins, model)[0].argmin() == i
        flipped = margins.copy()
        flipped[0, model.trust.argmin()] *= -1
        assert langid.decode(flipped, model)[0].argmin() == i
    spark = docs.sparkSession
    halves = {r["lang"]: r["text"] for r in docs.where("length(text) between 800 and 900").dropDuplicates(["lang"]).collect()}
    both = spark.createDataFrame([(1, "".join(a + b for a, b in zip(halves["de"].split(" "), halves["es"].split(" "))))], "doc_id long, text string")
    sure = langid.predict(docs, model).where("not ambiguous").count() / docs.count()
    assert sure > 0.97 and langid.predict(both, model, ambiguous=1.0).first()["ambiguous"]


def test_language_odd_rows(spark, odd, docs):
    model = langid.learn(docs, ~held_out())
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (6, "fr")} <= got and len(got) == 8
    assert langid.predict(odd, model).count() == 9 and langid.predict(odd.limit(0), model).count() == 0
    nothing = langid.learn(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}
    single = langid.learn(docs.where("lang = 'de'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd, single).collect()} == {"und", "de"}


@pytest.mark.parametrize("size", [0, 1, 7, 40, 333, 999, 5000])
def test_most_frequent_words(spark, size):
    rows = [(f"w{i}", 1 + (1000 // (i + 1) if i < 60 else 0)) for i in range(1000)]
    got = most_frequent(spark.createDataFrame(rows, "w string, n long"), size)
    assert len(got) == len({r["w"] for r in got}) == min(size, 1000)
    left = [n for w, n in rows if w not in {r["w"] for r in got}]
    assert not got or not left or max(left) <= 1.05 * min(r["n"] for r in got)


def brute_models(texts, target, words):
    """Counts by plain loops, hashed cells as the operator has them."""
    from collections import Counter

    out = []
    for chosen in (target, [True] * len(texts)):
        pairs, single, history = Counter(), Counter(), Counter()
        for t, c in zip(texts, chosen):
            ids = [words.get(w, 0) for w in (t or "").encode().lower().split()]
            if c and ids:
                for h, w in zip([1, *ids], [*ids, 1]):
                    pairs[h, w] += 1
                    single[w] += 1
                    history[h] += 1
        out.append((pairs, single, history))
    return out


def test_lm_scores_match_plain_counts(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("aa b cc d e f g hh".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    target = spark.createDataFrame([(i,) for i in range(0, 40, 2)] + [(0,), (None,)], "doc_id long")
    words = lm_score.vocabulary(docs, 5)
    assert len(words) == 5
    got = {r["doc_id"]: r for r in lm_score.cross_entropy_difference(docs, target, 5).collect()}
    models = brute_models(texts, [i < 40 and i % 2 == 0 for i in range(len(texts))], words)
    n = len(words) + 2
    for i, t in enumerate(texts):
        ids = [words.get(w, 0) for w in (t or "").encode().lower().split()]
        want = [0.0, 0.0]
        if ids:
            for m, (pairs, single, history) in enumerate(models):
                total = sum(single.values()) + 0.5 * n
                for h, w in zip([1, *ids], [*ids, 1]):
                    want[m] -= np.log((pairs[h, w] + lm_score.MU * (single[w] + 0.5) / total) / (history[h] + lm_score.MU))
            want = [x / (len(ids) + 1) for x in want]
        assert got[i]["n_tokens"] == (len(ids) + 1 if ids else 0)
        assert abs(got[i]["target_loss"] - want[0]) < 1e-6 and abs(got[i]["background_loss"] - want[1]) < 1e-6
        assert got[i]["score"] == got[i]["target_loss"] - got[i]["background_loss"]


def test_lm_prefers_the_target_and_takes_odd_rows(spark, docs, labels, odd):
    scores = lm_score.cross_entropy_difference(docs, labels.where("quality = 1")).join(labels, "doc_id").groupBy("quality").agg(F.avg("score").alias("s")).collect()
    by = {r["quality"]: r["s"] for r in scores}
    assert by[1] < by[0]
    got = lm_score.cross_entropy_difference(odd, labels.limit(0).select("doc_id")).collect()
    assert len(got) == 9 and all(np.isfinite(r["score"]) for r in got)
    assert lm_score.cross_entropy_difference(odd.limit(0), labels.select("doc_id")).count() == 0


@pytest.mark.parametrize("held", [0, 60, 1 << 19])
def test_lm_keeps_every_word_and_pair(spark, monkeypatch, held):
    monkeypatch.setattr(lm_score, "HELD_PAIRS", held)
    monkeypatch.setattr(lm_score, "_HELD_WORDS", 20_000)
    rng = random.Random(6)
    texts = [" ".join(["the of"] * 5 + [f"w{rng.randrange(100_000)}" for _ in range(1500)]) for _ in range(120)]  # about 83,000 words
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = spark.createDataFrame([(i,) for i in range(0, 120, 3)], "doc_id long")
    words = {w: i + 2 for i, w in enumerate(sorted({w for t in texts for w in t.encode().split()}))}
    assert len(words) > 70_000
    n = len(words) + 2
    got = {r["doc_id"]: r for r in lm_score.cross_entropy_difference(docs, target).collect()}
    assert len(got) == 120
    models = brute_models(texts, [i % 3 == 0 for i in range(120)], words)
    for m, name in enumerate(("target_loss", "background_loss")):
        pairs, single, history = models[m]
        total = sum(single.values()) + 0.5 * n
        for i in range(0, 120, 7):
            ids = [1, *(words[w] for w in texts[i].encode().split()), 1]
            want = -sum(np.log((pairs[h, w] + lm_score.MU * (single[w] + 0.5) / total) / (history[h] + lm_score.MU)) for h, w in zip(ids, ids[1:])) / (len(ids) - 1)
            assert abs(got[i][name] - want) < 1e-6


def test_lm_codes_that_meet_are_changed(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HELD_PAIRS", 2)
    docs = spark.createDataFrame([(i, f"a b c d{i} a b") for i in range(20)], "doc_id long, text string")
    target = docs.where("doc_id < 7").select("doc_id")
    want = lm_score.cross_entropy_difference(docs, target).orderBy("doc_id").collect()
    seeds = []
    counts = lm_score._word_counts

    def meeting(rows, seed, known):
        seeds.append(seed)
        out = counts(rows, seed, known)
        return out.withColumn("code", F.lit(9).cast("long")) if seed == 0 else out

    monkeypatch.setattr(lm_score, "_word_counts", meeting)
    assert lm_score.cross_entropy_difference(docs, target).orderBy("doc_id").collect() == want and seeds == [0, 1]


def test_lm_writes_no_row_per_pair(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(1500)) for _ in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    target = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id long")
    rows, written = {}, lm_score.materialize

    def counting(df, name="stage"):
        out = written(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(lm_score, "materialize", counting)
    want = lm_score.cross_entropy_difference(docs, target).orderBy("doc_id").collect()
    pairs = len(brute_models(texts, [True] * 62, {f"w{i}".encode(): i + 2 for i in range(300)})[1][0])
    assert pairs > 50_000 and sum(rows.values()) < pairs / 10
    monkeypatch.setattr(lm_score, "HELD_PAIRS", 4000)
    monkeypatch.setattr(lm_score, "_BUCKET_PAIRS", 7000)  # 13 buckets
    assert lm_score.cross_entropy_difference(docs, target).orderBy("doc_id").collect() == want


def test_lm_buckets_tell_all_pairs_apart():
    rng = np.random.default_rng(9)
    tokens = [rng.integers(2, 2000, 3000), np.zeros(0, np.int64), rng.integers(2, 2000, 500)]
    assert all((lm_score._unpack(lm_score._pack(x)) == x).all() for x in [*tokens, np.array([0, 255, 256, 1 << 62]), np.zeros(3, np.int64)])
    own = lm_score._Pairs(pa.table({"tokens": pa.array([lm_score._pack(x) for x in tokens], pa.binary())}))
    assert own.n.tolist() == [3001, 0, 501] and own.counts.sum() == 3502
    for bound, buckets in ((2000, 1), (2000, 7), (1 << 34, (1 << 6) + 1)):
        number = rng.permutation(np.unique(rng.integers(0, bound, 8000)))[:2000] if bound > 2000 else rng.permutation(2000)
        order, bucket, key = own.buckets(number, bound, buckets)
        assert len(set(zip(bucket.tolist(), key.tolist()))) == len(own.pairs) and key.min() >= 0 and bucket.max() < buckets
        assert (np.diff(bucket) >= 0).all() and (np.diff(key)[np.diff(bucket) == 0] > 0).all()


def test_descent_has_its_number_of_even_parts(spark):
    sizes = {r["part"]: r["count"] for r in spark.range(6000).groupBy(quality.part_of("id").alias("part")).count().collect()}
    assert sorted(sizes) == list(range(6)) and max(sizes.values()) < 1.2 * min(sizes.values())
