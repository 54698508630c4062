from __future__ import annotations

import random

import pytest
import xxhash

from assetlife.llm.simhash import drop_near_duplicates, fingerprint_links, fingerprint_of, simhash_components

SCHEMA = "doc_id long, text string, fp string, key long, component_id string"


def brute_fingerprint(text: str | None) -> int:
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = raw.split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "Two words", "a b c d e f a b c d", "É é Ü\x0bü\x0cx y z " * 40, "w " * 70000])
def test_fingerprint_matches_brute_force(text):
    assert fingerprint_of(text.encode()) == brute_fingerprint(text)


def test_links_match_brute_force(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(6):
            x = base
            for _ in range(rng.randint(1, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for most in (4, 2, 0):
        got = {tuple(sorted(r)) for r in fingerprint_links(spark.createDataFrame(list(enumerate(signed)), "id long, fp long"), most).collect()}
        want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= most}
        assert got == want


def test_links_come_once(spark):
    rows = [(i, i) for i in range(32)]  # all within five bits of each other
    got = [tuple(sorted(r)) for r in fingerprint_links(spark.createDataFrame(rows, "id long, fp long")).collect()]
    assert len(got) == len(set(got)) == sum((i ^ j).bit_count() <= 4 for i in range(32) for j in range(i))


def test_components_with_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(9, None), (4, ""), (7, "  "), (5, "same text here now"), (5, "same text here now"), (3, "same  TEXT\nhere now"), (None, "same text here now"), (8, long), (2, long + " tail"), (1, "alone in the world")]
    docs = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash_components(docs).collect()), key=str)
    assert got == sorted([(9, 4), (4, 4), (7, 4), (5, 3), (5, 3), (3, 3), (None, None), (8, 2), (2, 2), (1, 1)], key=str)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]
    assert simhash_components(docs.limit(0)).count() == 0


def test_long_chain_is_one_component(spark):
    from assetlife.llm.components import components

    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_one_row_of_each_group_stays(spark):
    """Repeated ids, null ids and equal rows: groups by brute force over all pairs."""
    import random

    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(80)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = rng.choice([*base, "", None])
        if text and rng.random() < 0.3:
            text += " " + rng.choice(["iota", "kappa"])
        rows.append((rng.choice([None, 1, 1, 2, i + 3, i + 3]), text, "x", i, "y"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fps = [fingerprint_of((t or "").encode(), 4, 42) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    kept = drop_near_duplicates(docs).collect()
    assert len(kept) == len(set(group))
    where = {(k, t or ""): g for (k, t, *_), g in zip(rows, group)}
    ids = {}
    for (k, *_), g in zip(rows, group):
        ids.setdefault(g, []).append((k is None, k or 0))
    assert {where[r["doc_id"], r["text"] or ""]: (r["doc_id"] is None, r["doc_id"] or 0) for r in kept} == {g: min(v) for g, v in ids.items()}
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def joins_of(df) -> str:
    """The kinds of joins that Spark means to run, by its own estimates."""
    import re

    return " ".join(re.findall(r"\w+Join", df._jdf.queryExecution().executedPlan().toString()))


def test_the_index_is_not_broadcast(spark):
    """Spark takes the exploded index to be as small as the file of fingerprints: it must not go through the driver whole."""
    from assetlife.session import materialize

    fps = materialize(spark.range(2000).selectExpr("id", "xxhash64(id) as fp"), "test-heads")
    assert joins_of(fingerprint_links(fps)) == "SortMergeJoin"


def test_near_duplicate_stage_broadcasts_no_index(spark, monkeypatch):
    from assetlife.llm import simhash

    seen = []
    monkeypatch.setattr(simhash, "components", lambda links, f=simhash.components: seen.append(joins_of(links)) or f(links))
    docs = spark.range(300).selectExpr("id as doc_id", "concat('the words of text number ', id div 2, ' and so on to its end') as text", "'x' as fp", "id as key", "'y' as component_id")
    assert drop_near_duplicates(docs).count() == 150
    assert seen == ["SortMergeJoin"]
