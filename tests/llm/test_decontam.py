from __future__ import annotations

import random
import re

from assetlife.llm import decontam
from assetlife.llm.decontam import contaminated, contamination, drop_contaminated

_W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _W.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=13):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w = words(text)
        hit, names = set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if own := windows.get(tuple(w[a:a + k])):
                    hit.update(range(a, a + k))
                    names |= own
        out.append((i, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, size=13):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_words int, items string")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = contamination(d, b, size).withColumn("bad", contaminated()).collect()
    for r in rows:
        assert r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"]) and r["longest"] == max([s["end"] - s["start"] for s in r["spans"]], default=0)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["bad"]) for r in rows), key=str), d, b


def material(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "ß", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([3, 12, 13, 14, 40]))) for i in range(25)] + [(25, "Solo"), (26, ""), (27, None), (28, "!!"), (3, text(20)), (None, "unnamed item")]
    docs = []
    for i in range(80):
        parts = [text(rng.randint(0, 30)) for _ in range(3)]
        if rng.random() < 0.7:
            parts.insert(rng.randint(0, 2), (rng.choice(items)[1] or "").upper().replace(" ", rng.choice([" ", ", ", "\n--"])))
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "...;"), (103, "solo"), (None, "so solo"), (104, "x " * 60_000 + "unnamed\titem"), (104, "x " * 60_000 + "unnamed\titem")]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = material()
    for size in (13, 4):
        got, _, _ = run(spark, docs, items, size)
        assert got == brute(docs, items, size)


def test_blocks_of_the_benchmark_unite(spark, monkeypatch):
    docs, items = material(2)
    one, _, _ = run(spark, docs, items)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 150)
    got, d, b = run(spark, docs, items)
    assert got == one == brute(docs, items)
    want = sorted((str(i) for i, *_, bad in brute(docs, items) if not bad))
    assert sorted(str(r["doc_id"]) for r in drop_contaminated(d, b).collect()) == want


def test_filter_keeps_clean_rows_whole(spark):
    docs, items = material(3)
    _, d, b = run(spark, docs, items)
    kept = drop_contaminated(d, b)
    assert kept.schema == d.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, *_, bad in brute(docs, items) if not bad)


def test_empty_tables(spark):
    docs, items = material(4)
    got, d, b = run(spark, docs[:5], [])
    assert all(r[2:] == (0, [], False) for r in got)
    assert drop_contaminated(d, b).count() == 5 and drop_contaminated(d.limit(0), b).count() == 0
    assert run(spark, [], items)[0] == []


def test_suffix_array_order():
    import numpy as np

    rng = np.random.default_rng(1)
    ids = np.concatenate((rng.integers(0, 4, 300), np.zeros(16))).astype(np.int32)
    array = decontam.word_suffix_array(ids, 13)
    keys = [tuple(ids[a:a + 13]) + (0,) * max(0, 13 - (len(ids) - a)) for a in array.tolist()]
    assert sorted(array.tolist()) == list(range(len(ids)))
    inside = [k for a, k in zip(array.tolist(), keys) if a < 300]
    assert inside == sorted(inside)
