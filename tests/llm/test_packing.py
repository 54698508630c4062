from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from assetlife.llm import token_ids
from assetlife.llm.common import ship
from assetlife.llm.packing import cut_documents, digested, fill, pack, runs
from assetlife.llm.queries import QUERIES, TOKENIZER
from assetlife.llm.token_ids import Encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def one_by_one(lengths: list[int], size: int) -> list[list[int]]:
    """The rule on a list of pieces: greedy, then two for the smallest."""
    left, made = sorted(lengths, reverse=True), []
    while left:
        held, room = [], size
        for n in list(left):
            if n <= room:
                held.append(n)
                left.remove(n)
                room -= n
        if room and len(held) > 1:
            s = held[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:] if s < a + b <= room + s]
            if pairs:
                _, a, b = max(pairs)
                held[-1:] = [a, b]
                left.remove(a)
                left.remove(b)
                left = sorted([*left, s], reverse=True)
        made.append(sorted(held, reverse=True))
    return made


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_the_rule_one_by_one(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 7, 20, 100])
    lengths = [min(size, int(rng.paretovariate(0.7))) if seed % 2 else rng.randint(1, size) for _ in range(rng.randint(0, 120))]
    counts = np.bincount(lengths, minlength=size + 1) if lengths else np.zeros(size + 1, int)
    got = [b for b, times in fill(counts, size) for _ in range(times)]
    assert sorted(got) == sorted(one_by_one(lengths, size))
    assert all(sum(b) <= size for b in got) and sorted(n for b in got for n in b) == sorted(lengths)


def test_two_fill_the_room_of_the_smallest():
    # greedy takes 60 and 35, which leaves 5; 25 and 15 fill the 40 beside the 60
    counts = np.bincount([60, 35, 25, 15], minlength=101)
    assert fill(counts, 100) == [([60, 25, 15], 1), ([35], 1)]


def test_runs_place_every_rank_once():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 65)
    counts[0] = 0
    p = runs(counts, 64)
    used: dict[int, list[tuple[int, int]]] = {}
    for n in range(1, 65):
        mine = p["length"] == n
        for rank in range(counts[n]):
            i = np.flatnonzero(mine)[np.searchsorted(p["first"][mine], rank, side="right") - 1]
            turn = rank - p["first"][i]
            used.setdefault(int(p["sequence"][i] + turn // p["each"][i]), []).append((int(p["offset"][i] + turn % p["each"][i] * n), n))
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 64
    assert sorted(used) == list(range(len(used)))


def test_plan_does_not_grow_with_the_counts():
    counts = np.arange(1025) * 7 % 50 + 1
    counts[0] = 0
    assert len(runs(counts * 10**9, 1024)["length"]) < 20_000


def test_ids_are_the_tokenizers(tokenizer, monkeypatch):
    rng = random.Random(5)
    alphabet = "ab é'!　\xa0\n\t 1\x1c\x85中<|endoftext|> sreß_🙂\x00\u2003\u1680"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) + rng.choice(["", "<|endoftext|>", " it's 'tis"]) for _ in range(5000)]
    texts += ["", "x" * 5000, "a " * 40_000, "\n" * 3000, "word word" * 9]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for span, slots in ((1 << 20, 1 << 20), (9, 64)):  # long texts in spans, a table that starts anew
        monkeypatch.setattr(token_ids, "SPAN_BYTES", span)
        monkeypatch.setattr(token_ids, "SLOTS", slots)
        encode = Encoder(tokenizer)
        step = 100 if slots > 64 else 1
        for a in range(0, len(texts) if step > 1 else 1500, step):
            ids, sizes = encode([t.encode() for t in texts[a:a + step]])
            assert sizes.tolist() == [len(w) for w in want[a:a + step]] and ids.tolist() == sum(want[a:a + step], [])


def check(rows, docs, size, end_id, tokenizer):
    """Pieces rebuild every document; sequences are gapless; few of them."""
    seen: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc"] is None, r["doc"], r["piece"])):
        seen.setdefault(r["doc"], []).append(r)
    assert set(seen) == set(docs)
    for doc, texts in docs.items():
        want = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id] for t in texts)
        if len(texts) == 1:
            assert [i for r in seen[doc] for i in r["ids"]] == want[0]
            assert [r["start"] for r in seen[doc]] == np.cumsum([0, *[r["length"] for r in seen[doc]]]).tolist()[:-1]
            assert [r["piece"] for r in seen[doc]] == list(range(len(seen[doc]))) and all(r["length"] == size for r in seen[doc][1:])
        assert sum(r["length"] for r in seen[doc]) == sum(map(len, want))
    sequences: dict = {}
    for r in rows:
        assert len(r["ids"]) == r["length"] <= size
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= size
    lengths = [r["length"] for r in rows]
    if lengths:
        assert len(sequences) == sum(t for _, t in fill(np.bincount(lengths, minlength=size + 1), size))


def test_pack_odd_rows(spark, tokenizer):
    ship(spark)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "sensor", "zqx", "läuft,", "42"]) for _ in range(rng.randint(0, 60))), "x", 1) for i in range(300)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (None, "no id", "x", 1), (1002, "long text " * 3000, "x", 1), (7, rows[7][1], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, nth int")
    texts: dict = {}
    for k, t, *_ in rows:
        texts.setdefault(k, []).append(t)
    for frame in (docs.repartition(3), docs.repartition(11)):
        out = pack(frame, TOKENIZER, size=64)
        assert out.columns == ["doc", "piece", "start", "length", "ids", "sequence_id", "offset"]
        check(out.collect(), texts, 64, 2, tokenizer)
    assert pack(docs.limit(0), TOKENIZER).count() == 0


def test_digests(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    pieces = cut_documents(docs, TOKENIZER)
    crc = {r["doc"]: r["ids_crc32"] for r in digested(pieces).collect()}
    for r in pieces.collect():
        assert crc[r["doc"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_query_against_the_rule(spark, tokenizer):
    """The query's rows over its whole table: ids by digest, places by brute force."""
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_packing"](spark, SF).collect()
    want = {}
    for d, t in docs.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, i] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    assert len({r["sequence_id"] for r in rows}) == len(one_by_one([n for _, n, _ in want.values()], 1024))
