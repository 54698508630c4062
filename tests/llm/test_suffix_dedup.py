from __future__ import annotations

import random

import numpy as np
import pytest

from assetlife.llm import suffix_dedup
from assetlife.llm.suffix_dedup import common_prefixes, cut_repeats, two_stage_suffix_array


def brute(rows: list[tuple[int, str | None]], length: int) -> list[tuple[int, int, bytes, list[tuple[int, int]]]]:
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        cover = np.zeros(len(raw) + 2, bool)
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                cover[s + 1:s + 1 + length] = True
            seen.add(w)
        edge = np.diff(cover.astype(int))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((i, len(raw), bytes(b for b, c in zip(raw, cover[1:]) if not c), spans))
    return out


def run(spark, rows, length):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, bin string")
    return sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), [(s["start"], s["end"]) for s in r["spans"]]) for r in cut_repeats(frame, length).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(0)
    for trial in range(30):
        strings = [bytes(rng.choice(list(b"\x00ab\xff" if trial % 2 else b"ab"), rng.integers(1, 40)).tolist()) for _ in range(6)]
        data = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum([len(s) for s in strings])
        starts = ends - np.array([len(s) for s in strings])
        depth = 64
        array = two_stage_suffix_array(data, starts, ends, ends - starts, depth)
        assert sorted(array.tolist()) == list(range(len(data)))
        owner = np.searchsorted(ends, array, side="right")
        suffix = [data[a:ends[o]].tobytes() for a, o in zip(array.tolist(), owner.tolist())]
        padded = [s.ljust(depth, b"\0") for s in suffix]
        assert padded == sorted(padded)
        prefix = common_prefixes(data, array, ends[owner] - array, depth)
        for k in range(1, len(suffix)):
            a, b = suffix[k - 1], suffix[k]
            assert prefix[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_matches_brute_force_on_mixed_copies(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.6 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 5))]
        rows.append((i * 3 + 1, " ".join(parts)))
    rows += [(500, "La " * 400), (501, "La " * 300), (502, "a" * 333), (503, ""), (504, None), (505, "ab" * 90), (2, "x\0" * 80 + "\0" * 150), (506, "\0" * 160)]
    assert run(spark, rows, 100) == brute(rows, 100)
    assert run(spark, rows, 33) == brute(rows, 33)


@pytest.mark.parametrize("hot", [1, 3])
def test_crowded_bins_are_split(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(i, "".join(rng.choice("ijklm") for _ in range(rng.randint(0, 90))) + shared[rng.randint(0, 20):] + "".join(rng.choice("nopq") for _ in range(rng.randint(0, 90)))) for i in range(80)]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_settling_streams_over_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    rows = [(1, 5, 10, 0, 2, False), (1, 5, 11, 0, 2, False)] + [(2, c, c, 0, 1, False) for c in range(6)] + [(3, 1, 1, 1, 4, True), (4, 1, 1, 9, 4, False), (4, 2, 1, 20, 4, False)] + [(5, None, 3, 3, 1, False)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
    want = sorted([(11, 0, 2), *[(c, 0, 1) for c in range(6)], (1, 1, 0), (1, 9, 0), (1, 20, 0), (3, 3, 2)])
    for size in (1, 2, 5, 50):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[a:a + size]), kinds)], names=list("abcdef")) for a in range(0, len(rows), size)]
        got = sorted((d, s, w) for b in suffix_dedup._settle(iter(batches)) for d, s, w in zip(*(b.column(i).to_pylist() for i in (0, 1, 4))))
        assert got == want, size


def test_repeated_and_missing_ids(spark):
    rng = random.Random(8)
    a, b = "abcdefghij" * 12 + "tail", "".join(rng.choice("abcdefghijklm") for _ in range(150))
    rows = [(1, b), (1, b), (2, "zz" + b), (2, "0123456789" * 11), (None, b + "yy"), (None, None), (3, a)]
    got = {(i, n): kept for i, n, kept, _ in run(spark, rows, 100)}
    assert got[1, 150] == b.encode() and got[2, 152] == b"zz" and got[None, 152] == b"yy" and got[None, 0] == b""
    assert len(run(spark, rows, 100)) == 7
    assert run(spark, [], 100) == []


def test_long_text(spark):
    rng = random.Random(2)
    body = "".join(rng.choice("abcdefghijklmnop") for _ in range(300_000))
    rows = [(1, body), (2, body[1000:200_000] + "!" + body[:500])]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_periodic_texts(spark):
    """One character, periods of two and of seven, megabytes of one character."""
    rows = [(1, "a" * 9000), (2, "ab" * 6000), (3, "x" + "abcdefg" * 1200 + "y"), (4, "ba" * 300 + "a" * 500), (5, "bcdefga" * 90)]
    assert run(spark, rows, 100) == brute(rows, 100)
    got = run(spark, [(1, "a" * 3_000_000), (2, "ab" * 1_000_000), (3, "b" + "a" * 99 + "!")], 100)
    assert [(n, len(kept), len(spans)) for _, n, kept, spans in got] == [(3_000_000, 1, 1), (2_000_000, 2, 1), (101, 101, 0)]


@pytest.mark.parametrize("hot, most", [(1, 300), (3, 1000), (4096, 100)])
def test_small_arrays(spark, monkeypatch, hot, most):
    """Bins beyond an array's bytes: equal windows are marked as they pass."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", most)
    monkeypatch.setattr(suffix_dedup, "RUN", 16)
    rng = random.Random(6)
    shared = "".join(rng.choice("abcdefgh") for _ in range(180))
    rows = [(i, "".join(rng.choice("ijklm") for _ in range(rng.randint(0, 60))) + shared[rng.randint(0, 30):] * rng.randint(1, 2)) for i in range(60)]
    rows += [(100, "ab" * 200), (101, "a" * 350), (102, shared)]
    assert run(spark, rows, 100) == brute(rows, 100)
