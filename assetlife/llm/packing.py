"""Packing documents into sequences by best-two-fit.

A sequence is filled greedily, always with the longest piece that still fits.
If room is left, its smallest piece gives way to two unpacked pieces that fill
the room so enlarged more tightly, where there are any.

Pieces of one length are interchangeable, so the rule is applied to the counts
of the lengths, at most ``size`` numbers whatever the corpus: a sequence that
the rule makes is made as often as the counts allow before the next is sought.
That gives a table of (length, first rank, sequence, offset) runs.  Tasks tokenize
the documents and number the pieces of each length as they write them; a running
sum over the tasks turns these numbers into ranks over the whole corpus, and each
piece reads its place from the run in which its rank lies.  No piece and no id
passes the driver, and token ids are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assetlife.llm.common import steps, text_rows
from assetlife.llm.token_ids import Encoder
from assetlife.session import materialize

#: Rows of a batch, and bytes of their texts, that are encoded at a time.
ROWS, STEP = 256, 1 << 20
_SCHEMA = "doc bigint, piece int, start bigint, length int, ids array<int>, part int, nth bigint"


@lru_cache(maxsize=2)
def _encoder(spec: str) -> Encoder:
    """One for all tasks of a worker, which share its table."""
    return Encoder(Tokenizer.from_str(spec))


def cut_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, piece, start, length, ids, part, nth), a written table: each
    document's token ids (of a byte-level BPE vocabulary without a normalizer) and ``end_id``, cut where it holds more than ``size``;
    only the first piece of a cut document is shorter.  ``part`` and ``nth``
    number the pieces of one length as their task wrote them.

    Null and empty texts are one piece of ``end_id`` alone; each repeated row is
    a document of its own; a null key stays null; texts of any length are encoded
    span by span (a text without blanks in one go); other columns are not read; an empty table gives an empty one.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(spec.value)
        seen = np.zeros(size + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                keys, texts = some.column(0).to_pylist(), text_rows(some, "_text")
                for a, b in steps(texts, STEP):
                    yield _pieces(keys[a:b], *encode(texts[a:b]), size, end_id, part, seen)

    return materialize(rows.mapInArrow(run, _SCHEMA), "pack-pieces")


def _pieces(keys: list, flat: np.ndarray, sizes: np.ndarray, size: int, end_id: int, part: int, seen: np.ndarray) -> pa.RecordBatch:
    """The pieces of documents whose ids lie end to end in ``flat``; ``seen``
    counts the pieces of each length."""
    flat = np.insert(flat, np.cumsum(sizes), np.int32(end_id))
    doc, piece, start, length, nth = [], [], [], [], []
    for k, n in zip(keys, (sizes + 1).tolist()):
        at = 0
        for i in range(-(-n // size)):
            long = size if i else (n - 1) % size + 1
            doc.append(k)
            piece.append(i)
            start.append(at)
            length.append(long)
            nth.append(int(seen[long]))
            seen[long] += 1
            at += long
    ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(np.full(len(doc), part, np.int32)), pa.array(nth, pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in _SCHEMA.split(", ")])


def fill(counts: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Sequences as (lengths, how often), by best-two-fit over the number of
    pieces of each length (``counts[n]`` pieces of ``n`` ids)."""
    left = np.array(counts, np.int64)
    made = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return made
        lengths: list[int] = []
        taken: dict[int, int] = {}
        room = size
        while room:
            fits = have[:np.searchsorted(have, room, side="right")]
            n = next((int(n) for n in fits[::-1] if left[n] > taken.get(int(n), 0)), 0)
            if not n:
                break
            more = int(min(room // n, left[n] - taken.get(n, 0)))
            lengths += [n] * more
            taken[n] = taken.get(n, 0) + more
            room -= more * n
        used = dict(taken)  # what the rule looks at, also if it gives it back
        pair = _two(left, taken, room + lengths[-1], lengths[-1]) if room and len(lengths) > 1 else None
        if pair:
            taken[lengths.pop()] -= 1
            for n in pair:
                lengths.append(n)
                taken[n] = taken.get(n, 0) + 1
                used[n] = max(used.get(n, 0), taken[n])
        times = min(int((left[n] - used[n]) // taken[n]) + 1 for n in taken if taken[n])
        for n, k in taken.items():
            left[n] -= k * times
        made.append((sorted(lengths, reverse=True), times))


def _two(left: np.ndarray, taken: dict[int, int], room: int, smallest: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is nearest to ``room`` from below and above
    ``smallest``; of equal sums the one with the longest piece."""
    free = left[:room + 1].copy()
    for n, k in taken.items():
        if n <= room:
            free[n] -= k
    have = np.flatnonzero(free > 0)
    if not len(have):
        return None
    # the longest partner of each length; a length may be its own partner if it is free twice
    at = np.searchsorted(have, room - have, side="right") - 1
    alone = (at >= 0) & (have[at] == have) & (free[have] < 2)
    at = np.where(alone, at - 1, at)
    good = at >= 0
    if not good.any():
        return None
    a, b = have[good], have[at[good]]
    total = a + b
    best = np.lexsort((a, total))[-1]
    return (int(a[best]), int(b[best])) if total[best] > smallest else None


def runs(counts: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """``fill`` as runs of ranks: pieces of ``length`` whose rank is ``first`` or
    more, up to the next run, lie ``each`` to a sequence, from sequence
    ``sequence`` and place ``offset`` on.  Sorted by (length, first)."""
    rows, next_rank, sequence = [], np.zeros(size + 1, np.int64), 0
    for lengths, times in fill(counts, size):
        offset = 0
        for n in dict.fromkeys(lengths):
            each = lengths.count(n)
            rows.append((n, int(next_rank[n]), each, sequence, offset))
            next_rank[n] += each * times
            offset += each * n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T))


def plan(pieces: DataFrame, size: int = 1024) -> tuple[DataFrame, Broadcast]:
    """How the pieces of ``pieces`` (part and length are read) are to lie: the
    rank at which each task's pieces of a length begin, and the runs."""
    sums = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    counts = np.zeros(size + 1, np.int64)
    for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[r["length"]] = r["n"]
    running = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("part", "length", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("_before"))
    return before, pieces.sparkSession.sparkContext.broadcast(runs(counts, size))  # bounded by ``size``, not by the corpus


def place(pieces: DataFrame, planned: tuple[DataFrame, Broadcast]) -> DataFrame:
    """``pieces`` (length, part, nth and any other columns) with ``sequence_id``
    and ``offset`` in place of part and nth.

    Sequences are without gaps; their numbers run from 0.
    """
    before, table = planned
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    ranked = pieces.join(before, ["part", "length"]).select(*kept, (F.col("_before") + F.col("nth")).alias("sequence_id"))
    schema = ranked.withColumn("offset", F.lit(0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = table.value
        starts = (p["length"] << 44) + p["first"]
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy().astype(np.int64)
            rank = batch.column(names.index("sequence_id")).to_numpy()
            i = np.searchsorted(starts, (length << 44) + rank, side="right") - 1
            turn = rank - p["first"][i]
            sequence, offset = p["sequence"][i] + turn // p["each"][i], p["offset"][i] + turn % p["each"][i] * length
            cols = [pa.array(sequence) if n == "sequence_id" else batch.column(k) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(offset.astype(np.int32))], names=[*names, "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, piece, start, length, ids, sequence_id, offset): ``cut_documents``,
    ``plan`` and ``place`` in one."""
    pieces = cut_documents(docs, tokenizer_path, size, end_id, key, text)
    return place(pieces, plan(pieces, size))


def digested(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` (of the ids as little-endian 32-bit numbers)
    in place of ``ids``."""
    import zlib

    kept = [c for c in pieces.columns if c != "ids"]
    schema = pieces.select(*kept, F.lit(0).cast("long").alias("ids_crc32")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.names.index("ids"))
            ends, flat = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in kept], pa.array(crc, pa.int64())], names=[*kept, "ids_crc32"])

    return pieces.select(*kept, "ids").mapInArrow(run, schema)
