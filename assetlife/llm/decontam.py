"""Benchmark decontamination by searching training suffix arrays.

The words of the training documents are numbered and laid end to end, shard by
shard (a few megabytes of whole documents inside a task).  Each shard gets a
suffix array over words, sorted to the depth that the search needs by rank
doubling; every distinct window of the benchmark is binary-searched in it,
which gives, as a range of the array, all its places.

The benchmark is the stated query set: it is shipped to the tasks in blocks of
about ``BLOCK_BYTES``, which the driver holds all at once; each block is matched
against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts, steps, text_rows

#: Benchmark text that goes to the tasks at a time.
BLOCK_BYTES = 8 << 20
# bytes of words stay, A-Z become a-z, all others a blank
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII bytes."""
    return text.translate(_FOLD).split()


class Patterns:
    """Windows of a block of benchmark items as rows of word numbers.

    Words are numbered from 1 in the block's own vocabulary; 0 is any other
    word.  ``rows`` holds each distinct window, padded with -1.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.size = size
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        windows: dict[tuple[int, ...], set[int]] = {}
        self.items: list[str] = []
        for name, words in items:
            if not words:
                continue
            ids = [number(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(1, len(ids) - size + 1)):
                windows.setdefault(tuple(ids[i:i + size]), set()).add(len(self.items))
            self.items.append(name)
        order = sorted(windows)
        self.lengths = np.array([len(w) for w in order], np.int64)
        self.rows = np.full((len(order), size), -1, np.int32)
        for i, w in enumerate(order):
            self.rows[i, :len(w)] = w
        self.owners = [np.array(sorted(windows[w]), np.int64) for w in order]


def word_suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``ids`` ordered by their first ``depth`` numbers at least,
    by doubling ranks.  ``ids`` ends with enough separators."""
    rank, width = ids.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-width] = rank[width:]
        pair = rank * (int(rank.max(initial=0)) + 2) + ahead + 1
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        rank = np.empty(len(pair), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])))[:len(pair)]
        width *= 2
    return order


def _sign(ids: np.ndarray, at: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sign of (suffix at ``at``) - row, over the row's length."""
    there = ids[at[:, None] + np.arange(rows.shape[1])]
    differ = (there != rows) & (np.arange(rows.shape[1]) < lengths[:, None])
    first = differ.argmax(axis=1)
    k = np.arange(len(rows))
    return np.where(differ[k, first], np.sign(there[k, first].astype(np.int64) - rows[k, first]), 0)


def search(ids: np.ndarray, array: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the range of the suffix array that starts with it."""

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(array), np.int64)
        while (unsure := np.flatnonzero(low < high)).size:
            mid = (low[unsure] + high[unsure]) // 2
            sign = _sign(ids, array[mid], rows[unsure], lengths[unsure])
            right = sign <= 0 if upper else sign < 0
            low[unsure[right]] = mid[right] + 1
            high[unsure[~right]] = mid[~right]
        return low

    return bound(False), bound(True)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def match_shard(texts: list[bytes], patterns: Patterns) -> tuple[list[int], list[np.ndarray], list[np.ndarray], list[int]]:
    """For each text: number of words, hit word positions, items whose windows
    occur, longest match in words (searched depth at most)."""
    words = [words_of(t) for t in texts]
    number = patterns.vocabulary.get
    counts = np.fromiter(map(len, words), np.int64, len(words))
    gap = patterns.size
    total = int(counts.sum()) + gap * (len(words) + 1)
    ids = np.zeros(total, np.int32)  # zeros between texts and for other words match nothing
    begins = np.concatenate(([0], np.cumsum(counts[:-1] + gap)))[:len(words)]
    for b, w in zip(begins.tolist(), words):
        ids[b:b + len(w)] = [number(x, 0) for x in w]
    hits = [np.zeros(0, np.int64)] * len(words)
    items = [np.zeros(0, np.int64)] * len(words)
    longest_of = [0] * len(words)
    nothing = counts.tolist(), hits, items, longest_of
    if not len(patterns.rows):
        return nothing
    # a window is made of known words only, so the array needs just the runs of known words that can hold one
    begin, end = _runs(ids > 0)
    wide = end - begin >= patterns.lengths.min()
    begin, end = begin[wide], end[wide]
    if not len(begin):
        return nothing
    shift = np.concatenate(([0], np.cumsum(end - begin + gap)))
    origin = np.arange(shift[-1]) + np.repeat(begin - shift[:-1], end - begin + gap)
    inside = np.arange(shift[-1]) < np.repeat(shift[:-1] + end - begin, end - begin + gap)
    packed = np.where(inside, ids[np.minimum(origin, total - 1)], 0)
    array = word_suffix_array(packed, gap)
    array = array[inside[array]]
    first, last = search(packed, array, patterns.rows, patterns.lengths)
    many = last - first
    found = np.flatnonzero(many)
    if not len(found):
        return nothing
    which = np.repeat(found, many[found])
    places = origin[np.concatenate([array[a:b] for a, b in zip(first[found].tolist(), last[found].tolist())])]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + patterns.lengths[which], -1)
    covered = np.cumsum(cover[:total]) > 0
    text = np.searchsorted(begins, places, side="right") - 1
    order = np.argsort(text, kind="stable")
    text, which = text[order], which[order]
    edges = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(text)]):
        t = int(text[a])
        own = covered[begins[t]:begins[t] + counts[t]]
        hits[t] = np.flatnonzero(own)
        items[t] = np.unique(np.concatenate([patterns.owners[w] for w in np.unique(which[a:b])]))
        head, tail = _runs(own)
        longest_of[t] = int((tail - head).max())
    return counts.tolist(), hits, items, longest_of


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark's items in blocks of bounded size."""
    block: list[tuple[str, list[bytes]]] = []
    held = 0
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    for row in rows.toLocalIterator():
        block.append(("" if row["i"] is None else row["i"], words_of(row["t"].encode())))
        held += len(row["t"])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items array<string>, spans array<struct<start,
    end>>, longest), one row per row of ``docs``.

    A word is hit if it lies in an occurrence of ``size`` consecutive words of
    an item (of the whole item, if that is shorter); spans are runs of hit
    words, longest the longest of them.  items: ids as strings, sorted, each
    once.  Null and empty texts have no words, items without words match
    nothing, repeated rows count each for themselves, an empty benchmark hits
    nothing; other columns are not read.  Texts are read whole, however long; a
    word hit by several items counts once and each of them is named.
    """
    blocks = list(_blocks(benchmark, item, item_text))
    if len(blocks) == 1:
        return _match(docs, blocks[0], size, key, text)
    # more than one block: each is matched against all documents, and the hit spans are united
    tagged = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).withColumn("_twin", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    one_each = tagged.dropDuplicates([key, "_twin"])
    parts = reduce(DataFrame.unionAll, [_match(one_each, b, size, key, text, extra=["_twin"]) for b in blocks])
    united = parts.groupBy("doc_id", "_twin").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"))
    return _unite(tagged.select(F.col(key).alias("id"), F.col("_twin").alias("w")).join(united, F.expr("id <=> doc_id and w = _twin"), "inner"))


def _unite(rows: DataFrame) -> DataFrame:
    spans = F.expr("""aggregate(all, cast(array() as array<struct<start:bigint,end:bigint>>), (acc, s) ->
        case when size(acc) > 0 and element_at(acc, -1).end >= s.start
             then concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, s.end) as end)))
             else concat(acc, array(s)) end)""")
    out = rows.withColumn("spans", spans)
    length = "transform(spans, s -> s.end - s.start)"
    return out.select("doc_id", "n_words", F.expr(f"aggregate({length}, 0L, (a, x) -> a + x)").alias("n_hit"), "items", "spans",
                      F.expr(f"coalesce(array_max({length}), 0L)").alias("longest"))


def _match(docs: DataFrame, block: list[tuple[str, list[bytes]]], size: int, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    extra = extra or []
    shipped = docs.sparkSession.sparkContext.broadcast(Patterns(block, size))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def make():
        patterns = shipped.value

        def work(keys, texts):
            counts, hits, items, longest = match_shard(texts, patterns)
            spans = []
            for h in hits:
                edge = np.flatnonzero(np.diff(h) > 1) + 1 if len(h) else h
                spans.append([{"start": int(r[0]), "end": int(r[-1]) + 1} for r in np.split(h, edge)] if len(h) else [])
            names = [sorted({patterns.items[i] for i in own.tolist()}) for own in items]
            return [pa.array(keys[0], pa.int64()), *[pa.array(k, pa.string()) for k in keys[1:]], pa.array(counts, pa.int64()), pa.array([len(h) for h in hits], pa.int64()),
                    pa.array(names, pa.list_(pa.string())), pa.array(spans, span), pa.array(longest, pa.int64())]

        return work

    frame = docs.select(F.col(key).cast("long").alias(key), *extra, text)
    own = "".join(f", {x} string" for x in extra)
    return map_texts(frame, [key, *extra], make, f"doc_id bigint{own}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>, longest bigint", text)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """The removal rule: some hit word, and a twentieth of all words at least."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text the benchmark contaminates; all
    columns, and rows without words, stay as they are.  Repeated rows go or stay
    together."""
    blocks = list(_blocks(benchmark, "item_id", "text"))
    if len(blocks) > 1:
        gone = contamination(docs.select(F.xxhash64(text).alias("doc_id"), text), benchmark, size, "doc_id", text).where(contaminated()).select("doc_id").distinct()
        return docs.join(gone, F.xxhash64(docs[text]) == gone["doc_id"], "left_anti")
    shipped = docs.sparkSession.sparkContext.broadcast(Patterns(blocks[0], size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_rows(batch, text)
            for a, b in steps(texts):
                counts, hits, _, _ = match_shard(texts[a:b], shipped.value)
                keep = [len(h) == 0 or 20 * len(h) < n for h, n in zip(hits, counts)]
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
