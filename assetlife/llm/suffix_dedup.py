"""Verbatim-repeat removal with two-stage suffix arrays.

Every string of ``length`` bytes that also starts earlier in the corpus
(smaller document id, or earlier in the same document) is removed.

1. *Segments.*  The smallest hash among the ``ANCHOR``-byte strings inside a
   window of ``length`` bytes is a function of the window alone, so equal
   windows have equal minima.  Runs of windows with one minimum, cut where they
   get longer than ``RUN`` windows (as they do in periodic text, whose pieces are
   then copies of each other), form a segment; its minimum is its bin.  Segments
   cover every window once.
2. *Settling.*  Segments with equal content (64-bit bin and content digests)
   are collapsed to the earliest: first inside each step of a task, before the
   shuffle, then in a stream sorted by bin.  All windows of a later copy start
   earlier elsewhere, so it is removed whole.  Bins with one distinct content
   need nothing more (unless it repeats inside itself).
3. *Suffix arrays.*  The distinct segments of each remaining bin get a suffix
   array by two-stage sorting: suffixes smaller than their successors are
   sorted directly, the others are induced by scanning the buckets.  Runs of
   adjacent suffixes with a common prefix of ``length`` or more are equal
   windows, and all but the earliest are marked.
4. *Cutting.*  Marked spans are merged per document and cut out.

A bin with more than ``HOT`` distinct contents (a passage met in very many
contexts) is split: its windows are dealt by their whole content.  Equal windows
then come in the order of their documents, and all but the first are marked as
they pass, so what a task holds does not grow with the number of documents that
share a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts, release
from assetlife.session import materialize

#: Bytes of the strings whose hashes bin the windows (a power of two).
ANCHOR = 32
#: Distinct contents beyond which a bin is split by window.
HOT = 4096
#: Windows of a segment.
RUN = 1 << 11
#: Bytes of segments that one suffix array holds, and a bin more (HOT bounds it).
ARRAY_BYTES = 1 << 20
_SLICE = 1 << 15
_LOW = 18


def _gram_hash(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k-byte string of ``data``, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    base, width = 0x100000001B3, 1
    while width < k:
        wider = h[:-width] * np.uint64(base)
        wider += h[width:]
        h, base, width = wider, base * base & (1 << 64) - 1, 2 * width
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    width = 1
    while width * 2 <= w:
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return np.minimum(x[:width - w], x[w - width:]) if w > width else x


def window_segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts laid end to end in ``data`` (text i ends at
    ``ends[i]``): (text, first window, windows, bin, repeats inside itself)."""
    low = np.uint64((1 << _LOW) - 1)
    k = min(ANCHOR, 1 << (length.bit_length() - 1))
    found = []
    for at in range(0, max(0, len(data) - length + 1), _SLICE):
        part = data[at:at + _SLICE + length - 1]
        key = (_gram_hash(part, k) & ~low) | np.arange(len(part) - k + 1, dtype=np.uint64)
        least = _sliding_min(key, length - k + 1)
        p = np.arange(at, at + len(least))
        text = np.searchsorted(ends, p, side="right")
        inside = p + length <= ends[text]
        least, p, text = least[inside], p[inside], text[inside]
        if not len(p):
            continue
        bins = least >> np.uint64(_LOW)
        cut = np.flatnonzero((bins[1:] != bins[:-1]) | (p[1:] != p[:-1] + 1) | (text[1:] != text[:-1])) + 1
        first = np.concatenate(([0], cut))
        pieces = -(-np.diff(np.append(first, len(p))) // RUN)
        if len(pieces) < pieces.sum():
            turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = np.repeat(first, pieces) + turn * RUN
        last = np.append(first[1:], len(p)) - 1
        found.append((text[first], p[first], last - first + 1, bins[first].astype(np.int64), (least[first] & low) != (least[last] & low)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(c) for c in zip(*found))


def _spread(x: np.ndarray) -> np.ndarray:
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(_LOW)).astype(np.int64)


def _find_segments(length: int):
    """Rows (bin, content, doc, start, n, inside): one per segment that is the
    earliest of its content in its step; the others have a null content and a
    bin of their own, so that copies do not meet in one task."""

    def make():
        def work(keys, texts):
            joined = b"".join(texts)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            ends = np.cumsum(sizes)
            text, p, n, bins, inside = window_segments(np.frombuffer(joined, np.uint8), ends, length)
            digest, view = xxhash.xxh3_64_intdigest, memoryview(joined)
            content = np.fromiter((digest(view[a:b]) for a, b in zip(p.tolist(), (p + n + length - 1).tolist())), np.uint64, len(p)).astype(np.int64)
            doc = np.array(keys[0], np.int64)[text]
            start = p - (ends - sizes)[text]
            order = np.lexsort((start, doc, content, bins))
            text, n, bins, inside, content, doc, start = (x[order] for x in (text, n, bins, inside, content, doc, start))
            copy = np.concatenate(([False], (bins[1:] == bins[:-1]) & (content[1:] == content[:-1])))[:len(bins)]
            head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(copy))))
            twin = copy & (doc == doc[head]) & (start == start[head])  # the same row given twice
            bins = np.where(copy, _spread(doc * 1000003 + start), bins)
            keep = ~twin
            return [pa.array(bins[keep]), pa.array(content[keep], mask=copy[keep]), pa.array(doc[keep]), pa.array(start[keep]), pa.array(n[keep].astype(np.int32)), pa.array(inside[keep])]

        return work

    return make


#: What is to be done with a settled segment.
_SORT, _SPLIT, _DROP = 0, 1, 2


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bin, content, doc, start) -> (doc, start, n, bin, what).

    Holds at most ``HOT`` + 1 rows of an unfinished bin between batches.
    """
    held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, bool)]  # firsts of the last bin
    hot = last = None  # bin already found hot; (bin, content, doc, start) of the last first row

    def out(doc, start, n, bins, what):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(n), pa.array(bins), pa.array(np.full(len(doc), what, np.int8) if np.isscalar(what) else what)], names=["doc", "start", "n", "bin", "what"])

    def firsts(bins, doc, start, n, inside):
        """Rows of whole bins, one for each distinct content."""
        if not len(bins):
            return None
        edge = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        size = np.repeat(np.diff(np.append(edge, len(bins))), np.diff(np.append(edge, len(bins))))
        want = (size > 1) | inside | (bins == hot if hot is not None else False)
        what = np.where((size > HOT) | (bins == hot if hot is not None else False), _SPLIT, _SORT).astype(np.int8)
        return out(doc[want], start[want], n[want], bins[want], what[want])

    for batch in batches:
        content_null = np.asarray(batch.column(1).is_null())
        bins, content, doc, start, n, inside = (np.asarray(c.fill_null(0) if c.null_count else c) for c in batch.columns)
        if content_null.any():
            yield out(doc[content_null], start[content_null], n[content_null], bins[content_null], _DROP)
            bins, content, doc, start, n, inside = (x[~content_null] for x in (bins, content, doc, start, n, inside))
        if not len(bins):
            continue
        before = last or (None,) * 4
        new = np.ones(len(bins), bool)
        new[1:] = (bins[1:] != bins[:-1]) | (content[1:] != content[:-1])
        new[0] = (bins[0], content[0]) != before[:2]
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        head_doc = np.where(head >= 0, doc[head], before[2] if last else 0)
        head_start = np.where(head >= 0, start[head], before[3] if last else 0)
        copies = ~new & ((doc != head_doc) | (start != head_start))
        if copies.any():
            yield out(doc[copies], start[copies], n[copies], bins[copies], _DROP)
        last = (bins[-1], content[-1], head_doc[-1], head_start[-1])
        held = [np.concatenate((h, x[new])) for h, x in zip(held, (bins, doc, start, n, inside))]
        open_bin = bins[-1]
        done = held[0] != open_bin
        if done.any() and (rows := firsts(*(h[done] for h in held))) is not None:
            yield rows
        held = [h[~done] for h in held]
        if len(held[0]) > HOT or (hot == open_bin and len(held[0])):
            hot = open_bin
            yield firsts(*held)
            held = [h[:0] for h in held]
    if (rows := firsts(*held)) is not None:
        yield rows


def two_stage_suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the strings ``data[starts[i]:ends[i]]`` that begin at their
    first ``wanted[i]`` bytes (and the few after them that induction needs), in
    the order of their first ``depth`` bytes.  A string's end is smaller than
    any byte.

    Directly sorted: suffixes smaller than their successor.  A larger one is
    its first byte before its successor's place: scanning the buckets of first
    bytes upwards meets every successor before the suffixes that it induces.
    """
    n = len(data)
    at = np.arange(n)
    step = np.zeros(n, np.int16)
    step[:-1] = data[1:].astype(np.int16) - data[:-1]
    step[ends - 1] = -1
    # equal neighbours go the way of the next unequal pair
    way = np.minimum.accumulate(np.where(step != 0, at, n - 1)[::-1])[::-1]
    smaller = step[way] > 0
    # induction starts at a directly sorted suffix, or at the string's end
    anchor = np.minimum.accumulate(np.where(smaller, at, n)[::-1])[::-1]
    seam = starts + wanted
    stop = np.where(seam < ends, np.minimum(anchor[np.minimum(seam, n - 1)], ends - 1), ends - 1)
    taken = np.zeros(n + 1, np.int32)
    np.add.at(taken, starts, 1)
    np.add.at(taken, stop + 1, -1)
    taken = np.cumsum(taken[:n]) > 0
    padded = np.concatenate((data, np.zeros(depth, np.uint8)))
    direct = at[taken & smaller]
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    owner = np.searchsorted(ends, direct, side="right")
    short = np.flatnonzero(direct + depth > ends[owner])
    for a in range(0, len(short), 1 << 14):  # a string's bytes end with it
        part = short[a:a + (1 << 14)]
        rows[part] *= np.arange(depth) < (ends[owner[part]] - direct[part])[:, None]
    direct = direct[np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").ravel(), kind="stable")]
    first = np.zeros(n, bool)
    first[starts] = True
    induced = taken & ~smaller
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    split = np.searchsorted(data[direct], np.arange(257))

    def induce(scanned: np.ndarray) -> np.ndarray:
        """Deal the larger predecessors of scanned suffixes to their buckets."""
        before = scanned[~first[scanned]] - 1
        before = before[induced[before]]
        byte = data[before]
        for b in np.unique(byte).tolist():
            larger[b].append(before[byte == b])
        return before

    tails = ends - 1
    tails = tails[induced[tails]]
    for b in np.unique(data[tails]).tolist():
        larger[b].append(tails[data[tails] == b])
    array = []
    for b in range(256):
        while larger[b]:
            fresh = np.concatenate(larger[b])
            larger[b] = []
            array.append(fresh)
            induce(fresh)
        if split[b] < split[b + 1]:
            group = direct[split[b]:split[b + 1]]
            array.append(group)
            induce(group)
    return np.concatenate(array) if array else at[:0]


def common_prefixes(data: np.ndarray, suffixes: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array, at
    most ``depth``; ``room``: bytes left in each suffix's string."""
    padded = np.concatenate((data, np.zeros(depth, np.uint8)))
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    out = np.zeros(len(suffixes), np.int64)
    for a in range(1, len(suffixes), 1 << 15):
        b = min(len(suffixes), a + (1 << 15))
        differ = view[suffixes[a:b]] != view[suffixes[a - 1:b - 1]]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
        out[a:b] = np.minimum(same, np.minimum(room[a:b], room[a - 1:b - 1]))
    return out


def repeated_windows(segments: list[bytes], docs: np.ndarray, offsets: np.ndarray, bins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, start, end) of runs of windows that start earlier elsewhere among
    the segments."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    data = np.frombuffer(b"".join(segments), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    windows = sizes - length + 1
    array = two_stage_suffix_array(data, starts, ends, windows, length)
    owner = np.searchsorted(ends, array, side="right")
    whole = array + length <= ends[owner]
    array, owner = array[whole], owner[whole]
    prefix = common_prefixes(data, array, ends[owner] - array, length)
    group = np.cumsum(prefix < length)
    doc, start = docs[owner], offsets[owner] + array - starts[owner]
    order = np.lexsort((start, doc, group))
    group, doc, start = group[order], doc[order], start[order]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), np.arange(len(group)), 0)) if len(group) else group
    again = (doc != doc[head]) | (start != start[head])
    doc, start = doc[again], start[again]
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    if not len(doc):
        return doc, start, start
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)) + 1
    a, b = np.concatenate(([0], cut)), np.concatenate((cut, [len(doc)])) - 1
    return doc[a], start[a], start[b] + length


def _extract(length: int):
    """Rows with a text and its wanted segments -> the segments' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wants = batch.column(2)
            edge = np.asarray(wants.offsets)
            flat = wants.values
            start, n, bins, what = (np.asarray(flat.field(i)) for i in range(4))
            for i, text in enumerate(batch.column(1)):
                raw, a, b = text.as_py(), edge[i], edge[i + 1]
                doc = batch.column(0)[i].as_py()
                seg, where, dealt = [], [], []
                for s, m, key, w in zip(start[a:b].tolist(), n[a:b].tolist(), bins[a:b].tolist(), what[a:b].tolist()):
                    if w == _SPLIT:
                        for k in range(s, s + m):
                            piece = raw[k:k + length]
                            seg.append(piece)
                            where.append(k)
                            dealt.append(xxhash.xxh3_64_intdigest(piece) >> 1)
                    else:
                        seg.append(raw[s:s + m + length - 1])
                        where.append(s)
                        dealt.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int64()), pa.array(seg, pa.binary()), pa.array([doc] * len(seg), pa.int64()), pa.array(where, pa.int64())], names=["bin", "seg", "doc", "start"])

    return run


def _suffix_arrays(length: int):
    """Rows sorted by (bin, doc, start) -> marked spans; whole bins, ARRAY_BYTES
    at a time.  Of a bin that is longer, equal windows are marked as they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg: list[bytes] = []
        bins, docs, starts = (np.zeros(0, np.int64) for _ in range(3))

        def marked(doc, a, b):
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(a), pa.array(b)], names=["doc", "start", "end"])

        def flush(k: int):
            nonlocal seg, bins, docs, starts
            out = marked(*repeated_windows(seg[:k], docs[:k], starts[:k], bins[:k], length))
            seg, bins, docs, starts = seg[k:], bins[k:], docs[k:], starts[k:]
            return out

        def pass_copies():
            """Mark windows that are held already; their first stays."""
            nonlocal seg, bins, docs, starts
            first: dict[bytes, int] = {}
            head = np.fromiter((first.setdefault(s, i) if len(s) == length else i for i, s in enumerate(seg)), np.int64, len(seg))
            own = head == np.arange(len(seg))
            copy = ~own & ((docs != docs[head]) | (starts != starts[head]))
            out = marked(docs[copy], starts[copy], starts[copy] + length)
            seg, bins, docs, starts = [s for s, k in zip(seg, own.tolist()) if k], bins[own], docs[own], starts[own]
            return out

        held = 0
        for batch in batches:
            col = [np.asarray(batch.column(i)) for i in (0, 2, 3)]
            for a in range(0, batch.num_rows, 2048):
                more = batch.column(1).slice(a, 2048).to_pylist()
                seg += more
                held += sum(map(len, more))
                bins, docs, starts = (np.concatenate((x, c[a:a + 2048])) for x, c in zip((bins, docs, starts), col))
                if held < ARRAY_BYTES:
                    continue
                if k := int(np.searchsorted(bins, bins[-1])):
                    yield flush(k)
                else:
                    yield pass_copies()
                held = sum(map(len, seg))
        if seg:
            yield flush(len(seg))

    return run


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(starts[1:] > reach[:-1]) + 1
    return starts[np.concatenate(([0], cut))], reach[np.concatenate((cut, [len(reach)])) - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = batch.column(2)
        for i, text in enumerate(batch.column(1)):
            raw, own = text.as_py(), spans[i].values
            if own is None or not len(own):
                starts = ends = np.zeros(0, np.int64)
            else:
                starts, ends = _merge(np.asarray(own.field(0)), np.asarray(own.field(1)))
            edges = [0, *np.stack((starts, ends), 1).ravel().tolist(), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i:i + 1], pa.array([len(raw)], pa.int64()), pa.array([kept], pa.binary()),
                 pa.array([[{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())]], span)],
                names=["doc", "n_bytes", "kept", "spans"])


def _numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) with one text per doc, and the ids of the docs if they are
    not the rows' own.

    Where an id is null or has several rows, the documents are the distinct
    (id, text) pairs, numbered in the order of id and text; null comes last.
    """
    plain = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = plain.agg(F.count("*").alias("rows"), F.count("id").alias("ids")).first()
    unique = plain.select("id").distinct().where("id is not null").count()
    if counts["rows"] == counts["ids"] == unique:
        return plain.withColumnRenamed("id", "doc"), None
    pairs = plain.select("id", F.sha2("text", 256).alias("digest"))
    ranked = materialize(pairs.distinct().orderBy(F.col("id").asc_nulls_last(), "digest").withColumn("at", F.monotonically_increasing_id()), "ids")
    numbered = plain.withColumn("digest", F.sha2("text", 256)).alias("p").join(ranked.alias("r"), F.expr("p.id <=> r.id and p.digest = r.digest"))
    return numbered.select(F.col("r.at").alias("doc"), F.col("p.text").alias("text")), ranked.select(F.col("at").alias("doc"), "id")


def cut_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, kept binary, spans array<start, end>), one row per
    input row: the text's bytes without every byte covered by a string of
    ``length`` bytes that also starts earlier; spans are the maximal removed
    runs.

    Null text counts as empty, texts shorter than ``length`` stay whole, longer
    ones of any length are judged whole, an empty table gives an empty result,
    other columns are not read.  Rows with
    the same id and text are one document and get equal results; different
    texts under one id are documents of their own in the order of their SHA-256
    digests; rows without an id come after all others.
    """
    whole, ids = _numbered(docs, key, text)
    found = map_texts(whole, ["doc"], _find_segments(length), "bin bigint, content bigint, doc bigint, start bigint, n int, inside boolean")
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = found.repartition(n, "bin").sortWithinPartitions("bin", "content", "doc", "start")
    settled = materialize(ordered.mapInArrow(_settle, "doc bigint, start bigint, n int, bin bigint, what tinyint"), "segments")
    release(docs.sparkSession)
    wanted = settled.where(F.col("what") != _DROP).groupBy("doc").agg(F.collect_list(F.struct("start", "n", "bin", "what")).alias("wants"))
    texts = whole.dropDuplicates(["doc"]) if ids is not None else whole
    cut = texts.join(wanted, "doc").select("doc", "text", "wants").mapInArrow(_extract(length), "bin bigint, seg binary, doc bigint, start bigint")
    marked = cut.repartition(n, "bin").sortWithinPartitions("bin", "doc", "start").mapInArrow(_suffix_arrays(length), "doc bigint, start bigint, end bigint")
    copies = settled.where(F.col("what") == _DROP).select("doc", "start", (F.col("start") + F.col("n") + F.lit(length - 1)).alias("end"))
    spans = marked.unionAll(copies).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    result = whole.join(spans, "doc", "left").select("doc", "text", "spans").mapInArrow(
        _cut, "doc bigint, n_bytes bigint, kept binary, spans array<struct<start:bigint,end:bigint>>")
    if ids is not None:
        return result.join(ids, "doc").select(F.col("id").alias("doc_id"), "n_bytes", "kept", "spans")
    return result.withColumnRenamed("doc", "doc_id")
