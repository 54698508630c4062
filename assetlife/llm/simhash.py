"""SimHash near-duplicates by one-wildcard segment variants.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments (two at least).  Two
fingerprints that differ in at most ``max_bits`` bits then have a segment in
which they differ in at most one bit (otherwise each segment would hold two
differences).  For every segment and every bit in it, the index holds the
segment with that bit wiped, so an equality join on (segment, wiped bit, rest)
brings every such pair together; the join condition verifies the whole
distance and keeps each pair at one key only: its first close segment and, in
it, the differing bit (the first bit if the segments are equal).

Equal fingerprints are collapsed before the join and rejoined after it, so
groups of copies of any size cost one index entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts
from assetlife.llm.components import components
from assetlife.session import materialize

#: Rows of shingle hashes turned into bits at a time.
_CHUNK = 1 << 15


def _lower_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered; other bytes stay."""
    return text.lower().split()


def fingerprint_of(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of one text (no words: 0)."""
    words = _lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), _CHUNK):
        part = hashes[a:a + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes)).view(">u8")
    return int(bits[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, fp long): one row per input row; null text counts as empty.
    ``digest`` adds the text's SHA-256."""

    def make():
        def work(keys, texts):
            fps = np.array([fingerprint_of(t, shingle, seed) for t in texts], np.uint64)
            own = [pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())] if digest else []
            return [pa.array(keys[0], pa.int64()), pa.array(fps.view(np.int64)), *own]

        return work

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), [key], make, "doc_id bigint, fp bigint" + (", digest binary" if digest else ""), text)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment, all 64 bits covered."""
    n = max(2, max_bits // 2 + 1)
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprint_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): ids of distinct fingerprints at most ``max_bits`` apart, each
    pair once.  ``fps`` has one row (id, fp) per fingerprint."""
    segments = _segments(max_bits)
    masks = [((1 << w) - 1) << low for low, w in segments]
    width = max(w for _, w in segments)
    keys, own = [], None
    differ = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    for low, w in segments:
        for i in range(w):
            wiped = ((1 << w) - 1) & ~(1 << i)
            rest = F.shiftrightunsigned(F.col("fp"), low).bitwiseAND(F.lit(wiped))
            keys.append(rest + F.lit((low + i) << width))
    # the pair's own key: its first segment with at most one difference, and there the differing bit
    for (low, _), mask in reversed(list(zip(segments, masks))):
        inside = differ.bitwiseAND(F.lit(_signed(mask)))
        bit = F.when(inside == 0, F.lit(_signed(1 << low))).otherwise(inside)
        own = F.when(F.bit_count(inside) <= 1, bit).otherwise(F.lit(0) if own is None else own)
    index = fps.select("id", "fp", F.explode(F.array(*keys)).alias("key"))
    left = index.select(F.col("id").alias("id_a"), F.col("fp").alias("fp_a"), F.col("key").alias("key_a"))
    right = index.select(F.col("id").alias("id_b"), F.col("fp").alias("fp_b"), F.col("key").alias("key_b"))
    near = (F.col("fp_a") < F.col("fp_b")) & (F.bit_count(differ) <= max_bits)
    # Spark takes an exploded table to be as small as the file it comes from: without the
    # hint it would send the whole index, 64 rows a fingerprint, through the driver
    right = right.hint("merge")
    here = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key_a, {width}) as int))") == own
    return left.join(right, (F.col("key_a") == F.col("key_b")) & near & here).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits.  Null and empty texts have fingerprint zero
    and link like any other; texts are read whole, however long.  Rows without a
    doc_id link with nothing and get a null component; repeated rows stay, each
    with its own result row; other columns, also those named like results, are not
    read; an empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, shingle, seed, key, text), "simhash")
    heads = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id"))
    heads = materialize(heads, "simhash-heads")
    links = fingerprint_links(heads, max_bits)
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    heads = heads.join(found, heads["id"] == found["node"], "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    out = fps.join(heads, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of ``docs``, as it is: the one with the smallest id
    (null last), of equal ids the one whose text has the smallest SHA-256, and any
    one of the rows that share id and text.

    Groups are those of linked fingerprints, whatever the rows' ids: rows without
    an id, and rows that repeat one, are members like any other.  Null and empty
    texts are one group.  An empty table gives an empty one.  Columns stay as
    they are; names that begin with ``__near_`` are reserved.
    """
    rows = materialize(fingerprints(docs, shingle, seed, key, text, digest=True), "simhash")
    heads = materialize(rows.select("fp").distinct().withColumn("id", F.col("fp")), "simhash-heads")  # a fingerprint is its own node
    found = components(fingerprint_links(heads, max_bits).select(F.col("a").alias("u"), F.col("b").alias("v")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    grouped = rows.join(found, rows["fp"] == found["node"], "left").select(F.coalesce("component", "fp").alias("group"), place.alias("place"))
    grouped = materialize(grouped.groupBy("group", "place").agg(F.count("*").alias("n")), "simhash-groups")
    # equal texts are of one group, so a row's own id and digest tell whether it is the first: no rows meet by group
    first = grouped.groupBy("group").agg(F.min("place").alias("first")).select(F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    held = grouped.select(F.col("place.doc_id").alias("__near_id"), F.col("place.digest").alias("__near_digest"), "n")
    same = held["__near_id"].eqNullSafe(first["first_id"]) & (held["__near_digest"] == first["first_digest"])
    held = materialize(held.join(first, same, "left").select("__near_id", "__near_digest", "n", F.col("first_digest").isNotNull().alias("stays")), "simhash-held")
    named = docs.withColumn("__near_sha", F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)))

    def among(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return df.join(some, df[key].cast("long").eqNullSafe(some["__near_id"]) & (df["__near_sha"] == some["__near_digest"]), how)

    names = ["__near_id", "__near_digest"]
    kept = among(named, held.where(~F.col("stays")).select(*names), "left_anti")
    again = held.where(F.col("stays") & (F.col("n") > 1)).select(*names)
    if not again.isEmpty():
        copies = among(kept, again, "left_semi").dropDuplicates([key, "__near_sha"])
        kept = among(kept, again, "left_anti").unionByName(copies)
    return kept.drop("__near_sha")
