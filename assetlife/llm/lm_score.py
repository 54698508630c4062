"""Language-model scoring by cross-entropy difference (Moore and Lewis).

Two bigram models with one vocabulary, one order and one smoothing are counted:
the target model over the documents that labels mark as good, the background
model over all documents.  A document's score is the mean over its tokens of
the target's loss minus the background's: the lower, the more it reads like
the target.

Counts cover the whole corpus: every word is in the vocabulary (unless a size
is asked for) and every pair has a count of its own.  Documents are read once
and cut into groups of about ``HELD_PAIRS`` tokens; a group names a word, and
later a pair, once, however often its documents hold it.  Words are counted and
numbered by Spark; they meet their numbers by 64-bit digests whose distinctness
is checked, so no two are taken as one.  A group then sends its pairs, as two
numbers each, to the buckets in which they are counted, and every bucket sends
the counts back in the order in which it was asked.  Nothing is held whole by
the driver or a task, and a frequent pair is one entry of each group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import most_frequent, release, text_rows
from assetlife.session import materialize

#: Weight of the unigram in a pair's smoothed probability.
MU = 4.0
#: Distinct words that a task holds before it passes them on.
_HELD_WORDS = 400_000
#: Pairs of neighbouring words in a group of documents (a longer document is a group of its own).
HELD_PAIRS = 1 << 21
#: Entries that a bucket of pairs has on average.
_BUCKET_PAIRS = 1 << 20
#: Losses are added as multiples of 2^-28, so sums do not depend on their order.
_LOSS_BITS = 28
_UNKNOWN, _EDGE = 0, 1
#: What stands for the two among the words: no word is empty or holds a blank.
_NAMES = (b" ", b"")


class _Numbers(dict):
    """Numbers of words within a group, in the order of appearance; with a
    vocabulary, every other word is the unknown one."""

    def __init__(self, known: frozenset[bytes] | None = None):
        super().__init__()
        self.words, self.known = [_NAMES[_UNKNOWN], _NAMES[_EDGE]], known

    def __missing__(self, word: bytes) -> int:
        if self.known is not None and word not in self.known:
            self[word] = _UNKNOWN
            return _UNKNOWN
        self[word] = len(self.words)
        self.words.append(word)
        return self[word]


def vocabulary(docs: DataFrame, size: int, text: str = "text") -> dict[bytes, int]:
    """Numbers of the ``size`` most frequent words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush():
            words = list(held)
            done = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([held[w] for w in words], pa.int64())], names=["w", "n"])
            held.clear()
            return done

        for batch in batches:
            for t in text_rows(batch, "text"):
                held.update(t.lower().split())
                if len(held) > _HELD_WORDS:
                    yield flush()
        yield flush()

    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    top = sorted(bytes(r["w"]) for r in most_frequent(counts, size))
    return {w: _EDGE + 1 + i for i, w in enumerate(top)}


def _marked(docs: DataFrame, target: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, inside) of all documents.

    The documents meet their marks by a sort-merge join at every size: a list
    of ids grows with the corpus, so it is never sent to all tasks."""
    ids = target.select(F.col(key).cast("long").alias("_id")).where("_id is not null").distinct().withColumn("_in", F.lit(True))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(ids.hint("merge"), F.col("id") == F.col("_id"), "left")
    return rows.select("id", "text", F.coalesce("_in", F.lit(False)).alias("inside"))


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers, none negative, without the high bytes that are zero in all;
    bytes of one place lie side by side, where they compress best."""
    planes = x.astype("<i8").view(np.uint8).reshape(-1, 8).T
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + planes[:width].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :data[0]] = planes.T
    return out.view("<i8").ravel()


def _groups(rows: DataFrame, known: frozenset[bytes] | None) -> tuple[DataFrame, DataFrame]:
    """The documents as (grp, id, inside, tokens), tokens by their numbers in
    the group, packed, and the groups' words as (grp, token, w, n, t): how often each is
    a token in all documents and in the target's.  Both are written once."""
    room = HELD_PAIRS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, size, numbers, held = TaskContext.get().partitionId() << 32, 0, _Numbers(known), []
        names = ["grp", "id", "inside", "tokens", "w", "token", "n", "t"]

        def flush():
            ids, inside, own = zip(*held)
            flat, sizes, m, k = np.concatenate(own), np.array([len(x) for x in own]), len(held), len(numbers.words)
            n = np.bincount(flat, minlength=k)
            t = np.bincount(flat[np.repeat(np.array(inside, bool), sizes)], minlength=k)
            n[_EDGE], t[_EDGE] = (sizes > 0).sum(), ((sizes > 0) & np.array(inside, bool)).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, grp)), pa.array(ids, pa.int64()), pa.array(inside, pa.bool_()), pa.array(map(_pack, own), pa.binary()), *(pa.nulls(m, x) for x in (pa.binary(), pa.int32(), pa.int64(), pa.int64()))], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, grp)), *(pa.nulls(k, x) for x in (pa.int64(), pa.bool_(), pa.binary())), pa.array(numbers.words, pa.binary()), pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(t)], names=names)

        for batch in batches:
            for i, t, inside in zip(batch.column(0).to_pylist(), text_rows(batch, "text"), batch.column(2).to_pylist()):
                own = t.lower().split()
                held.append((i, inside, np.fromiter(map(numbers.__getitem__, own), np.int32, len(own))))
                size += len(own) + 1
                if size >= room:
                    yield from flush()
                    grp, size, numbers, held = grp + 1, 0, _Numbers(known), []
        if held:
            yield from flush()

    out = materialize(rows.mapInArrow(cut, "grp bigint, id bigint, inside boolean, tokens binary, w binary, token int, n bigint, t bigint"), "lm-groups")
    release(rows.sparkSession)  # the shuffled texts
    return out.where("w is null").select("grp", "id", "inside", "tokens"), out.where("w is not null").select("grp", "token", "w", "n", "t")


def _code(seed: int):
    return F.xxhash64(F.lit(seed), F.col("w"))


def _word_counts(found: DataFrame, seed: int, parts: int) -> DataFrame:
    """(code, word, n, t): each word's digest, its number (of the small ones,
    each at most once) and its tokens in all documents and in the target's; the
    edge and the unknown word have rows of their own."""
    sums = found.repartition(parts, "w").groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return materialize(sums.select(_code(seed).alias("code"), (place * parts + F.spark_partition_id()).alias("word"), "n", "t"), "lm-words")


def _numbered(found: DataFrame) -> tuple[DataFrame, int, int, list[float]]:
    """(grp, token, word, n, t): the number and counts of each word of a group;
    a bound of the numbers, the tokens of all documents, and the smoothed totals
    of the target's tokens and of all."""
    seed, parts = 0, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        words = _word_counts(found, seed, parts)
        sums = words.agg(F.count("*").alias("v"), F.countDistinct("code").alias("codes"), F.max("word").alias("last"), F.sum("n").alias("n"), F.sum("t").alias("t")).first()
        if sums["v"] == sums["codes"]:
            break
        seed += 1  # two words with one code: other codes
    release(found.sparkSession)
    # an empty corpus has no groups, so neither edge nor unknown word
    total = [max(2, sums["v"]) * 0.5 + (sums[c] or 0) for c in ("t", "n")]
    met = materialize(found.select("grp", "token", _code(seed).alias("code")).join(words, "code").select("grp", "token", "word", "n", "t"), "lm-numbers")
    release(found.sparkSession)
    return met, (sums["last"] or 0) + 1, sums["n"] or 0, total


class _Pairs:
    """The (history, token) pairs of a group: documents begin and end at an edge,
    those without words have no pairs."""

    def __init__(self, docs: pa.Table):
        tokens = [_unpack(x) for x in docs["tokens"].to_pylist()]
        self.sizes = np.array([len(x) for x in tokens])
        full = self.sizes > 0
        #: tokens of each document, its end among them
        self.n = self.sizes + full
        flat = np.concatenate(tokens)
        ends = np.cumsum(self.sizes)[full]
        token = np.insert(flat, ends, _EDGE)
        history = np.insert(flat, ends - self.sizes[full], _EDGE)
        self.span = int(flat.max(initial=_EDGE)) + 1
        self.pairs, self.place, self.counts = np.unique(history * self.span + token, return_inverse=True, return_counts=True)
        self.history, self.token = self.pairs // self.span, self.pairs % self.span

    def inside(self, marks: np.ndarray) -> np.ndarray:
        """How often each pair stands in documents that are marked."""
        return np.bincount(self.place[np.repeat(marks, self.n)], minlength=len(self.pairs))

    def buckets(self, number: np.ndarray, bound: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, bucket, key) of the pairs by bucket and key.  Within a bucket
        the key tells a pair from all others: the bucket and the token give the
        rest of the history's number."""
        h, w = number[self.history], number[self.token]
        bucket, key = (h + w) % buckets, h // buckets * bound + w
        order = np.lexsort((key, bucket))
        return order, bucket[order], key[order]


def _by_token(facts: pa.Table, column: str) -> np.ndarray:
    """A column of a group's words, by their numbers in the group."""
    token, value = facts["token"].to_numpy(), facts[column].to_numpy()
    out = np.zeros(len(token), np.int64)
    out[token] = value
    return out


def _pair_counts(docs: DataFrame, numbers: DataFrame, bound: int, tokens: int) -> tuple[DataFrame, int]:
    """(grp, bucket, pn, pt): how often each pair of a group stands in all
    documents and in the target's, in the order of the group's keys in the
    bucket; the number of buckets."""
    buckets = max(1, -(-tokens // _BUCKET_PAIRS), (bound * bound >> 62) + 1)  # keys are 63-bit numbers

    def ask(docs: pa.Table, facts: pa.Table) -> pa.Table:
        own = _Pairs(docs)
        order, bucket, key = own.buckets(_by_token(facts, "word"), bound, buckets)
        n, t = own.counts[order], own.inside(docs["inside"].to_numpy().astype(bool))[order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        spans = list(zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]))
        packed = [[_pack(x) for x in (np.diff(key[a:b], prepend=0), n[a:b], t[a:b])] for a, b in spans]
        grp = docs["grp"][0].as_py()
        return pa.table({"bucket": pa.array(bucket[starts], pa.int64()), "grp": pa.array([grp] * len(spans), pa.int64()), **{c: pa.array([x[i] for x in packed], pa.binary()) for i, c in enumerate(("keys", "n", "t"))}})

    def count(asked: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpack(x)) for x in asked["keys"].to_pylist()]
        place = np.unique(np.concatenate(keys), return_inverse=True)[1]
        ends = np.cumsum([len(x) for x in keys])[:-1]
        out = {"grp": asked["grp"], "bucket": asked["bucket"]}
        for c in "nt":
            each, all_of = np.concatenate([_unpack(x) for x in asked[c].to_pylist()]), np.zeros(place.max() + 1, np.int64)
            np.add.at(all_of, place, each)
            out[f"p{c}"] = pa.array([_pack(x) for x in np.split(all_of[place], ends)], pa.binary())
        return pa.table(out)

    asked = docs.groupBy("grp").cogroup(numbers.select("grp", "token", "word").groupBy("grp")).applyInArrow(ask, "bucket bigint, grp bigint, keys binary, n binary, t binary")
    met = materialize(asked.groupBy("bucket").applyInArrow(count, "grp bigint, bucket bigint, pn binary, pt binary"), "lm-pairs")
    release(docs.sparkSession)  # what the groups asked
    return met, buckets


def score(docs: DataFrame, numbers: DataFrame, bound: int, tokens: int, total: list[float]) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score), one row per
    row of ``docs``; losses are means per token in nats, score their difference."""
    counts, buckets = _pair_counts(docs, numbers, bound, tokens)

    def loss(pair: np.ndarray, word: np.ndarray, tokens: float) -> np.ndarray:
        # in a document each word, and the edge, is as often a history as a token, so the
        # sum over its pairs may divide by the token's count as a history for the history's own
        p = (pair + MU * (word + 0.5) / tokens) / (word + MU)
        return np.floor(-np.log(p) * float(1 << _LOSS_BITS) + 0.5).astype(np.int64)

    def work(docs: pa.Table, facts: pa.Table) -> pa.Table:
        own = _Pairs(docs)
        words = facts.filter(facts["token"].is_valid())
        answers = facts.filter(facts["bucket"].is_valid()).sort_by("bucket")
        order = own.buckets(_by_token(words, "word"), bound, buckets)[0]
        ends = np.concatenate(([0], np.cumsum(own.n)))
        out = {"doc_id": docs["id"], "n_tokens": pa.array(own.n)}
        for name, pair, word, tokens in (("t", "pt", "t", total[0]), ("g", "pn", "n", total[1])):
            each = np.zeros(len(order), np.int64)
            each[order] = np.concatenate([np.zeros(0, np.int64), *map(_unpack, answers[pair].to_pylist())])
            run = np.concatenate(([0], np.cumsum(loss(each, _by_token(words, word)[own.token], tokens)[own.place])))
            out[name] = pa.array(run[ends[1:]] - run[ends[:-1]])
        return pa.table(out)

    facts = numbers.unionByName(counts, allowMissingColumns=True)
    sums = docs.groupBy("grp").cogroup(facts.groupBy("grp")).applyInArrow(work, "doc_id bigint, n_tokens bigint, t bigint, g bigint")
    mean = [F.col(c).cast("double") / float(1 << _LOSS_BITS) / F.greatest(F.col("n_tokens"), F.lit(1)) for c in "tg"]
    losses = sums.select("doc_id", "n_tokens", mean[0].alias("target_loss"), mean[1].alias("background_loss"))
    return losses.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame, size: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of ``docs`` against the documents whose ids are in ``target``,
    with a vocabulary of all words, or of the ``size`` most frequent ones.

    n_tokens counts words and the text's end; null texts and texts without
    words have no tokens, losses and score 0.0; repeated rows get equal rows;
    other columns are not read.  Without target documents the target model is
    uniform over the vocabulary."""
    known = None if size is None else frozenset(vocabulary(docs, size, text))
    own, found = _groups(_marked(docs, target, key, text), known)
    return score(own, *_numbered(found))
