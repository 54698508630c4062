"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, encoded once with offsets, and the
sorted spans of the assistant's texts are intersected with the sorted token
spans by binary search.  The template's marks are added tokens of their own, so
no token lies across a mark; control strings inside texts are escaped
reversibly and can neither end a turn nor be encoded as a mark.

A conversation's turns reach one task, sorted, as a stream; conversations
longer than ``PIECE_CHARS`` come out as several pieces cut between turns (marks
are tokens of their own, so pieces encode as the whole does).  The task holds
one piece at a time, however many turns share an id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

PIECE_CHARS = 1 << 20
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of common chat templates; none may reach the output unescaped.
CONTROL = [TURN, TEXT, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: A word joiner after its first character breaks a control string; a joiner of the text is doubled.
JOINER = "⁠"
_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)")
_ESCAPED = re.compile(f"{JOINER}({JOINER}?)")
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(rf"\1{JOINER}", text.replace(JOINER, JOINER * 2))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, np.ndarray]:
    """The formatted text of (role, text) turns, and the spans of the texts of
    ``loss_role``, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens (sorted spans) that share a character with a sorted loss span."""
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    step = np.zeros(len(offsets) + 1, np.int64)
    some = last > first
    np.add.at(step, first[some], 1)
    np.add.at(step, last[some], -1)
    return np.cumsum(step[:-1]) > 0


def masked_text(text: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """The characters under the mask, each once, in order (tokens that are
    parts of one character share its offset)."""
    starts, ends = offsets[mask, 0], offsets[mask, 1]
    if not len(starts):
        return ""
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    a, b = starts[np.concatenate(([0], cut))], ends[np.concatenate((cut, [len(ends)])) - 1]
    return "".join(text[x:y] for x, y in zip(a.tolist(), b.tolist()))


@lru_cache(maxsize=2)
def _tokenizer(spec: str) -> Tokenizer:
    t = Tokenizer.from_str(spec)
    t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (TURN, TEXT, END)])
    return t


_SCHEMA = "conv_id bigint, piece int, n_turns bigint, formatted string, ids array<int>, starts array<int>, ends array<int>, mask array<boolean>"


def format_conversations(conversations: DataFrame, tokenizer_path: str, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, piece, n_turns, formatted, ids, starts, ends, mask): the
    formatted text, its token ids, their character offsets and the loss mask.

    Turns are ordered by (turn, role, text), nulls first; repeated rows are
    turns of their own; null roles and texts count as empty; rows without a
    conv_id are one conversation; an empty table gives an empty result; other
    columns are not read.  Pieces of a conversation are contiguous and in order
    inside their partition.
    """
    spark = conversations.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary file
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = _tokenizer(spec.value)
        waiting: list[tuple] = []  # (conv_id, piece, n_turns, text, spans)

        def encoded() -> pa.RecordBatch:
            done = tokenizer.encode_batch([w[3] for w in waiting], add_special_tokens=False)
            cols: list[list] = [[] for _ in range(8)]
            for (conv, piece, turns, text, spans), e in zip(waiting, done):
                offsets = np.array(e.offsets, np.int32).reshape(-1, 2)
                for c, v in zip(cols, (conv, piece, turns, text, e.ids, offsets[:, 0], offsets[:, 1], loss_mask(offsets, spans))):
                    c.append(v)
            waiting.clear()
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in _SCHEMA.split(", ")])

        turns: list[tuple[str, str]] = []
        conv = size = piece = held = 0

        def close():
            nonlocal turns, size, held
            text, spans = render(turns, loss_role)
            waiting.append((conv, piece, len(turns), text, spans))
            held += len(text)
            turns, size = [], 0

        for batch in batches:
            for c, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if turns and (c != conv or size >= PIECE_CHARS):
                    close()
                    piece = piece + 1 if c == conv else 0
                    if held >= PIECE_CHARS:
                        yield encoded()
                        held = 0
                elif not turns:
                    piece = 0
                conv = c
                turns.append((role or "", text or ""))
                size += len(text or "")
        if turns:
            close()
        if waiting:
            yield encoded()

    return ordered.mapInArrow(run, _SCHEMA)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars), one row per conversation, computed from what
    ``format_conversations`` returned: turns are parsed out of the formatted
    text, the loss text is what lies under the masked tokens.

    Reads the pieces as they lie in their partitions; a table that was written
    is to be repartitioned by conv_id and sorted by (conv_id, piece) first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        done: list[list] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*[(c, n, t.hexdigest(), k, s.hexdigest(), f) for c, n, t, k, s, f in done])) or [()] * 6
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            at = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            for i in range(batch.num_rows):
                conv, text = at["conv_id"][i].as_py(), at["formatted"][i].as_py()
                if now is None or at["piece"][i].as_py() == 0:
                    if now is not None:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                offsets = np.stack([np.asarray(at[c][i].values) for c in ("starts", "ends")], axis=1)
                loss = unescape(masked_text(text, offsets, at["mask"][i].values.to_numpy(zero_copy_only=False)))
                for role, said in read_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(text)
            if len(done) >= 1024:
                yield flush()
        if now is not None:
            done.append(now)
        yield flush()

    return formatted.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -1, whose turns are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
