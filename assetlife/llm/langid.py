"""Language identification by error-correcting output codes.

Every language gets a codeword; for every bit a binary n-gram classifier (log
ratio of hashed byte n-gram frequencies, languages of one side averaged with
equal weight) predicts which side a text is on.  Loss-weighted decoding sums,
per language, the logistic losses of the bits' margins, each bit weighted by
how well it separates the training languages, and takes the smallest; a text
whose second language comes close is flagged as ambiguous.

Counts are gathered over all training documents, as one array per language and
task; the model is one array of 2^``BITS`` rows and a column per bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlife.llm.common import map_texts, steps, text_rows
from assetlife.llm.grams import byte_grams, joined

BITS = 16
_GRAMS = (3, 4)
_LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case, other ASCII as blanks
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Languages whose counts one task holds before it passes them on.
_HELD = 32


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # 2^BITS x bits
    trust: np.ndarray  # per bit


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """n distinct codewords of +1/-1: all splits for up to six languages, else
    the random code of 10 log2(n) bits with the largest least distance of 64 drawn."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 6:
        columns = [[1 if (s >> k) & 1 else -1 for k in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(columns, float).T
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (n, width))
        distance = (width - code @ code.T) / 2 + np.eye(n) * width
        if distance.min() > far and (abs(code.sum(axis=0)) < n).all():
            best, far = code, distance.min()
    return best


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, ends = joined([t.translate(_FOLD) for t in texts])
    found = [byte_grams(data, ends, n, BITS) for n in _GRAMS]
    return np.concatenate([t for t, _ in found]), np.concatenate([f for _, f in found])


def learn(docs: DataFrame, rows: Column, text: str = "text", lang: str = "lang") -> Model:
    """The model of the languages in ``lang`` of the rows that ``rows`` marks;
    rows with a null language or text are left out.  No rows: no languages."""
    picked = docs.where(rows & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush():
            for name in sorted(held):
                f = np.flatnonzero(held[name])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(f), pa.string()), pa.array(f.astype(np.int32)), pa.array(held[name][f])], names=["lang", "f", "n"])
            held.clear()

        for batch in batches:
            texts, names = text_rows(batch), batch.column(0).to_pylist()
            for a, b in steps(texts):
                t, f = _grams(texts[a:b])
                for name in set(names[a:b]):
                    own = np.array([x == name for x in names[a:b]])
                    if len(held) >= _HELD and name not in held:
                        yield from flush()
                    held[name] = held.get(name, 0) + np.bincount(f[own[t]], minlength=1 << BITS)
        yield from flush()

    counts = picked.mapInArrow(count, "lang string, f int, n bigint").groupBy("lang", "f").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counts["lang"].to_pylist(), object)
    languages = sorted(set(names), key=lambda x: x.encode())
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((1 << BITS, 1), np.float32), np.ones(1))
    share = np.zeros((len(languages), 1 << BITS))
    f, n = counts["f"].to_numpy(), counts["n"].to_numpy()
    for k, name in enumerate(languages):
        share[k, f[names == name]] = n[names == name]
    share += 0.5
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.stack([np.log(share[bit > 0].mean(axis=0)) - np.log(share[bit < 0].mean(axis=0)) if (bit < 0).any() else np.ones(1 << BITS) for bit in code.T], axis=1)
    # a bit's trust: its least expected margin on the languages' own n-grams
    margins = code * (share @ weights)
    trust = np.maximum(margins.min(axis=0), 0.0)
    trust = trust / trust.sum() * len(trust) if trust.sum() > 0 else np.ones(len(trust))
    return Model(languages, code, weights.astype(np.float32), trust)


def decode(margins: np.ndarray, model: Model) -> np.ndarray:
    """Texts x languages: summed logistic loss of the weighted bits."""
    z = margins[:, None, :] * model.code[None, :, :]
    return (model.trust * np.logaddexp(0.0, -z)).sum(axis=2)


def predict(docs: DataFrame, model: Model, sharpness: float = 12.0, ambiguous: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, second, ambiguous), one row per input row.

    ``score`` (0 to 1) is the share of the best language in exp(-loss);
    ambiguous: score under the threshold.  Null texts, texts without a letter
    and a model without languages give ``und`` with score 0, no second and
    ambiguous true.  Of languages that are level the first by name is taken.
    Texts are read whole, however long; repeated rows get a row each; other
    columns, also those named like results, are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shipped.value
        names = np.array([*m.languages, "und", None], object)

        def work(keys, texts):
            t, f = _grams(texts)
            k = len(texts)
            known = np.array([len(m.languages) > 0 and _LETTER.search(x.decode("utf-8", "replace")) is not None for x in texts], bool)
            total = np.zeros((k, m.weights.shape[1]))
            size = np.bincount(t, minlength=k)
            for bit in range(total.shape[1]):
                total[:, bit] = np.bincount(t, m.weights[f, bit], k)
            loss = decode(sharpness * total / np.maximum(size, 1)[:, None], m)
            if not loss.shape[1]:
                loss = np.zeros((k, 1))
            order = np.argsort(loss, axis=1, kind="stable")
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            best = np.where(known, 1 / share.sum(axis=1), 0.0)
            first = np.where(known, order[:, 0], len(m.languages))
            second = np.where(known & (loss.shape[1] > 1), order[:, min(1, loss.shape[1] - 1)], len(m.languages) + 1)
            return [pa.array(keys[0], pa.int64()), pa.array(names[first].tolist(), pa.string()), pa.array(best), pa.array(names[second].tolist(), pa.string()), pa.array(best < ambiguous)]

        return work

    return map_texts(docs.withColumn(key, F.col(key).cast("long")), [key], make, "doc_id bigint, lang_pred string, score double, second string, ambiguous boolean", text)
