"""Helpers shared by the operators: text batches, digests, safe columns."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from assetlife.session import materialize

#: Bytes of text that one step inside a task works on (a single longer text
#: makes a step of its own).
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the session's Python workers this package, as ``--py-files`` would:
    the driver serves a zip of its sources to every executor, once a session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that are written: its cleaner
    learns from a collection on the driver that nothing refers to them any more,
    and none may come by itself before the next large shuffle."""
    spark.sparkContext._jvm.System.gc()


def steps(texts: Iterable[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts holding about ``limit`` bytes."""
    start = size = i = 0
    for i, t in enumerate(texts, 1):
        size += len(t)
        if size >= limit:
            yield start, i
            start, size = i, 0
    if i > start:
        yield start, i


def text_rows(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes, null as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


def map_texts(df: DataFrame, keys: list[str], make: Callable, schema: str, text: str = "text", limit: int = STEP_BYTES) -> DataFrame:
    """``make()`` builds, once per task, a function from (key columns, texts)
    of one step (about ``limit`` bytes) to a list of output columns in the
    order of ``schema``.

    Only ``keys`` and ``text`` are read, so other columns of the input cannot
    clash with the result's names.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    n = len(keys)
    frame = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = text_rows(batch, "_text")
            ks = [batch.column(i).to_pylist() for i in range(n)]
            for a, b in steps(texts, limit):
                cols = work([k[a:b] for k in ks], texts[a:b])
                if len(cols[0]):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)

    return frame.mapInArrow(run, schema)


def most_frequent(counts: DataFrame, size: int) -> list[Row]:
    """``size`` rows of ``counts`` (w, n; each w once) with the largest n, to
    within a sixteenth of a doubling; of those that are level at the end, the
    ones with the smallest hashes.

    Two small histograms find the cut, so no task returns more than its share
    of the rows that are taken (a sorted limit would return ``size`` rows from
    every task).
    """
    counts = materialize(counts, "counts")
    level = F.floor(F.log2("n") * 16)
    last, room = None, size
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some hundred levels
        last = r["level"]
        if r["count"] > room:
            break
        room -= r["count"]
    else:
        return counts.collect()
    above, edge = counts.where(level > last), counts.where(level == last)
    slot = F.pmod(F.xxhash64("w"), F.lit(4096))
    end = None
    for r in edge.groupBy(slot.alias("slot")).count().orderBy("slot").collect():
        end = r["slot"]
        if r["count"] > room:
            break
        room -= r["count"]
    rest = edge.where(slot == end).orderBy(F.xxhash64("w"), "w").limit(room)
    return above.unionAll(edge.where(slot < end)).collect() + rest.collect()


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))
