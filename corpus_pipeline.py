"""From raw documents to a training mix: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it to the shared checkpoint folder and reads it back as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetlife.llm import decontam, mixing, quality, secret_scan, simhash
from assetlife.llm.common import held_out, ship, table
from assetlife.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts and texts of any length are scored like others (whole);
    a null id counts as held out; repeated rows share their score and go or stay
    together; an empty table gives an empty one.
    """
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id"), max_per_class=4000)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the smallest id, null last.

    Rows without an id and rows that repeat one are members like any other; null
    and empty texts are one group; of rows equal in id and text any one stays;
    texts are read whole; an empty table gives an empty one.
    """
    ship(spark)
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4, seed=42)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to speak of.

    Null and empty texts hold none and stay; repeated rows, and rows without an
    id, are judged each by its whole text; where documents or benchmark are
    empty, all documents stay.
    """
    ship(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), size=13)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced.

    Every row stays, null and empty texts as they are; n_chars follows a changed
    text; texts are read whole, however long; repeated rows change alike; a
    corpus too small to learn from loses nothing.
    """
    ship(spark)
    return secret_scan.redact(docs, *secret_scan.learn(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with size, source_size, target and taken words.

    Null, empty and blank texts are never taken and go; null sources are one
    source; repeated rows are sampled each for themselves; columns named like
    the four are replaced; an empty table gives an empty one.
    """
    ship(spark)
    return mixing.mix(docs, share=1.5, max_epochs=2.0, seed=7).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

#: Classifiers and fingerprints are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix that the five stages make of the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
