"""Sinks: Parquet feature table, CSV marts, one-row JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite one Parquet dataset (a directory of part files), compressed by
    zstd: feature tables take less of the disk than by Spark's default."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, aggregates: list[Column] | None = None, compression: str = "none"):
    """One CSV dataset with a header; NULL becomes an empty field.  Returns the
    path, or the aggregates of the rows, observed while they were written."""
    seen = Observation()
    out = df.observe(seen, *aggregates) if aggregates else df
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("compression", compression).csv(path)
    return dict(seen.get) if aggregates else path


def write_json(df: DataFrame, path: str) -> str:
    """A small (one-row) report as JSON lines, written as a single part."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
