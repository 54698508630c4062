"""Session construction and shared-folder helpers.

On a cluster the session is created by ``spark-submit``; the library only
reads ``spark.checkpoint.dir`` from it.  ``local_session`` exists for tests,
the bench and local runs, and is the only place that picks a folder itself.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "assetlife") -> SparkSession:
    """A local session with AQE on, the UI off and a scratch checkpoint dir."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ASSETLIFE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the cluster names it.

    ``spark.checkpoint.dir`` always wins.  Where it is unset, a session on a
    local master gets a fresh folder under the system's temporary one (its
    driver and tasks are one process); any other master is an error, since its
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise ValueError(f"{_CHECKPOINT_KEY} is not set: master {sc.master} needs a folder that its executors share")
        configured = tempfile.mkdtemp(prefix="assetlife-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_METHOD_KEY, _METHOD_DEFAULT, _METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def compiled_methods(spark: SparkSession) -> None:
    """Generate no method that the JVM would interpret row by row.

    HotSpot compiles no method above 8,000 bytes of bytecode, and a projection of
    some forty columns, fused into one method, is larger.  With this limit Spark
    evaluates such a stage by several methods instead; rows are the same.  A limit
    that the session has chosen stays.
    """
    if spark.conf.get(_METHOD_KEY, _METHOD_DEFAULT) == _METHOD_DEFAULT:
        spark.conf.set(_METHOD_KEY, _METHOD_BYTES)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the session's Python workers this package, as ``--py-files`` would:
    the driver serves a zip of its sources to every executor, once a session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """A point to which ``drop_scratch`` can go back."""
    return len(_scratch.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch tables made since a mark; returns their number.
    For callers that have written their results elsewhere, as the job has."""
    made = _scratch.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in made[since:]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    gone = len(made) - since
    del made[since:]
    return gone


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a written Parquet table in the shared checkpoint folder.

    The table survives executor loss (it lives in the cluster's shared
    folder, not on an executor), and reading it back starts a fresh, short
    lineage with Parquet pushdown and pruning.  ``localCheckpoint`` is never
    used; the RDD-based ``Dataset.checkpoint`` recomputes wide plans and is
    avoided for the same reason.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_observed(df: DataFrame, path: str, aggregates: list[Column], partition_by: list[str] | None = None) -> dict:
    """Write a Parquet table and return the aggregates of its rows, taken while
    they were written: no second pass reads them.

    The aggregates are observed in the tasks that write, whose results Spark
    counts once each, also when a task is run again.
    """
    seen = Observation()
    writer = df.observe(seen, *aggregates).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return dict(seen.get)


def materialize_observed(df: DataFrame, aggregates: list[Column], name: str = "stage") -> tuple[DataFrame, dict]:
    """``materialize`` with ``write_observed``."""
    path = scratch_path(df.sparkSession, name)
    metrics = write_observed(df, path, aggregates)
    return df.sparkSession.read.parquet(path), metrics
