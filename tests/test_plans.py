"""Plan shape: column pruning reaches the Parquet scan, no Cartesian or
nested-loop joins, and one-row statistics never become a join."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF


def _formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", ["feature_build", "window_analysis", "engine_summary", "order_check_physical"])
def test_pruned_scans_and_no_cartesian(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = _formatted(spark, df)
    reads = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert reads, "expected Parquet scans"
    for unused in ("l_returnflag", "l_linestatus", "props", "event_type"):
        assert all(unused not in r for r in reads), (unused, reads)
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in plan


def test_zscore_statistics_are_lazy(spark):
    """Normalising joins nothing, and its statistics vanish where no
    normalised column is read."""
    from assetlife.plans.registry import li, li_features

    joins = lambda df: len(re.findall(r"^\(\d+\) \w*Join", _formatted(spark, df), re.M))
    assert joins(entry.queries()["zscore"](spark, SF)) == joins(li(spark, SF))
    assert "Subquery" in _formatted(spark, li_features(spark, SF))
    assert "Subquery" not in _formatted(spark, li_features(spark, SF).select("engine_id", "sensor_04_delta", "rul"))


def test_rows_shuffle_once_per_sequence_pass(spark):
    from assetlife.operators import sequence as tx
    from assetlife.plans.registry import li
    from assetlife.session import materialize

    df = materialize(li(spark, SF), "plan-test")
    sensors = ["sensor_02", "sensor_04"]
    out = tx.apply_transformations(df, sensors, stats={s: (0.0, 1.0) for s in sensors})
    assert len(re.findall(r"^\(\d+\) Exchange", _formatted(spark, out), re.M)) == 1


def test_engine_filter_reaches_the_scan(spark):
    """The window is partitioned by the plain key, so the filter passes below it."""
    for name in ("engine_sample", "engine_series"):
        plan = _formatted(spark, entry.queries()[name](spark, SF))
        assert re.search(r"PushedFilters: \[[^\]]*l_suppkey", plan) or re.search(r"Filter[^\n]*\n[^\n]*\n[^\n]*l_suppkey", plan)


def test_split_keys_have_few_segments_and_no_window_over_a_key_of_rows(spark):
    from pyspark.sql import functions as F

    from assetlife.operators import segments

    # lines of 50 engines interleaved one by one
    rows = spark.range(20_000).select((F.col("id") % 50).alias("engine_id"), F.col("id").alias("_line"), F.lit(1.0).alias("v"))
    laid = segments._lay_out(rows, ["engine_id"], [F.col("_line")])
    n = laid.select("engine_id", F.shiftright("_at", 33)).distinct().count()
    assert n <= 50 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = segments.sequence(rows, ["engine_id"], [F.col("_line")], columns=lambda w: {"p": F.lag("v").over(w)}, lookback=1, rn_name="rn", max_rows=10)
    assert out.count() == 20_000 and out.where("rn = 1 and p is null").count() == 50 and out.where("rn > 1 and p = 1.0").count() == 19_950


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from assetlife import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_tables_can_be_dropped(spark):
    import os

    from assetlife.session import drop_scratch, materialize, scratch_mark

    mark = scratch_mark(spark)
    path = materialize(spark.range(3), "gone").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and drop_scratch(spark, mark) == 1 and not os.path.isdir(path)


def test_rows_are_dealt_by_engine_once(spark):
    """The adapters number rows by the engine's own column: feature windows need no second shuffle."""
    from assetlife.plans.registry import li
    from assetlife.operators.sequence import add_sensor_delta
    from assetlife.sources.adapters import event_trajectories
    for rows in (li(spark, SF), event_trajectories(spark, SF)):
        plan = add_sensor_delta(rows)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
