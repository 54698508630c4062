from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assetlife.config import FEATURE_SENSORS, FLEET_KEYS, SENSOR_COLS
from assetlife.operators import lifecycle as fe
from assetlife.operators import segments


def test_rul(feature_frame):
    out = fe.add_remaining_useful_life(feature_frame)
    left = {e: [r.rul for r in out.filter(F.col("engine_id") == e).orderBy("cycle").collect()] for e in (11, 12)}
    assert left == {11: [4, 3, 2, 1, 0], 12: [1, 0]}


def test_cycle_norm(feature_frame):
    part = {(r.engine_id, r.cycle): r.cycle_norm for r in fe.add_normalized_cycle(feature_frame).collect()}
    assert part[11, 1] == pytest.approx(0.2) and part[11, 5] == part[12, 2] == 1.0 and part[12, 1] == 0.5


def test_engineer_features_columns(feature_frame):
    out = fe.engineer_features(feature_frame, sensor_cols=("sensor_02", "sensor_04"), window=2)
    for col in ("engine_id", "cycle", "sensor_02", "sensor_04", "sensor_02_delta", "sensor_02_rolling_mean",
                "sensor_02_rolling_std", "cycle_norm", "rul"):
        assert col in out.columns
    assert out.agg(F.min("rul")).first()[0] == 0
    assert out.columns == ["engine_id", "cycle", "sensor_02", "sensor_04", "op_setting_1",
                           "sensor_02_norm", "sensor_02_delta", "sensor_02_rolling_mean", "sensor_02_rolling_std",
                           "sensor_04_norm", "sensor_04_delta", "sensor_04_rolling_mean", "sensor_04_rolling_std",
                           "cycle_norm", "rul"]


def test_no_sensor_raises(spark):
    df = spark.createDataFrame([(1, 1)], "engine_id bigint, cycle bigint")
    with pytest.raises(ValueError):
        fe.engineer_features(df)


def test_key_cols_keep_variants_apart(feature_frame):
    two = feature_frame.withColumn("variant", F.lit("FD001")).unionByName(
        feature_frame.withColumn("variant", F.lit("FD002")).withColumn("cycle", F.col("cycle") * 2))
    out = fe.add_remaining_useful_life(two, key_cols=["variant", "engine_id"])
    e11 = [r.rul for r in out.filter("variant = 'FD002' AND engine_id = 11").orderBy("cycle").collect()]
    assert e11 == [8, 6, 4, 2, 0]


def test_declared_order_follows_the_frame(feature_frame):
    frame = feature_frame.withColumn("op_setting_2", F.lit(0.0)).withColumn("rul", F.lit(1)).withColumn("sensor_03_delta", F.lit(0.0))
    assert fe.select_feature_columns(frame, ("sensor_03", "sensor_02")) == [
        "engine_id", "cycle", "sensor_03", "sensor_02", "op_setting_1", "op_setting_2", "sensor_03_delta", "rul"]


def test_runs_are_not_shuffled_to_their_statistics(spark):
    """Features of several runs: the rows are dealt once, by engine, and meet one row a run where they lie."""
    rows = spark.range(300).selectExpr("concat('FD00', id % 2) as variant", "'train' as split", "id % 5 as engine_id", "id as cycle",
                                       *[f"cast(id * {i} % 7 as double) as {s}" for i, s in enumerate(FEATURE_SENSORS, 1)])
    out = fe.engineer_features(rows, key_cols=list(FLEET_KEYS))
    plan = str(out._jdf.queryExecution().executedPlan())
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    mean = out.where("variant = 'FD001'").agg(F.avg("sensor_04_norm"), F.stddev_pop("sensor_04_norm")).first()
    assert abs(mean[0]) < 1e-9 and abs(mean[1] - 1) < 1e-9


def test_split_engines_lay_out_what_they_need(spark, monkeypatch):
    """Only the columns that features are made of are laid out, and numbering shuffles rows no more after it."""
    written = {}
    real = segments.materialize

    def noted(df, name):
        written.setdefault(name, []).append(df.columns)
        return real(df, name)

    monkeypatch.setattr(segments, "materialize", noted)
    other = [c for c in SENSOR_COLS if c not in FEATURE_SENSORS]
    rows = spark.range(400).selectExpr("id % 2 as engine_id", "id as cycle", "0.0 as op_setting_1",
                                       *[f"cast(id * {i} % 7 as double) as {s}" for i, s in enumerate([*FEATURE_SENSORS, *other], 1)])
    split, whole = fe.engineer_features(rows, max_rows=50), fe.engineer_features(rows)
    assert split.columns == whole.columns
    names = [f"round({c}, 6) as {c}" for c in whole.columns]
    assert split.selectExpr(*names).exceptAll(whole.selectExpr(*names)).isEmpty() and split.count() == 400
    assert set(written["segments"][0]) == {"engine_id", "cycle", "op_setting_1", *FEATURE_SENSORS, "_at"}
    numbered = segments.row_numbers(rows, ["engine_id"], [F.col("cycle")], max_rows=50)
    assert str(numbered._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") <= 1  # light engines' only
    assert sorted(r[0] for r in numbered.where("engine_id = 1").select("_rn").collect()) == list(range(1, 201))
