from __future__ import annotations

from pyspark.sql import functions as F

from assetlife.operators import cleaning as cl


def test_drop_exact_duplicates(dirty_frame):
    assert cl.drop_exact_duplicates(dirty_frame).count() == 4


def test_sort_by_engine_cycle(dirty_frame):
    out = cl.sort_by_engine_cycle(cl.drop_exact_duplicates(dirty_frame)).collect()
    assert [r.engine_id for r in out] == [1, 1, 2, 2]
    assert [r.cycle for r in out] == [1, 2, 1, 2]


def test_enforce_numeric_and_infinites(dirty_frame):
    df = dirty_frame.withColumn("sensor_02", F.when(F.col("cycle") == 2, F.lit("bad"))
                                .otherwise(F.col("sensor_02").cast("string")))
    df = df.withColumn("sensor_03", F.when(F.col("engine_id") == 2, F.lit(float("inf"))).otherwise(F.col("sensor_03")))
    out = cl.enforce_numeric_types(df)
    assert dict(out.dtypes)["sensor_02"] == "double"
    assert out.filter(F.col("cycle") == 2).filter(F.col("sensor_02").isNull()).count() == 2
    out = cl.replace_infinites_with_nan(out)
    assert out.filter((F.col("engine_id") == 2) & F.col("sensor_03").isNull()).count() == 2


def test_clean_sensor_data(dirty_frame):
    out = cl.clean_sensor_data(dirty_frame)
    assert out.columns[:2] == ["engine_id", "cycle"]
    assert "sensor_01" not in out.columns
    assert out.agg(F.min("cycle")).first()[0] >= 1
    assert out.count() == out.distinct().count() == 4


def test_near_constant_keeps_undefined_variance(spark, dirty_frame):
    assert cl.near_constant_sensors(dirty_frame) == ["sensor_01"]
    assert cl.near_constant_sensors(dirty_frame.limit(0)) == []


def test_clean_matches_step_by_step(dirty_frame):
    df = dirty_frame.withColumn("sensor_04", F.when(F.col("cycle") == 1, F.lit(float("nan"))).otherwise(F.col("sensor_04")))
    composite = cl.clean_sensor_data(df)
    steps = cl.drop_rows_with_missing_core(cl.replace_infinites_with_nan(cl.enforce_numeric_types(
        cl.drop_exact_duplicates(df))))
    steps = cl.project_to_schema(cl.restore_integer_ids(cl.drop_near_constant_sensors(steps)))
    assert sorted(map(tuple, composite.collect())) == sorted(map(tuple, steps.collect()))
