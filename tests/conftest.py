from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assetlife.config import RAW_COLUMNS  # noqa: E402
from assetlife.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 8, app="assetlife-tests")


def raw_schema() -> str:
    return ", ".join(f"{c} {'bigint' if c in ('engine_id', 'cycle') else 'double'}" for c in RAW_COLUMNS)


@pytest.fixture
def valid_frame(spark):
    """Engines 1-2 x cycles 1-3; settings 0, 0, 100; sensor_i = i + cycle."""
    rows = []
    for engine in (1, 2):
        for cycle in (1, 2, 3):
            rows.append((engine, cycle, 0.0, 0.0, 100.0, *[float(i + cycle) for i in range(1, 22)]))
    return spark.createDataFrame(rows, raw_schema())


@pytest.fixture
def dirty_frame(spark):
    """Engine 2,2,1,1,1 / cycle 2,1,2,1,1 (last two identical); sensor_01 = 10."""
    rows = []
    for engine, cycle in ((2, 2), (2, 1), (1, 2), (1, 1), (1, 1)):
        rows.append((engine, cycle, 0.0, 0.0, 100.0, 10.0, *[float(i + cycle) for i in range(2, 22)]))
    return spark.createDataFrame(rows, raw_schema())


@pytest.fixture
def seq_frame(spark):
    """Engine 7: cycles 1, 2, 5; engine 3: cycles 4, 6; out of order."""
    rows = [(7, 5, 9.0, 2.0), (3, 6, 30.0, 8.0), (7, 1, 1.5, 6.0), (3, 4, 20.0, 8.0), (7, 2, 4.5, 4.0)]
    return spark.createDataFrame(rows, "engine_id bigint, cycle bigint, sensor_02 double, sensor_04 double")


@pytest.fixture
def feature_frame(spark):
    """Engine 11 lives 5 cycles, engine 12 lives 2; readings follow from (engine, cycle)."""
    lives = {11: 5, 12: 2}
    sensors = {"sensor_02": lambda e, c: 100.0 - 3 * c, "sensor_03": lambda e, c: e * 0.5 + c, "sensor_04": lambda e, c: float(c * c),
               "sensor_07": lambda e, c: 8.25, "sensor_11": lambda e, c: (-1.0) ** c, "sensor_12": lambda e, c: float(e), "sensor_15": lambda e, c: c / 8}
    rows = [(e, c, 0.25, *[f(e, c) for f in sensors.values()]) for e, life in lives.items() for c in range(life, 0, -1)]
    schema = "engine_id bigint, cycle bigint, op_setting_1 double, " + ", ".join(f"{s} double" for s in sensors)
    return spark.createDataFrame(rows, schema)


def ordered(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).collect()]
