"""Schema names and defaults of the observation table.

Fixed values (must stay as they are for results to match the reference
behaviour): the 26 positional column names of a trajectory text file, the
seven default feature sensors, the default rolling window of 5 rows and the
near-constant variance threshold of 1e-9.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
ENGINE = "engine_id"
CYCLE = "cycle"
SETTING_COLS: tuple[str, ...] = ("op_setting_1", "op_setting_2", "op_setting_3")
SENSOR_COLS: tuple[str, ...] = tuple(f"sensor_{i:02d}" for i in range(1, 22))
RAW_COLUMNS: tuple[str, ...] = (ENGINE, CYCLE, *SETTING_COLS, *SENSOR_COLS)
FEATURE_SENSORS: tuple[str, ...] = (
    "sensor_02",
    "sensor_03",
    "sensor_04",
    "sensor_07",
    "sensor_11",
    "sensor_12",
    "sensor_15",
)
ROLLING_WINDOW = 5
VARIANCE_EPSILON = 1e-9
# Identity of an engine where several runs lie in one table.
FLEET_KEYS: tuple[str, ...] = ("variant", "split", ENGINE)
DEFAULT_VARIANT = "FD001"
DEFAULT_SPLIT = "train"
# Engineered suffixes kept in the feature table, in output order.
FEATURE_SUFFIXES: tuple[str, ...] = ("_norm", "_delta", "_rolling_mean", "_rolling_std")
# Sub-folders searched for a variant file, in order, before any other child.
SEARCH_SUBDIRS: tuple[str, ...] = ("CMAPSSData", "CMaps", "cmapss")
# ---------------------------------------------------------------------------


RAW_SCHEMA = T.StructType(
    [T.StructField(ENGINE, T.LongType()), T.StructField(CYCLE, T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in (*SETTING_COLS, *SENSOR_COLS)]
)

RUL_SCHEMA = T.StructType(
    [T.StructField(ENGINE, T.LongType()), T.StructField("rul", T.DoubleType())]
)
