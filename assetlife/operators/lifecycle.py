"""Life-cycle features: normalised cycle, remaining useful life, the feature
table.

``max(cycle)`` per engine is a per-key statistic of the sequence pass
(``key_stats``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlife.config import CYCLE, ENGINE, FEATURE_SUFFIXES, ROLLING_WINDOW
from assetlife.functions import present
from assetlife.operators.sequence import (
    check_window,
    engine_sequence,
    run_columns,
    sensors_present,
    transform_columns,
    with_zscore_stats,
    zscore_columns,
    zscore_stats,
)

_MAX = "__max_cycle"


def _max_cycle_stat():
    return {_MAX: ("max", F.col(CYCLE))}


def cycle_norm_col():
    return F.try_divide(F.col(CYCLE).cast("double"), F.col(_MAX).cast("double"))


def rul_col():
    return (F.col(_MAX) - F.col(CYCLE)).cast("bigint")


def add_normalized_cycle(df: DataFrame, key_cols=None, **seq_kw) -> DataFrame:
    """``cycle_norm = cycle / max_cycle(engine)``; a zero max gives NULL."""
    out = engine_sequence(df, key_cols, key_stats=_max_cycle_stat(), **seq_kw)
    return out.withColumn("cycle_norm", cycle_norm_col()).drop(_MAX)


def add_remaining_useful_life(df: DataFrame, key_cols=None, **seq_kw) -> DataFrame:
    """``rul = max_cycle(engine) - cycle`` (run-to-failure data only)."""
    out = engine_sequence(df, key_cols, key_stats=_max_cycle_stat(), **seq_kw)
    return out.withColumn("rul", rul_col()).drop(_MAX)


def _settings(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("op_setting_")]


def select_feature_columns(df: DataFrame, sensor_cols=None) -> list[str]:
    """The feature columns that ``df`` has, in their fixed order: ids, sensors,
    settings, what was engineered from each sensor, life position and label."""
    sensors = sensors_present(df, sensor_cols)
    engineered = [f"{s}{suffix}" for s in sensors for suffix in FEATURE_SUFFIXES]
    return present(df, [ENGINE, CYCLE, *sensors, *_settings(df), *engineered, "cycle_norm", "rul"])


def engineer_features(
    df: DataFrame,
    sensor_cols=None,
    window: int = ROLLING_WINDOW,
    include_rul: bool = True,
    key_cols=None,
    stats: dict | None = None,
    **seq_kw,
) -> DataFrame:
    """The feature table in one pass: cycle_norm, z-score, delta,
    rolling mean/std and (optionally) rul, then the feature column order.

    With a run's columns (variant, split) among ``key_cols`` every run is built,
    normalised too, as it would be in a frame of its own."""
    sensors = sensors_present(df, sensor_cols)
    if not sensors:
        raise ValueError("none of the feature sensors is a column of the frame")
    check_window(window)
    keys = key_cols or [ENGINE]
    groups = run_columns(keys)
    read = [*sensors, *_settings(df)]
    wide = engine_sequence(df, keys, lambda w: transform_columns(w, sensors, window), lookback=window - 1,
                           key_stats=_max_cycle_stat(), keep=read, **seq_kw)
    if stats is None:
        wide, stats = with_zscore_stats(wide, sensors, groups, df) if groups else (wide, zscore_stats(df, sensors))
    norms = zscore_columns(sensors, stats)
    life = {"cycle_norm": cycle_norm_col()}
    if include_rul:
        life["rul"] = rul_col()
    wide = wide.select("*", *[c.alias(n) for n, c in {**norms, **life}.items()])
    keep = select_feature_columns(wide, sensors)
    return wide.select(*groups, *keep)
