"""Per-engine sequence transforms (previous reading, delta, rate of change,
rolling mean/std, z-score) as window expressions (``operators.segments``).

Every function takes ``key_cols`` (default ``["engine_id"]``) so several
variants/splits can be processed at once with ids that restart per file.
All window columns of one call share one shuffle of the rows, whatever the
number of sensors.

Rows are ordered totally: by cycle, then by their line (``_file, _block,
_row``) where the frame carries it or by ``tiebreak``, else by a hash of the
row, so that only exact copies are interchangeable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from assetlife.config import CYCLE, ENGINE, FEATURE_SENSORS, ROLLING_WINDOW
from assetlife.functions import present
from assetlife.operators.joins import join_per_group
from assetlife.operators.segments import HEAVY_KEY_ROWS, sequence
from assetlife.operators.stats import exact_moments, written_columns
from assetlife.session import materialize

LINE_COLUMNS = ("_file", "_block", "_row")
_TIE = "_tie"


def sort_observations(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Output order by key then cycle, missing last (windows never need it)."""
    keys = key_cols or [ENGINE]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (*keys, CYCLE)])


def sensors_present(df: DataFrame, sensor_cols=None) -> list[str]:
    return present(df, sensor_cols or FEATURE_SENSORS)


def check_window(window: int) -> None:
    if window < 2:
        raise ValueError(f"a rolling window has 2 rows at least, not {window}")


def engine_sequence(
    df: DataFrame,
    key_cols: list[str] | None = None,
    columns=None,
    lookback: int = 0,
    lookahead: int = 0,
    key_stats: dict | None = None,
    tiebreak: list[str] | None = None,
    rn_name: str | None = None,
    max_rows: int = HEAVY_KEY_ROWS,
    keep: list[str] | None = None,
    ranged: bool = False,
) -> DataFrame:
    """Window columns per engine along cycle and the tie-break.  Of the frame's
    columns only those in ``keep`` (default: all) are carried along."""
    keys = key_cols or [ENGINE]
    ties = tiebreak or [c for c in LINE_COLUMNS if c in df.columns]
    named = df.columns
    if not ties and (columns is not None or rn_name):
        rest = [F.col(c) for c in named if c not in (*keys, CYCLE)]
        df, ties = df.withColumn(_TIE, F.xxhash64(*rest) if rest else F.lit(0)), [_TIE]
    kept = named if keep is None else [c for c in named if c in (*keys, CYCLE, *keep)]
    order_only = [c for c in ties if c not in kept]
    return sequence(df.select(*kept, *order_only), keys, [F.col(CYCLE), *[F.col(c) for c in ties]], columns, lookback, lookahead,
                    key_stats, rn_name, max_rows, order_only, ranged)


def zscore_stats(df: DataFrame, sensors: list[str]) -> dict[str, tuple[Column, Column]]:
    """Mean and population std of every sensor, as scalar subqueries over one
    aggregate: nothing runs before the query that reads them does, and
    columns that are not read drop out.  Reusable, e.g. train statistics for
    the test split."""
    if not sensors:
        return {}
    moments = df.agg(*[e for s in sensors for e in (F.avg(s).alias(f"m_{s}"), F.stddev_pop(s).alias(f"s_{s}"))])
    return {s: (moments.select(f"m_{s}").scalar(), moments.select(f"s_{s}").scalar()) for s in sensors}


def exact_zscore_stats(df: DataFrame, sensors: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """The same statistics as numbers, bit for bit the same whatever the
    partitioning of ``df`` (two passes, now)."""
    table, _ = written_columns(df, sensors)
    return {s: (mean, None if not n else math.sqrt(squares / n)) for s, (n, mean, squares) in exact_moments(table, sensors).items()}


def run_columns(key_cols: list[str] | None) -> list[str]:
    """The key columns that tell runs (variant, split) apart, without the engine."""
    return [k for k in (key_cols or [ENGINE]) if k not in (ENGINE, CYCLE)]


def with_zscore_stats(df: DataFrame, sensors: list[str], groups: list[str],
                      source: DataFrame | None = None) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    """``df`` with mean and population std of every sensor within its run, and
    those columns: each run is normalised as it would be in a frame of its own.

    The statistics are those of ``source``, the same rows before columns were
    added (default: ``df``).  They are written first, one row a run, so that
    their size is known and the rows are not shuffled by run to meet them.
    """
    stats = {s: (f"__mean_{s}", f"__std_{s}") for s in sensors}
    moments = (df if source is None else source).groupBy(*groups).agg(*[e for s, (m, d) in stats.items() for e in (F.avg(s).alias(m), F.stddev_pop(s).alias(d))])
    return join_per_group(df, materialize(moments, "run-moments"), groups), {s: (F.col(m), F.col(d)) for s, (m, d) in stats.items()}


def zscore_columns(sensors: list[str], stats: dict) -> dict[str, Column]:
    """``{s}_norm`` from the statistics (numbers or scalar columns).

    A zero or undefined std gives 0.0 on every row, missing readings included.
    """
    out = {}
    for s in sensors:
        mean, std = (x if isinstance(x, Column) else F.lit(None if x is None else float(x)).cast("double") for x in stats.get(s, (None, None)))
        out[f"{s}_norm"] = F.when(mean.isNull() | std.isNull() | (std == 0), F.lit(0.0)).otherwise((F.col(s) - mean) / std)
    return out


def normalize_sensors(df: DataFrame, sensor_cols=None, stats: dict | None = None, key_cols=None) -> DataFrame:
    """Z-score with global (whole-frame) mean and population std -> ``{s}_norm``.

    A zero or undefined std gives 0.0 on every row.  ``stats`` may carry
    statistics of another frame (e.g. the training split).  With a run's columns
    among ``key_cols`` the statistics are those of each run.
    """
    sensors, base_cols = sensors_present(df, sensor_cols), df.columns
    if stats is None:
        groups = run_columns(key_cols)
        df, stats = with_zscore_stats(df, sensors, groups) if groups else (df, zscore_stats(df, sensors))
    return df.select(*base_cols, *[c.alias(n) for n, c in zscore_columns(sensors, stats).items()])


def lag_columns(w: WindowSpec, sensors: list[str], kind: str, window: int = ROLLING_WINDOW) -> dict[str, Column]:
    """prev / delta / roc / rolling (mean + sample std) columns over ``w``."""
    out: dict[str, Column] = {}
    for s in sensors:
        prev = F.lag(s, 1).over(w)
        if kind == "prev":
            out[f"{s}_prev"] = prev
        elif kind == "delta":
            out[f"{s}_delta"] = F.col(s) - prev
        elif kind == "roc":
            out[f"{s}_roc"] = F.try_divide(F.col(s) - prev, (F.col(CYCLE) - F.lag(CYCLE, 1).over(w)).cast("double"))
        elif kind == "rolling":
            frame = w.rowsBetween(-(window - 1), 0)
            out[f"{s}_rolling_mean"] = F.avg(s).over(frame)
            out[f"{s}_rolling_std"] = F.stddev_samp(s).over(frame)
    return out


def _per_sensor(df: DataFrame, sensor_cols, kind: str, key_cols, window: int = ROLLING_WINDOW,
                lookback: int = 1, **seq_kw) -> DataFrame:
    sensors = sensors_present(df, sensor_cols)
    return engine_sequence(df, key_cols, lambda w: lag_columns(w, sensors, kind, window), lookback=lookback, **seq_kw)


def add_previous_reading(df: DataFrame, sensor_cols=None, key_cols=None, **seq_kw) -> DataFrame:
    """``{s}_prev`` = previous reading of the same engine (NULL on its first cycle)."""
    return _per_sensor(df, sensor_cols, "prev", key_cols, **seq_kw)


def add_sensor_delta(df: DataFrame, sensor_cols=None, key_cols=None, **seq_kw) -> DataFrame:
    """``{s}_delta`` = reading minus previous reading of the same engine."""
    return _per_sensor(df, sensor_cols, "delta", key_cols, **seq_kw)


def add_rate_of_change(df: DataFrame, sensor_cols=None, key_cols=None, **seq_kw) -> DataFrame:
    """``{s}_roc`` = delta / cycle gap; a zero gap gives NULL."""
    return _per_sensor(df, sensor_cols, "roc", key_cols, **seq_kw)


def add_rolling_stats(df: DataFrame, sensor_cols=None, window: int = ROLLING_WINDOW, key_cols=None,
                      **seq_kw) -> DataFrame:
    """Rolling mean and sample std over the last ``window`` rows of the engine."""
    check_window(window)
    return _per_sensor(df, sensor_cols, "rolling", key_cols, window=window, lookback=window - 1, **seq_kw)


def transform_columns(w: WindowSpec, sensors: list[str], window: int) -> dict[str, Column]:
    """delta, then rolling mean/std per sensor (the window part of the suite)."""
    cols = lag_columns(w, sensors, "delta")
    cols.update(lag_columns(w, sensors, "rolling", window))
    return cols


def suite_order(sensors: list[str]) -> list[str]:
    """Output order of the standard suite: all norms, all deltas, then per
    sensor rolling mean and std."""
    return ([f"{s}_norm" for s in sensors] + [f"{s}_delta" for s in sensors]
            + [c for s in sensors for c in (f"{s}_rolling_mean", f"{s}_rolling_std")])


def apply_transformations(df: DataFrame, sensor_cols=None, window: int = ROLLING_WINDOW, key_cols=None,
                          stats: dict | None = None, **seq_kw) -> DataFrame:
    """Standard suite in one pass: z-score, delta, rolling mean/std."""
    check_window(window)
    sensors = sensors_present(df, sensor_cols)
    base_cols = df.columns
    out = engine_sequence(df, key_cols, lambda w: transform_columns(w, sensors, window), lookback=window - 1, **seq_kw)
    if stats is None and not run_columns(key_cols):
        stats = zscore_stats(df, sensors)
    out = normalize_sensors(out, sensors, stats, key_cols)
    return out.select(*base_cols, *suite_order(sensors))
