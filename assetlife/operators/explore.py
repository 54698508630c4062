"""Exploration (EX1-EX11): profiles, life tables, histograms, correlations,
outlier fences, box-plot statistics and the findings record.

Everything is an aggregate: one-pass moments, exact percentiles by radix
selection (``operators.stats``) and pairwise-complete correlations from
co-moments that every task keeps for all pairs at once.  Only one-row (or
one-row-per-column) results come back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlife.config import CYCLE, ENGINE, FEATURE_SENSORS
from assetlife.functions import present
from assetlife.operators.stats import exact_moments, exact_percentiles_many, percentiles_of, written_columns
from assetlife.session import materialize, materialize_observed, ship

DESCRIBE_COLS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact 25/50/75 % (linear), max per
    numeric column, one row per column (EX1)."""
    cols = columns or _numeric(df)
    spark = df.sparkSession
    narrow, counts = written_columns(df, cols)
    qs = percentiles_of(narrow, cols, [0.25, 0.5, 0.75], counts)
    quartiles = spark.createDataFrame([(c, *qs[c]) for c in cols], "column_name string, p25 double, p50 double, p75 double")
    out = quartiles.join(_moments(narrow, cols), "column_name", "left")
    return out.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


#: Columns whose moments are one aggregate: few enough to stay in generated code.
_TOGETHER = 6


def _moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, count, mean, std, min, max) of each column; every aggregate
    reads its own few columns of the written table."""
    parts = []
    for a in range(0, len(columns), _TOGETHER):
        some = columns[a:a + _TOGETHER]
        x = [F.col(c).cast("double") for c in some]
        one = df.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
                       .alias(f"c{i}") for i, (c, v) in enumerate(zip(some, x))])
        parts.append(one.select(F.explode(F.array(*one.columns)).alias("m")).select("m.*"))
    return reduce(DataFrame.unionByName, parts)


def engine_life(features: DataFrame, key_cols=None) -> DataFrame:
    """``max(cycle)`` per engine (EX2, first level)."""
    keys = key_cols or [ENGINE]
    return features.groupBy(*keys).agg(F.max(CYCLE).alias("max_cycle"))


def sensor_summary(df: DataFrame, sensor_cols=None) -> DataFrame:
    """mean, sample std, min, max per sensor, one row per sensor (EX3), bit for
    bit the same whatever the partitioning."""
    sensors = present(df, sensor_cols or FEATURE_SENSORS)
    table = df.select(*[F.col(s).cast("double").alias(s) for s in sensors])
    table, seen = materialize_observed(table, [f(s).alias(f"{name}_{s}") for s in sensors for name, f in (("min", F.min), ("max", F.max))], "sensors")
    rows = [(s, mean, math.sqrt(squares / (n - 1)) if n > 1 else None, seen[f"min_{s}"], seen[f"max_{s}"]) for s, (n, mean, squares) in exact_moments(table, sensors).items()]
    return df.sparkSession.createDataFrame(rows, "sensor string, mean double, std double, min double, max double")


def engine_sample(readings: DataFrame, engines=(1, 5, 10, 25, 50), sensor: str = "sensor_04") -> DataFrame:
    """(engine_id, cycle, sensor) for a few engines, for trend plots (EX4).
    Raw readings are enough: no feature is read."""
    return readings.filter(F.col(ENGINE).isin(list(engines))).select(ENGINE, CYCLE, sensor)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed (EX5).

    A constant column uses the range (v - 0.5, v + 0.5).  Every bin is
    returned, empty ones with count 0.
    """
    spark = df.sparkSession
    rng = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    x = F.col(column).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id").cast("double") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("id") + 1).cast("double") * F.lit(width)).alias("upper"))
    return edges.join(counts, "bin", "left").select("bin", "lower", "upper",
                                                     F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def co_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, n, si, sj, qi, qj, p) for i <= j: over the rows where columns i and j
    both have a value, their number and the sums of x_i, x_j, x_i^2, x_j^2 and
    x_i x_j about the columns' means.

    A task keeps one such state for all pairs; states add up.
    """
    ship(df.sparkSession)
    k = len(columns)
    narrow = materialize(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), "moments")
    means = narrow.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in narrow.columns]).first()
    centre = np.array(list(means))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
            d = np.where(known > 0, x - centre, 0.0)
            n, s, q, p = n + known.T @ known, s + d.T @ known, q + (d * d).T @ known, p + d.T @ d
        i, j = np.triu_indices(k)
        cols = [i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["i", "j", "n", "si", "sj", "qi", "qj", "p"])

    each = narrow.mapInArrow(run, "i int, j int, n bigint, si double, sj double, qi double, qj double, p double")
    return each.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "qi", "qj", "p")])


def pair_correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(var_a, var_b, corr): Pearson correlation of the given column pairs over
    pairwise-complete rows, in one pass; a constant column gives NULL."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    n = F.col("n")
    spread = lambda q, s: F.col(q) - F.try_divide(F.col(s) * F.col(s), n)
    # what rounding leaves of a constant column's squares is no variance
    some = lambda q, s: F.when(spread(q, s) > F.col(q) * F.lit(1e-12), spread(q, s))
    joint = F.col("p") - F.try_divide(F.col("si") * F.col("sj"), n)
    corr = joint / F.sqrt(some("qi", "si") * some("qj", "sj"))
    state = co_moments(df, columns).select("i", "j", corr.alias("corr"))
    asked = df.sparkSession.createDataFrame([(*sorted((columns.index(a), columns.index(b))), a, b) for a, b in pairs], "i int, j int, var_a string, var_b string")
    return asked.join(state, ["i", "j"], "left").select("var_a", "var_b", "corr")


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over pairwise-complete rows;
    a constant column gives NULL (EX6)."""
    one = pair_correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    mirrored = one.where("var_a <> var_b").select(F.col("var_b").alias("var_a"), F.col("var_a").alias("var_b"), "corr")
    return one.unionByName(mirrored)


def rul_correlations(features: DataFrame, sensor_cols=None) -> DataFrame:
    """Correlation of each sensor with rul, ranked ascending (EX7)."""
    sensors = present(features, sensor_cols or FEATURE_SENSORS)
    ranked = pair_correlations(features, [(s, "rul") for s in sensors]).select(
        F.col("var_a").alias("sensor"), F.col("corr").alias("corr_with_rul"))
    return ranked.orderBy(F.col("corr_with_rul").asc_nulls_last(), "sensor")


def engine_series(features: DataFrame, engine_id: int = 1, sensor: str = "sensor_04") -> DataFrame:
    """One engine's raw reading, rolling mean, delta and rolling std by cycle (EX8)."""
    cols = [c for c in (sensor, f"{sensor}_rolling_mean", f"{sensor}_delta", f"{sensor}_rolling_std")
            if c in features.columns]
    return features.filter(F.col(ENGINE) == engine_id).select(CYCLE, *cols).orderBy(CYCLE)


def iqr_fences(df: DataFrame, column: str = "sensor_04", k: float = 1.5) -> dict:
    """Exact quartiles, IQR and the k*IQR fences of a column."""
    q1, q2, q3 = exact_percentiles_many(df, [column], [0.25, 0.5, 0.75])[column]
    if q1 is None:
        return {"q1": None, "median": None, "q3": None, "iqr": None, "lower": None, "upper": None}
    iqr = q3 - q1
    return {"q1": q1, "median": q2, "q3": q3, "iqr": iqr, "lower": q1 - k * iqr, "upper": q3 + k * iqr}


def iqr_outliers(df: DataFrame, column: str = "sensor_04", k: float = 1.5) -> DataFrame:
    """Fences and the count / percentage of rows outside them (EX9)."""
    f = iqr_fences(df.select(column), column, k)
    x = F.col(column)
    flag = (x < F.lit(f["lower"])) | (x > F.lit(f["upper"]))
    return df.agg(
        F.lit(f["q1"]).cast("double").alias("q1"), F.lit(f["q3"]).cast("double").alias("q3"),
        F.lit(f["iqr"]).cast("double").alias("iqr"), F.lit(f["lower"]).cast("double").alias("lower"),
        F.lit(f["upper"]).cast("double").alias("upper"),
        F.count_if(flag).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"),
        (F.lit(100.0) * F.count_if(flag) / F.count(F.lit(1))).alias("outlier_pct"))


def flag_outliers(df: DataFrame, column: str = "sensor_04", k: float = 1.5) -> DataFrame:
    """Rows with an ``is_outlier`` flag from the fences (a statistical flag only)."""
    f = iqr_fences(df, column, k)
    x = F.col(column)
    return df.withColumn("is_outlier", F.coalesce((x < F.lit(f["lower"])) | (x > F.lit(f["upper"])), F.lit(False)))


def boxplot_outliers(df: DataFrame, column: str = "sensor_04", k: float = 1.5, keys: list[str] | None = None) -> DataFrame:
    """The points that a box plot draws beyond its whiskers: keys, value, side."""
    f = iqr_fences(df.select(column), column, k)
    x = F.col(column)
    side = F.when(x < F.lit(f["lower"]), "low").when(x > F.lit(f["upper"]), "high")
    return df.select(*(keys or [ENGINE, CYCLE]), x, side.alias("side")).filter(F.col("side").isNotNull())


def boxplot_stats(df: DataFrame, column: str = "sensor_04", k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the most extreme values inside the fences, and
    the outlier counts below / above (EX10)."""
    f = iqr_fences(df.select(column), column, k)
    x = F.col(column)
    inside = (x >= F.lit(f["lower"])) & (x <= F.lit(f["upper"]))
    return df.agg(
        F.lit(f["q1"]).cast("double").alias("q1"), F.lit(f["median"]).cast("double").alias("median"),
        F.lit(f["q3"]).cast("double").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(x < F.lit(f["lower"])).alias("n_low_outliers"),
        F.count_if(x > F.lit(f["upper"])).alias("n_high_outliers"))


def findings(raw: DataFrame, features: DataFrame, sensor_cols=None, outlier_column: str = "sensor_04") -> DataFrame:
    """One-row findings record of a run (EX11)."""
    sensors = present(features, sensor_cols or FEATURE_SENSORS)
    used = dict.fromkeys([ENGINE, CYCLE, *sensors, outlier_column, *present(features, ["rul"])])
    return _findings(raw.sparkSession, raw, materialize(features.select(*used), "findings"), sensor_cols, outlier_column)


def _findings(spark, raw, features, sensor_cols, outlier_column):
    from assetlife.operators.quality import duplicate_count

    base = raw.agg(F.count(F.lit(1)).alias("n_rows_raw"), F.count_distinct(ENGINE).alias("n_engines"),
                   F.min(CYCLE).alias("cycle_min"), F.max(CYCLE).alias("cycle_max"),
                   sum((F.count_if(F.col(c).isNull()) for c in raw.columns), F.lit(0)).alias("missing_cells_raw")).first()
    life = engine_life(features)
    life_mean = life.agg(F.avg("max_cycle")).first()[0]
    life_median = exact_percentiles_many(life, ["max_cycle"], [0.5])["max_cycle"][0]
    dup = duplicate_count(raw).first()["duplicate_count"]
    out = iqr_outliers(features, outlier_column).first()["outlier_pct"]
    rec = {
        "n_rows_raw": base["n_rows_raw"], "n_engines": base["n_engines"],
        "cycle_min": base["cycle_min"], "cycle_max": base["cycle_max"],
        "mean_engine_life": life_mean, "median_engine_life": life_median,
        "duplicate_rows_raw": dup, "missing_cells_raw": base["missing_cells_raw"],
        "sensor_04_outlier_pct": out,
    }
    schema = ("n_rows_raw bigint, n_engines bigint, cycle_min bigint, cycle_max bigint, mean_engine_life double, "
              "median_engine_life double, duplicate_rows_raw bigint, missing_cells_raw bigint, "
              "sensor_04_outlier_pct double")
    if "rul" in features.columns:
        corr = rul_correlations(features, sensor_cols).filter(F.col("corr_with_rul").isNotNull())
        ext = corr.agg(F.min_by("sensor", "corr_with_rul").alias("neg"), F.min("corr_with_rul").alias("neg_v"),
                       F.max_by("sensor", "corr_with_rul").alias("pos"), F.max("corr_with_rul").alias("pos_v")).first()
        rec.update({"strongest_negative_corr_with_rul": ext["neg"], "strongest_negative_corr_value": ext["neg_v"],
                    "strongest_positive_corr_with_rul": ext["pos"], "strongest_positive_corr_value": ext["pos_v"]})
        schema += (", strongest_negative_corr_with_rul string, strongest_negative_corr_value double, "
                   "strongest_positive_corr_with_rul string, strongest_positive_corr_value double")
    return spark.createDataFrame([rec], schema)
