"""Cleaning (CL1-CL9): exact duplicates, numeric coercion, +-inf -> NULL,
dropping incomplete rows (never zero-filling), near-constant sensors, id
restoration and the schema projection.

Only ``drop_near_constant_sensors`` needs an action: one aggregate row of
population variances decides which columns to drop.  The full clean writes its
de-duplicated rows before that, so they are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlife.config import CYCLE, ENGINE, RAW_COLUMNS, SENSOR_COLS, SETTING_COLS, VARIANCE_EPSILON
from assetlife.functions import inf_to_null, present, to_bigint_id, to_double
from assetlife.operators.quality import repeated_digests, split_by_digest
from assetlife.operators.sequence import LINE_COLUMNS, run_columns
from assetlife.session import materialize


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of rows equal on every column (CL1); NULL equals NULL.

    Digests of the rows are counted first; rows whose digest is theirs alone are
    never shuffled, the others are compared as a whole.  Where the frame carries
    line positions they are not compared, and the first line's are kept.
    """
    lines = [c for c in LINE_COLUMNS if c in df.columns]
    data = [c for c in df.columns if c not in lines]
    again, _ = repeated_digests(df, data)
    if again.isEmpty():
        return df
    alone, suspects = split_by_digest(df, data, again)
    if not lines:
        return alone.unionByName(suspects.dropDuplicates())
    first = suspects.groupBy(*data).agg(F.min(F.struct(*lines)).alias("_line"))
    return alone.unionByName(first.select(*[F.col("_line")[c].alias(c) if c in lines else F.col(c) for c in df.columns]))


def enforce_numeric_types(df: DataFrame, columns=None) -> DataFrame:
    """Coerce present schema columns to numbers; a bad token becomes NULL (CL2).

    Ids keep an integer type when they already have one; text ids go through
    DOUBLE.  Measurement columns become DOUBLE.
    """
    targets = set(present(df, columns or RAW_COLUMNS))
    cols = []
    for f in df.schema.fields:
        if f.name not in targets:
            cols.append(F.col(f.name))
        elif f.name in (ENGINE, CYCLE) and isinstance(f.dataType, (T.LongType, T.IntegerType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(to_double(df, f.name).alias(f.name))
    return df.select(*cols)


def replace_infinites_with_nan(df: DataFrame) -> DataFrame:
    """+-inf -> NULL in every floating column (CL3)."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[inf_to_null(c).alias(c) if c in floating else F.col(c) for c in df.columns])


def drop_rows_with_missing_core(df: DataFrame, columns=None) -> DataFrame:
    """Drop rows with a missing value in any present schema column (CL4)."""
    cols = present(df, columns or RAW_COLUMNS)
    return df.dropna(how="any", subset=cols) if cols else df


def sensor_variances(df: DataFrame, sensor_cols=SENSOR_COLS, groups: list[str] | None = None) -> DataFrame:
    """One row of population variances of the present sensors (one pass); with
    ``groups`` the largest among the runs."""
    sensors = present(df, sensor_cols)
    if not sensors:
        return None
    if groups:
        return df.groupBy(*groups).agg(*[F.var_pop(s).alias(s) for s in sensors]).agg(*[F.max(s).alias(s) for s in sensors])
    return df.agg(*[F.var_pop(s).alias(s) for s in sensors])


def near_constant_sensors(df: DataFrame, sensor_cols=SENSOR_COLS, variance_epsilon: float = VARIANCE_EPSILON,
                          groups: list[str] | None = None) -> list[str]:
    """Sensors whose population variance is <= epsilon (in every run, with
    ``groups``); an undefined variance (no values) keeps the column."""
    variances = sensor_variances(df, sensor_cols, groups)
    if variances is None:
        return []
    row = variances.first()
    return [s for s in variances.columns if row[s] is not None and row[s] <= variance_epsilon]


def drop_near_constant_sensors(df: DataFrame, sensor_cols=SENSOR_COLS,
                               variance_epsilon: float = VARIANCE_EPSILON, groups: list[str] | None = None) -> DataFrame:
    """Drop near-constant sensor columns (CL5)."""
    dropped = near_constant_sensors(df, sensor_cols, variance_epsilon, groups)
    return df.drop(*dropped) if dropped else df


def sort_by_engine_cycle(df: DataFrame) -> DataFrame:
    """Order by engine then cycle, missing last (CL6); use only at output."""
    return df.orderBy(F.col(ENGINE).asc_nulls_last(), F.col(CYCLE).asc_nulls_last())


def restore_integer_ids(df: DataFrame) -> DataFrame:
    """engine_id / cycle back to BIGINT, truncating fractions (CL7)."""
    return df.withColumns({c: to_bigint_id(df, c) for c in (ENGINE, CYCLE) if c in df.columns})


def project_to_schema(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """ids, present settings, present sensors (CL8)."""
    return df.select(*(extra or []), ENGINE, CYCLE, *present(df, SETTING_COLS), *present(df, SENSOR_COLS))


def _valid(df: DataFrame, name: str):
    """True when the value survives CL2 + CL3 + CL4: a finite number."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        x = F.col(name)
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    if isinstance(dtype, T.NumericType):
        return F.col(name).isNotNull()
    coerced = to_double(df, name)
    return coerced.isNotNull() & (F.abs(coerced) != F.lit(float("inf")))


def clean_sensor_data(df: DataFrame, drop_constant_sensors: bool = True, key_cols=None,
                      sort: bool = False, distinct: bool = False) -> DataFrame:
    """CL1 -> CL2 -> CL3 -> CL4 -> (CL5) -> CL7 -> CL8 (-> CL6 when ``sort``).

    Same rows and values as applying the steps one by one, but planned as
    "dedupe, keep rows whose schema columns are all finite numbers, then
    coerce": numeric columns pass through unchanged, so no per-column CASE
    rewrite sits under the NOT NULL filter.  (That pattern makes Catalyst's
    constraint propagation explode once windows and joins are stacked on
    top.)  Sorting is optional: windows order rows themselves.  Line
    positions, where the frame carries them, are kept.  ``distinct`` says that
    the frame's copies have been counted and there are none (CL1 has nothing
    to drop).
    """
    extra = run_columns(key_cols) + [c for c in LINE_COLUMNS if c in df.columns]
    out = df if distinct else drop_exact_duplicates(df)
    core = [c for c in RAW_COLUMNS if c in out.columns]
    if core:
        cond = _valid(out, core[0])
        for c in core[1:]:
            cond = cond & _valid(out, c)
        out = out.filter(cond)
    # every schema value is now a finite number: numeric columns only change type
    out = out.select(*[
        (F.col(f.name).cast("bigint") if f.name in (ENGINE, CYCLE) and isinstance(f.dataType, T.IntegralType)
         else F.col(f.name).cast("double") if isinstance(f.dataType, T.NumericType)
         else to_double(out, f.name)).alias(f.name) if f.name in core else F.col(f.name)
        for f in out.schema.fields])
    if drop_constant_sensors:
        out = drop_near_constant_sensors(materialize(out, "clean"), groups=run_columns(key_cols))
    out = restore_integer_ids(out)
    out = project_to_schema(out, extra)
    return sort_by_engine_cycle(out) if sort else out
