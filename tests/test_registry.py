"""Every registered query runs on the sf0.001 tables and, where it has a
DuckDB twin, agrees with it (the same check the driver runs at sf0.01)."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

ROWS_ONLY = {q for q in entry.queries() if re.match(r"op\d+_|pipeline$", q)}  # tested in tests/llm
ROWS_ONLY |= {"rf_large"}  # MLlib's random streams; held against the checked forest in tests/test_forest.py
FAST = ["zscore", "zscore_constant", "engine_sample", "delta", "rolling_std", "feature_build", "engine_summary", "sensor_analysis", "window_analysis",
        "quality_report", "clean_all", "order_check_physical", "describe", "corr_matrix", "grouped_split",
        "rul_targets", "parse_text", "coerce_numeric", "provenance", "attach_official_rul", "stream_ingest",
        "near_constant", "engine_cycle_range", "list_files", "feature_build_split", "order_check_split",
        "delta_repeated_cycles", "window_analysis_sql", "sort_by_engine_cycle", "gate_raises", "report_default_paths",
        "boxplot_outliers", "job_test_split", "fleet_features", "fleet_summary_sql", "fleet_analysis_sql", "fleet_window",
        "fleet_window_sql", "fleet_rollup", "fleet_split", "quality_report_schema", "forest_nodes", "rf_predict"]


def test_every_query_has_a_twin_or_is_rows_only():
    missing = set(entry.queries()) - set(entry.oracle_sql()) - ROWS_ONLY
    assert not missing, missing


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v.item() if hasattr(v, "item") else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "events", "supplier", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.collect(), df.columns) == _canon(cur.fetchall(), d_cols)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
