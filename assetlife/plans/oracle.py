"""DuckDB SQL twins of the registered queries (brute-force reference plans).

These are deliberately the plain, single-node formulations (whole-engine
windows, PERCENTILE_CONT) so that they check the segmented Spark plans
independently.  Computed doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from assetlife.config import FEATURE_SENSORS, RAW_COLUMNS
from assetlife.sources.adapters import adapter_sql

S7 = FEATURE_SENSORS


def r6(expr: str, name: str) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    return f"FLOOR({x} * 1e6 + 0.5 + LEAST(ABS({x}) * 1e-5, 0.01)) / 1e6 AS {name}"


def with_li(body: str, extra_ctes: str = "") -> str:
    ctes = f"li AS ({adapter_sql('li')})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


W = "PARTITION BY engine_id ORDER BY cycle"


def zstats_cte(src: str, sensors=S7) -> str:
    cols = ", ".join(f"AVG({s}) AS m_{s}, STDDEV_POP({s}) AS s_{s}" for s in sensors)
    return f"zs AS (SELECT {cols} FROM {src})"


def norm_expr(s: str) -> str:
    m, sd = f"(SELECT m_{s} FROM zs)", f"(SELECT s_{s} FROM zs)"
    return f"CASE WHEN {sd} IS NULL OR {sd} = 0 THEN 0.0 ELSE ({s} - {m}) / {sd} END"


def feature_cte(src: str = "li", window: int = 5, sensors=S7, rul: bool = True) -> str:
    """The feature table of ``src`` (raw schema) as plain window SQL."""
    cols = ["engine_id", "cycle", *sensors, "op_setting_1", "op_setting_2", "op_setting_3"]
    eng = []
    for s in sensors:
        eng += [
            f"{norm_expr(s)} AS {s}_norm",
            f"{s} - LAG({s}) OVER (PARTITION BY engine_id ORDER BY cycle) AS {s}_delta",
            f"AVG({s}) OVER (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {window - 1} PRECEDING "
            f"AND CURRENT ROW) AS {s}_rolling_mean",
            f"STDDEV_SAMP({s}) OVER (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {window - 1} PRECEDING "
            f"AND CURRENT ROW) AS {s}_rolling_std",
        ]
    eng.append("CAST(cycle AS DOUBLE) / NULLIF(MAX(cycle) OVER (PARTITION BY engine_id), 0) AS cycle_norm")
    if rul:
        eng.append("CAST(MAX(cycle) OVER (PARTITION BY engine_id) - cycle AS BIGINT) AS rul")
    body = ",\n    ".join([*cols, *eng])
    return f"""{zstats_cte(src, sensors)},
feat AS (
  SELECT {body}
  FROM {src}
)"""


def feature_columns_list(sensors=S7, rul: bool = True) -> list[str]:
    cols = ["engine_id", "cycle", *sensors, "op_setting_1", "op_setting_2", "op_setting_3"]
    for s in sensors:
        cols += [f"{s}_norm", f"{s}_delta", f"{s}_rolling_mean", f"{s}_rolling_std"]
    cols.append("cycle_norm")
    if rul:
        cols.append("rul")
    return cols


def select_rounded(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(r6(c, c) if c in doubles else c for c in cols)


def with_features(body: str) -> str:
    return with_li(body, feature_cte("li"))


RAW_DOUBLES = set(RAW_COLUMNS[2:])
__all__ = ["r6", "with_li", "with_features", "feature_cte", "feature_columns_list", "select_rounded", "W",
           "zstats_cte", "norm_expr", "RAW_DOUBLES", "S7"]


def report_metrics_sql(src: str, columns: list[str], bigint_cols: set[str], required: list[str]) -> str:
    """Flattened quality report (metric, value) of relation ``src`` in SQL."""
    doubles = [c for c in columns if c not in bigint_cols]
    missing_required = [c for c in required if c not in columns]
    rows = [
        "SELECT 'row_count' AS metric, COUNT(*)::BIGINT AS value FROM src",
        f"SELECT 'column_count', {len(columns)}::BIGINT",
        "SELECT 'duplicate_count', ((SELECT COUNT(*) FROM src) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM src) x))::BIGINT",
        "SELECT 'n_engines', COUNT(DISTINCT engine_id)::BIGINT FROM src",
        "SELECT 'cycle_min', MIN(cycle)::BIGINT FROM src",
        "SELECT 'cycle_max', MAX(cycle)::BIGINT FROM src",
    ]
    for c in columns:
        pred = f"{c} IS NULL" + (f" OR isnan({c})" if c in doubles else "")
        rows.append(f"SELECT 'missing:{c}', COUNT(*) FILTER (WHERE {pred})::BIGINT FROM src "
                    f"HAVING COUNT(*) FILTER (WHERE {pred}) > 0")
    inv = [(f"{c}_infinite", f"isinf({c})") for c in doubles] + [
        ("engine_id_non_positive", "engine_id <= 0"), ("cycle_non_positive", "cycle <= 0")]
    for k, pred in inv:
        rows.append(f"SELECT 'invalid:{k}', COUNT(*) FILTER (WHERE {pred})::BIGINT FROM src "
                    f"HAVING COUNT(*) FILTER (WHERE {pred}) > 0")
    inf_any = " OR ".join(f"isinf({c})" for c in doubles) or "FALSE"
    checks = {
        "required_columns_present": "1" if not missing_required else "0",
        "numeric_types_valid": "1",
        "engine_id_valid": "(SELECT (COUNT(*) FILTER (WHERE engine_id <= 0) = 0)::INT FROM src)",
        "cycle_positive": "(SELECT (COUNT(*) FILTER (WHERE cycle <= 0) = 0)::INT FROM src)",
        "no_infinite_values": f"(SELECT (COUNT(*) FILTER (WHERE {inf_any}) = 0)::INT FROM src)",
        "no_exact_duplicates": "(SELECT ((SELECT COUNT(*) FROM src) = (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM src) x))::INT)",
        "engine_cycle_ordering_valid": "(SELECT ((SELECT COUNT(*) FROM src) > 0 AND NOT EXISTS (SELECT 1 FROM src "
                                       "WHERE engine_id IS NOT NULL GROUP BY engine_id HAVING COUNT(*) > 1 AND "
                                       "COUNT(DISTINCT cycle) < COUNT(*)))::INT)",
        "has_rows": "(SELECT (COUNT(*) > 0)::INT FROM src)",
    }
    for k, v in checks.items():
        rows.append(f"SELECT 'check:{k}', ({v})::BIGINT")
    crit = [
        ("missing_columns:" + str(missing_required), "0" if not missing_required else "1"),
        ("empty_dataframe", "1 - (SELECT (COUNT(*) > 0)::INT FROM src)"),
        ("invalid_engine_id", "1 - " + checks["engine_id_valid"]),
        ("non_positive_cycle", "1 - " + checks["cycle_positive"]),
        ("infinite_values_present", "1 - " + checks["no_infinite_values"]),
    ]
    for text, cond in crit:
        esc = text.replace("'", "''")
        rows.append(f"SELECT 'critical:{esc}', 1::BIGINT WHERE ({cond}) = 1")
    return f"src AS ({src})", "\nUNION ALL\n".join(rows)
