"""Registered queries: one Spark callable per operator, each with a DuckDB
twin in ``ORACLE`` when the operator is expressible in SQL.

Every query reads the driver tables of ``sf_dir`` (through the adapters) and
runs over whole tables.  Doubles are rounded to 6 digits on output so that
the summation order of two engines cannot change a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlife.config import FEATURE_SENSORS as S7
from assetlife.operators import lifecycle as fe
from assetlife.operators import sequence as tx
from assetlife.plans import marts
from assetlife.session import materialize
from assetlife.plans.oracle import (
    feature_columns_list,
    feature_cte,
    r6,
    select_rounded,
    with_features,
    with_li,
    zstats_cte,
    norm_expr,
)
from assetlife.sources.adapters import adapter_sql, event_trajectories, lineitem_trajectories

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round_to(c, digits: int):
    """floor(x * 10^d + 0.5 + |x| * 10^(d-11)) / 10^d in plain IEEE steps, the
    same formula as the SQL twins.  The relative nudge (1e-11) makes values
    that are exact decimal ties (e.g. a mean of 25.4521685) round the same way
    in both engines despite last-bit summation differences."""
    scale = float(10 ** digits)
    nudge = F.least(F.abs(c) * F.lit(scale * 1e-11), F.lit(0.01))
    return F.floor(c * F.lit(scale) + F.lit(0.5) + nudge).cast("double") / F.lit(scale)


def round6(c):
    return round_to(c, 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column to ``digits`` decimals."""
    return df.select(*[
        round_to(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_trajectories(spark, sf_dir)


def li_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.engineer_features(li(spark, sf_dir))


_ID = ["engine_id", "cycle"]


# ---------------------------------------------------------------- sequence (TX)
@register("zscore", with_li(
    f"SELECT engine_id, cycle, {', '.join(r6(norm_expr(s), s + '_norm') for s in S7)} FROM li",
    zstats_cte("li")))
def q_zscore(spark, sf_dir):
    out = tx.normalize_sensors(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_norm" for s in S7]))


_CONST = ["sensor_01", "sensor_05", "sensor_06"]


@register("zscore_constant", with_li(
    f"SELECT engine_id, cycle, {', '.join(r6(norm_expr(s), s + '_norm') for s in _CONST)} FROM li",
    zstats_cte("li", _CONST)))
def q_zscore_constant(spark, sf_dir):
    out = tx.normalize_sensors(li(spark, sf_dir), sensor_cols=_CONST)
    return rounded(out.select(*_ID, *[f"{s}_norm" for s in _CONST]))


def _lag_sql(kind: str) -> str:
    parts = []
    for s in S7:
        lag = f"LAG({s}) OVER (PARTITION BY engine_id ORDER BY cycle)"
        if kind == "prev":
            parts.append(r6(lag, f"{s}_prev"))
        elif kind == "delta":
            parts.append(r6(f"{s} - {lag}", f"{s}_delta"))
        elif kind == "roc":
            gap = "(cycle - LAG(cycle) OVER (PARTITION BY engine_id ORDER BY cycle))"
            parts.append(r6(f"({s} - {lag}) / NULLIF(CAST({gap} AS DOUBLE), 0)", f"{s}_roc"))
    return with_li(f"SELECT engine_id, cycle, {', '.join(parts)} FROM li")


@register("prev_reading", _lag_sql("prev"))
def q_prev(spark, sf_dir):
    out = tx.add_previous_reading(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_prev" for s in S7]))


@register("delta", _lag_sql("delta"))
def q_delta(spark, sf_dir):
    out = tx.add_sensor_delta(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_delta" for s in S7]))


@register("rate_of_change", _lag_sql("roc"))
def q_roc(spark, sf_dir):
    out = tx.add_rate_of_change(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_roc" for s in S7]))


def _rolling_sql(stat: str, window: int = 5) -> str:
    fn = "AVG" if stat == "mean" else "STDDEV_SAMP"
    parts = [r6(f"{fn}({s}) OVER (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {window - 1} PRECEDING "
                f"AND CURRENT ROW)", f"{s}_rolling_{stat}") for s in S7]
    return with_li(f"SELECT engine_id, cycle, {', '.join(parts)} FROM li")


@register("rolling_mean", _rolling_sql("mean"))
def q_rolling_mean(spark, sf_dir):
    out = tx.add_rolling_stats(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_rolling_mean" for s in S7]))


@register("rolling_std", _rolling_sql("std"))
def q_rolling_std(spark, sf_dir):
    out = tx.add_rolling_stats(li(spark, sf_dir))
    return rounded(out.select(*_ID, *[f"{s}_rolling_std" for s in S7]))


_SUITE = [c for s in S7 for c in (f"{s}_norm", f"{s}_delta", f"{s}_rolling_mean", f"{s}_rolling_std")]


@register("transform_suite", with_li(
    f"SELECT engine_id, cycle, {select_rounded(_SUITE, set(_SUITE))} FROM feat", feature_cte("li")))
def q_suite(spark, sf_dir):
    out = tx.apply_transformations(li(spark, sf_dir))
    return rounded(out.select(*_ID, *_SUITE))


# --------------------------------------------------------------- lifecycle (FE)
@register("cycle_norm", with_li(
    "SELECT engine_id, cycle, " + r6("CAST(cycle AS DOUBLE) / NULLIF(MAX(cycle) OVER (PARTITION BY engine_id), 0)",
                                     "cycle_norm") + " FROM li"))
def q_cycle_norm(spark, sf_dir):
    return rounded(fe.add_normalized_cycle(li(spark, sf_dir)).select(*_ID, "cycle_norm"))


@register("rul_label", with_li(
    "SELECT engine_id, cycle, CAST(MAX(cycle) OVER (PARTITION BY engine_id) - cycle AS BIGINT) AS rul FROM li"))
def q_rul(spark, sf_dir):
    return fe.add_remaining_useful_life(li(spark, sf_dir)).select(*_ID, "rul")


_FEAT = feature_columns_list()
_FEAT_DOUBLES = {c for c in _FEAT if c not in ("engine_id", "cycle", "rul")}


@register("feature_build", with_features(f"SELECT {select_rounded(_FEAT, _FEAT_DOUBLES)} FROM feat"))
def q_features(spark, sf_dir):
    return rounded(li_features(spark, sf_dir))


@register("feature_build_events", with_li(
    "SELECT " + select_rounded(_FEAT, _FEAT_DOUBLES) + " FROM feat",
    "ev AS (" + adapter_sql("ev") + "),\n"
    + feature_cte("ev")))
def q_features_events(spark, sf_dir):
    return rounded(fe.engineer_features(event_trajectories(spark, sf_dir)))


# ------------------------------------------------------------------ marts (SQ)
@register("engine_lifecycle", with_features(
    "SELECT engine_id, MIN(cycle) AS first_cycle, MAX(cycle) AS last_cycle, COUNT(*) AS n_cycles, "
    "MAX(rul) AS max_rul, MIN(rul) AS min_rul FROM feat GROUP BY engine_id"))
def q_lifecycle(spark, sf_dir):
    return marts.engine_lifecycle(li_features(spark, sf_dir))


_ENRICHED = [*_FEAT, "engine_total_cycles", "engine_last_cycle"]


@register("features_enriched", with_features(
    f"SELECT {select_rounded(_ENRICHED, _FEAT_DOUBLES)} FROM feat f JOIN (SELECT engine_id AS e_id, "
    "COUNT(*) AS engine_total_cycles, MAX(cycle) AS engine_last_cycle FROM feat GROUP BY engine_id) e "
    "ON f.engine_id = e.e_id"))
def q_enriched(spark, sf_dir):
    return rounded(marts.sensor_features_enriched(li_features(spark, sf_dir)).select(*_ENRICHED))


_SUMMARY_SQL = """SELECT engine_id, COUNT(*) AS n_cycles, MIN(cycle) AS first_cycle, MAX(cycle) AS last_cycle,
  {a02}, MIN(sensor_02) AS min_sensor_02, MAX(sensor_02) AS max_sensor_02,
  {a04}, MIN(sensor_04) AS min_sensor_04, MAX(sensor_04) AS max_sensor_04,
  {a11}, {arul}, MIN(rul) AS min_rul, MAX(rul) AS max_rul
FROM feat GROUP BY engine_id""".format(
    a02=r6("AVG(sensor_02)", "avg_sensor_02"), a04=r6("AVG(sensor_04)", "avg_sensor_04"),
    a11=r6("AVG(sensor_11)", "avg_sensor_11"), arul=r6("AVG(rul)", "avg_rul"))


@register("engine_summary", with_features(_SUMMARY_SQL))
def q_engine_summary(spark, sf_dir):
    return rounded(marts.engine_summary(li_features(spark, sf_dir)))


@register("engine_summary_sql", with_features(_SUMMARY_SQL))
def q_engine_summary_sql(spark, sf_dir):
    feats = li_features(spark, sf_dir)
    marts.register_views(spark, feats)
    return rounded(marts.run_sql_file(spark, "engine_summary.sql"))


_ANALYSIS_SQL = """SELECT m.engine_id, l.n_cycles, l.last_cycle, {m02}, {m04}, {m11}, {m15}, {mstd}, {mrul},
  CASE WHEN l.n_cycles >= (SELECT PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY n_cycles) FROM life) THEN 'long_life'
       WHEN l.n_cycles <= (SELECT PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY n_cycles) FROM life) THEN 'short_life'
       ELSE 'typical_life' END AS life_band
FROM (SELECT engine_id, AVG(sensor_02) a02, AVG(sensor_04) a04, AVG(sensor_11) a11, AVG(sensor_15) a15,
             AVG(sensor_04_rolling_std) astd, AVG(rul) arul FROM feat GROUP BY engine_id) m
JOIN life l ON m.engine_id = l.engine_id""".format(
    m02=r6("m.a02", "mean_sensor_02"), m04=r6("m.a04", "mean_sensor_04"), m11=r6("m.a11", "mean_sensor_11"),
    m15=r6("m.a15", "mean_sensor_15"), mstd=r6("m.astd", "mean_sensor_04_rolling_std"), mrul=r6("m.arul", "mean_rul"))
_LIFE_CTE = "life AS (SELECT engine_id, MAX(cycle) AS last_cycle, COUNT(*) AS n_cycles FROM feat GROUP BY engine_id)"


@register("sensor_analysis", with_li(_ANALYSIS_SQL, feature_cte("li") + ",\n" + _LIFE_CTE))
def q_sensor_analysis(spark, sf_dir):
    return rounded(marts.sensor_analysis(li_features(spark, sf_dir)))


@register("sensor_analysis_sql", with_li(_ANALYSIS_SQL, feature_cte("li") + ",\n" + _LIFE_CTE))
def q_sensor_analysis_sql(spark, sf_dir):
    feats = li_features(spark, sf_dir)
    marts.register_views(spark, feats)
    return rounded(marts.run_sql_file(spark, "sensor_analysis.sql"))


_WA_SQL = """SELECT engine_id, cycle, sensor_04, rul,
  CAST(ROW_NUMBER() OVER (PARTITION BY engine_id ORDER BY cycle) AS BIGINT) AS cycle_row_number,
  {lag}, {lead}, {dlt}, {rm}, {rs}
FROM feat ORDER BY engine_id, cycle LIMIT 5000""".format(
    lag=r6("LAG(sensor_04, 1) OVER (PARTITION BY engine_id ORDER BY cycle)", "sensor_04_lag"),
    lead=r6("LEAD(sensor_04, 1) OVER (PARTITION BY engine_id ORDER BY cycle)", "sensor_04_lead"),
    dlt=r6("sensor_04 - LAG(sensor_04, 1) OVER (PARTITION BY engine_id ORDER BY cycle)", "sensor_04_sql_delta"),
    rm=r6("AVG(sensor_04) OVER (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
          "sensor_04_sql_rolling_mean"),
    rs=r6("STDDEV_SAMP(sensor_04) OVER (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN 4 PRECEDING AND "
          "CURRENT ROW)", "sensor_04_sql_rolling_std"))


@register("window_analysis", with_features(_WA_SQL))
def q_window_analysis(spark, sf_dir):
    """The top-N form (the feature of SQ14)."""
    return rounded(marts.window_analysis(li_features(spark, sf_dir), limit=5000))


@register("window_analysis_full", with_features(_WA_SQL.replace(" LIMIT 5000", "")))
def q_window_analysis_full(spark, sf_dir):
    return rounded(marts.window_analysis(li_features(spark, sf_dir)))


@register("window_analysis_sql", with_features(_WA_SQL.replace(" LIMIT 5000", "")))
def q_window_analysis_sql(spark, sf_dir):
    marts.register_views(spark, li_features(spark, sf_dir))
    return rounded(marts.run_sql_file(spark, "window_analysis.sql"))


@register("window_analysis_sql_top", with_features(_WA_SQL))
def q_window_analysis_sql_top(spark, sf_dir):
    """The SQL file with the limit as its parameter."""
    marts.register_views(spark, li_features(spark, sf_dir))
    return rounded(marts.run_sql_file(spark, "window_analysis.sql", limit=5000))


# ------------------------------------------------ keys too large for one task
SMALL = 100  # rows: far under any engine here, so every engine is split


@register("feature_build_split", with_features(f"SELECT {select_rounded(_FEAT, _FEAT_DOUBLES)} FROM feat"))
def q_features_split(spark, sf_dir):
    """Features where every engine is numbered and windowed by several tasks."""
    rows = lineitem_trajectories(spark, sf_dir, max_rows=SMALL)
    return rounded(fe.engineer_features(rows, max_rows=SMALL))


@register("feature_build_events_split", with_li(
    "SELECT " + select_rounded(_FEAT, _FEAT_DOUBLES) + " FROM feat",
    "ev AS (" + adapter_sql("ev") + "),\n"
    + feature_cte("ev")))
def q_features_events_split(spark, sf_dir):
    rows = event_trajectories(spark, sf_dir, max_rows=20)
    return rounded(fe.engineer_features(rows, max_rows=20))


@register("window_analysis_split", with_features(_WA_SQL.replace(" LIMIT 5000", "")))
def q_window_analysis_split(spark, sf_dir):
    return rounded(marts.window_analysis(li_features(spark, sf_dir), max_rows=SMALL))


# ------------------------------------------- several runs in one table (fleet)
from assetlife.config import FLEET_KEYS  # noqa: E402
from assetlife.sources.adapters import fleet_trajectories  # noqa: E402

_FLEET = list(FLEET_KEYS)
_OF_RUN = "variant, split, engine_id"


def fleet_features(spark, sf_dir):
    return fe.engineer_features(fleet_trajectories(spark, sf_dir), key_cols=_FLEET)


def _fleet_cte() -> str:
    """Each run's feature table by itself, then all of them."""
    runs = [("FD001", "train"), ("FD002", "train"), ("FD002", "test")]
    ctes, union = [f"fleet AS ({adapter_sql('fleet')})"], []
    for i, (variant, split) in enumerate(runs):
        ctes.append(f"run{i} AS (SELECT * FROM fleet WHERE variant = '{variant}' AND split = '{split}')")
        ctes.append(feature_cte(f"run{i}").replace("feat AS (", f"feat{i} AS (").replace("zs AS (", f"zs{i} AS (").replace("FROM zs)", f"FROM zs{i})"))
        union.append(f"SELECT '{variant}' AS variant, '{split}' AS split, * FROM feat{i}")
    return ",\n".join([*ctes, "feat AS (" + " UNION ALL ".join(union) + ")"])


def with_fleet(body: str, extra: str = "") -> str:
    return f"WITH {_fleet_cte()}" + (",\n" + extra if extra else "") + "\n" + body


def _by_run(sql: str) -> str:
    """A twin of one run with the key of several."""
    return (sql.replace("SELECT engine_id", f"SELECT {_OF_RUN}").replace("PARTITION BY engine_id", f"PARTITION BY {_OF_RUN}")
            .replace("GROUP BY engine_id", f"GROUP BY {_OF_RUN}"))


@register("fleet_features", with_fleet(f"SELECT variant, split, {select_rounded(_FEAT, _FEAT_DOUBLES)} FROM feat"))
def q_fleet_features(spark, sf_dir):
    """Feature build of three runs at once: each is normalised by itself."""
    return rounded(fleet_features(spark, sf_dir))


@register("fleet_lifecycle", with_fleet(_by_run(
    "SELECT engine_id, MIN(cycle) AS first_cycle, MAX(cycle) AS last_cycle, COUNT(*) AS n_cycles, "
    "MAX(rul) AS max_rul, MIN(rul) AS min_rul FROM feat GROUP BY engine_id")))
def q_fleet_lifecycle(spark, sf_dir):
    return marts.engine_lifecycle(fleet_features(spark, sf_dir), _FLEET)


@register("fleet_enriched", with_fleet(
    f"SELECT variant, split, {select_rounded(_ENRICHED, _FEAT_DOUBLES)} FROM (SELECT *, "
    f"COUNT(*) OVER (PARTITION BY {_OF_RUN}) AS engine_total_cycles, MAX(cycle) OVER (PARTITION BY {_OF_RUN}) AS engine_last_cycle "
    "FROM feat) f"))
def q_fleet_enriched(spark, sf_dir):
    return rounded(marts.sensor_features_enriched(fleet_features(spark, sf_dir), _FLEET).select("variant", "split", *_ENRICHED))


_FLEET_SUMMARY = _by_run(_SUMMARY_SQL)
for _s in ("sensor_02", "sensor_04"):  # sums of two decimals here, so extremes are rounded too
    for _f in ("MIN", "MAX"):
        _FLEET_SUMMARY = _FLEET_SUMMARY.replace(f"{_f}({_s}) AS {_f.lower()}_{_s}", r6(f"{_f}({_s})", f"{_f.lower()}_{_s}"))


@register("fleet_summary", with_fleet(_FLEET_SUMMARY))
def q_fleet_summary(spark, sf_dir):
    return rounded(marts.engine_summary(fleet_features(spark, sf_dir), _FLEET))


@register("fleet_summary_sql", with_fleet(_FLEET_SUMMARY))
def q_fleet_summary_sql(spark, sf_dir):
    marts.register_views(spark, fleet_features(spark, sf_dir), "fleet_table", _FLEET)
    return rounded(marts.run_sql_file(spark, "engine_summary.sql", "fleet_table", _FLEET))


_FLEET_LIFE = f"life AS (SELECT {_OF_RUN}, MAX(cycle) AS last_cycle, COUNT(*) AS n_cycles FROM feat GROUP BY {_OF_RUN})"
_FLEET_ANALYSIS_SQL = """SELECT l.variant, l.split, l.engine_id, l.n_cycles, l.last_cycle, {m02}, {m04}, {m11}, {m15}, {mstd}, {mrul},
  CASE WHEN l.n_cycles >= q.p75 THEN 'long_life' WHEN l.n_cycles <= q.p25 THEN 'short_life' ELSE 'typical_life' END AS life_band
FROM (SELECT variant, split, engine_id, AVG(sensor_02) a02, AVG(sensor_04) a04, AVG(sensor_11) a11, AVG(sensor_15) a15,
             AVG(sensor_04_rolling_std) astd, AVG(rul) arul FROM feat GROUP BY ALL) m
JOIN life l USING (variant, split, engine_id)
JOIN (SELECT variant, split, QUANTILE_CONT(n_cycles, 0.25) AS p25, QUANTILE_CONT(n_cycles, 0.75) AS p75 FROM life GROUP BY ALL) q
  USING (variant, split)""".format(
    m02=r6("m.a02", "mean_sensor_02"), m04=r6("m.a04", "mean_sensor_04"), m11=r6("m.a11", "mean_sensor_11"),
    m15=r6("m.a15", "mean_sensor_15"), mstd=r6("m.astd", "mean_sensor_04_rolling_std"), mrul=r6("m.arul", "mean_rul"))


@register("fleet_analysis", with_fleet(_FLEET_ANALYSIS_SQL, _FLEET_LIFE))
def q_fleet_analysis(spark, sf_dir):
    """Life bands within each run."""
    return rounded(marts.sensor_analysis(fleet_features(spark, sf_dir), _FLEET))


@register("fleet_analysis_sql", with_fleet(_FLEET_ANALYSIS_SQL, _FLEET_LIFE))
def q_fleet_analysis_sql(spark, sf_dir):
    marts.register_views(spark, fleet_features(spark, sf_dir), "fleet_table", _FLEET)
    return rounded(marts.run_sql_file(spark, "sensor_analysis.sql", "fleet_table", _FLEET))


_FLEET_WA = (_by_run(_WA_SQL).replace("ORDER BY engine_id, cycle", f"ORDER BY {_OF_RUN}, cycle")
             .replace("cycle, sensor_04, rul,", f"cycle, {r6('sensor_04', 'sensor_04')}, rul,", 1))


@register("fleet_window", with_fleet(_FLEET_WA.replace("LIMIT 5000", "LIMIT 700")))
def q_fleet_window(spark, sf_dir):
    """The first 700 rows in key order (top-N): only their engines are windowed."""
    return rounded(marts.window_analysis(fleet_features(spark, sf_dir), limit=700, key_cols=_FLEET))


@register("fleet_window_sql", with_fleet(_FLEET_WA.replace(" LIMIT 5000", "")))
def q_fleet_window_sql(spark, sf_dir):
    marts.register_views(spark, fleet_features(spark, sf_dir), "fleet_table", _FLEET)
    return rounded(marts.run_sql_file(spark, "window_analysis.sql", "fleet_table", _FLEET))


@register("fleet_rollup", with_fleet(
    "SELECT variant, split, CAST(2 - GROUPING(variant) - GROUPING(split) AS INT) AS level, COUNT(*) AS n_engines, "
    "CAST(SUM(n) AS BIGINT) AS n_rows, MIN(f) AS first_cycle, MAX(l) AS last_cycle, " + r6("AVG(n)", "mean_cycles") + ", "
    + ", ".join(r6(f"SUM(s_{c}) / SUM(n_{c})", f"avg_{c}") for c in ("sensor_02", "sensor_04", "sensor_11", "rul"))
    + " FROM per GROUP BY GROUPING SETS ((variant, split), (variant), ())",
    f"per AS (SELECT {_OF_RUN}, COUNT(*) AS n, MIN(cycle) AS f, MAX(cycle) AS l, "
    + ", ".join(f"CAST(SUM({c}) AS DOUBLE) AS s_{c}, COUNT({c}) AS n_{c}" for c in ("sensor_02", "sensor_04", "sensor_11", "rul"))
    + f" FROM feat GROUP BY {_OF_RUN})"))
def q_fleet_rollup(spark, sf_dir):
    """Totals of every run, every variant and of all (GROUPING SETS)."""
    return rounded(marts.fleet_rollup(fleet_features(spark, sf_dir)))


# ----------------------------------------------------- output order, as ranks
def _ranked(df):
    """The rows with their position in the frame's order."""
    return df.withColumn("position", F.monotonically_increasing_id())


def _positions(df: DataFrame) -> DataFrame:
    """Positions made dense: rows before it in earlier partitions, plus its place."""
    tagged = df.withColumn("_task", F.shiftright("position", 33)).withColumn("_place", F.col("position").bitwiseAND(F.lit((1 << 33) - 1)))
    tagged = materialize(tagged, "positions")
    sizes = tagged.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_task", F.coalesce(F.sum("_size").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return tagged.join(before, "_task").withColumn("position", F.col("_before") + F.col("_place") + 1).drop("_task", "_place", "_before")


@register("sort_observations", with_li(
    "SELECT engine_id, cycle, CAST(row_number() OVER (ORDER BY engine_id, cycle) AS BIGINT) AS position FROM li"))
def q_sort_observations(spark, sf_dir):
    out = tx.sort_observations(li(spark, sf_dir).select(*_ID))
    return _positions(_ranked(out))


@register("sensor_analysis_order", with_li(
    "SELECT engine_id, CAST(row_number() OVER (ORDER BY n_cycles DESC, engine_id) AS BIGINT) AS position FROM life",
    feature_cte("li") + ",\n" + _LIFE_CTE))
def q_sensor_analysis_order(spark, sf_dir):
    return _positions(_ranked(marts.sensor_analysis(li_features(spark, sf_dir)).select("engine_id")))


# ------------------------------------------------------------- quality (DQ)
from assetlife.config import RAW_COLUMNS  # noqa: E402
from assetlife.operators import cleaning as cl  # noqa: E402
from assetlife.operators import quality as dq  # noqa: E402
from assetlife.plans.oracle import report_metrics_sql  # noqa: E402
from assetlife.session import scratch_path  # noqa: E402
from assetlife.sources.adapters import (  # noqa: E402
    dirty_trajectories,
    token_expected_sql,
    token_trajectories,
)

_RAW_D = [c for c in RAW_COLUMNS[2:]]


def dirty(spark, sf_dir, keep_line=False):
    return dirty_trajectories(spark, sf_dir, keep_line=keep_line)


def _with_dirty(body: str, extra: str = "") -> str:
    ctes = f"d AS ({adapter_sql('dirty')})" + (",\n" + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def _missing_sql(src: str, columns: list[str], doubles: set[str]) -> str:
    parts = []
    for c in columns:
        pred = f"{c} IS NULL" + (f" OR isnan({c})" if c in doubles else "")
        parts.append(f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {pred})::BIGINT AS missing_count FROM {src}")
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") m WHERE missing_count > 0"


@register("missing_counts", _with_dirty(_missing_sql("d", list(RAW_COLUMNS), set(_RAW_D))))
def q_missing(spark, sf_dir):
    return dq.missing_counts(dirty(spark, sf_dir))


def _invalid_sql(src: str, doubles: list[str]) -> str:
    inv = [(f"{c}_infinite", f"isinf({c})") for c in doubles] + [
        ("engine_id_non_positive", "engine_id <= 0"), ("cycle_non_positive", "cycle <= 0")]
    parts = [f"SELECT '{k}' AS key, COUNT(*) FILTER (WHERE {p})::BIGINT AS invalid_count FROM {src}" for k, p in inv]
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") m WHERE invalid_count > 0"


@register("invalid_counts", _with_dirty(_invalid_sql("d", _RAW_D)))
def q_invalid(spark, sf_dir):
    return dq.invalid_counts(dirty(spark, sf_dir))


@register("duplicate_count", _with_dirty(
    "SELECT COUNT(*)::BIGINT AS row_count, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d) x)::BIGINT AS "
    "distinct_count, (COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d) x))::BIGINT AS duplicate_count "
    "FROM d"))
def q_duplicates(spark, sf_dir):
    return dq.duplicate_count(dirty(spark, sf_dir))


@register("engine_cycle_range", _with_dirty(
    "SELECT COUNT(DISTINCT engine_id)::BIGINT AS n_engines, MIN(cycle) AS cycle_min, MAX(cycle) AS cycle_max FROM d"))
def q_cycle_range(spark, sf_dir):
    df = dirty(spark, sf_dir)
    per_engine = dq.engine_order_sorted(df)
    return df.agg(F.min("cycle").alias("cycle_min"), F.max("cycle").alias("cycle_max")).select(
        per_engine.agg(F.count(F.lit(1))).scalar().alias("n_engines"), "cycle_min", "cycle_max")


@register("order_check_sorted", _with_dirty(
    "SELECT engine_id, COUNT(*)::BIGINT AS n_rows, NOT (COUNT(*) > 1 AND COUNT(DISTINCT cycle) < COUNT(*)) AS ordered "
    "FROM d WHERE engine_id IS NOT NULL GROUP BY engine_id"))
def q_order_sorted(spark, sf_dir):
    return dq.engine_order_sorted(dirty(spark, sf_dir))


@register("order_check_physical",
          f"WITH d AS ({adapter_sql('dirty_line')})\n"
          "SELECT engine_id, COUNT(*) FILTER (WHERE rn > 1 AND NOT coalesce(cycle > prev, FALSE)) = 0 AS ordered "
          "FROM (SELECT engine_id, cycle, ROW_NUMBER() OVER (PARTITION BY engine_id ORDER BY _line) AS rn, "
          "LAG(cycle) OVER (PARTITION BY engine_id ORDER BY _line) AS prev FROM d WHERE engine_id IS NOT NULL) x "
          "GROUP BY engine_id")
def q_order_physical(spark, sf_dir):
    return dq.engine_order_physical(dirty(spark, sf_dir, keep_line=True), ["_line"])


@register("order_check_split", ORACLE["order_check_physical"])
def q_order_split(spark, sf_dir):
    return dq.engine_order_physical(dirty(spark, sf_dir, keep_line=True), ["_line"], max_rows=20)


@register("order_check_scanned", ORACLE["order_check_physical"])
def q_order_scanned(spark, sf_dir):
    """The same check over text files, from one small state per engine and file split."""
    rows = dirty(spark, sf_dir, keep_line=True)
    raw = scratch_path(spark, "lines")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in RAW_COLUMNS]
    rows.repartitionByRange(6, "_line").sortWithinPartitions("_line").select(F.concat_ws(" ", *fields).alias("value")).write.text(raw)
    lines = src.parse_trajectory_lines(src.read_lines(spark, raw), keep=["_file", "_block", "_row"])
    return dq.engine_order_scanned(lines)


_TIE_W = "OVER (PARTITION BY engine_id ORDER BY cycle, _line)"


@register("delta_repeated_cycles",
          f"WITH d AS ({adapter_sql('dirty_line')})\n"
          f"SELECT engine_id, cycle, _line, {r6(f'sensor_04 - LAG(sensor_04) {_TIE_W}', 'sensor_04_delta')}, "
          f"{r6(f'AVG(sensor_04) OVER (PARTITION BY engine_id ORDER BY cycle, _line ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)', 'sensor_04_rolling_mean')} FROM d")
def q_delta_ties(spark, sf_dir):
    """Rows that repeat (engine, cycle) follow each other in line order."""
    rows = dirty(spark, sf_dir, keep_line=True)
    delta = tx.add_sensor_delta(rows, ["sensor_04"], tiebreak=["_line"])
    out = tx.add_rolling_stats(delta, ["sensor_04"], tiebreak=["_line"], max_rows=20)
    return rounded(out.select(*_ID, "_line", "sensor_04_delta", "sensor_04_rolling_mean"))


@register("gate_raises", f"""WITH d AS ({adapter_sql('dirty')})
SELECT 'raw' AS stage, failure, CAST(row_number() OVER (ORDER BY place) AS BIGINT) AS place FROM (
  SELECT 'invalid_engine_id' AS failure, 1 AS place, COUNT(*) FILTER (WHERE engine_id <= 0) AS n FROM d
  UNION ALL SELECT 'non_positive_cycle', 2, COUNT(*) FILTER (WHERE cycle <= 0) FROM d
  UNION ALL SELECT 'infinite_values_present', 3, COUNT(*) FILTER (WHERE isinf(sensor_03)) FROM d) x
WHERE n > 0""")
def q_gate_raises(spark, sf_dir):
    """DQ13: the failures that the gate names when it raises."""
    try:
        dq.run_quality_checks(dirty(spark, sf_dir), stage="raw", save_path=scratch_path(spark, "report") + "/r.json", fail_on_critical=True)
        failures = []
    except dq.DataQualityError as error:
        failures = str(error).split(": ", 1)[1].split("; ")
    rows = [("raw", f, i) for i, f in enumerate(failures, 1)]
    return spark.createDataFrame(rows, "stage string, failure string, place bigint")


@register("report_default_paths", f"""WITH d AS ({adapter_sql('dirty')})
SELECT * FROM (VALUES ('data_quality_report_raw.json', (SELECT COUNT(*) FROM d)),
                      ('data_quality_report.json', (SELECT COUNT(*) FROM d))) v(file, row_count)""")
def q_report_default_paths(spark, sf_dir):
    """DQ14: reports of the stages raw and final are saved without being told where."""
    out, rows = scratch_path(spark, "outputs"), dirty(spark, sf_dir)
    for stage in ("raw", "final", "other"):
        dq.run_quality_checks(rows, stage=stage, output_dir=out)
    read = spark.read.schema(dq._report_schema()).json([f"{out}/data_quality_report_raw.json", f"{out}/data_quality_report.json"])
    return read.select(F.when(F.col("stage") == "raw", "data_quality_report_raw.json").otherwise("data_quality_report.json").alias("file"), "row_count")


_cte, _body = report_metrics_sql(adapter_sql("dirty"), list(RAW_COLUMNS), {"engine_id", "cycle"}, list(RAW_COLUMNS))


_lack, _odd_columns = "sensor_21", [c for c in RAW_COLUMNS if c != "sensor_21"]
_cte_o, _body_o = report_metrics_sql(f"SELECT * EXCLUDE ({_lack}) FROM ({adapter_sql('dirty')}) x", _odd_columns, {"engine_id", "cycle", "sensor_07"}, list(RAW_COLUMNS))
_body_o = (_body_o.replace("SELECT 'check:numeric_types_valid', (1)::BIGINT", "SELECT 'check:numeric_types_valid', (0)::BIGINT")
           + "\nUNION ALL\nSELECT 'critical:non_numeric_columns:[''sensor_07'']', 1::BIGINT")


@register("quality_report_schema", f"WITH {_cte_o}\n{_body_o}")
def q_quality_report_schema(spark, sf_dir):
    """DQ4, DQ5: a frame that lacks a column and holds another as text."""
    odd = dirty(spark, sf_dir).drop(_lack).withColumn("sensor_07", F.col("sensor_07").cast("string"))
    return dq.report_metrics(dq.report_frame(odd, stage="raw"))


@register("quality_report", f"WITH {_cte}\n{_body}")
def q_quality_report(spark, sf_dir):
    return dq.report_metrics(dq.report_frame(dirty(spark, sf_dir), stage="raw"))


_cte_f, _body_f = report_metrics_sql("SELECT * FROM feat", _FEAT, {"engine_id", "cycle", "rul"},
                                     ["engine_id", "cycle", "rul"])


@register("quality_final", with_li(_body_f, feature_cte("li") + ",\n" + _cte_f))
def q_quality_final(spark, sf_dir):
    feats = li_features(spark, sf_dir)
    return dq.report_metrics(dq.report_frame(feats, stage="final", required_columns=("engine_id", "cycle", "rul")))


@register("final_gate", with_features(
    "SELECT COUNT(*) = 0 AS empty, COUNT(*) FILTER (WHERE engine_id <= 0 OR cycle <= 0)::BIGINT AS invalid_ids "
    "FROM feat"))
def q_final_gate(spark, sf_dir):
    return dq.final_gate(li_features(spark, sf_dir))


# ------------------------------------------------------------- cleaning (CL)
_RAW_LIST = ", ".join(RAW_COLUMNS)


@register("drop_duplicates", _with_dirty(f"SELECT DISTINCT {_RAW_LIST} FROM d"))
def q_drop_dup(spark, sf_dir):
    return cl.drop_exact_duplicates(dirty(spark, sf_dir))


@register("coerce_numeric", token_expected_sql())
def q_coerce(spark, sf_dir):
    return cl.enforce_numeric_types(token_trajectories(spark, sf_dir))


_INF_SEL = ", ".join(f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END AS {c}" if c in _RAW_D else c
                     for c in RAW_COLUMNS)


@register("inf_to_null", _with_dirty(f"SELECT {_INF_SEL} FROM d"))
def q_inf_null(spark, sf_dir):
    return cl.replace_infinites_with_nan(dirty(spark, sf_dir))


_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS)


@register("drop_missing", _with_dirty(f"SELECT * FROM (SELECT {_INF_SEL} FROM d) x WHERE {_NOT_NULL}"))
def q_drop_missing(spark, sf_dir):
    return cl.drop_rows_with_missing_core(cl.replace_infinites_with_nan(dirty(spark, sf_dir)))


_VAR_SQL = "\nUNION ALL\n".join(
    f"SELECT '{s}' AS sensor, FLOOR(VAR_POP({s}) * 1e3 + 0.5 + LEAST(ABS(VAR_POP({s})) * 1e-8, 0.01)) / 1e3 AS var_pop, "
    f"VAR_POP({s}) <= 1e-9 AS near_constant "
    "FROM li"
    for s in [f"sensor_{i:02d}" for i in range(1, 22)])


@register("near_constant", with_li(_VAR_SQL))
def q_near_constant(spark, sf_dir):
    df = li(spark, sf_dir)
    var = cl.sensor_variances(df)
    pairs = ", ".join(f"'{s}', `{s}`" for s in var.columns)
    out = var.select(F.expr(f"stack({len(var.columns)}, {pairs}) AS (sensor, var_pop)"))
    # variances reach 1e9 here: 3 decimals keep 12+ significant digits
    return rounded(out.select("sensor", "var_pop", (F.col("var_pop") <= 1e-9).alias("near_constant")), digits=3)


_CLEAN_COLS = [c for c in RAW_COLUMNS if c != "sensor_01"]


@register("sort_by_engine_cycle", _with_dirty(
    "SELECT engine_id, cycle, position FROM (SELECT engine_id, cycle, CAST(row_number() OVER (ORDER BY engine_id, cycle) "
    "AS BIGINT) AS position FROM d) x"))
def q_sort_clean(spark, sf_dir):
    return _positions(_ranked(cl.sort_by_engine_cycle(dirty(spark, sf_dir).select(*_ID))))


@register("clean_all", _with_dirty(
    f"SELECT {', '.join(_CLEAN_COLS)} FROM (SELECT DISTINCT * FROM (SELECT {_INF_SEL} FROM d) y) x WHERE {_NOT_NULL}"))
def q_clean_all(spark, sf_dir):
    return cl.clean_sensor_data(dirty(spark, sf_dir))


# ------------------------------------------------------- sources / sinks (SRC, SNK)
from assetlife import sinks  # noqa: E402
from assetlife.sources import text as src  # noqa: E402
from assetlife.sources.adapters import rul_value, text_expected_sql, write_trajectory_text  # noqa: E402


def _raw_dir_with(spark, sf_dir, files: dict[str, DataFrame]) -> str:
    """A fresh raw folder in the shared checkpoint dir holding derived text files."""
    base = scratch_path(spark, "raw")
    for rel, df in files.items():
        write_trajectory_text(df, f"{base}/{rel}")
    return base


@register("parse_text", text_expected_sql())
def q_parse_text(spark, sf_dir):
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/train_FD001.txt": li(spark, sf_dir)})
    return src.load_raw_data(spark, "FD001", "train", raw)


@register("provenance", with_li(
    "SELECT CASE WHEN engine_id % 2 = 0 THEN 'FD001' ELSE 'FD002' END AS variant, "
    "CASE WHEN engine_id % 2 = 0 THEN 'train' ELSE 'test' END AS split, COUNT(*)::BIGINT AS n_rows, "
    "COUNT(DISTINCT engine_id)::BIGINT AS n_engines, SUM(cycle)::BIGINT AS sum_cycle FROM li GROUP BY 1, 2"))
def q_provenance(spark, sf_dir):
    rows = li(spark, sf_dir)
    raw = _raw_dir_with(spark, sf_dir, {
        "train_FD001.txt": rows.filter(F.col("engine_id") % 2 == 0),
        "nested/test_FD002.txt": rows.filter(F.col("engine_id") % 2 == 1),
    })
    both = src.load_variants(spark, raw, pairs=[("FD001", "train"), ("FD002", "test")])
    return both.groupBy("variant", "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.countDistinct("engine_id").alias("n_engines"),
                                                F.sum("cycle").alias("sum_cycle"))


@register("list_files", with_li(
    "SELECT 'test_FD001.txt' AS file, COUNT(*) AS n_lines FROM test UNION ALL SELECT 'train_FD001.txt', COUNT(*) FROM li",
    "test AS (SELECT * FROM (SELECT *, MAX(cycle) OVER (PARTITION BY engine_id) AS mc FROM li) x "
    "WHERE mc - cycle >= engine_id % 37 + 10)"))
def q_list_files(spark, sf_dir):
    """The listed files with their lines; a folder of parts is one file."""
    rows = li(spark, sf_dir)
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/train_FD001.txt": rows, "CMAPSSData/test_FD001.txt": _test_split(rows)})
    listed = src.list_available_files(spark, raw)
    return src.count_lines(spark, listed).select(F.element_at(F.split("path", "/"), -1).alias("file"), "n_lines")


def _test_split(rows: DataFrame) -> DataFrame:
    """Test split: every engine loses its last (engine_id % 37) + 10 cycles."""
    from assetlife.operators.lifecycle import add_remaining_useful_life

    return add_remaining_useful_life(rows).filter(F.col("rul") >= rul_value()).drop("rul")


def _write_rul_file(spark, rows: DataFrame, path: str | None = None) -> str:
    """One line per engine, in order; every third is followed by a line of
    white space only (blanks and tabs in turn)."""
    path = path or scratch_path(spark, "rul") + "/RUL_FD001.txt"
    engines = rows.select("engine_id").distinct().withColumn("value", rul_value().cast("string"))
    blanks = engines.filter(F.col("engine_id") % 3 == 0).withColumn("value", F.when(F.col("engine_id") % 2 == 0, "\t").otherwise("  \t "))
    lines = engines.withColumn("after", F.lit(0)).unionByName(blanks.withColumn("after", F.lit(1)))
    lines.orderBy("engine_id", "after").select("value").write.text(path)
    return path


_TEST_SQL = ("test AS (SELECT * FROM (SELECT *, MAX(cycle) OVER (PARTITION BY engine_id) AS mc FROM li) x "
             "WHERE mc - cycle >= engine_id % 37 + 10)")


@register("rul_targets", with_li(
    "SELECT CAST(ROW_NUMBER() OVER (ORDER BY engine_id) AS BIGINT) AS engine_id, CAST(engine_id % 37 + 10 AS DOUBLE) "
    "AS rul FROM (SELECT DISTINCT engine_id FROM li) e"))
def q_rul_targets(spark, sf_dir):
    path = _write_rul_file(spark, li(spark, sf_dir))
    return src.load_rul_targets(spark, path=path)


@register("attach_official_rul", with_li(
    "SELECT t.engine_id, t.cycle, CASE WHEN p.pos % 4 = 1 THEN NULL ELSE CAST(t.mc - t.cycle AS DOUBLE) END AS rul FROM test t "
    "JOIN (SELECT engine_id, ROW_NUMBER() OVER (ORDER BY engine_id) AS pos FROM (SELECT DISTINCT engine_id FROM li) e) p "
    "ON p.pos = t.engine_id", _TEST_SQL))
def q_attach_rul(spark, sf_dir):
    """Every fourth engine has no target: its rows stay, with a NULL rul."""
    rows = li(spark, sf_dir)
    targets = src.load_rul_targets(spark, path=_write_rul_file(spark, rows)).filter(F.col("engine_id") % 4 != 1)
    test = _test_split(rows)
    return src.attach_official_rul(test, targets).select("engine_id", "cycle", "rul")


@register("features_roundtrip", with_features(f"SELECT {select_rounded(_FEAT, _FEAT_DOUBLES)} FROM feat"))
def q_features_roundtrip(spark, sf_dir):
    path = sinks.write_parquet(li_features(spark, sf_dir), scratch_path(spark, "features"))
    return rounded(src.load_features_table(spark, path, "sensor_features"))


@register("csv_roundtrip", with_features(_SUMMARY_SQL))
def q_csv_roundtrip(spark, sf_dir):
    summary = rounded(marts.engine_summary(li_features(spark, sf_dir)))
    path = sinks.write_csv(summary, scratch_path(spark, "csv") + "/engine_summary")
    return spark.read.schema(summary.schema).option("header", True).csv(path)


@register("report_json", ORACLE["quality_report"])
def q_report_json(spark, sf_dir):
    report = dq.build_quality_report(dirty(spark, sf_dir), stage="raw")
    path = dq.save_quality_report(spark, report, scratch_path(spark, "report") + "/data_quality_report_raw.json")
    return dq.report_metrics(spark.read.schema(dq._report_schema()).json(path))


# ------------------------------------------------------------ exploration (EX)
from assetlife.operators import explore as ex  # noqa: E402
from assetlife.operators import model as ml  # noqa: E402


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c})::BIGINT AS count, {r6(f'AVG({x})', 'mean')}, "
            f"{r6(f'STDDEV_SAMP({x})', 'std')}, {r6(f'MIN({x})', 'min')}, "
            f"{r6(f'QUANTILE_CONT({x}, 0.25)', 'p25')}, {r6(f'QUANTILE_CONT({x}, 0.5)', 'p50')}, "
            f"{r6(f'QUANTILE_CONT({x}, 0.75)', 'p75')}, {r6(f'MAX({x})', 'max')} FROM {src}")
    return "\nUNION ALL\n".join(parts)


@register("describe", with_li(_describe_sql("li", list(RAW_COLUMNS))))
def q_describe(spark, sf_dir):
    return rounded(ex.describe(li(spark, sf_dir)))


@register("engine_life_describe", with_li(
    _describe_sql("life", ["max_cycle"]),
    feature_cte("li") + ",\nlife AS (SELECT engine_id, MAX(cycle) AS max_cycle FROM feat GROUP BY engine_id)"))
def q_engine_life_describe(spark, sf_dir):
    return rounded(ex.describe(ex.engine_life(li_features(spark, sf_dir)), ["max_cycle"]))


@register("sensor_summary", with_features("\nUNION ALL\n".join(
    f"SELECT '{s}' AS sensor, {r6(f'AVG({s})', 'mean')}, {r6(f'STDDEV_SAMP({s})', 'std')}, "
    f"{r6(f'MIN({s})', 'min')}, {r6(f'MAX({s})', 'max')} FROM feat" for s in S7)))
def q_sensor_summary(spark, sf_dir):
    return rounded(ex.sensor_summary(li_features(spark, sf_dir)))


@register("engine_sample", with_features(
    "SELECT engine_id, cycle, sensor_04 FROM feat WHERE engine_id IN (1, 5, 10, 25, 50)"))
def q_engine_sample(spark, sf_dir):
    return ex.engine_sample(li(spark, sf_dir))


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""SELECT b.bin::INT AS bin, {r6(f'r.lo + CAST(b.bin AS DOUBLE) * ((r.hi - r.lo) / {bins}.0)', 'lower')},
  {r6(f'r.lo + CAST(b.bin + 1 AS DOUBLE) * ((r.hi - r.lo) / {bins}.0)', 'upper')},
  COALESCE(c.n, 0)::BIGINT AS count
FROM range({bins}) b(bin)
CROSS JOIN (SELECT CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo,
                   CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi
            FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {src}) s) r
LEFT JOIN (SELECT LEAST(FLOOR((v - r2.lo) / (r2.hi - r2.lo) * {bins}.0), {bins - 1})::INT AS bin, COUNT(*) AS n
           FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL) s2
           CROSS JOIN (SELECT CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo,
                              CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi
                       FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {src}) s3) r2
           GROUP BY 1) c ON c.bin = b.bin"""


def _rounded_hist(df):
    return df.select("bin", round6(F.col("lower")).alias("lower"), round6(F.col("upper")).alias("upper"), "count")


@register("life_histogram", with_li(
    _hist_sql("life", "max_cycle", 20),
    feature_cte("li") + ",\nlife AS (SELECT engine_id, MAX(cycle) AS max_cycle FROM feat GROUP BY engine_id)"))
def q_life_hist(spark, sf_dir):
    return _rounded_hist(ex.histogram(ex.engine_life(li_features(spark, sf_dir)), "max_cycle", 20))


@register("rul_histogram", with_features(_hist_sql("feat", "rul", 40)))
def q_rul_hist(spark, sf_dir):
    return _rounded_hist(ex.histogram(li_features(spark, sf_dir), "rul", 40))


_CORR_COLS = [*S7, "rul"]


def _corr_expr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"COVAR_POP({a}, {b}) FILTER (WHERE {both}) / NULLIF(STDDEV_POP({a}) FILTER (WHERE {both}) * "
            f"STDDEV_POP({b}) FILTER (WHERE {both}), 0)")


@register("corr_matrix", with_features("\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, {r6(_corr_expr(a, b), 'corr')} FROM feat"
    for a in _CORR_COLS for b in _CORR_COLS)))
def q_corr_matrix(spark, sf_dir):
    return rounded(ex.correlation_pairs(li_features(spark, sf_dir), _CORR_COLS))


@register("rul_corr_rank", with_features("\nUNION ALL\n".join(
    f"SELECT '{s}' AS sensor, {r6(_corr_expr(s, 'rul'), 'corr_with_rul')} FROM feat" for s in S7)))
def q_rul_corr(spark, sf_dir):
    return rounded(ex.rul_correlations(li_features(spark, sf_dir)))


@register("engine_series", with_features(
    "SELECT cycle, sensor_04, " + r6("sensor_04_rolling_mean", "sensor_04_rolling_mean") + ", "
    + r6("sensor_04_delta", "sensor_04_delta") + ", " + r6("sensor_04_rolling_std", "sensor_04_rolling_std")
    + " FROM feat WHERE engine_id = 1"))
def q_engine_series(spark, sf_dir):
    # rolling / delta are per engine: filtering the input first gives the same values
    one = li(spark, sf_dir).filter(F.col("engine_id") == 1)
    return rounded(ex.engine_series(fe.engineer_features(one)))


_Q = lambda q: f"QUANTILE_CONT(sensor_04, {q})"
_IQR_CTE = (f"fences AS (SELECT {_Q(0.25)} AS q1, {_Q(0.5)} AS q2, {_Q(0.75)} AS q3 FROM feat), "
            "f AS (SELECT q1, q2, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM fences)")


@register("iqr_outliers", with_li(
    f"SELECT {r6('MAX(f.q1)', 'q1')}, {r6('MAX(f.q3)', 'q3')}, {r6('MAX(f.iqr)', 'iqr')}, {r6('MAX(f.lo)', 'lower')}, "
    f"{r6('MAX(f.hi)', 'upper')}, COUNT(*) FILTER (WHERE sensor_04 < f.lo OR sensor_04 > f.hi)::BIGINT AS n_outliers, "
    f"COUNT(*)::BIGINT AS n_rows, "
    + r6("100.0 * COUNT(*) FILTER (WHERE sensor_04 < f.lo OR sensor_04 > f.hi) / COUNT(*)", "outlier_pct")
    + " FROM feat, f", feature_cte("li") + ",\n" + _IQR_CTE))
def q_iqr(spark, sf_dir):
    return rounded(ex.iqr_outliers(li_features(spark, sf_dir)))


@register("boxplot_stats", with_li(
    f"SELECT {r6('MAX(f.q1)', 'q1')}, {r6('MAX(f.q2)', 'median')}, {r6('MAX(f.q3)', 'q3')}, "
    f"{r6('MIN(sensor_04) FILTER (WHERE sensor_04 >= f.lo AND sensor_04 <= f.hi)', 'whisker_low')}, "
    f"{r6('MAX(sensor_04) FILTER (WHERE sensor_04 >= f.lo AND sensor_04 <= f.hi)', 'whisker_high')}, "
    "COUNT(*) FILTER (WHERE sensor_04 < f.lo)::BIGINT AS n_low_outliers, "
    "COUNT(*) FILTER (WHERE sensor_04 > f.hi)::BIGINT AS n_high_outliers FROM feat, f",
    feature_cte("li") + ",\n" + _IQR_CTE))
def q_boxplot(spark, sf_dir):
    return rounded(ex.boxplot_stats(li_features(spark, sf_dir)))


@register("flag_outliers", with_li(
    "SELECT engine_id, cycle, sensor_04 < f.lo OR sensor_04 > f.hi AS is_outlier FROM feat, f", feature_cte("li") + ",\n" + _IQR_CTE))
def q_flag_outliers(spark, sf_dir):
    return ex.flag_outliers(li(spark, sf_dir).select(*_ID, "sensor_04")).select(*_ID, "is_outlier")


_IQR_12 = _IQR_CTE.replace("sensor_04", "sensor_12")


@register("boxplot_outliers", with_li(
    f"SELECT engine_id, cycle, {r6('sensor_12', 'sensor_12')}, CASE WHEN sensor_12 < f.lo THEN 'low' ELSE 'high' END AS side "
    "FROM feat, f WHERE sensor_12 < f.lo OR sensor_12 > f.hi", feature_cte("li") + ",\n" + _IQR_12))
def q_boxplot_outliers(spark, sf_dir):
    """The points beyond the whiskers."""
    return rounded(ex.boxplot_outliers(li(spark, sf_dir).select(*_ID, "sensor_12"), "sensor_12"))


_RC = "\nUNION ALL\n".join(f"SELECT '{s}' AS sensor, {_corr_expr(s, 'rul')} AS c FROM feat" for s in S7)
_FIND_SQL = f"""SELECT (SELECT COUNT(*) FROM li)::BIGINT AS n_rows_raw,
  (SELECT COUNT(DISTINCT engine_id) FROM li)::BIGINT AS n_engines,
  (SELECT MIN(cycle) FROM li) AS cycle_min, (SELECT MAX(cycle) FROM li) AS cycle_max,
  {r6('(SELECT AVG(max_cycle) FROM life)', 'mean_engine_life')},
  {r6('(SELECT QUANTILE_CONT(max_cycle, 0.5) FROM life)', 'median_engine_life')},
  ((SELECT COUNT(*) FROM li) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM li) d))::BIGINT AS duplicate_rows_raw,
  ({' + '.join(f'(SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM li)' for c in RAW_COLUMNS)})::BIGINT AS missing_cells_raw,
  {r6('(SELECT 100.0 * COUNT(*) FILTER (WHERE sensor_04 < f.lo OR sensor_04 > f.hi) / COUNT(*) FROM feat, f)',
      'sensor_04_outlier_pct')},
  (SELECT arg_min(sensor, c) FROM rc) AS strongest_negative_corr_with_rul,
  {r6('(SELECT MIN(c) FROM rc)', 'strongest_negative_corr_value')},
  (SELECT arg_max(sensor, c) FROM rc) AS strongest_positive_corr_with_rul,
  {r6('(SELECT MAX(c) FROM rc)', 'strongest_positive_corr_value')}"""


@register("findings", with_li(_FIND_SQL, feature_cte("li") + ",\n" + _IQR_CTE
                               + ",\nlife AS (SELECT engine_id, MAX(cycle) AS max_cycle FROM feat GROUP BY engine_id)"
                               + f",\nrc AS ({_RC})"))
def q_findings(spark, sf_dir):
    return rounded(ex.findings(li(spark, sf_dir), li_features(spark, sf_dir)))


# ------------------------------------------------------------- modelling (ML)
_NOT_NULL_FEAT = " AND ".join(f"{c} IS NOT NULL" for c in _FEAT)
_CC_CTE = f"cc AS (SELECT * FROM feat WHERE {_NOT_NULL_FEAT})"
_SPLIT_CTE = ("h AS (SELECT engine_id, ('0x' || substr(md5(CAST(engine_id AS VARCHAR) || ':42'), 1, 15))::BIGINT AS h "
              "FROM (SELECT DISTINCT engine_id FROM cc) e), "
              "sp AS (SELECT engine_id, ROW_NUMBER() OVER (ORDER BY h, engine_id) <= "
              "FLOOR(0.8 * COUNT(*) OVER ()) AS is_train FROM h)")


@register("complete_cases", with_li(f"SELECT {select_rounded(_FEAT, _FEAT_DOUBLES)} FROM cc",
                                    feature_cte("li") + ",\n" + _CC_CTE))
def q_complete_cases(spark, sf_dir):
    return rounded(ml.complete_cases(li_features(spark, sf_dir)))


@register("grouped_split", with_li("SELECT engine_id, is_train FROM sp",
                                   feature_cte("li") + ",\n" + _CC_CTE + ",\n" + _SPLIT_CTE))
def q_grouped_split(spark, sf_dir):
    return ml.engine_split(ml.complete_cases(li_features(spark, sf_dir)))


_FLEET_HASH = ("h AS (SELECT variant, split, engine_id, ('0x' || substr(md5(variant || ':' || split || ':' || "
               "CAST(engine_id AS VARCHAR) || ':42'), 1, 15))::BIGINT AS h FROM (SELECT DISTINCT variant, split, engine_id FROM fleet) e)")


@register("fleet_split", f"WITH fleet AS ({adapter_sql('fleet')}),\n{_FLEET_HASH}\nSELECT variant, split, engine_id, "
          "ROW_NUMBER() OVER (ORDER BY h, variant, split, engine_id) <= FLOOR(0.8 * COUNT(*) OVER ()) AS is_train FROM h")
def q_fleet_split(spark, sf_dir):
    """ML3 over engines of several runs, whose ids clash."""
    return ml.engine_split(fleet_trajectories(spark, sf_dir), key=_FLEET)


@register("regression_metrics", with_li(
    f"SELECT {r6('AVG(ABS(p - rul))', 'mae')}, {r6('SQRT(AVG((p - rul) * (p - rul)))', 'rmse')}, "
    + r6("1 - SUM((p - rul) * (p - rul)) / (VAR_POP(rul) * COUNT(*))", "r2") + ", COUNT(*)::BIGINT AS n_test "
    "FROM (SELECT cc.rul, (SELECT AVG(rul) FROM cc JOIN sp USING (engine_id) WHERE is_train) AS p "
    "FROM cc JOIN sp USING (engine_id) WHERE NOT is_train) t",
    feature_cte("li") + ",\n" + _CC_CTE + ",\n" + _SPLIT_CTE))
def q_regression_metrics(spark, sf_dir):
    """Metrics of the train-mean baseline (deterministic, so SQL can check it)."""
    train, test = ml.grouped_holdout(ml.complete_cases(li_features(spark, sf_dir)))
    mean = train.agg(F.avg("rul")).first()[0]
    return rounded(ml.regression_metrics(test.withColumn("prediction", F.lit(mean))))


from assetlife.operators import forest as hist  # noqa: E402

_TREES, _DEPTH, _BINS, _LEAST, _SEED = 3, 3, 16, 20, 42
_MODEL_FEATURES = [c for c in _FEAT if c not in ml.LEAKAGE]


def _forest_ctes() -> list[str]:
    """The forest by plain SQL: ranks for the edges, all cells of a level, the
    best split of every node, and both kinds of rows sent down."""
    cells = ", ".join(r6(c, c) for c in _MODEL_FEATURES)
    number = "CASE name " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_MODEL_FEATURES)) + " END"
    draw = (f"CAST('0x' || substr(md5('{_SEED}:' || CAST(t // {hist.PER_DIGEST} AS VARCHAR) || ':' || CAST(engine_id AS VARCHAR) || ':' || "
            f"CAST(cycle AS VARCHAR)), CAST(1 + 8 * (t % {hist.PER_DIGEST}) AS INT), 8) AS BIGINT)")
    weight = " + ".join(f"({draw} >= {step})::INT" for step in hist.poisson_steps())
    out = [
        f"pts AS (SELECT engine_id, cycle, rul, is_train, {cells} FROM cc JOIN sp USING (engine_id))",
        f"long AS (SELECT engine_id, cycle, is_train, {number} AS f, x FROM (UNPIVOT (SELECT * EXCLUDE (rul) FROM pts) ON {', '.join(_MODEL_FEATURES)} INTO NAME name VALUE x) u)",
        "ranked AS (SELECT f, x, ROW_NUMBER() OVER (PARTITION BY f ORDER BY x) - 1 AS k, COUNT(*) OVER (PARTITION BY f) AS n FROM long WHERE is_train)",
        f"edges AS (SELECT f, list(DISTINCT x ORDER BY x) AS es FROM ranked WHERE list_contains(list_transform(range(1, {_BINS}), lambda i: i * n // {_BINS}), k) GROUP BY f)",
        "coded AS (SELECT engine_id, cycle, f, len(list_filter(es, lambda e: e < x)) AS b, es FROM long JOIN edges USING (f))",
        f"drawn AS (SELECT engine_id, cycle, rul, t, {weight} AS w FROM pts, range({_TREES}) trees(t) WHERE is_train)",
        "at0 AS (SELECT engine_id, cycle, rul, t, w, 1 AS node FROM drawn WHERE w > 0)",
        f"test0 AS (SELECT engine_id, cycle, rul, t, 1 AS node FROM pts, range({_TREES}) trees(t) WHERE NOT is_train)",
    ]
    for i in range(_DEPTH):
        out += [
            f"cells{i} AS (SELECT t, node, f, b, any_value(es) AS es, CAST(SUM(w) AS DOUBLE) AS n, CAST(SUM(w * rul) AS DOUBLE) AS s FROM at{i} JOIN coded USING (engine_id, cycle) GROUP BY t, node, f, b)",
            f"sums{i} AS (SELECT t, node, f, b, es, SUM(n) OVER u AS ln, SUM(s) OVER u AS ls, SUM(n) OVER a AS n, SUM(s) OVER a AS s FROM cells{i} "
            "WINDOW u AS (PARTITION BY t, node, f ORDER BY b), a AS (PARTITION BY t, node, f))",
            f"gains{i} AS (SELECT *, CASE WHEN ln >= {_LEAST} AND n - ln >= {_LEAST} THEN ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n END AS g FROM sums{i})",
            f"best{i} AS (SELECT t, node, n, s, CASE WHEN g > 0 THEN g END AS g, f, b, es[b + 1] AS cut FROM gains{i} "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY t, node ORDER BY CASE WHEN g > 0 THEN g ELSE 0 END DESC, f, b) = 1)",
            f"at{i + 1} AS (SELECT a.engine_id, a.cycle, a.rul, a.t, a.w, 2 * a.node + (c.b > s.b)::INT AS node FROM at{i} a JOIN best{i} s USING (t, node) "
            "JOIN coded c ON c.engine_id = a.engine_id AND c.cycle = a.cycle AND c.f = s.f WHERE s.g IS NOT NULL)",
            f"test{i + 1} AS (SELECT a.engine_id, a.cycle, a.rul, a.t, CASE WHEN s.g IS NULL THEN a.node ELSE 2 * a.node + (c.b > s.b)::INT END AS node FROM test{i} a "
            f"LEFT JOIN best{i} s USING (t, node) LEFT JOIN coded c ON c.engine_id = a.engine_id AND c.cycle = a.cycle AND c.f = s.f)",
        ]
    nodes = " UNION ALL ".join([f"SELECT t, node, n, s / n AS mean, CASE WHEN g IS NOT NULL THEN f END AS f, CASE WHEN g IS NOT NULL THEN cut END AS cut, g FROM best{i}" for i in range(_DEPTH)]
                               + [f"SELECT t, node, CAST(SUM(w) AS DOUBLE), CAST(SUM(w * rul) AS DOUBLE) / SUM(w), NULL, NULL, NULL FROM at{_DEPTH} GROUP BY t, node"])
    out.append(f"nodes AS ({nodes})")
    each = " + ".join(f"MAX(CASE WHEN p.t = {t} THEN mean END)" for t in range(_TREES))
    out.append(f"preds AS (SELECT p.engine_id, p.cycle, p.rul, ({each}) / {_TREES} AS p FROM test{_DEPTH} p JOIN nodes USING (t, node) GROUP BY ALL)")
    return out


def _forest_sql(body: str) -> str:
    return with_li(body, ",\n".join([feature_cte("li"), _CC_CTE, _SPLIT_CTE, *_forest_ctes()]))


def _checked_forest(spark, sf_dir):
    """A small seeded forest over the published (rounded) features: (forest, test rows)."""
    rows = materialize(rounded(ml.complete_cases(li_features(spark, sf_dir))), "model-rows")
    train, test = ml.grouped_holdout(rows)
    fitted = hist.fit_forest(train, ml.model_feature_columns(rows), trees=_TREES, depth=_DEPTH, bins=_BINS, least_rows=_LEAST, seed=_SEED, written=True)
    return fitted, test


@register("forest_nodes", _forest_sql(
    f"SELECT CAST(t AS INT) AS tree, CAST(node AS INT) AS node, CAST(n AS BIGINT) AS n, {r6('mean', 'mean')}, "
    f"[{', '.join(repr(c) for c in _MODEL_FEATURES)}][f + 1] AS feature, {r6('cut', 'threshold')}, {r6('g', 'gain')} FROM nodes"))
def q_forest_nodes(spark, sf_dir):
    """Every node of the forest: rows, mean label, split and its gain."""
    return rounded(_checked_forest(spark, sf_dir)[0].table(spark))


@register("rf_predict", _forest_sql(f"SELECT engine_id, cycle, rul, {r6('p', 'prediction')} FROM preds"))
def q_rf_predict(spark, sf_dir):
    """The forest's prediction for every row of the held-out engines."""
    fitted, test = _checked_forest(spark, sf_dir)
    return rounded(hist.predict_forest(fitted, test, keep=["engine_id", "cycle", "rul"]))


@register("rf_metrics", _forest_sql(
    f"SELECT {r6('AVG(ABS(p - rul))', 'mae')}, {r6('SQRT(AVG((p - rul) * (p - rul)))', 'rmse')}, "
    + r6("1 - SUM((p - rul) * (p - rul)) / (VAR_POP(rul) * COUNT(*))", "r2") + ", COUNT(*)::BIGINT AS n_test FROM preds"))
def q_rf_metrics(spark, sf_dir):
    """MAE, RMSE and R2 of the forest on the held-out engines."""
    fitted, test = _checked_forest(spark, sf_dir)
    return rounded(ml.regression_metrics(hist.predict_forest(fitted, test, keep=["rul"])))


@register("rf_large")
def q_rf_large(spark, sf_dir):
    """Metrics of MLlib's forest of 100 trees and depth 12 on the same engines
    (its random streams are beyond SQL; tests hold it against the other)."""
    cc = ml.complete_cases(li_features(spark, sf_dir))
    train, test = ml.grouped_holdout(cc)
    model = ml.fit_random_forest(train, ml.model_feature_columns(cc))
    return rounded(ml.regression_metrics(ml.predict(model, test)))


# ------------------------------------------------------------------ job (JOB)
from assetlife.plans import job as batch  # noqa: E402
from assetlife.plans.publish import manifest, published  # noqa: E402

_KEEP = "cycle % 13 NOT IN (0, 2, 3)"
_JOB_SQL = f"""WITH li AS ({adapter_sql('li')}),
clean AS (SELECT * FROM li WHERE {_KEEP}),
{feature_cte('clean')},
life AS (SELECT engine_id, COUNT(*) AS n FROM clean GROUP BY engine_id)
SELECT * FROM (VALUES
  ('ingest', 'rows', (SELECT COUNT(*) FROM li)::DOUBLE),
  ('ingest', 'columns', 26.0),
  ('ingest', 'engines', (SELECT COUNT(DISTINCT engine_id) FROM li)::DOUBLE),
  ('validate_raw', 'passed', 1.0),
  ('validate_raw', 'duplicate_count', 0.0),
  ('clean', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('clean', 'columns', 20.0),
  ('features', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('features', 'columns', 42.0),
  ('validate_final', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('validate_final', 'engines', (SELECT COUNT(DISTINCT engine_id) FROM clean)::DOUBLE),
  ('validate_final', 'cycle_min', (SELECT MIN(cycle) FROM clean)::DOUBLE),
  ('validate_final', 'cycle_max', (SELECT MAX(cycle) FROM clean)::DOUBLE),
  ('validate_final', 'duplicate_count', 0.0),
  ('sql.engine_summary.sql', 'rows', (SELECT COUNT(*) FROM life)::DOUBLE),
  ('sql.sensor_analysis.sql', 'rows', (SELECT COUNT(*) FROM life)::DOUBLE),
  ('sql.window_analysis.sql', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('written.engine_summary', 'rows', (SELECT COUNT(*) FROM life)::DOUBLE),
  ('written.sensor_analysis', 'rows', (SELECT COUNT(*) FROM life)::DOUBLE),
  ('written.window_analysis', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('written.sensor_features', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('written.data_quality_report_raw', 'rows', (SELECT COUNT(*) FROM li)::DOUBLE),
  ('written.data_quality_report', 'rows', (SELECT COUNT(*) FROM clean)::DOUBLE),
  ('sample_engine_stats', 'n_engines_in_summary', (SELECT COUNT(*) FROM life)::DOUBLE),
  ('sample_engine_stats', 'avg_cycles_mean', FLOOR((SELECT AVG(n) FROM life) * 1e6 + 0.5 + LEAST(ABS((SELECT AVG(n) FROM life)) * 1e-5, 0.01)) / 1e6)
) v(stage, metric, value)"""


def _job_rows(spark, raw: str, split: str = "train", pairs=None):
    """(stage, metric, value) of a run, read back from what it published."""
    out = scratch_path(spark, "job")
    batch.run_job(spark, raw, out, split=split, pairs=pairs)
    told = batch.summary_rows(spark, batch.read_summary(spark, out))
    names = ["engine_summary", "sensor_analysis", "window_analysis", "sensor_features"]
    rows = [(f"written.{name}", "rows", float(published(spark, out, name).count())) for name in names]
    for name in ("data_quality_report_raw", "data_quality_report"):
        path = manifest(spark, out)["tables"][name]["path"]
        rows.append((f"written.{name}", "rows", float(spark.read.schema(dq._report_schema()).json(path).first()["row_count"])))
    both = told.unionByName(spark.createDataFrame(rows, "stage string, metric string, value double"))
    return both.select("stage", "metric", round6(F.col("value")).alias("value"))


@register("job_end_to_end", _JOB_SQL)
def q_job(spark, sf_dir):
    """The whole batch job over text derived from lineitem."""
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/train_FD001.txt": li(spark, sf_dir)})
    return _job_rows(spark, raw)


_JOB_TEST_SQL = (_JOB_SQL.replace("clean AS (SELECT * FROM li", "whole AS (SELECT *, MAX(cycle) OVER (PARTITION BY engine_id) AS mc FROM li),\n"
                                  "test AS (SELECT * EXCLUDE (mc) FROM whole WHERE mc - cycle >= engine_id % 37 + 10),\nclean AS (SELECT * FROM test")
                 .replace("FROM li)::DOUBLE", "FROM test)::DOUBLE"))


@register("job_test_split", _JOB_TEST_SQL)
def q_job_test(spark, sf_dir):
    """The job on the test split, with official targets."""
    rows = li(spark, sf_dir)
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/test_FD001.txt": _test_split(rows)})
    _write_rul_file(spark, rows, f"{raw}/CMAPSSData/RUL_FD001.txt")
    return _job_rows(spark, raw, split="test")


_OFFICIAL = "(engine_id % 37 + 10)"
_JOB_FLEET_SQL = f"""WITH li AS ({adapter_sql('li')}),
one AS (SELECT 'FD001' AS variant, 'train' AS split, * FROM li WHERE {_KEEP}),
two AS (SELECT 'FD002' AS variant, 'test' AS split, * EXCLUDE (mc) FROM (SELECT *, MAX(cycle) OVER (PARTITION BY engine_id) AS mc FROM li) x
        WHERE mc - cycle >= engine_id % 37 + 10 AND {_KEEP}),
runs AS (SELECT * FROM one UNION ALL SELECT * FROM two),
feat AS (SELECT *, MAX(cycle) OVER (PARTITION BY variant, split, engine_id) AS last FROM runs),
lab AS (SELECT *, CAST(last - cycle AS DOUBLE) + CASE WHEN split = 'test' THEN {_OFFICIAL} ELSE 0 END AS rul FROM feat),
per AS (SELECT variant, split, engine_id, COUNT(*) AS n, MIN(cycle) AS f, MAX(cycle) AS l, SUM(sensor_02) AS s02, SUM(rul) AS sr FROM lab GROUP BY ALL)
SELECT variant, split, CAST(2 - GROUPING(variant) - GROUPING(split) AS INT) AS level, COUNT(*) AS n_engines, CAST(SUM(n) AS BIGINT) AS n_rows,
       MIN(f) AS first_cycle, MAX(l) AS last_cycle, {r6('AVG(n)', 'mean_cycles')}, {r6('SUM(s02) / SUM(n)', 'avg_sensor_02')}, {r6('SUM(sr) / SUM(n)', 'avg_rul')}
FROM per GROUP BY GROUPING SETS ((variant, split), (variant), ())"""


@register("job_fleet", _JOB_FLEET_SQL)
def q_job_fleet(spark, sf_dir):
    """The job over two runs with the same engine ids: the published rollup of
    its feature table (a training run, and a test run with official targets)."""
    rows = li(spark, sf_dir)
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/train_FD001.txt": rows, "CMAPSSData/test_FD002.txt": _test_split(rows)})
    _write_rul_file(spark, rows, f"{raw}/CMAPSSData/RUL_FD002.txt")
    out = scratch_path(spark, "job")
    batch.run_job(spark, raw, out, pairs=[("FD001", "train"), ("FD002", "test")])
    return rounded(marts.fleet_rollup(published(spark, out, "sensor_features")).drop("avg_sensor_04", "avg_sensor_11"))


# ------------------------------------------------------------ streaming ingest
from assetlife.streaming import ingest_to_parquet  # noqa: E402


@register("stream_ingest", text_expected_sql())
def q_stream_ingest(spark, sf_dir):
    """The text parse run as an available-now Structured Streaming query."""
    raw = _raw_dir_with(spark, sf_dir, {"CMAPSSData/train_FD001.txt": li(spark, sf_dir)})
    table = scratch_path(spark, "stream-table")
    query = ingest_to_parquet(spark, raw, table)
    query.awaitTermination()
    return spark.read.parquet(table).drop("source_path")
