"""Adapters that present the driver's tables as engine trajectories.

The sensor dataset itself is not available, so trajectories are derived by
Spark from the given tables; every adapter is a plain projection plus one
skew-safe per-key row number (``operators.segments.row_numbers``).

Fixed values of the LI adapter: settings ``l_linenumber, 0.0, 100.0``; the
near-constant channels sensor_01 = 518.67, sensor_05 = 14.62,
sensor_10 = 1.3, sensor_16 = 0.03, sensor_18 = 2388.0, sensor_19 = 100.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlife.config import CYCLE, ENGINE, RAW_COLUMNS
from assetlife.operators.segments import HEAVY_KEY_ROWS, row_numbers
from assetlife.session import compiled_methods


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    compiled_methods(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def lineitem_sensors() -> dict[str, Column]:
    """Settings and 21 sensors as expressions over lineitem columns."""
    q, p, d, t = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return {
        "op_setting_1": _d("l_linenumber"),
        "op_setting_2": F.lit(0.0),
        "op_setting_3": F.lit(100.0),
        "sensor_01": F.lit(518.67),
        "sensor_02": q,
        "sensor_03": p,
        "sensor_04": d,
        "sensor_05": F.lit(14.62),
        "sensor_06": (F.col("l_partkey") % 13).cast("double"),
        "sensor_07": t,
        "sensor_08": q + d,
        "sensor_09": p / F.lit(100.0),
        "sensor_10": F.lit(1.3),
        "sensor_11": p * (F.lit(1.0) - d),
        "sensor_12": q * t,
        "sensor_13": t * F.lit(100.0),
        "sensor_14": _d("l_linenumber") * F.lit(1.5),
        "sensor_15": F.try_divide(p, q),
        "sensor_16": F.lit(0.03),
        "sensor_17": (F.col("l_orderkey") % 97).cast("double"),
        "sensor_18": F.lit(2388.0),
        "sensor_19": F.lit(100.0),
        "sensor_20": q * F.lit(0.5),
        "sensor_21": d + t,
    }


def lineitem_trajectories(spark: SparkSession, sf_dir: str, max_rows: int = HEAVY_KEY_ROWS) -> DataFrame:
    """LI: one engine per supplier, cycles numbered along ship date.

    ``cycle = row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate,
    l_orderkey, l_linenumber, l_partkey, l_extendedprice)``; a supplier of more
    than ``max_rows`` rows is numbered by several tasks.  The engine is a column
    before it is numbered: windows over engines later on find the rows already
    dealt by it and shuffle them no second time.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + 1).cast("bigint").alias(ENGINE), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    )
    numbered = row_numbers(
        li,
        keys=[ENGINE],
        order=[F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")],
        name=CYCLE,
        max_rows=max_rows,
    )
    sensors = lineitem_sensors()
    return numbered.select(
        F.col(ENGINE),
        F.col(CYCLE).cast("bigint").alias(CYCLE),
        *[sensors[c].cast("double").alias(c) for c in RAW_COLUMNS[2:]],
    )


def event_trajectories(spark: SparkSession, sf_dir: str, keep_event_id: bool = False,
                       max_rows: int = HEAVY_KEY_ROWS) -> DataFrame:
    """EV: one engine per user, cycles numbered along (ts, event_id).

    sensor_01 = 10.0 is constant; sensor_i = value + i for i >= 2, so sensor_04
    carries the event value shifted by 4.
    """
    ev = _table(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") + 1).cast("bigint").alias(ENGINE), "value")
    numbered = row_numbers(
        ev,
        keys=[ENGINE],
        order=[F.col("ts"), F.col("event_id")],
        name=CYCLE,
        max_rows=max_rows,
    )
    v = F.col("value")
    cols = [
        F.col(ENGINE),
        F.col(CYCLE).cast("bigint").alias(CYCLE),
        F.lit(0.0).alias("op_setting_1"),
        F.lit(0.0).alias("op_setting_2"),
        F.lit(100.0).alias("op_setting_3"),
        F.lit(10.0).alias("sensor_01"),
        *[(v + F.lit(float(i))).alias(f"sensor_{i:02d}") for i in range(2, 22)],
    ]
    if keep_event_id:
        cols.append(F.col("event_id"))
    return numbered.select(*cols)


def dirty_trajectories(spark: SparkSession, sf_dir: str, keep_line: bool = False) -> DataFrame:
    """DIRTY: EV with deterministic damage keyed on ``event_id``.

    Rows with event_id % 97 = 0 appear twice (exact copies); % 101 = 0 gets
    sensor_03 = +inf (odd ids) or -inf (even ids); % 103 = 0 gets
    sensor_07 = NULL; % 107 = 0 gets engine_id = 0; % 109 = 0 gets cycle = -1.
    ``_line`` (kept on request) is the physical line order: 2 * event_id + copy.
    """
    ev = event_trajectories(spark, sf_dir, keep_event_id=True)
    eid = F.col("event_id")
    damaged = ev.select(
        F.when(eid % 107 == 0, F.lit(0).cast("bigint")).otherwise(F.col(ENGINE)).alias(ENGINE),
        F.when(eid % 109 == 0, F.lit(-1).cast("bigint")).otherwise(F.col(CYCLE)).alias(CYCLE),
        *[F.col(c) for c in RAW_COLUMNS[2:7]],
        F.when(eid % 101 == 0, F.when(eid % 2 == 1, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
        .otherwise(F.col("sensor_03")).alias("sensor_03"),
        *[F.col(c) for c in RAW_COLUMNS[8:11]],
        F.when(eid % 103 == 0, F.lit(None).cast("double")).otherwise(F.col("sensor_07")).alias("sensor_07"),
        *[F.col(c) for c in RAW_COLUMNS[12:]],
        eid,
    )
    copies = damaged.filter(eid % 97 == 0)
    out = damaged.withColumn("_line", eid * 2).unionByName(copies.withColumn("_line", eid * 2 + 1))
    out = out.drop("event_id")
    return out if keep_line else out.drop("_line")


def fleet_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLEET: three runs in one table, whose engine ids clash.

    FD001/train is LI, FD002/train is EV, FD002/test is EV without the rows of
    cycles above 20 + engine_id % 37.
    """
    li, ev = lineitem_trajectories(spark, sf_dir), event_trajectories(spark, sf_dir)

    def run(rows: DataFrame, variant: str, split: str) -> DataFrame:
        return rows.select(F.lit(variant).alias("variant"), F.lit(split).alias("split"), *RAW_COLUMNS)

    cut = ev.filter(F.col(CYCLE) <= F.lit(20) + F.col(ENGINE) % 37)
    return run(li, "FD001", "train").unionByName(run(ev, "FD002", "train")).unionByName(run(cut, "FD002", "test"))


def _fleet_sql() -> str:
    columns = ", ".join(RAW_COLUMNS)
    return f"""SELECT 'FD001' AS variant, 'train' AS split, {columns} FROM ({_li_sql()}) l
UNION ALL SELECT 'FD002', 'train', {columns} FROM ({_ev_sql()}) e
UNION ALL SELECT 'FD002', 'test', {columns} FROM ({_ev_sql()}) t WHERE cycle <= 20 + engine_id % 37"""


def adapter_sql(name: str) -> str:
    """The same adapters in DuckDB SQL (used by the oracle twins)."""
    return _ADAPTER_SQL[name]


def _li_sql() -> str:
    sensors = {
        "op_setting_1": "CAST(l_linenumber AS DOUBLE)",
        "op_setting_2": "0.0::DOUBLE",
        "op_setting_3": "100.0::DOUBLE",
        "sensor_01": "518.67::DOUBLE",
        "sensor_02": "l_quantity",
        "sensor_03": "l_extendedprice",
        "sensor_04": "l_discount",
        "sensor_05": "14.62::DOUBLE",
        "sensor_06": "CAST(l_partkey % 13 AS DOUBLE)",
        "sensor_07": "l_tax",
        "sensor_08": "l_quantity + l_discount",
        "sensor_09": "l_extendedprice / 100.0::DOUBLE",
        "sensor_10": "1.3::DOUBLE",
        "sensor_11": "l_extendedprice * (1.0::DOUBLE - l_discount)",
        "sensor_12": "l_quantity * l_tax",
        "sensor_13": "l_tax * 100.0::DOUBLE",
        "sensor_14": "CAST(l_linenumber AS DOUBLE) * 1.5::DOUBLE",
        "sensor_15": "CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END",
        "sensor_16": "0.03::DOUBLE",
        "sensor_17": "CAST(l_orderkey % 97 AS DOUBLE)",
        "sensor_18": "2388.0::DOUBLE",
        "sensor_19": "100.0::DOUBLE",
        "sensor_20": "l_quantity * 0.5::DOUBLE",
        "sensor_21": "l_discount + l_tax",
    }
    cols = ",\n  ".join(f"CAST({sensors[c]} AS DOUBLE) AS {c}" for c in RAW_COLUMNS[2:])
    return f"""SELECT CAST(l_suppkey + 1 AS BIGINT) AS engine_id,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
       l_partkey, l_extendedprice) AS BIGINT) AS cycle,
  {cols}
FROM lineitem"""


def _ev_sql(keep_event_id: bool = False) -> str:
    sensors = ",\n  ".join(f"value + {float(i)}::DOUBLE AS sensor_{i:02d}" for i in range(2, 22))
    extra = ",\n  event_id" if keep_event_id else ""
    return f"""SELECT CAST(user_id + 1 AS BIGINT) AS engine_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS cycle,
  0.0::DOUBLE AS op_setting_1, 0.0::DOUBLE AS op_setting_2, 100.0::DOUBLE AS op_setting_3,
  10.0::DOUBLE AS sensor_01,
  {sensors}{extra}
FROM events"""


def _dirty_sql(keep_line: bool = False) -> str:
    sel = ",\n  ".join(
        {
            "engine_id": "CASE WHEN event_id % 107 = 0 THEN 0::BIGINT ELSE engine_id END AS engine_id",
            "cycle": "CASE WHEN event_id % 109 = 0 THEN -1::BIGINT ELSE cycle END AS cycle",
            "sensor_03": "CASE WHEN event_id % 101 = 0 THEN (CASE WHEN event_id % 2 = 1 THEN 'inf'::DOUBLE "
                         "ELSE '-inf'::DOUBLE END) ELSE sensor_03 END AS sensor_03",
            "sensor_07": "CASE WHEN event_id % 103 = 0 THEN NULL::DOUBLE ELSE sensor_07 END AS sensor_07",
        }.get(c, c)
        for c in RAW_COLUMNS
    )
    line = ", _line" if keep_line else ""
    return f"""SELECT {', '.join(RAW_COLUMNS)}{line} FROM (
  SELECT {sel}, event_id * 2 AS _line FROM ({_ev_sql(True)}) ev
  UNION ALL
  SELECT {sel}, event_id * 2 + 1 AS _line FROM ({_ev_sql(True)}) ev WHERE event_id % 97 = 0
) d"""


_ADAPTER_SQL = {
    "li": _li_sql(),
    "ev": _ev_sql(),
    "dirty": _dirty_sql(),
    "dirty_line": _dirty_sql(keep_line=True),
    "fleet": _fleet_sql(),
}


# Tokens injected by the TOKENS adapter, keyed on cycle % 11.
TOKEN_CASES = ("bad", "1d", None, "NaN", "inf", "-Infinity", "", "1e3")


def token_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOKENS: LI ids and two sensors as *text*, as a dirty file would give them.

    engine_id is written as '<id>.0'; sensor_02 carries junk by cycle % 11:
    0 'bad', 1 '1d', 2 padded with blanks, 3 'NaN', 4 'inf', 5 '-Infinity',
    6 '' and 7 '1e3'; other rows and sensor_03 hold the plain number.
    """
    base = lineitem_trajectories(spark, sf_dir).select(ENGINE, CYCLE, "sensor_02", "sensor_03")
    k = F.col(CYCLE) % 11
    s = F.col("sensor_02").cast("string")
    token = (F.when(k == 2, F.concat(F.lit("  "), s, F.lit(" ")))
             .when(k < 8, F.element_at(F.array(*[F.lit(t) for t in TOKEN_CASES]), (k + 1).cast("int")))
             .otherwise(s))
    return base.select(
        F.concat(F.col(ENGINE).cast("string"), F.lit(".0")).alias(ENGINE),
        F.col(CYCLE).cast("string").alias(CYCLE),
        token.alias("sensor_02"),
        F.col("sensor_03").cast("string").alias("sensor_03"),
    )


def token_expected_sql() -> str:
    """DuckDB: the numbers ``enforce_numeric_types`` must recover from TOKENS."""
    return f"""SELECT engine_id, cycle,
  CASE cycle % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN sensor_02 WHEN 3 THEN NULL
    WHEN 4 THEN 'inf'::DOUBLE WHEN 5 THEN '-inf'::DOUBLE WHEN 6 THEN NULL WHEN 7 THEN 1000.0::DOUBLE
    ELSE sensor_02 END AS sensor_02,
  sensor_03
FROM ({_li_sql()}) t"""


# --------------------------------------------------------------- text files
def text_line(df: DataFrame) -> Column:
    """One whitespace-separated line per row of the 26 raw columns, with the
    TEXT adapter's damage keyed on cycle % 13 (fixed values): 0 sensor_05 is
    'bad'; 1 extra blanks around and between fields; 2 sensor_07 is 'NaN';
    3 the line stops after 20 fields (sensor_16..21 missing)."""
    k = F.col(CYCLE) % 13
    fields = []
    for c in RAW_COLUMNS:
        v = F.col(c).cast("string")
        if c == "sensor_05":
            v = F.when(k == 0, F.lit("bad")).otherwise(v)
        if c == "sensor_07":
            v = F.when(k == 2, F.lit("NaN")).otherwise(v)
        fields.append(v)
    full = F.concat_ws(" ", *fields)
    short = F.concat_ws(" ", *fields[:20])
    spaced = F.concat(F.lit("  "), F.concat_ws("   ", *fields), F.lit("\t "))
    return F.when(k == 3, short).when(k == 1, spaced).otherwise(full)


def write_trajectory_text(df: DataFrame, path: str, blank_lines: bool = True) -> str:
    """Write raw rows as a text 'file' (a directory of part files); rows with
    cycle % 13 = 4 are followed by an extra blank line.

    The rows are computed once, blank lines included, and the parts are
    compressed: such text takes a third of its length on the disk.
    """
    line = text_line(df)
    if blank_lines:
        line = F.concat(line, F.when(F.col(CYCLE) % 13 == 4, "\n   ").otherwise(""))
    # a level at which the text takes little more than at the default one, in a third of its time
    writer = df.select(line.alias("value")).write.mode("overwrite")
    writer.option("compression", "gzip").option("zlib.compress.level", "FOUR").text(path)
    return path


def text_expected_sql() -> str:
    """DuckDB: the rows a parser must recover from the TEXT adapter."""
    sel = []
    for c in RAW_COLUMNS:
        if c == "sensor_05":
            sel.append("CASE WHEN cycle % 13 = 0 THEN NULL ELSE sensor_05 END AS sensor_05")
        elif c == "sensor_07":
            sel.append("CASE WHEN cycle % 13 = 2 THEN NULL ELSE sensor_07 END AS sensor_07")
        elif c in RAW_COLUMNS[20:]:
            sel.append(f"CASE WHEN cycle % 13 = 3 THEN NULL ELSE {c} END AS {c}")
        else:
            sel.append(c)
    return f"SELECT {', '.join(sel)} FROM ({_li_sql()}) t"


def rul_value() -> Column:
    """Fixed rule of the derived RUL targets: cycles cut from the end of an
    engine for the test split, (engine_id % 37) + 10."""
    return (F.col(ENGINE) % 37 + 10).cast("bigint")
