from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assetlife.config import RAW_COLUMNS
from assetlife.session import scratch_path
from assetlife.sources import text as src


def _mini_lines(extra_blank: bool = False) -> list[str]:
    rows = []
    for engine in (1, 2):
        for cycle in (1, 2, 3):
            vals = [engine, cycle, 0.0, 0.0, 100.0, *[float(i + engine + cycle) for i in range(21)]]
            rows.append(" ".join(str(x) for x in vals) + "  ")
            if extra_blank:
                rows += ["   ", "\t", ""]
    return rows


def _write(spark, rel: str, lines: list[str]) -> str:
    base = scratch_path(spark, "raw-test")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/{rel}")
    return base


def test_load_mini_file(spark):
    base = _write(spark, "CMAPSSData/train_FD001.txt", _mini_lines(extra_blank=True))
    df = src.load_raw_data(spark, "FD001", "train", base)
    assert df.columns == list(RAW_COLUMNS)
    rows = df.orderBy("engine_id", "cycle").collect()
    assert len(rows) == 6
    assert [r.engine_id for r in rows] == [1, 1, 1, 2, 2, 2]
    assert min(r.cycle for r in rows) == 1
    assert dict(df.dtypes)["sensor_01"] == "double"
    assert rows[0].sensor_01 == 2.0


def test_missing_file_raises(spark):
    base = scratch_path(spark, "empty")
    with pytest.raises(src.DatasetNotFoundError):
        src.locate_variant_file(spark, "FD001", "train", base)


def test_search_order_prefers_base_then_known_folders(spark):
    base = _write(spark, "zzz/train_FD001.txt", _mini_lines())
    assert src.locate_variant_file(spark, "FD001", "train", base).endswith("zzz/train_FD001.txt")
    spark.createDataFrame([("1 1",)], "value string").write.text(f"{base}/cmapss/train_FD001.txt")
    assert src.locate_variant_file(spark, "FD001", "train", base).endswith("cmapss/train_FD001.txt")


def test_bad_tokens_short_lines_and_nan(spark):
    lines = ["1 1 0 0 100 " + " ".join(["1.5"] * 21),
             "1 2 0 0 100 bad 1d NaN inf 1e3 " + " ".join(["2"] * 14),
             "1 3 0 0 100 7"]
    base = _write(spark, "train_FD001.txt", lines)
    df = src.load_raw_data(spark, "FD001", "train", base, check_columns=False)
    r = {row.cycle: row for row in df.collect()}
    assert r[2].sensor_01 is None and r[2].sensor_02 is None and r[2].sensor_03 is None
    assert r[2].sensor_04 == float("inf") and r[2].sensor_05 == 1000.0
    assert r[3].sensor_01 == 7.0 and r[3].sensor_02 is None


def test_all_missing_column_raises(spark):
    lines = [" ".join(["1", str(c)] + ["1.0"] * 23) for c in (1, 2)]
    base = _write(spark, "train_FD001.txt", lines)
    with pytest.raises(ValueError, match="sensor_21"):
        src.load_raw_data(spark, "FD001", "train", base)


def test_malformed_line_raises(spark):
    base = _write(spark, "train_FD001.txt", [" ".join(["1"] * 27)])
    with pytest.raises(Exception, match="more than 26"):
        src.load_raw_data(spark, "FD001", "train", base, check_columns=False).collect()


def test_rul_targets_follow_line_positions(spark):
    base = _write(spark, "RUL_FD001.txt", ["112", "", "98", " \t ", "\t", "69.5"])
    df = src.load_rul_targets(spark, "FD001", base)
    assert [tuple(r) for r in df.orderBy("engine_id").collect()] == [(1, 112.0), (2, 98.0), (3, 69.5)]


def test_list_available_files(spark):
    base = _write(spark, "CMAPSSData/train_FD001.txt", _mini_lines())
    files = [r.path for r in src.list_available_files(spark, base).collect()]
    assert files and all(p.endswith(".txt") for p in files)
    assert src.list_available_files(spark, base + "/nope").count() == 0


def test_not_found_names_every_folder(spark):
    base = _write(spark, "zzz/other.txt", ["x"])
    with pytest.raises(src.DatasetNotFoundError) as error:
        src.locate_variant_file(spark, "FD001", "train", base)
    for folder in (base, "CMAPSSData", "CMaps", "cmapss", "zzz"):
        assert folder in str(error.value)


def test_lines_of_one_file_are_numbered_by_many_tasks(spark):
    base = _write(spark, "RUL_FD001.txt", [str(i) for i in range(500)])
    lines = src.read_lines(spark, f"{base}/RUL_FD001.txt").repartition(7)
    for most in (20, 1000):
        got = src.number_lines(lines, max_rows=most).select("value", "_line").collect()
        assert sorted((r["_line"], int(r["value"])) for r in got) == [(i + 1, i) for i in range(500)]


def test_engines_without_target_keep_their_rows(spark):
    rows = spark.createDataFrame([(e, c) for e in (1, 2, 3) for c in (1, 2)], "engine_id bigint, cycle bigint")
    targets = spark.createDataFrame([(1, 10.0), (3, 5.0), (9, 1.0)], "engine_id bigint, rul double")
    got = sorted(tuple(r) for r in src.attach_official_rul(rows, targets).fillna(-1.0).collect())
    assert got == [(1, 1, 11.0), (1, 2, 10.0), (2, 1, -1.0), (2, 2, -1.0), (3, 1, 6.0), (3, 2, 5.0)]


def test_lines_of_plain_numbers_and_others_parse_alike(spark):
    """Lines cast as one array and lines that go token by token give the numbers of their tokens."""
    tails = ["+1.5 -2. .5 1e3 1E-2", "- 1e . +-1 1.5", "1e999 00012 -0.0 1 2", "bad 1d NaN inf 0x1"]
    lines = [f"1 {i} 0 0 100 {t} " + " ".join(["2"] * 16) for i, t in enumerate(tails)] + ["\t1   4\t0 0 100 7 \x0b8  "]
    base = _write(spark, "train_FD001.txt", lines)
    df = src.load_raw_data(spark, "FD001", "train", base, check_columns=False)
    got = {r["cycle"]: [r[f"sensor_0{i}"] for i in range(1, 6)] for r in df.collect()}
    inf = float("inf")
    assert got == {0: [1.5, -2.0, 0.5, 1000.0, 0.01], 1: [None, None, None, None, 1.5], 2: [inf, 12.0, -0.0, 1.0, 2.0],
                   3: [None, None, None, inf, None], 4: [7.0, 8.0, None, None, None]}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "[^0-9eE" not in plan and "try_cast(_tok" in plan


def test_stages_are_methods_that_the_jvm_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    src.read_lines(spark, _write(spark, "train_FD001.txt", _mini_lines()))
    assert spark.conf.get(key) == "8000"
    spark.conf.set(key, "20000")
    src.read_lines(spark, _write(spark, "train_FD001.txt", _mini_lines()))
    assert spark.conf.get(key) == "20000"
    spark.conf.unset(key)


def test_feature_tables_are_written_by_zstd(spark):
    import os

    from pyspark.sql import functions as F

    from assetlife import sinks
    from assetlife.session import scratch_path, write_observed
    first, second = scratch_path(spark, "written"), scratch_path(spark, "observed")
    sinks.write_parquet(spark.range(5), first)
    assert write_observed(spark.range(5), second, [F.count("id").alias("n")]) == {"n": 5}
    for path in (first, second):
        parts = [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]
        assert parts and all(f.endswith(".zstd.parquet") for f in parts)


def test_text_is_written_once_and_listed_compressed(spark, tmp_path):
    """Blank lines come in the same pass as the rows, parts are compressed and still one file of a listing."""
    columns = [f"cast(id % 97 + {i} as double) / 7 as {c}" for i, c in enumerate(RAW_COLUMNS[2:])]
    rows = spark.range(4000).selectExpr("1 + id % 3 as engine_id", "id as cycle", *columns)
    from assetlife.sources.adapters import text_line, write_trajectory_text

    base = str(tmp_path)
    write_trajectory_text(rows, f"{base}/train_FD001.txt")
    parts = list(tmp_path.glob("train_FD001.txt/part-*"))
    assert parts and all(p.name.endswith(".txt.gz") for p in parts)
    whole = rows.select(F.sum(F.length(text_line(rows)))).first()[0]
    listed = src.list_available_files(spark, base)
    spark.createDataFrame([("1 1",)], "value string").write.option("compression", "gzip").text(f"{base}/notes")
    assert [(r.path.rsplit("/", 1)[-1], 0 < r.length < whole / 2) for r in src.list_available_files(spark, base).collect()] == [("train_FD001.txt", True)]
    assert [r.n_lines for r in src.count_lines(spark, listed).collect()] == [4000]
    assert spark.read.text(f"{base}/train_FD001.txt").where("trim(value) = ''").count() == rows.where("cycle % 13 = 4").count()
    read = src.load_raw_data(spark, "FD001", "train", base)
    assert read.select("engine_id", "cycle", "sensor_02").exceptAll(rows.select("engine_id", "cycle", "sensor_02")).isEmpty()


def test_tokens_of_odd_blanks(spark):
    df = spark.createDataFrame([(x,) for x in ("\t1 2\x0b3\f", " 1\r\n2", "1", "", "a\u00a0b 1", None)], "value string")
    assert [r[0] for r in df.select(src.tokens(F.col("value"))).collect()] == [["1", "2", "3"], ["1", "2"], ["1"], [""], ["a\u00a0b", "1"], None]


def test_targets_meet_rows_where_they_lie(spark):
    """With the cycles that are left as a column, the result is the same and rows by engine are not shuffled again."""
    rows = spark.createDataFrame([(e, c, 4 - c) for e in (1, 2, 3) for c in (1, 2, 4)], "engine_id bigint, cycle bigint, rul bigint")
    targets = spark.createDataFrame([(1, 10.0), (3, 5.0)], "engine_id bigint, rul double")
    plain = src.attach_official_rul(rows, targets)
    given = src.attach_official_rul(rows, targets, remaining="rul")
    assert given.columns == plain.columns and sorted(map(str, given.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = src.attach_official_rul(rows.repartition(8, "engine_id"), targets, remaining="rul")
        assert str(dealt._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_split_and_told_plain_without_costly_expressions(spark):
    """A line of single blanks is split by the blank alone, and no line is struck out character by character to see
    whether it is plain; both give what they gave, odd white space and line ends included."""
    import re

    from assetlife.functions import is_plain

    odd = ["1 2 3", " 1 2", "1 2 ", "1  2", "1\t2", "1\x0b2\f3", "1\r2", "", " ", "1 2", "1 ", "12\n", "1 2", "1e5 -2.E+3", "1d", "NaN", "1 " * 200_000 + "1", None]
    df = spark.createDataFrame([(v,) for v in odd], "value string")
    got = df.select("value", src.tokens(F.col("value")).alias("t"), is_plain("value").alias("p")).collect()
    ascii_space = " \t\n\x0b\f\r"
    assert [r["t"] for r in got] == [None if v is None else re.split(r"[ \t\n\x0b\f\r]+", v.strip(ascii_space)) for v in odd]
    assert [r["p"] for r in got] == [None if v is None else set(v) <= set("0123456789eE+-." + ascii_space) for v in odd]
    plan = src.parse_trajectory_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and re.search(r"split\(value#\d+,  , -1\)", plan)
