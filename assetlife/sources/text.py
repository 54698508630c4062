"""Whitespace-separated trajectory text and RUL target files (SRC1-SRC10).

Files are resolved through the Hadoop FileSystem of the session, so the same
code reads local paths, HDFS or object stores.  A "file" may also be a
directory of part files (what Spark writes); its lines are then taken in
part-name order.

Line positions (needed for RUL targets, physical order checks and stable
tie-breaks) are exact along ``(file, split start, row id)``; a single huge file
is numbered by many tasks (``operators.segments``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlife.config import CYCLE, DEFAULT_SPLIT, DEFAULT_VARIANT, ENGINE, RAW_COLUMNS, SEARCH_SUBDIRS
from assetlife.functions import is_plain, string_to_double
from assetlife.operators.segments import HEAVY_KEY_ROWS, sequence
from assetlife.session import compiled_methods, materialize_observed


#: Names of text files and of compressed parts of text files.
TEXT_FILES = "*.{txt,txt.gz}"


class DatasetNotFoundError(FileNotFoundError):
    """Raised when an expected raw file is missing."""


# ------------------------------------------------------------ file system
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(p) if s.isDirectory())


def locate_variant_file(spark: SparkSession, variant: str = DEFAULT_VARIANT, split: str = DEFAULT_SPLIT,
                        raw_dir: str | None = None) -> str:
    """``{split}_{variant}.txt`` in ``raw_dir``, then the usual sub-folders,
    then any direct child folder (by name); first hit wins (SRC1)."""
    if raw_dir is None:
        raise DatasetNotFoundError("raw_dir is required")
    name, base = f"{split}_{variant}.txt", raw_dir.rstrip("/")
    folders = dict.fromkeys([base, *(f"{base}/{d}" for d in SEARCH_SUBDIRS), *(c.rstrip("/") for c in child_dirs(spark, base))])
    hit = next((f"{folder}/{name}" for folder in folders if path_exists(spark, f"{folder}/{name}")), None)
    if hit is None:
        raise DatasetNotFoundError(f"no {name} in any of: {', '.join(folders)}")
    return hit


def list_available_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """All ``*.txt`` files below ``raw_dir`` as (path, length), sorted (SRC8).

    A folder of part files that is named ``*.txt`` is one file, as it is for
    the readers: its length is that of its parts, compressed ones (``.txt.gz``)
    as they lie there.  Only file metadata is read (``binaryFile`` prunes the
    content column).
    """
    schema = "path string, length bigint"
    if not path_exists(spark, raw_dir):
        return spark.createDataFrame([], schema)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", TEXT_FILES).load(raw_dir))
    whole = F.regexp_extract("path", r"^(.*?\.txt)(/.*)?$", 1)
    return (files.select(whole.alias("path"), "length").filter(F.col("path") != "")
            .groupBy("path").agg(F.sum("length").alias("length")).orderBy("path"))


def count_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, n_lines): lines with anything but white space in each listed file."""
    paths = [r["path"] for r in files.select("path").collect()]  # a listing, not data
    if not paths:
        return spark.createDataFrame([], "path string, n_lines bigint")
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("part"))
    whole = F.regexp_extract("part", r"^(.*?\.txt)(/.*)?$", 1)
    return lines.groupBy(whole.alias("path")).agg(F.count_if(_holds_something("value")).alias("n_lines"))


# ------------------------------------------------------------ line order
def _holds_something(value: str) -> Column:
    """Not empty and not white space alone."""
    return F.col(value).rlike(r"\S")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their physical position keys: file, split start, row id."""
    compiled_methods(spark)
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def number_lines(lines: DataFrame, name: str = "_line", keys: list[str] | None = None,
                 max_rows: int = HEAVY_KEY_ROWS) -> DataFrame:
    """Exact 1-based position of every line across the files of ``keys``
    (default: all lines form one sequence, in file-name order).  A sequence
    of more than ``max_rows`` lines is numbered by several tasks."""
    order = [F.col("_file"), F.col("_block"), F.col("_row")]
    if keys:
        return sequence(lines, keys, order, rn_name=name, max_rows=max_rows)
    return sequence(lines.withColumn("_src", F.lit(0)), ["_src"], order, rn_name=name, max_rows=max_rows).drop("_src")


# --------------------------------------------------------------- parsing
def tokens(value: Column) -> Column:
    """Split a line on runs of whitespace, ignoring leading/trailing blanks."""
    runs = F.split(F.btrim(value, F.lit(" \t\n\x0b\f\r")), r"\s+")
    # single blanks alone are found without a regular expression, in a third of the time
    other = reduce(lambda a, b: a | b, [value.contains(c) for c in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.when(other | value.startswith(" ") | value.endswith(" "), runs).otherwise(F.split(value, " "))


def parse_trajectory_lines(lines: DataFrame, keep: list[str] | None = None, on_malformed: str = "error") -> DataFrame:
    """Positional parse of non-blank lines into the 26 raw columns (SRC2, SRC4).

    Short lines pad with NULL; a bad measurement token becomes NULL (pandas
    ``to_numeric`` rules, NaN -> NULL); a missing or bad id raises, as does a
    line with more than 26 fields (``on_malformed='error'``).
    """
    keep = keep or []
    body = lines.filter(_holds_something("value")).withColumn("_tok", tokens(F.col("value")))
    # a line of plain numbers is cast as one array; any other one (a token that is no
    # number, or that the cast does not take) goes token by token, by one expression for all
    numbers = F.when(is_plain("value"), F.col("_tok").try_cast("array<double>"))
    body = body.withColumn("_val", F.coalesce(numbers, F.transform("_tok", string_to_double)))
    width = len(RAW_COLUMNS)
    cols = []
    for i, name in enumerate(RAW_COLUMNS):
        tok, val = F.get(F.col("_tok"), i), F.get(F.col("_val"), i)
        if name in (ENGINE, CYCLE):
            bad = val.isNull() | (F.abs(val) == F.lit(float("inf")))
            checked = F.when(bad, F.raise_error(F.concat(F.lit(f"invalid {name} token: "),
                                                         F.coalesce(tok, F.lit("<missing>"))))).otherwise(val)
            if name == ENGINE and on_malformed == "error":
                # the width check lives inside a kept column so it is never pruned
                checked = F.when(F.size("_tok") > width, F.raise_error(
                    F.concat(F.lit("malformed line (more than 26 fields): "), F.col("value")))).otherwise(checked)
            val = checked.cast("bigint")
        cols.append(val.alias(name))
    return body.select(*keep, *cols)


def check_columns_present(rows: int, missing: dict[str, int]) -> None:
    """A schema column without any value raises ``ValueError``, as a column that
    is not there would; an empty input passes (the quality gate reports it)."""
    absent = [c for c in RAW_COLUMNS if rows and missing.get(c) == rows]
    if absent:
        raise ValueError(f"no line holds a value for: {', '.join(absent)}")


def missing_aggregates() -> list[Column]:
    """Rows and missing values of every schema column, to be observed or aggregated."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"miss__{c}") for c in RAW_COLUMNS]]


def load_dataset_variant(spark: SparkSession, variant: str = DEFAULT_VARIANT, split: str = DEFAULT_SPLIT,
                         raw_dir: str | None = None, provenance: bool = False, line_order: bool = False,
                         check_columns: bool = True) -> DataFrame:
    """Load one variant/split as the typed 26-column frame (SRC2-SRC5).

    ``check_columns`` writes the parsed rows to the checkpoint folder, where the
    values of every column are counted on the way, and reads them from there: the
    text is parsed once.  A schema column without any value raises ``ValueError``
    (as a missing column would).  ``provenance`` adds
    variant, split and source_path; ``line_order`` keeps ``_file, _block,
    _row`` for physical-order checks and stable tie-breaks.
    """
    path = locate_variant_file(spark, variant, split, raw_dir)
    lines = read_lines(spark, path)
    keep = ["_file", "_block", "_row"] if line_order else []
    parsed = parse_trajectory_lines(lines, keep=keep + (["_file"] if provenance and not line_order else []))
    if check_columns:
        parsed, seen = materialize_observed(parsed, missing_aggregates(), "parsed")
        check_columns_present(seen["rows"], {c: seen[f"miss__{c}"] for c in RAW_COLUMNS})
    if provenance:
        parsed = parsed.withColumns({"variant": F.lit(variant), "split": F.lit(split), "source_path": F.col("_file")})
        if not line_order:
            parsed = parsed.drop("_file")
    return parsed


def load_raw_data(spark: SparkSession, variant: str = DEFAULT_VARIANT, split: str = DEFAULT_SPLIT,
                  raw_dir: str | None = None, **kw) -> DataFrame:
    """Primary load wrapper (SRC7)."""
    return load_dataset_variant(spark, variant, split, raw_dir, **kw)


def load_variants(spark: SparkSession, raw_dir: str, variants: list[str] | None = None,
                  splits: list[str] | None = None, pairs: list[tuple[str, str]] | None = None, line_order: bool = False) -> DataFrame:
    """Several variants/splits in one frame keyed by (variant, split, engine_id):
    one text scan over all located files; provenance from the file name (SRC5).
    ``pairs`` lists (variant, split) explicitly, else all combinations;
    ``line_order`` keeps ``_file, _block, _row``."""
    pairs = pairs or [(v, s) for v in (variants or [DEFAULT_VARIANT]) for s in (splits or [DEFAULT_SPLIT])]
    lines = read_lines(spark, [locate_variant_file(spark, v, s, raw_dir) for v, s in pairs])
    places = ["_file", "_block", "_row"]
    parsed = parse_trajectory_lines(lines, keep=places)
    name = F.regexp_extract(F.col("_file"), r"(train|test|RUL)_(FD\d+)\.txt", 0)
    return parsed.select(
        F.regexp_extract(name, r"_(FD\d+)\.txt$", 1).alias("variant"),
        F.regexp_extract(name, r"^(train|test|RUL)_", 1).alias("split"),
        *RAW_COLUMNS, F.col("_file").alias("source_path"), *(places if line_order else []))


def load_rul_targets(spark: SparkSession, variant: str = DEFAULT_VARIANT, raw_dir: str | None = None,
                     path: str | None = None) -> DataFrame:
    """``RUL_{variant}.txt``: engine_id = 1-based position among non-blank
    lines, rul = the number on the line as DOUBLE (SRC6)."""
    path = path or locate_variant_file(spark, variant, "RUL", raw_dir)
    lines = read_lines(spark, path).filter(_holds_something("value"))
    numbered = number_lines(lines, name=ENGINE)
    return numbered.select(F.col(ENGINE).cast("bigint").alias(ENGINE),
                           string_to_double(F.get(tokens(F.col("value")), 0)).alias("rul"))


def load_features_table(spark: SparkSession, parquet_path: str, table_name: str = "sensor_features") -> DataFrame:
    """Register a Parquet feature table as a temp view (SRC9)."""
    if not path_exists(spark, parquet_path):
        raise FileNotFoundError(f"there is no feature table at {parquet_path}")
    df = spark.read.parquet(parquet_path)
    df.createOrReplaceTempView(table_name)
    return df


def attach_official_rul(features: DataFrame, targets: DataFrame, key_cols: list[str] | None = None,
                        remaining: str | None = None) -> DataFrame:
    """Test-split labels: ``rul = target + max_cycle(engine) - cycle`` (SRC10).

    Every row stays; an engine without a target has a NULL ``rul``.
    ``remaining`` names a column that holds ``max_cycle(engine) - cycle``
    already: the targets, one row per engine, are then all that the rows meet,
    and rows that lie by engine stay where they are.  Without it the per-engine
    maximum and the targets are combined first and then attached to the rows.
    """
    from assetlife.operators.joins import join_per_key

    keys = key_cols or [ENGINE]
    per_engine = targets.select(*keys, F.col("rul").alias("_target"))
    if remaining is not None:
        joined = join_per_key(features.withColumnRenamed(remaining, "_left"), per_engine, keys, "left")
        return joined.withColumn("rul", F.col("_target") + F.col("_left").cast("double")).drop("_target", "_left")
    last = features.groupBy(*keys).agg(F.max(CYCLE).alias("_max_cycle"))
    per_engine = join_per_key(last, per_engine, keys, "left")
    joined = join_per_key(features.drop("rul"), per_engine, keys, "left")
    return joined.withColumn("rul", F.col("_target") + (F.col("_max_cycle") - F.col(CYCLE)).cast("double")) \
        .drop("_target", "_max_cycle")
