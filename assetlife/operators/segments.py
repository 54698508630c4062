"""Ordered sequences: per-key row numbers, row-frame windows and key statistics.

Keys of at most ``max_rows`` rows are plain windows over the plain key
columns: one shuffle, one sort, and a filter on a key reaches the scan.

A key with more rows than that must not meet in one task.  One aggregate of
the key columns finds such keys; their rows (and only theirs) are laid out by
range over (key, order) in as many partitions as the session shuffles to, and
written with their place.  A *segment* is a key's part of one partition, so
there are at most (keys + partitions) segments, whatever the order's values:

1. the segment table (one row per segment, written) gives every segment its
   first place, the number of rows of its key before it, key statistics and its
   neighbours; a row's number follows from its place;
2. ``main``: window columns per (key, segment), the only step after the layout
   that shuffles rows, and only where there are window columns;
3. rows whose frame reaches past their segment are recomputed from a small
   set: themselves, their context and the ``lookback`` / ``lookahead`` rows
   copied from neighbouring segments.

The written place is a total order, so evaluating a row twice gives the same
result, also among equal order keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from assetlife.session import materialize

RN = "_rn"
_KEY, _SEG, _AT, _FIRST, _LRN, _N, _BEFORE, _EMIT = "_key", "_seg", "_at", "_first", "_lrn", "_n", "_before", "_emit"

#: Rows of one key that a single task may hold.
HEAVY_KEY_ROWS = 1 << 20

ColumnsFn = Callable[[WindowSpec], dict[str, Column]]

_STAT_FN = {"max": (F.max, F.max), "min": (F.min, F.min), "sum": (F.sum, F.sum), "count": (F.count, F.sum)}


def sequence(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    columns: ColumnsFn | None = None,
    lookback: int = 0,
    lookahead: int = 0,
    key_stats: dict[str, tuple[str, Column]] | None = None,
    rn_name: str | None = None,
    max_rows: int = HEAVY_KEY_ROWS,
    order_only: list[str] | None = None,
    ranged: bool = False,
) -> DataFrame:
    """Add per-key window columns over ordered rows without oversized tasks.

    ``columns(w)`` returns ``{name: expression}`` built with the window spec
    ``w``; frames may look at most ``lookback`` rows back and ``lookahead``
    rows ahead.  ``key_stats`` maps a name to ``(fn, column)`` with fn in
    max/min/sum/count.  ``rn_name`` adds the per-key row number.  ``order``
    should be total (see ``engine_sequence``); missing values come last, and
    NULL keys are keys like any other.  Columns that ``order_only`` names are
    read by ``order`` alone and not returned.  ``ranged`` deals the keys by
    range, for callers that sort by them next and need no second shuffle then.
    """
    columns = columns or (lambda w: {})
    key_stats, order_only = key_stats or {}, order_only or []
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).filter(F.col("_cnt") > max_rows).select(*keys)
    if heavy.isEmpty():
        by_range = df.repartitionByRange(*[F.col(k) for k in keys]) if ranged else df
        return _plain(by_range, keys, order, columns, key_stats, rn_name).drop(*order_only)
    heavy = materialize(heavy, "heavy-keys")
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(heavy[k]) for k in keys])
    light = _plain(df.join(heavy, same, "left_anti"), keys, order, columns, key_stats, rn_name).drop(*order_only)
    split = _split(df.join(heavy, same, "left_semi"), keys, order, columns, lookback, lookahead, key_stats, rn_name, order_only)
    return light.unionByName(split)


def _plain(df: DataFrame, keys, order, columns, key_stats, rn_name) -> DataFrame:
    whole = Window.partitionBy(*keys)
    w = whole.orderBy(*[o.asc_nulls_last() for o in order])
    added = {**columns(w), **{name: _STAT_FN[fn][0](c).over(whole) for name, (fn, c) in key_stats.items()}}
    if rn_name:
        added[rn_name] = F.row_number().over(w).cast("long")
    return df.select("*", *[c.alias(n) for n, c in added.items()])


def _lay_out(df: DataFrame, keys: list[str], order: list[Column], order_only: list[str] | None = None) -> DataFrame:
    """The rows with their place ``_at``: partition number, then row in it."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [F.col(k).asc_nulls_last() for k in keys] + [o.asc_nulls_last() for o in order]
    laid = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return materialize(laid.withColumn(_AT, F.monotonically_increasing_id()).drop(*(order_only or [])), "segments")


def _split(df: DataFrame, keys, order, columns, lookback, lookahead, key_stats, rn_name, order_only) -> DataFrame:
    data_cols = [c for c in df.columns if c not in order_only]
    # structs group and join NULL keys like any value
    key_struct = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    base = _lay_out(df, keys, order, order_only).select("*", key_struct.alias(_KEY), F.shiftright(_AT, 33).alias(_SEG))

    w_main = Window.partitionBy(_KEY, _SEG).orderBy(_AT)
    main_cols = columns(w_main)
    main = base.select(*data_cols, _KEY, _SEG, _AT, *[c.alias(n) for n, c in main_cols.items()])

    # the rows of a segment lie side by side, so a row's number is its place less the first one's
    seg = base.groupBy(_KEY, _SEG).agg(F.count(F.lit(1)).alias(_N), F.min(_AT).alias(_FIRST),
                                       *[_STAT_FN[fn][0](c).alias(name) for name, (fn, c) in key_stats.items()])
    w_key = Window.partitionBy(_KEY)
    w_seg = w_key.orderBy(_SEG)
    up_to = lambda last: F.coalesce(F.sum(_N).over(w_seg.rowsBetween(Window.unboundedPreceding, last)), F.lit(0))
    seg_out = {_BEFORE: up_to(-1), **{name: _STAT_FN[fn][1](name).over(w_key) for name, (fn, _) in key_stats.items()}}
    if lookback:
        seg_out["_next"] = F.array(*[F.struct(F.lead(_SEG, i).over(w_seg).alias("s"), up_to(i - 1).alias("b"))
                                     for i in range(1, lookback + 1)])
    if lookahead:
        seg_out["_prev"] = F.array(*[F.struct(F.lag(_SEG, i).over(w_seg).alias("s"), up_to(-i).alias("e"))
                                     for i in range(1, lookahead + 1)])
    # written: its size is known then, and it is no longer than the keys and partitions
    met = main.join(materialize(seg.withColumns(seg_out), "segment-table"), [_KEY, _SEG])
    main = met.withColumn(_LRN, F.col(_AT) - F.col(_FIRST) + 1).withColumn(RN, F.col(_BEFORE) + F.col(_LRN))

    stat_names = list(key_stats)
    out_names = [*data_cols, *main_cols, *stat_names, *([RN] if rn_name else [])]
    if lookback or lookahead:
        out = _with_borders(main, columns, data_cols, stat_names, out_names, lookback, lookahead)
    else:
        out = main.select(*out_names)
    return out.withColumnRenamed(RN, rn_name) if rn_name and rn_name != RN else out


def _with_borders(main: DataFrame, columns, data_cols, stat_names, out_names, lookback: int, lookahead: int) -> DataFrame:
    lrn, n = F.col(_LRN), F.col(_N)
    carry = [*data_cols, _KEY, RN, *stat_names]
    at_edge = (lrn <= lookback) | (lrn > n - lookahead)
    near = main.filter((lrn <= lookback + lookahead) | (lrn > n - lookahead - lookback))
    pieces = [near.select(*carry, _SEG, at_edge.alias(_EMIT))]
    if lookback:
        copies = main.filter(lrn > n - lookback).select(*carry, F.explode("_next").alias("_t"))
        pieces.append(copies.filter(F.col("_t.s").isNotNull() & (F.col("_t.b") - F.col(RN) < lookback))
                      .select(*carry, F.col("_t.s").alias(_SEG), F.lit(False).alias(_EMIT)))
    if lookahead:
        copies = main.filter(lrn <= lookahead).select(*carry, F.explode("_prev").alias("_t"))
        pieces.append(copies.filter(F.col("_t.s").isNotNull() & (F.col(RN) - F.col("_t.e") <= lookahead))
                      .select(*carry, F.col("_t.s").alias(_SEG), F.lit(False).alias(_EMIT)))
    w = Window.partitionBy(_KEY, _SEG).orderBy(RN)
    border = reduce(DataFrame.unionByName, pieces)
    border = border.select(*carry, _EMIT, *[c.alias(name) for name, c in columns(w).items()]).filter(_EMIT)
    return main.filter(~at_edge).select(*out_names).unionByName(border.select(*out_names))


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], name: str = RN,
                max_rows: int = HEAVY_KEY_ROWS) -> DataFrame:
    """Per-key ``row_number`` along ``order`` without an oversized task."""
    return sequence(df, keys, order, rn_name=name, max_rows=max_rows)
