"""Joins of rows with a table of one row per key.

No side is broadcast by hint: such a table grows with the keys.  Spark
broadcasts it where its measured size allows, and otherwise shuffles both sides
and splits the partitions of hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_per_key(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Attach a one-row-per-key ``table`` to ``rows``."""
    return rows.join(table, keys, how)


def join_per_group(rows: DataFrame, table: DataFrame, groups: list[str]) -> DataFrame:
    """Attach a one-row-per-group ``table`` made from ``rows``; missing group
    values are a group like any other."""
    names = {g: f"__group_{i}" for i, g in enumerate(groups)}
    other = table.select(*[F.col(g).alias(names.get(g, g)) for g in table.columns])
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()])
    return rows.join(other, same, "left").drop(*names.values())
