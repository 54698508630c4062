"""Mixing sources to target weights by capped water-filling.

The mix's size is shared among the sources by weight.  A source stops at
``max_epochs`` times its size; what it cannot take is shared again among the
others by weight, until no source is above its cap.  A source's rate is then
so many whole repetitions of every document and a fraction: documents in the
order of a seeded hash get one repetition more until the fraction is met, to
the nearest document.

The cut is found in two steps, so that no source is sorted as a whole: sizes are
summed by source and hash bucket, running sums over the buckets find the one in
which the cut lies, and only inside buckets are documents ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlife.session import materialize

#: Hash buckets of a source.
BUCKETS = 1024


def words(text: str = "text") -> Column:
    """Runs of other characters than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2)) -> DataFrame:
    """``sources`` (one row each) with ``weight``: the given ones in turn, in
    the order of the sources' code points, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    Each round clamps the sources whose share is above their cap and shares the
    rest again; only sums cross the driver.  Shares only grow, so a clamped
    source stays clamped.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"] * share
    level, clamped = 0.0, -1
    while True:
        above = (F.lit(level) * F.col("weight") >= cap) if clamped >= 0 else F.lit(False)
        r = sources.agg(F.count(F.when(above, 1)).alias("k"), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("full"), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("free")).first()
        if r["k"] == clamped:
            break
        clamped = r["k"]
        level = (total - r["full"]) / r["free"] if r["free"] > 0 else float("inf")
    return sources.withColumn("target", F.when(F.lit(level) * F.col("weight") >= cap, cap).otherwise(F.lit(level) * F.col("weight")))


def mix(docs: DataFrame, weigh=cycled_weights, share: float = 1.5, max_epochs: float = 2.0, seed: int = 7, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and taken (words of the document
    in the mix, repetitions counted); every row of ``docs`` stays, the mix is
    the rows with taken > 0, taken / size times each.

    ``weigh`` adds ``weight`` to a table of sources.  Null and empty texts have
    size 0 and are never taken; null sources are one source; a source without
    words has target 0; repeated rows are sampled each for themselves; an empty
    table gives an empty result.  Columns of ``docs`` named like a result
    column are replaced; names that begin with ``__mix_`` are reserved.
    """
    own = ["size", "source_size", "target", "taken"]
    kept = docs.drop(*own)
    at = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("size").cast("string"))), 1, 13), 16, 10).cast("long")
    sized = kept.withColumn("size", words(text)).withColumn("__mix_at", at).withColumn("__mix_bucket", F.shiftright("__mix_at", 52 - (BUCKETS.bit_length() - 1)).cast("int"))
    sums = materialize(sized.groupBy(F.col(source).alias("source"), "__mix_bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    filled = materialize(water_fill(materialize(weigh(sources), "mix-sources"), share, max_epochs), "mix-targets")
    rates = filled.select(
        F.col("source").alias("__mix_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("__mix_whole"))
    rates = rates.withColumn("__mix_need", F.col("target") - F.col("__mix_whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("source").alias("__mix_s"), F.col("__mix_bucket").alias("__mix_b"), F.coalesce(F.sum("words").over(running), F.lit(0)).alias("__mix_before"))
    cuts = before.join(rates, F.col("__mix_s").eqNullSafe(F.col("__mix_source"))).drop("__mix_source")
    placed = sized.join(cuts, F.col(source).eqNullSafe(F.col("__mix_s")) & (F.col("__mix_bucket") == F.col("__mix_b")))
    inside = Window.partitionBy("__mix_s", "__mix_b").orderBy("__mix_at", key, "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("__mix_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    extra = (F.lit(2.0) * ahead + F.col("size") <= F.lit(2.0) * F.col("__mix_need")).cast("long")
    return placed.withColumn("taken", F.col("size") * (F.col("__mix_whole") + extra)).select(*[F.col(c) for c in kept.columns], *own)
