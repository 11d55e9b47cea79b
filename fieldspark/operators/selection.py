"""Exact medians, plain and weighted, of groups of any size.

The value up to which a given weight lies is found by refining a histogram: the values of a group are
counted into equal bins between its least and greatest, the bin in which the weight is reached becomes the
new range, and so on until few values are left in it; only those are put in order. Every step is an
aggregation by group and bin, which is combined before the shuffle, so no task holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from fieldspark.session import materialize

SMALL, BINS = 100_000, 4096
BROADCAST_ROWS = 100_000
#: Of a sum of doubles: what its order may change. Counts are compared as they are.
SLACK = 1e-12


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"__t_{k}"])
    return on


def _bounded(df: DataFrame) -> DataFrame:
    """df, broadcast if counting shows that it is small; else its rows meet the others by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def select_by_weight(values: DataFrame, keys: list[str], targets: list[Column], small: int = SMALL, bins: int = BINS) -> DataFrame:
    """keys, target, x: the smallest value up to which the weight of a group reaches each target.

    values(keys, x, w), read several times, has each finite value of a group once, with its weight; targets
    are expressions of `total`, the group's weight. A bin holds at most a group's share of the values between
    its ends, and the least and greatest value are never in one bin, so the range shrinks every time. Sums of
    doubles that miss the target by their rounding alone have reached it, so that the order of rows decides nothing.
    """
    state = values.groupBy(*keys).agg(F.sum("w").alias("total"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
    state = state.withColumn("target", F.explode(F.array_distinct(F.array(*targets)))).withColumn("below", F.col("total") * 0)
    state = state.select(*[F.col(k).alias(f"__t_{k}") for k in keys], "target", "lo", "hi", "below", "n")
    names = [f"__t_{k}" for k in keys]
    enough = F.col("target") * (1 - SLACK) if isinstance(values.schema["w"].dataType, (DoubleType, FloatType)) else F.col("target")
    while True:
        state = materialize(state, "select-ranges")
        wide = state.where((F.col("n") > small) & (F.col("lo") < F.col("hi")))
        if not wide.take(1):
            break
        part = _bounded(wide.withColumnRenamed("n", "held"))
        near = values.join(part, _same(values, part, keys) & F.col("x").between(F.col("lo"), F.col("hi")))
        share = F.col("x") / (F.col("hi") - F.col("lo")) - F.col("lo") / (F.col("hi") - F.col("lo"))
        place = F.when(F.col("x") == F.col("lo"), 0).when(F.col("x") == F.col("hi"), bins - 1).otherwise(F.least(F.greatest(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)))
        counts = near.groupBy(*names, "target", "below", place.alias("bin")).agg(F.sum("w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(*names, "target").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("reached", F.col("below") + F.sum("w").over(upto)).where((F.col("reached") >= enough) | (F.col("bin") == bins - 1))
        first = counts.groupBy(*names, "target").agg(F.min(F.struct("bin", "lo", "hi", (F.col("reached") - F.col("w")).alias("below"), "n")).alias("s"))
        state = first.select(*names, "target", "s.lo", "s.hi", "s.below", "s.n").unionByName(state.where((F.col("n") <= small) | (F.col("lo") >= F.col("hi"))))
    part = _bounded(state)
    near = values.join(part, _same(values, part, keys) & F.col("x").between(F.col("lo"), F.col("hi")))
    upto = Window.partitionBy(*names, "target").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = near.withColumn("reached", F.col("below") + F.sum("w").over(upto)).where((F.col("reached") >= enough) | (F.col("x") == F.col("hi")))
    return reached.groupBy(*names, "target").agg(F.min("x").alias("x")).select(*[F.col(f"__t_{k}").alias(k) for k in keys], "target", "x")


def medians(df: DataFrame, keys: list[str], columns: dict[str, Column], small: int = SMALL) -> DataFrame:
    """keys and, for each of columns, the median of its values in the group, null without any; groups of any size."""
    parts = [df.select(*keys, F.lit(name).alias("__name"), c.cast("double").alias("x")) for name, c in columns.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = materialize(rows.where(F.col("x").isNotNull()).groupBy(*keys, "__name", "x").agg(F.count(F.lit(1)).alias("w")), "select-values")
    middle = [F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1]
    found = select_by_weight(rows, [*keys, "__name"], middle, small).groupBy(*keys, "__name").agg(F.avg("x").alias("x"))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == name, F.col("x"))).alias(name) for name in columns])


def largest_group(df: DataFrame, keys: list[str]) -> int:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
