"""Simulated growth and scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.series import first_row


def conflicting_rows(report: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """Keys whose rows differ in other columns than the tie-breakers, with those columns' names; missing counts as a value."""
    others = [c for c in report.columns if c not in keys and c not in tie]
    values = [F.size(F.collect_set(F.struct(F.col(c)))).alias(c) for c in others]
    differ = F.filter(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in others]), lambda x: x.isNotNull())
    return report.groupBy(*keys).agg(*values).select(*keys, differ.alias("columns")).where(F.size("columns") > 0)


def resolve_duplicates(report: DataFrame, keys: list[str], ndvi: str | None = None, weight: str | None = None, strict: bool = True) -> DataFrame:
    """Exact repeats go; rows that agree but for NDVI or total weight leave the lowest NDVI, then the highest weight.

    strict: rows of a key that differ otherwise are an error. The check runs over the window that picks
    the row, so the table is shuffled once.
    """
    tie = [c for c in (ndvi, weight) if c]
    others = [c for c in report.columns if c not in keys and c not in tie]
    w = Window.partitionBy(*keys)
    order = ([F.asc_nulls_last(ndvi)] if ndvi else []) + ([F.desc_nulls_last(weight)] if weight else []) or [F.lit(0)]
    mark = F.xxhash64(*[F.col(c) for c in others], *[F.col(c).isNull() for c in others]) if others else F.lit(0)
    rows = report.dropDuplicates().withColumn("__m", mark)
    rows = rows.withColumns({"__r": F.row_number().over(w.orderBy(*order)), "__bad": F.min("__m").over(w) != F.max("__m").over(w)})
    if strict:
        key = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        rows = rows.withColumn("__bad", F.when(F.col("__bad"), F.raise_error(F.concat(F.lit("rows that differ for "), key)).cast("boolean")).otherwise(F.lit(False)))
    return rows.where("__r = 1 and not __bad").drop("__m", "__r", "__bad")


def stepwise_filter(df: DataFrame, steps: list[tuple[int, Column]], out: str = "removed_in_step") -> DataFrame:
    """Number of the first step whose condition a row fails, NULL if it is kept. The conditions are the caller's."""
    removed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in steps]
    return df.withColumn(out, F.coalesce(*removed) if removed else F.lit(None).cast("int"))


def simulation_summary(report: DataFrame, key: str = "SimulationID", day: str = "date", lai: str = "lai", yield_: str = "yield") -> DataFrame:
    """Highest yield, highest leaf area and its first day."""
    top = F.max(F.struct(F.col(lai), -F.unix_date(F.col(day).cast("date"))))
    out = report.groupBy(key).agg(F.max(yield_).alias("max_yield"), F.max(lai).alias("max_lai"), top.alias("__t"))
    return out.withColumn("max_lai_date", F.date_from_unix_date(-F.col("__t.col2"))).drop("__t")


def matched_summary(summary: DataFrame, keys: list[str] | None = None, removed: str = "removed_in_step") -> DataFrame:
    """Matched and all simulations side by side. The conversion factor is an input of its own."""
    m = F.col(removed).isNull()
    only = lambda c: F.when(m, F.col(c))
    return summary.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(m).alias("n_matched"),
        F.avg(only("max_yield")).alias("matched_mean_yield"),
        F.max(only("max_lai")).alias("matched_max_lai"),
        F.max_by("max_lai_date", only("max_lai")).alias("matched_max_lai_date"),
        F.stddev_samp(only("max_yield")).alias("matched_std_yield"),
        F.stddev_samp(only("max_lai")).alias("matched_std_lai"),
        F.max("max_lai").alias("all_max_lai"),
        F.stddev_samp("max_yield").alias("all_std_yield"),
        F.stddev_samp("max_lai").alias("all_std_lai"),
    )


def matched_rows(report: DataFrame, matched: DataFrame, key: str = "SimulationID") -> DataFrame:
    """J4."""
    return report.join(matched.select(key).distinct(), key, "left_semi")


def mean_matched_series(report: DataFrame, matched: DataFrame, day: str, value: str, key: str = "SimulationID") -> DataFrame:
    """Mean series of the matched simulations."""
    return matched_rows(report, matched, key).groupBy(day).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))


def first_matches(matched: DataFrame, n: int, rank: str = "rank") -> DataFrame:
    """T4: the first n in stated order."""
    return matched.orderBy(rank).limit(n)


def latest_scene(items: DataFrame, per_day: bool = False) -> DataFrame:
    """Latest processing of each tile, satellite, orbit and sensing time, or of each tile and day."""
    key = ["tile", "__day"] if per_day else ["tile", "satellite", "orbit", "sensed"]
    items = items.withColumn("__day", F.to_date("sensed"))
    return first_row(items, key, [F.desc("processed"), "id"]).drop("__day")


def usable_tiles(pixels: DataFrame, tile: str = "tile", last_band: str = "b12") -> DataFrame:
    """Q12: tiles of which the last band has any value; semi-join with it."""
    return pixels.groupBy(tile).agg(F.bool_or(F.col(last_band).isNotNull()).alias("__any")).where("__any").select(tile)


def hooked(df: DataFrame, *hooks) -> DataFrame:
    """caller's steps, each DataFrame -> DataFrame, one after another."""
    for h in hooks:
        df = df.transform(h)
    return df
