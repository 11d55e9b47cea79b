"""Predictions against observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.selection import SMALL, select_by_weight
from fieldspark.session import materialize

from fieldspark.functions.names import keep_original_year, reported_mean


def match(pred: DataFrame, obs: DataFrame, pixel_converted: bool = True) -> DataFrame:
    """Region, pred, obs of the regions that have both; missing columns are an error.

    pixel_converted picks the mean yield of the pixels, else that of the simulator.
    """
    want = "mean_yield_kg_ha" if pixel_converted else "apsim_mean_yield_estimate_kg_ha"
    if want not in pred.columns:
        raise ValueError(f"predictions have no column {want}")
    if not {"reported_mean_yield_kg_ha", "reported_production_kg"} & set(obs.columns):
        raise ValueError("observations have neither reported_mean_yield_kg_ha nor reported_production_kg")
    take = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c)
    p = pred.select(F.col("region").cast("string").alias("region"), F.col(want).alias("pred"), take(pred, "total_area_ha"))
    o = obs.select(F.col("region").cast("string").alias("region"), take(obs, "reported_mean_yield_kg_ha"), take(obs, "reported_production_kg"))
    both = p.join(o, "region").withColumn("obs", reported_mean(F.col("reported_mean_yield_kg_ha"), F.col("reported_production_kg"), F.col("total_area_ha")))
    return both.select("region", "pred", "obs").dropna(subset=["pred", "obs"])


def metric_columns(pred: Column, obs: Column) -> list[Column]:
    """A8 as aggregates: n, MAPE (a fraction), errors, RMSE, RRMSE in percent, R2, squared correlation.

    Written out as sums, so a constant column gives NULL and not an error. The best linear fit's R2 is
    the squared correlation.
    """
    e = pred - obs
    n = F.count(F.lit(1))
    sse, sst = F.sum(e * e), F.sum(obs * obs) - F.sum(obs) * F.sum(obs) / F.nullif(n, F.lit(0))
    sxx = F.sum(pred * pred) - F.sum(pred) * F.sum(pred) / F.nullif(n, F.lit(0))
    sxy = F.sum(pred * obs) - F.sum(pred) * F.sum(obs) / F.nullif(n, F.lit(0))
    rmse = F.sqrt(F.avg(e * e))
    r2 = F.try_divide(sxy * sxy, F.nullif(sxx, F.lit(0.0)) * F.nullif(sst, F.lit(0.0)))
    return [
        n.alias("n"),
        F.avg(F.abs(F.try_divide(e, F.nullif(obs, F.lit(0.0))))).alias("mape"),
        F.avg(e).alias("mean_error"),
        F.median(e).alias("median_error"),
        F.avg(F.abs(e)).alias("mean_abs_error"),
        F.median(F.abs(e)).alias("median_abs_error"),
        rmse.alias("rmse"),
        F.try_divide(100 * rmse, F.avg(obs)).alias("rrmse"),
        (1 - F.try_divide(sse, F.nullif(sst, F.lit(0.0)))).alias("r2"),
        r2.alias("pearson_r2"),
        r2.alias("best_fit_r2"),
    ]


def metrics(df: DataFrame, keys: list[str] | None = None, pred: str = "pred", obs: str = "obs") -> DataFrame:
    """One row for each key; without keys one row, also of no pairs (n 0, others NULL)."""
    return df.groupBy(*(keys or [])).agg(*metric_columns(F.col(pred), F.col(obs)))


def metrics_rollup(df: DataFrame, keys: list[str], pred: str = "pred", obs: str = "obs") -> DataFrame:
    """For each key and for all together; `level_of_total` counts the keys that are summed over."""
    total = sum((F.grouping(k).cast("int") for k in keys), F.lit(0))
    return df.rollup(*keys).agg(total.alias("level_of_total"), *metric_columns(F.col(pred), F.col(obs)))


def weighted_mean(x: Column, w: Column) -> Column:
    """A6, over rows that have both."""
    both = x.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, x * w)), F.sum(F.when(both, w)))


def weighted_median(df: DataFrame, keys: list[str], value: str, weight: str, out: str = "weighted_median", small: int = SMALL) -> DataFrame:
    """The smallest value up to which half of the weight lies, by refining a histogram of weights (see selection).

    Weights are summed by value first; a group of any number of values is never in one task, only the last
    `small` values around its median are put in order.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(weight).isNotNull()).groupBy(*keys, F.col(value).alias("x")).agg(F.sum(weight).alias("w"))
    found = select_by_weight(materialize(rows, "select-weights"), keys, [F.col("total") / 2], small)
    return found.select(*keys, F.col("x").alias(out))


def aggregate_level(est: DataFrame, level: str) -> DataFrame:
    """Estimates of a level: area-weighted yields and sums; an area of -1 is missing."""
    e = est.withColumn("total_area_ha", F.when(F.col("total_area_ha") >= 0, F.col("total_area_ha")))
    area = F.col("total_area_ha")
    aggs = [weighted_mean(F.col("mean_yield_kg_ha"), area).alias("mean_yield_kg_ha"), F.sum(area).alias("total_area_ha")]
    aggs += [F.sum(c).alias(c) for c in ("total_yield_production_kg", "total_yield_production_ton") if c in est.columns]
    if "apsim_mean_yield_estimate_kg_ha" in est.columns:
        aggs.append(weighted_mean(F.col("apsim_mean_yield_estimate_kg_ha"), area).alias("apsim_mean_yield_estimate_kg_ha"))
    return e.groupBy(level).agg(*aggs).join(weighted_median(e, [level], "mean_yield_kg_ha", "total_area_ha", out="median_yield_kg_ha"), level, "left")


def study_summary(df: DataFrame) -> DataFrame:
    """Area, production and mean yield of a study, estimated and reported."""
    area, kg = F.sum("total_area_ha"), F.sum("total_production_kg")
    has = F.col("reported_production_kg").isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_regions"),
        F.count_if(has).alias("n_reported"),
        area.alias("total_area_ha"),
        kg.alias("total_production_kg"),
        F.try_divide(kg, area).alias("mean_yield_kg_ha"),
        F.sum("reported_production_kg").alias("reported_production_kg"),
        F.try_divide(F.sum("reported_production_kg"), F.sum(F.when(has, F.col("total_area_ha")))).alias("reported_mean_yield_kg_ha"),
    )


def reference_mean(df: DataFrame, ref: str = "reported_mean_yield_kg_ha", area: str = "total_area_ha") -> DataFrame:
    """Area-weighted reference yield over the regions that have one."""
    return df.agg(weighted_mean(F.col(ref), F.col(area)).alias("reference_mean"))


def with_reported_error(df: DataFrame, pred: str, ref: str) -> DataFrame:
    """Reported minus predicted (the other way round than A8), largest first."""
    return df.withColumn("reported_minus_predicted", F.col(ref) - F.col(pred)).orderBy(F.desc_nulls_last("reported_minus_predicted"), "region")


def value_ranges(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Least, greatest and the percentiles used to stretch a display."""
    q = F.percentile(value, F.array(F.lit(0.02), F.lit(0.95), F.lit(0.98)))
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), q.alias("__q")).select(*keys, "low", "high", *[F.col("__q")[i].alias(n) for i, n in enumerate(("p02", "p95", "p98"))])


def distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Number, mean and quartiles."""
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), q.alias("__q")).select(*keys, "n", "mean", *[F.col("__q")[i].alias(n) for i, n in enumerate(("q0", "q25", "q50", "q75", "q100"))])


def years_with_reference(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """All years in one table. A year with reference rows is joined with them (inner); the others stay alone.

    pred(region, <year>, ...), ref(region, <year>, ...): the study's year is `study_year`; a column year is kept as year_original.
    """
    p, r = keep_original_year(pred), keep_original_year(ref, "year_ref_original")
    have = r.select("study_year").distinct()
    matched = p.join(r, ["study_year", "region"])
    alone = p.join(have, "study_year", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True).withColumnRenamed("study_year", "year").orderBy("year", "region")
