"""Leaf area by region and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions import dates
from fieldspark.functions.pixels import adjust_for_crop, drop_negative
from fieldspark.operators.selection import SMALL, largest_group, medians
from fieldspark.operators.series import akima_filled, dealt_out, every_day_of, gathered, smoothed
from fieldspark.session import materialize

STATS = ["lai_mean", "lai_median", "lai_std", "lai_mean_adj", "lai_median_adj", "lai_std_adj"]


def stats(value: Column, name: str, exact: bool = True) -> list[Column]:
    """A1: mean, median, population standard deviation. exact=False: the median by quantile sketch, in bounded memory."""
    median = F.median(value) if exact else F.percentile_approx(value, 0.5, 10_000)
    return [F.avg(value).alias(f"{name}_mean"), median.alias(f"{name}_median"), F.stddev_pop(value).alias(f"{name}_std")]


def missing_share(value: Column, counted: Column) -> Column:
    """A2: percent of counted pixels without a value, 0 without any counted."""
    return F.coalesce(F.try_divide(100.0 * F.count_if(value.isNull() & counted), F.count_if(counted)), F.lit(0.0))


def _group_stats(rows: DataFrame, keys: list[str], crop: str | None, exact: bool, small: int, counts: list[Column]) -> DataFrame:
    """Raw and adjusted statistics of v by keys, then counts. A task sorts up to `small` pixels of a group for its
    median; where a group has more, all medians are found by refining histograms, with the same result."""
    value = drop_negative(F.col("v"))
    adjusted = adjust_for_crop(value, crop)
    every = [*stats(value, "lai", exact), *[c.alias(n) for c, n in zip(stats(adjusted, "x", exact), STATS[3:])]]
    if not exact or largest_group(rows, keys) <= small:
        return rows.groupBy(*keys).agg(*every, *counts)
    out = rows.groupBy(*keys).agg(*[c for k, c in enumerate(every) if k not in (1, 4)], *counts)
    found = medians(rows, keys, {"lai_median": value, "lai_median_adj": adjusted}, small)
    found = found.select(*[F.col(k).alias(f"__m_{k}") for k in keys], "lai_median", "lai_median_adj")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__m_{k}"))
    both = out.join(found, on, "left")
    return both.select(*keys, *STATS, *[c for c in out.columns if c not in (*keys, *STATS)])


def daily_stats(cells: DataFrame, keys: list[str], crop: str | None = None, exact: bool = True, small: int = SMALL) -> DataFrame:
    """A1, A2, A36 over cells(keys..., v, m): raw and adjusted statistics, valid pixels, cloud/snow percent.

    For zones, keys hold the zone's id or nothing but the date.
    """
    value = drop_negative(F.col("v"))
    counts = [F.count(value).alias("n_pixels"), missing_share(value, F.col("m") == 1).alias("cloud_pct")]
    return _group_stats(cells, keys, crop, exact, small, counts)


def reject_cloudy(daily: DataFrame, threshold: float) -> DataFrame:
    """a day with too many missing pixels or none valid keeps its row and percentage, without statistics."""
    bad = (F.col("cloud_pct") > threshold * 100) | (F.col("n_pixels") == 0)
    return daily.withColumns({c: F.when(~bad, F.col(c)) for c in STATS if c in daily.columns})


def lai_series(cells: DataFrame, region: str = "region", cloud: float = 0.5, crop: str | None = None) -> DataFrame:
    """A1 -> F4 -> W11 -> W3 -> W4: one row for each region and day. All six statistics are smoothed; means and
    medians are gap-filled, smoothed and unsmoothed. A region's days are gathered once."""
    daily = reject_cloudy(daily_stats(cells, [region, "date"], crop), cloud)
    names = ["lai_mean", "lai_median", "lai_mean_adj", "lai_median_adj"]
    series = smoothed(every_day_of(gathered(daily, [region], "date"), [region], "date"), STATS)
    return dealt_out(akima_filled(series, "date", [*names, *[f"{c} Unsmoothed" for c in names]]), [region])


def legacy_daily_stats(cells: DataFrame, keys: list[str], max_keys: list[str], day: str = "date") -> tuple[DataFrame, DataFrame]:
    """Mean and standard deviation of each day only, and the season's maximum of each pixel."""
    value = drop_negative(F.col("v"))
    daily = cells.groupBy(*keys, day).agg(F.avg(value).alias("lai_mean"), F.stddev_pop(value).alias("lai_std"))
    return daily, season_max(cells, max_keys).select(*max_keys, "max_lai")


def season_max(cells: DataFrame, keys: list[str], crop: str | None = None) -> DataFrame:
    """A3: highest value of each pixel over the season, raw and adjusted."""
    value = drop_negative(F.col("v"))
    return cells.groupBy(*keys).agg(F.max(value).alias("max_lai"), F.max(adjust_for_crop(value, crop)).alias("max_lai_adj"))


def valid_regions(mask: DataFrame, px_threshold: int) -> DataFrame:
    """regions with more crop pixels than the threshold; semi-join with it."""
    return mask.groupBy("region").agg(F.count_if(F.col("m") > 0).alias("n_crop")).where(F.col("n_crop") > px_threshold)


def between_days(df: DataFrame, first, last, day: str = "date") -> DataFrame:
    """On the partition column, so other days' files are not read."""
    return df.where(F.col(day).between(first, last))


def mean_over_regions(daily: DataFrame, keys: list[str], values: list[str], flag: str = "interpolated") -> DataFrame:
    """Means of the regions of each key and date, and whether any is interpolated."""
    return daily.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values], F.max(flag).alias(flag))


def common_dates_mean(daily: DataFrame, unit: list[str], region: str, day: str, value: str) -> DataFrame:
    """Means over the days that all regions of a unit have."""
    need = daily.groupBy(*unit).agg(F.countDistinct(region).alias("__need"))
    have = daily.groupBy(*unit, day).agg(F.countDistinct(region).alias("__have"), F.avg(value).alias(value))
    return have.join(need, unit).where("__have = __need").drop("__have", "__need") if unit else have.crossJoin(need).where("__have = __need").drop("__have", "__need")


def peak(daily: DataFrame, keys: list[str], value: str, day: str) -> DataFrame:
    """Highest value and its day, the first one in a tie."""
    top = F.max(F.struct(F.col(value), -F.unix_date(F.col(day).cast("date"))))
    return daily.where(F.col(value).isNotNull()).groupBy(*keys).agg(top.alias("__t")).select(*keys, F.col(f"__t.{value}").alias("max_value"), F.date_from_unix_date(-F.col("__t.col2")).alias("max_day"))


def mosaic(pixels: DataFrame, keys: list[str], value: str, order_by: str) -> DataFrame:
    """Of several rasters over a cell, the first valid value in a stated order (names, not file order)."""
    valid = F.when(F.col(value).isNotNull(), F.struct(F.col(order_by), F.col(value)))
    return pixels.groupBy(*keys).agg(F.min(valid)[value].alias(value))


def daily_stats_on_mask(lai: DataFrame, mask: DataFrame, crop: str | None = None, exact: bool = True, small: int = SMALL) -> DataFrame:
    """daily_stats over lai(date, ix, iy, v) on mask(region, ix, iy, m), without a row for every crop pixel and day.

    Cells outside a day's raster are missing. Only pixels with a value are joined; a region's crop pixels are counted once, and those without a
    value on a day follow by subtraction. Days on which a region has no pixel at all are added from the
    table of days, which is as long as there are rasters.
    """
    crop_cells = mask.where("m = 1").select("region", "ix", "iy")
    seen = lai.where(F.col("v").isNotNull()).join(crop_cells, ["ix", "iy"])
    seen = _group_stats(seen, ["region", "date"], crop, exact, small, [F.count(drop_negative(F.col("v"))).alias("n_pixels"), F.count("v").alias("__n")])
    rows = mask.groupBy("region").agg(F.count_if(F.col("m") == 1).alias("__all")).crossJoin(lai.select("date").distinct())
    out = rows.join(seen, ["region", "date"], "left").withColumn("n_pixels", F.coalesce("n_pixels", F.lit(0)))
    share = F.coalesce(F.try_divide(100.0 * (F.col("__all") - F.coalesce("__n", F.lit(0))), F.col("__all")), F.lit(0.0))
    return out.withColumn("cloud_pct", share).drop("__all", "__n")


def means_by_plot_date(daily: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Means by year and reference date; whether a season crosses New Year is told by each key's dates."""
    # written first, so that Spark knows its size: few keys go to the rows, and no task holds a key's rows
    cross = materialize(daily.groupBy(*keys).agg(dates.is_cross_year(F.col(day)).alias("__cross")), "cross-year")
    d = daily.join(cross, keys).withColumn("plot_date", dates.plot_date(F.col(day), F.col("__cross")))
    return d.groupBy(*keys, F.year(day).alias("year"), "plot_date").agg(F.avg(value).alias(value))
