"""Weather series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.series import first_row, linear_fill
from fieldspark.session import materialize

#: Limits of plausible daily weather.
LIMITS = {"maxt": (None, 50.0), "mint": (-40.0, None), "wind": (0.0, 20.0), "rain": (0.0, 300.0), "radn": (0.0, 100.0)}


def era5_units(df: DataFrame) -> DataFrame:
    """Kelvin, Joule, metre and wind parts to the units of the daily series; missing becomes 0."""
    celsius = lambda c: F.col(c) - 273.15
    out = df.withColumns(
        {
            "maxt": celsius("temperature_2m_max"),
            "mint": celsius("temperature_2m_min"),
            "radn": F.col("surface_solar_radiation_downwards_sum") / 1e6,
            "rain": F.greatest(F.col("total_precipitation_sum") * 1000, F.lit(0.0)),
            "wind": F.hypot("u_component_of_wind_10m", "v_component_of_wind_10m"),
        }
    )
    out = out.withColumn("meant", (F.col("maxt") + F.col("mint")) / 2)
    return out.fillna(0.0, subset=["maxt", "mint", "meant", "radn", "rain", "wind"])


def clean_power(df: DataFrame, keys: list[str], day: str, values: list[str], fill: float = -999.0) -> DataFrame:
    """Fill values are missing, and missing values lie on a line between their neighbours."""
    df = df.withColumns({v: F.nullif(F.col(v), F.lit(fill)) for v in values})
    return linear_fill(df, keys, day, values)


def flatten_payload(df: DataFrame, keys: list[str], payload: str, params: list[str]) -> DataFrame:
    """{parameter: {date: value}} as text -> one row a date, one column a parameter."""
    parsed = F.from_json(payload, "map<string,map<string,double>>")
    long = df.select(*keys, F.explode(parsed).alias("param", "__series")).select(*keys, "param", F.explode("__series").alias("date", "value"))
    long = long.withColumn("date", F.coalesce(F.try_to_date("date", "yyyyMMdd"), F.try_to_date("date", "yyyy-MM-dd")))
    return long.groupBy(*keys, "date").pivot("param", params).agg(F.first("value"))


def location_stats(df: DataFrame, keys: list[str], day: str = "date", means: tuple[str, ...] = ("radn", "meant", "maxt", "mint", "wind")) -> DataFrame:
    """Mean of the yearly rain sums, and means of the other variables (wind in km/h), in one pass over years.

    Sums and counts by year first, then over years: the second step sees one row a year.
    """
    parts = [F.sum(c).alias(f"__s_{c}") for c in means] + [F.count(c).alias(f"__n_{c}") for c in means]
    yearly = df.groupBy(*keys, F.year(day).alias("__y")).agg(F.sum("rain").alias("rain"), *parts)
    mean = lambda c: F.try_divide(F.sum(f"__s_{c}"), F.sum(f"__n_{c}"))
    return yearly.groupBy(*keys).agg(F.avg("rain").alias("rain"), *[(mean(c) * (3.6 if c == "wind" else 1)).alias(c) for c in means])


def tav_amp(df: DataFrame, keys: list[str], day: str = "date", value: str = "meant") -> DataFrame:
    """A10: mean of the monthly means, and the span between the highest and the lowest."""
    monthly = df.groupBy(*keys, F.month(day).alias("__m")).agg(F.avg(value).alias("__v"))
    return monthly.groupBy(*keys).agg(F.avg("__v").alias("tav"), (F.max("__v") - F.min("__v")).alias("amp"))


def doy_climatology(df: DataFrame, keys: list[str], day: str, values: list[str], before: str | None = None) -> DataFrame:
    """Means by day of year of the years before a date; day 366 is filled from 365 where it is missing."""
    past = df if before is None else df.where(F.year(day) < F.year(F.lit(before).cast("date")))
    clim = past.groupBy(*keys, F.dayofyear(day).alias("doy")).agg(*[F.avg(v).alias(v) for v in values])
    leap = clim.where("doy = 366").select(*keys)
    fill = clim.where("doy = 365").withColumn("doy", F.lit(366))
    fill = fill.join(leap, keys, "left_anti") if keys else fill.crossJoin(leap.agg(F.count(F.lit(1)).alias("__n"))).where("__n = 0").drop("__n")
    return clim.unionByName(fill)


def require_full_year(clim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with fewer than 365 days, as violations."""
    return clim.groupBy(*keys).agg(F.countDistinct("doy").alias("n_days")).where("n_days < 365")


def project_days(clim: DataFrame, spine: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """Coming days with the climatology of their day of year; data_type tells them from measured ones."""
    return spine.withColumn("doy", F.dayofyear(day)).join(clim, [*keys, "doy"]).withColumn("data_type", F.lit("projected"))


def override_rain(met: DataFrame, precip: DataFrame, allow_gaps: bool = False) -> DataFrame:
    """Rain by region and date from a second table.

    The second table counts for a region only if it has all of the region's days; otherwise the region
    keeps its own rain if allow_gaps, and is an error if not.
    """
    j = met.join(precip.select("region", "date", F.col("mm").alias("__mm")), ["region", "date"], "left")
    gaps = F.count_if(F.col("__mm").isNull()).over(Window.partitionBy("region"))
    other = F.col("rain") if allow_gaps else F.raise_error(F.concat(F.lit("no full precipitation for region "), F.col("region"))).cast("double")
    return j.withColumn("rain", F.when(gaps == 0, F.col("__mm")).otherwise(other)).drop("__mm")


def missing_days(spine: DataFrame, held: DataFrame, on: list[str]) -> DataFrame:
    """Wanted days not yet held."""
    return spine.join(held.select(*on).distinct(), on, "left_anti")


def prefer_final(files: DataFrame, version: int) -> DataFrame:
    """For each date the FINAL product, else the PRELIM one, which version 3 does not have."""
    usable = files if version == 2 else files.where("product = 'FINAL'")
    return first_row(usable, ["date"], [F.when(F.col("product") == "FINAL", 0).otherwise(1), "product"])


def region_precipitation(cells: DataFrame, region_cells: DataFrame) -> DataFrame:
    """Mean of the cells of each region and day. cells(date, ix, iy, mm), region_cells(region, ix, iy)."""
    return cells.join(region_cells, ["ix", "iy"]).groupBy("region", "date").agg(F.avg("mm").alias("mm"))


def weather_facts(met: DataFrame, keys: list[str]) -> DataFrame:
    """First day, last day, last measured day."""
    return met.groupBy(*keys).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.max(F.when(F.col("data_type") == "measured", F.col("date"))).alias("last_measured"))


def limit_violations(met: DataFrame, keys: list[str], limits: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """Q1: keys, variable, value of every value outside its limits; one pass over the table."""

    def outside(c: str, low: float | None, high: float | None) -> Column:
        bad = F.lit(False)
        bad = bad | (F.col(c) < low) if low is not None else bad
        bad = bad | (F.col(c) > high) if high is not None else bad
        return F.when(bad, F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")))

    found = [outside(c, *lim) for c, lim in (limits or LIMITS).items() if c in met.columns]
    return met.select(*keys, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("__x")).select(*keys, "__x.variable", "__x.value")


def last_years(df: DataFrame, keys: list[str], day: str, years: int) -> DataFrame:
    """rows of the last N years of each key's range.

    The keys' last days are written first: Spark knows their size then and takes them to the rows where they
    are few, so that no task holds a key's rows.
    """
    top = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(F.col(day).cast("date")).alias("__top"))
    own = F.lit(True)
    for k in keys:
        own = own & F.col(k).eqNullSafe(F.col(f"__{k}"))
    late = F.col(day).cast("date") >= F.add_months("__top", -12 * years)
    return df.join(materialize(top, "last-days"), own & late).select(*[df[c] for c in df.columns])


def join_on_rounded(stats: DataFrame, centroids: DataFrame, digits: int = 2) -> DataFrame:
    """Statistics and regions by coordinates rounded to a few decimals (a region column is the better key)."""
    keys = lambda df: df.withColumns({"__lat": F.bround("latitude", digits), "__lon": F.bround("longitude", digits)})
    right = keys(centroids).drop("latitude", "longitude")
    return keys(stats).join(right, ["__lat", "__lon"]).drop("__lat", "__lon")
