"""Scans (S1-S10, S16): files and landed records as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.operators.geo import z_ranges

LAI_CSV = "`Date` string, `n_pixels` int, `interpolated` int, `LAI Mean` double, `LAI Median` double, `LAI Std` double, `LAI Mean Adjusted` double, `LAI Median Adjusted` double, `LAI Std Adjusted` double, `Cloud or Snow Percentage` double"
MET = ("radn", "maxt", "mint", "meant", "rain", "wind")


def scan_pixels(spark: SparkSession, path: str, product: str, first: str, last: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Days by partition, a window (ix_min, ix_max, iy_min, iy_max) by ranges of Z-order where pixels were written in it."""
    df = spark.read.parquet(path).where((F.col("product") == product) & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if window and "z" in df.columns:
        near = F.lit(False)
        for low, high in z_ranges(window):
            near = near | F.col("z").between(low, high)
        df = df.where(near)
    df = df.where(F.col("ix").between(*window[:2]) & F.col("iy").between(*window[2:])) if window else df
    return df.drop("z")


def read_region_csv(spark: SparkSession, path: str, schema: str = LAI_CSV, pattern: str = r"([^/]+)_LAI_STATS\.csv$") -> DataFrame:
    """One CSV a region as one table, the region out of the file's name; rows with unreadable dates go."""
    df = spark.read.schema(schema).csv(path, header=True).withColumn("region", F.regexp_extract("_metadata.file_path", pattern, 1))
    parsed = F.try_to_date("Date", "dd/MM/yyyy").alias("date")  # names do not differ by case, so it replaces the text
    return df.select("region", parsed, *[F.col(f"`{c}`") for c in df.columns if c not in ("region", "Date")]).where(F.col("date").isNotNull())


def study_parts(files: DataFrame, pattern: str = r"([^/]+)/([^/]+)/(\d{4})/([^/]+)/[^/]*$", names: tuple[str, ...] = ("level", "study_id", "year", "timepoint"), path: str = "path") -> DataFrame:
    """S3: level, study, year and timepoint out of file paths."""
    return files.select(path, *[F.regexp_extract(path, pattern, i + 1).alias(n) for i, n in enumerate(names)]).where(F.col(names[0]) != "")


def read_precipitation(spark: SparkSession, path: str, region: str, first: str, last: str) -> DataFrame:
    """One region's column of a wide table, or its rows of a long one, and a slice of days."""
    df = spark.read.parquet(path)
    long = df.where(F.col("region") == region).select("date", "mm") if "mm" in df.columns else df.select("date", F.col(f"`{region}`").alias("mm"))
    return long.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def read_report(spark: SparkSession, source: str | DataFrame, crop: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Simulation rows under plain names; the crop's own column is <Crop>.Leaf.LAI."""
    df = source if isinstance(source, DataFrame) else spark.read.parquet(source)
    crop = crop.lower().capitalize()
    names = columns or {"SimulationID": "SimulationID", "Clock.Today": "ts", f"{crop}.Leaf.LAI": "lai", "Yield": "yield", f"{crop}.Total.Wt": "total_wt", "NDVI": "ndvi"}
    out = df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items() if a in df.columns])
    return out.withColumn("date", F.to_date("ts")) if "ts" in out.columns else out


def read_report_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """S5 with a query of the caller's, run at the database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def parse_met(lines: DataFrame, missing: str = "zero") -> DataFrame:
    """lines(path, line_no, value) of .met files -> latitude, longitude, date and the variables by header name.

    Each variable is checked by itself for -999, which becomes 0, or NULL with missing="null". The header
    is one row a file and joined to the data rows.
    """
    v = F.trim("value")
    number = lambda c: F.regexp_extract(c, r"=\s*(-?[0-9.]+)", 1).try_cast("double")
    head = lines.groupBy("path").agg(
        F.max(F.when(F.lower(v).startswith("latitude"), number(F.col("value")))).alias("latitude"),
        F.max(F.when(F.lower(v).startswith("longitude"), number(F.col("value")))).alias("longitude"),
        F.max(F.when(F.lower(v).startswith("year"), F.split(v, r"\s+"))).alias("names"),
    )
    rows = lines.where(v.rlike(r"^\d{4}\s+\d{1,3}\s")).select("path", F.split(v, r"\s+").alias("parts"))
    rows = rows.join(head, "path").withColumn("m", F.map_from_arrays("names", "parts"))
    date = F.to_date(F.concat(F.col("m")["year"], F.lit("-"), F.lpad(F.col("m")["day"], 3, "0")), "yyyy-DDD")
    value = lambda c: F.when(F.col("m")[c].try_cast("double") != -999, F.col("m")[c].try_cast("double"))
    fill = (lambda c: F.coalesce(c, F.lit(0.0))) if missing == "zero" else (lambda c: c)
    return rows.select("path", "latitude", "longitude", date.alias("date"), *[fill(value(c)).alias(c) for c in MET])


def read_met(spark: SparkSession, path: str, missing: str = "zero") -> DataFrame:
    return parse_met(spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value"), missing)


def read_regions(spark: SparkSession, source: str | DataFrame, name: str) -> DataFrame:
    """Region, rings, attributes and centroid out of GeoJSON text (a path to files, or a column `value` of documents)."""
    docs = spark.read.text(source, wholetext=True) if isinstance(source, str) else source
    shape = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    f = docs.select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    poly = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("f.geometry.type") == "Polygon", poly).when(F.col("f.geometry.type") == "MultiPolygon", multi)
    at = lambda i: F.regexp_extract(F.col("f.properties")["centroid"], r"POINT ?\((-?[0-9.]+) (-?[0-9.]+)\)", i).try_cast("double")
    points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return f.select(F.col("f.properties")[name].alias("region"), points.alias("rings"), F.col("f.properties").alias("attrs"), at(1).alias("lon"), at(2).alias("lat"))


def granule_angles(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Mean sun and view angles of granule metadata; another unit than degrees is an error."""
    sun, view = "//Mean_Sun_Angle", "//Mean_Viewing_Incidence_Angle[@bandId='8']"
    unit = F.expr(f"xpath_string({xml}, '{sun}/ZENITH_ANGLE/@unit')")
    take = lambda p: F.expr(f"""xpath_double({xml}, "{p}")""")
    ok = F.when(unit == "deg", take(f"{sun}/ZENITH_ANGLE")).otherwise(F.raise_error(F.lit("angles are not in degrees")).cast("double"))
    return df.withColumns({"sun_zenith": ok, "sun_azimuth": take(f"{sun}/AZIMUTH_ANGLE"), "view_zenith": take(f"{view}/ZENITH_ANGLE"), "view_azimuth": take(f"{view}/AZIMUTH_ANGLE")})


def read_era5(spark: SparkSession, path: str) -> DataFrame:
    """Landed feature records, properties as columns."""
    return spark.read.json(path).select("properties.*").withColumn("date", F.to_date("date"))


def clear_scenes(items: DataFrame, cloud_below: float, cloud: str = "eo:cloud_cover") -> DataFrame:
    """S16."""
    return items.where(F.col(f"`{cloud}`") < cloud_below)


def met_file_fields(df: DataFrame, name: str = "file") -> DataFrame:
    """lon, lat, first and last day out of weather file names lon_lat_first_last; other names are an error."""
    part = F.split(F.regexp_replace(name, r"\.\w+$", ""), "_")
    good = F.when(F.size(part) == 4, part).otherwise(F.raise_error(F.concat(F.lit("not a weather file: "), F.col(name))))
    day = lambda i: F.to_date(F.element_at(good, i), "yyyyMMdd")
    return df.withColumns({"lon": F.element_at(good, 1).cast("double"), "lat": F.element_at(good, 2).cast("double"), "first_day": day(3), "last_day": day(4)})


def day_chunks(ranges: DataFrame, first: str, last: str, step: str) -> DataFrame:
    """Date ranges cut into chunks of an interval such as 30 days or 5 years."""
    starts = F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"), F.expr(f"interval {step}")))
    r = ranges.withColumn("chunk_start", starts)
    w = Window.partitionBy(*ranges.columns).orderBy("chunk_start")
    return r.withColumn("chunk_end", F.coalesce(F.date_sub(F.lead("chunk_start").over(w), 1), F.col(last).cast("date")))
