"""Sinks (S11-S15): result tables, weather files, feature files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.geo import parts_of, z_code

#: Units of the weather file's columns.
MET_UNITS = {"year": "()", "day": "()", "radn": "(MJ/m^2)", "maxt": "(oC)", "mint": "(oC)", "meant": "(oC)", "rain": "(mm)", "wind": "(m/s)"}


def write_table(df: DataFrame, path: str, parts: list[str] | None = None, kind: str = "parquet") -> None:
    """A result table in partitions of year, timepoint, ..."""
    w = df.write.mode("overwrite").partitionBy(*(parts or []))
    w.parquet(path) if kind == "parquet" else w.option("header", True).csv(path)


def write_pixels(df: DataFrame, path: str, parts: list[str], files: int = 200, page_rows: int = 20_000) -> None:
    """pixels(ix, iy, ...) in partitions, in Z-order within each and over its files, with their code in `z`.

    A window's cells lie in few ranges of codes, so scan_pixels reads few files, row groups and pages.
    """
    df = df.withColumn("z", z_code(F.col("ix"), F.col("iy"))).repartitionByRange(files, *parts, "z").sortWithinPartitions(*parts, "z")
    df.write.mode("overwrite").option("parquet.page.row.count.limit", page_rows).partitionBy(*parts).parquet(path)


def met_lines(met: DataFrame, heads: DataFrame, columns: tuple[str, ...] = ("year", "day", "radn", "maxt", "mint", "meant", "rain", "wind")) -> DataFrame:
    """(region, order, line) of weather files: five header lines, two column lines, then a row a day padded to 8 signs.

    met(region, date, variables), heads(region, lat, lon, tav, amp).
    """
    pad = lambda c: F.rpad(c, 8, " ")
    cell = lambda c: pad({"year": F.year("date"), "day": F.dayofyear("date")}.get(c, F.bround(F.col(c), 2) if c in met.columns else F.lit(None)).cast("string"))
    rows = met.select("region", (F.unix_date("date") + 1_000_000).alias("order"), F.concat_ws(" ", *[cell(c) for c in columns]).alias("line"))
    text = lambda s, *c: F.format_string(s, *c)
    # fixed values: the header lines of the file format
    head: list[Column] = [
        F.lit("[weather.met.weather]"),
        text("latitude = %.2f  (DECIMAL DEGREES)", F.col("lat")),
        text("longitude = %.2f  (DECIMAL DEGREES)", F.col("lon")),
        text("tav = %5.2f (oC)    ! annual average ambient temperature", F.col("tav")),
        text("amp = %5.2f (oC)    ! annual amplitude (i.e., range) in mean monthly temperature", F.col("amp")),
        F.lit(" ".join(c.ljust(8) for c in columns)),
        F.lit(" ".join(MET_UNITS[c].ljust(8) for c in columns)),
    ]
    top = heads.select("region", F.posexplode(F.array(*head)).alias("order", "line"))
    return top.unionByName(rows.select("region", "order", "line"))


def write_met(met: DataFrame, heads: DataFrame, path: str, partitions: int = 200) -> None:
    """A folder for each region, lines in order."""
    lines = met_lines(met, heads).repartition(partitions, "region").sortWithinPartitions("region", "order")
    lines.select("region", "line").write.mode("overwrite").partitionBy("region").text(path)


def features(df: DataFrame, rings: str = "rings", drop: tuple[str, ...] = ("edges",)) -> DataFrame:
    """One GeoJSON feature a row, all other columns as properties; a region of several parts is a MultiPolygon."""
    props = [c for c in df.columns if c != rings and c not in drop]
    df = df.select(*props, F.filter(rings, lambda r: F.size(r) > 0).alias("__rings")).withColumn("__parts", parts_of(F.col("__rings")))
    line = lambda i: F.transform(F.get("__rings", i), lambda p: F.array(p.x, p.y))
    coords = F.transform("__parts", lambda part: F.transform(part, line))
    single = F.struct(F.lit("Polygon").alias("type"), F.get(coords, F.lit(0)).alias("coordinates"))
    several = F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates"))
    geometry = F.when(F.size("__parts") == 1, F.to_json(single)).otherwise(F.to_json(several))
    text = [F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*props)), F.lit(',"geometry":'), geometry, F.lit("}")]
    return df.select(F.concat(*text).alias("value"))


def write_features(df: DataFrame, path: str) -> None:
    features(df).write.mode("overwrite").text(path)
