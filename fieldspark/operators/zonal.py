"""Zonal statistics and mosaics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.names import normalize_year
from fieldspark.operators.evaluate import weighted_median


def zonal_stats(pixels: DataFrame, cover: DataFrame, px_ha: float, areas: DataFrame | None = None) -> DataFrame:
    """A4: yield of each polygon from pixels(ix, iy, v, covered) and shares cover(region, ix, iy, weight).

    Mean and median are weighted by the covered share; median: see A7. Areas in hectares, production in
    kilograms and tons, coverage in percent of the polygon's cells; areas(region, area_ha) adds the
    polygon's own area. Rounded 0, 2, 1, 3 decimals as exported.
    """
    px = cover.join(pixels, ["ix", "iy"], "left").withColumn("w", F.when(F.col("v").isNotNull(), F.col("weight")))
    v, w = F.col("v"), F.col("w")
    stats = px.groupBy("region").agg(
        F.bround(F.try_divide(F.sum(v * w), F.sum(w))).cast("long").alias("mean_yield_kg_ha"),
        F.bround(F.sum(w) * px_ha, 2).alias("total_area_ha"),
        F.bround(F.sum(v * w) * px_ha).cast("long").alias("total_production_kg"),
        F.bround(F.sum(v * w) * px_ha / 1000, 3).alias("total_production_ton"),
        F.bround(F.try_divide(100 * F.sum(F.col("weight") * F.coalesce(F.col("covered"), F.lit(0))), F.sum("weight")), 1).alias("coverage_pct"),
        F.bround(F.sum(F.col("weight") * F.coalesce(F.col("covered"), F.lit(0))) * px_ha, 2).alias("covered_area_ha"),
    )
    median = weighted_median(px, ["region"], "v", "w", out="median").select("region", F.bround("median").cast("long").alias("median_yield_kg_ha"))
    out = stats.join(median, "region", "left")
    return out.join(areas, "region", "left") if areas is not None else out


def region_totals(pixels: DataFrame, area_ha: Column, keys: list[str] | None = None) -> DataFrame:
    """Yield totals of each region from its pixels; whole numbers cut, without pixels NULL area (0 elsewhere)."""
    v = F.col("v")
    area = F.sum(F.when(v.isNotNull(), area_ha))
    kg = F.sum(v * area_ha)
    return pixels.groupBy(*(keys or ["region"])).agg(
        F.coalesce(F.avg(v).cast("int"), F.lit(0)).alias("mean_yield_kg_ha"),
        F.coalesce(F.median(v).cast("int"), F.lit(0)).alias("median_yield_kg_ha"),
        area.alias("total_area_ha"),
        F.coalesce(kg.cast("long"), F.lit(0)).alias("total_production_kg"),
        F.coalesce(F.bround(kg / 1000, 3), F.lit(0.0)).alias("total_production_ton"),
    )


def coverage_mask(cells: DataFrame, extents: DataFrame, tile: int = 512) -> DataFrame:
    """1 for each cell (ix, iy) inside the rectangle of any region's raster, else 0.

    extents(ix_min, ix_max, iy_min, iy_max) are cut into tiles, so the join is on the tile and a cell
    meets only the rectangles near it.
    """
    span = lambda a, b: F.sequence(F.floor(F.col(a) / tile), F.floor(F.col(b) / tile))
    e = extents.withColumn("tx", F.explode(span("ix_min", "ix_max"))).withColumn("ty", F.explode(span("iy_min", "iy_max")))
    c = cells.withColumns({"tx": F.floor(F.col("ix") / tile), "ty": F.floor(F.col("iy") / tile)})
    on = (c.tx == e.tx) & (c.ty == e.ty) & c.ix.between(e.ix_min, e.ix_max) & c.iy.between(e.iy_min, e.iy_max)
    hit = c.join(e, on, "left_semi").select("ix", "iy", F.lit(1).alias("covered"))
    return cells.join(hit, ["ix", "iy"], "left").withColumn("covered", F.coalesce("covered", F.lit(0)))


def attribute_layers(region_cells: DataFrame, single: DataFrame, multi: DataFrame, values: list[str]) -> DataFrame:
    """Attributes of one year and of several years on the cells of their regions, a column for each layer."""
    name = lambda df, suffix: df.select("region", *[F.col(v).alias(f"{v}_{suffix}") for v in values])
    return region_cells.join(name(single, "single"), "region", "left").join(name(multi, "multi"), "region", "left")


def of_year(df: DataFrame, column: str | None, year: int | str, strict: bool = False) -> DataFrame:
    """Rows of a year; without the column all rows, or an error if strict."""
    if column is None or column not in df.columns:
        if strict:
            raise ValueError(f"no column {column} to pick year {year} by")
        return df
    return df.where(normalize_year(F.col(column)) == str(year))


def extract_reference(df: DataFrame, name: str, value: str, year_column: str | None = None, year: int | str | None = None) -> DataFrame:
    """F8: region and reported yield of the rows that have both."""
    for c in (name, value):
        if c not in df.columns:
            raise ValueError(f"no column {c}")
    rows = of_year(df, year_column, year, strict=True) if year is not None else df
    return rows.select(F.col(name).alias("region"), F.col(value).cast("double").alias("reported_mean_yield_kg_ha")).dropna()


def coverage_warnings(zonal: DataFrame) -> DataFrame:
    """Q9."""
    level = F.when(F.col("coverage_pct") == 0, "no coverage").when(F.col("coverage_pct") < 50, "less than half covered")
    return zonal.select("region", "coverage_pct", level.alias("warning")).where(F.col("warning").isNotNull())


def target_resolution(grids: DataFrame, project, existing: DataFrame | None = None) -> DataFrame:
    """Crs and resolution of the target: those of what is there already, else of the commonest system's sample tile.

    grids(product, crs, xmin, ymin, xmax, ymax, width): the tile's width in the target system over its
    pixels, with project(x, y) giving target coordinates. existing(path, crs, dx): the first output by
    path wins over all tiles; if it has no system, that is an error.
    """
    common = grids.groupBy().agg(F.mode("crs", True).alias("crs"))
    tile = grids.join(common, "crs").groupBy("crs").agg(F.min_by(F.struct("xmin", "ymin", "xmax", "width"), "product").alias("t"))
    left, _ = project(F.col("t.xmin"), F.col("t.ymin"))
    right, _ = project(F.col("t.xmax"), F.col("t.ymin"))
    sample = tile.select(F.lit(1).alias("order"), "crs", F.try_divide(right - left, F.col("t.width")).alias("resolution"))
    if existing is not None:
        first = existing.groupBy().agg(F.min(F.struct("path", "crs", "dx")).alias("f")).where(F.col("f").isNotNull())
        crs = F.when(F.col("f.crs").isNull(), F.raise_error(F.lit("the existing output has no reference system"))).otherwise(F.col("f.crs"))
        sample = sample.unionByName(first.select(F.lit(0).alias("order"), crs.alias("crs"), F.abs("f.dx").alias("resolution")))
    return sample.groupBy().agg(F.min(F.struct("order", "crs", "resolution")).alias("s")).where(F.col("s").isNotNull()).select("s.crs", "s.resolution")
