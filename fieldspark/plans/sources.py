"""Queries of scans, sinks, exported columns, projections and checks over the driver tables, each with its DuckDB SQL.

Files are written to the shared folder and read again by the scans.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions import dates, names, pixels
from fieldspark.operators import checks, evaluate, geo, lai, simulation, studies, weather, zonal
from fieldspark.plans.queries import _POLYGONS, _regions, _round
from fieldspark.plans.registry import query
from fieldspark.session import shared_folder, table
from fieldspark.sources import readers, sinks
from fieldspark.streaming import jobs, ledger


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT l_returnflag AS product, l_shipdate::DATE AS date, floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, count(*) AS n, round(max(l_extendedprice), 2) AS v FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND floor(l_quantity) BETWEEN 5 AND 40 AND round(l_discount * 100) BETWEEN 1 AND 8 GROUP BY ALL""")
def scan_pixels(spark, d):
    """Pixels written in partitions of product, then one product, a range of days and a window read."""
    px = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("product"), F.to_date("l_shipdate").alias("date"), F.floor("l_quantity").cast("int").alias("ix"), F.round(F.col("l_discount") * 100).cast("int").alias("iy"), F.col("l_extendedprice").alias("v"))
    at = _folder(spark, "pixels")
    sinks.write_pixels(px, at, ["product"], files=8)
    found = lai.between_days(readers.scan_pixels(spark, at, "R", "1990-01-01", "1999-12-31", (5, 40, 1, 8)), F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
    return _round(found.groupBy("product", "date", "ix", "iy").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v")), 2, "v")


@query("""SELECT event_type AS region, ts::DATE AS date, count(*)::INT AS n_pixels, round(avg(value), 6) AS lai_mean FROM events GROUP BY ALL""")
def read_region_files(spark, d):
    """A CSV folder for each region, its name out of the path; the line with an unreadable date goes."""
    daily = table(spark, d, "events").groupBy(F.col("event_type").alias("file"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("int").alias("n_pixels"), F.round(F.avg("value"), 6).alias("LAI Mean"))
    rows = daily.select(F.date_format("day", "dd/MM/yyyy").alias("Date"), "n_pixels", "LAI Mean", "file")
    broken = rows.select("file").distinct().select(F.lit("no date").alias("Date"), F.lit(0).alias("n_pixels"), F.lit(0.0).alias("LAI Mean"), "file")
    at = _folder(spark, "region-csv")
    sinks.write_table(rows.unionByName(broken), at, ["file"], kind="csv")
    got = readers.read_region_csv(spark, at, "`Date` string, `n_pixels` int, `LAI Mean` double", r"file=([^/]+)/")
    return got.select("region", "date", "n_pixels", F.col("LAI Mean").alias("lai_mean"))


@query("""
WITH p AS (SELECT event_type AS region, ts::DATE AS date, round(sum(value), 4) AS mm FROM events GROUP BY ALL)
SELECT 'long' AS layout, date, mm FROM p WHERE region = 'click' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
UNION ALL SELECT 'wide', date, max(mm) FILTER (region = 'view') FROM p WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY date""")
def read_precipitation(spark, d):
    """One region's rows of a long table and one region's column of a wide one, for a slice of days."""
    p = table(spark, d, "events").groupBy(F.col("event_type").alias("region"), F.to_date("ts").alias("date")).agg(F.round(F.sum("value"), 4).alias("mm"))
    long, wide = _folder(spark, "rain-long"), _folder(spark, "rain-wide")
    sinks.write_table(p, long)
    sinks.write_table(p.groupBy("date").pivot("region").agg(F.first("mm")), wide)
    read = lambda at, region, kind: readers.read_precipitation(spark, at, region, "2024-01-05", "2024-01-25").select(F.lit(kind).alias("layout"), "date", "mm")
    return read(long, "click", "long").unionByName(read(wide, "view", "wide"))


@query("""SELECT l_orderkey AS "SimulationID", l_shipdate AS ts, l_quantity AS lai, l_extendedprice AS "yield", l_tax AS ndvi, l_shipdate::DATE AS date FROM lineitem""")
def read_report(spark, d):
    """Simulator columns with dots in their names under plain ones."""
    raw = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("SimulationID"), F.col("l_shipdate").alias("Clock.Today"), F.col("l_quantity").alias("Wheat.Leaf.LAI"), F.col("l_extendedprice").alias("Yield"), F.col("l_tax").alias("NDVI"))
    return readers.read_report(spark, raw, "WHEAT")


@query("""
SELECT event_id, ts::DATE AS date, round(value - 200, 8) AS maxt, round(value / 2 - 200, 8) AS mint, round((value - 200 + value / 2 - 200) / 2, 8) AS meant, round(value / 10, 8) AS radn,
  CASE WHEN event_id % 7 = 0 THEN 0 ELSE round(greatest(value - 100, 0), 8) END::DOUBLE AS rain, round(sqrt((value / 30) ** 2 + (value / 40) ** 2), 8) AS wind FROM events""")
def era5_series(spark, d):
    """Landed feature records in raw units, one in seven without precipitation."""
    v = F.col("value")
    raw = {
        "event_id": F.col("event_id"), "date": F.to_date("ts").cast("string"), "temperature_2m_max": v - 200 + 273.15, "temperature_2m_min": v / 2 - 200 + 273.15, "surface_solar_radiation_downwards_sum": v * 1e5,
        "total_precipitation_sum": F.when(F.col("event_id") % 7 != 0, (v - 100) / 1000), "u_component_of_wind_10m": v / 30, "v_component_of_wind_10m": v / 40,
    }
    at = _folder(spark, "era5")
    table(spark, d, "events").select(F.struct(*[c.alias(k) for k, c in raw.items()]).alias("properties")).write.json(at)
    out = weather.era5_units(readers.read_era5(spark, at))
    return _round(out.select("event_id", "date", "maxt", "mint", "meant", "radn", "rain", "wind"), 8, "maxt", "mint", "meant", "radn", "rain", "wind")


_POWER = "SELECT event_type, ts::DATE AS date, CASE WHEN dayofyear(ts::DATE) % 4 <> 0 THEN round(avg(value), 6) END AS v FROM events GROUP BY event_type, ts::DATE"


@query(f"""
WITH g AS ({_POWER}), i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY date) AS i, CASE WHEN v IS NOT NULL THEN row_number() OVER (PARTITION BY event_type ORDER BY date) END AS k FROM g),
b AS (SELECT event_type, date, v, i, last_value(k IGNORE NULLS) OVER w1 AS pk, last_value(v IGNORE NULLS) OVER w1 AS pv, first_value(k IGNORE NULLS) OVER w2 AS nk, first_value(v IGNORE NULLS) OVER w2 AS nv FROM i
  WINDOW w1 AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), w2 AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, date, round(coalesce(v, pv + (nv - pv) * (i - pk) / (nk - pk), pv, nv), 8) AS v FROM b""")
def clean_power(spark, d):
    """Every fourth day holds the fill value -999, which lies on a line between its neighbours after cleaning."""
    daily = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("date")).agg(F.round(F.avg("value"), 6).alias("v"))
    filled = daily.withColumn("v", F.when(F.dayofyear("date") % 4 == 0, -999.0).otherwise(F.col("v")))
    return _round(weather.clean_power(filled, ["event_type"], "date", ["v"]), 8, "v")


@query("""SELECT event_id, round(round(value / 0.25) * 0.25, 3) AS lon FROM events WHERE abs(value / 0.25 - floor(value / 0.25) - 0.5) > 1e-6
UNION ALL SELECT event_id, round((CASE WHEN floor(value / 0.25)::BIGINT % 2 = 0 THEN floor(value / 0.25) ELSE ceil(value / 0.25) END) * 0.25, 3) FROM events WHERE abs(value / 0.25 - floor(value / 0.25) - 0.5) <= 1e-6""")
def snapped_coordinates(spark, d):
    """The nearest grid line, halves to even."""
    return table(spark, d, "events").select("event_id", dates.snap_coordinate(F.col("value"), 0.25).alias("lon"))


@query("""SELECT event_type AS region, ts::DATE AS date, 12.5::DOUBLE AS latitude, -3.25::DOUBLE AS longitude, round(max(value), 2) AS maxt, round(min(value), 2) AS mint, count(*)::DOUBLE AS rain, 0.0::DOUBLE AS wind FROM events GROUP BY ALL""")
def weather_files(spark, d):
    """Weather files written for each region and read back; a variable that is not written comes back as 0."""
    met = table(spark, d, "events").groupBy(F.col("event_type").alias("region"), F.to_date("ts").alias("date")).agg(F.max("value").alias("maxt"), F.min("value").alias("mint"), F.count(F.lit(1)).cast("double").alias("rain"))
    met = met.withColumns({"radn": F.lit(1.0), "meant": F.lit(2.0), "wind": F.lit(-999.0)})
    heads = met.select("region").distinct().select("region", F.lit(12.5).alias("lat"), F.lit(-3.25).alias("lon"), F.lit(1.0).alias("tav"), F.lit(2.0).alias("amp"))
    at = _folder(spark, "met")
    sinks.write_met(met, heads, at)
    got = readers.read_met(spark, at).withColumn("region", F.regexp_extract("path", r"region=([^/]+)/", 1))
    return _round(got.select("region", "date", "latitude", "longitude", "maxt", "mint", "rain", "wind"), 2, "maxt", "mint")


@query("""SELECT 'Feature' AS kind, s_name AS name, s_acctbal AS kg, 'Polygon' AS shape, s_suppkey::DOUBLE AS x0, s_suppkey + 1.0::DOUBLE AS x1 FROM supplier""")
def feature_lines(spark, d):
    """Features written as lines and read back as text."""
    x = F.col("s_suppkey").cast("double")
    point = lambda a, b: F.struct(a.alias("x"), F.lit(b).alias("y"))
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("kg"), F.array(F.array(point(x, 0.0), point(x + 1, 0.0), point(x + 1, 1.0), point(x, 0.0))).alias("rings"))
    at = _folder(spark, "features")
    sinks.write_features(rows, at)
    get = lambda p: F.get_json_object("value", p)
    return spark.read.text(at).select(
        get("$.type").alias("kind"), get("$.properties.name").alias("name"), get("$.properties.kg").cast("double").alias("kg"), get("$.geometry.type").alias("shape"),
        get("$.geometry.coordinates[0][0][0]").cast("double").alias("x0"), get("$.geometry.coordinates[0][1][0]").cast("double").alias("x1"),
    )


@query("""SELECT event_id, value FROM events WHERE value < 120""")
def clear_scenes(spark, d):
    """Catalogue items below a cloud cover."""
    items = table(spark, d, "events").select("event_id", F.col("value").alias("eo:cloud_cover"))
    return readers.clear_scenes(items, 120.0).select("event_id", F.col("eo:cloud_cover").alias("value"))


@query("""
WITH t AS (SELECT l_suppkey, sum(l_quantity) AS kg, max(CASE WHEN l_tax > 0.06 THEN l_extendedprice END) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT s_suppkey, coalesce(trunc(kg)::INT, -1) AS estimated_total_production_kg, round(coalesce(kg, 0) / 1000, 3) AS estimated_total_production_ton, coalesce(round(v + 0.001, 2), -1.0) AS estimated_mean_yield_kg_ha FROM supplier LEFT JOIN t ON s_suppkey = l_suppkey""")
def exported_columns(spark, d):
    """Exported names, -1 for missing, whole numbers cut, tons to three decimals."""
    t = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("kg"), F.max(F.when((F.col("l_returnflag") == "A") & (F.col("l_tax") > 0.06), F.col("l_extendedprice"))).alias("v"))
    j = table(spark, d, "supplier").join(t, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    out = j.select("s_suppkey", names.export_missing(F.col("kg")).alias("total_production_kg"), names.kg_to_tons(F.coalesce("kg", F.lit(0.0))).alias("total_production_ton"), names.export_missing(names.half_even(F.col("v") + 0.001), 2).alias("mean_yield_kg_ha"))
    return names.export_names(out)


@query("""
WITH p AS (SELECT l_suppkey AS region, round(avg(l_extendedprice)) AS pred, CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE round(avg(l_quantity * 1000)) END AS obs FROM lineitem GROUP BY 1)
SELECT region, pred - obs AS error, CASE WHEN obs <> 0 THEN round(100 * (pred - obs) / obs, 1) WHEN pred > obs THEN 1e300 ELSE -1e300 END::DOUBLE AS relative_error FROM p""")
def prediction_errors(spark, d):
    """Errors and relative errors; an observation of 0 gives an infinite one."""
    p = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("region")).agg(F.round(F.avg("l_extendedprice")).alias("pred"), F.round(F.avg(F.col("l_quantity") * 1000)).alias("obs"))
    obs = F.when(F.col("region") % 5 == 0, 0.0).otherwise(F.col("obs"))
    rel = names.relative_error(F.col("pred"), obs)
    return p.select("region", names.error(F.col("pred"), obs).alias("error"), F.when(rel == float("inf"), 1e300).when(rel == float("-inf"), -1e300).otherwise(rel).alias("relative_error"))


@query("""SELECT o_orderkey, year(o_orderdate)::VARCHAR AS label FROM orders WHERE year(o_orderdate) = 1997""")
def rows_of_year(spark, d):
    """Years written as 1997, 1997.0 and '1997' are the same."""
    y = F.year("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(y.cast("string"), F.lit(".0"))).otherwise(y.cast("string"))
    o = table(spark, d, "orders").select("o_orderkey", text.alias("y"))
    return zonal.of_year(o, "y", 1997, strict=True).select("o_orderkey", names.normalize_year(F.col("y")).alias("label"))


@query("""SELECT o_orderkey, year(o_orderdate)::INT AS year_original, o_custkey % 7 AS year FROM orders""")
def kept_year(spark, d):
    """A year column that is there keeps its values under another name."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 7).alias("study"))
    return names.keep_original_year(o).withColumnRenamed("study", "year")


@query("""
SELECT l_suppkey, count(*) FILTER (l_linenumber IN (4, 5) AND l_quantity < 40 AND coalesce(CASE WHEN l_tax > 0.01 THEN l_tax END < 0.06, true)) AS n_s2, count(*) FILTER ((l_linenumber::INT & 6) = 0) AS n_hls,
  count(*) FILTER (l_quantity < 30 AND l_discount >= 0.03 AND l_tax < 0.05) AS n_gee, sum(CASE WHEN l_linenumber = 3 THEN -9999 ELSE trunc(cos(radians((l_extendedprice / 11) / 100)) * 10000) END)::BIGINT AS cosines FROM lineitem GROUP BY 1""")
def pixel_masks(spark, d):
    """Masks of three products counted, and cosine bands with their nodata value."""
    c = F.col
    line = table(spark, d, "lineitem")
    s2 = pixels.keep_s2_pixel(c("l_linenumber"), c("l_quantity"), F.when(c("l_tax") > 0.01, c("l_tax")), 40, 0.06)
    angle = F.when(c("l_linenumber") == 3, -32768.0).otherwise(c("l_extendedprice") / 11)
    return line.groupBy("l_suppkey").agg(
        F.count_if(s2).alias("n_s2"), F.count_if(pixels.keep_hls_pixel(c("l_linenumber"), (1, 2))).alias("n_hls"),
        F.count_if(pixels.keep_gee_pixel(c("l_quantity"), c("l_discount"), c("l_tax"), 30, 0.03, 0.05)).alias("n_gee"), F.sum(pixels.cos_band_hls(angle, -32768.0)).alias("cosines"),
    )


_R = geo.RADIUS


@query(f"""
WITH p AS (SELECT c_custkey, c_acctbal / 200 AS lon, c_acctbal / 400 + 30 AS lat FROM customer),
a AS (SELECT *, (sin(radians(20)) + sin(radians(50))) / 2 AS n, cos(radians(20)) ** 2 + (sin(radians(20)) + sin(radians(50))) * sin(radians(20)) AS c FROM p),
b AS (SELECT *, {_R} / n * sqrt(c - 2 * n * sin(radians(lat))) AS rho, {_R} / n * sqrt(c - 2 * n * sin(radians(30))) AS rho0, n * radians(lon - 10) AS theta FROM a)
SELECT c_custkey, round(rho * sin(theta), 3) AS albers_x, round(rho0 - rho * cos(theta), 3) AS albers_y, round({_R} * radians(lon), 3) AS cyl_x, round({_R} * sin(radians(lat)), 3) AS cyl_y,
  round(lon, 6) AS lon, round(lat, 6) AS lat, round(abs({_R} * radians(0.01) * {_R} * (sin(radians(lat + 0.01)) - sin(radians(lat)))), 1) AS pixel_m2 FROM b""")
def projections(spark, d):
    """Two projections, the way back, and the area of a pixel."""
    p = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 200).alias("lon"), (F.col("c_acctbal") / 400 + 30).alias("lat"))
    ax, ay = geo.albers(F.col("lon"), F.col("lat"), 20, 50, 30, 10)
    cx, cy = geo.equal_area_cylinder(F.col("lon"), F.col("lat"))
    p = p.select("c_custkey", ax.alias("albers_x"), ay.alias("albers_y"), cx.alias("cyl_x"), cy.alias("cyl_y"), geo.pixel_area(F.col("lon"), F.col("lat"), 0.01, 0.01).alias("pixel_m2"))
    lon, _ = geo.albers_inverse(F.col("albers_x"), F.col("albers_y"), 20, 50, 30, 10)
    _, lat = geo.equal_area_cylinder_inverse(F.col("cyl_x"), F.col("cyl_y"))
    return _round(_round(_round(p.withColumns({"lon": lon, "lat": lat}), 6, "lon", "lat"), 3, "albers_x", "albers_y", "cyl_x", "cyl_y"), 1, "pixel_m2")


_E2 = geo.WGS84_F * (2 - geo.WGS84_F)
_EP2 = _E2 / (1 - _E2)


@query(f"""
WITH p AS (SELECT c_custkey, radians(50 + c_acctbal / 2000) AS phi, radians(c_acctbal / 4000) AS lam FROM customer),
a AS (SELECT *, {geo.WGS84_A}::DOUBLE / sqrt(1 - {_E2}::DOUBLE * sin(phi) ** 2) AS n, tan(phi) ** 2 AS t, {_EP2}::DOUBLE * cos(phi) ** 2 AS c, lam * cos(phi) AS a FROM p),
m AS (SELECT *, {geo.WGS84_A}::DOUBLE * ({1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256}::DOUBLE * phi - {3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024}::DOUBLE * sin(2 * phi) + {15 * _E2**2 / 256 + 45 * _E2**3 / 1024}::DOUBLE * sin(4 * phi) - {35 * _E2**3 / 3072}::DOUBLE * sin(6 * phi)) AS m FROM a)
SELECT c_custkey, round(500000 + 0.9996::DOUBLE * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t ** 2 + 72 * c - {58 * _EP2}::DOUBLE) * a ** 5 / 120), 3) AS easting,
  round(0.9996::DOUBLE * (m + n * tan(phi) * (a ** 2 / 2 + (5 - t + 9 * c + 4 * c ** 2) * a ** 4 / 24 + (61 - 58 * t + t ** 2 + 600 * c - {330 * _EP2}::DOUBLE) * a ** 6 / 720)), 3) AS northing FROM m""")
def utm_coordinates(spark, d):
    """Transverse Mercator of zone 36, around its middle of 33 degrees."""
    x, y = geo.utm(33 + F.col("c_acctbal") / 4000, 50 + F.col("c_acctbal") / 2000, 36)
    return _round(table(spark, d, "customer").select("c_custkey", x.alias("easting"), y.alias("northing")), 3, "easting", "northing")


@query("""SELECT l_suppkey, round(avg(yearly), 4) AS rain, round(3.6 * sum(s) / sum(n), 4) AS wind FROM (SELECT l_suppkey, year(l_shipdate) AS y, sum(l_tax) AS yearly, sum(l_quantity) AS s, count(l_quantity) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""")
def wind_means(spark, d):
    """Wind is meant in metres a second and given in kilometres an hour."""
    met = table(spark, d, "lineitem").select("l_suppkey", F.col("l_shipdate").alias("date"), F.col("l_tax").alias("rain"), F.col("l_quantity").alias("wind"))
    return _round(weather.location_stats(met, ["l_suppkey"], means=("wind",)), 4, "rain", "wind")


@query("""
WITH cols AS (SELECT l_suppkey, l_returnflag AS c, CASE WHEN max(l_extendedprice) > 50000 THEN 'double' ELSE 'string' END AS kind FROM lineitem GROUP BY 1, 2 UNION ALL SELECT l_suppkey, l_linestatus, 'int' FROM lineitem GROUP BY 1, 2),
s AS (SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN s_name || ' ' || s_suppkey ELSE replace(s_name, '#', CASE WHEN s_nationkey % 7 = 0 THEN ':' ELSE '_' END) END AS level, CASE WHEN s_nationkey % 6 <> 0 THEN CASE WHEN s_nationkey % 4 = 0 THEN 'X' ELSE 'A' END END AS name_column,
  CASE WHEN s_nationkey % 3 <> 0 THEN 'R' END AS reference_column, CASE WHEN s_nationkey % 2 = 0 THEN 'O' END AS year_column FROM supplier),
h AS (SELECT s.*, n.kind AS nk, r.kind AS rk, y.kind AS yk FROM s LEFT JOIN cols n ON n.l_suppkey = s_suppkey AND n.c = name_column LEFT JOIN cols r ON r.l_suppkey = s_suppkey AND r.c = reference_column LEFT JOIN cols y ON y.l_suppkey = s_suppkey AND y.c = year_column)
SELECT level, 'level name holds a colon or space' AS error FROM h WHERE contains(level, ':') OR contains(level, ' ')
UNION ALL SELECT level, 'no name column is set' FROM h WHERE name_column IS NULL
UNION ALL SELECT level, 'no column ' || name_column FROM h WHERE name_column IS NOT NULL AND nk IS NULL
UNION ALL SELECT level, 'column R is missing or not numeric' FROM h WHERE reference_column IS NOT NULL AND rk IS DISTINCT FROM 'double'
UNION ALL SELECT level, 'column R needs a year column' FROM h WHERE reference_column IS NOT NULL AND yk IS NULL""")
def level_tables(spark, d):
    """Q13: what is wrong with the tables of many levels, from their columns and settings."""
    line, sup = table(spark, d, "lineitem"), table(spark, d, "supplier")
    cols = line.groupBy("l_suppkey", F.col("l_returnflag").alias("column")).agg(F.when(F.max("l_extendedprice") > 50000, "double").otherwise("string").alias("kind"))
    cols = cols.unionByName(line.select("l_suppkey", F.col("l_linestatus").alias("column"), F.lit("int").alias("kind")).distinct())
    key = F.col("s_nationkey")
    name = F.when(key % 5 == 0, F.concat_ws(" ", "s_name", "s_suppkey")).otherwise(F.replace("s_name", F.lit("#"), F.when(key % 7 == 0, ":").otherwise("_")))
    levels = sup.select("s_suppkey", name.alias("level"), F.when(key % 6 != 0, F.when(key % 4 == 0, "X").otherwise("A")).alias("name_column"), F.when(key % 3 != 0, "R").alias("reference_column"), F.when(key % 2 == 0, "O").alias("year_column"))
    return checks.level_errors(cols.join(levels.select(F.col("s_suppkey").alias("l_suppkey"), "level"), "l_suppkey").drop("l_suppkey"), levels.drop("s_suppkey"))


@query("""
WITH b AS (SELECT r_name, n_name, s_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT b.*, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS date, avg(l_quantity) AS value, max((l_returnflag = 'R')::INT) AS f FROM lineitem JOIN b ON l_suppkey = s_suppkey GROUP BY ALL),
g AS (SELECT 0 AS level, r_name AS name, s_name, date, value, f FROM x UNION ALL SELECT 1, n_name, s_name, date, value, f FROM x UNION ALL SELECT 2, s_name, s_name, date, value, f FROM x),
m AS (SELECT 0 AS level, r_name AS name, count(*) AS n FROM b GROUP BY 2 UNION ALL SELECT 1, n_name, count(*) FROM b GROUP BY 2 UNION ALL SELECT 2, s_name, count(*) FROM b GROUP BY 2),
d AS (SELECT level, name, date, avg(value) AS value, max(f) AS f FROM g JOIN m USING (level, name) GROUP BY level, name, date HAVING count(DISTINCT s_name) = max(n)),
t AS (SELECT level, name, count(*) AS n_days, min(date) AS first_day, max(date) AS last_day, sum(value) AS total, sum(f) AS flags FROM d GROUP BY ALL),
k AS (SELECT DISTINCT 0 AS level, r_name AS name, n_name AS child FROM b UNION SELECT DISTINCT 1, n_name, s_name FROM b),
c AS (SELECT level, name, count(*) AS n_children, string_agg(child, ',' ORDER BY child) AS children FROM k GROUP BY ALL),
e AS (SELECT 0 AS level, r_name AS name, sum(s_acctbal) AS area FROM b JOIN supplier USING (s_suppkey) GROUP BY 2 UNION ALL SELECT 1, n_name, sum(s_acctbal) FROM b JOIN supplier USING (s_suppkey) GROUP BY 2)
SELECT m.level::INT AS level, m.name, coalesce(n_days, 0)::INT AS n_days, first_day, last_day, round(total, 3) AS total, flags::BIGINT AS flags, round(area, 2) AS area, coalesce(n_children, 0)::INT AS n_children, coalesce(children, '') AS child_names, children AS nested_names
FROM m LEFT JOIN t USING (level, name) LEFT JOIN c USING (level, name) LEFT JOIN e USING (level, name)""")
def hierarchy_json(spark, d):
    """Documents of three levels with series and children, read back out of their JSON."""
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    line = table(spark, d, "lineitem").join(sup.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
    series = line.groupBy("s_name", F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("date")).agg(F.avg("l_quantity").alias("value"), F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("interpolated"))
    areas = [sup.groupBy(F.lit(i).alias("level"), F.col(c).alias("name")).agg(F.sum("s_acctbal").alias("total_area")) for i, c in enumerate(("r_name", "n_name"))]
    docs = studies.level_documents(sup.select("r_name", "n_name", "s_name"), series, ["r_name", "n_name", "s_name"], areas[0].unionByName(areas[1]))
    kind = "struct<properties:struct<name:string,subregions:array<string>,timeSeries:array<double>,dateLabels:array<string>,interpolationFlags:array<int>,total_area:double>>"
    p = docs.withColumn("p", F.from_json("document", kind)["properties"]).withColumn("c", F.from_json("children", f"struct<features:array<{kind}>>")["features"])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return p.select(
        "level", F.col("p.name").alias("name"), F.coalesce(F.size("p.dateLabels"), F.lit(0)).alias("n_days"), F.array_min("p.dateLabels").alias("first_day"), F.array_max("p.dateLabels").alias("last_day"), F.round(total("p.timeSeries"), 3).alias("total"),
        total(F.transform("p.interpolationFlags", lambda x: x.cast("double"))).cast("long").alias("flags"), F.round("p.total_area", 2).alias("area"), F.size("p.subregions").alias("n_children"), F.array_join("p.subregions", ",").alias("child_names"),
        F.array_join(F.transform("c", lambda x: x["properties"]["name"]), ",").alias("nested_names"),
    )


@query("""SELECT c_custkey, 4 AS n_edges, c_custkey::DOUBLE AS xmin, c_custkey + 2.0::DOUBLE AS xmax FROM customer WHERE c_acctbal >= 0""")
def usable_rings(spark, d):
    """rings without area or of too few points are left out, and polygons that have no other."""
    x = F.col("c_custkey").cast("double")
    at = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    y = F.when(F.col("c_acctbal") >= 0, 1.0).otherwise(0.0)  # a flat ring where the balance is negative
    ring = F.array(at(x, F.lit(0.0)), at(x + 2, F.lit(0.0)), at(x + 2, y), at(x, y), at(x, F.lit(0.0)))
    short = F.array(at(x, F.lit(0.0)), at(x + 9, F.lit(5.0)), at(x, F.lit(0.0)))
    r = table(spark, d, "customer").select("c_custkey", F.array(ring, short).alias("rings"))
    return geo.with_edges(r).select("c_custkey", F.size("edges").alias("n_edges"), "xmin", "xmax")


_EDGES = ", ".join(f"('{n}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for n, p in _POLYGONS.items() for a, b in zip(p, p[1:] + p[:1]))


@query(f"""
WITH e(region, x1, y1, x2, y2) AS (VALUES {_EDGES}), p AS (SELECT row_number() OVER () AS id, l_quantity AS x, l_discount * 100 + 0.05 AS y FROM lineitem),
c AS (SELECT id, region FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT region, count(*) AS n FROM p LEFT JOIN c USING (id) GROUP BY region""")
def points_with_regions(spark, d):
    """Every point, with its region's attributes where it lies in one."""
    pts = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100 + 0.05).alias("y"))
    return geo.points_in_polygons(pts, _regions(spark), 10.0, how="left").groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey, s_name, n FROM supplier JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) ON s_suppkey = k""")
def keys_as_text(spark, d):
    """Keys of different names and types, compared as text."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("gid")).agg(F.count(F.lit(1)).alias("n"))
    return studies.match_on(table(spark, d, "supplier").select("s_suppkey", "s_name"), o, "s_suppkey", "gid").select("s_suppkey", "s_name", "n")


@query("""SELECT l_suppkey AS zone, round(avg(l_quantity), 6) AS lai_mean, round(median(l_quantity), 6) AS lai_median, round(stddev_pop(l_quantity), 6) AS lai_std, count(*) AS n_pixels,
  100.0 * count(*) FILTER (l_tax > 0.07 AND l_linenumber < 4) / count(*) FILTER (l_linenumber < 4) AS cloud_pct FROM lineitem WHERE true GROUP BY 1""".replace("avg(l_quantity)", "avg(l_quantity) FILTER (l_tax <= 0.07)").replace("median(l_quantity)", "median(l_quantity) FILTER (l_tax <= 0.07)").replace("stddev_pop(l_quantity)", "stddev_pop(l_quantity) FILTER (l_tax <= 0.07)").replace("count(*) AS n_pixels", "count(*) FILTER (l_tax <= 0.07) AS n_pixels").replace("100.0 *", "round(100.0 *").replace("(l_linenumber < 4) AS cloud_pct", "(l_linenumber < 4), 6) AS cloud_pct"))
def zone_statistics(spark, d):
    """The daily statistics with zones as keys."""
    cells = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("zone"), F.when(F.col("l_tax") <= 0.07, F.col("l_quantity")).alias("v"), F.when(F.col("l_linenumber") < 4, 1).otherwise(0).alias("m"))
    out = lai.daily_stats(cells, ["zone"]).select("zone", "lai_mean", "lai_median", "lai_std", "n_pixels", "cloud_pct")
    return _round(out, 6, "lai_mean", "lai_median", "lai_std", "cloud_pct")


@query("""
WITH z AS (SELECT l_suppkey AS region, round(100.0 * count(*) FILTER (l_quantity > 24 AND l_suppkey > 3) / count(*), 1) AS coverage_pct FROM lineitem GROUP BY 1)
SELECT region, coverage_pct, CASE WHEN coverage_pct = 0 THEN 'no coverage' ELSE 'less than half covered' END AS warning FROM z WHERE coverage_pct < 50""")
def coverage_warnings(spark, d):
    """Q9."""
    hit = (F.col("l_quantity") > 24) & (F.col("l_suppkey") > 3)
    z = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("region")).agg(F.round(100.0 * F.count_if(hit) / F.count(F.lit(1)), 1).alias("coverage_pct"))
    return zonal.coverage_warnings(z)


@query("""SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49.5 AND l_discount > 0.08) GROUP BY 1""")
def usable_tiles(spark, d):
    """Q12: tiles of which the last band has any value."""
    line = table(spark, d, "lineitem")
    px = line.select(F.col("l_suppkey").alias("tile"), F.when((F.col("l_quantity") > 49.5) & (F.col("l_discount") > 0.08), F.col("l_quantity")).alias("b12"))
    good = simulation.usable_tiles(px)
    return line.join(good, F.col("l_suppkey") == F.col("tile"), "left_semi").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH p AS (SELECT l_suppkey AS region, round(avg(l_extendedprice), 2) AS pred FROM lineitem GROUP BY 1)
SELECT region, pred, s_acctbal AS ref, round(s_acctbal - pred, 4) AS reported_minus_predicted FROM p JOIN supplier ON region = s_suppkey""")
def ranked_errors(spark, d):
    """Reported minus predicted, largest first."""
    p = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("region")).agg(F.round(F.avg("l_extendedprice"), 2).alias("pred"))
    j = p.join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"), F.col("s_acctbal").alias("ref")), "region")
    return _round(evaluate.with_reported_error(j, "pred", "ref"), 4, "reported_minus_predicted")


@query("""
WITH m AS (SELECT l_orderkey, max(l_extendedprice) AS top FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY top DESC, l_orderkey) AS rank FROM m)
SELECT l_orderkey, top FROM r WHERE rank <= 25""")
def first_matches(spark, d):
    """T4: the best 25 simulations in stated order."""
    m = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("top"))
    return simulation.first_matches(m.withColumn("rank", F.struct(-F.col("top"), F.col("l_orderkey"))), 25).select("l_orderkey", "top")


@query("""SELECT user_id, count(*) AS n, round(sum(value * 2), 4) AS total FROM events WHERE value * 2 > 100 GROUP BY 1""")
def hooked_steps(spark, d):
    """A caller's steps one after another."""
    return _round(simulation.hooked(table(spark, d, "events"), lambda x: x.withColumn("value", F.col("value") * 2), lambda x: x.where("value > 100"), lambda x: x.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))), 4, "total")


@query("""
WITH c AS (SELECT l_suppkey AS region, floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, (1 + max(l_tax) * 37) / 7 AS weight FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, avg(CASE WHEN l_tax > 0.01 THEN l_extendedprice END) AS v, 1 AS covered FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
j AS (SELECT region, weight, v, covered, CASE WHEN v IS NOT NULL THEN weight END AS w FROM c LEFT JOIN p USING (ix, iy)),
m AS (SELECT region, v, sum(w) OVER (PARTITION BY region ORDER BY v) AS cum, sum(w) OVER (PARTITION BY region) AS total FROM j WHERE v IS NOT NULL),
k AS (SELECT region, min(v) AS median FROM m WHERE cum >= total / 2 GROUP BY region)
SELECT j.region, round(sum(v * w) / sum(w))::BIGINT AS mean_yield_kg_ha, round(sum(w) * 0.04, 2) AS total_area_ha, round(sum(v * w) * 0.04)::BIGINT AS total_production_kg, round(sum(v * w) * 0.04 / 1000, 3) AS total_production_ton,
  round(100 * sum(weight * coalesce(covered, 0)) / sum(weight), 1) AS coverage_pct, round(sum(weight * coalesce(covered, 0)) * 0.04, 2) AS covered_area_ha, round(any_value(median))::BIGINT AS median_yield_kg_ha
FROM j LEFT JOIN k ON j.region = k.region GROUP BY j.region""")
def zonal_statistics(spark, d):
    """A4: weighted mean, median, area, production and coverage of every region from shares of cells."""
    line = table(spark, d, "lineitem")
    cell = [F.floor("l_quantity").cast("int").alias("ix"), F.round(F.col("l_discount") * 100).cast("int").alias("iy")]
    cover = line.groupBy(F.col("l_suppkey").alias("region"), *cell).agg(((1 + F.max("l_tax") * 37) / 7).alias("weight"))
    raster = F.col("l_returnflag") == "N"
    px = line.groupBy(*cell).agg(F.avg(F.when(raster & (F.col("l_tax") > 0.01), F.col("l_extendedprice"))).alias("v"), F.max(F.when(raster, 1)).alias("covered"))
    return zonal.zonal_stats(px, cover, 0.04)


@query("""SELECT l_suppkey, min(l_quantity) AS xmin, min(l_tax) AS ymin, max(l_quantity) AS xmax, max(l_tax) AS ymax, max(l_linenumber) = min(l_linenumber) AS same_resolution FROM lineitem GROUP BY 1""")
def raster_extents(spark, d):
    """Extent of each supplier's rasters, and whether their resolutions agree."""
    g = table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").alias("xmin"), F.col("l_tax").alias("ymin"), F.col("l_quantity").alias("xmax"), F.col("l_tax").alias("ymax"), F.col("l_linenumber").alias("dx"), F.lit(1.0).alias("dy"))
    return geo.union_extent(g, ["l_suppkey"])


@query(f"""
WITH g AS (SELECT l_orderkey * 10 + l_linenumber AS product, l_returnflag AS crs, l_tax AS xmin, l_discount AS ymin, l_tax + l_quantity AS xmax, 100 AS width FROM lineitem),
c AS (SELECT crs FROM g GROUP BY crs ORDER BY count(*) DESC, crs LIMIT 1), t AS (SELECT g.* FROM g JOIN c USING (crs) ORDER BY product LIMIT 1)
SELECT crs, round(({_R} * radians(xmax) - {_R} * radians(xmin)) / width, 4) AS resolution FROM t""")
def target_resolution(spark, d):
    """The commonest system's sample tile sets the resolution of a target system."""
    g = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("product"), F.col("l_returnflag").alias("crs"), F.col("l_tax").alias("xmin"), F.col("l_discount").alias("ymin"), (F.col("l_tax") + F.col("l_quantity")).alias("xmax"), F.col("l_discount").alias("ymax"), F.lit(100).alias("width"),
    )
    return _round(zonal.target_resolution(g, geo.equal_area_cylinder), 4, "resolution")


@query("""
WITH o AS (SELECT l_returnflag AS crs, -(l_linenumber * 2.5) AS dx, l_linestatus || '/' || l_orderkey || '.tif' AS path FROM lineitem)
SELECT crs, abs(dx)::DOUBLE AS resolution FROM o ORDER BY path, crs, dx LIMIT 1""")
def existing_resolution(spark, d):
    """Outputs that are there set the target, not the sample tile."""
    line = table(spark, d, "lineitem")
    g = line.select(F.col("l_orderkey").alias("product"), F.col("l_returnflag").alias("crs"), F.col("l_tax").alias("xmin"), F.col("l_discount").alias("ymin"), (F.col("l_tax") + F.col("l_quantity")).alias("xmax"), F.col("l_discount").alias("ymax"), F.lit(100).alias("width"))
    there = line.select(F.concat("l_linestatus", F.lit("/"), F.col("l_orderkey").cast("string"), F.lit(".tif")).alias("path"), F.col("l_returnflag").alias("crs"), (-(F.col("l_linenumber") * 2.5)).alias("dx"))
    return zonal.target_resolution(g, geo.equal_area_cylinder, there)


@query("""
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS name, l_quantity AS xmin, l_extendedprice / 1000 AS ymin, l_quantity + l_linenumber * l_discount AS xmax, l_extendedprice / 1000 + l_tax * 10 AS ymax FROM lineitem),
s AS (SELECT s_suppkey AS name, abs(s_acctbal) / 200 AS xmin, s_suppkey % 100 * 1.0 AS ymin, abs(s_acctbal) / 200 + s_nationkey * 0.3 AS xmax, s_suppkey % 100 + 1.5 AS ymax FROM supplier)
SELECT r.name, s.name AS b_name FROM r JOIN s ON greatest(r.xmin, s.xmin) < least(r.xmax, s.xmax) AND greatest(r.ymin, s.ymin) < least(r.ymax, s.ymax)""")
def overlapping_boxes(spark, d):
    """Small boxes of line items against boxes of suppliers, of many sizes, by tiles."""
    boxes = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("name"), F.col("l_quantity").alias("xmin"), (F.col("l_extendedprice") / 1000).alias("ymin"), (F.col("l_quantity") + F.col("l_linenumber") * F.col("l_discount")).alias("xmax"), (F.col("l_extendedprice") / 1000 + F.col("l_tax") * 10).alias("ymax"))
    x = F.abs("s_acctbal") / 200
    wide = table(spark, d, "supplier").select(F.col("s_suppkey").alias("name"), x.alias("xmin"), (F.col("s_suppkey") % 100).cast("double").alias("ymin"), (x + F.col("s_nationkey") * 0.3).alias("xmax"), (F.col("s_suppkey") % 100 + 1.5).alias("ymax"))
    return geo.overlaps(boxes, wide)


@query("""SELECT event_type, user_id, max(value) AS max_lai, count(*) AS n_pixels FROM events GROUP BY ALL""")
def folded_ranges(spark, d):
    """R2: overlapping ranges of days in three batches, one of them run twice; every landed day is read once and counted once."""
    at, out = _folder(spark, "landed-days"), _folder(spark, "season")
    px = table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("date"), F.col("value").alias("v"))
    px.write.partitionBy("date").parquet(at)
    ends = px.groupBy("event_type").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    part = lambda x, y: ends.select("event_type", F.date_add("a", F.floor(F.datediff("b", "a") * F.lit(x)).cast("int")).alias("first"), F.date_add("a", F.ceil(F.datediff("b", "a") * F.lit(y)).cast("int")).alias("last"))
    wanted = [part(0.4, 0.7), part(0.1, 0.5).unionByName(part(0.6, 0.8)), part(0.0, 1.0)]
    landed = spark.read.schema(px.schema).parquet(at)
    for number in (0, 1, 1, 2):
        ledger.fold_ranges(landed, wanted[number], out, number, ["event_type"], ["user_id"])
    return ledger.folded(spark, out)


@query("""SELECT user_id, max(value) AS max_lai FROM events GROUP BY 1""")
def streamed_maximum(spark, d):
    """R2: the running maximum of each key, over landed files, as the stream leaves it."""
    at, out = _folder(spark, "landed"), _folder(spark, "maxima")
    ev = table(spark, d, "events").select("user_id", "ts", F.col("value").alias("v"))
    ev.write.option("maxRecordsPerFile", 4000).parquet(at)
    stream = jobs.running_max(spark.readStream.schema(ev.schema).parquet(at), ["user_id"])
    keep = lambda batch, number: batch.write.mode("overwrite").parquet(out)
    stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", _folder(spark, "maxima-log")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query("""
WITH g AS (SELECT user_id, ts::DATE AS date, round(max(value), 4) AS v FROM events GROUP BY ALL), i AS (SELECT user_id, date, CASE WHEN dayofyear(date) % 5 <> 0 THEN v END AS v FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date) AS i FROM i), k AS (SELECT *, CASE WHEN v IS NOT NULL THEN i END AS k FROM r),
b AS (SELECT user_id, date, v, i, last_value(k IGNORE NULLS) OVER w1 AS pk, last_value(v IGNORE NULLS) OVER w1 AS pv, first_value(k IGNORE NULLS) OVER w2 AS nk, first_value(v IGNORE NULLS) OVER w2 AS nv FROM k
  WINDOW w1 AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), w2 AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, date, round(coalesce(v, pv + (nv - pv) * (i - pk) / (nk - pk), pv, nv), 8) AS v FROM b""")
def appended_days(spark, d):
    """Days land in two deliveries that overlap; the store takes missing days only and cleans the whole again."""
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("date")).agg(F.round(F.max("value"), 4).alias("v"))
    days = days.withColumn("v", F.when(F.dayofyear("date") % 5 != 0, F.col("v")))
    landed, store, cleaned, log = (_folder(spark, x) for x in ("days", "store", "cleaned", "days-log"))

    def deliver(part: DataFrame) -> None:
        part.write.mode("append").parquet(landed)
        jobs.append_missing_days(spark, spark.readStream.schema(days.schema).parquet(landed), store, cleaned, log, ["v"], keys=("user_id",)).awaitTermination()

    deliver(days.where("date < date'2024-01-18'"))
    deliver(days.where("date >= date'2024-01-15'").withColumn("v", F.when(F.col("date") >= F.lit("2024-01-18").cast("date"), F.col("v")).otherwise(-1.0)))
    return _round(jobs.latest_cleaned(spark, cleaned, ["user_id"]), 8, "v")


@query("""
WITH t AS (SELECT event_type, ts::DATE AS date, user_id, CASE WHEN value >= 5 THEN value - 5 END AS v FROM events),
m AS (SELECT event_type, user_id, max(v) AS top FROM t GROUP BY ALL)
SELECT event_type, date, round(avg(v), 8) AS lai_mean, round(stddev_pop(v), 8) AS lai_std, any_value(p.peak) AS peak FROM t JOIN (SELECT event_type, max(top) AS peak FROM m GROUP BY 1) p USING (event_type) GROUP BY event_type, date""")
def legacy_stats(spark, d):
    """Mean and deviation by day, with the season's maximum over the pixels' own."""
    cells = table(spark, d, "events").select("event_type", F.to_date("ts").alias("date"), "user_id", (F.col("value") - 5).alias("v"))
    daily, top = lai.legacy_daily_stats(cells, ["event_type"], ["event_type", "user_id"])
    out = daily.join(top.groupBy("event_type").agg(F.max("max_lai").alias("peak")), "event_type")
    return _round(out, 8, "lai_mean", "lai_std")
