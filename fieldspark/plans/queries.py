"""Queries over the driver tables, each with the DuckDB SQL it is held against.

Analogy: user = region, event type = product, day = date, `value` = leaf area or rain; line item = pixel,
supplier = region, nation and region = admin levels, `l_quantity` = area weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions import dates, names, pixels
from fieldspark.operators import checks, evaluate, geo, lai, series, simulation, studies, weather, zonal
from fieldspark.plans.registry import query
from fieldspark.session import materialize, table
from fieldspark.sources import readers, sinks


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _levels(spark, d) -> DataFrame:
    """Line items with the nation and region of their supplier."""
    line, sup, nat, reg = (table(spark, d, t) for t in ("lineitem", "supplier", "nation", "region"))
    return line.join(sup, line.l_suppkey == sup.s_suppkey).join(nat, F.col("s_nationkey") == F.col("n_nationkey")).join(reg, F.col("n_regionkey") == F.col("r_regionkey"))


_LEVELS = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
SELECT r_name, n_name, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS mean_yield, sum(l_quantity) AS area
FROM {_LEVELS} GROUP BY r_name, n_name""")
def weighted_mean_by_level(spark, d):
    """Area-weighted mean of each nation."""
    out = _levels(spark, d).groupBy("r_name", "n_name").agg(evaluate.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")).alias("mean_yield"), F.sum("l_quantity").alias("area"))
    return _round(out, 4, "mean_yield")


@query(f"""
WITH c AS (SELECT n_name, l_extendedprice AS x, sum(l_quantity) OVER (PARTITION BY n_name ORDER BY l_extendedprice) AS cum, sum(l_quantity) OVER (PARTITION BY n_name) AS total FROM {_LEVELS})
SELECT n_name, min(x) AS weighted_median FROM c WHERE cum >= total / 2 GROUP BY n_name""")
def weighted_median_by_level(spark, d):
    """A7, W9."""
    return evaluate.weighted_median(_levels(spark, d), ["n_name"], "l_extendedprice", "l_quantity")


def _pairs(spark, d) -> DataFrame:
    line = table(spark, d, "lineitem")
    return line.groupBy(F.col("l_suppkey").alias("region"), F.year("l_shipdate").alias("year")).agg(F.round(F.avg("l_extendedprice"), 2).alias("pred"), F.round(F.avg(F.col("l_quantity") * 1000), 2).alias("obs"))


_PAIRS = "SELECT l_suppkey AS region, year(l_shipdate)::INT AS year, round(avg(l_extendedprice), 2) AS pred, round(avg(l_quantity * 1000), 2) AS obs FROM lineitem GROUP BY ALL"
_METRICS = """count(*) AS n, round(avg(abs((pred - obs) / nullif(obs, 0))), 6) AS mape, round(avg(pred - obs), 4) AS mean_error,
  round(quantile_cont(pred - obs, 0.5), 4) AS median_error, round(avg(abs(pred - obs)), 4) AS mean_abs_error, round(quantile_cont(abs(pred - obs), 0.5), 4) AS median_abs_error,
  round(sqrt(avg((pred - obs) ** 2)), 4) AS rmse, round(100 * sqrt(avg((pred - obs) ** 2)) / avg(obs), 4) AS rrmse,
  round(1 - sum((pred - obs) ** 2) / nullif(sum(obs * obs) - sum(obs) * sum(obs) / count(*), 0), 6) AS r2,
  round((sum(pred * obs) - sum(pred) * sum(obs) / count(*)) ** 2 / nullif((sum(pred * pred) - sum(pred) * sum(pred) / count(*)) * (sum(obs * obs) - sum(obs) * sum(obs) / count(*)), 0), 6) AS pearson_r2,
  round((sum(pred * obs) - sum(pred) * sum(obs) / count(*)) ** 2 / nullif((sum(pred * pred) - sum(pred) * sum(pred) / count(*)) * (sum(obs * obs) - sum(obs) * sum(obs) / count(*)), 0), 6) AS best_fit_r2"""


def _round_metrics(df: DataFrame) -> DataFrame:
    return _round(_round(df, 6, "mape", "r2", "pearson_r2", "best_fit_r2"), 4, "mean_error", "median_error", "mean_abs_error", "median_abs_error", "rmse", "rrmse")


@query(f"SELECT year, {_METRICS} FROM ({_PAIRS}) GROUP BY year")
def eval_metrics(spark, d):
    """J1, A8, A38."""
    return _round_metrics(evaluate.metrics(_pairs(spark, d), ["year"]))


@query(f"SELECT year, grouping(year)::INT AS level_of_total, {_METRICS} FROM ({_PAIRS}) GROUP BY ROLLUP (year)")
def eval_metrics_rollup(spark, d):
    """A30."""
    return _round_metrics(evaluate.metrics_rollup(_pairs(spark, d), ["year"]))


@query("""
WITH p AS (SELECT l_suppkey AS region, round(avg(l_extendedprice), 2) AS pred, sum(l_quantity) AS area FROM lineitem GROUP BY 1),
o AS (SELECT s_suppkey AS region, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS mean, s_acctbal * 100 AS kg FROM supplier),
m AS (SELECT region, pred, coalesce(mean, kg / area) AS obs FROM p JOIN o USING (region))
SELECT region::VARCHAR AS region, pred, round(obs, 4) AS obs, round(round(pred - obs, 4), 1) AS error, CASE WHEN obs <> 0 THEN round(round(100 * (pred - obs) / obs, 4), 1) END AS rel_error FROM m WHERE obs IS NOT NULL""")
def region_errors(spark, d):
    """Predictions joined with reported yields, some of them derived from production."""
    pred = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("region")).agg(F.round(F.avg("l_extendedprice"), 2).alias("mean_yield_kg_ha"), F.sum("l_quantity").alias("total_area_ha"))
    obs = table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("reported_mean_yield_kg_ha"), (F.col("s_acctbal") * 100).alias("reported_production_kg"))
    m = evaluate.match(pred, obs)
    e = F.round(F.round(F.col("pred") - F.col("obs"), 4), 1)
    return m.select("region", "pred", F.round("obs", 4).alias("obs"), e.alias("error"), F.when(F.col("obs") != 0, F.round(F.round(100 * (F.col("pred") - F.col("obs")) / F.col("obs"), 4), 1)).alias("rel_error"))


@query("""
SELECT event_type, ts::DATE AS date, round(avg(value), 8) AS lai_mean, round(median(value), 8) AS lai_median, round(stddev_pop(value), 8) AS lai_std,
  round(avg(0.0482 * value * value + 0.9161 * value + 0.0026), 8) AS lai_mean_adj, round(median(0.0482 * value * value + 0.9161 * value + 0.0026), 8) AS lai_median_adj,
  round(stddev_pop(0.0482 * value * value + 0.9161 * value + 0.0026), 8) AS lai_std_adj, count(value) AS n_pixels, 0.0::DOUBLE AS cloud_pct
FROM events GROUP BY ALL""")
def daily_stats(spark, d):
    """A1, P3, P4."""
    cells = table(spark, d, "events").select("event_type", F.to_date("ts").alias("date"), F.col("value").alias("v"), F.lit(1).alias("m"))
    return _round(lai.daily_stats(cells, ["event_type", "date"], "wheat"), 8, *lai.STATS)


@query("""
WITH s AS (SELECT event_type, ts::DATE AS date, 100.0 * count(*) FILTER (value > 400) / count(*) AS cloud_pct, count(*) FILTER (value <= 400) AS n_pixels, avg(value) FILTER (value <= 400) AS m FROM events GROUP BY ALL)
SELECT event_type, date, round(cloud_pct, 8) AS cloud_pct, n_pixels, CASE WHEN NOT (cloud_pct > 1.0 OR n_pixels = 0) THEN round(m, 8) END AS lai_mean FROM s""")
def missing_share(spark, d):
    """Values over 400 are missing; days with more than 1 percent missing keep their row without statistics."""
    v = F.when(F.col("value") <= 400, F.col("value"))
    cells = table(spark, d, "events").select("event_type", F.to_date("ts").alias("date"), v.alias("v"), F.lit(1).alias("m"))
    out = lai.reject_cloudy(lai.daily_stats(cells, ["event_type", "date"]), 0.01)
    return _round(out.select("event_type", "date", "cloud_pct", "n_pixels", "lai_mean"), 8, "cloud_pct", "lai_mean")


@query("""SELECT user_id, json_extract(props, '$.k')::INT AS k, max(value) AS max_lai, round(max(-0.078 * value * value + 1.4 * value - 0.18), 4) AS max_lai_adj FROM events WHERE value >= 0 GROUP BY ALL""")
def pixel_max(spark, d):
    """A3."""
    ev = table(spark, d, "events").select("user_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("value").alias("v"))
    return _round(lai.season_max(ev, ["user_id", "k"], "maize"), 4, "max_lai_adj")


_ZONES = [("A", 0, 30, 0, 4), ("B", 30, 60, 0, 6), ("C", 60, 110, 3, 11)]


@query("""
WITH z(zone, x1, x2, y1, y2) AS (VALUES ('A', 0, 30, 0, 4), ('B', 30, 60, 0, 6), ('C', 60, 110, 3, 11)),
p AS (SELECT floor(l_extendedprice / 1000)::INT AS ix, floor(l_quantity / 5)::INT AS iy, l_discount * 100 AS v FROM lineitem)
SELECT zone, count(*) AS n, round(avg(v), 4) AS mean_yield, round(median(v), 4) AS median_yield, round(sum(v), 2) AS production FROM p JOIN z ON ix >= x1 AND ix < x2 AND iy >= y1 AND iy < y2 GROUP BY zone""")
def zonal_grid(spark, d):
    """Line items fall in cells, cells belong to zones."""
    rows = [(z, x, y) for z, x1, x2, y1, y2 in _ZONES for x in range(x1, x2) for y in range(y1, y2)]
    cells = spark.createDataFrame(rows, "zone string, ix int, iy int")
    px = table(spark, d, "lineitem").select(geo.cell_index(F.col("l_extendedprice"), 0, 1000).alias("ix"), geo.cell_index(F.col("l_quantity"), 0, 5).alias("iy"), (F.col("l_discount") * 100).alias("v"))
    out = px.join(cells, ["ix", "iy"]).groupBy("zone").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean_yield"), F.median("v").alias("median_yield"), F.sum("v").alias("production"))
    return _round(_round(out, 4, "mean_yield", "median_yield"), 2, "production")


_POLYGONS = {"P": [(1.3, 0.4), (30.2, 0.7), (24.6, 8.3), (3.1, 6.2)], "Q": [(20.4, 2.3), (49.7, 1.6), (44.4, 9.4)], "R": [(10.7, 5.3), (40.3, 5.6), (35.6, 9.7), (22.3, 6.1), (12.2, 9.2)]}
_EDGES = ", ".join(f"('{n}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for n, p in _POLYGONS.items() for a, b in zip(p, p[1:] + p[:1]))


def _regions(spark) -> DataFrame:
    return spark.createDataFrame([(n, [[(x, y) for x, y in p + p[:1]]]) for n, p in _POLYGONS.items()], "region string, rings array<array<struct<x: double, y: double>>>")


@query(f"""
WITH e(region, x1, y1, x2, y2) AS (VALUES {_EDGES}), p AS (SELECT row_number() OVER () AS id, l_orderkey, l_quantity AS x, l_discount * 100 + 0.05 AS y FROM lineitem),
c AS (SELECT id, l_orderkey, region, count(*) AS n FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) GROUP BY ALL)
SELECT region, count(*) AS n_points, sum(l_orderkey)::BIGINT AS key_sum FROM c WHERE n % 2 = 1 GROUP BY region""")
def point_in_polygon(spark, d):
    """Points by quantity and discount in literal polygons; the checked sum pins the points found."""
    pts = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").alias("x"), (F.col("l_discount") * 100 + 0.05).alias("y"))
    return geo.points_in_polygons(pts, _regions(spark), 10.0).groupBy("region").agg(F.count(F.lit(1)).alias("n_points"), F.sum("l_orderkey").alias("key_sum"))


@query("""
WITH y AS (SELECT l_suppkey, year(l_shipdate) AS y, sum(l_quantity) AS rain, sum(l_extendedprice) AS s, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, round(avg(rain), 4) AS rain, round(sum(s) / sum(n), 4) AS radn FROM y GROUP BY l_suppkey""")
def annual_rain_mean(spark, d):
    """A9."""
    met = table(spark, d, "lineitem").select("l_suppkey", F.col("l_shipdate").alias("date"), F.col("l_quantity").alias("rain"), F.col("l_extendedprice").alias("radn"))
    return _round(weather.location_stats(met, ["l_suppkey"], means=("radn",)).select("l_suppkey", "rain", "radn"), 4, "rain", "radn")


@query("""
WITH m AS (SELECT l_suppkey, month(l_shipdate) AS m, avg(l_quantity) AS v FROM lineitem GROUP BY ALL)
SELECT l_suppkey, round(avg(v), 4) AS tav, round(max(v) - min(v), 4) AS amp FROM m GROUP BY l_suppkey""")
def tav_amp(spark, d):
    """A10."""
    return _round(weather.tav_amp(table(spark, d, "lineitem"), ["l_suppkey"], "l_shipdate", "l_quantity"), 4, "tav", "amp")


_CLIM = """c AS (SELECT l_returnflag, dayofyear(l_shipdate)::INT AS doy, avg(l_quantity) AS rain FROM lineitem WHERE year(l_shipdate) < 2001 GROUP BY ALL),
f AS (SELECT * FROM c UNION ALL SELECT l_returnflag, 366, rain FROM c WHERE doy = 365 AND l_returnflag NOT IN (SELECT l_returnflag FROM c WHERE doy = 366))"""


@query(f"WITH {_CLIM} SELECT l_returnflag, doy, round(rain, 4) AS rain FROM f")
def doy_climatology(spark, d):
    """A11."""
    met = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", F.col("l_quantity").alias("rain"))
    return _round(weather.doy_climatology(met, ["l_returnflag"], "l_shipdate", ["rain"], "2001-01-01"), 4, "rain")


@query(f"""WITH {_CLIM}, s AS (SELECT unnest(generate_series(DATE '2003-12-01', DATE '2004-12-31', INTERVAL 1 DAY))::DATE AS date)
SELECT l_returnflag, date, doy, round(rain, 4) AS rain, 'projected' AS data_type FROM s JOIN f ON doy = dayofyear(date)""")
def project_days(spark, d):
    """A leap year's days from the climatology."""
    met = table(spark, d, "lineitem").select("l_returnflag", "l_shipdate", F.col("l_quantity").alias("rain"))
    clim = weather.doy_climatology(met, ["l_returnflag"], "l_shipdate", ["rain"], "2001-01-01")
    ends = met.select("l_returnflag").distinct().select("l_returnflag", F.lit("2003-12-01").alias("a"), F.lit("2004-12-31").alias("b"))
    return _round(weather.project_days(clim, series.date_spine(ends, "a", "b"), ["l_returnflag"]).select("l_returnflag", "date", "doy", "rain", "data_type"), 4, "rain")


@query("""
WITH u AS (SELECT DISTINCT user_id, ts::DATE AS date FROM events), r AS (SELECT min(date) AS a, max(date) AS b FROM u),
s AS (SELECT DISTINCT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS date FROM u, r)
SELECT user_id, date FROM s WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.user_id = s.user_id AND u.date = s.date)""")
def held_dates_missing(spark, d):
    """J5, W11, U3."""
    held = table(spark, d, "events").select("user_id", F.to_date("ts").alias("date"))
    ends = held.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spine = series.date_spine(held.select("user_id").distinct().join(ends), "a", "b")
    return weather.missing_days(spine, held, ["user_id", "date"])


@query("""
WITH u AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events), g AS (SELECT user_id, d, d - (row_number() OVER (PARTITION BY user_id ORDER BY d))::INT AS g FROM u)
SELECT user_id, min(d) AS first_day, max(d) AS last_day, count(*) AS n_days FROM g GROUP BY user_id, g""")
def date_runs(spark, d):
    """W6."""
    return series.date_runs(table(spark, d, "events"), ["user_id"], "ts")


def _gappy(spark, d) -> DataFrame:
    """Daily means of each event type, every third day blank."""
    daily = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("date")).agg(F.round(F.avg("value"), 8).alias("v"))
    return daily.withColumn("v", F.when(F.dayofyear("date") % 3 != 0, F.col("v")))


_GAPPY = "SELECT event_type, ts::DATE AS date, CASE WHEN dayofyear(ts::DATE) % 3 <> 0 THEN round(avg(value), 8) END AS v FROM events GROUP BY event_type, ts::DATE"


@query(f"""
WITH g AS ({_GAPPY}), i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY date) AS i, CASE WHEN v IS NOT NULL THEN row_number() OVER (PARTITION BY event_type ORDER BY date) END AS k FROM g),
b AS (SELECT event_type, date, v, i, last_value(k IGNORE NULLS) OVER w1 AS pk, last_value(v IGNORE NULLS) OVER w1 AS pv, first_value(k IGNORE NULLS) OVER w2 AS nk, first_value(v IGNORE NULLS) OVER w2 AS nv FROM i
  WINDOW w1 AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), w2 AS (PARTITION BY event_type ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_type, date, round(coalesce(v, pv + (nv - pv) * (i - pk) / (nk - pk), pv, nv), 6) AS v FROM b""")
def linear_fill(spark, d):
    """W5."""
    return _round(series.linear_fill(_gappy(spark, d), ["event_type"], "date", ["v"]), 6, "v")


_HAT9 = [f"{x}::DOUBLE" for x in series.hat_matrix(9)[4]]
_SUM9 = " + ".join(f"{h} * {'lag' if k < 4 else 'lead'}(v, {abs(k - 4)}) OVER w" if k != 4 else f"{h} * v" for k, h in enumerate(_HAT9))


@query(f"""
WITH g AS (SELECT * FROM ({_GAPPY}) WHERE v IS NOT NULL), s AS (SELECT event_type, date, v, {_SUM9} AS s FROM g WINDOW w AS (PARTITION BY event_type ORDER BY date))
SELECT event_type, date, v AS unsmoothed, round(greatest(s, 0), 6) AS v FROM s WHERE s IS NOT NULL""")
def savgol_smooth(spark, d):
    """W3 away from the ends, where the window is whole."""
    w = Window.partitionBy("event_type").orderBy("date")
    out = series.savgol_smooth(_gappy(spark, d), ["event_type"], "date", ["v"]).where(F.col("v").isNotNull())
    inner = F.row_number().over(w) > 4, F.row_number().over(w.orderBy(F.desc("date"))) > 4
    out = out.withColumns({"a": inner[0], "b": inner[1]}).where("a and b")
    return out.select("event_type", "date", F.col("v Unsmoothed").alias("unsmoothed"), F.round("v", 6).alias("v"))


def _smooth_sql(rows: str) -> str:
    """CTEs from `rows`(series, date, v) to fit(series, date, v): W3 over the valid values of each series."""
    hats = ", ".join(f"({w}, {r}, {j}, {h!r}::DOUBLE)" for w in (4, 5, 7, 9) for r, row in enumerate(series.hat_matrix(w)) for j, h in enumerate(row))
    return f"""
hat(w, r, j, h) AS (VALUES {hats}),
known AS (SELECT series, date, v, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS k, count(*) OVER (PARTITION BY series) AS n FROM {rows} WHERE v IS NOT NULL),
sized AS (SELECT *, CASE WHEN n >= 9 THEN 9 WHEN n > 4 AND n % 2 = 0 THEN n - 1 ELSE n END AS w FROM known),
begun AS (SELECT *, least(greatest(k - (w - 1) // 2, 0), n - w) AS b FROM sized),
fit AS (
  SELECT s.series, s.date, greatest(sum(hat.h * y.v), 0) AS v FROM begun s JOIN hat ON hat.w = s.w AND hat.r = s.k - s.b JOIN known y ON y.series = s.series AND y.k = s.b + hat.j GROUP BY s.series, s.date
  UNION ALL SELECT series, date, v FROM known WHERE n < 4
)"""


def _akima_sql(rows: str) -> str:
    """CTEs from `rows`(series, date, v) to curve(series, date, v, filled): W4."""
    return f"""
steps AS (
  SELECT series, date, v, (lead(v) OVER s - v) / (lead(date) OVER s - date) AS m, lead(date) OVER s AS next_date, lead(v) OVER s AS next_v
  FROM {rows} WHERE v IS NOT NULL WINDOW s AS (PARTITION BY series ORDER BY date)
), around AS (SELECT *, lag(m) OVER s AS p, lag(m, 2) OVER s AS p2, lead(m) OVER s AS m1 FROM steps WINDOW s AS (PARTITION BY series ORDER BY date)),
inner_slopes AS (SELECT *, coalesce(m, 2 * p - p2, p) AS c, coalesce(p, 2 * m - m1, m) AS b FROM around),
slopes AS (SELECT *, coalesce(m1, 2 * c - b) AS d, coalesce(p2, 2 * b - c) AS a FROM inner_slopes),
bends AS (SELECT *, abs(d - c) + abs(b - a) AS bend, max(abs(d - c) + abs(b - a)) OVER (PARTITION BY series) AS top FROM slopes),
knots AS (SELECT *, CASE WHEN bend <= 1e-9 * top THEN (b + c) / 2 ELSE (abs(d - c) * b + abs(b - a) * c) / bend END AS slope FROM bends),
pieces AS (SELECT series, date, v, slope, next_date, next_v, lead(slope) OVER (PARTITION BY series ORDER BY date) AS next_slope FROM knots),
placed AS (
  SELECT r.series, r.date, r.v, q.v AS y0, q.slope AS d0, q.next_v AS y1, q.next_slope AS d1, q.next_date - q.date AS h, (r.date - q.date) / (q.next_date - q.date) AS u
  FROM {rows} r ASOF LEFT JOIN pieces q ON r.series = q.series AND r.date >= q.date
), curve AS (
  SELECT series, date, CASE WHEN v IS NULL AND y1 IS NOT NULL THEN greatest((2 * u ** 3 - 3 * u ** 2 + 1) * y0 + (u ** 3 - 2 * u ** 2 + u) * h * d0 + (3 * u ** 2 - 2 * u ** 3) * y1 + (u ** 3 - u ** 2) * h * d1, 0) ELSE v END AS v,
    v IS NULL AND y1 IS NOT NULL AS filled
  FROM placed
)"""


@query(f"""
WITH g AS (SELECT event_type AS series, date, v FROM ({_GAPPY})), {_smooth_sql("g")}
SELECT g.series AS event_type, g.date, round(fit.v, 6) AS v, g.v AS unsmoothed FROM g LEFT JOIN fit ON g.series = fit.series AND g.date = fit.date""")
def savgol_smooth_whole(spark, d):
    """W3 with its ends."""
    return _round(series.savgol_smooth(_gappy(spark, d), ["event_type"], "date", ["v"]).withColumnRenamed("v Unsmoothed", "unsmoothed"), 6, "v")


_FILLED = ["lai_mean", "lai_median", "lai_mean_adj", "lai_median_adj"]


@query(f"""
WITH cells AS (SELECT event_type AS region, ts::DATE AS date, CASE WHEN dayofyear(ts) % 3 <> 0 AND value >= 0 THEN value END AS v FROM events),
adjusted AS (SELECT *, 0.0482 * v * v + 0.9161 * v + 0.0026 AS a FROM cells),
daily AS (
  SELECT region, date, avg(v) AS lai_mean, median(v) AS lai_median, stddev_pop(v) AS lai_std, avg(a) AS lai_mean_adj, median(a) AS lai_median_adj, stddev_pop(a) AS lai_std_adj,
    count(v) AS n_pixels, 100.0 * (count(*) - count(v)) / count(*) AS cloud_pct FROM adjusted GROUP BY ALL
), kept AS (SELECT region, date, n_pixels, cloud_pct, {", ".join(f"CASE WHEN cloud_pct <= 50 AND n_pixels > 0 THEN {c} END AS {c}" for c in lai.STATS)} FROM daily),
spine AS (SELECT region, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM kept GROUP BY region),
long AS (SELECT region || '/' || name AS series, region, name, date, v FROM (FROM spine LEFT JOIN kept USING (region, date)) UNPIVOT INCLUDE NULLS (v FOR name IN ({", ".join(lai.STATS)}))), {_smooth_sql("long")},
every_series AS (
  SELECT l.series || '/smooth' AS series, l.region, l.name, l.date, fit.v FROM long l LEFT JOIN fit ON fit.series = l.series AND fit.date = l.date
  UNION ALL SELECT series || '/raw', region, name || '_unsmoothed', date, v FROM long
), wanted AS (SELECT series, date, v FROM every_series WHERE name NOT LIKE 'lai_std%'), {_akima_sql("wanted")},
whole AS (SELECT b.region, b.date, b.name, CASE WHEN c.series IS NULL THEN b.v ELSE c.v END AS v, coalesce(c.filled, FALSE) AS filled FROM every_series b LEFT JOIN curve c ON c.series = b.series AND c.date = b.date)
SELECT w.region, w.date, {", ".join(f"round(max(v) FILTER (name = '{c}{end}'), 6) AS {c}{end}" for c in lai.STATS for end in ("", "_unsmoothed"))},
  any_value(k.n_pixels) AS n_pixels, round(any_value(k.cloud_pct), 6) AS cloud_pct, max(filled::INT) AS interpolated
FROM whole w LEFT JOIN kept k ON k.region = w.region AND k.date = w.date GROUP BY w.region, w.date""")
def akima_fill(spark, d):
    """A1 -> F4 -> W11 -> W3 -> W4, the flagship."""
    cells = table(spark, d, "events").select(F.col("event_type").alias("region"), F.to_date("ts").alias("date"), F.when(F.dayofyear("ts") % 3 != 0, F.col("value")).alias("v"), F.lit(1).alias("m"))
    out = lai.lai_series(cells, cloud=0.5, crop="wheat")
    out = out.select(*[F.col(c).alias(c.replace(" ", "_").lower()) for c in out.columns])
    return _round(out, 6, *[c for c in out.columns if c.startswith("lai_") or c == "cloud_pct"])


@query(f"""
WITH RECURSIVE g AS ({_GAPPY}),
known AS (SELECT event_type, date, v, row_number() OVER s - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n, lead(date) OVER s - date AS h, (lead(v) OVER s - v) / (lead(date) OVER s - date) AS m FROM g WHERE v IS NOT NULL WINDOW s AS (PARTITION BY event_type ORDER BY date)),
sides AS (SELECT event_type, k, n, lag(h) OVER s AS a, h AS b, m - lag(m) OVER s AS bend FROM known WINDOW s AS (PARTITION BY event_type ORDER BY k)),
eq AS (
  SELECT event_type, k, n, CASE WHEN k = 1 THEN 0 WHEN k = n - 2 THEN a - b * b / a ELSE a END AS lo, CASE WHEN k = n - 2 THEN 0 WHEN k = 1 THEN b - a * a / b ELSE b END AS hi,
    2.0::DOUBLE * (a + b) + CASE WHEN k = 1 THEN a * (a + b) / b ELSE 0 END + CASE WHEN k = n - 2 THEN b * (a + b) / a ELSE 0 END AS mid, 6 * bend AS r
  FROM sides WHERE n >= 4 AND k BETWEEN 1 AND n - 2
), forth AS (
  SELECT event_type, k, n, hi / mid AS c, r / mid AS r FROM eq WHERE k = 1
  UNION ALL SELECT e.event_type, e.k, e.n, e.hi / (e.mid - e.lo * f.c), (e.r - e.lo * f.r) / (e.mid - e.lo * f.c) FROM forth f JOIN eq e ON e.event_type = f.event_type AND e.k = f.k + 1
), back AS (
  SELECT event_type, k, r AS s FROM forth WHERE k = n - 2
  UNION ALL SELECT f.event_type, f.k, f.r - f.c * b.s FROM back b JOIN forth f ON f.event_type = b.event_type AND f.k = b.k - 1
), ends AS (
  SELECT event_type, k, s FROM back
  UNION ALL SELECT k.event_type, 0, ((k.h + j.h) * x.s - k.h * y.s) / j.h FROM known k JOIN known j ON j.event_type = k.event_type AND j.k = 1 JOIN back x ON x.event_type = k.event_type AND x.k = 1 JOIN back y ON y.event_type = k.event_type AND y.k = 2 WHERE k.k = 0
  UNION ALL SELECT k.event_type, k.n - 1, ((k.h + j.h) * x.s - k.h * y.s) / j.h FROM known k JOIN known j ON j.event_type = k.event_type AND j.k = k.n - 3 JOIN back x ON x.event_type = k.event_type AND x.k = k.n - 2 JOIN back y ON y.event_type = k.event_type AND y.k = k.n - 3 WHERE k.k = k.n - 2 AND k.n >= 4
  UNION ALL SELECT k.event_type, j.k, CASE WHEN k.n = 3 THEN 2 * (i.m - k.m) / (k.h + i.h) ELSE 0 END FROM known k JOIN known j ON j.event_type = k.event_type LEFT JOIN known i ON i.event_type = k.event_type AND i.k = 1 WHERE k.k = 0 AND k.n < 4
), pieces AS (SELECT k.*, e.s, lead(e.s) OVER (PARTITION BY k.event_type ORDER BY k.k) AS s1 FROM known k JOIN ends e ON e.event_type = k.event_type AND e.k = k.k),
placed AS (SELECT g.event_type, g.date, g.v, p.h, p.m, p.s, p.s1, p.v AS y, g.date - p.date AS d FROM g ASOF LEFT JOIN pieces p ON g.event_type = p.event_type AND g.date >= p.date)
SELECT event_type, date, round(CASE WHEN v IS NULL THEN y + d * (m - h * (2 * s + s1) / 6) + d * d * s / 2 + d * d * d * (s1 - s) / (6 * h) ELSE v END, 6) AS v, (v IS NULL AND h IS NOT NULL)::INT AS interpolated FROM placed""")
def spline_fill(spark, d):
    """W10."""
    return _round(series.spline_fill(_gappy(spark, d), ["event_type"], "date", "v"), 6, "v")


@query("""SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_version(spark, d):
    """W2, W7, W8."""
    ev = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return series.first_row(ev, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query("""SELECT l_orderkey, l_linestatus, l_discount, l_tax FROM (SELECT DISTINCT l_orderkey, l_linestatus, l_discount, l_tax FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_discount, l_tax DESC) = 1""")
def duplicate_rule(spark, d):
    """Lowest first tie-breaker, then highest second."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_discount", "l_tax")
    return simulation.resolve_duplicates(rows, ["l_orderkey", "l_linestatus"], "l_discount", "l_tax")


@query("""
SELECT l_orderkey, array_to_string((CASE WHEN count(DISTINCT l_linestatus) > 1 THEN ['l_linestatus'] ELSE [] END) || (CASE WHEN count(DISTINCT l_returnflag) > 1 THEN ['l_returnflag'] ELSE [] END), ',') AS columns
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1 OR count(DISTINCT l_returnflag) > 1""")
def conflicting_rows(spark, d):
    """W1's check: keys whose rows differ, and where."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_returnflag", "l_discount")
    return simulation.conflicting_rows(rows, ["l_orderkey"], ["l_discount"]).withColumn("columns", F.array_join("columns", ","))


@query("""
WITH p AS (SELECT l_suppkey, floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, max(CASE WHEN l_tax > 0.02 THEN l_extendedprice END) AS v FROM lineitem GROUP BY 1, 2, 3)
SELECT ix, iy, arg_min(v, l_suppkey) FILTER (v IS NOT NULL) AS v FROM p GROUP BY ix, iy""")
def first_valid_mosaic(spark, d):
    """Of the suppliers' rasters, the first with a value."""
    px = table(spark, d, "lineitem").groupBy("l_suppkey", F.floor("l_quantity").cast("int").alias("ix"), F.round(F.col("l_discount") * 100).cast("int").alias("iy"))
    px = px.agg(F.max(F.when(F.col("l_tax") > 0.02, F.col("l_extendedprice"))).alias("v"))
    return lai.mosaic(px, ["ix", "iy"], "v", "l_suppkey")


@query("""
WITH p AS (SELECT year(l_shipdate)::INT AS year, l_suppkey AS region, round(avg(l_extendedprice), 2) AS pred FROM lineitem GROUP BY ALL),
r AS (SELECT year(o_orderdate)::INT AS year, o_custkey AS region, max(o_totalprice) AS reported FROM orders WHERE year(o_orderdate) < 1998 GROUP BY ALL)
SELECT year, region, pred, reported FROM p JOIN r USING (year, region) UNION ALL SELECT year, region, pred, NULL FROM p WHERE year NOT IN (SELECT year FROM r)""")
def union_years(spark, d):
    """Years with reference rows are joined, the others stay alone."""
    pred = table(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("study_year"), F.col("l_suppkey").alias("region")).agg(F.round(F.avg("l_extendedprice"), 2).alias("pred"))
    ref = table(spark, d, "orders").where(F.year("o_orderdate") < 1998).groupBy(F.year("o_orderdate").alias("study_year"), F.col("o_custkey").alias("region")).agg(F.max("o_totalprice").alias("reported"))
    return evaluate.years_with_reference(pred, ref)


@query("""
WITH t AS (SELECT user_id % 10 AS unit, ts::DATE AS date, event_type, value FROM events), n AS (SELECT unit, count(DISTINCT event_type) AS n FROM t GROUP BY unit)
SELECT t.unit, date, round(avg(value), 8) AS value FROM t JOIN n ON t.unit = n.unit GROUP BY t.unit, date HAVING count(DISTINCT event_type) = max(n)""")
def common_dates_curve(spark, d):
    """Days on which all types occur."""
    ev = table(spark, d, "events").select((F.col("user_id") % 10).alias("unit"), F.to_date("ts").alias("date"), "event_type", "value")
    return _round(lai.common_dates_mean(ev, ["unit"], "event_type", "date", "value"), 8, "value")


@query("""SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_discount > 0.05) > 250) GROUP BY 1""")
def valid_regions(spark, d):
    """Suppliers with enough cells, by semi-join."""
    line = table(spark, d, "lineitem")
    good = lai.valid_regions(line.select(F.col("l_suppkey").alias("region"), F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("m")), 250)
    out = line.join(good, F.col("l_suppkey") == F.col("region"), "left_semi").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("total"))
    return _round(out, 2, "total")


@query("""SELECT event_type, min(value) AS low, max(value) AS high, round(quantile_cont(value, 0.02), 4) AS p02, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.98), 4) AS p98 FROM events GROUP BY 1""")
def value_ranges(spark, d):
    """A22."""
    return _round(evaluate.value_ranges(table(spark, d, "events"), ["event_type"], "value"), 4, "p02", "p95", "p98")


@query("""SELECT year(l_shipdate)::INT AS year, count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean, min(l_quantity) AS q0, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50, quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS q100 FROM lineitem GROUP BY 1""")
def predictions_by_year(spark, d):
    """A31."""
    line = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    return _round(evaluate.distribution(line, ["year"], "l_quantity"), 4, "mean")


@query("""
SELECT l_orderkey, l_linenumber, 'rain' AS variable, l_quantity AS value FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT l_orderkey, l_linenumber, 'wind', l_discount FROM lineitem WHERE l_discount > 0.09 OR l_discount < 0.01""")
def range_checks(spark, d):
    """Q1."""
    met = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("rain"), F.col("l_discount").alias("wind"))
    return weather.limit_violations(met, ["l_orderkey", "l_linenumber"], {"rain": (None, 45.0), "wind": (0.01, 0.09)})


@query("""
SELECT s_suppkey, year, rf FROM (SELECT s_suppkey FROM supplier) CROSS JOIN (SELECT DISTINCT year(l_shipdate)::INT AS year FROM lineitem) CROSS JOIN (SELECT DISTINCT l_returnflag AS rf FROM lineitem)
EXCEPT SELECT l_suppkey, year(l_shipdate), l_returnflag FROM lineitem WHERE l_quantity > 48""")
def manifest_gaps(spark, d):
    """Combinations without any row."""
    line = table(spark, d, "lineitem")
    wanted = studies.manifest(table(spark, d, "supplier").select("s_suppkey"), line.select(F.year("l_shipdate").alias("year")).distinct(), line.select(F.col("l_returnflag").alias("rf")).distinct())
    present = line.where("l_quantity > 48").select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("rf"))
    return studies.manifest_gaps(wanted, present, ["s_suppkey", "year", "rf"])


_SUMMARY = "SELECT user_id, max(value) AS max_lai, sum(value) AS total, count(*) AS n FROM events GROUP BY user_id"


@query(f"""SELECT user_id, CASE WHEN NOT n > 50 THEN 2 WHEN NOT max_lai > 200 THEN 3 WHEN NOT total / n < 55 THEN 4 END::INT AS removed_in_step FROM ({_SUMMARY})""")
def stepwise_filter(spark, d):
    """F16, X2."""
    s = table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("max_lai"), F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    steps = [(2, F.col("n") > 50), (3, F.col("max_lai") > 200), (4, F.col("total") / F.col("n") < 55)]
    return simulation.stepwise_filter(s, steps).select("user_id", "removed_in_step")


def _simulations(spark, d) -> DataFrame:
    ev = table(spark, d, "events").select(F.col("user_id").alias("SimulationID"), F.to_date("ts").alias("date"), F.col("value").alias("lai"), (F.col("value") * 10).alias("yield"))
    return simulation.stepwise_filter(simulation.simulation_summary(ev), [(2, F.col("max_lai") > 200)])


_SIMULATIONS = """SELECT user_id, max(value * 10) AS max_yield, max(value) AS max_lai, min(ts::DATE) FILTER (value = m) AS max_lai_date FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id"""


@query(f"SELECT user_id AS SimulationID, round(max_yield, 4) AS max_yield, max_lai, max_lai_date, CASE WHEN NOT max_lai > 200 THEN 2 END::INT AS removed_in_step FROM ({_SIMULATIONS})")
def sim_summary(spark, d):
    """A19, A20."""
    return _round(_simulations(spark, d), 4, "max_yield")


@query(f"""
WITH s AS ({_SIMULATIONS})
SELECT count(*) AS n_all, count(*) FILTER (max_lai > 200) AS n_matched, round(avg(max_yield) FILTER (max_lai > 200), 4) AS matched_mean_yield, max(max_lai) FILTER (max_lai > 200) AS matched_max_lai,
  round(stddev_samp(max_yield) FILTER (max_lai > 200), 4) AS matched_std_yield, max(max_lai) AS all_max_lai, round(stddev_samp(max_lai), 4) AS all_std_lai FROM s""")
def matched_summary(spark, d):
    """A21."""
    out = simulation.matched_summary(_simulations(spark, d))
    out = out.select("n_all", "n_matched", "matched_mean_yield", "matched_max_lai", "matched_std_yield", "all_max_lai", "all_std_lai")
    return _round(out, 4, "matched_mean_yield", "matched_std_yield", "all_std_lai")


@query("""SELECT ts::DATE AS date, round(avg(value), 4) AS lai, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING max(value) > 200) GROUP BY 1""")
def mean_matched_series(spark, d):
    """A18, J4."""
    ev = table(spark, d, "events").select(F.col("user_id").alias("SimulationID"), F.to_date("ts").alias("date"), F.col("value").alias("lai"))
    return _round(simulation.mean_matched_series(ev, _simulations(spark, d).where("removed_in_step is null"), "date", "lai"), 4, "lai")


#: made-up weights of the right shape: 11 bands, 5 units
_NET = {
    "input_scale": [1.0 + k / 10 for k in range(11)],
    "input_bias": [0.05 * k - 0.2 for k in range(11)],
    "hidden": [((7 * u + 3 * k) % 11 - 5) / 10 for u in range(5) for k in range(11)],
    "hidden_bias": [0.1 * u - 0.2 for u in range(5)],
    "out": [0.5, -0.25, 0.75, 0.1, -0.6],
    "out_bias": [0.3],
    "target_scale": [0.25],
    "target_bias": [-1.0],
}


def _net_sql() -> str:
    z = [f"(embedding[{k + 1}]::DOUBLE * {s!r}::DOUBLE + {b!r}::DOUBLE)" for k, (s, b) in enumerate(zip(_NET["input_scale"], _NET["input_bias"]))]
    units = [f"{o!r}::DOUBLE * tanh({_NET['hidden_bias'][u]!r}::DOUBLE + " + " + ".join(f"{z[k]} * {_NET['hidden'][11 * u + k]!r}::DOUBLE" for k in range(11)) + ")" for u, o in enumerate(_NET["out"])]
    return f"(0.3::DOUBLE + {' + '.join(units)} + 1.0) / 0.25"


@query(f"SELECT vec_id, round({_net_sql()}, 6) AS lai FROM embeddings")
def mlp_inference(spark, d):
    """The network as plain column arithmetic."""
    bands = [F.col("embedding")[k].cast("double") for k in range(11)]
    return table(spark, d, "embeddings").select("vec_id", F.round(pixels.network(bands, _NET, scale=1.0), 6).alias("lai"))


@query(r"""SELECT p_partkey, lower(regexp_replace(translate(p_name, '''"', ''), '[^\w.-]', '_', 'g')) AS cleaned_name FROM part""")
def clean_names(spark, d):
    """P1."""
    return names.with_clean_names(table(spark, d, "part").select("p_partkey", "p_name"), "p_name").select("p_partkey", "cleaned_name")


@query("""SELECT user_id, ts::DATE AS date, max((json_extract(props, '$.k'))::DOUBLE) AS k, max(value) AS rain FROM events GROUP BY ALL""")
def payload_flatten(spark, d):
    """Events become one payload a user ({parameter: {date: value}}) and are flattened again."""
    ev = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("date")).agg(F.max(F.get_json_object("props", "$.k").cast("double")).alias("k"), F.max("value").alias("rain"))
    entries = lambda c: F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyyMMdd"), F.col(c))))
    payload = F.to_json(F.create_map(F.lit("k"), entries("k"), F.lit("rain"), entries("rain")))
    return weather.flatten_payload(ev.groupBy("user_id").agg(payload.alias("payload")), ["user_id"], "payload", ["k", "rain"])


@query("""
WITH t AS (SELECT l_suppkey, l_shipdate::DATE AS d FROM lineitem),
x AS (SELECT l_suppkey, bool_or(month(d) >= 7) AND bool_or(month(d) <= 6) AS c FROM t GROUP BY 1),
p AS (SELECT l_suppkey, d, c, CASE WHEN c AND month(d) <= 6 THEN 2001 ELSE 2000 END AS y FROM t JOIN x USING (l_suppkey))
SELECT l_suppkey, make_date(y, month(d), CASE WHEN month(d) = 2 AND day(d) = 29 AND y = 2001 THEN 28 ELSE day(d) END) AS plot_date, (dayofyear(d) + CASE WHEN c AND month(d) <= 6 THEN 365 ELSE 0 END)::INT AS doy, count(*) AS n FROM p GROUP BY ALL""")
def plot_dates(spark, d):
    """Winter seasons on one reference year."""
    t = table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("d"))
    x = materialize(t.groupBy("l_suppkey").agg(dates.is_cross_year(F.col("d")).alias("c")), "cross-year")
    p = t.join(x, "l_suppkey").select("l_suppkey", dates.plot_date(F.col("d"), F.col("c")).alias("plot_date"), dates.continuous_doy(F.col("d"), F.col("c")).alias("doy"))
    # there are nearly as many days of suppliers as rows: as many tasks more as there are rows more
    p = p.repartition(max(spark.sparkContext.defaultParallelism, t.count() // 500_000 + 1), "l_suppkey", "plot_date", "doy")
    return p.groupBy("l_suppkey", "plot_date", "doy").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH r AS (SELECT s_suppkey, abs(s_acctbal) AS area, abs(s_acctbal) * 2.5 AS kg, CASE WHEN s_suppkey % 4 <> 0 THEN abs(s_acctbal) * 3 END AS rep FROM supplier)
SELECT count(*) AS n_regions, count(rep) AS n_reported, round(sum(area), 2) AS total_area_ha, round(sum(kg), 2) AS total_production_kg, round(sum(kg) / sum(area), 4) AS mean_yield_kg_ha,
  round(sum(rep), 2) AS reported_production_kg, round(sum(rep) / sum(area) FILTER (rep IS NOT NULL), 4) AS reported_mean_yield_kg_ha FROM r""")
def study_summary(spark, d):
    """A13."""
    a = F.abs("s_acctbal")
    r = table(spark, d, "supplier").select(a.alias("total_area_ha"), (a * 2.5).alias("total_production_kg"), F.when(F.col("s_suppkey") % 4 != 0, a * 3).alias("reported_production_kg"))
    return _round(_round(evaluate.study_summary(r), 2, "total_area_ha", "total_production_kg", "reported_production_kg"), 4, "mean_yield_kg_ha", "reported_mean_yield_kg_ha")


@query("""SELECT round(sum(rep * area) / sum(CASE WHEN rep IS NOT NULL THEN area END), 4) AS reference_mean FROM (SELECT abs(s_acctbal) AS area, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END AS rep FROM supplier)""")
def reference_mean(spark, d):
    """A14."""
    r = table(spark, d, "supplier").select(F.abs("s_acctbal").alias("area"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_suppkey")).alias("rep"))
    return _round(evaluate.reference_mean(r, "rep", "area"), 4, "reference_mean")


@query("""
SELECT n_name, count(*) AS n, '{"type":"Feature","properties":{"n_name":"' || n_name || '","n":' || count(*) || '}}' AS document FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def feature_rows(spark, d):
    """S14's JSON of attributes."""
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("document", F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("n_name", "n").alias("properties"))))


@query()
def features_json(spark, d):
    """Documents with nested series and polygons."""
    ev = table(spark, d, "events").groupBy(F.col("event_type").alias("region"), F.to_date("ts").alias("date")).agg(F.round(F.avg("value"), 4).alias("value"))
    return studies.feature_documents(ev.groupBy("region").agg(F.count(F.lit(1)).alias("n_days")), ev)


@query("""SELECT r_name AS parent, n_name AS region, n_nationkey FROM region JOIN nation ON n_regionkey = r_regionkey""")
def children_of_levels(spark, d):
    """Parents list their subregions' names, which are joined back."""
    nat = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parents = studies.subregions(nat, "r_name", "n_name").withColumnRenamed("r_name", "region")
    return studies.children(parents, table(spark, d, "nation").select(F.col("n_name").alias("region"), "n_nationkey"))


@query("""
SELECT event_type, count(*) FILTER (value < 100 AND user_id % 3 <> 0) AS n_valid_days, round(avg(value) FILTER (value < 100 AND user_id % 3 <> 0), 4) AS mean_cloud_pct FROM events GROUP BY event_type""")
def valid_days(spark, d):
    """A12, F13."""
    daily = table(spark, d, "events").select("event_type", F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("interpolated"), F.col("value").alias("cloud_pct"))
    return _round(studies.valid_days(daily, ["event_type"]), 4, "mean_cloud_pct")


@query("""
WITH p AS (SELECT user_id, ts::DATE AS date, sum(value) AS rain FROM events GROUP BY ALL), c AS (SELECT user_id, ts::DATE AS date, max(value) AS mm FROM events WHERE user_id % 2 = 0 GROUP BY ALL)
SELECT user_id::VARCHAR AS region, date, round(CASE WHEN user_id % 2 = 0 THEN mm ELSE rain END, 4) AS rain FROM p LEFT JOIN c USING (user_id, date)""")
def rain_override(spark, d):
    """J15 with fallback: regions with full precipitation of their own take it."""
    ev = table(spark, d, "events").select(F.col("user_id").cast("string").alias("region"), F.to_date("ts").alias("date"), "value")
    met = ev.groupBy("region", "date").agg(F.sum("value").alias("rain"))
    own = ev.where(F.col("region").cast("long") % 2 == 0).groupBy("region", "date").agg(F.max("value").alias("mm"))
    return _round(weather.override_rain(met, own, allow_gaps=True), 4, "rain")


@query("""
WITH c AS (SELECT floor(l_extendedprice / 5000)::INT AS ix, floor(l_quantity / 10)::INT AS iy, year(l_shipdate)::INT AS date, avg(l_tax) AS mm FROM lineitem GROUP BY ALL), r(region, x1, x2) AS (VALUES ('A', 0, 5), ('B', 3, 12))
SELECT region, date, round(avg(mm), 6) AS mm FROM c JOIN r ON ix >= x1 AND ix < x2 GROUP BY ALL""")
def region_precipitation(spark, d):
    """Cells of each region averaged by date."""
    cells = table(spark, d, "lineitem").groupBy(F.floor(F.col("l_extendedprice") / 5000).cast("int").alias("ix"), F.floor(F.col("l_quantity") / 10).cast("int").alias("iy"), F.year("l_shipdate").alias("date")).agg(F.avg("l_tax").alias("mm"))
    own = spark.createDataFrame([(r, x, y) for r, a, b in (("A", 0, 5), ("B", 3, 12)) for x in range(a, b) for y in range(6)], "region string, ix int, iy int")
    return _round(weather.region_precipitation(cells, own), 6, "mm")


@query("""SELECT l_returnflag, min(l_shipdate::DATE) AS first_day, max(l_shipdate::DATE) AS last_day, max(l_shipdate::DATE) FILTER (l_linestatus = 'O') AS last_measured FROM lineitem GROUP BY 1""")
def weather_facts(spark, d):
    """A34, F12."""
    met = table(spark, d, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("date"), F.when(F.col("l_linestatus") == "O", "measured").otherwise("projected").alias("data_type"))
    return weather.weather_facts(met, ["l_returnflag"])


@query("""SELECT l_returnflag, count(*) AS n FROM (SELECT *, max(l_shipdate::DATE) OVER (PARTITION BY l_returnflag) AS top FROM lineitem) WHERE l_shipdate::DATE >= top - INTERVAL 2 YEAR GROUP BY 1""")
def last_years(spark, d):
    """F15."""
    return weather.last_years(table(spark, d, "lineitem"), ["l_returnflag"], "l_shipdate", 2).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT user_id, value, event_id FROM events WHERE value > 250 UNION ALL SELECT user_id, NULL, event_id FROM events WHERE value <= 250""")
def union_missing_columns(spark, d):
    """Tables with unequal columns, by name."""
    ev = table(spark, d, "events")
    return ev.where("value > 250").select("user_id", "value", "event_id").unionByName(ev.where("value <= 250").select("event_id", "user_id"), allowMissingColumns=True)


@query("""SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, d):
    """Q3: keys with more rows than one."""
    return checks.duplicate_keys(table(spark, d, "events"), ["user_id", "event_type"])


@query("""
WITH g AS (SELECT l_suppkey, l_returnflag AS crs, round(l_tax, 2) AS dx, round(l_discount, 2) AS dy FROM lineitem)
SELECT l_suppkey, count(DISTINCT crs) AS n_crs, round(max(dx) - min(dx), 4) AS dx_spread, round(max(dy) - min(dy), 4) AS dy_spread FROM g GROUP BY 1 HAVING n_crs > 1 OR max(dx) - min(dx) > 1e-10 OR max(dy) - min(dy) > 1e-10""")
def mixed_grids(spark, d):
    """Q4."""
    g = table(spark, d, "lineitem").select("l_suppkey", F.col("l_returnflag").alias("crs"), F.round("l_tax", 2).alias("dx"), F.round("l_discount", 2).alias("dy"))
    return _round(checks.mixed_grids(g, ["l_suppkey"]), 4, "dx_spread", "dy_spread")


@query("""
WITH h AS (SELECT DISTINCT user_id, ts::DATE AS date FROM events), s AS (SELECT user_id, unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY))::DATE AS date FROM (SELECT DISTINCT user_id FROM h))
SELECT s.user_id, s.date FROM s JOIN (SELECT user_id, max(date) AS m FROM h GROUP BY 1) l ON l.user_id = s.user_id AND s.date < l.m WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.user_id = s.user_id AND h.date = s.date)""")
def interior_gaps(spark, d):
    """Q2: missing days before a user's last one."""
    held = table(spark, d, "events").select("user_id", F.to_date("ts").alias("date")).distinct()
    spine = series.date_spine(held.select("user_id").distinct().select("user_id", F.lit("2024-01-01").alias("a"), F.lit("2024-02-05").alias("b")), "a", "b")
    return checks.interior_gaps(held, spine, "date", ["user_id"])


@query("""SELECT region FROM (SELECT DISTINCT user_id AS region, event_type FROM events WHERE value > 150 AND event_type IN (SELECT DISTINCT event_type FROM events)) GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT event_type) FROM events)""")
def complete_regions(spark, d):
    """Q15: users with a large value of every type."""
    ev = table(spark, d, "events")
    return checks.complete_regions(ev.where("value > 150").select(F.col("user_id").alias("region"), F.col("event_type").alias("product")), ev.select(F.col("event_type").alias("product")))


@query("""
SELECT user_id, max(value) AS max_value, min(ts::DATE) FILTER (value = m) AS max_day FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id""")
def observed_peak(spark, d):
    """A19."""
    return lai.peak(table(spark, d, "events"), ["user_id"], "value", "ts")


@query("""
WITH t AS (SELECT l_suppkey, l_quantity, l_extendedprice, CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS m FROM lineitem)
SELECT l_suppkey, count(*) AS n, round(sum(CASE WHEN m = 1 THEN greatest(l_quantity - 10, 0) * 1.5 END), 4) AS total FROM t GROUP BY 1""")
def masked_yield(spark, d):
    """Binarized mask, clipped and scaled pixels."""
    line = table(spark, d, "lineitem")
    v = pixels.yield_pixel(pixels.apply_mask(F.col("l_quantity") - 10, pixels.binarize(F.col("l_discount"), 0.0801)), F.lit(1.5))
    return _round(line.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("total")), 4, "total")


@query("""
SELECT l_orderkey, l_linenumber, trunc(cos(radians(l_quantity)) * 10000)::INT AS cos_band,
  (CASE WHEN l_linenumber >= 4 AND l_partkey <> 0 THEN greatest(l_partkey, 1000) - 1000 ELSE l_partkey END)::BIGINT AS b4, (l_partkey & 30) = 0 AS clear FROM lineitem""")
def band_processing(spark, d):
    """Cosine band, harmonization by baseline, mask bits."""
    line = table(spark, d, "lineitem")
    return line.select("l_orderkey", "l_linenumber", pixels.cos_band(F.col("l_quantity")).alias("cos_band"), pixels.harmonize(F.col("l_partkey"), F.col("l_linenumber")).alias("b4"), pixels.keep_hls_pixel(F.col("l_partkey")).alias("clear"))


@query("""
WITH e AS (SELECT user_id % 5 AS product, min(value) AS xmin, min(user_id)::DOUBLE AS ymin, max(value) AS xmax, max(user_id)::DOUBLE AS ymax FROM events GROUP BY 1)
SELECT a.product AS name, b.product AS b_name FROM e a, (SELECT product, xmin + 400 AS xmin, ymin, xmax + 400 AS xmax, ymax - 100 AS ymax FROM e) b
WHERE greatest(a.xmin, b.xmin) < least(a.xmax, b.xmax) AND greatest(a.ymin, b.ymin) < least(a.ymax, b.ymax)""")
def extent_overlaps(spark, d):
    """Extents of event groups against shifted ones."""
    e = table(spark, d, "events").groupBy((F.col("user_id") % 5).alias("name")).agg(F.min("value").alias("xmin"), F.min("user_id").cast("double").alias("ymin"), F.max("value").alias("xmax"), F.max("user_id").cast("double").alias("ymax"))
    b = e.select("name", (F.col("xmin") + 400).alias("xmin"), "ymin", (F.col("xmax") + 400).alias("xmax"), (F.col("ymax") - 100).alias("ymax"))
    return geo.overlaps(e, b)


@query("""
WITH p AS (SELECT floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
t AS (SELECT a.i::INT AS ix, b.i::INT AS iy, a.i * 3.0 + 1.5 AS x, b.i * 2.0 + 1.0 AS y FROM generate_series(0, 16) a(i), generate_series(0, 5) b(i))
SELECT t.ix, t.iy, round(v, 8) AS v FROM t LEFT JOIN p ON p.ix = floor(x)::INT AND p.iy = floor(y)::INT""")
def reproject_nearest(spark, d):
    """A coarser grid over the raster of line items."""
    px = table(spark, d, "lineitem").groupBy(F.floor("l_quantity").cast("int").alias("ix"), F.round(F.col("l_discount") * 100).cast("int").alias("iy")).agg(F.avg("l_extendedprice").alias("v"))
    grid = {"x0": 0.0, "y0": 0.0, "dx": 1.0, "dy": 1.0}
    return _round(geo.reproject_nearest(geo.target_grid(spark, (0, 0, 51, 12), 3.0, 2.0), px, grid), 8, "v")


@query("""
WITH p AS (SELECT floor(l_quantity)::INT AS ix, round(l_discount * 100)::INT AS iy, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
t AS (SELECT a.i::INT AS ix, b.i::INT AS iy, a.i * 3.0 + 1.5 - 0.5 AS fx, b.i * 2.0 + 1.0 - 0.5 AS fy FROM generate_series(0, 16) a(i), generate_series(0, 5) b(i)),
c AS (SELECT t.ix, t.iy, (floor(fx) + i)::INT AS sx, (floor(fy) + j)::INT AS sy, abs(1 - i - (fx - floor(fx))) * abs(1 - j - (fy - floor(fy))) AS w FROM t, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
SELECT c.ix, c.iy, round(sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END), 4) AS v FROM c LEFT JOIN p ON p.ix = sx AND p.iy = sy WHERE w > 0 GROUP BY c.ix, c.iy""")
def reproject_bilinear(spark, d):
    """J13."""
    px = table(spark, d, "lineitem").groupBy(F.floor("l_quantity").cast("int").alias("ix"), F.round(F.col("l_discount") * 100).cast("int").alias("iy")).agg(F.avg("l_extendedprice").alias("v"))
    grid = {"x0": 0.0, "y0": 0.0, "dx": 1.0, "dy": 1.0}
    return _round(geo.reproject_bilinear(geo.target_grid(spark, (0, 0, 51, 12), 3.0, 2.0), px, grid), 4, "v")


@query(f"""
WITH e(region, x1, y1, x2, y2) AS (VALUES {_EDGES}),
areas AS (SELECT region, sum(x1 * y2 - x2 * y1) / 2 AS area FROM e GROUP BY region),
rows AS (SELECT e.*, unnest(range(floor(least(y1, y2))::BIGINT, ceil(greatest(y1, y2))::BIGINT)) AS iy FROM e WHERE y1 <> y2),
cut AS (SELECT region, iy, x1, y1, x2, y2, greatest(least(y1, y2), iy) AS foot, least(greatest(y1, y2), iy + 1) AS head FROM rows),
piece AS (SELECT region, iy, (head - foot) * sign(y2 - y1) * -sign(area) AS height, x1 + (foot - y1) * (x2 - x1) / (y2 - y1) AS a, x1 + (head - y1) * (x2 - x1) / (y2 - y1) AS b FROM cut JOIN areas USING (region)),
cols AS (SELECT *, least(a, b) AS l, greatest(a, b) AS r, unnest(range(floor(least(a, b))::BIGINT, greatest(floor(least(a, b)) + 1, ceil(greatest(a, b)))::BIGINT)) AS ix FROM piece),
part AS (SELECT region, iy, ix, height * CASE WHEN r > l THEN (least(r, ix + 1) - greatest(l, ix)) / (r - l) ELSE 1 END AS height, (greatest(l, ix) + least(r, ix + 1)) / 2 AS middle FROM cols),
cell AS (SELECT region, iy, ix, sum(height) AS height, sum(height * (ix + 1 - middle)) AS area FROM part GROUP BY ALL),
box AS (SELECT region, unnest(range(floor(min(x1))::BIGINT, ceil(max(x1))::BIGINT)) AS ix, min(y1) AS low, max(y1) AS high FROM e GROUP BY region),
every AS (SELECT region, ix, unnest(range(floor(low)::BIGINT, ceil(high)::BIGINT)) AS iy FROM box),
cover AS (
  SELECT region, ix, iy, round(coalesce(area, 0) + coalesce(sum(height) OVER (PARTITION BY region, iy ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS weight FROM every LEFT JOIN cell USING (region, ix, iy)
), p AS (SELECT floor(l_quantity)::BIGINT AS ix, round(l_discount * 100)::BIGINT AS iy, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
x AS (SELECT region, weight, v, CASE WHEN v IS NOT NULL THEN weight END AS w FROM cover LEFT JOIN p USING (ix, iy) WHERE weight > 0),
c AS (SELECT region, v, sum(w) OVER (PARTITION BY region ORDER BY v) AS cum, sum(w) OVER (PARTITION BY region) AS total FROM x WHERE w > 0),
m AS (SELECT region, min(v) AS median FROM c WHERE cum >= total / 2 GROUP BY region)
SELECT region, round_even(sum(v * w) / sum(w), 0)::BIGINT AS mean_yield_kg_ha, round_even(any_value(median), 0)::BIGINT AS median_yield_kg_ha, round_even(sum(w), 2) AS total_area_ha, round_even(sum(v * w), 0)::BIGINT AS total_production_kg,
  round_even(sum(v * w) / 1000, 3) AS total_production_ton, round_even(100 * sum(w) / sum(weight), 1) AS coverage_pct, round_even(sum(w), 2) AS covered_area_ha, round(any_value(abs(area)), 4) AS area_ha
FROM x JOIN areas USING (region) LEFT JOIN m USING (region) GROUP BY region""")
def zonal_polygons(spark, d):
    """Area-weighted statistics of literal polygons over the raster of line items."""
    px = table(spark, d, "lineitem").groupBy(F.floor("l_quantity").cast("long").alias("ix"), F.round(F.col("l_discount") * 100).cast("long").alias("iy")).agg(F.avg("l_extendedprice").alias("v"))
    cover = geo.coverage(_regions(spark), 0.0, 0.0, 1.0, 1.0)
    areas = geo.area_centroid(_regions(spark)).select("region", F.round("area", 4).alias("area_ha"))
    return zonal.zonal_stats(px.withColumn("covered", F.lit(1)), cover, 1.0, areas)


@query("""
WITH p AS (SELECT l_suppkey AS region, CASE WHEN l_discount > 0.02 THEN l_quantity * 100 END AS v FROM lineitem)
SELECT region, coalesce(trunc(avg(v))::INT, 0) AS mean_yield_kg_ha, coalesce(trunc(median(v))::INT, 0) AS median_yield_kg_ha, round(sum(CASE WHEN v IS NOT NULL THEN 0.25 END), 4) AS total_area_ha, coalesce(trunc(sum(v * 0.25))::BIGINT, 0) AS total_production_kg, coalesce(round(sum(v * 0.25) / 1000, 3), 0) AS total_production_ton FROM p GROUP BY 1""")
def region_totals(spark, d):
    """A5."""
    px = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("region"), F.when(F.col("l_discount") > 0.02, F.col("l_quantity") * 100).alias("v"))
    return _round(_round(zonal.region_totals(px, F.lit(0.25)), 4, "total_area_ha"), 3, "total_production_ton")


@query("""SELECT year, metric, value FROM (UNPIVOT (SELECT year(l_shipdate)::INT AS year, round(avg(l_quantity), 4) AS mean_quantity, round(avg(l_tax), 6) AS mean_tax FROM lineitem GROUP BY 1) ON mean_quantity, mean_tax INTO NAME metric VALUE value)""")
def metric_rows(spark, d):
    """P33."""
    m = table(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.round(F.avg("l_quantity"), 4).alias("mean_quantity"), F.round(F.avg("l_tax"), 6).alias("mean_tax"))
    return names.metric_rows(m, ["year"])


@query("""
WITH c AS (SELECT l_suppkey, unnest(generate_series(min(l_shipdate::DATE), max(l_shipdate::DATE), INTERVAL 365 DAY))::DATE AS chunk_start, max(l_shipdate::DATE) AS b FROM lineitem GROUP BY 1)
SELECT l_suppkey, chunk_start, coalesce(lead(chunk_start) OVER (PARTITION BY l_suppkey ORDER BY chunk_start) - 1, b) AS chunk_end FROM c""")
def day_chunks(spark, d):
    """Date ranges in chunks."""
    r = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("b"))
    return readers.day_chunks(r, "a", "b", "365 days").select("l_suppkey", "chunk_start", "chunk_end")


@query("""SELECT s_suppkey AS region, s_name, n, max_price FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY 1) ON l_suppkey = s_suppkey
LEFT JOIN (SELECT l_suppkey AS k, max(l_extendedprice) AS max_price FROM lineitem WHERE l_tax > 0.07 GROUP BY 1) ON k = s_suppkey""")
def primary_table(spark, d):
    """J2, T1, T5."""
    line, sup = table(spark, d, "lineitem"), table(spark, d, "supplier")
    sims = line.groupBy(F.col("l_suppkey").alias("cleaned_name")).agg(F.sum(F.when(F.col("l_quantity") > 49, 1)).alias("n"))
    daily = line.groupBy(F.col("l_suppkey").alias("cleaned_name")).agg(F.max(F.when(F.col("l_tax") > 0.07, F.col("l_extendedprice"))).alias("max_price"))
    return studies.primary_table(sup.select(F.col("s_suppkey").alias("region"), F.col("s_suppkey").alias("cleaned_name"), "s_name"), sims, daily).drop("cleaned_name")


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IS NOT NULL""")
def allowed_regions(spark, d):
    """allow-list on an attribute, rows of one level."""
    c = studies.one_admin_level(table(spark, d, "customer").withColumn("deeper", F.lit(None).cast("string")), "c_nationkey", ["deeper"])
    return studies.allowed(c, "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT user_id, date, round(value, 8) AS value, flag FROM (SELECT user_id % 20 AS user_id, ts::DATE AS date, avg(value) AS value, max(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END)::INT AS flag FROM events GROUP BY ALL)""")
def mean_over_regions(spark, d):
    """A15."""
    ev = table(spark, d, "events").select((F.col("user_id") % 20).alias("user_id"), F.to_date("ts").alias("date"), "value", F.when(F.col("event_id") % 2 == 0, 1).otherwise(0).alias("flag"))
    return _round(lai.mean_over_regions(ev, ["user_id", "date"], ["value"], "flag"), 8, "value")


@query("""SELECT l_orderkey, l_linenumber, round(5.0 * floor(l_extendedprice / 5), 4) AS low, round(5.0 * ceil(l_extendedprice / 5), 4) AS high, round(l_quantity * 3.6, 4) AS wind FROM lineitem""")
def snapped_bounds(spark, d):
    """P29, P30."""
    c = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(dates.snap_down(c, 5.0), 4).alias("low"), F.round(dates.snap_up(c, 5.0), 4).alias("high"), F.round(F.col("l_quantity") * 3.6, 4).alias("wind"))


@query("""SELECT user_id::VARCHAR AS region, n, CASE WHEN user_id IN (SELECT user_id FROM events WHERE value > 400) THEN 'CHIRPS' ELSE 'NASA' END AS precipitation_source FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""")
def precipitation_source(spark, d):
    """P26."""
    ev = table(spark, d, "events").withColumn("region", F.col("user_id").cast("string"))
    return names.precipitation_source(ev.groupBy("region").agg(F.count(F.lit(1)).alias("n")), ev.where("value > 400").select("region"))


@query()
def weather_file_lines(spark, d):
    """Lines of weather files of each event type."""
    ev = table(spark, d, "events").groupBy(F.col("event_type").alias("region"), F.to_date("ts").alias("date")).agg(F.avg("value").alias("rain"), F.max("value").alias("maxt"), F.min("value").alias("mint"))
    heads = ev.groupBy("region").agg(F.avg("rain").alias("lat"), F.avg("mint").alias("lon"), F.avg("maxt").alias("tav"), F.max("rain").alias("amp"))
    return sinks.met_lines(ev, heads, ("year", "day", "maxt", "mint", "rain"))


@query("""
WITH s AS (SELECT l_discount AS latitude, l_tax AS longitude, count(*) AS n FROM lineitem GROUP BY ALL), c AS (SELECT p_partkey AS region, (p_size % 11) / 100.0 + 0.001 AS latitude, (p_partkey % 9) / 100.0 - 0.002 AS longitude FROM part)
SELECT region, round(s.latitude, 4) AS latitude, round(s.longitude, 4) AS longitude, n FROM s JOIN c ON round(s.latitude, 2) = round(c.latitude, 2) AND round(s.longitude, 2) = round(c.longitude, 2)""")
def rounded_join(spark, d):
    """J6."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_discount").alias("latitude"), F.col("l_tax").alias("longitude")).agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "part").select(F.col("p_partkey").alias("region"), (F.col("p_size") % 11 / 100.0 + 0.001).alias("latitude"), (F.col("p_partkey") % 9 / 100.0 - 0.002).alias("longitude"))
    return _round(weather.join_on_rounded(s, c), 4, "latitude", "longitude").select("region", "latitude", "longitude", "n")


@query("""
WITH t AS (SELECT l_returnflag, l_shipdate::DATE AS d, l_quantity FROM lineitem), x AS (SELECT l_returnflag, bool_or(month(d) >= 7) AND bool_or(month(d) <= 6) AS c FROM t GROUP BY 1),
p AS (SELECT l_returnflag, d, l_quantity, CASE WHEN c AND month(d) <= 6 THEN 2001 ELSE 2000 END AS y FROM t JOIN x USING (l_returnflag))
SELECT l_returnflag, year(d)::INT AS year, make_date(y, month(d), CASE WHEN month(d) = 2 AND day(d) = 29 AND y = 2001 THEN 28 ELSE day(d) END) AS plot_date, round(avg(l_quantity), 8) AS l_quantity FROM p GROUP BY ALL""")
def means_by_plot_date(spark, d):
    """A17, P18."""
    line = table(spark, d, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("d"), "l_quantity")
    return _round(lai.means_by_plot_date(line, ["l_returnflag"], "d", "l_quantity"), 8, "l_quantity")


@query("""
WITH l AS (SELECT user_id AS ix, (event_id % 7)::BIGINT AS iy, ts::DATE AS date, max(CASE WHEN value > 30 THEN value END) AS v FROM events GROUP BY ALL),
m AS (SELECT (user_id % 10)::VARCHAR AS region, user_id AS ix, k AS iy FROM (SELECT DISTINCT user_id FROM events), generate_series(0, 4) g(k)),
c AS (SELECT region, count(*) AS n FROM m GROUP BY 1), s AS (SELECT region, date, avg(v) AS mean, count(v) AS n FROM l JOIN m USING (ix, iy) GROUP BY ALL)
SELECT c.region, d.date, round(s.mean, 8) AS lai_mean, coalesce(s.n, 0) AS n_pixels, round(100.0 * (c.n - coalesce(s.n, 0)) / c.n, 6) AS cloud_pct FROM c CROSS JOIN (SELECT DISTINCT date FROM l) d LEFT JOIN s USING (region, date)""")
def masked_daily_stats(spark, d):
    """Leaf area on a crop mask, percentages by subtraction."""
    px = table(spark, d, "events").groupBy(F.col("user_id").alias("ix"), (F.col("event_id") % 7).alias("iy"), F.to_date("ts").alias("date")).agg(F.max(F.when(F.col("value") > 30, F.col("value"))).alias("v"))
    cells = table(spark, d, "events").select(F.col("user_id").alias("ix")).distinct().withColumn("iy", F.explode(F.array(*[F.lit(k).cast("long") for k in range(5)])))
    mask = cells.select((F.col("ix") % 10).cast("string").alias("region"), "ix", "iy", F.lit(1).alias("m"))
    return _round(_round(lai.daily_stats_on_mask(px, mask).select("region", "date", "lai_mean", "n_pixels", "cloud_pct"), 8, "lai_mean"), 6, "cloud_pct")


@query("""SELECT l_suppkey, min(l_shipdate::DATE) AS first_day, max(l_shipdate::DATE) AS last_day FROM lineitem GROUP BY 1""")
def window_range(spark, d):
    """A33."""
    w = table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("a"))
    return studies.window_range(w, "a", "a", ["l_suppkey"])


@query("""
WITH c AS (SELECT DISTINCT floor(l_extendedprice / 1000)::INT AS ix, floor(l_quantity)::INT AS iy FROM lineitem), e AS (SELECT l_suppkey, min(floor(l_extendedprice / 1000))::INT AS x1, min(floor(l_extendedprice / 1000))::INT + 3 AS x2, min(floor(l_quantity))::INT AS y1, max(floor(l_quantity))::INT - 20 AS y2 FROM lineitem GROUP BY 1)
SELECT ix, iy, (EXISTS (SELECT 1 FROM e WHERE ix BETWEEN x1 AND x2 AND iy BETWEEN y1 AND y2))::INT AS covered FROM c""")
def coverage_mask(spark, d):
    """A26."""
    line = table(spark, d, "lineitem").select("l_suppkey", F.floor(F.col("l_extendedprice") / 1000).cast("int").alias("ix"), F.floor("l_quantity").cast("int").alias("iy"))
    ext = line.groupBy("l_suppkey").agg(F.min("ix").alias("ix_min"), (F.min("ix") + 3).alias("ix_max"), F.min("iy").alias("iy_min"), (F.max("iy") - 20).alias("iy_max")).where("iy_min <= iy_max")
    return zonal.coverage_mask(line.select("ix", "iy").distinct(), ext, tile=16)


@query("""
WITH c AS (SELECT DISTINCT user_id AS region, (event_id % 3)::BIGINT AS ix, 0 AS iy FROM events), s AS (SELECT user_id AS region, max(value) AS rain FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1), m AS (SELECT user_id AS region, min(value) AS rain FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT c.region, ix, iy, s.rain AS rain_single, m.rain AS rain_multi FROM c LEFT JOIN s USING (region) LEFT JOIN m USING (region)""")
def attribute_layers(spark, d):
    """Two attributes burnt on the cells of their regions."""
    ev = table(spark, d, "events").withColumn("region", F.col("user_id"))
    cells = ev.select("region", (F.col("event_id") % 3).alias("ix"), F.lit(0).alias("iy")).distinct()
    single = ev.groupBy("region").agg(F.max(F.when(F.expr("ts < timestamp'2024-01-10'"), F.col("value"))).alias("rain"))
    multi = ev.groupBy("region").agg(F.min(F.when(F.expr("ts >= timestamp'2024-01-20'"), F.col("value"))).alias("rain"))
    return zonal.attribute_layers(cells, single, multi, ["rain"])


@query("""SELECT event_type AS path, 48.5::DOUBLE AS latitude, 30.25::DOUBLE AS longitude, ts::DATE AS date, 0.0::DOUBLE AS radn, round(max(value), 2) AS maxt, round(min(value), 2) AS mint, CASE WHEN count(*) % 5 = 0 THEN 0.0 ELSE count(*) END::DOUBLE AS rain FROM events GROUP BY event_type, ts::DATE""")
def parse_weather_files(spark, d):
    """Weather file lines made from events, read back by header name; -999 becomes 0."""
    ev = table(spark, d, "events").groupBy(F.col("event_type").alias("path"), F.to_date("ts").alias("date")).agg(F.max("value").alias("maxt"), F.min("value").alias("mint"), F.count(F.lit(1)).alias("n"))
    rain = F.when(F.col("n") % 5 == 0, -999).otherwise(F.col("n"))
    rows = ev.select("path", F.format_string("%d %d %.2f -999 %.2f %d", F.year("date"), F.dayofyear("date"), "maxt", "mint", rain).alias("value"))
    heads = ev.select("path").distinct().select("path", F.explode(F.array(*map(F.lit, ("[weather.met.weather]", "latitude = 48.50  (DECIMAL DEGREES)", "Longitude = 30.25  (DECIMAL DEGREES)", "year day maxt radn mint rain", "() () (oC) (MJ/m^2) (oC) (mm)")))).alias("value"))
    return readers.parse_met(heads.unionByName(rows)).select("path", "latitude", "longitude", "date", "radn", "maxt", "mint", "rain")


@query("""
WITH w AS (SELECT o_custkey, year(o_orderdate)::INT AS year, min(o_orderdate::DATE) AS a, max(o_orderdate::DATE) AS b FROM orders GROUP BY ALL), m AS (SELECT c_custkey AS o_custkey, y AS year FROM customer, (SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders))
SELECT m.o_custkey, m.year, CASE WHEN a IS NULL THEN 'a or b is missing or no date' ELSE 'a is not before b' END AS error FROM m LEFT JOIN w USING (o_custkey, year) WHERE a IS NULL OR a >= b""")
def window_errors(spark, d):
    """Date windows of every customer and year."""
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), F.to_date("o_orderdate").alias("a"))
    win = o.groupBy("o_custkey", "year").agg(F.min("a").alias("a"), F.max("a").alias("b"))
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")).crossJoin(o.select("year").distinct())
    return checks.window_errors(wanted, win, ["o_custkey", "year"], [("a", "b")])


@query("""SELECT year(o_orderdate)::INT AS year, o_orderstatus AS timepoint, o_custkey % 50 AS level, count(DISTINCT o_orderpriority) AS n_studies FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderpriority) > 1""")
def several_studies(spark, d):
    """Q8."""
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("timepoint"), (F.col("o_custkey") % 50).alias("level"), F.col("o_orderpriority").alias("study_id"))
    return checks.several_studies(o)


@query("""
WITH a AS (SELECT l_suppkey, min(l_quantity) AS x0, max(l_quantity) AS y0 FROM lineitem WHERE l_tax > 0.04 GROUP BY 1), b AS (SELECT l_suppkey, min(l_extendedprice) AS x0, max(l_quantity) AS y0 FROM lineitem WHERE l_tax <= 0.04 GROUP BY 1)
SELECT l_suppkey, 'origin' AS why FROM a JOIN b USING (l_suppkey) WHERE abs((b.x0 - a.x0) / 2 - round((b.x0 - a.x0) / 2)) > 1e-6 OR abs((b.y0 - a.y0) / 2 - round((b.y0 - a.y0) / 2)) > 1e-6""")
def unaligned_grids(spark, d):
    """Q5: grids whose origins are not whole pixels of 2 apart."""
    line = table(spark, d, "lineitem")
    rest = {"dx": F.lit(2.0), "dy": F.lit(2.0), "rx": F.lit(0.0), "ry": F.lit(0.0), "crs": F.lit("c")}
    a = line.where("l_tax > 0.04").groupBy("l_suppkey").agg(F.min("l_quantity").alias("x0"), F.max("l_quantity").alias("y0")).withColumns(rest)
    b = line.where("l_tax <= 0.04").groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("x0"), F.max("l_quantity").alias("y0")).withColumns(rest)
    return checks.unaligned(a, b, ["l_suppkey"]).withColumn("why", F.array_join("why", ","))


@query("""SELECT o_orderpriority AS level, 'study' || (o_custkey % 20) AS study_id, year(o_orderdate)::VARCHAR AS year, 'T-' || o_orderstatus AS timepoint FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL""")
def study_parts(spark, d):
    """Levels, studies, years and timepoints out of paths."""
    o = table(spark, d, "orders")
    path = F.concat(F.lit("/base/"), "o_orderpriority", F.lit("/study"), (F.col("o_custkey") % 20).cast("string"), F.lit("/"), F.year("o_orderdate").cast("string"), F.lit("/T-"), "o_orderstatus", F.lit("/agg.csv"))
    return studies.distinct_parts(readers.study_parts(o.select(path.alias("path"))), "level", "study_id", "year", "timepoint")


@query("""
WITH s AS (SELECT event_id, user_id % 30 AS tile, ts::DATE AS day, hour(ts) % 2 AS sat, date_trunc('hour', ts) AS sensed, ts FROM events)
SELECT lpad(tile::VARCHAR, 5, '0') AS tile, sensed, date_trunc('second', max(ts)) AS processed FROM s GROUP BY tile, sensed, sat""")
def latest_scenes(spark, d):
    """Scene ids made from events, parsed, and the latest processing of each sensing time kept."""
    ev = table(spark, d, "events")
    stamp = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss")
    sat = F.when(F.hour("ts") % 2 == 0, "S2A").otherwise("S2B")
    item = F.concat_ws("_", sat, F.lit("MSIL2A"), stamp(F.date_trunc("hour", "ts")), F.lit("R065"), F.concat(F.lit("T"), F.lpad((F.col("user_id") % 30).cast("string"), 5, "0")), stamp("ts"))
    return simulation.latest_scene(dates.scene_fields(ev.select(item.alias("id")))).select(F.substring("tile", 2, 5).alias("tile"), "sensed", "processed")


@query("""SELECT ts::DATE AS date, CASE WHEN bool_or(value > 420) THEN 'FINAL' ELSE 'PRELIM' END AS product FROM events GROUP BY 1""")
def preferred_product(spark, d):
    """W7."""
    files = table(spark, d, "events").select(F.to_date("ts").alias("date"), F.when(F.col("value") > 420, "FINAL").otherwise("PRELIM").alias("product"))
    return weather.prefer_final(files, 2)


@query("""SELECT l_partkey, max(l_quantity) AS sun_zenith, round(max(l_tax) * 100) AS view_zenith FROM lineitem GROUP BY 1""")
def granule_angles(spark, d):
    """Angles out of metadata made for each part of the line items."""
    granules = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.max("l_quantity").cast("string").alias("q"), F.round(F.max("l_tax") * 100).cast("string").alias("v"))
    q, v = F.col("q"), F.col("v")
    xml = F.concat(F.lit("<m><Mean_Sun_Angle><ZENITH_ANGLE unit='deg'>"), q, F.lit("</ZENITH_ANGLE><AZIMUTH_ANGLE unit='deg'>1</AZIMUTH_ANGLE></Mean_Sun_Angle><Mean_Viewing_Incidence_Angle bandId='8'><ZENITH_ANGLE unit='deg'>"), v, F.lit("</ZENITH_ANGLE></Mean_Viewing_Incidence_Angle></m>"))
    return readers.granule_angles(granules.select("l_partkey", xml.alias("xml"))).select("l_partkey", "sun_zenith", "view_zenith")


@query("""SELECT n_name AS region, n_nationkey::DOUBLE AS lon, n_regionkey::DOUBLE + 40 AS lat, n_regionkey::VARCHAR AS zone, 16.0::DOUBLE AS area FROM nation""")
def regions_from_geojson(spark, d):
    """Feature documents made from nations, read as polygons with attributes and centroid."""
    n = table(spark, d, "nation")
    x, y = F.col("n_nationkey") * 10, F.col("n_regionkey") * 10
    ring = F.array(F.array(x, y), F.array(x + 4, y), F.array(x + 4, y + 4), F.array(x, y + 4), F.array(x, y))
    props = F.struct(F.col("n_name").alias("NAME"), F.col("n_regionkey").alias("zone"), F.format_string("POINT (%d %d)", "n_nationkey", F.col("n_regionkey") + 40).alias("centroid"))
    feature = F.struct(props.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    docs = n.groupBy("n_regionkey").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    return geo.area_centroid(readers.read_regions(spark, docs, "NAME")).select("region", "lon", "lat", F.col("attrs")["zone"].alias("zone"), "area")


@query("""
WITH g AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag AS crs FROM g QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1""")
def common_crs(spark, d):
    """The commonest system of each supplier's tiles, the first by name in a tie."""
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.mode("l_returnflag", True).alias("crs"))


@query("""SELECT c_custkey, c_acctbal BETWEEN -50 AND 50 AS in_v2, c_acctbal BETWEEN -60 AND 60 AS in_v3 FROM customer""")
def precipitation_bounds(spark, d):
    """F11."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", geo.in_bounds(F.lit(0.0), F.col("c_acctbal"), 2).alias("in_v2"), geo.in_bounds(F.lit(0.0), F.col("c_acctbal"), 3).alias("in_v3"))


@query("""
WITH f AS (SELECT DISTINCT event_type AS product, (user_id % 2 + 2)::INT AS version, ts::DATE AS date FROM events WHERE value > 150), w AS (SELECT p.product, d.date FROM (SELECT DISTINCT event_type AS product FROM events) p, (SELECT DISTINCT ts::DATE AS date FROM events) d)
SELECT product, version, date FROM w, (VALUES (2), (3)) v(version) EXCEPT SELECT product, version, date FROM f""")
def missing_products(spark, d):
    """Q10."""
    ev = table(spark, d, "events")
    files = ev.where("value > 150").select(F.col("event_type").alias("product"), (F.col("user_id") % 2 + 2).cast("int").alias("version"), F.to_date("ts").alias("date"))
    wanted = ev.select(F.col("event_type").alias("product")).distinct().crossJoin(ev.select(F.to_date("ts").alias("date")).distinct())
    return checks.missing_products(files, wanted, spark.createDataFrame([(2,), (3,)], "version int"))


@query("""
WITH e AS (SELECT s_suppkey AS region, s_acctbal AS kg FROM supplier), f AS (SELECT l_suppkey AS region, max(l_extendedprice) AS f FROM lineitem WHERE l_tax > 0.07 AND l_quantity > 45 GROUP BY 1)
SELECT e.region, kg, f.f, n_name AS zone, r.o AS o_ref FROM e JOIN f USING (region) LEFT JOIN (SELECT s_suppkey AS region, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) USING (region) LEFT JOIN (SELECT o_custkey AS region, max(o_totalprice) AS o FROM orders GROUP BY 1) r USING (region)""")
def assembled_regions(spark, d):
    """Estimate and factor inner, attributes and reference left."""
    sup = table(spark, d, "supplier")
    est = sup.select(F.col("s_suppkey").alias("region"), F.col("s_acctbal").alias("kg"))
    fac = table(spark, d, "lineitem").where("l_tax > 0.07 and l_quantity > 45").groupBy(F.col("l_suppkey").alias("region")).agg(F.max("l_extendedprice").alias("f"))
    attrs = sup.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("region"), F.col("n_name").alias("zone"))
    ref = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("region")).agg(F.max("o_totalprice").alias("o"))
    return studies.assemble_regions(est, fac, attrs=attrs, keep=["zone"], reference=ref)


@query("""SELECT s_suppkey AS region, s_name, rep AS reported_mean_yield_kg_ha FROM supplier LEFT JOIN (SELECT l_suppkey AS k, max(CASE WHEN l_linenumber = 7 THEN l_quantity END) AS rep FROM lineitem GROUP BY 1) ON k = s_suppkey""")
def with_reference(spark, d):
    """Level statistics with reference yields, replacing a column of that name."""
    section = table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"), "s_name", F.lit(0.0).alias("reported_mean_yield_kg_ha"))
    ref = zonal.extract_reference(table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max(F.when(F.col("l_linenumber") == 7, F.col("l_quantity"))).alias("q")), "l_suppkey", "q")
    return studies.with_reference(section, ref)
