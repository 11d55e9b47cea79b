"""Cases with known answers for the operators."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.functions import dates, names, pixels
from fieldspark.operators import checks, evaluate, geo, lai, series, simulation, studies, weather, zonal
from fieldspark.sources import readers, sinks


def day(s):
    return dt.date.fromisoformat(s)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


# --- predictions and observations


def pairs(spark, obs, pred):
    return spark.createDataFrame([(float(o), float(p)) for o, p in zip(obs, pred)], "obs double, pred double")


@pytest.mark.parametrize(
    "obs,pred,want",
    [
        ([100, 200, 300], [110, 190, 310], {"n": 3, "rmse": 10.0, "rrmse": 5.0, "mean_error": 10 / 3}),
        ([1000, 2000, 3000], [1100, 2100, 3100], {"mean_error": 100.0, "rmse": 100.0, "pearson_r2": 1.0}),
        ([120], [100], {"n": 1, "rmse": 20.0, "r2": None}),
        ([1000, 2000, 3000], [1000, 1500, 2000], {"pearson_r2": 1.0}),
        ([5, 5], [5, 5], {"r2": None, "pearson_r2": None, "rmse": 0.0}),
    ],
)
def test_metrics(spark, obs, pred, want):
    r = one(evaluate.metrics(pairs(spark, obs, pred)))
    for k, v in want.items():
        assert r[k] == (v if v is None else pytest.approx(v))


def test_metrics_of_nothing_and_reversed(spark):
    r = one(evaluate.metrics(spark.createDataFrame([], "obs double, pred double")))
    assert r["n"] == 0 and r["rmse"] is None and r["r2"] is None
    assert one(evaluate.metrics(pairs(spark, [100, 200, 300, 400], [400, 300, 200, 100])))["r2"] < 0
    rolled = evaluate.metrics_rollup(pairs(spark, [1, 2, 3], [1, 2, 4]).withColumn("year", F.col("obs").cast("int")), ["year"])
    total = one(rolled.where("level_of_total = 1"))
    assert total["n"] == 3 and total["rmse"] == pytest.approx(math.sqrt(1 / 3))


def test_errors(spark):
    df = spark.createDataFrame([(110.0, 100.0), (190.0, 200.0), (5.0, 0.0), (0.0, 0.0)], "p double, o double")
    got = df.select(names.error(F.col("p"), F.col("o")).alias("e"), names.relative_error(F.col("p"), F.col("o")).alias("r")).collect()
    assert [(r.e, r.r) for r in got[:3]] == [(10, 10), (-10, -5), (5, math.inf)] and math.isnan(got[3].r)


def test_match(spark):
    pred = spark.createDataFrame([("A", 1000.0, 10.0), ("C", 500.0, 10.0), ("D", None, 1.0)], "region string, mean_yield_kg_ha double, total_area_ha double")
    obs = spark.createDataFrame([("A", None, 50000.0), ("B", 1.0, None), ("C", 700.0, None), ("D", 5.0, None)], "region string, reported_mean_yield_kg_ha double, reported_production_kg double")
    got = {r.region: r.obs for r in evaluate.match(pred, obs).collect()}
    assert got == {"A": 5000.0, "C": 700.0}
    with pytest.raises(ValueError):
        evaluate.match(pred, obs, pixel_converted=False)
    with pytest.raises(ValueError):
        evaluate.match(pred, obs.select("region"))


@pytest.mark.parametrize("rows,mean,median", [([(1000, 50), (3000, 50)], 2000, 1000), ([(1000, 90), (2000, 10)], 1100, 1000), ([(1000, 10), (3000, 90)], 2800, 3000), ([(1000, 30), (2000, 40), (5000, 30)], 2600, 2000), ([(0, -1), (3000, 100)], 3000, 3000)])
def test_level_aggregation(spark, rows, mean, median):
    df = spark.createDataFrame([("x", float(y), float(a), int(y * a), 1.0) for y, a in rows], "level string, mean_yield_kg_ha double, total_area_ha double, total_yield_production_kg long, total_yield_production_ton double")
    r = one(evaluate.aggregate_level(df, "level"))
    assert r.mean_yield_kg_ha == pytest.approx(mean) and r.median_yield_kg_ha == median
    assert r.total_area_ha == sum(a for _, a in rows if a > 0)


def test_years(spark):
    pred = spark.createDataFrame([(y, r, 1000.0, 7) for y in ("2022", "2023") for r in "AB"], "study_year string, region string, pred double, year int")
    ref = spark.createDataFrame([("2022", "A", 1100.0), ("2022", "B", 1900.0)], "study_year string, region string, reported double")
    got = evaluate.years_with_reference(pred, ref)
    assert "year_original" in got.columns and [(r.year, r.region, r.reported) for r in got.collect()] == [("2022", "A", 1100.0), ("2022", "B", 1900.0), ("2023", "A", None), ("2023", "B", None)]
    two = spark.createDataFrame([("2022", "T-0", "l", "s1"), ("2022", "T-0", "l", "s2")], "year string, timepoint string, level string, study_id string")
    assert one(checks.several_studies(two)).n_studies == 2


# --- leaf area


def test_pixels(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "v double")
    col = lambda c: [r[0] for r in df.select(c).collect()]
    v = F.col("v")
    assert col(pixels.drop_negative(pixels.missing_if_nan(v))) == [None, 0, 1, 2, None, None]
    assert col(pixels.adjust_for_crop(v, "wheat"))[2] == pytest.approx(0.9669) and col(pixels.adjust_for_crop(v, "maize"))[2] == pytest.approx(1.142)
    assert col(pixels.adjust_for_crop(v, None))[:4] == [-0.5, 0, 1, 2]
    with pytest.raises(ValueError):
        pixels.adjust_for_crop(v, "rice")
    assert col(pixels.yield_pixel(v, F.lit(100.0)))[:5] == [0, 0, 100, 200, None]
    assert col(pixels.binarize(v, 1))[:4] == [0, 0, 1, 1]
    assert col(pixels.apply_mask(v, F.lit(0)))[:3] == [None] * 3
    got = spark.range(1).select(pixels.harmonize(F.lit(0), F.lit(4)), pixels.harmonize(F.lit(900), F.lit(4)), pixels.harmonize(F.lit(1500), F.lit(4)), pixels.harmonize(F.lit(1500), F.lit(3)), pixels.keep_hls_pixel(F.lit(33)), pixels.keep_hls_pixel(F.lit(2)), pixels.cos_band_hls(F.lit(6000), 55537), pixels.cos_band_hls(F.lit(55537), 55537)).first()
    assert tuple(got) == (0, 0, 500, 1500, True, False, 5000, -9999)
    with pytest.raises(Exception, match="baseline"):
        spark.range(1).select(pixels.harmonize(F.lit(1), F.lit(None).cast("double"))).collect()
    assert one(spark.range(1).select(pixels.keep_s2_pixel(F.lit(4), F.lit(None).cast("int"), F.lit(20), 50, 10)))[0] is False


def on_mask(px, mask):
    """Plain version of J10: a row for every mask cell and day, missing outside the raster."""
    cells = mask.crossJoin(px.select("date").distinct())
    return cells.join(px, ["date", "ix", "iy"], "left").withColumn("v", pixels.apply_mask(F.col("v"), F.col("m")))


def test_daily_stats_and_clouds(spark):
    lai_px = spark.createDataFrame([("2024-01-01", 0, 0, 1.0), ("2024-01-01", 1, 0, None), ("2024-01-01", 0, 1, 3.0), ("2024-01-01", 1, 1, 5.0), ("2024-01-02", 0, 0, 2.0)], "date string, ix int, iy int, v double")
    mask = spark.createDataFrame([("r", x, y, 1) for x in range(2) for y in range(2)] + [("r", 5, 5, 0)], "region string, ix int, iy int, m int")
    daily = lai.daily_stats(on_mask(lai_px, mask), ["region", "date"])
    got = {r.date: r for r in lai.reject_cloudy(daily, 0.5).collect()}
    a, b = got["2024-01-01"], got["2024-01-02"]
    assert (a.n_pixels, a.lai_mean, a.lai_median, a.cloud_pct) == (3, 3, 3, 25.0) and a.lai_std == pytest.approx(1.632993, abs=1e-6)
    assert b.lai_mean is None and b.cloud_pct == 75.0 and b.n_pixels == 1
    top = {(r.ix, r.iy): r.max_lai for r in lai.season_max(on_mask(lai_px, mask), ["ix", "iy"]).collect()}
    assert top == {(0, 0): 2, (1, 0): None, (0, 1): 3, (1, 1): 5, (5, 5): None}
    assert one(lai.valid_regions(mask, 3)).n_crop == 4 and lai.valid_regions(mask, 4).count() == 0


def test_mask_keeps_each_pixel_in_place(spark):
    px = spark.createDataFrame([("d", x, y, float(10 * x + y)) for x in range(4) for y in range(4)], "date string, ix int, iy int, v double")
    mask = spark.createDataFrame([("r", x, y, int((x + y) % 2)) for x in range(-1, 6) for y in range(4)], "region string, ix int, iy int, m int")
    for r in on_mask(px, mask).collect():
        inside = 0 <= r.ix < 4 and r.m == 1
        assert r.v == (10 * r.ix + r.iy if inside else None)


def akima(t, y, at):
    """Plain version from the published formula."""
    t, y = np.array(t, float), np.array(y, float)
    if len(t) == 1:
        return [None] * len(at)
    m = np.diff(y) / np.diff(t)
    m = np.r_[0, 0, m, 0, 0]
    if len(t) == 2:
        m[:] = m[2]
    else:
        m[1] = 2 * m[2] - m[3]
        m[0] = 2 * m[1] - m[2]
        m[-2] = 2 * m[-3] - m[-4]
        m[-1] = 2 * m[-2] - m[-3]
    w1, w2 = np.abs(m[3:] - m[2:-1])[: len(t)], np.abs(m[1:-2] - m[:-3])[: len(t)]
    w = w1 + w2
    left, right = m[1:-2][: len(t)], m[2:-1][: len(t)]
    d = np.where(w <= 1e-9 * w.max(), (left + right) / 2, (w1 * left + w2 * right) / np.where(w == 0, 1, w))
    out = []
    for x in at:
        if x < t[0] or x > t[-1]:
            out.append(None)
            continue
        i = min(int(np.searchsorted(t, x, side="right")) - 1, len(t) - 2)
        h = t[i + 1] - t[i]
        s = (x - t[i]) / h
        out.append(max(0.0, (2 * s**3 - 3 * s**2 + 1) * y[i] + (s**3 - 2 * s**2 + s) * h * d[i] + (3 * s**2 - 2 * s**3) * y[i + 1] + (s**3 - s**2) * h * d[i + 1]))
    return out


@pytest.mark.parametrize("values", [[1.0, None, 3.0], [None, 2.0, None, None, 5.0, 1.0, None, 0.0, 4.0, None], [1.0, None, 1.0, None, 2.0, 2.0, None, 2.0], [None, 3.0, None], [0.5, 3.0, None, None, None, 0.1, 0.2, None, 7.0, 8.0, 7.5]])
def test_akima(spark, values):
    rows = [("r", day("2024-03-01") + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    got = [(r.v, r.interpolated) for r in series.akima_fill(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", ["v"]).orderBy("d").collect()]
    t = [i for i, v in enumerate(values) if v is not None]
    want = akima(t, [values[i] for i in t], range(len(values)))
    for i, v in enumerate(values):
        expect = v if v is not None else want[i]
        assert (got[i][0] is None) == (expect is None) and (expect is None or got[i][0] == pytest.approx(expect, abs=1e-9))
        assert got[i][1] == int(v is None and expect is not None)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 6, 8, 9, 15])
def test_savgol(spark, n):
    rng = np.random.default_rng(n)
    v = rng.random(n) * 5
    rows = []
    for i in range(n):
        rows += [("r", 2 * i, float(v[i])), ("r", 2 * i + 1, None)]
    got = series.savgol_smooth(spark.createDataFrame(rows, "k string, d int, v double"), ["k"], "d", ["v"]).orderBy("d").collect()
    w = 9 if n >= 9 else (n if n % 2 else n - 1) if n > 4 else n
    want = v.copy()
    if n >= 4:
        for r in range(n):
            s = min(max(r - (w - 1) // 2, 0), n - w)
            c = np.polyfit(np.arange(w), v[s : s + w], 2)
            want[r] = max(0.0, np.polyval(c, r - s))
    assert [r["v Unsmoothed"] for r in got[::2]] == pytest.approx(list(v))
    assert [r.v for r in got[::2]] == pytest.approx(list(want), abs=1e-8)
    assert all(r.v is None for r in got[1::2])


def test_linear_and_runs_and_spine(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])], "k string, i int, v double")
    assert [r.v for r in series.linear_fill(df, ["k"], "i", ["v"]).orderBy("i").collect()] == [1, 1, 2, 3, 4, 4]
    d = spark.createDataFrame([("a", day(x)) for x in ("2024-02-28", "2024-02-29", "2024-03-01", "2024-03-01", "2024-03-05")], "k string, d date")
    got = sorted((str(r.first_day), str(r.last_day), r.n_days) for r in series.date_runs(d, ["k"], "d").collect())
    assert got == [("2024-02-28", "2024-03-01", 3), ("2024-03-05", "2024-03-05", 1)]
    assert series.every_day(d.distinct().withColumn("v", F.lit(1)), ["k"], "d").where("v is null").count() == 3


def not_a_knot(x, y, at):
    """Plain version: values of the cubic spline whose first and last two pieces are each one cubic, by a full system."""
    n, h = len(x), np.diff(x)
    out = np.full(len(at), np.nan)
    inside = (at >= x[0]) & (at <= x[-1])
    if n < 4:
        out[inside] = np.polyval(np.polyfit(x - x[0], y, n - 1), at[inside] - x[0])
        return out
    a, r = np.zeros((n, n)), np.zeros(n)
    slope = np.diff(y) / h
    a[0, :3] = [h[1], -(h[0] + h[1]), h[0]]
    a[-1, -3:] = [h[-1], -(h[-2] + h[-1]), h[-2]]
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = [h[i - 1], 2 * (h[i - 1] + h[i]), h[i]]
        r[i] = 6 * (slope[i] - slope[i - 1])
    m = np.linalg.solve(a, r)
    i = np.clip(np.searchsorted(x, at[inside], side="right") - 1, 0, n - 2)
    d = at[inside] - x[i]
    out[inside] = y[i] + d * (slope[i] - h[i] * (2 * m[i] + m[i + 1]) / 6) + d * d * m[i] / 2 + d**3 * (m[i + 1] - m[i]) / (6 * h[i])
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 30])
def test_spline_against_a_full_system(spark, n):
    rng = np.random.default_rng(n)
    at = np.cumsum(rng.integers(1, 5, n)) + 3
    values = rng.random(n) * 10
    rows = [("a", day("2024-01-01") + dt.timedelta(days=i), float(values[list(at).index(i)]) if i in at else None) for i in range(int(at[-1]) + 4)]
    got = [r.v for r in series.spline_fill(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", "v").orderBy("d").collect()]
    want = not_a_knot(at.astype(float), values, np.arange(len(rows), dtype=float)) if n > 1 else [values[0] if i == at[0] else np.nan for i in range(len(rows))]
    for a, b in zip(got, want):
        assert (a is None) == bool(np.isnan(b)) and (a is None or a == pytest.approx(b, abs=1e-9))


def test_series_are_gathered_once(spark):
    """Several columns and series with days left out: as one column and series at a time, and without windows or Python."""
    rng = np.random.default_rng(2)
    rows = [(k, day("2023-12-01") + dt.timedelta(days=int(i)), float(rng.random()) if rng.random() < 0.6 else None, float(rng.random()) if rng.random() < 0.3 else None, "x") for k in ("a", "b", None) for i in rng.permutation(40)[:25]]
    df = spark.createDataFrame(rows, "k string, d date, v double, w double, note string").repartition(3)
    out = series.akima_fill(series.savgol_smooth(df, ["k"], "d", ["v", "w"]), ["k"], "d", ["v", "w", "v Unsmoothed"])
    assert set(out.columns) == {"k", "d", "v", "w", "note", "v Unsmoothed", "w Unsmoothed", "interpolated"}
    both = {(r.k, r.d): r for r in out.collect()}
    for c in ("v", "w"):
        alone = series.akima_fill(series.savgol_smooth(df, ["k"], "d", [c]), ["k"], "d", [c])
        assert {(r.k, r.d): r[c] for r in alone.collect()} == {k: r[c] for k, r in both.items()}
    full = series.dealt_out(series.every_day_of(series.gathered(df, ["k"], "d"), ["k"], "d"), ["k"]).select("k", "d", "v", "w", "note")
    spine = series.every_day(df, ["k"], "d").where("k is not null").select("k", "d", "v", "w", "note")
    assert sorted(map(repr, full.where("k is not null").collect())) == sorted(map(repr, spine.collect()))
    for plan in (series.savgol_smooth(df, ["k"], "d", ["v", "w"]), series.akima_fill(df, ["k"], "d", ["v", "w"]), series.spline_fill(df, ["k"], "d", "v")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        # the test's own repartition is the other exchange
        assert text.count("Exchange") == 2 and "Window" not in text and "Python" not in text and "Pandas" not in text


def test_spline(spark):
    x = np.array([0.0, 1, 3, 4, 7, 9])
    cubic = lambda t: 0.3 * t**3 - 2 * t**2 + t + 40
    assert not_a_knot(x, cubic(x), np.array([2.0, 5, 6, 8])) == pytest.approx(cubic(np.array([2.0, 5, 6, 8])))  # a cubic is its own spline
    rows = [("a", day("2024-01-01") + dt.timedelta(days=i), float(cubic(i)) if i in x else None) for i in range(11)]
    got = series.spline_fill(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", "v").orderBy("d").collect()
    assert got[5].v == pytest.approx(cubic(5)) and got[5].interpolated == 1 and got[10].v is None and got[0].interpolated == 0


# --- weather


def test_met_files(spark, tmp_path):
    (tmp_path / "a.met").write_text("[weather.met.weather]\nlatitude = 48.50  (DECIMAL DEGREES)\nlongitude = 30.00  (DECIMAL DEGREES)\ntav = 9.00 (oC)\nyear day radn maxt mint meant rain wind\n() () (MJ/m^2) (oC) (oC) (oC) (mm) (m/s)\n2022 32   15.00    10.00   -2.00   4.00  -999     3.00\n2022 33   -999    -999   -1.00   5.00  2.00     5.00\n")
    got = readers.read_met(spark, str(tmp_path / "a.met")).orderBy("date").collect()
    assert [str(r.date) for r in got] == ["2022-02-01", "2022-02-02"] and got[0].latitude == 48.5 and got[0].longitude == 30
    assert (got[0].rain, got[1].radn, got[1].maxt, got[0].meant) == (0, 0, 0, 4)
    assert readers.read_met(spark, str(tmp_path / "a.met"), missing="null").orderBy("date").first().rain is None


def test_met_round_trip(spark, tmp_path):
    met = spark.createDataFrame([("r", day("2022-02-01") + dt.timedelta(days=i), 15.0 + i, 10.126, -1.0, 4.5, 0.5, 3.0) for i in range(3)], "region string, date date, radn double, maxt double, mint double, meant double, rain double, wind double")
    heads = spark.createDataFrame([("r", 48.5, 30.0, 9.1, 20.2)], "region string, lat double, lon double, tav double, amp double")
    sinks.write_met(met, heads, str(tmp_path / "out"), partitions=2)
    back = readers.read_met(spark, str(tmp_path / "out" / "region=r")).orderBy("date").collect()
    assert [r.radn for r in back] == [15, 16, 17] and back[0].maxt == 10.13 and back[0].latitude == 48.5


def test_weather(spark):
    met = spark.createDataFrame([("x", day("2021-05-01"), 15.0, 10.0, 3.0, 5.0), ("x", day("2022-05-01"), 17.0, 12.0, 5.0, 7.0), ("x", day("2022-05-02"), 16.0, 11.0, 4.0, 3.0)], "loc string, date date, radn double, maxt double, wind double, rain double")
    r = one(weather.location_stats(met, ["loc"], means=("radn", "maxt", "wind")))
    assert (r.radn, r.maxt, r.wind, r.rain) == (16, 11, pytest.approx(14.4), 7.5)
    clean = weather.clean_power(spark.createDataFrame([("x", i, v) for i, v in enumerate([-999.0, 2.0, -999.0, 4.0])], "loc string, d int, t double"), ["loc"], "d", ["t"])
    assert [r.t for r in clean.orderBy("d").collect()] == [2, 2, 3, 4]
    flat = weather.flatten_payload(spark.createDataFrame([("x", '{"T2M": {"20220101": 1.5, "20220102": -999}, "RAIN": {"20220101": 0.0}}')], "loc string, p string"), ["loc"], "p", ["T2M", "RAIN"])
    assert {str(r.date): (r.T2M, r.RAIN) for r in flat.collect()} == {"2022-01-01": (1.5, 0), "2022-01-02": (-999, None)}
    era = weather.era5_units(spark.createDataFrame([(293.15, 283.15, 2e6, -0.001, 3.0, 4.0), (None, 280.0, None, 0.002, 0.0, 0.0)], "temperature_2m_max double, temperature_2m_min double, surface_solar_radiation_downwards_sum double, total_precipitation_sum double, u_component_of_wind_10m double, v_component_of_wind_10m double")).collect()
    assert (era[0].maxt, era[0].meant, era[0].radn, era[0].rain, era[0].wind) == (pytest.approx(20), pytest.approx(15), 2, 0, 5) and era[1].maxt == 0
    bad = weather.limit_violations(spark.createDataFrame([("x", 55.0, -50.0, 5.0), ("y", 20.0, 0.0, 25.0)], "loc string, maxt double, mint double, wind double"), ["loc"])
    assert sorted((r.loc, r.variable) for r in bad.collect()) == [("x", "maxt"), ("x", "mint"), ("y", "wind")]


def test_climatology_and_override(spark):
    met = spark.createDataFrame([("r", day("2019-01-01") + dt.timedelta(days=i), float(i % 365)) for i in range(730)], "region string, date date, rain double")
    clim = weather.doy_climatology(met, ["region"], "date", ["rain"])
    c = {r.doy: r.rain for r in clim.collect()}
    assert len(c) == 366 and weather.require_full_year(clim, ["region"]).count() == 0
    short = weather.doy_climatology(met.where("month(date) < 12"), ["region"], "date", ["rain"])
    assert one(weather.require_full_year(short, ["region"])).n_days < 365
    few = spark.createDataFrame([("a", day("2024-01-01"), 1.0), ("a", day("2024-01-02"), 2.0), ("b", day("2024-01-01"), 3.0)], "region string, date date, rain double")
    other = spark.createDataFrame([("a", day("2024-01-01"), 9.0), ("b", day("2024-01-01"), 8.0)], "region string, date date, mm double")
    got = {(r.region, str(r.date)): r.rain for r in weather.override_rain(few, other, allow_gaps=True).collect()}
    assert got == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 2, ("b", "2024-01-01"): 8}
    with pytest.raises(Exception, match="no full precipitation"):
        weather.override_rain(few, other).collect()
    files = spark.createDataFrame([("2024-01-01", "FINAL"), ("2024-01-01", "PRELIM"), ("2024-01-02", "PRELIM")], "date string, product string")
    assert sorted(map(tuple, weather.prefer_final(files, 2).collect())) == [("2024-01-01", "FINAL"), ("2024-01-02", "PRELIM")]
    assert weather.prefer_final(files, 3).count() == 1


# --- geometry


def square(name, x, y, side=1.0, hole=None):
    ring = lambda a, b, s: [(a, b), (a + s, b), (a + s, b + s), (a, b + s), (a, b)]
    rings = [ring(x, y, side)]
    if hole:
        rings.append(ring(*hole)[::-1])
    return (name, rings)


RINGS = "region string, rings array<array<struct<x: double, y: double>>>"


def test_points_and_area(spark):
    regions = spark.createDataFrame([square("a", 0.0, 0.0, 10.0, (4.0, 4.0, 2.0)), square("b", 20.0, 0.0, 5.0)], RINGS)
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 22.0, 2.0), (4, 50.0, 50.0)], "id int, x double, y double")
    got = {r.id: r.region for r in geo.points_in_polygons(pts, regions, 3.0, how="left").collect()}
    assert got == {1: "a", 2: None, 3: "b", 4: None}
    area = {r.region: (r.area, r.cx, r.cy) for r in geo.area_centroid(regions).collect()}
    assert area["a"] == pytest.approx((96, 5, 5)) and area["b"] == pytest.approx((25, 22.5, 2.5))
    flat = spark.createDataFrame([("line", [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]), ("dot", [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)]])], RINGS)
    assert geo.with_edges(flat).count() == 0


def test_coverage_adds_up(spark):
    regions = spark.createDataFrame([square("a", 0.25, 0.6, 3.5, (1.6, 1.6, 0.7)), ("tri", [[(10.2, 10.1), (14.7, 10.9), (11.3, 15.2), (10.2, 10.1)]]), square("tiny", 30.4, 30.4, 0.1)], RINGS)
    cover = {r.region: r.s for r in geo.coverage(regions, 0.0, 0.0, 1.0, 1.0).groupBy("region").agg(F.sum("weight").alias("s")).collect()}
    area = {r.region: r.area for r in geo.area_centroid(regions).collect()}
    assert cover == pytest.approx(area)
    cells = {(r.region, r.ix, r.iy) for r in geo.region_cells(regions, 0.0, 0.0, 1.0, 1.0).collect()}
    assert ("tiny", 30, 30) in cells and ("a", 0, 0) not in cells and ("a", 1, 0) not in cells and ("a", 1, 1) in cells


def test_coverage_of_several_parts(spark):
    ring = lambda x, y, s: square("", x, y, s)[1][0]
    parts = [
        ("two", [ring(0.25, 0.25, 2.0), ring(5.5, 5.5, 2.0), ring(9.2, 9.2, 0.5)]),
        ("island", [ring(0.3, 0.3, 8.0), ring(1.5, 1.5, 4.0)[::-1], ring(2.2, 2.2, 1.1), ring(12.4, 0.1, 0.5)]),
        ("touching", [ring(0.5, 0.5, 1.0), ring(1.5, 1.5, 1.0), [(3.0, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0), (3.0, 3.0)], [(3.0, 3.0), (5.5, 3.5), (3.5, 5.5), (3.0, 3.0)]]),
    ]
    cover = geo.coverage(spark.createDataFrame(parts, RINGS), 0.0, 0.0, 1.0, 1.0)
    got = {(r.region, r.ix, r.iy): r.weight for r in cover.collect()}
    total = {name: sum(w for (region, _, _), w in got.items() if region == name) for name, _ in parts}
    assert total == pytest.approx({"two": 4 + 4 + 0.25, "island": 64 - 16 + 1.21 + 0.25, "touching": 1 + 1 + 16 - 3})
    assert got["two", 5, 5] == pytest.approx(0.25) and got["two", 9, 9] == pytest.approx(0.25) and got["two", 6, 6] == 1
    assert got["island", 2, 2] == pytest.approx(0.64) and ("island", 4, 4) not in got and got["island", 12, 0] == pytest.approx(0.25)


def test_zonal(spark):
    px = spark.createDataFrame([(x, y, 3000.0 if y >= 1 else None, 1) for x in range(10) for y in range(10)], "ix long, iy long, v double, covered int")
    regions = spark.createDataFrame([("A", [[(0.0, 0.0), (5.0, 0.0), (5.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]), ("B", [[(5.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 10.0), (5.0, 0.0)]])], RINGS)
    out = zonal.zonal_stats(px, geo.coverage(regions, 0.0, 0.0, 1.0, 1.0), 100.0)
    for r in out.collect():
        assert (r.mean_yield_kg_ha, r.median_yield_kg_ha, r.total_area_ha, r.total_production_kg, r.coverage_pct) == (3000, 3000, 4500, 13500000, 100)
    assert zonal.coverage_warnings(out.withColumn("coverage_pct", F.lit(0.0))).count() == 2
    with pytest.raises(ValueError):
        zonal.extract_reference(px, "name", "v")
    r = one(zonal.region_totals(spark.createDataFrame([("a", None)], "region string, v double"), F.lit(1.0)))
    assert (r.mean_yield_kg_ha, r.total_area_ha, r.total_production_kg) == (0, None, 0)


def test_mosaic_and_coverage(spark):
    px = spark.createDataFrame([("a", 0, 0, None), ("a", 1, 0, 1.0), ("b", 0, 0, 5.0), ("b", 1, 0, 6.0), ("b", 2, 0, None)], "region string, ix int, iy int, v double")
    assert {(r.ix, r.iy): r.v for r in lai.mosaic(px, ["ix", "iy"], "v", "region").collect()} == {(0, 0): 5, (1, 0): 1, (2, 0): None}
    cells = spark.createDataFrame([(x, 0) for x in range(6)], "ix int, iy int")
    ext = spark.createDataFrame([(0, 1, 0, 0), (4, 4, 0, 3)], "ix_min int, ix_max int, iy_min int, iy_max int")
    assert [r.covered for r in zonal.coverage_mask(cells, ext, tile=2).orderBy("ix").collect()] == [1, 1, 0, 0, 1, 0]


def test_projections(spark):
    pts = spark.createDataFrame([(x, y) for x in (20.0, 30.5, 39.9) for y in (40.0, 48.3, 60.0)], "lon double, lat double")
    alb = (45.0, 55.0, 50.0, 30.0)
    for fwd, inv in ((geo.equal_area_cylinder, geo.equal_area_cylinder_inverse), (lambda a, b: geo.albers(a, b, *alb), lambda a, b: geo.albers_inverse(a, b, *alb))):
        x, y = fwd(F.col("lon"), F.col("lat"))
        p = pts.withColumns({"x": x, "y": y})
        a, b = inv(F.col("x"), F.col("y"))
        for r in p.select("lon", "lat", a.alias("a"), b.alias("b")).collect():
            assert (r.a, r.b) == pytest.approx((r.lon, r.lat), abs=1e-9)
    area = lambda lat: one(spark.range(1).select(geo.pixel_area(F.lit(0.0), F.lit(lat), 0.01, 0.01)))[0]
    assert 1.1e6 < area(0.0) < 1.4e6 and area(60.0) < 0.6 * area(0.0)
    x, y = geo.utm(F.lit(33.0), F.lit(49.0), 36)
    r = one(spark.range(1).select(x, y))
    assert r[0] == pytest.approx(500000, abs=1e-3) and r[1] == pytest.approx(5427235, abs=600)  # 0.9996 of the meridian arc
    grid = geo.target_grid(spark, (0.2, 0.2, 3.9, 1.8), 1.0, 1.0)
    assert grid.count() == 8
    src = spark.createDataFrame([(x, y, float(x + 10 * y)) for x in range(5) for y in range(5)], "ix int, iy int, v double")
    g = {"x0": 0.0, "y0": 0.0, "dx": 1.0, "dy": 1.0}
    assert {(r.ix, r.iy): r.v for r in geo.reproject_bilinear(grid, src, g).collect()} == {(r.ix, r.iy): r.v for r in geo.reproject_nearest(grid, src, g).collect()}


def test_grid_checks(spark):
    schema = "p string, x0 double, y0 double, dx double, dy double, rx double, ry double, crs string"
    a = spark.createDataFrame([("p", 0.0, 0.0, 1.0, 1.0, 0.0, 0.0, "c")], schema)
    ok = spark.createDataFrame([("p", 3.0, -2.0, 1.0, 1.0, 0.0, 0.0, "c")], schema)
    bad = spark.createDataFrame([("p", 0.5, 0.0, 1.0, 2.0, 0.1, 0.0, "d")], schema)
    assert checks.unaligned(a, ok, ["p"]).count() == 0
    assert one(checks.unaligned(a, bad, ["p"])).why == ["rotated", "system", "pixel size", "origin"]
    with pytest.raises(ValueError, match="grids"):
        checks.strict(checks.unaligned(a, bad, ["p"]), "grids")


# --- simulations and scenes


def test_duplicates(spark):
    s = "SimulationID int, ts string, lai double, yield double, total_wt double, ndvi double"
    df = spark.createDataFrame([(1, "a", 0.5, 3000.0, 100.0, 0.3), (1, "a", 0.5, 3000.0, 200.0, 0.3), (1, "a", 0.5, 3000.0, 300.0, 0.4), (2, "a", 0.1, 1.0, 1.0, 0.1), (2, "a", 0.1, 1.0, 1.0, 0.1)], s)
    got = {r.SimulationID: r.total_wt for r in simulation.resolve_duplicates(df, ["SimulationID", "ts"], "ndvi", "total_wt").collect()}
    assert got == {1: 200.0, 2: 1.0}
    bad = spark.createDataFrame([(1, "a", 0.5, 3000.0, 1.0, 0.1), (1, "a", 0.5, 4000.0, 1.0, 0.1)], s)
    with pytest.raises(Exception, match="differ"):
        simulation.resolve_duplicates(bad, ["SimulationID", "ts"], "ndvi", "total_wt").collect()
    assert one(simulation.conflicting_rows(bad, ["SimulationID", "ts"], ["ndvi", "total_wt"]))["columns"] == ["yield"]
    null = spark.createDataFrame([(1, "a", None, 1.0, 1.0, 0.1), (1, "a", 0.5, 1.0, 1.0, 0.1)], s)
    assert simulation.resolve_duplicates(null, ["SimulationID", "ts"], "ndvi", "total_wt", strict=False).count() == 0


def test_scenes(spark):
    ids = ["S2A_MSIL2A_20230501T101601_R065_T33UVR_20230501T170000", "S2A_MSIL2A_20230501T101601_R065_T33UVR_20230502T010000", "S2B_MSIL2A_20230501T103601_R022_T33UVR_20230501T180000"]
    df = dates.scene_fields(spark.createDataFrame([(i,) for i in ids], "id string"))
    assert {r.id for r in simulation.latest_scene(df).collect()} == {ids[1], ids[2]}
    assert {r.id for r in simulation.latest_scene(df, per_day=True).collect()} == {ids[1]}
    with pytest.raises(Exception, match="not a scene id"):
        dates.scene_fields(spark.createDataFrame([("nonsense",)], "id string")).collect()
    xml = "<a><Mean_Sun_Angle><ZENITH_ANGLE unit='deg'>30.5</ZENITH_ANGLE><AZIMUTH_ANGLE unit='deg'>150</AZIMUTH_ANGLE></Mean_Sun_Angle></a>"
    assert one(readers.granule_angles(spark.createDataFrame([(xml,)], "xml string"))).sun_zenith == 30.5
    with pytest.raises(Exception, match="degrees"):
        readers.granule_angles(spark.createDataFrame([(xml.replace("deg", "rad"),)], "xml string")).collect()


def test_network(spark):
    rng = np.random.default_rng(3)
    lists = [rng.normal(size=n).tolist() for n in (11, 11, 55, 5, 5, 1, 1, 1)]
    fields = [0.0] * 5
    for x in lists:
        fields += [float(len(x)), *x]
    w = pixels.read_weights(fields)
    bands = rng.integers(1, 9000, 11).tolist()
    df = spark.createDataFrame([tuple(bands), tuple([None] + bands[1:])], ", ".join(f"b{i} int" for i in range(11)))
    got = [r[0] for r in df.select(pixels.network([F.col(f"b{i}") for i in range(11)], w)).collect()]
    z = np.array(bands) * 1e-4 * np.array(lists[0]) + np.array(lists[1])
    want = (np.array(lists[4]) @ np.tanh(np.array(lists[2]).reshape(5, 11) @ z + lists[3]) + lists[5][0] - lists[7][0]) / lists[6][0]
    assert got[0] == pytest.approx(want) and got[1] is None
    with pytest.raises(ValueError):
        pixels.network([F.col("b0")], w)


# --- names, studies, files


def test_names(spark):
    df = spark.createDataFrame([("Naïve 'Région' N°1",), ("Łódź-x.y",), (None,)], "region string")
    assert {r.region: r.cleaned_name for r in names.with_clean_names(df).collect()}["Naïve 'Région' N°1"] == "naive_region_n_1"
    assert [r[0] for r in spark.createDataFrame([("2019",), ("2019.0",), ("x",)], "y string").select(names.normalize_year(F.col("y"))).collect()] == ["2019", "2019", "x"]
    assert tuple(one(spark.range(1).select(names.export_missing(F.lit(None).cast("double")), names.export_missing(F.lit(2.345), 2), names.kg_to_tons(F.lit(1234.0))))) == (-1, 2.34, 1.234)


def test_dates(spark):
    df = spark.createDataFrame([(day("2024-02-29"),), (day("2023-09-01"),)], "d date")
    got = [tuple(map(str, r)) for r in df.select(dates.plot_date(F.col("d"), F.lit(True)), dates.continuous_doy(F.col("d"), F.lit(True)), dates.to_year(F.col("d"), 2023)).collect()]
    assert got == [("2001-02-28", "425", "2023-02-28"), ("2000-09-01", "244", "2023-09-01")]
    assert one(spark.range(1).select(dates.snap_coordinate(F.lit(30.9), 0.625)))[0] == 30.625


def test_assembly(spark):
    est = spark.createDataFrame([("a", 5), ("b", 6)], "region string, kg long")
    fac = spark.createDataFrame([("a", 1.5)], "region string, f double")
    attrs = spark.createDataFrame([("a", "x")], "region string, zone string")
    r = one(studies.assemble_regions(est, fac, attrs=attrs, keep=["zone"], reference=fac))
    assert (r.region, r.zone, r.f_ref) == ("a", "x", 1.5)
    with pytest.raises(ValueError):
        studies.assemble_regions(est, fac, attrs=attrs, keep=["nothing"])
    daily = spark.createDataFrame([("r", 0, 20.0), ("r", 0, 50.0), ("r", 1, 100.0)], "region string, interpolated int, cloud_pct double")
    assert tuple(one(studies.valid_days(daily, ["region"]))) == ("r", 2, 35.0)
    assert checks.level_table_errors(est, "name", "kg", None, ["ok", "a b"]) == ["no column name", "column kg needs a year column", "level name 'a b' holds a colon or space"]


def test_window_checks(spark):
    wanted = studies.manifest(spark.createDataFrame([("r",)], "region string"), spark.createDataFrame([(2022,), (2023,)], "year int"), spark.createDataFrame([("T-0",)], "timepoint string"))
    win = spark.createDataFrame([(2022, "T-0", "2022-05-01", "2022-04-01")], "year int, timepoint string, a string, b string")
    got = {(r.year, r.error) for r in checks.window_errors(wanted.drop("region"), win, ["year", "timepoint"], [("a", "b")]).collect()}
    assert got == {(2022, "a is not before b"), (2023, "a or b is missing or no date")}


def test_geojson_and_csv(spark, tmp_path):
    doc = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"NAME":"a","centroid":"POINT (30.5 49.25)","year":2020},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"type":"Feature","properties":{"NAME":"m"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[2,0],[2,2],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}]}'
    (tmp_path / "r.geojson").write_text(doc)
    regions = readers.read_regions(spark, str(tmp_path / "r.geojson"), "NAME")
    got = {r.region: r for r in regions.collect()}
    assert got["a"].lon == 30.5 and got["a"].attrs["year"] == "2020" and len(got["m"].rings) == 2
    assert '"coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]]' in sinks.features(regions.select("region", "rings")).where(F.col("value").contains('"a"')).first().value
    (tmp_path / "x_LAI_STATS.csv").write_text("Date,n_pixels,interpolated\n05/03/2024,3,0\nnonsense,1,0\n")
    r = one(readers.read_region_csv(spark, str(tmp_path / "*_LAI_STATS.csv"), "`Date` string, n_pixels int, interpolated int"))
    assert (r.region, str(r.date)) == ("x", "2024-03-05")
    files = spark.createDataFrame([("/base/level/study1/2022/T-0/agg.csv",), ("nothing",)], "path string")
    assert tuple(one(readers.study_parts(files)))[1:] == ("level", "study1", "2022", "T-0")


def test_plan_prunes_columns_and_days(spark, tmp_path):
    df = spark.range(100).select(F.lit("lai").alias("product"), F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 5).cast("int")).alias("date"), F.col("id").cast("int").alias("ix"), F.lit(1).alias("iy"), F.rand().alias("v"))
    sinks.write_table(df, str(tmp_path / "px"), ["date"])
    plan = readers.scan_pixels(spark, str(tmp_path / "px"), "lai", "2024-01-02", "2024-01-03", (0, 50, 0, 3)).select("ix", "v")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(ix,0)" in plan


def test_area_and_features_of_nested_rings(spark):
    import json

    from fieldspark.operators.geo import area_centroid, polygon_parts
    from fieldspark.sources.sinks import features

    box = lambda x, y, n, turn=1: [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)][::turn]
    shape = "region string, rings array<array<struct<x: double, y: double>>>"
    rows = [
        ("hole wound like its shell", [box(0.0, 0.0, 4.0), box(1.0, 1.0, 2.0)]),
        ("hole first", [box(1.0, 1.0, 2.0, -1), box(0.0, 0.0, 4.0)]),
        ("two parts", [box(0.0, 0.0, 2.0), box(10.0, 0.0, 2.0, -1)]),
        ("island in a hole", [box(0.0, 0.0, 9.0), box(1.0, 1.0, 6.0), box(2.0, 2.0, 2.0)]),
    ]
    df = spark.createDataFrame(rows, shape)
    got = {r.region: (r.area, round(r.cx, 6), round(r.cy, 6)) for r in area_centroid(df).collect()}
    assert got["hole wound like its shell"] == got["hole first"] == (12.0, 2.0, 2.0)
    assert got["two parts"] == (8.0, 6.0, 1.0)
    x = (81 * 4.5 - 36 * 4 + 4 * 3) / 49
    assert got["island in a hole"] == (49.0, round(x, 6), round(x, 6))
    made = {f["properties"]["region"]: f["geometry"] for f in (json.loads(r.value) for r in features(df).collect())}
    assert made["hole first"]["type"] == "Polygon" and [len(r) for r in made["hole first"]["coordinates"]] == [5, 5] and made["hole first"]["coordinates"][0][1] == [4.0, 0.0]
    assert made["two parts"]["type"] == "MultiPolygon" and len(made["two parts"]["coordinates"]) == 2
    assert [len(p) for p in made["island in a hole"]["coordinates"]] == [2, 1]
    import numpy as np

    assert polygon_parts([np.array(r) for r in rows[3][1]]) == [[0, 1], [2]]
