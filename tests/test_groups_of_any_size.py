"""Medians of hot groups, boxes of all sizes, the ledger of days, and outputs that are there, against plain versions."""

import datetime as dt
import random
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import evaluate, geo, lai, selection, weather, zonal
from fieldspark.session import shared_folder
from fieldspark.streaming import ledger


def hot_rows():
    rng = random.Random(3)
    rows = [("hot", rng.lognormvariate(0, 4) * rng.choice([1, -1])) for _ in range(4000)] + [("hot", 2.5)] * 700 + [("hot", None)] * 50
    rows += [("flat", 7.0)] * 900 + [("two", 1.0), ("two", 4.0)] * 300 + [("wide", x) for x in (-1e300, 1e300, 1e-300, 0.0, 5.0, 6.0)] * 60
    rows += [(None, float(i)) for i in range(501)] + [("one", 3.0), ("none", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small,bins", [(selection.SMALL, selection.BINS), (20, 16), (1, 2)])
def test_medians_of_any_group(spark, small, bins, monkeypatch):
    monkeypatch.setattr(selection, "select_by_weight", lambda v, k, t, s, _f=selection.select_by_weight: _f(v, k, t, s, bins))
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: (r.m, r.n) for r in selection.medians(df, ["k"], {"m": F.col("v"), "n": -F.col("v")}, small).collect()}
    for k in {k for k, _ in rows} - {"none"}:
        m = statistics.median(v for x, v in rows if x == k and v is not None)
        assert got[k] == (pytest.approx(m), pytest.approx(-m))
    assert "none" not in got


@pytest.mark.parametrize("small", [selection.SMALL, 30, 1])
def test_weighted_median_of_one_group(spark, small):
    rng = random.Random(9)
    rows = [("nation", rng.choice([rng.random() * 1000, float(rng.randrange(20))]), float(rng.randrange(0, 5))) for _ in range(3000)]
    rows += [("b", 1.0, 50.0), ("b", 3.0, 50.0), ("c", 1.0, 10.0), ("c", 3.0, 90.0), ("d", 2.0, None), ("d", None, 4.0), (None, 5.0, 1.0)]
    got = {r.k: r.weighted_median for r in evaluate.weighted_median(spark.createDataFrame(rows, "k string, v double, w double"), ["k"], "v", "w", small=small).collect()}
    total, cum = sum(w for k, _, w in rows if k == "nation"), 0.0
    for v, w in sorted((v, w) for k, v, w in rows if k == "nation"):
        cum += w
        if cum >= total / 2:
            break
    assert got == {"nation": v, "b": 1.0, "c": 3.0, None: 5.0}


@pytest.mark.parametrize("small", [selection.SMALL, 8])
def test_weighted_median_at_exactly_half(spark, small):
    rng, rows = random.Random(12), []
    for g in range(300):
        lower = [(1 + rng.randrange(9) / 100 * 37) / 7 for _ in range(21)]
        upper = rng.sample(lower, 21)  # the other half of the weight, added up in another order
        rows += [(g, float(i), w) for i, w in enumerate(lower + upper)]
    rng.shuffle(rows)
    got = evaluate.weighted_median(spark.createDataFrame(rows, "k int, v double, w double"), ["k"], "v", "w", small=small).collect()
    assert {r.k: r.weighted_median for r in got} == {g: 20.0 for g in range(300)}


def test_daily_stats_are_the_same_for_hot_regions(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), "2024-01-0%d" % rng.randrange(1, 4), rng.choice([None, -1.0, round(rng.random() * 8, 2)]), rng.randrange(2)) for _ in range(2000)]
    cells = spark.createDataFrame(rows, "region string, date string, v double, m int")
    for crop in (None, "maize"):
        whole, refined = (lai.daily_stats(cells, ["region", "date"], crop, small=s) for s in (10_000, 25))
        assert whole.columns == refined.columns
        a, b = ({(r.region, r.date): tuple(r) for r in x.collect()} for x in (whole, refined))
        assert a.keys() == b.keys() and all(b[k] == pytest.approx(v, nan_ok=True) for k, v in a.items())


def test_masked_stats_are_those_of_every_mask_cell(spark):
    rng = random.Random(11)
    px = spark.createDataFrame([(d, x, y, rng.choice([None, -2.0, rng.random() * 6])) for d in ("d1", "d2") for x in range(12) for y in range(12) if rng.random() < 0.8], "date string, ix int, iy int, v double")
    mask = spark.createDataFrame([(r, x, y, rng.randrange(2)) for r, a in (("a", 0), ("b", 5), ("far", 40)) for x in range(a, a + 9) for y in range(9)], "region string, ix int, iy int, m int")
    every = mask.crossJoin(px.select("date").distinct()).join(px, ["date", "ix", "iy"], "left").where("m = 1")
    want = {(r.region, r.date): r for r in lai.daily_stats(every, ["region", "date"], "wheat").collect()}
    for small in (selection.SMALL, 10):
        got = {(r.region, r.date): r for r in lai.daily_stats_on_mask(px, mask, "wheat", small=small).collect()}
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert all(r[c] == pytest.approx(want[k][c]) for c in (*lai.STATS, "n_pixels")), k


def test_boxes_of_all_sizes_meet_once(spark):
    rng = random.Random(4)

    def box(name):
        x, y, w, h = rng.uniform(-50, 50), rng.uniform(-50, 50), 10 ** rng.uniform(-3, 2), 10 ** rng.uniform(-3, 2)
        return (name, x, y, x + w, y + h)

    a = [box(i) for i in range(150)] + [(900, 0.0, 0.0, 8.0, 8.0), (901, 0.0, 0.0, 0.0, 5.0), (902, None, 0.0, 1.0, 1.0)]
    b = [box(i) for i in range(120)] + [(900, 8.0, 0.0, 16.0, 8.0), (901, -4.0, -4.0, 4.0, 4.0), (902, 2.0, 2.0, 3.0, 3.0), (902, 2.0, 2.0, 3.0, 3.0)]
    schema = "name int, xmin double, ymin double, xmax double, ymax double"
    met = geo.overlaps(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
    want = sorted((p[0], q[0]) for p in a if p[1] is not None for q in b if max(p[1], q[1]) < min(p[3], q[3]) and max(p[2], q[2]) < min(p[4], q[4]))
    assert sorted(map(tuple, met.collect())) == want
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = spark.createDataFrame([], schema)
    assert geo.overlaps(none, none).count() == 0


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_ranges_that_are_missing(spark):
    rng = random.Random(6)
    make = lambda n: [(rng.choice(["a", "b", None]), day(s), day(s + rng.randrange(-1, 9))) for s in (rng.randrange(60) for _ in range(n))]
    wanted, done = make(25), make(12)
    schema = "k string, first date, last date"
    got = ledger.missing_ranges(spark.createDataFrame(wanted, schema), spark.createDataFrame(done, schema), ["k"]).collect()
    days = lambda rows: {(k, d) for k, a, b in rows for d in (a + dt.timedelta(days=i) for i in range((b - a).days + 1))}
    want = days(wanted) - days(done)
    assert days(map(tuple, got)) == want and sum((b - a).days + 1 for _, a, b in got) == len(want)
    ends = {(k, b + dt.timedelta(days=1)) for k, _, b in got}
    assert not ends & want  # ranges are as long as can be


def test_days_are_folded_once(spark):
    at, landed = (f"{shared_folder(spark)}/test-{uuid.uuid4().hex}" for _ in range(2))
    rows = [(k, c, day(i), float(i * (c + 1) % 17)) for k in ("a", "b") for c in range(3) for i in range(30)]
    px = spark.createDataFrame(rows, "k string, c int, date date, v double")
    px.write.partitionBy("date").parquet(landed)
    pixels = spark.read.schema(px.schema).parquet(landed)
    ranges = lambda *r: spark.createDataFrame([(k, day(a), day(b)) for k, a, b in r], "k string, first date, last date")
    batches = [ranges(("a", 5, 9)), ranges(("a", 3, 12), ("a", 8, 14), ("b", 0, 2)), ranges(("a", 3, 12), ("b", 1, 4))]
    done = set()
    for number, wanted in ((0, batches[0]), (1, batches[1]), (1, batches[1]), (2, batches[2]), (2, batches[2])):
        fresh = ledger.fold_ranges(pixels, wanted, at, number, ["k"], ["c"]).collect()
        if number == 1:
            assert {(r.k, r["first"], r["last"]) for r in fresh} == {("a", day(3), day(4)), ("a", day(10), day(14)), ("b", day(0), day(2))}
        done |= {(r.k, r["first"] + dt.timedelta(days=i)) for r in fresh for i in range((r["last"] - r["first"]).days + 1)}
    got = {(r.k, r.c): (r.max_lai, r.n_pixels) for r in ledger.folded(spark, at).collect()}
    want = {(k, c): [v for x, y, d, v in rows if (x, y) == (k, c) and (k, d) in done] for k in ("a", "b") for c in range(3)}
    assert got == {k: (max(v), len(v)) for k, v in want.items()}
    assert len(done) == 12 + 5


def test_existing_output_wins(spark):
    grids = spark.createDataFrame([("p2", "utm", 0.0, 0.0, 10.0, 1.0, 10), ("p1", "utm", 0.0, 0.0, 30.0, 1.0, 10), ("p0", "geo", 0.0, 0.0, 1.0, 1.0, 10)], "product string, crs string, xmin double, ymin double, xmax double, ymax double, width int")
    same = lambda x, y: (x, y)
    there = spark.createDataFrame([("b", "z", 5.0), ("a", "albers", -20.0)], "path string, crs string, dx double")
    assert zonal.target_resolution(grids, same).collect() == [("utm", 3.0)]
    assert zonal.target_resolution(grids, same, there.limit(0)).collect() == [("utm", 3.0)]
    assert zonal.target_resolution(grids, same, there).collect() == [("albers", 20.0)]
    assert zonal.target_resolution(grids.limit(0), same, there).collect() == [("albers", 20.0)]
    with pytest.raises(Exception, match="reference system"):
        zonal.target_resolution(grids, same, spark.createDataFrame([("a", None, 5.0)], there.schema)).collect()


def test_last_years_hold_no_key_in_one_task(spark):
    rows = [(k, dt.date(y, m, 28), y * 100 + m) for k in ("a", None) for y in (2019, 2020, 2021) for m in (2, 8)] + [("b", None, 1), ("c", dt.date(2000, 2, 29), 2)]
    got = weather.last_years(spark.createDataFrame(rows, "k string, day date, n int"), ["k"], "day", 1)
    assert got.columns == ["k", "day", "n"]
    want = [(k, y * 100 + m) for k in ("a", None) for y, m in ((2020, 8), (2021, 2), (2021, 8))] + [("c", 2)]
    assert sorted(((r.k, r.n) for r in got.collect()), key=str) == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_plot_dates_are_not_gathered_by_key(spark):
    rows = [("a", dt.date(2020, 2, 29), 1.0), ("a", dt.date(2020, 9, 1), 2.0), ("a", dt.date(2020, 9, 1), 4.0), ("b", dt.date(2021, 3, 1), 5.0), (None, dt.date(2021, 3, 1), 6.0)]
    got = lai.means_by_plot_date(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", "v")
    want = {("a", 2020, dt.date(2001, 2, 28), 1.0), ("a", 2020, dt.date(2000, 9, 1), 3.0), ("b", 2021, dt.date(2000, 3, 1), 5.0)}
    assert {(r.k, r.year, r.plot_date, r.v) for r in got.collect()} == want
    from fieldspark.plans.registry import all_queries

    for df in (got, all_queries()["plot_dates"](spark, "/root/testdata/sf0.001")):
        assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_equal_boxes_are_compared_once(spark, monkeypatch):
    tiled = []
    monkeypatch.setattr(geo, "_tiles", lambda df, levels, _f=geo._tiles: tiled.append(_f(df, levels)) or tiled[-1])
    schema = "name int, xmin double, ymin double, xmax double, ymax double"
    a = [(i, 0.0, 0.0, 1.0, 1.0) for i in range(600)] + [(None, 0.0, 0.0, 1.0, 1.0), (9000, 5.0, 5.0, 6.0, 6.0)]
    b = [(i, 0.5, -0.0, 3.0, 0.5) for i in range(300)] + [(None, 0.5, 0.0, 3.0, 0.5), (9001, 0.9, 0.9, 5.1, 5.1), (9002, 0.0, 2.0, 3.0, 2.0)]
    got = geo.overlaps(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
    names = [i for i, *_ in a if i != 9000]
    want = [(i, j) for i in names for j in [*range(300), None, 9001]] + [(9000, 9001)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert all(x.count() < 300 for x in tiled)


def test_rows_of_equal_boxes_are_shuffled_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(geo, "materialize", lambda df, name, _f=geo.materialize: stored.append(df) or _f(df, name))
    monkeypatch.setattr(geo, "GATHERED", 50, raising=False)
    monkeypatch.setattr(geo, "TASK_NAMES", 50, raising=False)
    schema = "name int, xmin double, ymin double, xmax double, ymax double"
    a = [(12 * i + k, float(k), 0.0, k + 1.5, 1.0) for i in range(40) for k in range(12)] + [(1000 + i, 2.0, 0.0, 2.5, 4.0) for i in range(700)] + [(None, 2.0, 0.0, 2.5, 4.0)] * 3
    b = [(3 * i + k, 4.0 * k, 0.5, 4.0 * k + 3, 2.0) for i in range(300) for k in range(3)] + [(None, 0.0, 0.5, 3.0, 2.0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where boxes that occur often are many themselves
    try:
        got = geo.overlaps(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
        pairs = got.collect()
        assert got.rdd.getNumPartitions() > len(a) // 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [(p[0], q[0]) for p in a for q in b if max(p[1], q[1]) < min(p[3], q[3]) and max(p[2], q[2]) < min(p[4], q[4])]
    assert sorted(map(tuple, pairs), key=str) == sorted(want, key=str)
    assert all("SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString() for df in (*stored, got))
    assert sum("names" in df.columns for df in stored) == 1  # of the two sides only the one that is broadcast is stored
