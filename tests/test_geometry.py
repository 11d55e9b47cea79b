"""Coverage and point-in-polygon against brute force: holes, parts, islands in holes, shapes on grid lines, rasters upside down."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import geo

RINGS = "region string, rings array<array<struct<x: double, y: double>>>"


def star(rng, cx, cy, r, n, turned=False):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    points = [(cx + f * math.cos(a), cy + f * math.sin(a)) for a, f in ((a, r * rng.uniform(0.6, 1)) for a in angles)]
    points = points + points[:1]
    return points[::-1] if turned else points


def box(x, y, w, h, turned=False):
    points = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return points[::-1] if turned else points


def shapes():
    rng = random.Random(8)
    out = [(f"star{i}", [star(rng, rng.uniform(-3, 8), rng.uniform(-3, 8), rng.uniform(0.5, 7), 40, i % 2)]) for i in range(6)]
    out.append(("ring", [star(rng, 3, 3, 2, 30), star(rng, 3, 3, 8, 60, True), star(rng, 3, 3, 0.9, 20)]))
    out.append(("grid", [box(-4.0, -2.0, 6.0, 4.0), box(-2.0, -1.0, 2.0, 2.0, True), box(4.0, -2.0, 2.0, 2.0)]))
    out.append(("comb", [[(0.0, 0.0), (9.0, 0.0), (9.0, 1.0), (8.0, 7.0), (7.0, 1.0), (6.0, 7.0), (5.0, 1.0), (4.0, 7.0), (3.0, 1.0), (2.0, 7.0), (1.0, 1.0), (0.0, 7.0), (0.0, 0.0)]]))
    out.append(("sliver", [[(-5.0, 4.999), (12.0, 5.001), (12.0, 5.0015), (-5.0, 4.9995), (-5.0, 4.999)]]))
    out.append(("speck", [box(20.31, 20.32, 0.05, 0.04)]))
    out.append(("none", [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)], [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]))
    return out


def area_in(ring, xa, ya, xb, yb):
    """Unsigned area of a ring in a rectangle, by cutting it at each side."""
    points = ring[:-1]
    for axis, bound, sign in ((0, xa, 1), (0, xb, -1), (1, ya, 1), (1, yb, -1)):
        kept = []
        for p, q in zip(points, points[1:] + points[:1]):
            a, b = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if a >= 0:
                kept.append(p)
            if (a >= 0) != (b >= 0):
                kept.append((p[0] + a / (a - b) * (q[0] - p[0]), p[1] + a / (a - b) * (q[1] - p[1])))
        points = kept
        if not points:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1]))) / 2



def signs_of(name, rings):
    if name == "ring":
        return [-1, 1, 1]
    if name == "grid":
        return [1, -1, 1]
    return [1] * len(rings)


@pytest.mark.parametrize("x0,y0,dx,dy", [(0.0, 0.0, 1.0, 1.0), (-10.25, 21.0, 0.75, -0.5), (0.0, 0.0, 2.0, 2.0)])
def test_coverage_is_the_clipped_area(spark, x0, y0, dx, dy):
    rows = shapes()
    got = {(r.region, r.ix, r.iy): r.weight for r in geo.coverage(spark.createDataFrame(rows, RINGS).repartition(2), x0, y0, dx, dy).collect()}
    want = {}
    for name, rings in rows[:-1]:
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        ix = sorted(((min(xs) - x0) / dx, (max(xs) - x0) / dx))
        iy = sorted(((min(ys) - y0) / dy, (max(ys) - y0) / dy))
        for i in range(math.floor(ix[0]), math.ceil(ix[1]) + 1):
            for j in range(math.floor(iy[0]), math.ceil(iy[1]) + 1):
                a, b = sorted((y0 + j * dy, y0 + (j + 1) * dy))
                share = sum(s * area_in(r, x0 + i * dx, a, x0 + (i + 1) * dx, b) for s, r in zip(signs_of(name, rings), rings)) / abs(dx * dy)
                if share > 1e-8:
                    want[name, i, j] = share
    assert {k for k, v in got.items() if v > 1e-8} == set(want)
    assert all(got[k] == pytest.approx(v, abs=2e-9) for k, v in want.items())


def in_rings(rings, x, y):
    n = 0
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            n += (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
    return n % 2 == 1


@pytest.mark.parametrize("grid", [0.5, 2.0, 7.3, 100.0])
def test_points_meet_their_cell_only(spark, grid):
    rng = random.Random(5)
    rows = shapes()
    points = [(i, rng.uniform(-6, 13), rng.uniform(-6, 13)) for i in range(1500)]
    points += [(2000 + i, float(x), float(y)) for i, (x, y) in enumerate((x / 2, y / 2) for x in range(-10, 26) for y in range(-10, 20))]
    pts = spark.createDataFrame(points, "id long, x double, y double").repartition(2)
    got = Counter((r.id, r.region) for r in geo.points_in_polygons(pts, spark.createDataFrame(rows, RINGS), grid).collect())
    want = Counter((i, name) for i, x, y in points for name, rings in rows[:-1] if in_rings(rings, x, y))
    assert got == want


def test_edges_a_point_tests_are_bounded(spark):
    """A polygon of 20000 edges: no cell has more than its own few, and inner cells have none."""
    ring = [(50 + 40 * math.cos(a), 50 + 40 * math.sin(a)) for a in (2 * math.pi * i / 20000 for i in range(20000))]
    index = geo.edge_index(spark.createDataFrame([("disc", [ring + ring[:1]])], RINGS), 0.25, ["region"])
    r = index.agg(F.max(F.size("edges")).alias("most"), F.count_if(F.size("edges") == 0).alias("inner"), F.count_if(F.col("odd") & (F.size("edges") == 0)).alias("odd")).first()
    assert r.most <= 70 and r.inner == r.odd and abs(r.inner / 16 - math.pi * 1600) < 120


@pytest.mark.parametrize("dy", [1.0, -1.0])
def test_cells_by_their_centres(spark, dy):
    rows = shapes()
    got = {(r.region, r.ix, r.iy) for r in geo.region_cells(spark.createDataFrame(rows, RINGS), -0.3, 0.1, 1.0, dy).collect()}
    for name, rings in rows[:-1]:
        want = {(name, i, j) for i in range(-10, 25) for j in range(-25, 25) if in_rings(rings, -0.3 + i + 0.5, 0.1 + (j + 0.5) * dy)}
        mine = {k for k in got if k[0] == name}
        if want:
            assert mine == want
        else:
            assert mine and all(any(area_in(r, -0.3 + i, 0.1 + min(j * dy, (j + 1) * dy), 0.7 + i, 0.1 + max(j * dy, (j + 1) * dy)) > 0 for r in rings) for _, i, j in mine)
    assert not any(k[0] == "none" for k in got)


def test_plans_stay_in_built_in_functions(spark):
    regions = spark.createDataFrame(shapes(), RINGS)
    pts = spark.range(10).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    for df in (geo.coverage(regions, 0.0, 0.0, 1.0, 1.0), geo.area_centroid(regions), geo.points_in_polygons(pts, regions, 1.0), geo.region_cells(regions, 0.0, 0.0, 1.0, 1.0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))


def scanned_rows(df):
    """Rows that the scan of a DataFrame gave out, after row groups and pages were left out."""
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_windows_read_few_pixels(spark):
    import uuid

    from fieldspark.session import shared_folder
    from fieldspark.sources import readers, sinks

    at = f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"
    side = 400
    px = spark.range(side * side).select(F.lit("R").alias("product"), F.lit("2024-01-01").cast("date").alias("date"), (F.col("id") % side - 150).cast("int").alias("ix"), (F.floor(F.col("id") / side) - 90).cast("int").alias("iy"), F.col("id").cast("double").alias("v"))
    sinks.write_pixels(px.repartition(5), at, ["product"], files=6, page_rows=500)
    for window in ((-20, 20, -20, 20), (100, 140, 200, 210), (-150, 249, 0, 0), (5, 4, 0, 9), (-1, 0, -1, 0)):
        found = readers.scan_pixels(spark, at, "R", "2023-01-01", "2025-01-01", window)
        want = {(x, y) for x in range(window[0], window[1] + 1) for y in range(window[2], window[3] + 1)}
        assert sorted((r.ix, r.iy) for r in found.collect()) == sorted(want) and "z" not in found.columns
    for window in ((-20, 20, -20, 20), (100, 140, 200, 210)):
        found = readers.scan_pixels(spark, at, "R", "2023-01-01", "2025-01-01", window)
        assert scanned_rows(found) <= 12_000  # of 160000


def test_z_codes_and_ranges(spark):
    rng = random.Random(2)
    cells = [(rng.randrange(-(1 << 30), 1 << 30), rng.randrange(-(1 << 30), 1 << 30)) for _ in range(50)] + [(0, 0), (-1, -1), (-(1 << 30), (1 << 30) - 1)]
    got = {(r.x, r.y): r.z for r in spark.createDataFrame(cells, "x long, y long").withColumn("z", geo.z_code(F.col("x"), F.col("y"))).collect()}
    code = lambda x, y: sum((((x + (1 << 30)) >> b & 1) << 2 * b) | (((y + (1 << 30)) >> b & 1) << 2 * b + 1) for b in range(31))
    assert got == {c: code(*c) for c in cells}
    for window in ((3, 17, -9, 4), (0, 0, 0, 0), (-300, 1000, 5, 2000)):
        for most in (8, 64, 400):
            ranges = geo.z_ranges(window, most)
            assert len(ranges) <= most and all(a <= b for a, b in ranges) and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
            for x in range(window[0], window[1] + 1, 7):
                for y in range(window[2], window[3] + 1, 7):
                    assert any(a <= code(x, y) <= b for a, b in ranges)
    assert geo.z_ranges((4, 3, 0, 1)) == []
