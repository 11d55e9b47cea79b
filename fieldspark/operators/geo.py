"""Geometry on DataFrames.

A polygon is `rings array<array<struct<x,y>>>`; edges of all its rings stand in one array, and the
even-odd rule takes care of holes. Point-in-polygon is an equi-join on coarse cells that know whether
their corner is inside, so a point meets the edges of its own cell only; coverage adds up signed areas
along the edges. All in built-in functions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.session import materialize

#: Sphere with the surface of the reference ellipsoid, and the ellipsoid itself.
RADIUS, WGS84_A, WGS84_F = 6371007.1809, 6378137.0, 1 / 298.257223563


def _ring_edges(r: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.struct(r[i - 1].x.alias("x1"), r[i - 1].y.alias("y1"), r[i].x.alias("x2"), r[i].y.alias("y2")))


def _twice_area(r: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0.0), lambda acc, i: acc + r[i - 1].x * r[i].y - r[i].x * r[i - 1].y)


def _good_rings(rings: Column | str) -> Column:
    """without rings of fewer than four points or without area."""
    return F.filter(rings, lambda r: (F.size(r) >= 4) & (F.when(F.size(r) >= 4, _twice_area(r)).otherwise(0.0) != 0))


def with_edges(regions: DataFrame, rings: str = "rings") -> DataFrame:
    """Edges and bounding box of each polygon; F17: rings of fewer than four points or no area are left out."""
    df = regions.withColumn("edges", F.flatten(F.transform(_good_rings(rings), _ring_edges))).where(F.size("edges") > 0)
    low, high = (lambda c: F.array_min(F.transform("edges", lambda e: e[c])), lambda c: F.array_max(F.transform("edges", lambda e: e[c])))
    return df.withColumns({"xmin": low("x1"), "ymin": low("y1"), "xmax": high("x1"), "ymax": high("y1")})


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: an odd number of edges lies to the right."""
    crossed = lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < e.x1 + F.try_divide((y - e.y1) * (e.x2 - e.x1), e.y2 - e.y1))
    return F.size(F.filter(edges, crossed)) % 2 == 1


def turned_rings(regions: DataFrame, rings: str = "rings") -> DataFrame:
    """regions with `turned`: of each good ring its edges, its unsigned area and 1 for outlines, -1 for holes, whatever their order and direction.

    A ring within an even number of larger ones is an outline. Rings of a region may touch but not cross,
    so one point inside a ring (halfway between its two leftmost edges, just above its lowest corner) tells.
    """

    def ring(r: Column) -> Column:
        edges, ys = _ring_edges(r), F.array_sort(F.array_distinct(F.transform(r, lambda p: p.y)))
        return F.struct(edges.alias("edges"), F.abs(_twice_area(r) / 2).alias("area"), F.signum(_twice_area(r)).alias("turn"), ((ys[0] + ys[1]) / 2).alias("py"))

    def point(r: Column) -> Column:
        crossed = F.filter(r.edges, lambda e: (e.y1 > r.py) != (e.y2 > r.py))
        xs = F.array_sort(F.transform(crossed, lambda e: e.x1 + (r.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)))
        return F.struct(r.edges.alias("edges"), r.area.alias("area"), r.turn.alias("turn"), r.py.alias("py"), ((xs[0] + xs[1]) / 2).alias("px"))

    df = regions.withColumn("__rings", F.transform(_good_rings(rings), ring)).where(F.size("__rings") > 0)
    df = df.withColumn("__rings", F.transform("__rings", point))
    around = lambda a: F.size(F.filter("__rings", lambda b: (b.area > a.area) & inside(b.edges, a.px, a.py)))
    side = lambda a: F.when(around(a) % 2 == 0, F.lit(1.0)).otherwise(-1.0)
    return df.withColumn("turned", F.transform("__rings", lambda a: F.struct(a.edges.alias("edges"), a.area.alias("area"), a.turn.alias("turn"), side(a).alias("side")))).drop("__rings")


def edge_index(regions: DataFrame, grid: float, keep: list[str]) -> DataFrame:
    """keep, cx, cy, edges, odd: the coarse cells of each polygon, each with the edges that reach it and whether its lower right corner is inside.

    Cells in the inside have no edges; cells outside are not there. Edges are dealt to the cells they reach
    row by row; where they cross the lower side of a row, the crossings to the right of a corner are
    counted by a running sum along the row.
    """
    key = [F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)]
    names = [f"__k{i}" for i in range(len(keep))]
    e = with_edges(regions).withColumn("__region", F.monotonically_increasing_id()).select("__region", *key, F.explode("edges").alias("e"))
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    margin = 1e-9 * grid  # an edge too many does no harm
    e = e.withColumn("cy", F.explode(F.sequence(F.floor((low - margin) / grid), F.floor((high + margin) / grid))))
    at = lambda y: F.col("e.x1") + (y - F.col("e.y1")) * (F.col("e.x2") - F.col("e.x1")) / (F.col("e.y2") - F.col("e.y1"))
    flat = F.col("e.y1") == F.col("e.y2")
    xa = F.when(flat, F.col("e.x1")).otherwise(at(F.greatest(low, F.least(high, F.col("cy") * grid))))
    xb = F.when(flat, F.col("e.x2")).otherwise(at(F.least(high, F.greatest(low, (F.col("cy") + 1) * grid))))
    reach = F.transform(F.sequence(F.floor((F.least(xa, xb) - margin) / grid), F.floor((F.greatest(xa, xb) + margin) / grid)), lambda c: F.struct(c.alias("cx"), F.lit(0).alias("n"), F.col("e").alias("edge")))
    foot = F.col("cy") * grid
    spans = (F.col("e.y1") > foot) != (F.col("e.y2") > foot)
    # counts for the corners (cx + 1) * grid that are left of the crossing
    crossing = F.struct((F.ceil(F.when(spans, at(foot)) / grid) - 2).alias("cx"), F.lit(1).alias("n"), F.when(F.lit(False), F.col("e")).alias("edge"))
    entries = e.withColumn("entry", F.explode(F.when(spans, F.array_append(reach, crossing)).otherwise(reach)))
    cells = entries.groupBy("__region", *names, "cy", "entry.cx").agg(F.sum("entry.n").alias("n"), F.collect_list("entry.edge").alias("edges"))
    row = Window.partitionBy("__region", "cy").orderBy(F.desc("cx"))
    right = F.sum("n").over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumns({"odd": right % 2 == 1, "left": F.lead("cx").over(row)})
    # cells between two entries have the corner of the right one
    first = F.when(F.col("odd") & F.col("left").isNotNull(), F.col("left") + 1).otherwise(F.col("cx"))
    cells = cells.where((F.size("edges") > 0) | F.col("odd")).withColumn("cell", F.explode(F.sequence(first, F.col("cx"))))
    edges = F.when(F.col("cell") == F.col("cx"), F.col("edges")).otherwise(F.slice("edges", 1, 0))
    return cells.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("cell").alias("cx"), "cy", edges.alias("edges"), "odd")


def inside_cell(edges: Column, odd: Column, x: Column, y: Column, right: Column, foot: Column) -> Column:
    """Even-odd rule from a cell's corner (right, foot): up its right side to the point's height, then left to the point."""
    left_of = lambda e: F.try_divide((y - e.y1) * (e.x2 - e.x1), e.y2 - e.y1) + e.x1
    across = F.filter(edges, lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < left_of(e)) & (left_of(e) <= right))
    above = lambda e: F.try_divide((right - e.x1) * (e.y2 - e.y1), e.x2 - e.x1) + e.y1
    # at the height where it meets the side, a rising edge is not yet right of it, a falling one no longer
    rises = lambda e: (e.x1 < e.x2) == (e.y1 < e.y2)
    passed = lambda e: F.when(rises(e) & (e.y1 != e.y2), (above(e) < foot) != (above(e) < y)).otherwise((above(e) > foot) != (above(e) > y))
    up = F.filter(edges, lambda e: ((e.x1 > right) != (e.x2 > right)) & passed(e))
    return (F.size(across) + F.size(up) + odd.cast("int")) % 2 == 1


def points_in_polygons(points: DataFrame, regions: DataFrame, grid: float, x: str = "x", y: str = "y", how: str = "inner", keep: list[str] | None = None) -> DataFrame:
    """Points with the attributes of the polygons around them.

    grid is the side of the coarse cells: a point tests only the edges that reach its cell, and none in
    cells that lie inside, so choose it near an edge's length. The join is an equi-join: Spark broadcasts
    the cells only if they are small.
    """
    keep = keep or [c for c in regions.columns if c not in ("rings", "edges", "xmin", "xmax", "ymin", "ymax")]
    r = edge_index(regions, grid, keep)
    r = r.select(*[F.col(c).alias(f"__r_{c}") for c in keep], "edges", "odd", F.col("cx").alias("__rx"), F.col("cy").alias("__ry"))
    p = points.withColumns({"__cx": F.floor(F.col(x) / grid), "__cy": F.floor(F.col(y) / grid)})
    hit = inside_cell(F.col("edges"), F.col("odd"), F.col(x), F.col(y), (F.col("__cx") + 1) * grid, F.col("__cy") * grid)
    return p.join(r, (F.col("__cx") == F.col("__rx")) & (F.col("__cy") == F.col("__ry")) & hit, how).select(*points.columns, *[F.col(f"__r_{c}").alias(c) for c in keep])


def _on_raster(regions: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """region and its edges, one a row, in columns and rows of a raster: u1, v1, u2, v2."""
    e = with_edges(regions).select("region", F.explode("edges").alias("e"))
    u, v = (lambda c: (F.col(c) - x0) / dx), (lambda c: (F.col(c) - y0) / dy)
    return e.select("region", u("e.x1").alias("u1"), v("e.y1").alias("v1"), u("e.x2").alias("u2"), v("e.y2").alias("v2"))


def _u_at(v: Column) -> Column:
    return F.col("u1") + (v - F.col("v1")) * (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))


def region_cells(regions: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """J7 on a raster: (region, ix, iy) of the cells whose centre lies inside; of regions without any, all cells they touch.

    Every edge is cut by the lines through the centres of the rows it spans; between the first and second,
    third and fourth, ... cut of a line its centres are inside. Only cells inside are made.
    """
    e = _on_raster(regions, x0, y0, dx, dy)
    low, high = F.least("v1", "v2"), F.greatest("v1", "v2")
    rows = e.withColumns({"first": F.ceil(low - 0.5), "last": F.ceil(high - 0.5) - 1}).where("first <= last").withColumn("iy", F.explode(F.sequence("first", "last")))
    cuts = rows.select("region", "iy", (F.ceil(_u_at(F.col("iy") + 0.5) - 0.5) - 1).alias("ix"))  # the last centre left of the cut
    line = Window.partitionBy("region", "iy").orderBy(F.desc("ix"))
    runs = cuts.withColumns({"odd": F.row_number().over(line) % 2 == 1, "left": F.lead("ix").over(line)}).where(F.col("odd") & (F.col("left") < F.col("ix")))
    centre = runs.select("region", F.explode(F.sequence(F.col("left") + 1, F.col("ix"))).alias("ix"), "iy")
    small = e.join(centre.select("region").distinct(), "region", "left_anti")
    small = small.withColumn("iy", F.explode(F.sequence(F.floor(low), F.floor(high))))
    flat = F.col("v1") == F.col("v2")
    a = F.when(flat, F.col("u1")).otherwise(_u_at(F.greatest(low, F.least(high, F.col("iy").cast("double")))))
    b = F.when(flat, F.col("u2")).otherwise(_u_at(F.least(high, F.greatest(low, F.col("iy") + 1.0))))
    touched = small.select("region", F.explode(F.sequence(F.floor(F.least(a, b)), F.floor(F.greatest(a, b)))).alias("ix"), "iy").distinct()
    return centre.unionByName(touched)


def ring_signs(rings: list[np.ndarray]) -> list[int]:
    """1 for outlines, -1 for holes, whatever their order and direction: rings (n x 2) in an even number of others are outlines.

    Rings may touch but not cross, so most midpoints of a ring's edges tell whether it lies in another.
    """
    middles = [(r[1:] + r[:-1]) / 2 for r in rings]
    out = []
    for i, m in enumerate(middles):
        depth = 0
        for j, r in enumerate(rings):
            if i == j or len(m) == 0 or len(r) < 4 or (rings[i].min(axis=0) < r.min(axis=0)).any() or (rings[i].max(axis=0) > r.max(axis=0)).any():
                continue
            (x1, y1), (x2, y2) = r[:-1].T, r[1:].T
            within = 0
            for x, y in m:
                at = np.flatnonzero((y1 > y) != (y2 > y))
                within += int((x < x1[at] + (y - y1[at]) * (x2[at] - x1[at]) / (y2[at] - y1[at])).sum()) % 2
            depth += 2 * within > len(m)
        out.append(-1 if depth % 2 else 1)
    return out


def coverage(regions: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """(region, ix, iy, weight) with the share of each cell that the polygon covers, cells without any left out.

    Every edge is cut at the rows and columns it crosses; a piece adds its signed height, and the signed
    area between it and the right side of its cell, to that cell. Heights added up along a row of cells
    give the share of what lies right of them, so only cells with an edge are made and summed, and the
    cells between them come as whole runs. A region may have several parts, holes, and parts within
    holes, which may touch but not cross. Shares are exact to nine digits.
    """
    r = turned_rings(regions).select("region", F.explode("turned").alias("ring"))
    sign = -F.col("ring.turn") * F.col("ring.side") * (1.0 if dx * dy > 0 else -1.0)
    u, v = (lambda c: (F.col(c) - x0) / dx), (lambda c: (F.col(c) - y0) / dy)
    e = r.select("region", sign.alias("sign"), F.explode("ring.edges").alias("e")).select("region", "sign", u("e.x1").alias("u1"), v("e.y1").alias("v1"), u("e.x2").alias("u2"), v("e.y2").alias("v2")).where("v1 <> v2")
    low, high = F.least("v1", "v2"), F.greatest("v1", "v2")
    e = e.withColumn("iy", F.explode(F.sequence(F.floor(low), F.ceil(high) - 1)))
    foot, head = F.greatest(low, F.col("iy").cast("double")), F.least(high, F.col("iy") + 1.0)
    e = e.select("region", "iy", ((head - foot) * F.signum(F.col("v2") - F.col("v1")) * F.col("sign")).alias("height"), _u_at(foot).alias("a"), _u_at(head).alias("b"))
    left, right = F.least("a", "b"), F.greatest("a", "b")
    e = e.withColumn("ix", F.explode(F.sequence(F.floor(left), F.greatest(F.floor(left), F.ceil(right) - 1))))
    begin, end = F.greatest(left, F.col("ix").cast("double")), F.least(right, F.col("ix") + 1.0)
    part = F.col("height") * F.coalesce(F.try_divide(end - begin, right - left), F.lit(1.0))
    cells = e.groupBy("region", "iy", "ix").agg(F.sum(part).alias("height"), F.sum(part * (F.col("ix") + 1 - (begin + end) / 2)).alias("area"))
    row = Window.partitionBy("region", "iy").orderBy("ix")
    before = F.coalesce(F.sum("height").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    cells = cells.select("region", "iy", "ix", (before + F.col("area")).alias("share"), (before + F.col("height")).alias("rest"), F.lead("ix").over(row).alias("next"))
    last = F.when((F.col("rest") > 1e-9) & F.col("next").isNotNull(), F.col("next") - 1).otherwise(F.col("ix"))
    cells = cells.withColumn("cell", F.explode(F.sequence(F.col("ix"), last)))
    share = F.round(F.least(F.when(F.col("cell") == F.col("ix"), F.col("share")).otherwise(F.col("rest")), F.lit(1.0)), 9)
    return cells.select("region", F.col("cell").alias("ix"), "iy", share.alias("weight")).where("weight > 0")


def area_centroid(regions: DataFrame) -> DataFrame:
    """Area and centroid by sums over the edges (in an equal-area system).

    A ring counts by its own unsigned area, added or subtracted by how rings are nested, so neither the
    order nor the direction of outlines and holes matters.
    """
    around = lambda ring, f: F.aggregate(ring.edges, F.lit(0.0), lambda acc, e: acc + f(e) * (e.x1 * e.y2 - e.x2 * e.y1))
    part = lambda r: F.struct((r.side * r.area).alias("a"), (r.side * r.turn * around(r, lambda e: e.x1 + e.x2)).alias("x"), (r.side * r.turn * around(r, lambda e: e.y1 + e.y2)).alias("y"))
    r = turned_rings(regions).withColumn("parts", F.transform("turned", part))
    total = lambda c: F.aggregate("parts", F.lit(0.0), lambda acc, x: acc + x[c])
    return r.select(*[c for c in regions.columns if c != "rings"], total("a").alias("area"), F.try_divide(total("x"), 6 * total("a")).alias("cx"), F.try_divide(total("y"), 6 * total("a")).alias("cy"))


def polygon_parts(rings: list[np.ndarray]) -> list[list[int]]:
    """Numbers of the rings of each part: its outline, then the holes that lie in it and in no smaller outline."""
    signs = ring_signs(rings)
    box = [(*r.min(axis=0), *r.max(axis=0)) for r in rings]
    size = [abs(float(r[:-1, 0] @ r[1:, 1] - r[1:, 0] @ r[:-1, 1])) for r in rings]
    parts = {i: [i] for i, s in enumerate(signs) if s > 0}
    for i, s in enumerate(signs):
        if s < 0:
            around = [j for j in parts if box[j][0] <= box[i][0] and box[j][1] <= box[i][1] and box[j][2] >= box[i][2] and box[j][3] >= box[i][3] and ring_signs([rings[j], rings[i]])[1] < 0]
            parts[min(around, key=size.__getitem__)].append(i)
    return list(parts.values())


def _parts(column: pa.Array) -> pa.Array:
    found = [polygon_parts([np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2) for ring in rings or [] if ring]) for rings in column.to_pylist()]
    return pa.array(found, pa.list_(pa.list_(pa.int32())))


def parts_of(rings: Column) -> Column:
    """array<array<int>>: the rings of each part of a region, outlines first; empty rings do not count."""
    return F.arrow_udf(_parts, "array<array<int>>")(rings)


def cell_index(v: Column, origin: float, step: float) -> Column:
    """Index of the cell that holds a coordinate."""
    return F.floor((v - origin) / step).cast("int")


def sample_nearest(points: DataFrame, pixels: DataFrame, grid: dict[str, float], x: str = "x", y: str = "y") -> DataFrame:
    """Points with the value of the cell they lie in, missing outside the raster."""
    p = points.withColumns({"ix": cell_index(F.col(x), grid["x0"], grid["dx"]), "iy": cell_index(F.col(y), grid["y0"], grid["dy"])})
    return p.join(pixels, ["ix", "iy"], "left")


def target_grid(spark, bounds: tuple[float, float, float, float], dx: float, dy: float) -> DataFrame:
    """Cells (ix, iy, x, y centre) of a grid snapped outward to its steps; rows are dealt out, columns made within."""
    left, bottom, right, top = math.floor(bounds[0] / dx) * dx, math.floor(bounds[1] / dy) * dy, math.ceil(bounds[2] / dx) * dx, math.ceil(bounds[3] / dy) * dy
    n_x, n_y = round((right - left) / dx), round((top - bottom) / dy)
    rows = spark.range(n_y).select(F.col("id").cast("int").alias("iy")).withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(n_x - 1))))
    return rows.withColumns({"x": left + (F.col("ix") + 0.5) * dx, "y": bottom + (F.col("iy") + 0.5) * dy})


def reproject_nearest(target: DataFrame, pixels: DataFrame, grid: dict[str, float], inverse=None) -> DataFrame:
    """Each target cell's centre, taken back to the source system, picks the source cell it falls in."""
    sx, sy = inverse(F.col("x"), F.col("y")) if inverse else (F.col("x"), F.col("y"))
    t = target.withColumns({"sx": cell_index(sx, grid["x0"], grid["dx"]), "sy": cell_index(sy, grid["y0"], grid["dy"])})
    src = pixels.select(F.col("ix").alias("sx"), F.col("iy").alias("sy"), "v")
    return t.join(src, ["sx", "sy"], "left").select("ix", "iy", "v")


def reproject_bilinear(target: DataFrame, pixels: DataFrame, grid: dict[str, float], inverse=None) -> DataFrame:
    """Weighted mean of the four source cells around a target centre, missing ones left out of both sums."""
    sx, sy = inverse(F.col("x"), F.col("y")) if inverse else (F.col("x"), F.col("y"))
    fx, fy = (sx - grid["x0"]) / grid["dx"] - 0.5, (sy - grid["y0"]) / grid["dy"] - 0.5
    t = target.withColumns({"fx": fx, "fy": fy})
    corner = lambda i, j: F.struct((F.floor("fx") + i).cast("int").alias("sx"), (F.floor("fy") + j).cast("int").alias("sy"), (F.abs(1 - i - (F.col("fx") - F.floor("fx"))) * F.abs(1 - j - (F.col("fy") - F.floor("fy")))).alias("w"))
    t = t.withColumn("c", F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)]))).select("ix", "iy", "c.*").where("w > 0")
    src = pixels.where(F.col("v").isNotNull()).select(F.col("ix").alias("sx"), F.col("iy").alias("sy"), "v")
    found = t.join(src, ["sx", "sy"]).groupBy("ix", "iy").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))
    return target.select("ix", "iy").join(found, ["ix", "iy"], "left")


_BOX = ["xmin", "ymin", "xmax", "ymax"]
#: Names of equal rectangles that are kept together, and those, on average, that one task gathers at a time at
#: most; hashes of rectangles of a size that are told apart for that; copies of names, by tiles, broadcast at most.
TOGETHER, GATHERED, HASHES, BROADCAST_NAMES = 256, 8192, 65_536, 8_000_000
#: Names of a task: pairs are many times as many, and where they are written as Parquet, a file's names fit its
#: dictionary (1 MB), without which they take three times the space.
TASK_NAMES = 65_536


def _equal_boxes(df: DataFrame) -> tuple[DataFrame, list[int]]:
    """names, level and box of the rectangles that have an area, and their levels; equal ones share rows of TOGETHER names.

    Rows are shuffled once. Counts by level and hash of the rectangle, few whatever the number of rectangles,
    tell beforehand where there are too many for one task; there they are dealt by name, too.
    """
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    keys = {"level": (F.ceil(F.log2(side)) - 2).cast("int"), "hash": F.pmod(F.xxhash64(*_BOX), F.lit(HASHES)).cast("int")}
    df = df.select("name", *_BOX).where("xmin < xmax AND ymin < ymax").withColumns(keys)
    counts = materialize(df.groupBy("level", "hash").agg(F.count(F.lit(1)).alias("n")), "box-counts")
    levels = {r["level"]: r["n"] for r in counts.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    many = counts.where(F.col("n") > GATHERED).select("level", "hash", F.ceil(F.col("n") / GATHERED).alias("parts"))
    part = F.pmod(F.xxhash64("name"), F.coalesce("parts", F.lit(1))).cast("int")
    df = df.join(F.broadcast(many), ["level", "hash"], "left").select("name", *_BOX, "level", part.alias("part"))
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, sum(levels.values()) // TASK_NAMES + 1)
    unnamed = F.array_repeat(F.lit(None).cast(df.schema["name"].dataType), F.count_if(F.col("name").isNull()).cast("int"))
    rows = df.repartition(tasks, *_BOX, "part").groupBy(*_BOX, "part").agg(F.concat(F.collect_list("name"), unnamed).alias("all"), F.first("level").alias("level"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(TOGETHER))
    return rows.select(F.explode(F.transform(starts, lambda i: F.slice("all", i, TOGETHER))).alias("names"), *_BOX, "level"), sorted(levels)


def _tiles(df: DataFrame, others: list[int]) -> DataFrame:
    """Rectangles on the tiles they touch: of the others' levels above their own, and of their own if some other is not above it."""
    tile = lambda c, level: F.floor(F.col(c) / F.pow(F.lit(2.0), level))
    above = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > F.col("level"))
    own = F.when(F.col("level") >= min(others, default=0), F.array("level")).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("on", F.explode(F.concat(own, above)))
    span = lambda a, b: F.sequence(tile(a, F.col("on")), tile(b, F.col("on")))
    return df.withColumn("tx", F.explode(span("xmin", "xmax"))).withColumn("ty", F.explode(span("ymin", "ymax")))


def overlaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of extents (name, xmin, ymin, xmax, ymax) that share an area.

    Equal rectangles are compared once, and their pairs of names written out at the end, 256 by 256. Both
    sides go to tiles of a quarter of their longer side (25 at most) and to those of the other side's larger
    sizes, and meet by an equi-join on the tiles of the larger one's size; a pair counts only in the tile that
    holds the lower left corner of what they share. Missing or empty extents meet nothing.
    """
    # powers of two between the least and the greatest side: few, whatever the number of rectangles
    (a, of_a), (b, of_b) = _equal_boxes(a), _equal_boxes(b)
    b = _tiles(materialize(b, "boxes"), of_a).select("on", "tx", "ty", *[F.col(c).alias(f"b_{c}") for c in ("names", *_BOX, "level")])
    if (b.agg(F.sum(F.size("b_names")).alias("n")).first()["n"] or 0) <= BROADCAST_NAMES:
        b = F.broadcast(b)
    met = _tiles(a, of_b).join(b, ["on", "tx", "ty"]).where(F.col("on") == F.greatest("level", "b_level"))
    left, low = F.greatest("xmin", "b_xmin"), F.greatest("ymin", "b_ymin")
    here = lambda v, t: F.floor(v / F.pow(F.lit(2.0), F.col("on"))) == F.col(t)
    met = met.where((left < F.least("xmax", "b_xmax")) & (low < F.least("ymax", "b_ymax")) & here(left, "tx") & here(low, "ty"))
    return met.select(F.explode("names").alias("name"), "b_names").select("name", F.explode("b_names").alias("b_name"))


def union_extent(grids: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Extent of all rasters, and whether their resolutions agree."""
    spread = lambda c: F.max(c) - F.min(c)
    return grids.groupBy(*(keys or [])).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), ((spread("dx") <= 1e-10) & (spread("dy") <= 1e-10)).alias("same_resolution"))


def in_bounds(lon: Column, lat: Column, version: int) -> Column:
    """precipitation products reach to 50 degrees north and south, from version 3 to 60."""
    limit = 50 if version == 2 else 60
    return lat.between(-limit, limit) & lon.between(-180, 180)


def box_in_box(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """(xmin, ymin, xmax, ymax) of a lies within b."""
    return (a[0] >= b[0]) & (a[1] >= b[1]) & (a[2] <= b[2]) & (a[3] <= b[3])


def equal_area_cylinder(lon: Column, lat: Column, parallel: float = 0.0) -> tuple[Column, Column]:
    """Cylindrical equal-area projection on the sphere of equal surface, metres."""
    k = math.cos(math.radians(parallel))
    return RADIUS * k * F.radians(lon), RADIUS / k * F.sin(F.radians(lat))


def equal_area_cylinder_inverse(x: Column, y: Column, parallel: float = 0.0) -> tuple[Column, Column]:
    k = math.cos(math.radians(parallel))
    return F.degrees(x / (RADIUS * k)), F.degrees(F.asin(y * (k / RADIUS)))


def albers(lon: Column, lat: Column, lat1: float, lat2: float, lat0: float, lon0: float) -> tuple[Column, Column]:
    """Albers equal-area conic on the sphere of equal surface, metres."""
    s1, s2 = math.sin(math.radians(lat1)), math.sin(math.radians(lat2))
    n = (s1 + s2) / 2
    c = math.cos(math.radians(lat1)) ** 2 + 2 * n * s1
    rho = RADIUS / n * F.sqrt(c - 2 * n * F.sin(F.radians(lat)))
    rho0 = RADIUS / n * math.sqrt(c - 2 * n * math.sin(math.radians(lat0)))
    theta = n * F.radians(lon - lon0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, lat1: float, lat2: float, lat0: float, lon0: float) -> tuple[Column, Column]:
    s1, s2 = math.sin(math.radians(lat1)), math.sin(math.radians(lat2))
    n = (s1 + s2) / 2
    c = math.cos(math.radians(lat1)) ** 2 + 2 * n * s1
    rho0 = RADIUS / n * math.sqrt(c - 2 * n * math.sin(math.radians(lat0)))
    dy = rho0 - y
    rho2 = x * x + dy * dy
    return lon0 + F.degrees(F.atan2(x, dy)) / n, F.degrees(F.asin((c - rho2 * (n / RADIUS) ** 2) / (2 * n)))


def utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Transverse Mercator of a UTM zone, north; series of Snyder's working manual, metres."""
    e2 = WGS84_F * (2 - WGS84_F)
    ep2 = e2 / (1 - e2)
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    n = WGS84_A / F.sqrt(1 - e2 * F.sin(phi) ** 2)
    t, c, a = F.tan(phi) ** 2, ep2 * F.cos(phi) ** 2, lam * F.cos(phi)
    m = WGS84_A * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi)
        - (35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    x = 0.9996 * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * a**5 / 120) + 500000
    y = 0.9996 * (m + n * F.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * a**6 / 720))
    return x, y


def pixel_area(lon: Column, lat: Column, width: Column | float, height: Column | float) -> Column:
    """Square metres of a pixel given in degrees, from its projected corners."""
    x1, y1 = equal_area_cylinder(lon, lat)
    x2, y2 = equal_area_cylinder(lon + width, lat + height)
    return F.abs((x2 - x1) * (y2 - y1))


_Z_BITS = 31


def z_code(ix: Column, iy: Column) -> Column:
    """Bits of column and row interleaved, so that cells near one another have codes near one another; both within 2^30 of 0."""

    def spread(v: Column) -> Column:
        v = v.cast("long") + F.lit(1 << _Z_BITS - 1)
        for shift in (16, 8, 4, 2, 1):
            keep = sum((1 << shift) - 1 << at for at in range(0, 64, 2 * shift)) & (1 << 63) - 1
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(keep))
        return v

    return spread(ix).bitwiseOR(F.shiftleft(spread(iy), 1))


def z_ranges(window: tuple[int, int, int, int], most: int = 64) -> list[tuple[int, int]]:
    """Ranges of codes that hold all cells of a window (ix_min, ix_max, iy_min, iy_max), ends included; at most `most`, so they may hold others too."""
    x0, x1, y0, y1 = (v + (1 << _Z_BITS - 1) for v in window)
    if x0 > x1 or y0 > y1:
        return []
    whole, open_squares = [], [(_Z_BITS, 0, 0, 0)]  # bits of the side, its code, its corner
    while open_squares and len(whole) + len(open_squares) + 3 <= most:
        bits, code, x, y = open_squares.pop(0)
        side = 1 << bits - 1
        for k in range(4):
            cx, cy, c = x + (k & 1) * side, y + (k >> 1) * side, code + k * side * side
            if cx > x1 or cy > y1 or cx + side <= x0 or cy + side <= y0:
                continue
            inside = cx >= x0 and cy >= y0 and cx + side - 1 <= x1 and cy + side - 1 <= y1
            whole.append((c, c + side * side - 1)) if inside or bits == 1 else open_squares.append((bits - 1, c, cx, cy))
    ranges, out = sorted(whole + [(c, c + (1 << 2 * b) - 1) for b, c, _, _ in open_squares]), []
    for a, b in ranges:
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
