"""Checks of data (Q2-Q8, Q10, Q13, Q15): each gives its violations; strict() turns any into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strict(violations: DataFrame, what: str) -> None:
    """An error with the first few violations, if there are any."""
    found = violations.take(5)
    if found:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def interior_gaps(held: DataFrame, wanted: DataFrame, day: str, keys: list[str]) -> DataFrame:
    """Q2: wanted days that are missing before the last held one (missing at the end is allowed)."""
    last = held.groupBy(*keys).agg(F.max(day).alias("__last"))
    gaps = wanted.join(held.select(*keys, day), [*keys, day], "left_anti")
    return gaps.join(last, keys).where(F.col(day) < F.col("__last")).drop("__last") if keys else gaps.crossJoin(last).where(F.col(day) < F.col("__last")).drop("__last")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q3."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def mixed_grids(grids: DataFrame, keys: list[str], tolerance: float = 1e-10) -> DataFrame:
    """Q4: products whose rasters differ in system or resolution."""
    spread = lambda c: F.max(c) - F.min(c)
    return grids.groupBy(*keys).agg(F.countDistinct("crs").alias("n_crs"), spread("dx").alias("dx_spread"), spread("dy").alias("dy_spread")).where((F.col("n_crs") > 1) | (F.col("dx_spread") > tolerance) | (F.col("dy_spread") > tolerance))


def unaligned(a: DataFrame, b: DataFrame, on: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Q5: pairs of grids with rotation, unequal pixels or origins that are not whole pixels apart.

    a and b hold x0, y0, dx, dy, rx, ry, crs for each key.
    """
    names = ("x0", "y0", "dx", "dy", "rx", "ry", "crs")
    j = a.join(b.select(*on, *[F.col(c).alias(f"b_{c}") for c in names]), on)
    off = lambda o, d: F.abs(F.try_divide(F.col(f"b_{o}") - F.col(o), F.col(d)) - F.round(F.try_divide(F.col(f"b_{o}") - F.col(o), F.col(d)))) > tolerance
    rules = {
        "rotated": (F.col("rx") != 0) | (F.col("ry") != 0) | (F.col("b_rx") != 0) | (F.col("b_ry") != 0),
        "system": F.col("crs") != F.col("b_crs"),
        "pixel size": (F.abs(F.col("dx") - F.col("b_dx")) > tolerance * F.abs("dx")) | (F.abs(F.col("dy") - F.col("b_dy")) > tolerance * F.abs("dy")),
        "origin": off("x0", "dx") | off("y0", "dy"),
    }
    why = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return j.select(*on, why.alias("why")).where(F.size("why") > 0)


def window_errors(wanted: DataFrame, windows: DataFrame, on: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Q6: missing, unreadable or reversed date windows of the combinations wanted."""
    j = wanted.join(windows, on, "left")

    def wrong(a: str, b: str) -> Column:
        x, y = F.try_to_date(F.col(a).cast("string")), F.try_to_date(F.col(b).cast("string"))
        return F.when(x.isNull() | y.isNull(), F.lit(f"{a} or {b} is missing or no date")).when(x >= y, F.lit(f"{a} is not before {b}"))

    why = F.filter(F.array(*[wrong(a, b) for a, b in pairs]), lambda x: x.isNotNull())
    return j.select(*on, F.explode(why).alias("error"))


def several_studies(pred: DataFrame) -> DataFrame:
    """Q8."""
    return pred.groupBy("year", "timepoint", "level").agg(F.countDistinct("study_id").alias("n_studies")).where("n_studies > 1")


def missing_products(files: DataFrame, wanted_days: DataFrame, versions: DataFrame) -> DataFrame:
    """Q10: (product, version, date) wanted and not there."""
    return wanted_days.crossJoin(versions).join(files.select("product", "version", "date").distinct(), ["product", "version", "date"], "left_anti")


def level_table_errors(df: DataFrame, name: str, reference: str | None, year: str | None, levels: list[str]) -> list[str]:
    """Q13: what is wrong with a level's table and the levels' names, by schema alone."""
    kinds = dict(df.dtypes)
    out = [f"no column {name}"] if name not in kinds else []
    if reference:
        if not str(kinds.get(reference, "")).startswith(("double", "float", "int", "bigint", "decimal", "smallint")):
            out.append(f"column {reference} is missing or not numeric")
        if not year or year not in kinds:
            out.append(f"column {reference} needs a year column")
    return out + [f"level name {x!r} holds a colon or space" for x in levels if ":" in x or " " in x]


def complete_regions(products: DataFrame, names: list[str] | DataFrame) -> DataFrame:
    """Q15: regions that have every one of these products (a list or a table with column product); semi-join with it."""
    if isinstance(names, list):
        return products.where(F.col("product").isin(names)).groupBy("region").agg(F.countDistinct("product").alias("n")).where(F.col("n") == len(set(names))).select("region")
    wanted = names.select("product").distinct()
    have = products.join(wanted, "product", "left_semi").groupBy("region").agg(F.countDistinct("product").alias("n"))
    return have.join(wanted.agg(F.count(F.lit(1)).alias("n")), "n").select("region")


def days_between_rows(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Days since the row before, to look for gaps."""
    w = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn("gap_days", F.datediff(day, F.lag(day).over(w)))


def level_errors(columns: DataFrame, levels: DataFrame) -> DataFrame:
    """Q13 over many levels: (level, error) of levels(level, name_column, reference_column, year_column) whose tables have columns(level, column, kind).

    A level needs its name column; a reference column must be there, numeric, and have a year column that is
    there too; a level's name may hold neither colon nor space.
    """
    held = columns.groupBy("level").agg(F.map_from_entries(F.collect_set(F.struct("column", "kind"))).alias("__held"))
    df = levels.join(held, "level", "left").withColumn("__held", F.coalesce("__held", F.create_map().cast("map<string,string>")))
    kind = lambda c: F.when(F.col(c).isNotNull(), F.try_element_at("__held", F.col(c)))
    numeric = kind("reference_column").rlike("^(double|float|int|bigint|smallint|tinyint|decimal)")
    found = [
        F.when(F.col("level").rlike("[: ]"), F.lit("level name holds a colon or space")),
        F.when(F.col("name_column").isNull(), F.lit("no name column is set")),
        F.when(F.col("name_column").isNotNull() & kind("name_column").isNull(), F.concat(F.lit("no column "), "name_column")),
        F.when(F.col("reference_column").isNotNull() & ~F.coalesce(numeric, F.lit(False)), F.concat(F.lit("column "), "reference_column", F.lit(" is missing or not numeric"))),
        F.when(F.col("reference_column").isNotNull() & kind("year_column").isNull(), F.concat(F.lit("column "), "reference_column", F.lit(" needs a year column"))),
    ]
    return df.select("level", F.explode(F.array_compact(F.array(*found))).alias("error"))
