"""Dates and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snap_coordinate(c: Column, step: float, digits: int = 3) -> Column:
    """To the nearest grid line, halves to even."""
    return F.bround(F.bround(c / step) * step, digits)


def snap_down(c: Column, step: float) -> Column:
    """P30, lower bounds."""
    return F.floor(c / step) * step


def snap_up(c: Column, step: float) -> Column:
    """P30, upper bounds."""
    return F.ceil(c / step) * step


def to_year(d: Column, year: Column | int) -> Column:
    """The same day in another year; 29 February becomes the 28th where there is none."""
    target = F.lit(year) if isinstance(year, int) else year
    return F.add_months(d, 12 * (target - F.year(d)))


def is_cross_year(d: Column) -> Column:
    """P18, an aggregate: dates on both sides of New Year within one season."""
    return F.bool_or(F.month(d) >= 7) & F.bool_or(F.month(d) <= 6)


def plot_date(d: Column, cross_year: Column, base: int = 2000) -> Column:
    """Days on one reference season; January to June follow in the next year where it crosses."""
    return to_year(d, F.when(cross_year & (F.month(d) <= 6), base + 1).otherwise(base))


def continuous_doy(d: Column, cross_year: Column) -> Column:
    """P19."""
    return F.dayofyear(d) + F.when(cross_year & (F.month(d) <= 6), 365).otherwise(0)


def scene_fields(df: DataFrame, item_id: str = "id") -> DataFrame:
    """Satellite, sensing time, orbit, tile and processing time out of a scene id; an id of another form is an error."""
    c = F.col(item_id)
    good = c.rlike(r"^S2[A-Z]_MSI\w+_\d{8}T\d{6}_(N\d+_)?R\d{3}_T\w{5}_\d{8}T\d{6}$")
    checked = F.when(good, c).otherwise(F.raise_error(F.concat(F.lit("not a scene id: "), F.coalesce(c, F.lit("null")))))
    part = F.split(checked, "_")
    at = lambda i: F.element_at(part, i)
    stamp = lambda x: F.to_timestamp(x, "yyyyMMdd'T'HHmmss")
    return df.withColumns({"satellite": at(1), "sensed": stamp(at(3)), "orbit": at(-3), "tile": at(-2), "processed": stamp(at(-1))})
