"""Series by day: smoothing, gap filling, runs, spines.

Smoothing and curves work on whole series, a season or some decades of days: one gather brings the rows
of a series into arrays in their order, all columns are worked on there by higher-order functions, and
the rows are dealt out again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gathered(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """One row a series: keys, and every other column as an array in the order of order_by (the first of repeated rows first)."""
    others = [c for c in df.columns if c not in keys]
    entry = F.struct(F.col(order_by).alias("__o"), *[F.col(f"`{c}`") for c in others])
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("__rows"))
    column = lambda c: F.transform("__rows", lambda r: r[c]).alias(c)
    return rows.select(*keys, *[column(c) for c in others])


def dealt_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of gathered series; every column but keys is an array of the same length."""
    return df.select(*keys, F.inline(F.arrays_zip(*[f"`{c}`" for c in df.columns if c not in keys])))


def _numbers(n: str) -> str:
    """0, 1, ..., n - 1; empty for n < 1."""
    return f"IF({n} >= 1, sequence(0, {n} - 1), CAST(array() AS ARRAY<INT>))"


def _stretches(ends: str) -> str:
    """For each place from the first of ends to before the last: the number of the last end at or before it."""
    return f"flatten(transform({_numbers(f'(size({ends}) - 1)')}, k -> array_repeat(k, {ends}[k + 1] - {ends}[k])))"


def _stage(df: DataFrame, values: list[str], **columns: str) -> DataFrame:
    """Columns of text with {i} for the number of each value: text is put together at once, Columns piece by piece.

    Names in the text begin with __, unlike its variables, so a table's own names cannot be taken for these.
    """
    return df.withColumns({f"__{name}{i}": F.expr(text.format(i=i)) for i in range(len(values)) for name, text in columns.items()})


def _with_knots(df: DataFrame, values: list[str]) -> DataFrame:
    """For the i-th value __kp{i}, __ky{i}: places and values of what is there; __kn{i} how many; __ko{i}: the knot at or before each place from the first knot on."""
    df = df.withColumns({f"__v{i}": F.col(f"`{v}`") for i, v in enumerate(values)})
    df = _stage(df, values, kp=f"filter({_numbers('size(__v{i})')}, k -> __v{{i}}[k] IS NOT NULL)")
    return _stage(df, values, ky="transform(__kp{i}, k -> CAST(__v{i}[k] AS DOUBLE))", kn="size(__kp{i})", ko=_stretches("__kp{i}"))


#: Number of the last knot of the i-th value at or before place k, null before the first; from the last knot on its own.
_KNOT = "CASE WHEN __kn{i} > 0 THEN CASE WHEN k >= __kp{i}[__kn{i} - 1] THEN __kn{i} - 1 ELSE get(__ko{i}, k - __kp{i}[0]) END END"


def _tidy(df: DataFrame) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith("__")])


def hat_matrix(width: int, order: int = 2) -> list[list[float]]:
    """Rows give the values of the least-squares polynomial at each place of a window."""
    x = np.arange(width) - (width - 1) / 2
    a = np.vander(x, order + 1, increasing=True)
    return (a @ np.linalg.pinv(a)).tolist()


def smoothed(df: DataFrame, values: list[str], window: int = 9, order: int = 2) -> DataFrame:
    """savgol_smooth on gathered series."""
    widths = sorted({*range(4, window + 1)} - {x for x in range(6, window) if x % 2 == 0})
    matrix = lambda w: "array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in r) + ")" for r in hat_matrix(w, order)) + ")"
    df = _with_knots(df, values)
    # the largest odd width that fits, or 4
    df = _stage(df, values, w=f"least(IF(__kn{{i}} % 2 = 0, greatest(__kn{{i}} - 1, 4), __kn{{i}}), {window})")
    df = _stage(df, values, hat="CASE __w{i} " + " ".join(f"WHEN {w} THEN {matrix(w)}" for w in widths) + " END")
    start = "least(greatest(k - CAST(floor((__w{i} - 1) / 2) AS INT), 0), __kn{i} - __w{i})"
    fit = f"greatest(aggregate(zip_with(slice(__ky{{i}}, {start} + 1, __w{{i}}), __hat{{i}}[k - {start}], (a, b) -> a * b), 0D, (acc, x) -> acc + x), 0D)"
    df = _stage(df, values, fit=f"IF(__kn{{i}} >= 4, transform({_numbers('__kn{i}')}, k -> {fit}), __ky{{i}})")
    df = _stage(df, values, new=f"transform({_numbers('size(__v{i})')}, k -> IF(__v{{i}}[k] IS NOT NULL, get(__fit{{i}}, {_KNOT}), NULL))")
    return _tidy(df.withColumns({f"{v} Unsmoothed": F.col(f"`{v}`") for v in values} | {v: F.col(f"__new{i}") for i, v in enumerate(values)}))


def savgol_smooth(df: DataFrame, keys: list[str], order_by: str, values: list[str], window: int = 9, order: int = 2) -> DataFrame:
    """The window's polynomial over the valid values of each series, not below 0; `<value> Unsmoothed` keeps the input.

    Gaps are skipped, so a window spans valid values. Near the ends the first and last window count.
    The window shrinks to the largest odd number of valid values, 4 at least; shorter series stay as
    they are.
    """
    return dealt_out(smoothed(gathered(df, keys, order_by), values, window, order), keys)


def _filled(df: DataFrame, values: list[str], at: str, flag: str) -> DataFrame:
    """Gaps between knots filled by `at`, of the knot before q and the day x; flag is 1 in places where any value was."""
    gap = f"__v{{i}}[k] IS NULL AND {_KNOT} < __kn{{i}} - 1"
    # the knot as a variable of its own, as it stands in `at` many times
    curve = f"transform({_numbers('size(__v{i})')}, k -> IF({gap}, transform(array({_KNOT}), q -> transform(array(__t[k]), x -> {at})[0])[0], NULL))"
    df = _stage(df, values, c=curve)
    any_filled = " OR ".join(f"get(__c{i}, k) IS NOT NULL" for i in range(len(values)))
    whole = {v: F.expr(f"zip_with(CAST(__v{i} AS ARRAY<DOUBLE>), __c{i}, (a, b) -> coalesce(a, b))") for i, v in enumerate(values)}
    return _tidy(df.withColumns(whole | {flag: F.expr(f"transform({_numbers('size(__t)')}, k -> IF({any_filled}, 1, 0))")}))


def _with_days(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("__t", F.transform(day, lambda d: F.unix_date(d.cast("date")).cast("double")))


def akima_filled(df: DataFrame, day: str, values: list[str], flag: str = "interpolated") -> DataFrame:
    """akima_fill on gathered series."""
    df = _stage(_with_knots(_with_days(df, day), values), values, kt="transform(__kp{i}, k -> __t[k])")
    df = _stage(df, values, m=f"transform({_numbers('(__kn{i} - 1)')}, k -> try_divide(__ky{{i}}[k + 1] - __ky{{i}}[k], __kt{{i}}[k + 1] - __kt{{i}}[k]))")
    # one more slope at each end, in line with the two there, then another; one slope alone goes on
    df = _stage(df, values, l="2 * get(__m{i}, 0) - coalesce(get(__m{i}, 1), get(__m{i}, 0))", r="2 * get(__m{i}, __kn{i} - 2) - coalesce(get(__m{i}, __kn{i} - 3), get(__m{i}, __kn{i} - 2))")
    df = _stage(df, values, s="IF(__kn{i} > 1, concat(array(2 * __l{i} - get(__m{i}, 0), __l{i}), __m{i}, array(__r{i}, 2 * __r{i} - get(__m{i}, __kn{i} - 2))), NULL)")
    s = "__s{i}"
    df = _stage(df, values, b=f"IF(__kn{{i}} > 1, transform({_numbers('__kn{i}')}, k -> named_struct('w1', abs({s}[k + 3] - {s}[k + 2]), 'w2', abs({s}[k + 1] - {s}[k]), 'b', {s}[k + 1], 'c', {s}[k + 2])), NULL)")
    df = _stage(df, values, top="1e-9D * array_max(transform(__b{i}, x -> x.w1 + x.w2))")
    df = _stage(df, values, d="transform(__b{i}, x -> coalesce(IF(x.w1 + x.w2 <= __top{i}, (x.b + x.c) / 2, try_divide(x.w1 * x.b + x.w2 * x.c, x.w1 + x.w2)), 0D))")
    h = "(__kt{i}[q + 1] - __kt{i}[q])"
    cubic = f"(2 * u * u * u - 3 * u * u + 1) * __ky{{i}}[q] + (u * u * u - 2 * u * u + u) * {h} * __d{{i}}[q] + (3 * u * u - 2 * u * u * u) * __ky{{i}}[q + 1] + (u * u * u - u * u) * {h} * __d{{i}}[q + 1]"
    return _filled(df, values, f"transform(array(try_divide(x - __kt{{i}}[q], {h})), u -> greatest({cubic}, 0D))[0]", flag)


def akima_fill(df: DataFrame, keys: list[str], day: str, values: list[str], flag: str = "interpolated") -> DataFrame:
    """Gaps between valid values by Akima's cubic, not below 0; days outside the first and last stay missing.

    Two values: a straight line; one: none. flag is 1 on rows where any of the values was filled.
    """
    return dealt_out(akima_filled(gathered(df, keys, day), day, values, flag), keys)


def linear_fill(df: DataFrame, keys: list[str], order_by: str, values: list[str]) -> DataFrame:
    """Gaps by straight lines over row positions; before the first and after the last value its nearest."""
    w = Window.partitionBy(*keys).orderBy(order_by)
    df = df.withColumn("__i", F.row_number().over(w))
    for v in values:
        k = F.when(F.col(v).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(v).alias("y")))
        df = df.withColumn("__k", k)
        a = F.last("__k", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        b = F.first("__k", True).over(w.rowsBetween(0, Window.unboundedFollowing))
        df = df.withColumns({"__x": a, "__y": b})
        line = F.col("__x.y") + (F.col("__y.y") - F.col("__x.y")) * F.try_divide(F.col("__i") - F.col("__x.i"), F.col("__y.i") - F.col("__x.i"))
        df = df.withColumn(v, F.coalesce(v, line, "__x.y", "__y.y")).drop("__k", "__x", "__y")
    return df.drop("__i")


def date_runs(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Runs of consecutive days: keys, first_day, last_day, n_days. Repeated days count once."""
    days = df.select(*keys, F.col(day).cast("date").alias("__d")).distinct()
    w = Window.partitionBy(*keys).orderBy("__d")
    island = F.date_sub(F.col("__d"), F.row_number().over(w))
    return days.withColumn("__g", island).groupBy(*keys, "__g").agg(F.min("__d").alias("first_day"), F.max("__d").alias("last_day"), F.count(F.lit(1)).alias("n_days")).drop("__g")


def first_row(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """One row of each key, the first in this order."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def date_spine(bounds: DataFrame, first: str, last: str, day: str = "date") -> DataFrame:
    """A row for every day from first to last; other columns repeat."""
    others = [c for c in bounds.columns if c not in (first, last)]
    return bounds.select(*others, F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias(day))


def every_day(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """The rows of df and one with missing values for each day of a key's range that has none."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("__a"), F.max(day).alias("__b"))
    return date_spine(ends, "__a", "__b", day).join(df.withColumn(day, F.col(day).cast("date")), [*keys, day], "left")


def every_day_of(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """every_day on gathered series with each day once."""
    others = [c for c in df.columns if c not in (*keys, day)]
    df = df.withColumns({"__days": F.transform(day, lambda d: d.cast("date"))} | {f"__c{i}": F.col(f"`{c}`") for i, c in enumerate(others)})
    df = df.withColumn("__at", F.expr("transform(__days, d -> datediff(d, __days[0]))"))
    df = df.withColumn("__owner", F.expr(f"concat({_stretches('__at')}, array(size(__at) - 1))"))
    every = _numbers("size(__owner)")
    held = [F.expr(f"transform({every}, j -> IF(__at[__owner[j]] = j, __c{i}[__owner[j]], NULL))").alias(c) for i, c in enumerate(others)]
    return df.select(*keys, F.expr(f"transform({every}, j -> date_add(__days[0], j))").alias(day), *held)


def spline_filled(df: DataFrame, day: str, value: str, flag: str = "interpolated") -> DataFrame:
    """spline_fill on gathered series: the second derivatives by elimination forward and substitution back along the array."""
    df = _stage(_with_knots(_with_days(df, day), [value]), [value], kt="transform(__kp{i}, k -> __t[k])")
    df = df.withColumn("__h", F.expr(f"transform({_numbers('(__kn0 - 1)')}, k -> __kt0[k + 1] - __kt0[k])"))
    df = df.withColumn("__m", F.expr(f"transform({_numbers('(__kn0 - 1)')}, k -> (__ky0[k + 1] - __ky0[k]) / __h[k])"))
    # equation of inner knot i + 1, pieces a and b around it; the first and last take in that the outer two pieces are one cubic
    first, last, a, b = "i = 0", "i = __kn0 - 3", "__h[i]", "__h[i + 1]"
    row = f"""named_struct(
      'lo', CASE WHEN {first} THEN 0D WHEN {last} THEN {a} - {b} * {b} / {a} ELSE {a} END,
      'mid', 2 * ({a} + {b}) + IF({first}, {a} * ({a} + {b}) / {b}, 0D) + IF({last}, {b} * ({a} + {b}) / {a}, 0D),
      'hi', CASE WHEN {last} THEN 0D WHEN {first} THEN {b} - {a} * {a} / {b} ELSE {b} END,
      'r', 6 * (__m[i + 1] - __m[i]))"""
    pivot = "(e.mid - e.lo * element_at(done, -1).c)"
    forward = f"concat(done, array(named_struct('c', e.hi / {pivot}, 'r', (e.r - e.lo * element_at(done, -1).r) / {pivot})))"
    # an entry of zeros stands before the equations, so that every one has a row before it
    df = df.withColumn("__e", F.expr(f"IF(__kn0 >= 4, slice(aggregate(transform({_numbers('(__kn0 - 2)')}, i -> {row}), array(named_struct('c', 0D, 'r', 0D)), (done, e) -> {forward}), 2, __kn0 - 2), NULL)"))
    df = df.withColumn("__i", F.expr("aggregate(reverse(__e), CAST(array() AS ARRAY<DOUBLE>), (done, e) -> concat(array(e.r - e.c * coalesce(get(done, 0), 0D)), done))"))
    left = "((__h[0] + __h[1]) * __i[0] - __h[0] * __i[1]) / __h[1]"
    n = "__kn0"
    right = f"((__h[{n} - 3] + __h[{n} - 2]) * __i[{n} - 3] - __h[{n} - 2] * __i[{n} - 4]) / __h[{n} - 3]"
    df = df.withColumn("__s", F.expr(f"CASE WHEN {n} >= 4 THEN concat(array({left}), __i, array({right})) WHEN {n} = 3 THEN array_repeat(2 * (__m[1] - __m[0]) / (__h[0] + __h[1]), 3) ELSE array_repeat(0D, {n}) END"))
    d = "(x - __kt0[q])"
    cubic = f"__ky0[q] + {d} * (__m[q] - __h[q] * (2 * __s[q] + __s[q + 1]) / 6) + {d} * {d} * __s[q] / 2 + {d} * {d} * {d} * (__s[q + 1] - __s[q]) / (6 * __h[q])"
    return _filled(df, [value], cubic, flag)


def spline_fill(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Gaps by the cubic spline whose first and last two pieces are each one cubic; days outside the first and last value stay missing.

    Three values: a parabola, two: a line. Days must differ within a series.
    """
    return dealt_out(spline_filled(gathered(df, keys, day), day, value), keys)
