"""Studies and their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_observation(interpolated: str = "interpolated", cloud: str = "cloud_pct") -> Column:
    """F13."""
    return (F.col(interpolated) == 0) & (F.col(cloud) < 100)


def valid_days(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Number of valid days and their mean cloud percentage."""
    ok = valid_observation()
    return daily.groupBy(*keys).agg(F.count_if(ok).alias("n_valid_days"), F.avg(F.when(ok, F.col("cloud_pct"))).alias("mean_cloud_pct"))


def primary_table(zonal: DataFrame, simulations: DataFrame, lai: DataFrame) -> DataFrame:
    """Zonal results with simulator and leaf-area columns where the region has them."""
    out = zonal.join(simulations, "cleaned_name", "left").join(lai, "cleaned_name", "left")
    return out.select("region", *[c for c in out.columns if c != "region"]).orderBy("region")


def assemble_regions(estimate: DataFrame, factor: DataFrame, extra: DataFrame | None = None, attrs: DataFrame | None = None, keep: list[str] | None = None, reference: DataFrame | None = None) -> DataFrame:
    """One row for each region that has estimate and factor, with extra columns, kept attributes and reference (_ref)."""
    out = estimate.join(factor, "region")
    if extra is not None:
        out = out.join(extra, "region", "left")
    if attrs is not None:
        missing = [c for c in keep or [] if c not in attrs.columns]
        if missing:
            raise ValueError(f"regions have no attribute {missing}")
        out = out.join(attrs.select("region", *(keep or [])), "region", "left")
    if reference is not None:
        out = out.join(reference.select("region", *[F.col(c).alias(f"{c}_ref") for c in reference.columns if c != "region"]), "region", "left")
    return out.orderBy("region")


def with_reference(section: DataFrame, reference: DataFrame, column: str = "reported_mean_yield_kg_ha") -> DataFrame:
    """Reference yields joined to a table, replacing a column of that name."""
    return section.drop(column).join(reference.select("region", column), "region", "left")


def match_on(polygons: DataFrame, rows: DataFrame, left: str, right: str, how: str = "inner") -> DataFrame:
    """Keys of different names, compared as text."""
    return polygons.join(rows, F.col(left).cast("string") == F.col(right).cast("string"), how)


def manifest(regions: DataFrame, years: DataFrame, timepoints: DataFrame) -> DataFrame:
    """Every combination of three small tables (a plan of work, not data)."""
    return regions.crossJoin(years).crossJoin(timepoints)


def manifest_gaps(wanted: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Q7."""
    return wanted.join(present.select(*on).distinct(), on, "left_anti")


def children(parents: DataFrame, features: DataFrame, name: str = "region", subregions: str = "subregions") -> DataFrame:
    """(parent, child columns) by the names a parent lists."""
    p = parents.select(F.col(name).alias("parent"), F.explode(subregions).alias(name))
    return p.join(features, name)


def subregions(features: DataFrame, attribute: str, name: str = "region") -> DataFrame:
    """Sorted names of each attribute's regions."""
    return features.groupBy(attribute).agg(F.sort_array(F.collect_set(name)).alias("subregions"))


def window_range(windows: DataFrame, start: str, end: str, keys: list[str] | None = None) -> DataFrame:
    """A33."""
    return windows.groupBy(*(keys or [])).agg(F.min(start).alias("first_day"), F.max(end).alias("last_day"))


def one_admin_level(regions: DataFrame, level: str, deeper: list[str]) -> DataFrame:
    """rows of this level: it has a name and no deeper one has."""
    ok = F.col(level).isNotNull()
    for c in deeper:
        ok = ok & F.col(c).isNull()
    return regions.where(ok)


def allowed(regions: DataFrame, attribute: str, values: list, templates: DataFrame | None = None) -> DataFrame:
    """regions on an allow-list, with the template of their attribute if a table is given."""
    out = regions.where(F.col(attribute).isin(values))
    return out.join(templates, attribute, "left") if templates is not None else out


def feature_documents(features: DataFrame, series: DataFrame, name: str = "region", day: str = "date", value: str = "value") -> DataFrame:
    """One JSON document a region, its series nested in order of days."""
    s = series.groupBy(name).agg(F.sort_array(F.collect_list(F.struct(F.col(day).cast("string").alias("date"), F.col(value).alias("value")))).alias("series"))
    j = features.join(s, name, "left")
    doc = F.struct(F.lit("Feature").alias("type"), F.struct(*[c for c in j.columns]).alias("properties"))
    return j.select(name, F.to_json(doc).alias("document"))


def distinct_parts(df: DataFrame, *columns: str) -> DataFrame:
    """U5, S3."""
    return df.select(*columns).distinct().orderBy(*columns)


def level_documents(base: DataFrame, series: DataFrame, levels: list[str], estimates: DataFrame | None = None, day: str = "date", value: str = "value", flag: str = "interpolated") -> DataFrame:
    """(level, name, document, children): a JSON feature of every region of every level, and the collection of its children's features.

    base has a row a region with its name at each of levels, coarsest first, and the last one names it in
    series(name, day, value, flag). A feature holds the means over the days that all its base regions have,
    its days, whether any value of a day was filled, its children's names, and the columns of
    estimates(level, name, ...), null without a row there. Levels are put together from the bottom, each by one
    grouping and one join; children stand in order of name; those of the last level have none.
    """
    lowest = levels[-1]
    known = base.select(*levels).distinct().where(F.col(lowest).isNotNull())
    wide = series.select(F.col(lowest), F.col(day).cast("string").alias("__day"), F.col(value).alias("__value"), F.col(flag).cast("int").alias("__flag"))
    features = None
    for i, level in enumerate(levels):
        inner = i + 1 < len(levels)
        members = known.where(F.col(level).isNotNull()).groupBy(F.col(level).alias("name")).agg(
            F.countDistinct(lowest).alias("__members"), (F.sort_array(F.collect_set(levels[i + 1])) if inner else F.array().cast("array<string>")).alias("subregions")
        )
        rows = known.select(F.col(level).alias("name"), lowest).distinct().join(wide, lowest)
        days = rows.groupBy("name", "__day").agg(F.avg("__value").alias("v"), F.max("__flag").alias("f"), F.countDistinct(lowest).alias("__have"))
        common = days.join(members.select("name", "__members"), "name").where("__have = __members")
        nested = common.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("__day", "v", "f"))).alias("s"))
        one = members.join(nested, "name", "left").select(
            F.lit(i).alias("level"), "name", "subregions", F.lit(inner).alias("isAggregated"), F.col("s.v").alias("timeSeries"), F.col("s.__day").alias("dateLabels"), F.col("s.f").alias("interpolationFlags")
        )
        features = one if features is None else features.unionByName(one)
    if estimates is not None:
        features = features.join(estimates, ["level", "name"], "left")
    properties = [c for c in features.columns if c != "level"]
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties")), {"ignoreNullFields": "false"})
    docs = features.select("level", "name", feature.alias("document"))
    pairs = None
    for i in range(len(levels) - 1):
        pair = known.select(F.lit(i).alias("level"), F.col(levels[i]).alias("name"), F.col(levels[i + 1]).alias("child")).distinct()
        pairs = pair if pairs is None else pairs.unionByName(pair)
    if pairs is None:
        return docs.withColumn("children", F.lit(None).cast("string"))
    below = docs.select((F.col("level") - 1).alias("level"), F.col("name").alias("child"), F.col("document").alias("__d"))
    kept = pairs.join(below, ["level", "child"]).groupBy("level", "name").agg(F.sort_array(F.collect_list(F.struct("child", "__d"))).alias("__c"))
    collection = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("__c.__d", ","), F.lit("]}"))
    return docs.join(kept.select("level", "name", collection.alias("children")), ["level", "name"], "left")
