"""S15 and Q13 on small cases told out."""

import json

from pyspark.sql import functions as F

from fieldspark.operators import checks, studies


def test_documents_of_three_levels(spark):
    base = spark.createDataFrame([("land", "east", "a"), ("land", "east", "b"), ("land", "west", "c"), ("land", None, "d"), ("isle", "north", "e"), ("isle", "north", None)], "country string, part string, region string")
    series = spark.createDataFrame([("a", "2024-01-02", 1.0, 0), ("a", "2024-01-01", 3.0, 0), ("b", "2024-01-01", 5.0, 1), ("b", "2024-01-03", 7.0, 0), ("c", "2024-01-01", 2.0, 0), ("d", "2024-01-01", 6.0, 0), ("x", "2024-01-01", 9.0, 0)], "region string, date string, value double, interpolated int")
    estimates = spark.createDataFrame([(1, "east", 12.5), (0, "nowhere", 1.0)], "level int, name string, mean_yield double")
    docs = {(r.level, r.name): r for r in studies.level_documents(base, series, ["country", "part", "region"], estimates).collect()}
    assert set(docs) == {(0, "land"), (0, "isle"), (1, "east"), (1, "west"), (1, "north"), *[(2, x) for x in "abcde"]}
    east = json.loads(docs[1, "east"].document)["properties"]
    assert east == {"name": "east", "subregions": ["a", "b"], "isAggregated": True, "timeSeries": [4.0], "dateLabels": ["2024-01-01"], "interpolationFlags": [1], "mean_yield": 12.5}
    land = json.loads(docs[0, "land"].document)["properties"]
    assert land["subregions"] == ["east", "west"] and land["timeSeries"] == [4.0] and land["mean_yield"] is None
    children = json.loads(docs[1, "east"].children)
    assert children["type"] == "FeatureCollection" and [f["properties"]["name"] for f in children["features"]] == ["a", "b"]
    assert children["features"][0]["properties"]["dateLabels"] == ["2024-01-01", "2024-01-02"] and children["features"][0]["properties"]["subregions"] == []
    assert [f["properties"]["name"] for f in json.loads(docs[0, "land"].children)["features"]] == ["east", "west"]
    assert docs[2, "a"].children is None and json.loads(docs[1, "north"].document)["properties"]["timeSeries"] is None
    flat = studies.level_documents(base.select("region"), series, ["region"]).collect()
    assert sorted(r.name for r in flat) == list("abcde") and all(r.children is None for r in flat)
    assert studies.level_documents(base.limit(0), series, ["country", "part", "region"]).count() == 0


def test_errors_of_level_tables(spark):
    columns = spark.createDataFrame([("ok", "name", "string"), ("ok", "yield", "double"), ("ok", "year", "string"), ("text", "name", "string"), ("text", "yield", "string"), ("a b", "name", "string")], "level string, column string, kind string")
    levels = spark.createDataFrame([("ok", "name", "yield", "year"), ("text", "name", "yield", "year"), ("a b", "name", None, None), ("none", "name", None, None), ("unset", None, None, None)], "level string, name_column string, reference_column string, year_column string")
    got = sorted((r.level, r.error) for r in checks.level_errors(columns, levels).collect())
    assert got == [("a b", "level name holds a colon or space"), ("none", "no column name"), ("text", "column yield is missing or not numeric"), ("text", "column yield needs a year column"), ("unset", "no name column is set")]


def test_complete_regions_by_a_table_of_products(spark):
    products = spark.createDataFrame([("r", "x"), ("r", "y"), ("r", "y"), ("s", "x"), ("s", "z")], "region string, product string")
    names = spark.createDataFrame([("x",), ("y",), ("x",)], "product string")
    assert [r.region for r in checks.complete_regions(products, names).collect()] == ["r"]
    assert [r.region for r in checks.complete_regions(products, ["x"]).orderBy("region").collect()] == ["r", "s"]
    assert checks.complete_regions(products.where(F.lit(False)), names).count() == 0
