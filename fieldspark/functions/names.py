"""Names, labels and exported numbers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clean_name(c: Column) -> Column:
    """P1 for text without accents: quotes go, other signs than word letters, dot and dash become _, lower case."""
    return F.lower(F.regexp_replace(F.translate(c, "'\"", ""), r"(?U)[^\w.-]", "_"))


@F.pandas_udf(StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """Letters without their accents (compatibility decomposition, combining marks dropped)."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def with_clean_names(df: DataFrame, name: str = "region", out: str = "cleaned_name") -> DataFrame:
    """Accents are stripped once for each distinct name and joined back."""
    names = df.select(name).distinct().withColumn(out, strip_accents(clean_name(F.col(name))))
    return df.join(names.withColumnRenamed(name, "__name"), F.col(name).eqNullSafe(F.col("__name")), "left").drop("__name")


def normalize_year(c: Column) -> Column:
    """2019, 2019.0 and '2019' are the same label; other text stays."""
    return F.coalesce(c.try_cast("double").cast("int").cast("string"), c.cast("string"))


def half_even(c: Column, digits: int = 2) -> Column:
    """The rounding of exported numbers."""
    return F.bround(c, digits)


def export_missing(c: Column, digits: int | None = None) -> Column:
    """P20: -1 for a missing value, at the sink only; rounded, or cut to a whole number without digits."""
    return F.coalesce(F.bround(c, digits) if digits is not None else c.cast("int"), F.lit(-1))


def kg_to_tons(c: Column) -> Column:
    """P28."""
    return F.bround(c / 1000, 3)


def error(pred: Column, obs: Column) -> Column:
    """P24, predicted minus observed."""
    return F.round(pred - obs, 1)


def relative_error(pred: Column, obs: Column) -> Column:
    """P24 in percent; an observation of 0 gives an infinite error, 0 against 0 NaN."""
    e = pred - obs
    at_zero = F.when(e > 0, F.lit(float("inf"))).when(e < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.when(obs == 0, at_zero).otherwise(F.round(F.try_divide(100 * e, obs), 1))


def reported_mean(mean: Column, production_kg: Column, area_ha: Column) -> Column:
    """P25: reported mean yield, else production over area."""
    return F.coalesce(mean, F.try_divide(production_kg, area_ha))


#: Names of the exported columns
#: Column names as exported.
EXPORT_NAMES = {
    "mean_yield_kg_ha": "estimated_mean_yield_kg_ha",
    "median_yield_kg_ha": "estimated_median_yield_kg_ha",
    "total_production_kg": "estimated_total_production_kg",
    "total_production_ton": "estimated_total_production_ton",
}


def export_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in EXPORT_NAMES.items() if k in df.columns})


def keep_original_year(df: DataFrame, kept_as: str = "year_original") -> DataFrame:
    """A year column that is there already gets another name."""
    return df.withColumnRenamed("year", kept_as) if "year" in df.columns else df


def metric_rows(df: DataFrame, ids: list[str]) -> DataFrame:
    """One row per metric."""
    metrics = [c for c in df.columns if c not in ids]
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(ids, metrics, "metric", "value")


def precipitation_source(df: DataFrame, precip_regions: DataFrame, other: str = "NASA") -> DataFrame:
    """CHIRPS where the region has precipitation of its own."""
    have = precip_regions.select(F.col("region").alias("__region")).distinct().withColumn("__have", F.lit(True))
    return df.join(have, F.col("region") == F.col("__region"), "left").withColumn("precipitation_source", F.when(F.col("__have"), "CHIRPS").otherwise(other)).drop("__region", "__have")
