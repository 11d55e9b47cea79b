"""Incremental jobs as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldspark.operators.series import linear_fill


def append_missing_days(spark: SparkSession, landed: DataFrame, store: str, cleaned: str, checkpoint: str, values: list[str], keys: tuple[str, ...] = ("loc",), day: str = "date") -> StreamingQuery:
    """Days that the store does not hold are appended, then the locations they touch are cleaned again.

    Dedup is within the batch and against the store, so the query keeps no state. The cleaned table is
    written by batch number: a batch that runs twice overwrites its own part. Readers take each
    location's rows of its highest batch.
    """
    on = [*keys, day]

    def batch(new: DataFrame, number: int) -> None:
        new = new.dropDuplicates(on)
        try:
            held = spark.read.parquet(store).where(F.col("batch") != number)
        except Exception as e:  # noqa: BLE001  nothing stored yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            held = None
        fresh = new if held is None else new.join(held.select(*on), on, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{store}/batch={number}")
        every = spark.read.parquet(store)
        touched = spark.read.parquet(f"{store}/batch={number}").select(*keys).distinct()
        whole = every.join(touched, list(keys), "left_semi").drop("batch")
        linear_fill(whole, list(keys), day, values).write.mode("overwrite").parquet(f"{cleaned}/batch={number}")

    return landed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_cleaned(spark: SparkSession, cleaned: str, keys: list[str]) -> DataFrame:
    """Rows of each location's last batch."""
    rows = spark.read.parquet(cleaned)
    last = rows.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return rows.join(last, [*keys, "batch"], "left_semi").drop("batch")


def running_max(pixels: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """R2: season maximum of each pixel, one row of state a pixel; for update or complete mode."""
    return pixels.groupBy(*keys).agg(F.max(value).alias("max_lai"))


def daily_stream_stats(pixels: DataFrame, keys: list[str], ts: str = "ts", value: str = "v", late: str = "2 days") -> DataFrame:
    """R2: A1 by day with a watermark; rows later than that are dropped, finished days are appended."""
    day = F.window(ts, "1 day")
    out = pixels.withWatermark(ts, late).groupBy(*keys, day.alias("w")).agg(F.avg(value).alias("lai_mean"), F.median(value).alias("lai_median"), F.stddev_pop(value).alias("lai_std"), F.count(value).alias("n_pixels"))
    return out.select(*keys, F.to_date("w.start").alias("date"), "lai_mean", "lai_median", "lai_std", "n_pixels")
