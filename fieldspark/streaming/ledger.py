"""R2: a ledger of the ranges of days that are done, and a season maximum folded only over what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def missing_ranges(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Days of wanted(keys, first, last) that are in none of done(keys, first, last), as longest ranges; ends count in.

    Each range opens on its first day and closes after its last; between two such days of a key nothing
    changes, so running sums over them tell which stretches are wanted and not done. Ranges with a missing
    or earlier last day hold no day.
    """

    def steps(df: DataFrame, name: str) -> DataFrame:
        step = lambda c, n: F.struct(F.col(c).cast("date").alias("day"), F.lit(n).alias("n"))
        rows = df.where("first <= last").withColumn("after", F.date_add("last", 1))
        rows = rows.select(*keys, F.explode(F.array(step("first", 1), step("after", -1))).alias("s"))
        other = "done" if name == "wanted" else "wanted"
        return rows.select(*keys, "s.day", F.col("s.n").alias(name), F.lit(0).alias(other))

    changes = steps(wanted, "wanted").unionByName(steps(done, "done")).groupBy(*keys, "day").agg(F.sum("wanted").alias("wanted"), F.sum("done").alias("done"))
    order = Window.partitionBy(*keys).orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = changes.select(*keys, "day", ((F.sum("wanted").over(upto) > 0) & (F.sum("done").over(upto) <= 0)).alias("open"), F.lead("day").over(order).alias("next"))
    # a stretch that goes on from an open one belongs to its range
    begins = F.col("open") & ~F.coalesce(F.lag("open").over(order), F.lit(False))
    states = states.withColumn("begins", begins).withColumn("number", F.sum(F.col("begins").cast("int")).over(upto))
    return states.where("open").groupBy(*keys, "number").agg(F.min("day").alias("first"), F.date_sub(F.max("next"), 1).alias("last")).drop("number")


def _held(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001  nothing there yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def fold_ranges(pixels: DataFrame, wanted: DataFrame, at: str, number: int, keys: list[str], cell: list[str], day: str = "date", value: str = "v") -> DataFrame:
    """Fold the days of wanted(keys, first, last) that are not done yet into the maxima under `at`; returns the ranges that were new.

    pixels(keys, cell, day, value) lie in partitions of day: only partitions of new days are read. Batches
    are numbered and written in turn, maxima first, ranges last; a batch that runs again sees neither its own
    ranges nor its own maxima and overwrites both, so it gives what it gave before. Readers take the last batch.
    """
    spark = pixels.sparkSession
    ranges, maxima = _held(spark, f"{at}/ranges"), _held(spark, f"{at}/maxima")
    done = wanted.limit(0) if ranges is None else ranges.where(F.col("batch") < number)
    fresh = missing_ranges(wanted, done.select(*keys, "first", "last"), keys).persist()
    try:
        days = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys], F.explode(F.sequence("first", "last")).alias("__day"))
        # the days alone prune the scan: they are no more than a calendar has
        rows = pixels.join(F.broadcast(days.select(F.col("__day").alias(day)).distinct()), day, "left_semi")
        on = F.col(day) == F.col("__day")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
        new = rows.join(days, on, "left_semi").groupBy(*keys, *cell).agg(F.max(value).alias("max_lai"), F.count(value).alias("n_pixels"))
        old = None if maxima is None else maxima.where(F.col("batch") < number)
        if old is not None:
            last = old.agg(F.max("batch").alias("batch")).first()["batch"]
            new = new.unionByName(old.where(F.col("batch") == F.lit(last)).drop("batch")).groupBy(*keys, *cell).agg(F.max("max_lai").alias("max_lai"), F.sum("n_pixels").alias("n_pixels"))
        new.write.mode("overwrite").parquet(f"{at}/maxima/batch={number}")
        fresh.write.mode("overwrite").parquet(f"{at}/ranges/batch={number}")
    finally:
        fresh.unpersist()
    return spark.read.parquet(f"{at}/ranges/batch={number}")


def folded(spark: SparkSession, at: str) -> DataFrame:
    """Maxima as the last batch left them."""
    maxima = spark.read.parquet(f"{at}/maxima")
    last = maxima.agg(F.max("batch").alias("batch")).first()["batch"]
    return maxima.where(F.col("batch") == F.lit(last)).drop("batch")
