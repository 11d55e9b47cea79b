"""The incremental jobs on small folders of files."""

import datetime as dt


from fieldspark.streaming.jobs import append_missing_days, daily_stream_stats, latest_cleaned, running_max


def test_append_missing_days(spark, tmp_path):
    d = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    schema = "loc string, date date, t double"
    landed = str(tmp_path / "landed")
    args = (str(tmp_path / "store"), str(tmp_path / "clean"), str(tmp_path / "cp"), ["t"])

    def run():
        append_missing_days(spark, spark.readStream.schema(schema).parquet(landed), *args).awaitTermination()
        return {(r.loc, (r.date - d(0)).days): r.t for r in latest_cleaned(spark, args[1], ["loc"]).collect()}

    spark.createDataFrame([("a", d(0), 1.0), ("a", d(1), None), ("a", d(1), None), ("a", d(2), 3.0), ("b", d(0), 7.0)], schema).write.parquet(landed)
    assert run() == {("a", 0): 1, ("a", 1): 2, ("a", 2): 3, ("b", 0): 7}
    spark.createDataFrame([("a", d(2), 99.0), ("a", d(3), None), ("a", d(4), 5.0)], schema).write.mode("append").parquet(landed)
    assert run() == {("a", 0): 1, ("a", 1): 2, ("a", 2): 3, ("a", 3): 4, ("a", 4): 5, ("b", 0): 7}


def test_stream_stats(spark, tmp_path):
    ts = lambda day, h: dt.datetime(2024, 1, day, h)
    rows = [("r", 0, ts(1, 1), 1.0), ("r", 1, ts(1, 5), 3.0), ("r", 0, ts(2, 1), 4.0), ("r", 0, ts(9, 1), 2.0)]
    src = str(tmp_path / "px")
    spark.createDataFrame(rows, "region string, ix int, ts timestamp, v double").coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema("region string, ix int, ts timestamp, v double").parquet(src)

    def collect(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert {(r.ix, r.max_lai) for r in collect(running_max(stream(), ["region", "ix"]), "top", "complete")} == {(0, 4.0), (1, 3.0)}
    done = {str(r.date): (r.lai_mean, r.n_pixels) for r in collect(daily_stream_stats(stream(), ["region"]), "daily", "append")}
    assert done == {"2024-01-01": (2.0, 2), "2024-01-02": (4.0, 1)}
