"""Incremental runs: index ranges that resume, cross-run dedup, and the same over file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_by, unseen
from ..sources.files import exists


def resume_range(total: int, start: int = 1, end: int = 0, next_start: int = 1, auto: bool = True) -> tuple[int, int]:
    """1-based inclusive range of a run.  A run from 1 goes on where the last one ended; the end is clamped."""
    if auto and start <= 1 and next_start > 1:
        start = next_start
    return max(1, start), total if end <= 0 else min(end, total)


def slice_rows(df: DataFrame, index: str, first: int, last: int) -> DataFrame:
    return df.filter(F.col(index).between(first, last))


def stream_files(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def slices(first: int, last: int, every: int = 0):
    """The ranges of at most ``every`` that a run goes through, with a checkpoint after each; 0: one range."""
    step = every if every > 0 else max(1, last - first + 1)
    for at in range(first, last + 1, step):
        yield at, min(last, at + step - 1)


def stream_first_rows(stream: DataFrame, keys: list[str], output: str, checkpoint: str, position: str, buckets: int = 64):
    """Appends to ``output`` the first row of each key over all runs, by position within a batch.

    The state is the output table itself, met by an anti-join on its key columns, so it needs no bound in
    event time.  It is laid out by a hash of the key, and a batch reads only the folders that its keys
    fall into.  A batch that is run again after a failure replaces its own folder, so nothing is written twice."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = first_by(batch, [F.col(k) for k in keys], position).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        if exists(spark, output):
            some = [r["bucket"] for r in first.select("bucket").distinct().collect()]
            before = spark.read.schema(first.schema.add("batch", "long")).option("basePath", output).parquet(output)
            first = unseen(first, before.filter((F.col("batch") < number) & F.col("bucket").isin(some)), keys)
        first.write.mode("overwrite").partitionBy("bucket").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_counts(stream: DataFrame, time: str, key: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key; state goes when the watermark has passed a window."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
