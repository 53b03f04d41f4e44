"""Incremental ingestion with Structured Streaming: an extension, the batch builders are the definition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_rows(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_arrivals(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once; the state of a key is dropped when it can't come any more."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def window_counts(stream: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """Rows for each event-time window and key; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def into_parquet(stream: DataFrame, build: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch goes through a batch builder into its own folder, which a repeated batch overwrites."""

    def one(batch: DataFrame, number: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
