"""Incremental runs: new files are taken in once, and only the years they touch are written anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.temporal import resample_month


def update_monthly(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, cell: str, t: str, value: str) -> None:
    """Monthly sums and counts of all new files of a folder, as partial rows by year; ``monthly_means`` adds them up.

    The batch's number is a column and a partition, so a batch that is run again replaces its own rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        part = resample_month(batch, cell, t, {"s": F.sum(value), "n": F.count(value)}).withColumns({"year": F.year("t"), "batch": F.lit(number)})
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "year").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def monthly_means(spark: SparkSession, target: str) -> DataFrame:
    d = spark.read.parquet(target)
    return d.groupBy("cell", "t").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("v"))


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events by type and day of a stream, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
