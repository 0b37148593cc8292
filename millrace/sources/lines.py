"""Lines of text, stored or streamed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``line`` per line of the text files under ``path``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that appear under ``path``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "line")


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines sent over TCP, with their arrival time.  The source keeps no offsets: for trials only."""
    return (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .option("includeTimestamp", "true")
        .load()
        .withColumnRenamed("value", "line")
        .withColumnRenamed("timestamp", "arrived")
    )


def arriving(lines: DataFrame, column: str = "arrived") -> DataFrame:
    """Lines with the time of the batch that takes them in, for jobs over arrival time."""
    return lines.withColumn(column, F.current_timestamp())


def stream_pair(
    spark: SparkSession, train_path: str, test_path: str, max_files_per_trigger: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Two independent line streams, one to learn from and one to score."""
    return (
        stream_lines(spark, train_path, max_files_per_trigger),
        stream_lines(spark, test_path, max_files_per_trigger),
    )


def heartbeat(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """A tick ``ts`` per second, to move event time on while the watched source is silent."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .load()
        .select(F.col("timestamp").alias("ts"))
    )
