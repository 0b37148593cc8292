"""Short text posts, stored or streamed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POST_SCHEMA = "id BIGINT, ts TIMESTAMP, text STRING"


def read_posts(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(POST_SCHEMA).format(fmt).load(path)


def stream_posts(
    spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Posts from the files that appear under ``path``; the schema is fixed, never inferred."""
    reader = spark.readStream.schema(POST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
