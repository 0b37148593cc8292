"""Inputs derived by Spark from the stored tables: an access log, posts, and labelled points.

Time is compressed 720 times (30 days become one hour), so that windows of minutes hold many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
SQUEEZE = 720
GAP = (1704068400, 1704069000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_arrival(events: DataFrame) -> DataFrame:
    """Add ``arrived``, the compressed time."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    squeezed = F.expr(f"{EPOCH} + (s - {EPOCH}) div {SQUEEZE}")
    return events.withColumn("s", seconds).withColumn("arrived", F.timestamp_seconds(squeezed)).drop("s")


def access_log(events: DataFrame) -> DataFrame:
    """``(event_id, arrived, line)``; some lines are corrupt, lack an address or the protocol."""
    user, number = F.col("user_id"), F.col("event_id")
    address = F.when(
        number % 83 != 0, F.concat(F.lit("10.0."), F.expr("user_id div 100"), F.lit("."), user % 100)
    ).otherwise(F.lit(""))
    protocol = F.when(number % 89 != 0, F.lit(" HTTP/1.1")).otherwise(F.lit(""))
    status = (
        F.when(F.col("event_type") == "error", F.lit("500"))
        .when(F.col("event_type") == "click", F.lit("302"))
        .otherwise(F.lit("200"))
    )
    line = F.concat(
        address,
        F.lit(" - - ["),
        F.date_format("arrived", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "GET /'),
        F.col("event_type"),
        protocol,
        F.lit('" '),
        status,
        F.lit(" "),
        number,
        F.lit(' "-" "agent-'),
        user % 7,
        F.lit('"'),
    )
    corrupt = F.concat(F.lit("corrupt "), number)
    return with_arrival(events).select(
        "event_id", "arrived", F.when(number % 97 == 0, corrupt).otherwise(line).alias("line")
    )


def without_gap(log: DataFrame) -> DataFrame:
    """The log with ten silent minutes cut out."""
    second = F.unix_seconds("arrived")
    return log.where((second < GAP[0]) | (second >= GAP[1]))


def posts(events: DataFrame) -> DataFrame:
    """``(id, ts, text)`` with prefixed terms, digits, lone prefixes and trailing spaces."""
    kind = F.col("event_type")
    letter = F.char((F.lit(65) + F.col("event_id") % 26).cast("int"))
    tail = F.when(F.col("event_id") % 50 == 0, F.lit("  ")).otherwise(F.lit(""))
    text = F.concat(
        F.lit("saw "), kind, F.lit(" $"), kind, F.lit(" $"), F.col("user_id"), F.lit(" $ $Tag"), letter, tail
    )
    return with_arrival(events).select(
        F.col("event_id").alias("id"), F.col("arrived").alias("ts"), text.alias("text")
    )


def labelled_points(events: DataFrame) -> DataFrame:
    """``(id, label, feature)`` around a falling line."""
    feature = F.col("value") / F.lit(250.0) - F.lit(1.0)
    wobble = ((F.col("event_id") * 7919) % 1000) / F.lit(1000.0) * F.lit(0.4) - F.lit(0.2)
    return events.select(
        F.col("event_id").alias("id"), (wobble - feature).alias("label"), feature.alias("feature")
    )


def vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, features)`` in double precision."""
    return embeddings.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )
