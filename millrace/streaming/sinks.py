"""Sinks that write each micro-batch to a folder of its own.

A folder is named after the batch id, so a batch that is run again replaces its own output, and the
folders read back as one table with a ``batch_id`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.streaming.versions import VersionedTable


def batch_folder(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/batch_id={batch_id}"


class TextBatches:
    """Non-empty batches as text; with a ``limit`` nothing is written once more rows than that are out.

    The bound is tested after a batch is written, so the batch that passes it is kept whole.  The
    count so far is kept beside the output and survives a restart.
    """

    def __init__(self, out: str, column: str = "text", limit: int | None = None, files: int | None = None):
        self.out, self.column, self.limit, self.files = out, column, limit, files
        self.reached = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        counts = VersionedTable(batch.sparkSession, f"{self.out.rstrip('/')}/_counts", "total BIGINT")
        before = counts.before(batch_id).first()
        total = before["total"] if before else 0
        if self.limit is not None and total > self.limit:
            self.reached = True
            return
        rows = batch.select(self.column)
        if self.files:
            rows = rows.coalesce(self.files)
        rows = rows.persist()
        try:
            if not rows.isEmpty():
                rows.write.mode("overwrite").text(batch_folder(self.out, batch_id))
                total += rows.count()
                counts.write(batch_id, batch.sparkSession.createDataFrame([(total,)], "total BIGINT"))
        finally:
            rows.unpersist()
        self.reached = self.limit is not None and total > self.limit


class JsonBatches:
    """Every batch as JSON, empty ones included."""

    def __init__(self, out: str):
        self.out = out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(batch_folder(self.out, batch_id))


class ParquetBatches:
    """What ``change`` makes of every batch, as Parquet."""

    def __init__(self, out: str, change: Callable[[DataFrame, int], DataFrame] | None = None):
        self.out, self.change = out, change

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        result = self.change(batch, batch_id) if self.change else batch
        result.write.mode("overwrite").parquet(batch_folder(self.out, batch_id))


class SqlBatches:
    """Every batch under a view name, exported as JSON, and a query over it stored as Parquet.

    The view holds one batch only.  ``show`` prints the first twenty rows of the answer.
    """

    def __init__(self, sql: str, view: str, out: str, export: str | None = None, show: bool = False):
        self.sql, self.view, self.out, self.show = sql, view, out, show
        self.export = JsonBatches(export) if export else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if self.export:
                self.export(batch, batch_id)
            batch.createOrReplaceTempView(self.view)
            answer = batch.sparkSession.sql(self.sql)
            answer.write.mode("overwrite").parquet(batch_folder(self.out, batch_id))
            if self.show:
                answer.show()
        finally:
            batch.unpersist()


class RunningLengths:
    """Per batch: totals since the start, integer average, maximum of the batch and so far.

    Takes batches with a ``length`` column; empty batches leave no row.
    """

    TOTALS = "posts BIGINT, chars BIGINT, top BIGINT"
    ROW = "total_posts BIGINT, total_chars BIGINT, average BIGINT, batch_max BIGINT, max_so_far BIGINT"

    def __init__(self, out: str):
        self.out = out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        totals = VersionedTable(spark, f"{self.out.rstrip('/')}/_totals", self.TOTALS)
        new = batch.agg(F.count("*").alias("posts"), F.sum("length").alias("chars"), F.max("length").alias("top")).first()
        if not new["posts"]:
            return
        old = totals.before(batch_id).first() or {"posts": 0, "chars": 0, "top": 0}
        posts, chars = old["posts"] + new["posts"], old["chars"] + new["chars"]
        top = max(old["top"], new["top"])
        row = spark.createDataFrame([(posts, chars, chars // posts, new["top"], top)], self.ROW)
        row.write.mode("overwrite").parquet(batch_folder(self.out, batch_id))
        totals.write(batch_id, spark.createDataFrame([(posts, chars, top)], self.TOTALS))
