"""A small table with one version per micro-batch, for what a job carries from batch to batch.

A batch that is run again starts from the version before it and replaces its own, so results do not
depend on how often a batch was tried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """Versions live in ``<path>/v=<batch id>``; one is complete once Spark has marked it so."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int | None = 3):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(self.path)
        return path, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        path, root, files = self._files()
        if not files.exists(root):
            return []
        names = [status.getPath().getName() for status in files.listStatus(root)]
        return sorted((int(name[2:]) for name in names if name.startswith("v=")), reverse=True)

    def _complete(self, version: int) -> bool:
        path, _, files = self._files()
        return files.exists(path(self._folder(version), "_SUCCESS"))

    def _newest(self, older_than: int | None = None) -> DataFrame:
        for version in self._numbers():
            if (older_than is None or version < older_than) and self._complete(version):
                return self.read(version)
        return self.empty()

    def versions(self) -> list[int]:
        return sorted(v for v in self._numbers() if self._complete(v))

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def before(self, batch_id: int) -> DataFrame:
        """The newest version older than the batch, empty at the start."""
        return self._newest(batch_id)

    def latest(self) -> DataFrame:
        return self._newest()

    def write(self, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self._folder(batch_id))
        if self.keep is not None:
            path, _, files = self._files()
            for old in [v for v in self._numbers() if v < batch_id][self.keep :]:
                files.delete(path(self._folder(old)), True)
