"""Models trained batch by batch, and scoring against a chosen version of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from millrace.operators import kmeans, regression
from millrace.streaming.versions import VersionedTable


def unused_rows(spark: SparkSession, path: str) -> VersionedTable:
    """How many rows of each batch could not be used, beside the model or output at ``path``."""
    return VersionedTable(spark, f"{path.rstrip('/')}_unused", "rows BIGINT", keep=None)


def report_unused(batch: DataFrame, usable: Column, path: str, batch_id: int) -> DataFrame:
    """The usable rows; the number of others is written down, if there are any."""
    fits = F.coalesce(usable, F.lit(False))
    unused = batch.where(~fits).count()
    if unused:
        unused_rows(batch.sparkSession, path).write(batch_id, batch.sparkSession.createDataFrame([(unused,)], "rows BIGINT"))
    return batch.where(fits)


class KMeansStore:
    """Versions of a k-means model, one per training batch."""

    def __init__(self, spark: SparkSession, path: str, keep: int | None = None):
        schema = "centres ARRAY<ARRAY<DOUBLE>>, weights ARRAY<DOUBLE>"
        self.spark, self.table = spark, VersionedTable(spark, path, schema, keep)

    @staticmethod
    def _model(row) -> kmeans.KMeansModel | None:
        return kmeans.KMeansModel(tuple(map(tuple, row["centres"])), tuple(row["weights"])) if row else None

    def latest(self) -> kmeans.KMeansModel | None:
        return self._model(self.table.latest().first())

    def version(self, batch_id: int) -> kmeans.KMeansModel | None:
        return self._model(self.table.read(batch_id).first())

    def before(self, batch_id: int) -> kmeans.KMeansModel | None:
        return self._model(self.table.before(batch_id).first())

    def save(self, batch_id: int, model: kmeans.KMeansModel) -> None:
        row = ([list(c) for c in model.centres], list(model.weights))
        self.table.write(batch_id, self.spark.createDataFrame([row], self.table.schema))


class KMeansTrainer:
    """Batches with a ``features`` column move the centres; every batch leaves a version."""

    def __init__(
        self, path: str, start: kmeans.KMeansModel, decay: float = 1.0, per_point: bool = False, keep: int | None = None
    ):
        self.path, self.start, self.decay, self.per_point, self.keep = path, start, decay, per_point, keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        store = KMeansStore(batch.sparkSession, self.path, self.keep)
        batch = report_unused(batch, (F.size("features") == self.start.dim) & ~F.exists("features", F.isnull), self.path, batch_id)
        model = store.before(batch_id) or self.start
        store.save(batch_id, kmeans.update(model, batch, decay=self.decay, per_point=self.per_point))


class LineStore:
    """Versions of a one-feature line, one per training batch."""

    def __init__(self, spark: SparkSession, path: str, keep: int | None = None):
        self.spark, self.table = spark, VersionedTable(spark, path, "slope DOUBLE, intercept DOUBLE", keep)

    @staticmethod
    def _model(row) -> regression.LineModel | None:
        return regression.LineModel(row["slope"], row["intercept"]) if row else None

    def latest(self) -> regression.LineModel | None:
        return self._model(self.table.latest().first())

    def version(self, batch_id: int) -> regression.LineModel | None:
        return self._model(self.table.read(batch_id).first())

    def before(self, batch_id: int) -> regression.LineModel | None:
        return self._model(self.table.before(batch_id).first())

    def save(self, batch_id: int, model: regression.LineModel) -> None:
        self.table.write(batch_id, self.spark.createDataFrame([(model.slope, model.intercept)], self.table.schema))


class LineTrainer:
    """Batches with ``label`` and ``feature`` move the line; every batch leaves a version."""

    def __init__(
        self, path: str, start: regression.LineModel = regression.LineModel(), carry_intercept: bool = False,
        keep: int | None = None,
    ):
        self.path, self.start, self.carry_intercept, self.keep = path, start, carry_intercept, keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        store = LineStore(batch.sparkSession, self.path, self.keep)
        batch = report_unused(batch, F.col("label").isNotNull() & F.col("feature").isNotNull(), self.path, batch_id)
        model = store.before(batch_id) or self.start
        store.save(batch_id, regression.update(model, batch, carry_intercept=self.carry_intercept))


class Scorer:
    """Predictions next to the known labels, by one named version of the model or the newest one.

    Training and scoring may run side by side.  With ``behind`` batch b is scored by the newest version older than b, which
    training batch b does not touch: the answer is the same however far the trainer is, once it has published b - 1, and in a batch that is run again.
    """

    def __init__(
        self,
        out: Callable[[DataFrame, int], None],
        load: Callable[[SparkSession, int], object],
        score: Callable[[DataFrame, object], DataFrame],
        usable: Column | None = None,
        unused: str | None = None,
    ):
        self.out, self.load, self.score, self.usable, self.unused = out, load, score, usable, unused

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        model = self.load(batch.sparkSession, batch_id)
        if model is not None:
            if self.usable is not None and self.unused:
                batch = report_unused(batch, self.usable, self.unused, batch_id)
            self.out(self.score(batch, model), batch_id)


def kmeans_scorer(path: str, start: kmeans.KMeansModel, out, version: int | None = None, behind: bool = False) -> Scorer:
    """Cluster per labelled point; before any training the starting centres answer."""

    def load(spark: SparkSession, batch_id: int):
        store = KMeansStore(spark, path)
        if behind:
            return store.before(batch_id) or start
        return store.version(version) if version is not None else store.latest() or start

    def score(batch: DataFrame, model: kmeans.KMeansModel) -> DataFrame:
        return kmeans.assign(batch, model).withColumn("label", F.col("label").cast("int")).select("label", "cluster")

    return Scorer(out, load, score)


def line_scorer(path: str, out, version: int | None = None, unused: str | None = None, behind: bool = False) -> Scorer:
    """Prediction per labelled point; before any training the zero line answers.

    With ``unused`` rows without a label or a feature are counted beside that path instead of answered.
    """

    def load(spark: SparkSession, batch_id: int):
        store = LineStore(spark, path)
        if behind:
            return store.before(batch_id) or regression.LineModel()
        return store.version(version) if version is not None else store.latest() or regression.LineModel()

    def score(batch: DataFrame, model: regression.LineModel) -> DataFrame:
        return batch.select("label", regression.predict(F.col("feature"), model).alias("prediction"))

    return Scorer(out, load, score, F.col("label").isNotNull() & F.col("feature").isNotNull(), unused)
