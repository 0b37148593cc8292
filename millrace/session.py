"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  The master and all sizes (memory, cores, shuffle partitions) stay
# with whoever submits the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # recording the Python call site of every expression only serves error messages and makes
    # building a plan several times slower
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "millrace", **settings: str) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """What a given session needs: log times carry no zone after parsing, so one fixed zone is used."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state off the heap; ``transformWithState`` also requires this provider.

    A batch commits what it changed instead of a copy of the whole state.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


SHARED = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named in ``spark.checkpoint.dir``, if it is set."""
    return spark.conf.get(SHARED, None) or spark.sparkContext.getConf().get(SHARED, None)


def use_local_folder(spark: SparkSession) -> SparkSession:
    """For tests, benches and trials: names a temporary folder as the shared one where none is set.

    Only a local master, whose tasks all run on this machine, gets one; anything else is left alone.
    """
    if not shared_folder(spark) and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set(SHARED, tempfile.mkdtemp(prefix="millrace-"))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder; without one there is no place that all executors see."""
    base = shared_folder(spark)
    if not base:
        raise RuntimeError(f"set {SHARED} to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, frames: Iterable[DataFrame]) -> None:
    """Deletes the folders below the shared folder that ``frames`` are read from, once they are no longer needed."""
    base = shared_folder(spark)
    jvm = spark.sparkContext._jvm
    for folder in {file.rsplit("/", 1)[0] for frame in frames for file in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if base and base.split(":")[-1].rstrip("/") in folder:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def passing_scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for the length of a block: what it wrote is deleted when the block ends, however it ends."""
    base = scratch_path(spark, name)
    try:
        yield lambda df, part: _written(df, f"{base}/{part}-{uuid.uuid4().hex}")
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For summaries that are far smaller than the input they come from and are used several times:
    the input is read once whatever the optimizer makes of the uses, an executor lost later costs
    no second pass over it, and the optimizer knows the true size.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
