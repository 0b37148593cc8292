"""Posts from a feed: a folder of files with one JSON post a line that grow while they are read.

Spark's file source takes a file once, as long as it is then.  Here the offset is a byte position per file, so what
is appended later comes in a later batch, and a line still being written waits until it has ended.  The offset is as
long as the list of files, so a feed is meant to have few files that grow, not many that stay.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.sources.posts import POST_SCHEMA

BLOCK = 1 << 20


@dataclass
class Span(InputPartition):
    """Lines of a file that start in [begin, end); ``cut`` if ``begin`` may be inside a line."""

    file: str
    begin: int
    end: int
    cut: bool


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """Any file system that Arrow knows by its address; paths without one are local or mounted."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


class FeedReader(DataSourceStreamReader):
    def __init__(self, folder: str, split_bytes: int):
        self.folder, self.split_bytes = folder, split_bytes
        self.ends: dict[str, tuple[int, int]] = {}  # of files seen: their size then, and where their last line ends

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Where the last whole line of every file ends.  Only files that have grown are opened."""
        store, root = _store(self.folder)
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.File and info.base_name[0] not in "._":
                size, end = self.ends.get(info.base_name, (0, 0))
                if info.size < size:
                    raise ValueError(f"{info.base_name} has become shorter: a feed may only grow")
                if info.size > size:
                    with store.open_input_file(info.path) as file:
                        end = last_line_end(file, end, info.size)
                    self.ends[info.base_name] = info.size, end
        return {name: end for name, (_, end) in sorted(self.ends.items()) if end}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        """New bytes of every file, cut into spans of about the same size: a file that got most of them is many tasks."""
        out = []
        for name, upto in end.items():
            since = start.get(name, 0)
            if upto < since:
                raise ValueError(f"{name} has become shorter: a feed may only grow")
            for at in range(since, upto, self.split_bytes):
                out.append(Span(name, at, min(at + self.split_bytes, upto), at > since))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        store, root = _store(self.folder)
        with io.BufferedReader(store.open_input_file(f"{root.rstrip('/')}/{partition.file}"), BLOCK) as file:
            at = partition.begin
            if partition.cut:  # the line across the cut belongs to the span before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(at)
            lines, held = [], 0
            while at < partition.end:
                line = file.readline()
                at, held = at + len(line), held + len(line)
                lines.append(line.strip().decode("utf-8", "replace"))
                if held >= BLOCK:
                    yield as_batch(lines)
                    lines, held = [], 0
            if lines:
                yield as_batch(lines)


def as_batch(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])


def last_line_end(file, begin: int, size: int) -> int:
    """The position after the last line feed in [begin, size), looked for from the back; ``begin`` if there is none."""
    high = size
    while high > begin:
        low = max(begin, high - BLOCK)
        file.seek(low)
        found = file.read(high - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        high = low
    return begin


class PostFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "post_feed"

    def schema(self) -> str:
        return "line STRING"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"], int(self.options.get("split_bytes", 64 << 20)))


def stream_feed(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """Posts as they are appended to the files under ``path``; a restart goes on at the byte where it stopped.

    Empty lines are no posts; lines that are no JSON come as posts of nulls, as from Spark's own reader.
    """
    spark.dataSource.register(PostFeed)
    reader = spark.readStream.format("post_feed")
    if split_bytes:
        reader = reader.option("split_bytes", split_bytes)
    return reader.load(path).where("line != ''").select(F.from_json("line", POST_SCHEMA).alias("post")).select("post.*")
