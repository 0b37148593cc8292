"""A feed of posts whose files grow: nothing twice, nothing lost, whole lines only."""

import json
import os

import pytest

from millrace.sources import feed
from millrace.streaming.runner import for_each_batch
from millrace.streaming.sinks import ParquetBatches


def line(i, text="héllo"):
    return json.dumps({"id": i, "ts": "2024-01-01T00:00:00.000Z", "text": text}, ensure_ascii=False) + "\n"


def append(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as file:
        file.write(text.encode())


def taken(spark, folder, split_bytes=None):
    """Runs until nothing is left to take; ids so far."""
    rows = feed.stream_feed(spark, f"{folder}/in", split_bytes)
    for_each_batch(rows, ParquetBatches(f"{folder}/out"), f"{folder}/cp", None).awaitTermination()
    return [r["id"] for r in spark.read.parquet(f"{folder}/out").orderBy("id").collect()] if os.path.exists(f"{folder}/out") else []


def test_growing_files_are_read_once(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    append(f"{tmp_path}/in/_hidden", line(99))
    assert taken(spark, tmp_path) == []
    append(f"{tmp_path}/in/a", line(1) + "\n" + line(2) + line(3)[:20])
    assert taken(spark, tmp_path) == [1, 2]  # the third is still being written
    append(f"{tmp_path}/in/a", line(3)[20:] + line(4, "x" * 300_000) + line(5)[:-1])
    append(f"{tmp_path}/in/b", "".join(line(i) for i in range(10, 40)))
    assert taken(spark, tmp_path, 40_000) == [1, 2, 3, 4, *range(10, 40)]
    assert taken(spark, tmp_path) == [1, 2, 3, 4, *range(10, 40)]
    append(f"{tmp_path}/in/a", "\n")
    append(f"{tmp_path}/in/c", "no json\n")
    rows = taken(spark, tmp_path)
    assert rows == [None, 1, 2, 3, 4, 5, *range(10, 40)]
    texts = {r["id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert texts[1] == "héllo" and len(texts[4]) == 300_000 and texts[None] is None


@pytest.mark.parametrize("split", [1, 7, 40, 10**6])
def test_every_cut_gives_every_line_once(tmp_path, split):
    lines = ["", "a", "ü" * 30, "b" * 50, "", "c"]
    append(f"{tmp_path}/f", "".join(f"{x}\n" for x in lines) + "unfinished")
    reader = feed.FeedReader(str(tmp_path), split)
    spans = reader.partitions({}, reader.latestOffset())
    assert [x for s in spans for batch in reader.read(s) for x in batch.column(0).to_pylist()] == lines
    assert all(s.end - s.begin <= split for s in spans)


def test_a_file_that_shrinks_is_an_error(tmp_path):
    append(f"{tmp_path}/f", "abc\n")
    reader = feed.FeedReader(str(tmp_path), 10)
    assert reader.latestOffset() == {"f": 4}
    os.truncate(f"{tmp_path}/f", 1)
    with pytest.raises(ValueError, match="shorter"):
        reader.latestOffset()
    with pytest.raises(ValueError, match="shorter"):
        feed.FeedReader(str(tmp_path), 10).partitions({"f": 4}, {"f": 2})
