"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import staged

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text: ``bytes.split`` cuts at exactly the bytes 0x20 and 0x09 to 0x0D."""
    return (text or "").encode().split()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_count(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def unit_hash(*columns: str) -> Column:
    """A number in [0, 1) that the columns' values decide."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def null_safe_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on equally named columns in which nulls are equal; the keys come from the left side."""
    right = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[f"_right_{n}"])
    return left.join(right, condition, how).drop(*[f"_right_{n}" for n in names])


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str] = ()) -> DataFrame:
    """Adds ``place`` (rows before, among those with the same ``keys``) and ``before_<v>`` (their sum of ``v``).

    The order is total over the whole table without any task that holds a whole key: rows are dealt by range
    over key and order, numbered inside each range, written once, and each range then gets the sums of the
    ranges before it.  A key with a third of all rows spreads over a third of the ranges.  ``values`` are
    longs without nulls; rows that tie in ``order`` get different places.
    """
    base = df.withColumn("_group", F.xxhash64(*keys) if keys else F.lit(0).cast("long"))
    ordering = [F.col("_group"), *[F.col(k).asc() for k in keys], *order]
    names = ["place", *[f"before_{v}" for v in values]]
    schema = T.StructType([*base.schema.fields, T.StructField("_part", T.LongType(), False)])
    for name in names:
        schema = schema.add(name, T.LongType(), False)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, [0] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group = batch.column("_group").to_numpy(zero_copy_only=False)
            begins = np.concatenate(([True], group[1:] != group[:-1]))
            start = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
            first = (start == 0) if group[0] == last else np.zeros(n, bool)
            columns, ends = [], []
            steps = [np.ones(n, np.int64), *(batch.column(v).to_numpy(zero_copy_only=False) for v in values)]
            for held, step in zip(carried, steps, strict=True):
                total = np.cumsum(step)
                before = total - step
                before = before - before[start] + np.where(first, held, 0)
                columns.append(pa.array(before, pa.int64()))
                ends.append(int(before[-1] + step[-1]))
            last, carried = group[-1], ends
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int64)), *columns],
                names=[*batch.schema.names, "_part", *names],
            )

    table = staged(base.repartitionByRange(*ordering).sortWithinPartitions(*ordering).mapInArrow(number, schema), "running")
    sums = [F.count(F.lit(1)).alias("_n0"), *[F.sum(v).alias(f"_n{i + 1}") for i, v in enumerate(values)]]
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy("_group", "_part")
        .agg(*sums)
        .select("_group", "_part", *[F.coalesce(F.sum(f"_n{i}").over(earlier), F.lit(0)).alias(f"_o{i}") for i in range(len(names))])
    )
    joined = table.join(offsets, ["_group", "_part"])
    return joined.select(*df.columns, *[(F.col(name) + F.col(f"_o{i}")).alias(name) for i, name in enumerate(names)])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of the undirected ``edges`` (a, b): the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which end after a number of
    rounds logarithmic in the number of nodes.  Each round is two grouped minima and two joins on all
    edges at once and is written to the shared folder, so the plan stays short and a lost executor costs
    one round.  Nothing reaches the driver but two sums that tell whether anything changed.
    """
    current = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    for _ in range(most_rounds):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        current = staged(small.where("a <> b").distinct(), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = now
    raise RuntimeError("the components did not settle")


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """``k1``, ``k2``: 128 bits that stand for a row's id and text, never null; equal rows have equal keys."""
    return F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with its row key under names that no table should have."""
    first, second = row_key(docs)
    return docs.select("*", first.alias("_llm_k1"), second.alias("_llm_k2"))
