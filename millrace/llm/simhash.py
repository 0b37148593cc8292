"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has eight bytes, one at each position.  Two fingerprints that differ in at most ``bits`` bits
differ in at most as many bytes, so they share at least 8 - bits positional bytes.  The index lists each
fingerprint under every choice of 8 - bits positional bytes, so that a pair meets if and only if its tally
reaches that guaranteed minimum; pairs that meet are verified by their differing bits.  Only distinct
fingerprints are listed.  All in one list agree in 8 - bits bytes, so a list of distinct fingerprints holds
65,536 at most (for two bits), whatever the input; it is walked once and gives the links of a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import components, keyed, row_key
from millrace.session import staged

SHINGLE_SEED = 42


def fingerprint(text: str | None, size: int = 3, piece: int = 1 << 15) -> int:
    """Signed 64-bit fingerprint: a bit is set where over half of the shingles' XXH64 values have it.

    Words are cut at bytes 0x20 and 0x09 to 0x0D after A-Z are lower-cased; shingles count as often as they
    occur.  Fewer words than ``size`` are one shingle; no word (or null) gives 0.  Hashes are tallied in pieces of
    bounded size, so a long text needs little more memory than itself.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= size:
        hashes = np.array([digest(joined, SHINGLE_SEED)], np.uint64)
        return int(hashes.view(np.int64)[0])
    ends = list(accumulate(len(w) + 1 for w in found))
    begins = [0, *ends]
    n, counts = len(found) - size + 1, np.zeros(64, np.int64)
    for at in range(0, n, piece):
        to = min(at + piece, n)
        hashes = np.array([digest(joined[b : e - 1], SHINGLE_SEED) for b, e in zip(begins[at:to], ends[at + size - 1 : to + size - 1], strict=True)], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, the row's key and ``fp``; one pass, texts go no further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks, pa.int64())], names=["doc_id", "k1", "k2", "fp"])

    base = docs.select("doc_id", *row_key(docs), "text")
    schema = T.StructType([*base.schema.fields[:-1], T.StructField("fp", T.LongType(), False)])
    return base.mapInArrow(run, schema)


def list_links(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints of one list."""
    rest, links, queue = fps.copy(), [], []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        differing = (rest ^ at).view(np.uint64)  # signed values would be counted without their sign
        shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        near = (shared >= 8 - bits) & (np.bitwise_count(differing) <= bits)
        if near.any():
            found = rest[near]
            links += [(int(at), int(f)) for f in found]
            queue.extend(found)
            rest = rest[~near]
    return links


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """``a``, ``b``: links that connect what chains of at most ``bits`` differing bits connect (``distinct``: ``fp``)."""
    masks = [~np.int64(sum(0xFF << (8 * p) for p in gone) - (1 << 64 if 7 in gone else 0)) for gone in combinations(range(8), bits)]
    entries = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(int(m))).alias("kept")) for i, m in enumerate(masks)])
    listed = distinct.select("fp", F.explode(entries).alias("e")).select("e.list", "e.kept", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None

        def walk(number: np.ndarray, kept: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((kept[1:] != kept[:-1]) | (number[1:] != number[:-1])) + 1
            begins, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)]))
            out = [pair for b, e in zip(begins, ends, strict=True) if e - b > 1 for pair in list_links(fps[b:e], bits)]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            number, kept, _ = held
            last = np.flatnonzero((kept != kept[-1]) | (number != number[-1]))
            if len(last):  # all lists but the last are complete
                yield walk(*(c[: last[-1] + 1] for c in held))
                held = tuple(c[last[-1] + 1 :] for c in held)
        if held is not None:
            yield walk(*held)

    return listed.repartition("list", "kept").sortWithinPartitions("list", "kept", "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = 2) -> DataFrame:
    """``doc_id``, row key, ``fp``, ``component_id`` (smallest id reachable) for every row of ``docs``.

    Copies share a fingerprint and so one entry of the index.  A null id belongs to its component like others but is never
    its smallest, unless all are null (then null).  Rows without words have fingerprint 0 and link like others.
    """
    marked = staged(fingerprints(docs), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, bits))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(smallest, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, bits: int = 2) -> DataFrame:
    """One row of ``docs`` per component: the one with the smallest id (null last), of repeated rows one."""
    found = near_duplicates(docs, bits)
    group = F.when(F.col("component_id").isNotNull(), F.struct(F.lit(0).alias("kind"), F.col("component_id").alias("of"))).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("fp").alias("of"))
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")
    kept = found.groupBy(group.alias("g")).agg(F.min(order).alias("first")).select(F.col("first.k1").alias("_llm_k1"), F.col("first.k2").alias("_llm_k2")).distinct()
    key = ["_llm_k1", "_llm_k2"]
    return keyed(docs).join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)
