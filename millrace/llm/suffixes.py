"""Suffix-array deduplication of byte strings.

Bytes covered by a string of ``window`` bytes that starts anywhere else too are removed.  Windows meet by anchors (see
``repeats``); where runs differ, their bytes are bundled and sorted as suffixes in two stages: only
suffixes smaller than their successors are sorted directly, the others are induced by one scan over the buckets
of first bytes.  Common prefixes of neighbours in that order then show which windows occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.repeats import Kind, joined_spans, mixed, repeated_windows

_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


def words_at(text: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from each position on, big-endian; zeros follow the text."""
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8))).astype(np.uint64)
    n, out = len(text) + depth, np.zeros(len(text) + depth, np.uint64)
    for k in range(8):
        out |= padded[k : k + n] << np.uint64(56 - 8 * k)
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; equal bytes follow the next byte that differs."""
    n = len(text)
    step = np.sign(np.append(text[1:].astype(np.int16), -1) - text.astype(np.int16))
    nearest = np.where(step != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    return step[nearest] > 0


def sort_directly(starts: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their first ``depth`` bytes: eight bytes a round, ties only go on."""
    order = starts[np.argsort(words[starts], kind="stable")]
    if not len(order):
        return order
    key = words[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    for at in range(8, depth, 8):
        group = np.cumsum(new) - 1
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        key = words[order[tied] + at]
        sorting = np.lexsort((key, group[tied]))
        order[tied], key, of = order[tied][sorting], key[sorting], group[tied]
        new[tied] = np.concatenate(([True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])))
    return order


def suffix_array(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    words = words_at(text, depth) if words is None else words
    smaller = smaller_than_next(text)
    direct = sort_directly(np.flatnonzero(smaller), words, depth)
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def hand_on(chunk: np.ndarray, byte: int) -> np.ndarray:
        """Sends the predecessors of a scanned chunk to their buckets; those of the same bucket are returned."""
        before = chunk[chunk > 0] - 1
        before = before[~smaller[before]]
        of = text[before]
        here = before[of == byte]
        rest, of = before[of > byte], of[of > byte]
        for value in np.unique(of):
            induced[value].append(rest[of == value])
        return here

    induced[text[-1]].append(np.array([n - 1]))  # the empty suffix is scanned first
    out: list[np.ndarray] = []
    for byte in range(256):
        chunk = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        while len(chunk):
            out.append(chunk)
            chunk = hand_on(chunk, byte)
        chunk = direct[bounds[byte] : bounds[byte + 1]]
        if len(chunk):
            out.append(chunk)
            hand_on(chunk, byte)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix and the next one in ``order``, up to ``depth`` bytes."""
    left, right = order[:-1], order[1:]
    out, alive = np.zeros(len(left), np.int64), np.arange(len(left))
    for at in range(0, depth, 8):
        differing = words[left[alive] + at] ^ words[right[alive] + at]
        same = np.zeros(len(alive), np.int64)
        for k in range(1, 9):
            same += differing >> np.uint64(64 - 8 * k) == 0
        out[alive] += same
        alive = alive[same == 8]
        if not len(alive):
            break
    return np.minimum(out, depth)


def found_again(pieces: pd.DataFrame, window: int) -> list[list[tuple[int, int]]]:
    """For each piece the runs of its windows (first, end) that start at another place of the bundle too."""
    sizes = np.array([len(u) for u in pieces["units"]])
    text = np.frombuffer(b"".join(pieces["units"]), np.uint8)
    words = words_at(text, window)
    order = suffix_array(text, window, words)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    begin = np.cumsum(sizes) - sizes
    offset = np.arange(len(text)) - begin[piece]
    order = order[offset[order] < pieces["n"].to_numpy()[piece[order]]]
    long = common_prefixes(order, words, window) >= window
    twice = np.zeros(len(text) + 1, bool)
    twice[order[:-1][long]] = twice[order[1:][long]] = True
    out = []
    for at, n in zip(begin, pieces["n"], strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate(([False], twice[at : at + n], [False])).astype(np.int8)))
        out.append([(int(b), int(e)) for b, e in zip(edges[::2], edges[1::2], strict=True)])
    return out


def byte_codes(text: str) -> np.ndarray:
    return _CODES[np.frombuffer(text.encode(), np.uint8)]


def byte_slices(text: str, spans: list[tuple[int, int]]) -> list[bytes]:
    raw = text.encode()
    return [raw[b:e] for b, e in spans]


def kind(window: int, most: int = 2000) -> Kind:
    return Kind(window, max(window // 5, 1), most, most, False, byte_codes, byte_slices, lambda units, b, e: units[b:e], lambda rows: found_again(rows, window))


def without_repeats(docs: DataFrame, window: int = 200, most: int = 2000, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, binary) for every row of ``docs``.

    Texts are taken as UTF-8 bytes, null as empty; ``n_spans`` counts maximal removed runs.  Texts shorter than ``window`` stay as they are.
    Repeated rows are removed whole, from ``window`` bytes on, like all copies.  Ids may be null or repeated.  An empty table gives no rows.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.lit(0).cast("long").alias("doc"))
    spans = repeated_windows(keyed, kind(window, most))
    rows = keyed.join(spans, "k1", "left").select("doc_id", "text", "spans")
    schema = T.StructType(
        [
            *rows.schema.fields[:1],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept", T.BinaryType())] if keep_text else []),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema.names[1:]]
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw, gone = (text.as_py() or "").encode(), joined_spans([(s["b"], s["e"]) for s in found.as_py() or []])
                ends = [0, *[x for span in gone for x in span], len(raw)]
                kept = b"".join(raw[b:e] for b, e in zip(ends[::2], ends[1::2], strict=True))
                values = [len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept]
                for column, value in zip(out, values[: len(out)], strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(out, types[: len(out)], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    return rows.mapInArrow(cut, schema)
