"""What the two substring operators share: meeting places for equal windows without a row per window.

A document is a sequence of units (bytes or words).  Every window of ``window`` units holds span = window - gram + 1
grams; the one with the smallest hash is the window's anchor, so equal windows have equal anchors at equal
distances.  Neighbouring windows share anchors, in runs of about span / 2 windows, and a run is what
documents send: its gram's hash (``fp``), a hash of all its units (``sh``) and its place.  Runs alone with their gram
are unique.  Runs that are equal as a whole settle each other by counting.  Only runs that share a gram but
differ (where a repeated stretch begins or ends) need their units: one run of each kind is fetched, and a
solver compares those of one gram inside bundles of bounded size.

A gram that meets in more than ``most`` different runs (a passage that a third of all documents hold, after
different beginnings) is not sent to one bundle: its runs are halved.  All windows of a half share the units in
its middle, so halves meet by the hash of these; equal halves settle by counting, halves without a
partner go, and the rest is halved again until groups are small or windows single.  That is exact, has no
cap, and writes at most two rows per run and round.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
PLACE_BITS = np.uint64(26)
#: Windows of a text that are anchored at a time; runs are cut there, which costs nothing but two kinds of a run.
STRETCH = 1 << 22


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all ``width`` consecutive codes, by doubling."""
    out, out_width, power, power_width, base = None, 0, codes, 1, BASE
    rest = width
    while rest:
        if rest & 1:
            if out is None:
                out, out_width = power, power_width
            else:
                n = len(codes) - out_width - power_width + 1
                out = out[:n] * base + power[out_width : out_width + n]
                out_width += power_width
        rest >>= 1
        if rest:
            n = len(power) - power_width
            power = power[:n] * base + power[power_width : power_width + n]
            power_width, base = 2 * power_width, base * base
    return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size : width - size + n])


def runs(codes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``begin, n, off, fp, sh`` of the runs of a document: first window, windows, anchor's distance, hashes."""
    empty = np.zeros(0, np.int64)
    parts = [(empty, empty, empty, empty, empty)]
    with np.errstate(over="ignore"):
        for at in range(0, max(len(codes) - window + 1, 0), STRETCH):
            piece = codes[at : at + STRETCH + window - 1]
            grams, whole = mixed(rolled(piece, gram)), rolled(piece, window)
            ranked = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
            anchor = (sliding_least(ranked, window - gram + 1) & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
            begin = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            end = np.concatenate((begin[1:], [len(anchor)]))
            n, off = end - begin, anchor[begin] - begin
            sh = mixed(whole[begin] + mixed(whole[end - 1]) + (n * 4096 + off).astype(np.uint64))
            parts.append((begin + at, n, off, grams[anchor[begin]].view(np.int64), sh.view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass(frozen=True)
class Kind:
    """What tells the operators apart.

    ``codes``: text to one 64-bit code per unit.  ``slices``: text and spans of units to their bytes.  ``split``: such bytes
    and a span of units to its bytes.  ``ordered``: a window counts against documents with larger ids only.  ``solve``: pieces of
    one bundle (columns ``PIECE``) to the runs of windows found again.  A group of up to ``most`` pieces is solved in one bundle.
    """

    window: int
    gram: int
    most: int
    bundle: int
    ordered: bool
    codes: Callable[[str], np.ndarray]
    slices: Callable[[str, list[tuple[int, int]]], list[bytes]]
    split: Callable[[bytes, int, int], bytes]
    solve: Callable[[pd.DataFrame], list[list[tuple[int, int]]]]


def all_runs(keyed: DataFrame, kind: Kind) -> DataFrame:
    """``fp, sh, place, k1, doc``: ``place`` packs begin, n and off; ``keyed`` has ``k1, doc, text``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "doc"))
            found, counts = [], []
            for text in batch.column("text"):
                found.append(runs(kind.codes(text.as_py() or ""), kind.window, kind.gram))
                counts.append(len(found[-1][0]))
            begin, n, off, fp, sh = (np.concatenate(x) for x in zip(*found, strict=True))
            place = (begin << 20) | (n << 10) | off
            columns = [fp, sh, place, np.repeat(k1, counts), np.repeat(doc, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["fp", "sh", "place", "k1", "doc"])

    return keyed.select("k1", "doc", "text").mapInArrow(send, "fp long, sh long, place long, k1 long, doc long")


PIECE = "meet long, fp long, sh long, shape long, lo int, n int, copies long, least long, units binary"


def fetched(keyed: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """Pieces with their units: one text per kind of run is cut where ``wanted`` says."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, rows in zip(batch.column("text"), batch.column("rows"), strict=True):
                rows = rows.as_py()
                if not rows:
                    continue
                ends = [((r["place"] >> 20), (r["place"] >> 20) + (r["place"] >> 10 & 1023) + kind.window - 1) for r in rows]
                frame = {
                    "meet": [r["fp"] for r in rows],
                    "fp": [r["fp"] for r in rows],
                    "sh": [r["sh"] for r in rows],
                    "shape": [r["place"] & 0xFFFFF for r in rows],
                    "lo": [0] * len(rows),
                    "n": [r["place"] >> 10 & 1023 for r in rows],
                    "copies": [r["copies"] for r in rows],
                    "least": [r["least"] for r in rows],
                    "units": kind.slices(text.as_py(), ends),
                }
                yield pa.RecordBatch.from_pydict(frame, schema=PIECE_ARROW)

    lists = wanted.groupBy("k1").agg(F.collect_list(F.struct("fp", "sh", "place", "copies", "least")).alias("rows"))
    texts = keyed.select("k1", "text").join(lists, "k1").dropDuplicates(["k1"])
    return texts.select("text", "rows").mapInArrow(cut, PIECE)


PIECE_ARROW = pa.schema(
    [
        *[(c, pa.int64()) for c in ("meet", "fp", "sh", "shape")],
        ("lo", pa.int32()),
        ("n", pa.int32()),
        *[(c, pa.int64()) for c in ("copies", "least")],
        ("units", pa.binary()),
    ]
)


def halved(pieces: DataFrame, kind: Kind, size: int) -> DataFrame:
    """Pieces cut where their windows' distance to the anchor passes a multiple of ``size``.

    Distances below one another's multiple are a cell; all windows of a cell share the units around the anchor, and equal windows
    are in equal cells, so pieces of a cell meet by a hash of what they share.
    """
    span = kind.window - kind.gram + 1

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in batch.schema.names}
            for row in batch.to_pylist():
                far = (row["shape"] & 1023) - row["lo"]  # distance of the first window
                for cell in range((far - row["n"] + 1) // size, far // size + 1):
                    lo, hi = max(far - (cell + 1) * size + 1, 0), min(far - cell * size + 1, row["n"])
                    core = kind.split(row["units"], far - cell * size, far - min((cell + 1) * size, span) + 1 + kind.window)
                    key = xxhash.xxh64_intdigest(core + struct.pack("<qi", row["meet"], cell))
                    new = {"meet": key - (1 << 64) if key >> 63 else key, "lo": row["lo"] + lo, "n": hi - lo}
                    new["units"] = kind.split(row["units"], lo, hi - 1 + kind.window)
                    for c in out:
                        out[c].append(new.get(c, row[c]))
            yield pa.RecordBatch.from_pydict(out, schema=batch.schema)

    return pieces.mapInArrow(halve, PIECE)


def settled(pieces: DataFrame, kind: Kind) -> DataFrame:
    """``fp, sh, shape, lo, n``: the windows of ``pieces`` (distinct within ``meet``) that are found again."""

    def bundle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        spans = kind.solve(rows)
        at = [i for i, found in enumerate(spans) for _ in found]
        out = rows.loc[at, ["fp", "sh", "shape", "lo"]].reset_index(drop=True)
        flat = [s for found in spans for s in found]
        out["lo"] = (out["lo"] + [s[0] for s in flat]).astype("int32")
        out["n"] = np.array([s[1] - s[0] for s in flat], np.int32)
        return out

    found = []
    size = 1 << (kind.window - kind.gram).bit_length()
    while True:
        number = F.count_distinct(F.xxhash64("units"), F.col("shape").bitwiseAND(F.lit(1023)) - F.col("lo")) if found else F.count(F.lit(1))
        counts = staged(pieces.groupBy("meet").agg(number.alias("kinds")).where("kinds > 1"), "kinds")
        totals = counts.agg(
            F.coalesce(F.sum(F.when(F.col("kinds") <= kind.most, F.col("kinds"))), F.lit(0)).alias("small"), F.count(F.when(F.col("kinds") > kind.most, 1)).alias("hot")
        ).first()
        bundles = max(totals["small"] // kind.bundle, 1)
        small = pieces.join(counts.where(F.col("kinds") <= kind.most), "meet").withColumn("bundle", F.pmod(F.xxhash64("meet"), F.lit(bundles)))
        found.append(staged(small.drop("kinds").groupBy("bundle").applyInPandas(bundle, "fp long, sh long, shape long, lo int, n int"), "settled"))
        if not totals["hot"]:
            break
        hot = pieces.join(counts.where(F.col("kinds") > kind.most), "meet").drop("kinds").select(*pieces.columns)
        size //= 2  # down to single windows, which are all equal where they meet
        halves = halved(hot, kind, size).withColumn("content", F.xxhash64("units")).withColumn("far", F.col("shape").bitwiseAND(F.lit(1023)) - F.col("lo"))
        halves = staged(halves, "halves")
        same = ["meet", "content", "n", "far"]
        equal = halves.groupBy(*same).agg(
            F.sum("copies").alias("all_copies"), F.min("least").alias("all_least"), F.min(F.struct("least", "fp", "sh", "shape", "lo")).alias("one")
        )
        equal = staged(equal, "equal-halves")
        again = halves.join(equal, same)
        found.append(again.where("least > all_least" if kind.ordered else "copies = 1 AND all_copies > 1").select("fp", "sh", "shape", "lo", "n"))
        # one piece goes on for all equal ones; in ordered search all of the smallest document, as they share their fate
        first = F.struct("least", "fp", "sh", "shape", "lo") == F.col("one")
        pieces = again.where(F.col("least") == F.col("all_least") if kind.ordered else first).select("meet", "fp", "sh", "shape", "lo", "n", F.col("all_copies").alias("copies"), F.col("all_least").alias("least"), "units")
        pieces = staged(pieces, "pieces")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def repeated_windows(keyed: DataFrame, kind: Kind) -> DataFrame:
    """``k1``, ``spans`` (array of begin, end in units, end exclusive, of covered stretches) of documents that have any.

    ``keyed`` has ``k1`` (stands for a row's id and text), ``doc`` (id, not null) and ``text``.  Unordered: windows that start
    at two places at least.  Ordered: windows that start in a document with a smaller ``doc``, too.
    """
    every = all_runs(keyed, kind)
    # written first, so that both sides of the join are plain exchanges and a gram with a third of all runs is split
    again = staged(every.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp"), "grams")
    meeting = staged(every.join(again, "fp"), "meeting-runs").withColumn("shape", F.col("place").bitwiseAND(F.lit(0xFFFFF)))
    content = ["fp", "sh", "shape"]
    contents = meeting.groupBy(*content).agg(F.count(F.lit(1)).alias("copies"), F.min("doc").alias("least"), F.min(F.struct("doc", "k1", "place")).alias("one"))
    contents = staged(contents, "contents")
    mixed_grams = contents.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("fp")
    wanted = contents.join(mixed_grams, "fp").select("one.k1", "fp", "sh", "one.place", "copies", "least")
    pieces = staged(fetched(keyed, wanted, kind), "pieces")
    parts = settled(pieces, kind).groupBy(*content).agg(F.collect_set(F.struct("lo", "n")).alias("parts"))
    facts = contents.join(parts, content, "left").select(*content, "copies", "least", "parts")
    facts = staged(facts.where("copies > 1 OR parts IS NOT NULL"), "facts")
    begin, n = F.shiftrightunsigned("place", 20), F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    whole = F.col("doc") > F.col("least") if kind.ordered else F.col("copies") > 1
    windows = F.when(whole, F.array(F.struct(F.lit(0).alias("lo"), n.cast("int").alias("n")))).otherwise(F.col("parts"))
    marked = meeting.join(facts, content).select("k1", begin.cast("long").alias("begin"), F.explode(windows).alias("w"))
    marked = marked.select("k1", F.struct((F.col("begin") + F.col("w.lo")).alias("b"), (F.col("begin") + F.col("w.lo") + F.col("w.n") + kind.window - 1).alias("e")).alias("s"))
    return marked.groupBy("k1").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for b, e in spans:
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out
