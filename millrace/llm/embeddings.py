"""Near-duplicate vectors by a subspace join.

Unit vectors with cosine >= c have projections on any subspace that are as near.  All vectors are turned by one random
rotation and split into ``blocks`` low-dimensional blocks; the first half of the blocks is the subspace.  With the length of the
rest as one coordinate more, the product of two projections is an upper bound of the cosine, so a product
of two thin matrices leaves few pairs of a tile; the full cosine in double precision verifies them.

The vectors are written once, in runs: single rows that hold a bounded number of bytes of vectors of one dimension,
ordered by label.  Every pair of runs with a label in common meets in one task, which reads both from the shared folder
(a Cartesian product has no shuffle), so a vector is neither shuffled nor written again for each tile it is in.

Equal vectors of a label are one class from the start.  A task gives link counts and a spanning forest of its
links; pairs are never written.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import components
from millrace.session import scratch_path, setting, staged

#: Bytes of vectors in a run, and of the runs that a task holds against the runs it reads one by one.
RUN, GROUP = 1 << 23, 1 << 25
#: So many groups of runs are compared in one job.
ROUND = 32
#: Bytes that end a batch for Python: less than a pair of full runs, so that it goes alone.
BATCH = "8m"
#: Leading coordinates whose signs order the vectors of a run.
SIGNS = 16
#: Rows that are in double precision at once.
PIECE = 1 << 12
#: What a task gets of either run of a pair.
PAIRED = ("first", "dim", "kind", "labels", "n", "vectors")


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def edges_of(dim: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dim, min(blocks, dim) + 1).round().astype(int)


def slack(terms: int) -> float:
    """More than the rounding of a product of unit vectors in single precision."""
    return (terms + 16) * 2.0**-22


def roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while not np.array_equal(found, above := parent[found]):
        found = above
    parent[nodes] = found
    return found


def join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Joins the trees of ``a`` and ``b`` in ``parent``; the links that did it, which form a forest."""
    used = []
    while True:
        p, q = roots(parent, a), roots(parent, b)
        apart = p != q
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        if not len(a):
            return used
        high, at = np.unique(np.maximum(p, q), return_index=True)
        parent[high] = np.minimum(p, q)[at]
        used.append((a[at], b[at]))


def join_all(parent: np.ndarray, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for all links of a matrix over the nodes ``a`` and ``b``."""
    rows, columns = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    p, q = roots(parent, a[rows]), roots(parent, b[columns])
    if (p == p[0]).all() and (q == p[0]).all():
        return []
    used = join(parent, a[rows], b[linked[rows].argmax(1)]) + join(parent, a[linked[:, columns].argmax(0)], b[columns])
    x, y = np.nonzero(linked & (roots(parent, a)[:, None] != roots(parent, b)))
    return used + join(parent, a[x], b[y])


class Run:
    """The vectors of a run, their projections and where each label lies; ``order`` has the places they have in the run.

    Within a label, vectors whose leading coordinates have the same signs stand together, so that groups of near vectors fill few tiles.
    """

    def __init__(self, row: dict[str, pa.Scalar], blocks: int):
        dim = row["dim"].as_py()
        self.first, self.n = row["first"].as_py(), row["n"].values.to_numpy()
        self.labels, at = {}, 0
        for label, same in groupby(None if x != x else x for x in row["labels"].as_py()):  # not-a-number equals itself
            self.labels[label] = (at, at := at + len(list(same)))
        self.raw = np.frombuffer(row["vectors"].as_buffer(), row["kind"].as_py()).reshape(-1, dim)
        half, turn = self.edge(dim, blocks), rotation(dim)
        unit, part, signs = np.empty(self.raw.shape, np.float32), np.empty((len(self.raw), half + 1), np.float32), np.empty(len(self.raw), np.int64)
        for at in range(0, len(unit), PIECE):
            piece = slice(at, at + PIECE)
            exact = self.scaled(piece)
            exact /= np.linalg.norm(exact, axis=1, keepdims=True)
            turned = exact @ turn
            unit[piece], part[piece, :half] = exact, turned[:, :half]
            part[piece, half] = np.sqrt(np.maximum(0, 1 - (turned[:, :half] ** 2).sum(1)))
            signs[piece] = (turned[:, :SIGNS] > 0) @ (1 << np.arange(min(dim, SIGNS)))
        label_at = np.repeat(np.arange(len(self.labels)), [e - s for s, e in self.labels.values()])
        self.order = np.lexsort((signs, label_at))
        self.raw, self.unit, self.part = self.raw[self.order], unit[self.order], part[self.order]

    @staticmethod
    def edge(dim: int, blocks: int) -> int:
        """Where the first half of the blocks ends."""
        edges = edges_of(dim, blocks)
        return int(edges[max(1, (len(edges) - 1) // 2)])

    def scaled(self, at) -> np.ndarray:
        raw = self.raw[at].astype(np.float64)
        raw /= np.abs(raw).max(1, keepdims=True)
        return raw


def cosines(a: Run, b: Run, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosines of pairs, in double precision."""
    out = np.empty(len(x))
    for at in range(0, len(x), PIECE):
        p, q = a.scaled(x[at : at + PIECE]), b.scaled(y[at : at + PIECE])
        out[at : at + PIECE] = (p * q).sum(1) / (np.sqrt((p**2).sum(1)) * np.sqrt((q**2).sum(1)))
    return out


def links(a: Run, b: Run, least: float, tile: int) -> Iterator[tuple[int, int, np.ndarray | tuple[np.ndarray, np.ndarray]]]:
    """The links of two runs or, if they are one, within it: positions of pairs, or where they are dense a matrix from a position on."""
    bound, band = least - slack(a.part.shape[1]), slack(a.raw.shape[1])
    for label in a.labels.keys() & b.labels.keys():
        (a0, a1), (b0, b1) = a.labels[label], b.labels[label]
        if a is b and a1 - a0 < 2:
            continue
        thin = np.ascontiguousarray(b.part[b0:b1].T)
        for s in range(a0, a1, tile):
            left = slice(s, min(s + tile, a1))
            for t in range(s if a is b else b0, b1, tile):
                right = slice(t, min(t + tile, b1))
                most = a.part[left] @ thin[:, t - b0 : right.stop - b0]
                if most.max() < bound:
                    continue
                near = most >= bound
                if a is b and s == t:
                    near = np.triu(near, 1)
                n = np.count_nonzero(near)
                if n * 64 < near.size:
                    x, y = np.divmod(np.flatnonzero(near), near.shape[1])
                    x, y = x + s, y + t
                    full = np.einsum("ij,ij->i", a.unit[x], b.unit[y])
                    linked = full >= least + band
                    open_ = np.flatnonzero(~linked & (full >= least - band))
                    linked[open_] = cosines(a, b, x[open_], y[open_]) >= least
                    if linked.any():
                        yield s, t, (x[linked], y[linked])
                else:
                    full = a.unit[left] @ b.unit[right].T
                    linked = near & (full >= least + band)
                    x, y = np.nonzero(near & ~linked & (full >= least - band))
                    linked[x, y] = cosines(a, b, x + s, y + t) >= least
                    if linked.any():
                        yield s, t, linked


class Tally:
    """Link counts of the classes in some runs, and a forest of their links."""

    def __init__(self) -> None:
        self.at: dict[int, int] = {}
        self.node, self.n, self.counts, self.parent = (np.zeros(0, np.int64) for _ in range(4))
        self.forest: list[tuple[np.ndarray, np.ndarray]] = []

    def place(self, run: Run) -> int:
        if run.first not in self.at:
            size, held = len(run.n), len(self.node)
            self.at[run.first] = held
            self.node = np.concatenate((self.node, run.first + np.arange(size)))
            self.n = np.concatenate((self.n, run.n))
            self.counts = np.concatenate((self.counts, np.zeros(size, np.int64)))
            self.parent = np.concatenate((self.parent, held + np.arange(size)))
        return self.at[run.first]

    def add(self, a: Run, b: Run, least: float, tile: int) -> None:
        p, q = self.place(a), self.place(b)
        for s, t, found in links(a, b, least, tile):
            if isinstance(found, tuple):
                x, y = a.order[found[0]] + p, b.order[found[1]] + q
                np.add.at(self.counts, x, self.n[y])
                np.add.at(self.counts, y, self.n[x])
                self.forest += join(self.parent, x, y)
            else:
                x, y = a.order[s : s + found.shape[0]] + p, b.order[t : t + found.shape[1]] + q
                self.counts[x] += summed(found, self.n[y])
                self.counts[y] += summed(found.T, self.n[x])
                self.forest += join_all(self.parent, x, y, found)

    def batches(self, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(self.counts)
        a, b = (np.concatenate([x[i] for x in self.forest]) if self.forest else np.zeros(0, np.int64) for i in (0, 1))
        for node, other, count in ((self.node[some], None, self.counts[some]), (self.node[a], self.node[b], np.zeros(len(a), np.int64))):
            for at in range(0, len(node), size):
                part = slice(at, at + size)
                others = pa.nulls(len(node[part]), pa.int64()) if other is None else pa.array(other[part])
                yield pa.RecordBatch.from_arrays([pa.array(node[part]), others, pa.array(count[part])], names=["node", "other", "links"])


def summed(linked: np.ndarray, n: np.ndarray) -> np.ndarray:
    if (n == 1).all():
        return np.count_nonzero(linked, axis=1)
    return np.where(linked, n, 0).sum(1)


def keys(vectors: DataFrame) -> DataFrame:
    """``vectors`` with 128 bits that stand for label and vector; rows without either get some that no class has."""
    lone = F.col("label").isNull() | F.col("embedding").isNull()
    first = F.when(lone, F.xxhash64("vec_id")).otherwise(F.xxhash64("label", "embedding"))
    second = F.when(lone, F.lit(None)).otherwise(F.xxhash64(F.lit(1), "label", "embedding"))
    return vectors.select("vec_id", "label", "embedding", first.alias("k1"), second.alias("k2"))


def classes_of(vectors: DataFrame) -> DataFrame:
    """``dim, label, k1, k2, embedding, least, n``: the distinct comparable vectors of each label, ordered by range."""
    usable = keys(vectors).where(
        "label IS NOT NULL AND embedding IS NOT NULL AND exists(embedding, x -> x <> 0) AND "
        "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    )
    usable = usable.select("label", "k1", "k2", "embedding", F.col("vec_id").cast("long").alias("least"), F.lit(1).cast("long").alias("n"))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A vector that fills a table is one row per batch."""
        for batch in batches:
            at = pa.array(np.arange(batch.num_rows))
            table = pa.table({**{c: batch.column(c) for c in ("k1", "k2", "least", "n")}, "at": at})
            found = table.group_by(["k1", "k2"], use_threads=False).aggregate([("least", "min"), ("n", "sum"), ("at", "min")])
            if len(found) < batch.num_rows:
                kept = batch.take(found["at_min"].combine_chunks())
                columns = [kept.column(c) for c in ("label", "k1", "k2", "embedding")]
                columns += [found[c].combine_chunks().cast(pa.int64()) for c in ("least_min", "n_sum")]
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    order = ["dim", "label", "k1", "k2"]
    thinned = usable.mapInArrow(thin, usable.schema).withColumn("dim", F.size("embedding"))
    ranged = thinned.repartitionByRange(*order).sortWithinPartitions(*order)
    grouped = ranged.groupBy(*order).agg(F.any_value("embedding").alias("embedding"), F.min("least").alias("least"), F.sum("n").alias("n"))
    return grouped.sortWithinPartitions(*order)


def runs_of(classes: DataFrame, size: int) -> DataFrame:
    """The classes written as runs: rows of ``size`` bytes of vectors of one length, ordered by label; node ``first + i`` is the ``i``-th class of a run."""
    fields = {f.name: f.dataType for f in classes.schema.fields}
    kind = "f4" if isinstance(fields["embedding"].elementType, T.FloatType) else "f8"
    label = fields["label"].simpleString()
    lists = ["labels", "k1", "k2", "least", "n"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first, held, rows, dim, most = part << 33, [], 0, None, 0

        def run() -> pa.RecordBatch:
            whole = {c: pa.concat_arrays([b.column("label" if c == "labels" else c) for b in held]) for c in lists}
            vectors = b"".join(b.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).tobytes() for b in held)
            ends, labels = pa.array([0, rows], pa.int32()), whole["labels"]
            columns = [pa.array([first]), pa.array([dim], pa.int32()), pa.array([kind]), labels.slice(0, 1), labels.slice(rows - 1)]
            columns += [pa.ListArray.from_arrays(ends, whole[c]) for c in lists] + [pa.array([vectors], pa.binary()), pa.array([part], pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["first", "dim", "kind", "low", "high", *lists, "vectors", "part"])

        for batch in batches:
            dims, at = batch.column("dim").to_numpy(), 0
            while at < len(dims):
                if held and (dims[at] != dim or rows >= most):
                    yield run()
                    first, held, rows = first + rows, [], 0
                dim = int(dims[at])
                most = max(1, size // (dim * int(kind[1])))
                same = int(np.argmax(np.append(dims[at:] != dim, True)))
                held.append(batch.slice(at, min(same, most - rows)))
                rows += held[-1].num_rows
                at += held[-1].num_rows
        if held:
            yield run()

    schema = f"first long, dim int, kind string, low {label}, high {label}, labels array<{label}>, k1 array<long>, k2 array<long>, least array<long>, n array<long>, vectors binary, part int"
    packed = classes.mapInArrow(pack, schema)
    path = scratch_path(classes.sparkSession, "runs")
    # few runs in a row group, as readers hold a group at a time
    packed.write.partitionBy("part").option("parquet.block.row.count.limit", "2").parquet(path)
    return classes.sparkSession.read.schema(packed.schema).parquet(path)


def link_results(runs: DataFrame, least: float, blocks: int, tile: int, group: int) -> DataFrame:
    """``node, other, links``: partial link counts (``other`` null) and forest edges (``links`` 0)."""
    spark = runs.sparkSession
    size = F.sum(F.octet_length("vectors").cast("long")).alias("bytes")
    spans = staged(runs.groupBy("part", "dim").agg(size, F.min("low").alias("low"), F.max("high").alias("high")), "spans")
    sizes = spans.groupBy("part").agg(F.sum("bytes").alias("bytes")).collect()
    earlier = spans.select(F.col("part").alias("start"), "dim", F.col("low").alias("from"), F.col("high").alias("to"))
    shared = spans.join(earlier, "dim").where("start <= part AND low <= to AND from <= high")
    starts = {r["part"]: r["start"] for r in shared.groupBy("part").agg(F.min("start").alias("start")).collect()}
    groups: list[list[int]] = []  # first part, last part, first part that has a label of theirs, bytes
    for part, held in sorted((r["part"], r["bytes"]) for r in sizes):
        if groups and groups[-1][3] + held <= group:
            groups[-1] = [groups[-1][0], part, min(groups[-1][2], starts[part]), groups[-1][3] + held]
        else:
            groups.append([part, part, starts[part], held])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, held = Tally(), None
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = ({c: batch.column(f"{side}_{c}")[i] for c in PAIRED} for side in "lr")
                held = held if held and held.first == a["first"].as_py() else Run(a, blocks)
                same = held.first == b["first"].as_py()
                tally.add(held, held if same else Run(b, blocks), least, tile)
        yield from tally.batches()

    def side(first: int, last: int, name: str) -> DataFrame:
        some = runs.where(F.col("part").between(first, last))
        return some.select(*[F.col(c).alias(f"{name}_{c}") for c in ("low", "high", *PAIRED)])

    meet = F.expr("l_dim = r_dim AND l_first <= r_first AND l_low <= r_high AND r_low <= l_high")
    schema, found = "node long, other long, links long", []
    for at in range(0, len(groups), ROUND):
        pairs = [side(start, last, "l").join(side(first, last, "r").coalesce(1).hint("shuffle_replicate_nl"), meet) for first, last, start, _ in groups[at : at + ROUND]]
        with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH):
            found.append(staged(reduce(DataFrame.union, pairs).drop("l_low", "l_high", "r_low", "r_high").mapInArrow(compare, schema), "links"))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def near_duplicates(vectors: DataFrame, least: float = 0.93, blocks: int = 4, tile: int = 1024, run: int = RUN, group: int = GROUP) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Links join vectors of equal, non-null label and equal length with cosine >= ``least``.  Vectors that are null, empty, zero or hold
    null or non-finite components have no link and are components of their own, as do rows without a label.  A null id is never the smallest
    of its component unless alone (then null, and kept).  Repeated rows link with each other.
    """
    if vectors.schema["embedding"].dataType.elementType not in (T.FloatType(), T.DoubleType()):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    runs = runs_of(classes_of(vectors), run)
    results = link_results(runs, least, blocks, tile, group)
    listed = runs.select("first", F.posexplode(F.arrays_zip("k1", "k2", "least", "n")).alias("i", "of"))
    classes = listed.select((F.col("first") + F.col("i")).alias("node"), "of.*")
    counts = results.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(results.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = classes.select("node", "least").join(roots, "node")
    smallest = known.groupBy("root").agg(F.min("least").alias("component"))
    linked = staged(roots.join(smallest, "root").join(counts, "node").select("node", "links", "component"), "linked")
    facts = classes.join(linked, "node", "left")
    facts = facts.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "least").alias("component"))
    out = keys(vectors).select("vec_id", "k1", "k2").join(facts, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        (component.isNull() | F.coalesce(F.col("vec_id") == component, F.lit(False))).alias("kept"),
    )
