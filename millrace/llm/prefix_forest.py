"""Nearest neighbours by inner product with a hash-prefix forest (LSH Forest, Bawa et al. 2005).

Each tree gives every vector a long string of ``CHARS`` characters.  A character stands for the nearest of sixteen signed
random directions (eight orthonormal ones of a random rotation, either sign), so near vectors share a longer prefix
than others.  A tree is the sorted array of its strings, cut into shards at prefixes that hold a bounded number of vectors.

A query descends in every tree to its longest match and then ascends in all trees together: it takes the
longest prefix length at which the vectors that share its prefixes number ``candidates`` in all; of the trees, one after the other
leaves the next longer prefix for this one only until the number is reached.  All vectors under the chosen prefixes are
compared exactly, in double precision, where their shard lies; a prefix above the shards reads all shards below it.  A prefix is never read in part.

So that the angle stands for the inner product whatever the lengths, a vector x is hashed as (x, sqrt(M^2 - |x|^2)), M being the
greatest length, and a query q as (q, 0).

Equal vectors are one entry with their smallest ids: of a group of copies no more can be among the nearest of one query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import staged

CHARS, BITS = 15, 4
#: Directions per character.
WIDTH = 1 << (BITS - 1)
USABLE = (
    "vec_id IS NOT NULL AND embedding IS NOT NULL AND exists(embedding, x -> x <> 0) AND "
    "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
)


def directions(tree: int, dim: int, seed: int = 12) -> np.ndarray:
    """``dim`` x (``CHARS`` * ``WIDTH``) directions, orthonormal as far as there are dimensions."""
    rng, parts, left = np.random.default_rng([seed, tree, dim]), [], CHARS * WIDTH
    while left:
        some = min(left, dim)
        parts.append(np.linalg.qr(rng.standard_normal((dim, some)))[0])
        left -= some
    return np.concatenate(parts, 1).astype(np.float32)


def strings(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The string of each vector in a tree, packed into a long; missing last dimensions count as 0."""
    turned = (vectors @ turn[: vectors.shape[1]]).reshape(len(vectors), CHARS, WIDTH)
    at = np.abs(turned).argmax(2)
    sign = np.take_along_axis(turned, at[..., None], 2)[..., 0] > 0
    return ((2 * at + sign).astype(np.int64) << (BITS * np.arange(CHARS - 1, -1, -1))).sum(1)


def prefix(column: str, level: Column | int) -> Column:
    """The first ``level`` characters of a string."""
    shift = F.lit(BITS * CHARS) - BITS * (F.lit(level) if isinstance(level, int) else level)
    return F.call_function("shiftright", F.col(column), shift.cast("int"))


def classes_of(vectors: DataFrame, asked: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """``node, embedding, dim, norm, ids, query`` of the distinct usable vectors, and ``vec_id, node`` of the queries."""
    kind = vectors.schema["embedding"].dataType
    exact = F.col("embedding") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else F.col("embedding").cast("array<double>")
    keys = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    usable = vectors.where(USABLE).select(F.col("vec_id").cast("long").alias("vec_id"), exact.alias("embedding")).select("*", *keys)
    low = F.dense_rank().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    few = usable.withColumn("low", low).where(F.col("low") <= k + 1)
    grouped = few.groupBy("k1", "k2").agg(F.any_value("embedding").alias("embedding"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
    queries = usable.where(asked).select("vec_id", "k1", "k2").distinct()
    marked = grouped.join(queries.select("k1", "k2", F.lit(True).alias("query")).distinct(), ["k1", "k2"], "left")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    named = marked.select("k1", "k2", "embedding", "ids", F.coalesce("query", F.lit(False)).alias("query"), F.size("embedding").alias("dim"), norm.alias("norm"))
    classes = staged(named.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbered once, when written
    return classes, staged(queries.join(classes.where("query").select("k1", "k2", "node"), ["k1", "k2"]).select("vec_id", "node"), "queries")


def hashed(classes: DataFrame, trees: int) -> DataFrame:
    """``node, least, query, dim, vec, own, asked``: the vector in binary, its strings as an entry and as a query."""
    longest = classes.groupBy("dim").agg(F.max("norm").alias("longest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, list[np.ndarray]] = {}  # of the last number of dimensions
        for batch in batches:
            values, offsets = batch.column("embedding").values.to_numpy(), batch.column("embedding").offsets.to_numpy()
            dims, query = np.diff(offsets), batch.column("query").to_numpy(zero_copy_only=False)
            norm, most = batch.column("norm").to_numpy(), batch.column("longest").to_numpy()
            own = np.zeros((len(dims), trees), np.int64)
            asked = np.zeros((len(dims), trees), np.int64)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x = values[offsets[:-1][rows][:, None] + np.arange(dim)].astype(np.float64)
                last = np.sqrt(np.maximum(most[rows] ** 2 - norm[rows] ** 2, 0))
                full = (np.concatenate((x, last[:, None]), 1) / most[rows][:, None]).astype(np.float32)
                some = query[rows]
                if dim not in turns:
                    turns = {dim: [directions(tree, dim + 1) for tree in range(trees)]}
                for tree, turn in enumerate(turns[dim]):
                    own[rows, tree] = strings(full, turn)
                    asked[rows[some], tree] = strings(full[some, :-1], turn)
            width = values.dtype.itemsize
            vec = pa.Array.from_buffers(pa.binary(), len(dims), [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, len(a) * trees + 1, trees, dtype=np.int32)), pa.array(a.reshape(-1))) for a in (own, asked)]
            kept = [batch.column(c) for c in ("node", "least", "query", "dim")]
            yield pa.RecordBatch.from_arrays([*kept, vec, *lists], names=["node", "least", "query", "dim", "vec", "own", "asked"])

    base = classes.join(longest, "dim").select("node", F.col("ids")[0].alias("least"), "query", "dim", "norm", "longest", "embedding")
    schema = "node long, least long, query boolean, dim int, vec binary, own array<long>, asked array<long>"
    return staged(base.mapInArrow(run, schema), "hashed")


def forest(entries: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """All prefixes that hold more than ``size`` vectors, with ``n``, and the shards: the longer prefixes next below them.

    ``entries``: ``dim, tree, string``.  A shard holds ``size`` vectors at most; one whose strings are equal to the end is cut into ``chunks``.
    """
    node = ["dim", "tree", "prefix"]
    large, found = None, []
    for level in range(CHARS + 1):
        rows = entries.select("dim", "tree", prefix("string", level).alias("prefix"), prefix("string", max(level - 1, 0)).alias("up"))
        if large is not None:
            rows = rows.join(large.withColumnRenamed("prefix", "up"), ["dim", "tree", "up"], "left_semi")
        counts = staged(rows.groupBy(*node).agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit(level)), "prefixes")
        found.append(counts)
        large = counts.where(F.col("n") > size).select(*node)
        if level == CHARS or large.isEmpty():
            break
    every = found[0]
    for counts in found[1:]:
        every = every.union(counts)
    over = (F.col("n") > size) & (F.col("level") < CHARS)
    chunks = F.ceil(F.col("n") / F.lit(size)).cast("int").alias("chunks")
    return every.where(over), staged(every.where(~over).select("*", chunks).withColumn("shard", F.monotonically_increasing_id()), "shards")


def matches(probes: DataFrame, entries: DataFrame, located: DataFrame, large: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``query, tree, level, n``: how many entries share a query's first ``level`` characters; and the shard a query falls into."""
    highest = (shards.agg(F.max("level")).first()[0] or 0) + 1
    steps = probes.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(highest)]))).withColumn("prefix", prefix("string", F.col("level")))
    node = ["dim", "tree", "level", "prefix"]
    above = steps.join(large.select(*node, "n"), node).select("query", "tree", "level", F.col("n").cast("long"))
    homes = staged(steps.join(shards.select(*node, "n", "chunks", "shard"), node).select("query", "dim", "tree", "string", "shard", "level", "n", "chunks"), "homes")

    def count(points: pa.Table, asked: pa.Table) -> pa.Table:
        held, strings_, level = np.sort(points["string"].to_numpy()), asked["string"].to_numpy(), asked["level"].to_numpy()
        out = []
        for at in range(int(level[0]) + 1 if len(level) else CHARS + 1, CHARS + 1):
            shift = BITS * (CHARS - at)
            low = strings_ >> shift << shift
            n = np.searchsorted(held, low + (1 << shift)) - np.searchsorted(held, low)
            some = n > 0
            out.append((asked["query"].to_numpy()[some], asked["tree"].to_numpy()[some], np.full(some.sum(), at, np.int32), n[some]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0)] * 4
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
        return pa.table([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)], names=["query", "tree", "level", "n"])

    deeper = located.where(F.col("level") < CHARS).select("shard", "string").groupBy("shard")
    deeper = deeper.cogroup(homes.where(F.col("level") < CHARS).groupBy("shard")).applyInArrow(count, "query long, tree int, level int, n long")
    return staged(above.union(homes.select("query", "tree", "level", "n")).union(deeper), "matches"), homes


def ascended(found: DataFrame, candidates: int) -> DataFrame:
    """``query, tree, level``: the prefixes whose entries a query is compared with."""
    sums = found.groupBy("query", "level").agg(F.sum("n").alias("n"))
    reached = sums.groupBy("query").agg(F.coalesce(F.max(F.when(F.col("n") >= candidates, F.col("level"))), F.lit(0)).alias("x"))
    both = found.join(reached, "query").where("level = x OR level = x + 1")
    of = lambda level: F.coalesce(F.sum(F.when(F.col("level") == level, F.col("n"))), F.lit(0))
    both = both.groupBy("query", "tree", "x").agg(of(F.col("x")).alias("wide"), of(F.col("x") + 1).alias("narrow"))
    whole = Window.partitionBy("query")
    before = whole.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.sum("narrow").over(whole) + F.coalesce(F.sum(F.col("wide") - F.col("narrow")).over(before), F.lit(0))
    chosen = both.withColumn("rises", taken < candidates).select("query", "tree", F.when(F.col("rises"), F.col("x")).otherwise(F.col("x") + 1).cast("int").alias("level"), F.when(F.col("rises"), F.col("wide")).otherwise(F.col("narrow")).alias("n"))
    whole_tree = F.min(F.when(F.col("level") == 0, F.col("tree"))).over(whole)  # one tree's root holds all there is
    return chosen.where("n > 0").withColumn("all", whole_tree).where("all IS NULL OR tree = all").select("query", "tree", "level")


def best(scores: np.ndarray, q: np.ndarray, x: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the ``k`` best of one query; rough scores only narrow the choice."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge)) * max(1.0, np.abs(q).max()))
    else:
        at = np.arange(len(scores))
    exact = (x[at].astype(np.float64) * q).sum(1)
    order = np.lexsort((least[at], -exact))[:k]
    return at[order], exact[order]


def compared(targets: DataFrame, points: DataFrame, floats: bool, k: int) -> DataFrame:
    """``query, found``: the best ``k`` entries of each query in each shard it reads, as one list per shard."""
    kind = np.float32 if floats else np.float64

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        queries, sizes, parts = [], [0], [(np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))]
        if held.num_rows and asked.num_rows:
            order = np.argsort(held["string"].to_numpy(), kind="stable")
            string, node, least = (held[c].to_numpy()[order] for c in ("string", "node", "least"))
            x = np.frombuffer(b"".join(held["vec"].to_pylist()), kind).reshape(len(order), -1)[order]
            q = np.frombuffer(b"".join(asked["asked"].to_pylist()), kind).reshape(asked.num_rows, -1).astype(np.float64)
            shift = BITS * (CHARS - np.maximum(asked["level"].to_numpy(), asked["home"].to_numpy())).astype(np.int64)
            low = asked["string"].to_numpy() >> shift << shift
            inside = asked["level"].to_numpy() > asked["home"].to_numpy()
            begin = np.where(inside, np.searchsorted(string, low), 0)
            end = np.where(inside, np.searchsorted(string, low + (np.int64(1) << shift)), len(string))
            spans, which = np.unique(np.stack((begin, end), 1), axis=0, return_inverse=True)
            which, query = which.reshape(-1), asked["query"].to_numpy()
            for span, (b, e) in enumerate(spans.tolist()):
                part = x[b:e].astype(np.float64)
                for rows in np.array_split(np.flatnonzero(which == span), 1 + (which == span).sum() // 256):
                    for i, scores in zip(rows.tolist(), q[rows] @ part.T, strict=True):
                        at, exact = best(scores, q[i], part, least[b:e], k)
                        queries.append(query[i])
                        sizes.append(len(at))
                        parts.append((-exact, least[b:e][at], node[b:e][at]))
        columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.StructArray.from_arrays(columns, ["far", "least", "node"]))
        return pa.table({"query": pa.array(queries, pa.int64()), "found": lists})

    sides = points.groupBy("shard", "chunk").cogroup(targets.groupBy("shard", "chunk"))
    return sides.applyInArrow(run, "query long, found array<struct<far: double, least: long, node: long>>")


def nearest(vectors: DataFrame, asked: Column, k: int = 20, trees: int = 48, candidates: int = 32_000, size: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` that ``asked`` holds for, the ``k`` of greatest inner product found.

    Found are those among at least ``candidates`` entries, counted once per tree (all, if there are fewer): nearest first, ties to the smaller
    ``vec_id``.  Only vectors of one length are compared.  Vectors that are null, empty, zero or hold null or non-finite components and rows
    without an id take no part.  A row is known by its id: rows with the query's own id are not found, and a repeated row counts once.
    A query whose id stands for several vectors is answered for each.
    """
    floats = isinstance(getattr(vectors.schema["embedding"].dataType, "elementType", None), T.FloatType)
    classes, queries = classes_of(vectors, asked, k)
    table = hashed(classes, trees)
    entries = table.select("node", "dim", F.posexplode("own").alias("tree", "string"))
    probes = table.where("query").select(F.col("node").alias("query"), "dim", F.posexplode("asked").alias("tree", "string"))
    large, shards = forest(entries, size)
    levels = [r[0] for r in shards.select("level").distinct().collect()]
    node = ["dim", "tree", "level", "prefix"]
    at_levels = entries.withColumn("level", F.explode(F.array(*[F.lit(i) for i in levels or [0]]))).withColumn("prefix", prefix("string", F.col("level")))
    placed = at_levels.join(shards.select(*node, "shard", "chunks"), node)
    located = staged(placed.select("shard", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", "string", "level"), "located")
    found, homes = matches(probes, entries, located, large, shards)
    chosen = staged(ascended(found, candidates).join(probes, ["query", "tree"]), "chosen")
    own = homes.select("query", "tree", "shard", F.col("level").alias("home"), "chunks")
    inside = chosen.join(own, ["query", "tree"]).where("level > home").select("query", "string", "level", "shard", "home", "chunks")
    under = shards.select("dim", "tree", F.explode(F.expr("sequence(0, level)")).alias("level"), F.col("level").alias("home"), "prefix", "shard", "chunks")
    under = under.withColumn("prefix", F.expr(f"shiftright(prefix, (home - level) * {BITS})"))
    below = chosen.withColumn("prefix", prefix("string", F.col("level"))).join(under, node).select("query", "string", "level", "shard", "home", "chunks")
    targets = inside.union(below).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("chunks")
    targets = targets.join(table.select(F.col("node").alias("query"), F.col("vec").alias("asked")), "query")
    points = located.select("shard", "chunk", "node", "string").join(table.select("node", "least", "vec"), "node")
    scored = compared(targets, points, floats, k + 1)
    # lists are put together and cut as lists; what several trees found stands side by side, with the same score
    met = scored.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("s"))
    once = F.filter("s", lambda c, i: (i == 0) | (c["node"] != F.get("s", i - 1)["node"]))
    ranked = met.select("query", F.explode(F.slice(once, 1, k + 1)).alias("c")).select("query", "c.node", (-F.col("c.far")).alias("score"))
    named = ranked.join(classes.select("node", "ids"), "node").select("query", F.explode("ids").alias("vec_id"), "score")
    first = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k + 1).alias("near")
    lists = named.groupBy("query").agg(first)
    own_id = F.filter("near", lambda c: c["vec_id"] != F.col("query_id"))
    answers = queries.withColumnsRenamed({"vec_id": "query_id", "node": "query"}).join(lists, "query")
    answers = answers.select("query_id", F.posexplode(F.slice(own_id, 1, k)).alias("rank", "c"))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.far")).alias("score"))
