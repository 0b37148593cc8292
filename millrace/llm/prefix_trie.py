"""A trie of conversations by their turns, built as adaptive radix trees.

A turn is known by a digest of role and text, sixteen bytes in big-endian order, so a conversation is a byte key and
conversations that begin alike share a beginning of their keys.  Only byte depths that end a turn are nodes of the trie.

Equal conversations are one key with a weight.  The distinct keys are put in order over the whole table without
any task that holds all of it, and cut into runs of bounded size.  Each run becomes one adaptive radix tree, told the last key before
it and the first behind it.  All that a node reports is a sum over its keys: a key counts the nodes that it does not share with the
key before it, and is a leaf unless the key behind it goes on from it.  So only the few nodes on a run's edges are
parts of a node, added up afterwards.

A key ends where its beginning is no other conversation's (found at depths 4, 16, 64, …).  What follows is a path without branches and
needs no tree: its nodes come straight from the turns, so a conversation with a third of all turns is in no one's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import running
from millrace.llm.radix import Node, shared, tree
from millrace.session import staged

#: Bytes of a turn's digest.
WIDTH = 16
NO_END = sha256(b"").hexdigest()
NODE = "conv long, depth long, parent long, n long, children long, leaves long, saved long, ends string"
PART = f"{NODE}, self string, above string"
KINDS = {"long": pa.int64(), "string": pa.string()}
PART_TYPES = pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in PART.split(", ")])


def turn_id(role: Column, text: Column) -> Column:
    """Digest of a turn; null role or text counts as empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role), F.lit(":"), role, text)))


def ordered(turns: DataFrame) -> DataFrame:
    """``conv, place, id, tokens, before``: turns numbered in each conversation, with their code points and those before.

    Turns ascend by ``turn``, null first, equal ones by digest.  Turns without a ``conv_id`` belong to no conversation.
    """
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        turn_id(F.col("role"), F.col("text")).alias("id"),
        F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("tokens"),
    )
    placed = running(staged(narrow, "turns"), ["conv"], [F.col("turn").asc_nulls_first(), F.col("id")], ["tokens"])
    return staged(placed.select("conv", "place", "id", "tokens", F.col("before_tokens").alias("before")), "placed")


def facts_of(placed: DataFrame) -> DataFrame:
    """``conv, length, total`` of every conversation."""
    return placed.groupBy("conv").agg(F.count(F.lit(1)).alias("length"), F.sum("tokens").alias("total"))


def branched(placed: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The conversations as branches of the first of their family, and their facts.

    Conversation c takes its first h = crc32(c) % ``most`` turns from conversation c - c % ``family`` (all if that has fewer, none
    if there is no such conversation) in place of its own first h.  One left without turns still has facts.
    """
    before = F.array(*[F.coalesce(F.sum(F.when(F.col("place") < j, F.col("tokens"))), F.lit(0)) for j in range(most)])
    own = staged(placed.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("sum"), before.alias("first")), "own")
    base = own.where(f"conv % {family} = 0").select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("first").alias("base_first"))
    taken = own.select("*", (F.col("conv") - F.col("conv") % family).alias("base"), (F.crc32(F.col("conv").cast("string")) % most).alias("h"))
    taken = taken.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("skip", F.least("h", "n"))
    at = lambda name, place: F.coalesce(F.get(name, F.col(place).cast("int")), F.lit(0))
    taken = taken.select("*", at("base_first", "head").alias("head_sum"), at("first", "skip").alias("skip_sum"))
    facts = staged(
        taken.select(
            "conv", "base", "h", "head", "head_sum", "skip_sum",
            (F.col("head") + F.col("n") - F.col("skip")).alias("length"),
            (F.col("head_sum") + F.col("sum") - F.col("skip_sum")).alias("total"),
        ),
        "facts",
    )
    rest = placed.join(facts, "conv").where("place >= h")
    rest = rest.select("conv", (F.col("place") - F.col("h") + F.col("head")).alias("place"), "id", "tokens", (F.col("before") - F.col("skip_sum") + F.col("head_sum")).alias("before"))
    roots = placed.where(f"conv % {family} = 0 AND place < {most - 1}").withColumnRenamed("conv", "base")
    begun = roots.join(facts.select("conv", "base", "h"), "base").where("place < h").select("conv", "place", "id", "tokens", "before")
    return staged(rest.union(begun), "branched"), facts.select("conv", "length", "total")


def checkpoints(longest: int, first: int = 4, factor: int = 4) -> list[int]:
    depths = [first]
    while depths[-1] < longest:
        depths.append(depths[-1] * factor)
    return depths


def classes_of(turns: DataFrame, facts: DataFrame) -> DataFrame:
    """``conv, n, ends, length, total, cut``: the distinct conversations, each by its smallest id.

    ``n`` conversations are equal; ``ends`` is the digest of their ids, ascending, joined by commas; the key of a class ends after ``cut``
    turns.  Beginnings are compared by 128 bits: a hash of each turn and its place, combined by exclusive or, which
    needs neither order nor a conversation in one place.  The ids of a class stream through one task.
    """
    depths = checkpoints(facts.agg(F.max("length")).first()[0] or 0)
    marks = [F.xxhash64("place", "id"), F.xxhash64(F.lit(1), "id", "place")]
    hashed = turns.select("conv", "place", *[m.alias(f"m{i}") for i, m in enumerate(marks)])
    upto = lambda d: F.array(*[F.bit_xor(F.when(F.col("place") < d, F.col(f"m{i}")).otherwise(0)) for i in (0, 1)])
    none = F.array(*[F.array(F.lit(0).cast("long"), F.lit(0).cast("long"))] * len(depths))
    begins = hashed.groupBy("conv").agg(F.array(*[upto(d) for d in depths]).alias("begins"))
    known = staged(facts.join(begins, "conv", "left").withColumn("begins", F.coalesce("begins", none)), "beginnings")
    whole = known.select(F.element_at("begins", -1).alias("w"), "length", "conv").select(F.col("w")[0].alias("a"), F.col("w")[1].alias("b"), "length", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, least, n, hasher = None, 0, 0, sha256()
        out: list[tuple[int, int, str]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([batch.column(c).to_numpy() for c in ("a", "b", "length")], 1)
            convs = batch.column("conv").to_pylist()
            cuts = (np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, len(convs)], strict=True):
                ids = ",".join(map(str, convs[begin:end])).encode()
                if held == (own := tuple(group[begin])):
                    hasher.update(b"," + ids)
                    n += end - begin
                else:
                    if held is not None:
                        out.append((least, n, hasher.hexdigest()))
                    held, least, n, hasher = own, convs[begin], end - begin, sha256(ids)
            yield made(out)
            out = []
        if held is not None:
            yield made([(least, n, hasher.hexdigest())])

    def made(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv", "n", "ends"])

    key = ["a", "b", "length"]
    equal = whole.repartition(*key).sortWithinPartitions(*key, "conv").mapInArrow(run, "conv long, n long, ends string")
    classes = staged(equal.join(known, "conv"), "classes")
    begun = classes.select("conv", F.posexplode("begins").alias("i", "w")).select("conv", "i", F.col("w")[0].alias("a"), F.col("w")[1].alias("b"))
    single = begun.groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n = 1")
    alone = single.groupBy("conv").agg(F.min("i").alias("i"))
    at = F.get(F.array(*[F.lit(d).cast("long") for d in depths]), F.col("i"))
    cut = F.least("length", F.coalesce(at, F.col("length"))).alias("cut")
    return staged(classes.join(alone, "conv", "left").select("conv", "n", "ends", "length", "total", cut), "classes")


def parts_of(keys: list[bytes], facts: dict[str, list], last: bytes | None, following: bytes | None) -> pa.Table:
    """The nodes of a run of keys; those on its edges carry their own digest, their children that of the node above."""
    root = tree(keys)
    from_left = -1 if last is None else shared(last, keys[0]) // WIDTH  # nodes down to this depth are counted before
    from_right = -1 if following is None else shared(keys[-1], following) // WIDTH
    conv, weight, total, length, lens, ends = (facts[c] for c in ("conv", "n", "total", "length", "lens", "ends"))
    # nodes in the order of their keys, each before its children: (node, bytes above its own, number of the parent)
    order: list[tuple[Node, int, int]] = []
    stack = [(root, 0, -1)]
    while stack:
        node, begin, parent = stack.pop()
        mine = len(order)
        order.append((node, begin, parent))
        below = begin + len(node.path) + 1
        stack += [(kid, below, mine) for kid in reversed(list(node.children()))]
    size = len(order)
    n, least, words, leaves, owned, branches, member = ([0] * size for _ in range(7))
    for i in range(size - 1, -1, -1):
        node, begin, parent = order[i]
        end = begin + len(node.path)
        if node.value is not None:
            c = node.value
            goes_on = any(True for _ in node.children()) or (c == len(keys) - 1 and following is not None and following.startswith(keys[c]))
            n[i] += weight[c]
            words[i] += weight[c] * total[c]
            leaves[i] += 0 if goes_on and length[c] * WIDTH == len(keys[c]) else 1
            least[i] = min(least[i], conv[c]) if n[i] > weight[c] else conv[c]
            member[i] = c
            owned[i] += total[c] - sum(lens[c])  # of the turns behind the key, which nobody shares
            branches[i] += length[c] * WIDTH > len(keys[c])
        if parent >= 0:
            first = n[parent] == 0
            n[parent] += n[i]
            words[parent] += words[i]
            leaves[parent] += leaves[i]
            least[parent] = least[i] if first else min(least[parent], least[i])
            member[parent] = member[i]
            low = -(-begin // WIDTH)  # the first depth that ends in this node's own bytes, its byte in the parent included
            own = range(low, end // WIDTH + 1)
            owned[parent] += owned[i] + sum(lens[member[i]][d - 1] for d in own if d > from_left or not keys[0].startswith(keys[member[i]][: d * WIDTH]))
            branches[parent] += 1 if own else branches[i]
    rows: list[tuple] = []
    deepest = [-1] * size  # the number of the last row on the way to the end of a node
    for i, (node, begin, parent) in enumerate(order):
        end, c, up = begin + len(node.path), member[i], deepest[parent] if parent >= 0 else -1
        depths = range(-(-begin // WIDTH), end // WIDTH + 1)
        before = sum(lens[c][: max(0, depths[0] - 1)]) if depths else 0
        after = owned[i] + sum(lens[c][d - 1] for d in depths if d and (d > from_left or not keys[0].startswith(keys[c][: d * WIDTH])))
        for d in depths:
            begun = keys[c][: d * WIDTH]
            left, right = d <= from_left and keys[0].startswith(begun), d <= from_right and keys[-1].startswith(begun)
            open_ = md5(begun).hexdigest() if left or right else None
            children = 1 if (d + 1) * WIDTH <= end else branches[i]
            if left and d < from_left:
                children -= 1
            own_end = ends[c] if node.value is not None and d * WIDTH == end and length[c] == d else None
            rows.append((least[i], d, up, n[i], children, leaves[i], words[i] - n[i] * before - after, own_end, open_))
            up = len(rows) - 1
            if d:
                before += lens[c][d - 1]
                after -= lens[c][d - 1] if not left else 0
        deepest[i] = up
    parent = [None if r[2] < 0 or rows[r[2]][8] else rows[r[2]][0] for r in rows]
    above = [rows[r[2]][8] if r[2] >= 0 else None for r in rows]
    columns = [[r[0] for r in rows], [r[1] for r in rows], parent, *[[r[j] for r in rows] for j in (3, 4, 5, 6, 7, 8)], above]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, PART_TYPES, strict=True)], schema=PART_TYPES)


def trie(turns: DataFrame, facts: DataFrame, size: int = 2048) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` for every node.

    ``turns``: ``conv, place, id, tokens, before``; ``facts``: ``conv, length, total``.  A node is a distinct sequence of first turns; its members are the
    conversations that begin with it, and ``conv_id`` is the smallest.  A conversation without turns is a member of the root alone.  The
    root has depth 0 and no parent.  Without conversations there is no node.
    """
    classes = classes_of(turns, facts)
    of_class = turns.join(classes.select("conv", "cut"), "conv")
    keys = of_class.where("place < cut").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "id", "tokens"))).alias("t"))
    hexed = F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")
    keyed = classes.join(keys, "conv", "left").select(
        "conv", "n", "ends", "length", "total",
        F.coalesce(F.unhex(hexed), F.unhex(F.lit(""))).alias("key"),
        F.coalesce(F.transform("t", lambda t: t["tokens"]), F.array().cast("array<long>")).alias("lens"),
    )
    sorted_keys = running(staged(keyed, "keys"), [], [F.col("key")]).withColumn("run", F.expr(f"place div {size}"))
    sorted_keys = staged(sorted_keys, "sorted")
    last = sorted_keys.where(f"place % {size} = {size - 1}").select((F.col("run") + 1).alias("run"), F.col("key").alias("last"), F.lit(None).cast("binary").alias("following"))
    first = sorted_keys.where(f"place % {size} = 0").select((F.col("run") - 1).alias("run"), F.lit(None).cast("binary"), "key")
    edges = last.union(first).groupBy("run").agg(F.max("last").alias("last"), F.max("following").alias("following"))

    def build(table: pa.Table, edge: pa.Table) -> pa.Table:
        if not table.num_rows:
            return PART_TYPES.empty_table()
        table = table.sort_by("place")
        columns = {c: table[c].to_pylist() for c in ("key", "conv", "n", "total", "length", "lens", "ends")}
        near = [edge[c][0].as_py() if edge.num_rows else None for c in ("last", "following")]
        return parts_of(columns.pop("key"), columns, *near)

    parts = staged(sorted_keys.groupBy("run").cogroup(edges.groupBy("run")).applyInArrow(build, PART), "parts")
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    merged = parts.where("self IS NOT NULL").groupBy("self", "depth").agg(F.min("conv").alias("conv"), F.max("parent").alias("parent"), *sums, F.max("ends").alias("ends"), F.max("above").alias("above"))
    merged = staged(merged, "merged")
    columns = [c.split()[0] for c in NODE.split(", ")]
    high = merged.select(F.col("self").alias("above"), F.col("conv").alias("high"))
    under = parts.where("self IS NULL AND above IS NOT NULL").select(*columns, "above").union(merged.select(*columns, "above"))
    nodes = under.join(high, "above", "left").withColumn("parent", F.col("high")).select(*columns)
    nodes = nodes.union(parts.where("self IS NULL AND above IS NULL").select(*columns))
    tail = turns.join(classes, "conv").where("place >= cut").select(
        "conv", (F.col("place") + 1).alias("depth"), F.col("conv").alias("parent"), "n",
        F.when(F.col("place") + 1 < F.col("length"), 1).otherwise(0).cast("long"), F.lit(1).cast("long"),
        (F.col("n") - 1) * (F.col("total") - F.col("before")),
        F.when(F.col("place") + 1 == F.col("length"), F.col("ends")),
    )
    return nodes.union(tail).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_END)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, family: int = 100, most: int = 6, size: int = 2048) -> DataFrame:
    """The trie of the conversations of ``turns`` (``conv_id, turn, role, text``) as branches of their families.

    Null role or text counts as empty; turns without a ``conv_id`` take no part; repeated turns are turns of their own; other columns, whatever their
    names, play no part.
    """
    return trie(*branched(ordered(turns), family, most), size)
