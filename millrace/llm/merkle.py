"""A Merkle manifest of a table: one digest for all rows, one per group, and a proof for every row.

The leaves of a group stand in a fixed order and are hashed together ``arity`` at a time, level by level, until one
node remains.  The trees are never held whole.  ``3^6`` leaves in a row (a superblock) are one task's work: going
up, each superblock is reduced to its top, the tops are numbered again and form the next, far smaller, stage.  Going
down, the nodes of a superblock and the siblings that its top has outside are cogrouped by superblock: one call
reduces the block once more, joins inner and outer siblings to proofs and folds every row's leaf up to the root.
What is exchanged per superblock is one top and a few siblings per level above it.

Nothing is collected.  A group with a third of all rows is many superblocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import running
from millrace.session import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Siblings before and behind a node, level by level upwards; both empty where a node is hashed alone.
PROOF = "array<struct<before:string,behind:string>>"


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its text, or ``-`` where it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def siblings_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["behind"])), ""), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give, to verify a row without the table."""
    return F.aggregate(proof, start, lambda h, p: F.sha2(F.concat(p["before"], h, p["behind"]), 256))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduced(nodes: list[str], arity: int, most: int | None) -> list[list[str]]:
    """All levels from ``nodes`` upwards: ``most`` levels of hashing, or until one node remains."""
    levels = [nodes]
    while len(levels) <= most if most is not None else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    return levels


def tops(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """``grp, block, single, top``: a superblock as the only one of its group, and as one of many."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        levels = reduced(table["hash"].to_pylist(), arity, None)
        top = reduced(levels[-1], arity, height - len(levels) + 1)[-1][0]
        return pa.table({"grp": table["grp"][:1], "block": table["block"][:1], "single": pa.array([levels[-1][0]]), "top": pa.array([top])})

    return nodes.groupBy("grp", "block").applyInArrow(run, "grp string, block long, single string, top string")


def climbed(leaves: DataFrame, arity: int, height: int) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Nodes and superblocks of every stage, and ``grp, hash`` of the roots.  ``leaves``: ``grp, place, hash`` and more columns.

    Stages go on until every group is one superblock; a stage has ``arity ** height`` times fewer rows than the one before.
    """
    block = f"place div {arity**height}"
    nodes, stages, roots = leaves, [], None
    while True:
        nodes = nodes.withColumn("block", F.expr(block))
        found = staged(tops(nodes.select("grp", "place", "block", "hash"), arity, height), "tops")
        alone = found.groupBy("grp").agg((F.count(F.lit(1)) == 1).alias("alone"))
        blocks = staged(found.join(alone, "grp"), "blocks")
        stages.append((nodes, blocks))
        done = blocks.where("alone").select("grp", F.col("single").alias("hash"))
        roots = done if roots is None else roots.union(done)
        rest = blocks.where("NOT alone")
        if rest.isEmpty():
            return stages, roots
        nodes = rest.select("grp", F.col("block").alias("place"), F.col("top").alias("hash"))


def descended(nodes: DataFrame, outer: DataFrame, arity: int, height: int, carry: Sequence[str]) -> DataFrame:
    """``<carry>, subroot, root, proof, folded`` of one stage's nodes out of those of its superblocks.

    ``outer``: ``grp, block, alone, subroot, root, outer``, one row per superblock.  ``folded`` is the root that a node's
    ``given`` leads to; higher stages have no such column and fold nothing.
    """
    fold_up = "given" in nodes.columns
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], "subroot string", "root string", f"proof {PROOF}", "folded string"])

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        at = {c: above[c][0].as_py() for c in ("alone", "subroot", "root", "outer")}
        levels = reduced(table["hash"].to_pylist(), arity, None if at["alone"] else height)
        sides: list[list[tuple[str, str]]] = []
        for level in levels[:-1]:  # the siblings of each node of each level, once
            firsts = [i - i % arity for i in range(len(level))]
            sides.append([("".join(level[f:i]), "".join(level[i + 1 : f + arity])) for i, f in enumerate(firsts)])
        tail = [(p["before"], p["behind"]) for p in at["outer"]]
        before, behind, folded = [], [], []
        for i, start in enumerate(table["given"].to_pylist() if fold_up else [None] * table.num_rows):
            proof = [side[i // arity**nth] for nth, side in enumerate(sides)] + tail
            for left, right in proof:
                before.append(left)
                behind.append(right)
                if fold_up:
                    start = digest(left + start + right)
            folded.append(start)
        offsets = pa.array(range(0, len(before) + 1, len(sides) + len(tail)) if before else [0] * (table.num_rows + 1), pa.int32())
        pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(behind, pa.string())], ["before", "behind"])
        out = {c: table[c] for c in carry}
        out |= {c: pa.array([at[c]] * table.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table(out | {"proof": pa.ListArray.from_arrays(offsets, pairs), "folded": pa.array(folded, pa.string())})

    wanted = dict.fromkeys(["grp", "block", "place", "hash", *carry, *(["given"] if fold_up else [])])
    return nodes.select(*wanted).groupBy("grp", "block").cogroup(outer.groupBy("grp", "block")).applyInArrow(run, schema)


def proven(stages: list[tuple[DataFrame, DataFrame]], above: DataFrame, arity: int, height: int, carry: Sequence[str]) -> DataFrame:
    """``<carry>, subroot, root, proof, folded`` of the leaves, from the highest stage down.

    ``above``: ``grp, subroot, root, outer``, what each group's subroot has above it.
    """
    paths: DataFrame | None = None
    for nth in range(len(stages) - 1, -1, -1):
        nodes, blocks = stages[nth]
        # a group's only superblock hangs on the group's subroot, others on their node of the next stage
        outer = blocks.where("alone").select("grp", "block", "alone").join(above, "grp").select("grp", "block", "alone", "subroot", "root", "outer")
        if paths is not None:
            outer = outer.union(paths.select("grp", F.col("place").alias("block"), F.lit(False), "subroot", "root", "proof"))
        paths = descended(nodes, outer, arity, height, ["grp", "place"] if nth else carry)
        paths = staged(paths, "proofs") if nth else paths
    return paths


def manifest(
    docs: DataFrame,
    given: Column | None = None,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    arity: int = 3,
    height: int = 6,
) -> DataFrame:
    """``<key>, leaf, subroot, root, proof, folded`` for every row of ``docs``.

    Leaves of a ``group`` ascend by ``key``, null first, then by digest; groups ascend by the bytes of their name, null
    first, and their subroots are the leaves of the tree above.  ``proof`` has the siblings of the leaf up to the
    root; ``folded`` is the root that ``given`` (a digest per row, by default the leaf itself) leads to with them.

    A null field is a field of its own kind, unlike empty text.  Repeated rows are leaves of their own.  A table without rows has
    no root and gives no rows.  Other columns, whatever their names, play no part.
    """
    name = F.col(group).cast("string")
    grp = F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("grp")
    own = leaf(*[F.col(f) for f in fields])
    rows = docs.select(grp, F.col(key).alias("key"), own.alias("hash"), (own if given is None else given).alias("given"))
    # digests are written before they are put in order: the order is found by sampling, which would hash all texts again
    leaves = running(staged(rows, "leaves"), ["grp"], [F.col("key").asc_nulls_first(), F.col("hash")])
    stages, subroots = climbed(staged(leaves, "leaves"), arity, height)
    groups = running(subroots, [], [F.col("grp")]).select(F.lit("").alias("grp"), "place", "hash", F.col("grp").alias("name"))
    high, roots = climbed(staged(groups, "groups"), arity, height)
    top = roots.select("grp", F.col("hash").alias("subroot"), F.col("hash").alias("root"), F.array().cast(PROOF).alias("outer"))
    over = proven(high, top, arity, height, ["name", "hash"])
    above = staged(over.select(F.col("name").alias("grp"), F.col("hash").alias("subroot"), "root", F.col("proof").alias("outer")), "groups")
    out = proven(stages, above, arity, height, ["key", "hash"])
    return out.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "proof", "folded")
