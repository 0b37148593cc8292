"""Resharding by a minimum-cost flow: equal row counts per shard while the fewest bytes move.

The flow network has one source arc per old shard (its rows), one sink arc per new shard (its capacity), a
free arc from old shard i to new shard i, and an arc that costs a row's bytes to every other new shard.  All
moving arcs of one row cost the same, so a flow is cheapest when the free arcs carry what they can and carry
the heaviest rows: old shard i keeps its min(rows, capacity) largest rows.  Capacities differ by one at most;
the larger ones go where the next row to stay is heaviest.  What is left over is a transportation problem
with equal costs, and every feasible flow solves it: surplus rows and free slots are laid end to end on one
line, and each overlap of a surplus with a gap is one block transfer.  Shards are numbered, not loaded: plans
hold one row per shard or per transfer, rows are placed by distributed running counts, and texts move once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import byte_count, null_safe_join, running
from millrace.session import staged

#: Bytes that a row costs besides its text.
ROW_BYTES = 8


def stored_shards(docs: DataFrame) -> DataFrame:
    """``docs`` with ``old_shard``: the place of the row's file among the names of the files read; 0 without files.

    The window that numbers the files has one row per file.
    """
    named = docs.withColumn("_file", F.input_file_name())
    files = named.select("_file").distinct().select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("int").alias("old_shard"))
    return named.join(staged(files, "files"), "_file", "left").drop("_file")


def capacities(held: DataFrame, shards: int, next_bytes: DataFrame) -> DataFrame:
    """``shard``, ``capacity``: all rows of ``held`` (``old_shard``, ``rows``) over ``shards``, at most one apart.

    The remainder's extra slots go first to shards that have to give rows away, by the bytes of the row that
    an extra slot would let stay (``next_bytes``: ``old_shard``, ``bytes``), then to the lowest shards.
    """
    each = held.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(True).alias("new"))
    known = each.join(held.withColumnRenamed("old_shard", "shard"), "shard", "full_outer")
    known = known.join(next_bytes.withColumnRenamed("old_shard", "shard"), "shard", "left")
    turn = F.row_number().over(Window.orderBy(F.col("new").desc_nulls_last(), F.col("bytes").desc_nulls_last(), "shard"))
    total = F.coalesce(F.sum("rows").over(Window.partitionBy()), F.lit(0))
    extra = (F.col("turn") <= F.col("total") % shards).cast("long")
    ranked = known.select("shard", "new", turn.alias("turn"), total.alias("total")).where("new")
    return ranked.select("shard", (F.floor(F.col("total") / shards) + extra).alias("capacity"))


def transfers(held: DataFrame, room: DataFrame, shards: int) -> DataFrame:
    """``old_shard, shard, from_place, to_place, slot``: the flow along every arc that carries rows.

    Rows of ``old_shard`` whose place is in [from_place, to_place) go to ``shard``, from ``slot`` on.
    """
    state = held.join(room.withColumnRenamed("shard", "old_shard"), "old_shard", "full_outer").select(
        "old_shard", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("capacity", F.lit(0)).alias("capacity")
    )
    state = state.withColumn("kept", F.least("rows", "capacity"))
    before = Window.orderBy("old_shard").rowsBetween(Window.unboundedPreceding, -1)
    line = lambda amount: F.coalesce(F.sum(amount).over(before), F.lit(0))
    state = staged(
        state.withColumn("more", F.col("rows") - F.col("kept"))
        .withColumn("free", F.col("capacity") - F.col("kept"))
        .withColumn("more_from", line("more"))
        .withColumn("free_from", line("free"))
        .withColumn("total", F.sum("more").over(Window.partitionBy())),
        "flow",
    )
    stay = state.where("kept > 0").select(
        "old_shard", F.col("old_shard").alias("shard"), F.lit(0).cast("long").alias("from_place"), F.col("kept").alias("to_place"), F.lit(0).cast("long").alias("slot")
    )
    # overlaps of two sorted lists of intervals: walk their common boundaries instead of comparing all pairs
    gives = state.where("more > 0").select(F.col("more_from").alias("at"), "old_shard", F.col("kept"), F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("used"), "total")
    takes = state.where("free > 0").select(F.col("free_from").alias("at"), F.lit(None).cast("int"), F.lit(None).cast("long"), F.col("old_shard"), F.col("kept"), F.col("total"))
    up_to = Window.orderBy("at")
    last = lambda c: F.last(c, ignorenulls=True).over(up_to)
    walk = gives.union(takes)
    cuts = walk.select(
        "at",
        last("old_shard").alias("old_shard"),
        last("kept").alias("kept"),
        last(F.when(F.col("old_shard").isNotNull(), F.col("at"))).alias("give_at"),
        last("shard").alias("shard"),
        last("used").alias("used"),
        last(F.when(F.col("shard").isNotNull(), F.col("at"))).alias("take_at"),
        "total",
    ).distinct()
    cuts = cuts.withColumn("end", F.coalesce(F.lead("at").over(Window.orderBy("at")), F.col("total")))
    move = cuts.select(
        "old_shard",
        "shard",
        (F.col("kept") + F.col("at") - F.col("give_at")).alias("from_place"),
        (F.col("kept") + F.col("end") - F.col("give_at")).alias("to_place"),
        (F.col("used") + F.col("at") - F.col("take_at")).alias("slot"),
    )
    return staged(stay.union(move), "transfers")


def reshard(docs: DataFrame, shards: int, old_shard: str | None = None, carry: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, transfers).  rows: ``doc_id, row_hash, size, old_shard, shard, slot``, one for each row of ``docs``,
    and the columns of ``carry``.

    ``old_shard`` names an integer column with the present shard; without it rows count as lying in the files
    they are read from.  Shards hold equally many rows, at most one apart; slots run from 0 without gaps.  Null
    texts have the size of a row without text; null or repeated ids are rows like others; an empty table has
    no rows and no transfers.  Equal rows are interchangeable.
    """
    named = stored_shards(docs) if old_shard is None else docs.withColumn("old_shard", F.coalesce(F.col(old_shard).cast("int"), F.lit(0)))
    narrow = named.select("doc_id", F.xxhash64("doc_id", "text").alias("row_hash"), (byte_count(F.col("text")) + ROW_BYTES).alias("size"), "old_shard", *carry)
    placed = staged(running(narrow, ["old_shard"], [F.col("size").desc(), F.col("row_hash"), F.col("doc_id")]), "places")
    held = staged(placed.groupBy("old_shard").agg(F.count(F.lit(1)).alias("rows")), "held")
    total = held.agg(F.floor(F.coalesce(F.sum("rows"), F.lit(0)) / shards).alias("base"))
    next_bytes = placed.join(total, F.col("place") == F.col("base")).where(F.col("old_shard") < shards).select("old_shard", F.col("size").alias("bytes"))
    moves = transfers(held, capacities(held, shards, next_bytes), shards)
    arcs = moves.withColumnRenamed("slot", "first_slot")
    rows = placed.join(arcs, "old_shard").where("place >= from_place and place < to_place")
    rows = rows.select(*narrow.columns, "shard", (F.col("first_slot") + F.col("place") - F.col("from_place")).alias("slot"))
    return rows, moves


def sharded(docs: DataFrame, shards: int, **options) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (and ``size``, ``old_shard``) added."""
    rows, _ = reshard(docs, shards, **options)
    # rows with the same id and text are numbered on both sides, so each gets one of the slots
    key = ["_llm_id", "_llm_row", "_llm_nth"]
    names = [c for c in docs.columns if c not in ("shard", "slot", "size", "old_shard")]
    nth = F.row_number().over(Window.partitionBy("doc_id", "row_hash").orderBy("shard", "slot"))
    numbered = rows.select(
        F.col("doc_id").alias("_llm_id"), F.col("row_hash").alias("_llm_row"), nth.alias("_llm_nth"), "size", "old_shard", "shard", "slot"
    )
    tagged = docs.select(*names, F.col("doc_id").alias("_llm_id"), F.xxhash64("doc_id", "text").alias("_llm_row"))
    plain = Window.partitionBy("_llm_id", "_llm_row").orderBy(F.lit(0))
    out = null_safe_join(tagged.withColumn("_llm_nth", F.row_number().over(plain)), numbered, key)
    return out.select(*names, "size", "old_shard", "shard", "slot")


def rewrite(docs: DataFrame, shards: int, path: str, old_shard: str | None = None) -> DataFrame:
    """Writes the affected shards below ``path`` as ``shard=<n>`` folders and returns the transfers.

    A shard that neither gives nor takes rows is not written: its old file stays as it is.
    """
    rows = staged(sharded(docs, shards, old_shard=old_shard), "sharded")
    moved = rows.where(~F.col("old_shard").eqNullSafe(F.col("shard")))
    affected = moved.select("shard").union(moved.select("old_shard")).distinct()
    out = rows.join(affected, "shard", "left_semi")
    salt = F.floor(F.col("slot") / F.lit(1_000_000))
    out.repartition(F.col("shard"), salt).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return moved.groupBy("old_shard", "shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
