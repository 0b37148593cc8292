"""Mixing sources to target weights with exact block quotas per output shard.

Every source becomes one stream of words: its documents in a seeded random order, end to end, as often as
its target asks.  The stream is cut into blocks of ``block_words`` words, so a source's quota of blocks is
exact.  A splitting tree deals the quotas to the output shards: a node that serves shards [lo, hi) passes a
multivariate-hypergeometric draw of its blocks to its left half, and the rest to the right, until every
shard has its own exact number of blocks of each source.  A shard takes that many of the source's blocks in
a permuted order, disjoint from all other shards, and orders its pieces at random.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import null_safe_join, running, word_count
from millrace.session import staged

#: Multipliers of the block permutation; a prime is coprime to every count that it does not divide.
FIRST_PRIME, SECOND_PRIME = 998244353, 1000000007


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` blocks out of ``good + bad`` are good ones, by inversion, for every population.

    Chances follow from the mode by the ratio of neighbours.  They are summed over nine standard deviations (and
    50 counts) to either side; what lies outside is less than a double can tell from nothing.
    """
    total = good + bad
    if not (good and bad and drawn):
        return drawn if good else 0
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(total - 1, 1))) ** 0.5
    mode, reach = (drawn + 1) * (good + 1) // (total + 2), int(9 * spread) + 50
    first = max(mode - reach, drawn - bad, 0)
    count = min(mode + reach, good, drawn) - first + 1
    k = first + np.arange(count - 1, dtype=float)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    upto = np.cumsum(np.exp(logs - logs.max()))
    return first + min(int(np.searchsorted(upto, rng.random() * upto[-1], side="right")), count - 1)


def left_quotas(quotas: Sequence[int], left: int, whole: int, seed: Sequence[int]) -> list[int]:
    """A multivariate-hypergeometric draw of the left half's part of ``quotas``: source after source."""
    rng = np.random.default_rng(list(seed))
    rest, drawn, out = int(sum(quotas)), int(sum(quotas)) * left // whole, []
    for quota in quotas:
        rest -= int(quota)
        out.append(hypergeometric(rng, int(quota), rest, drawn))
        drawn -= out[-1]
    return out


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target`` out of one row per source.

    Sources in code-point order (null last) take the weights in turn and share ``share`` of all words; a
    target stops at ``ceiling`` times its source.  Handing the excess on again and again ends where every
    source below its ceiling has the same words per unit of weight.  That level follows from one sorted
    pass: by ceiling per weight, a source is full if the level of the sources not before it reaches its own
    ceiling.  The window has one row per source, never one per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("turn", F.row_number().over(by_name) - 1)
    choices = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.select(
        "source", "source_size", "turn", F.element_at(choices, (F.col("turn") % len(weights) + 1).cast("int")).alias("weight")
    ).withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "turn").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ranked.withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("open_words", F.col("words") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("full", F.col("ratio") * F.col("open_weight") <= F.col("open_words"))
    )
    first_open = Window.partitionBy()
    pick = lambda c: F.min_by(F.when(~F.col("full"), F.col(c)), F.when(~F.col("full"), F.struct("ratio", "turn"))).over(first_open)
    return levels.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * pick("open_words") / pick("open_weight")).alias("target"),
    )


def deal(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source``, ``shard``, ``quota`` out of ``source``, ``quota`` by the splitting tree, one level per pass.

    A group is one node, with one row per source; its random numbers depend on seed and node only.
    """

    def split(key: tuple, node: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(key[0]), int(key[1])
        if hi - lo == 1:
            return node
        node = node.sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        middle = (lo + hi) // 2
        left = left_quotas(node["quota"].tolist(), middle - lo, hi - lo, [seed, lo, hi])
        halves = [node.assign(hi=middle, quota=left), node.assign(lo=middle, quota=node["quota"] - left)]
        return pd.concat(halves, ignore_index=True)

    level = quotas.select("source", "quota", F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"))
    for _ in range(max(shards - 1, 0).bit_length()):
        level = level.groupBy("lo", "hi").applyInPandas(split, "source string, quota long, lo long, hi long")
    return level.select("source", F.col("lo").alias("shard"), "quota")


def permuted(block: Column, blocks: Column) -> Column:
    """A place in 0..blocks-1 for each block, all different: multiplication by a number coprime to ``blocks``."""
    prime = F.when(blocks % FIRST_PRIME == 0, F.lit(SECOND_PRIME)).otherwise(F.lit(FIRST_PRIME)).cast("long")
    return F.pmod(block * prime + F.lit(1), blocks)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
    shards: int = 16,
    block_words: int = 4096,
    seed: int = 7,
    whole: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (``doc_id``, ``text``, ``source``): (documents, pieces).

    documents: ``doc_id, size, source, source_size, target, row_hash`` for every row.  pieces: ``doc_id,
    row_hash, copy, start, n_words, shard, place_hash``: words [start, start + n_words) of a document that a
    shard holds; a shard's pieces in the order of ``place_hash`` are its shuffled content.  A source's drawn
    words equal its target rounded to whole words: the document on the edge is cut.  With ``whole`` no document
    is cut: one on the edge is taken or left, whichever is nearer, and all of it goes to the shard of its first word.

    Null and empty texts have size 0: no pieces (with ``whole``, one empty piece for each pass that reaches
    them).  Null sources are one source, the last.  Rows with the same id count as separate documents; of equal rows either may come first.
    An empty table gives no rows.  Texts are read once and never shuffled: only ids and sizes are.
    """
    sized = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("row_hash")
    ).withColumn("draw", F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long"))
    placed = running(sized, ["source"], [F.col("draw"), F.col("row_hash")], ["size"]).drop("draw", "place")
    totals = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(totals, weights, share, ceiling)
    aims = aims.withColumn("drawn", F.floor(F.col("target") + 0.5)).withColumn(
        "blocks", F.greatest(F.ceil(F.col("drawn") / F.lit(block_words)), F.lit(1))
    )
    aims = staged(aims, "mix-targets")
    dealt = deal(aims.select("source", F.col("blocks").alias("quota")), shards, seed)
    upto = Window.partitionBy("source").orderBy("shard")
    dealt = (
        dealt.select("source", "shard", F.sum("quota").over(upto).alias("upto"))
        .groupBy("source")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "upto"))).alias("bounds"))
    )
    plan = staged(null_safe_join(aims, dealt, ["source"]), "mix-plan")
    rows = null_safe_join(placed, plan, ["source"])
    passes = F.col("copy") * F.col("source_size") + F.col("before_size")
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(np.ceil(ceiling))).cast("long")))).withColumn("begin", passes)
    if whole:
        pieces = copies.where("source_size > 0 and 2 * begin + size <= 2 * drawn and begin < drawn")
        pieces = pieces.withColumn("block", F.floor(F.col("begin") / F.lit(block_words))).withColumn("from", F.col("begin"))
        pieces = pieces.withColumn("to", F.col("begin") + F.col("size"))
    else:
        pieces = copies.withColumn("end", F.least(F.col("begin") + F.col("size"), "drawn")).where("begin < end")
        first, last = F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words)
        pieces = pieces.withColumn("block", F.explode(F.sequence(first, last)))
        pieces = pieces.withColumn("from", F.greatest("begin", F.col("block") * block_words))
        pieces = pieces.withColumn("to", F.least("end", (F.col("block") + 1) * block_words))
    pieces = pieces.withColumn("rank", permuted(F.col("block"), F.col("blocks")))
    pieces = pieces.select(
        "doc_id",
        "row_hash",
        "copy",
        (F.col("from") - F.col("begin")).alias("start"),
        (F.col("to") - F.col("from")).alias("n_words"),
        F.expr("size(filter(bounds, b -> b.upto <= rank))").cast("long").alias("shard"),
        F.xxhash64("row_hash", "copy", "block", F.lit(seed)).alias("place_hash"),
    )
    return rows.select("doc_id", "size", "source", "source_size", "target", "row_hash"), pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``; ``taken`` sums the dealt pieces."""
    rows, pieces = mix(docs, **options)
    # equal rows (same id and text) share a hash: their pieces are summed together and shared out again
    group = rows.groupBy("doc_id", "row_hash", "size", "source_size", "target").agg(F.count(F.lit(1)).alias("rows"))
    drawn = pieces.groupBy("doc_id", "row_hash").agg(F.sum("n_words").alias("taken"))
    out = null_safe_join(group, drawn, ["doc_id", "row_hash"], "left")
    out = out.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    total = F.coalesce(F.col("taken"), F.lit(0).cast("long"))
    share = F.floor(total / F.col("rows")) + F.when(F.col("nth") <= total % F.col("rows"), 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", share.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, in the columns of ``docs``; documents stay whole."""
    _, pieces = mix(docs, whole=True, **options)
    key = ["_llm_id", "_llm_row"]
    named = pieces.select(F.col("doc_id").alias("_llm_id"), F.col("row_hash").alias("_llm_row"))
    counts = named.groupBy(*key).agg(F.count(F.lit(1)).alias("_llm_copies"))
    tagged = docs.select("*", F.col("doc_id").alias("_llm_id"), F.xxhash64("doc_id", "text").alias("_llm_row"))
    equal = tagged.groupBy(*key).agg(F.count(F.lit(1)).alias("_llm_rows")).where("_llm_rows > 1")
    counts = null_safe_join(counts, equal, key, "left")
    # equal rows cannot be told apart: each gets the rounded-up share of the copies of all of them
    each = F.ceil(F.col("_llm_copies") / F.coalesce("_llm_rows", F.lit(1))).cast("int")
    joined = null_safe_join(tagged, counts.select(*key, each.alias("_llm_each")), key)
    return joined.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_each")))).select(*docs.columns)
