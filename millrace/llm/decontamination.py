"""Benchmark decontamination: short test items inside long documents.

Size-partitioned MinHash containment search.  Items are partitioned by the number of their shingles, in
powers of two.  A document that holds at least ``least`` of an item's q shingles misses at most q - ceil(least * q)
of them, so it holds at least one of any q - ceil(least * q) + 1: the item's smallest hash values are its MinHash
signature, with a length that its partition's largest size sets.  Documents are cut into shingles once; a
join of their hashes with the signatures gives candidates without a miss, whatever the document's length (a
plain Jaccard MinHash would need thousands of values for a short item in a long text).  Candidates are
verified by the exact containment of their shingles as text.

Everything is DataFrame expressions.  Which side of a join is broadcast is left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keyed, row_key
from millrace.session import staged

SHINGLE = 5
#: What separates words after lower-casing: anything but letters and digits.
BETWEEN = r"[^\p{L}\p{N}]+"


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def shingle_hashes(width: int) -> Column:
    """Hashes of the shingles of the word array ``w``, in order."""
    parts = ", ".join(f"w[i + {k}]" for k in range(width))
    return F.expr(f"CASE WHEN size(w) >= {width} THEN transform(sequence(0, size(w) - {width}), i -> xxhash64({parts})) ELSE array() END")


def shingle_texts(width: int) -> Column:
    return F.expr(f"CASE WHEN size(w) >= {width} THEN transform(sequence(1, size(w) - {width - 1}), i -> concat_ws(' ', slice(w, i, {width}))) ELSE array() END")


def signatures(items: DataFrame, width: int, least: float) -> DataFrame:
    """``h``, ``item_id``: the signature values of items with ``w``."""
    hashed = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(width))).alias("hs"))
    size = F.size("hs")
    largest = F.pow(2.0, F.floor(F.log2(size.cast("double"))) + 1) - 1  # of the item's partition
    length = F.greatest(largest - F.ceil(largest * F.lit(least)), size - F.ceil(size * F.lit(least))) + 1
    return hashed.where("size(hs) > 0").select("item_id", F.explode(F.slice("hs", F.lit(1), F.least(length, size).cast("int"))).alias("h"))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """``k1, k2, doc_id, item_id, n_item, n_shared, containment`` for all pairs with containment >= ``least``.

    Containment is the share of an item's distinct five-word shingles that occur in the document; words are
    runs of letters and digits, lower-cased.  An item of fewer words is one shingle, its whole word sequence.
    Items without words match nothing, nor do null texts or null item ids.  Equal rows of ``docs`` give one row; equal items with
    different ids each give their own.
    """
    items = staged(benchmark.where("item_id is not null").select("item_id", plain_words(F.col("text")).alias("w")).where("size(w) > 0").distinct(), "items")
    widths = sorted(r["width"] for r in items.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("width")).distinct().collect())  # five at most
    narrow = docs.select(*row_key(docs), "doc_id", "text")
    found = None
    for width in widths or [SHINGLE]:
        of_width = items.where(F.least(F.size("w"), F.lit(SHINGLE)) == width)
        signed = staged(signatures(of_width, width, least), "signatures")
        shingled = narrow.select("k1", "k2", plain_words(F.col("text")).alias("w")).select("k1", "k2", F.explode(shingle_hashes(width)).alias("h"))
        candidates = staged(shingled.join(signed, "h").select("k1", "k2", "item_id").distinct(), "candidates")
        texts = staged(of_width.select("item_id", F.array_distinct(shingle_texts(width)).alias("s")).select("item_id", F.size("s").alias("n_item"), F.explode("s").alias("shingle")), "shingles")
        suspects = narrow.join(candidates.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
        pieces = suspects.select("k1", "k2", "doc_id", plain_words(F.col("text")).alias("w"))
        pieces = pieces.select("k1", "k2", "doc_id", F.explode(F.array_distinct(shingle_texts(width))).alias("shingle"))
        shared = pieces.join(texts, "shingle").groupBy("k1", "k2", "doc_id", "item_id", "n_item").agg(F.count_distinct("shingle").alias("n_shared"))
        checked = shared.join(candidates, ["k1", "k2", "item_id"], "left_semi").where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(least)))
        found = checked if found is None else found.unionByName(checked)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, whether or not it has an id; others stay as they are."""
    named = benchmark.select(F.md5(F.to_json(F.struct(plain_words(F.col("text"))))).alias("item_id"), "text")  # by its words
    bad = contaminated(docs, named, least).select(F.col("k1").alias("_llm_k1"), F.col("k2").alias("_llm_k2")).distinct()
    return keyed(docs).join(bad, ["_llm_k1", "_llm_k2"], "left_anti").select(*docs.columns)
