"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    decontamination,
    embeddings,
    language,
    language_model,
    merkle,
    mixing,
    oracle,
    phrases,
    prefix_forest,
    prefix_trie,
    sharding,
    simhash,
    suffixes,
    toxicity,
)
from millrace.llm.common import remainder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"))


def op2_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(read(spark, sf_dir, "documents"))


def op3_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows, _ = sharding.reshard(docs, 24, carry=[sharding.text_crc32(F.col("text")).alias("text_crc32")])
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs)
    held = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return language.identify(held, model).drop("text")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    held = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return toxicity.score(held, model).drop("text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    hexadecimal = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def op9_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.without_repeats(read(spark, sf_dir, "documents"))


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    tampered = merkle.leaf(*[F.col(c) for c in merkle.FIELDS[:-1]], text)
    found = merkle.manifest(read(spark, sf_dir, "documents"), tampered)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("proof")).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_score_texts": op2_score_texts,
    "op3_reshard": op3_reshard,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_phrase_dedup": op9_phrase_dedup,
    "op10_embedding_duplicates": op10_embedding_duplicates,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, ('0x' || substr(md5(doc_id::VARCHAR || ':7'), 1, 15))::BIGINT AS draw, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
                [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight,
                row_number() OVER (ORDER BY source NULLS LAST) AS turn
            FROM d GROUP BY source
        ), l AS (
            SELECT *, 2 * source_size AS most,
                1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0) AS open_words,
                sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
            FROM s WINDOW before AS (ORDER BY 2 * source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), first_open AS (
            SELECT open_words, open_weight FROM l WHERE most / weight * open_weight > open_words ORDER BY most / weight, turn LIMIT 1
        ), t AS (
            SELECT source, CAST(source_size AS BIGINT) AS source_size,
                CASE WHEN most / weight * open_weight <= open_words THEN most
                     ELSE weight * (SELECT open_words FROM first_open) / (SELECT open_weight FROM first_open) END AS target
            FROM l
        ), p AS (
            SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS drawn,
                CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ) SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
            drawn // source_size * size + greatest(0, least(size, drawn % source_size - before)) END AS taken FROM p
    """,
    "op5_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
        ), b AS (
            SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
        ), ds AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
        ), bs AS (
            SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b)
        ), n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
        SELECT doc_id, item_id, CAST(n_item AS INT) AS n_item, count(*) AS n_shared, count(*) / n_item AS containment
        FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= ceil(n_item * 0.8)
    """,
    "op11_merkle_manifest": oracle.MANIFEST,
    "op13_conversation_trie": oracle.TRIE,
}
