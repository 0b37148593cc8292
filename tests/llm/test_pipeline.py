from collections import Counter

import corpus_pipeline
from millrace.llm import decontamination, mixing, simhash, toxicity
from millrace.session import scratch_path


def written(spark, df, name):
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, data):
    """Each stage against what its operator says of the rows that the stage before kept."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(written(spark, stage(spark, kept[-1], data), f"stage{number}"))
    ids = [Counter(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    assert all(k.columns == columns for k in kept[:-1])
    model = toxicity.train(docs, spark.read.parquet(f"{data}/labels.parquet"))
    assert set(ids[1]) == {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert set(ids[2]) == {r["component_id"] for r in simhash.near_duplicates(kept[1]).collect()}
    bad = decontamination.contaminated(kept[2], spark.read.parquet(f"{data}/benchmark.parquet"))
    assert set(ids[2]) - set(ids[3]) == {r["doc_id"] for r in bad.collect()}
    rows, _ = mixing.mix(kept[3])
    facts = {r["doc_id"]: r for r in rows.collect()}
    taken, target = Counter(), {}
    for i, copies in ids[4].items():
        taken[facts[i]["source"]] += copies * facts[i]["size"]
        target[facts[i]["source"]] = facts[i]["target"]
        assert copies <= 2
    largest = Counter()
    for r in facts.values():
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - t) <= largest[s] for s, t in target.items())
    last = kept[5]
    counts = Counter(r["shard"] for r in last.select("shard").collect())
    assert ids[5] == ids[4] and max(counts.values()) - min(counts.values()) <= 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in last.collect())


def test_odd_rows_pass_through(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing like this is in there at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(docs.columns) < set(out.columns) and out.count() > 0
