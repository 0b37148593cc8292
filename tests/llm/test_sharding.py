import random
from collections import Counter

import pytest

from millrace.llm import sharding


def fewest_bytes(old, shards):
    """Bytes of the cheapest way to equal counts: successive cheapest paths on the network of rows and shards."""
    total = sum(map(len, old.values()))
    base, extra = divmod(total, shards)
    # every row on its own: it stays for nothing or moves for its size; the larger capacities may be anywhere
    best = None
    from itertools import combinations

    for larger in combinations(range(shards), extra):
        moved = 0
        for shard, sizes in old.items():
            room = base + (shard in larger) if shard < shards else 0
            moved += sum(sorted(sizes)[: max(len(sizes) - room, 0)])
        best = moved if best is None else min(best, moved)
    return best


@pytest.mark.parametrize("seed,shards", [(1, 4), (2, 3), (3, 6), (4, 1)])
def test_fewest_bytes_move(spark, seed, shards):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randint(0, 40), min(rng.randint(0, 7), rng.randint(0, 5))) for i in range(61)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, here int").repartition(4)
    got, moves = sharding.reshard(docs, shards, old_shard="here")
    got = got.collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 61 and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(shards))
    for shard in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    moved = sum(r["size"] for r in got if r["shard"] != r["old_shard"])
    old = {}
    for _, text, here in rows:
        old.setdefault(here, []).append(len(text) + 8)
    assert moved == fewest_bytes(old, shards)
    assert moves.selectExpr("sum(to_place - from_place)").first()[0] == 61


def test_round_trip_of_files(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(3)
    docs.write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    moves = sharding.rewrite(stored, 5, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    assert back.groupBy("shard").count().selectExpr("max(count) - min(count)").first()[0] <= 1
    assert {r["shard"] for r in moves.collect()} == {3, 4}


def test_odd_rows(spark, odd, none):
    out = sharding.sharded(odd, 4)
    rows = out.collect()
    assert Counter(r["shard"] for r in rows) == {0: 3, 1: 3, 2: 3, 3: 3} and len({(r["shard"], r["slot"]) for r in rows}) == 12
    assert [r["size"] for r in rows if r["doc_id"] == 3] == [8] and set(odd.columns) <= set(out.columns)
    assert sharding.sharded(none, 4).count() == 0
