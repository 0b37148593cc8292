from collections import Counter, defaultdict
from math import comb

import numpy as np
import pytest

from millrace.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, ceiling=2.0):
    """Targets by handing the excess on again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), share * sum(sizes.values())
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > ceiling * sizes[s]}
        if not full:
            return target | {s: weight[s] * unit for s in open_}
        for s in full:
            target[s] = ceiling * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 900, "c": 1, None: 30}, {"a": 0, "b": 10}, {"é": 7, "z": 7, "Z": 7, "": 50}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(filled(sizes))


def test_splits_are_exact():
    left = mixing.left_quotas([10, 0, 7, 3], 2, 4, [1, 0, 4])
    assert sum(left) == 10 and all(0 <= x <= q for x, q in zip(left, [10, 0, 7, 3], strict=True))
    assert left == mixing.left_quotas([10, 0, 7, 3], 2, 4, [1, 0, 4])
    big = mixing.left_quotas([3 * 10**9, 10**9], 1, 2, [5])
    assert sum(big) == 2 * 10**9 and abs(big[0] - 1.5 * 10**9) < 10**6


@pytest.mark.parametrize(("good", "bad", "drawn"), [(5, 7, 6), (1, 1, 1), (20, 30, 10), (1000, 3, 1000), (3, 0, 2), (0, 4, 2)])
def test_draws_follow_the_hypergeometric_law(good, bad, drawn):
    rng = np.random.default_rng(1)
    seen = Counter(mixing.hypergeometric(rng, good, bad, drawn) for _ in range(20_000))
    for k in range(min(good, drawn) + 1):
        chance = comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) if drawn >= k else 0
        assert seen.pop(k, 0) / 20_000 == pytest.approx(chance, abs=0.02)
    assert not seen


def test_draws_of_huge_populations_have_mean_and_spread():
    rng = np.random.default_rng(2)
    got = np.array([mixing.hypergeometric(rng, 3 * 10**10, 10**10, 2 * 10**10) for _ in range(60)]) - 1.5 * 10**10
    spread = (2 * 10**10 * 0.75 * 0.25 * 0.5) ** 0.5
    assert abs(got.mean()) < 4 * spread / 60**0.5 and 0.6 * spread < got.std() < 1.5 * spread


def test_shards_get_disjoint_exact_blocks(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows, pieces = mixing.mix(docs, shards=5, block_words=50)
    source = {(r["doc_id"], r["row_hash"]): r for r in rows.collect()}
    taken, shards, blocks = Counter(), Counter(), defaultdict(set)
    for p in pieces.collect():
        row = source[p["doc_id"], p["row_hash"]]
        assert 0 <= p["start"] and p["start"] + p["n_words"] <= row["size"] and 0 <= p["shard"] < 5
        taken[row["source"]] += p["n_words"]
        shards[p["shard"]] += p["n_words"]
        spans = blocks[p["doc_id"], p["row_hash"], p["copy"]]
        words = set(range(p["start"], p["start"] + p["n_words"]))
        assert not words & spans
        spans |= words
    target = {r["source"]: r["target"] for r in source.values()}
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    total = sum(shards.values())
    assert max(abs(n - total / 5) for n in shards.values()) < 50 * len(target)  # equal but for sources' last blocks


def test_reruns_agree_and_nothing_is_taken_thrice(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    first = sorted(map(tuple, mixing.taken_words(docs).collect()))
    assert first == sorted(map(tuple, mixing.taken_words(docs.repartition(7)).collect()))
    assert all(0 <= taken <= 2 * size for _, size, _, _, taken in first)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) == 2


def test_odd_rows(odd, none):
    rows = mixing.taken_words(odd, block_words=100).collect()
    assert len(rows) == 12
    assert {r["size"] for r in rows if r["doc_id"] == 3} == {0} and all(r["taken"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.where("k1 = 'x' AND score = 'y'").count() == mixed.count() > 0
    assert mixing.taken_words(none).count() == mixing.mixed_documents(none).count() == 0
