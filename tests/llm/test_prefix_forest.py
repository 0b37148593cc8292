import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import prefix_forest
from millrace.llm.queries import QUERIES


def usable(vector):
    return vector is not None and any(vector) and all(x is not None and np.isfinite(x) for x in vector)


def brute(rows, k=20):
    """Whole answers, rows being (vec_id, vector)."""
    rows = list({(i, tuple(v)) for i, v in rows if i is not None and usable(v)})
    out = {}
    for q, v in sorted(rows):
        if q % 20 == 0:
            scored = sorted((-float((np.array(w) * np.array(v)).sum()), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df, **settings):
    out = {}
    for r in sorted(prefix_forest.nearest(df, F.col("vec_id") % 20 == 0, **settings).collect()):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in v] for q, v in out.items()}


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, node string, vec string")


def extended(rows):
    return [(i, v, None, "n", "v") for i, v in rows]


def test_all_vectors_are_compared_where_the_number_asks_for_it(spark):
    """Enough candidates: equal to brute force, with lengths that differ, ties, copies and a small shard size."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8)) * rng.uniform(0.1, 3, (300, 1))
    x[40:120] = x[40]
    x[200:230] = np.eye(8)[rng.integers(0, 8, 30)]
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    got, want = found(frame(spark, extended(rows), "double"), trees=4, candidates=10**6, size=16), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in got for a, b in zip(got[q], want[q], strict=True))


def test_odd_rows(spark):
    """Unusable vectors, null and repeated rows, vectors of several lengths, fewer than k rows, an empty table."""
    rows = [(0, None), (20, []), (40, [0.0, 0.0]), (60, [1.0, float("nan")]), (80, [float("inf"), 1.0]), (100, [1.0, None]), (None, [1.0, 1.0])]
    rows += [(120, [1.0, 2.0]), (120, [1.0, 2.0]), (121, [2.0, 1.0]), (122, [2.0, 1.0]), (123, [-1.0, 0.0]), (140, [1.0, 0.0, 0.0]), (141, [0.5, 0.0, 0.0])]
    df = frame(spark, extended(rows))
    assert found(df, trees=3) == brute(rows) == {120: [(121, 4.0), (122, 4.0), (123, -1.0)], 140: [(141, 0.5)]}
    assert found(df.limit(0), trees=3) == {}
    assert found(df, trees=3, k=1) == brute(rows, 1)


def test_strings_that_never_differ(spark):
    """Vectors that differ in their last bits share whole strings; their shards are cut into chunks and none is lost."""
    rows = [(i, [1.0 + i * 2.0**-45, 0.5, 0.25, 0.0]) for i in range(100)]
    assert found(frame(spark, extended(rows), "double"), trees=2, candidates=10, size=7) == brute(rows)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_recall_with_few_candidates(spark, spread):
    """Clustered vectors: a twentieth of the rows is enough for nine of ten."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 32))
    x = (centres[rng.integers(0, 60, 3000)] + spread * 0.3 * rng.standard_normal((3000, 32))).astype(np.float32)
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    got = found(frame(spark, extended(rows)), trees=16, candidates=1500, size=256)
    scores = x.astype(np.float64) @ x[::20].astype(np.float64).T
    hits = 0
    for n, q in enumerate(range(0, 3000, 20)):
        order = [i for i in np.argsort(-scores[:, n], kind="stable").tolist() if i != q][:20]
        hits += len(set(order) & {i for i, _ in got[q]})
    assert hits / (150 * 20) >= 0.9


def test_query(spark, data):
    df = QUERIES["op12_nearest_neighbours"](spark, data)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    want = brute(rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in want[q]} & set(got[q])) for q in want)
    assert hits >= 0.9 * 20 * len(want)
