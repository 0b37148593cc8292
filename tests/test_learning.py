import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import vectors as vx
from millrace.operators import kmeans, regression


def test_parse(spark):
    frame = spark.createDataFrame([("(3,[1.5,2])",), ("-1.74,1.66",), ("0.5,1 2",), ("junk",)], "l STRING")
    got = [tuple(r) for r in frame.select(vx.parse_labeled(F.col("l")).alias("p")).select("p.*").collect()]
    assert got[:3] == [(3.0, [1.5, 2.0]), (-1.74, [1.66]), (0.5, [1.0, 2.0])]
    assert got[3][0] is None
    vec = spark.createDataFrame([("[172153.58,22]",), ("nope",)], "l STRING").select(vx.parse_vector(F.col("l")))
    assert [r[0] for r in vec.collect()] == [[172153.58, 22.0], None]


def random_points(seed, n, dim):
    rng = random.Random(seed)
    return [tuple(rng.gauss(5 * (i % 3), 1) for _ in range(dim)) for i in range(n)]


@pytest.mark.parametrize("k", [3, 300])
def test_assign(spark, k):
    points = random_points(1, 60, 2)
    model = kmeans.random_centres(k, 2, seed=4)
    frame = spark.createDataFrame([(i, list(p)) for i, p in enumerate(points)], "i INT, features ARRAY<DOUBLE>")
    for row in kmeans.assign(frame, model).collect():
        scores = [sum((a - b) ** 2 for a, b in zip(row["features"], c)) for c in model.centres]
        assert math.isclose(scores[row["cluster"]], min(scores))


@pytest.mark.parametrize("decay, per_point", [(1.0, False), (0.5, False), (0.9, True)])
def test_update_matches_the_library(spark, decay, per_point):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    start = kmeans.KMeansModel(((0.0, 0.0), (4.0, 4.0), (100.0, 100.0)), (2.0, 3.0, 1.0))
    theirs = StreamingKMeansModel([list(c) for c in start.centres], list(start.weights))
    ours = start
    for seed in (1, 2):
        points = random_points(seed, 50, 2)
        frame = spark.createDataFrame([(list(p),) for p in points], "features ARRAY<DOUBLE>")
        ours = kmeans.update(ours, frame, decay=decay, per_point=per_point)
        theirs = theirs.update(
            spark.sparkContext.parallelize([Vectors.dense(p) for p in points], 2), decay,
            "points" if per_point else "batches",
        )
    for mine, other in zip(ours.centres, theirs.centers):
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(mine, other))
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(ours.weights, theirs.clusterWeights))


def test_dying_cluster_is_replaced(spark):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    start = kmeans.KMeansModel(((0.0, 0.0), (1e6, 1e6)), (0.0, 0.0))
    points = random_points(3, 40, 2)
    ours = kmeans.update(start, spark.createDataFrame([(list(p),) for p in points], "features ARRAY<DOUBLE>"))
    theirs = StreamingKMeansModel([list(c) for c in start.centres], [0.0, 0.0]).update(
        spark.sparkContext.parallelize([Vectors.dense(p) for p in points], 2), 1.0, "batches"
    )
    assert ours.weights == tuple(theirs.clusterWeights) == (20.0, 20.0)
    for mine, other in zip(ours.centres, theirs.centers):
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(mine, other))


def test_assign_ties_and_missing(spark):
    model = kmeans.KMeansModel(((1.0,), (1.0,), (0.0,)), (0.0,) * 3)
    frame = spark.createDataFrame([([1.0],), (None,), ([-2.0],)], "features ARRAY<DOUBLE>")
    assert [r["cluster"] for r in kmeans.assign(frame, model).collect()] == [0, None, 2]


def test_empty_batch_changes_nothing(spark):
    start = kmeans.KMeansModel(((0.0,), (1.0,)), (2.0, 3.0))
    assert kmeans.update(start, spark.createDataFrame([], "features ARRAY<DOUBLE>")) == start
    line = regression.LineModel(0.5, 0.25)
    assert regression.update(line, spark.createDataFrame([], "label DOUBLE, feature DOUBLE")) == line


def line_points(seed=1, n=200):
    rng = random.Random(seed)
    xs = [rng.uniform(-1, 1) for _ in range(n)]
    return [(0.3 - x + rng.gauss(0, 0.1), x) for x in xs]


@pytest.mark.parametrize("iterations, tolerance", [(50, 1e-3), (50, 0.0), (3, 0.0), (200, 1e-2)])
def test_sgd_matches_the_library(spark, iterations, tolerance):
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    points = line_points()
    frame = spark.createDataFrame(points, "label DOUBLE, feature DOUBLE")
    ours = regression.LineModel()
    weights = [0.0]
    for _ in range(2):
        ours = regression.update(ours, frame, iterations=iterations, tolerance=tolerance)
        theirs = LinearRegressionWithSGD.train(
            spark.sparkContext.parallelize([LabeledPoint(y, [x]) for y, x in points], 2),
            iterations=iterations, step=0.1, miniBatchFraction=1.0, initialWeights=weights, intercept=True,
            convergenceTol=tolerance, regType=None,
        )
        weights = list(theirs.weights)
        assert math.isclose(ours.slope, weights[0], rel_tol=1e-9)
        assert math.isclose(ours.intercept, theirs.intercept, rel_tol=1e-9)


def test_sgd_moves_to_the_exact_line(spark):
    frame = regression.standardise(spark.createDataFrame(line_points(), "label DOUBLE, feature DOUBLE"), "label", "feature")
    exact = regression.exact_line(frame).first()
    model = regression.LineModel()
    for _ in range(20):
        model = regression.update(model, frame, carry_intercept=True, tolerance=0.0)
    assert math.isclose(model.slope, exact["slope"], abs_tol=1e-6)
    assert math.isclose(model.intercept, exact["intercept"], abs_tol=1e-6)


def test_predict_and_errors(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "label DOUBLE, feature DOUBLE")
    scored = frame.withColumn("prediction", regression.predict(F.col("feature"), regression.LineModel(1.0, -2.0)))
    assert [r["prediction"] for r in scored.collect()] == [0.0, 2.0]
    assert tuple(regression.errors(scored).first()) == (2, 1.0, 1.0)
