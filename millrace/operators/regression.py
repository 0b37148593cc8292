"""Linear regression on one feature, learnt from sums so that the data is read once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.vectors import number

# First step size, number of gradient steps, change below which steps end, and the
# intercept every batch starts from.
STEP_SIZE, ITERATIONS, TOLERANCE = 0.1, 50, 1e-3
START_INTERCEPT = 1.0


@dataclass(frozen=True)
class LineModel:
    slope: float = 0.0
    intercept: float = 0.0


def moments(points: DataFrame, label: str = "label", feature: str = "feature") -> DataFrame:
    """One row of sums, all that gradient steps over the full batch need."""
    x, y = F.col(feature), F.col(label)
    return points.agg(
        F.count("*").cast("double").alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"),
        F.sum(x * y).alias("sxy"),
    )


def sgd_line(
    sums: DataFrame,
    slope: float = 0.0,
    intercept: float = START_INTERCEPT,
    step_size: float = STEP_SIZE,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(slope, intercept)`` after gradient steps of size ``step_size / sqrt(i)`` on the squared error.

    Steps end early once the model moves by less than ``tolerance`` of its own length.
    """
    w_next = f"m.w - {number(step_size)} / sqrt(i) * (m.w * sxx + m.b * sx - sxy) / n"
    b_next = f"m.b - {number(step_size)} / sqrt(i) * (m.w * sx + m.b * n - sy) / n"
    # a one-element transform names the new values, so that they are written once
    step = f"""element_at(transform(array(struct({w_next} AS w, {b_next} AS b)),
        v -> struct(v.w AS w, v.b AS b, i > 1 AND sqrt(pow(v.w - m.w, 2) + pow(v.b - m.b, 2))
            < {number(tolerance)} * greatest(sqrt(v.w * v.w + v.b * v.b), 1D) AS done)), 1)"""
    fitted = f"""aggregate(sequence(1, {iterations}),
        struct({number(slope)} AS w, {number(intercept)} AS b, false AS done),
        (m, i) -> if(m.done, m, {step}))"""
    return sums.where("n > 0").select(F.expr(fitted).alias("m")).select(
        F.col("m.w").alias("slope"), F.col("m.b").alias("intercept")
    )


def update(
    model: LineModel,
    points: DataFrame,
    label: str = "label",
    feature: str = "feature",
    carry_intercept: bool = False,
    step_size: float = STEP_SIZE,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> LineModel:
    """One batch of training; an empty batch leaves the model alone.

    The slope is carried from batch to batch.  The intercept starts anew in each one, as in Spark's
    own streaming regression, unless ``carry_intercept`` is set.
    """
    start = model.intercept if carry_intercept else START_INTERCEPT
    row = sgd_line(moments(points, label, feature), model.slope, start, step_size, iterations, tolerance).first()
    return LineModel(row["slope"], row["intercept"]) if row else model


def predict(feature: Column, model: LineModel) -> Column:
    return feature * F.lit(model.slope) + F.lit(model.intercept)


def exact_line(points: DataFrame, label: str = "label", feature: str = "feature") -> DataFrame:
    """Least-squares line and share of variance explained, the point gradient steps move towards."""
    y, x = F.col(label), F.col(feature)
    return points.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def predict_by(points: DataFrame, line: DataFrame, feature: str = "feature") -> DataFrame:
    """Add ``prediction`` by a one-row line that is computed within the same job."""
    slope = line.select("slope").scalar()
    intercept = line.select("intercept").scalar()
    return points.withColumn("prediction", F.col(feature) * slope + intercept)


def errors(predicted: DataFrame, label: str = "label") -> DataFrame:
    miss = F.col("prediction") - F.col(label)
    return predicted.agg(
        F.count("*").alias("n"), F.avg(F.abs(miss)).alias("mean_abs"), F.sqrt(F.avg(miss * miss)).alias("rmse")
    )


def standardise(points: DataFrame, *columns: str) -> DataFrame:
    """Columns moved to mean 0 and scaled to standard deviation 1, by sums from one pass."""
    means = points.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns]
        ).alias("s")
    ).scalar()
    scaled = {
        c: F.try_divide(F.col(c) - means.getField(f"{c}_mean"), means.getField(f"{c}_dev")) for c in columns
    }
    return points.withColumns(scaled)
