"""Proof that a fitted logistic regression is the optimum of its loss.

The loss is the mean log-loss plus ``reg / 2`` times the squared coefficients on features of unit variance; intercepts
are free. It is convex, so a fit is optimal exactly where its gradient is zero. For class c and feature j of standard
deviation s this reads, times the number of rows,

    sum of p_c x_j over all rows  +  rows * reg * s^2 * coefficient  =  sum of x_j over the rows of class c

The right side depends on the data alone. The left side is the fit's, and the difference of both is the gradient.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.plans import model
from moodstream.plans.model import Features
from moodstream.session import materialise


def sparse_features(df: DataFrame, keep: list, column: str = "features") -> DataFrame:
    """``keep`` with one row ``(bucket, x)`` for every stored entry of a sparse vector."""
    parts = F.unwrap_udt(column)
    pairs = F.arrays_zip(parts.getField("indices").alias("bucket"), parts.getField("values").alias("x"))
    return df.select(*keep, F.inline(pairs).alias("bucket", "x"))


def coefficients(fitted: PipelineModel, spark) -> DataFrame:
    """``(position, bucket, beta)`` of the classes the model has coefficients for: with two classes, the second alone.

    The driver holds the coefficient matrix as part of the model; its size is features times classes, whatever the data.
    """
    matrix = fitted.stages[-2].coefficientMatrix.toArray()
    first = 1 if len(matrix) == 1 else 0
    rows = [(first + c, j, float(matrix[c][j])) for c in range(matrix.shape[0]) for j in range(matrix.shape[1]) if matrix[c][j]]
    return spark.createDataFrame(rows, "position int, bucket int, beta double")


def gradient(rows: DataFrame, fitted: PipelineModel, features: Features = model.TFIDF, reg: float | None = None) -> DataFrame:
    """``(class, bucket, observed, expected, pull, sd, gradient)`` over all training rows, in long form.

    ``observed`` is the class's own sum of the feature, ``expected`` the sum weighted by the fitted probabilities,
    ``pull`` the penalty's term, and ``gradient`` their mean difference in units of the feature's standard deviation:
    the derivative of the loss in the space where the fit was made. Features that no row has are left out. The rows
    that were fitted must be given: those with a text and a known label.
    """
    classifier, names = fitted.stages[-2], fitted.stages[-1].getLabels()
    reg = classifier.getOrDefault("regParam") if reg is None else reg
    used = model.label_position(model.with_text(rows, features), fitted, features.label).filter(F.col("label").isNotNull())
    prepared = model.prepare(used, fitted, features)
    scored = PipelineModel(stages=fitted.stages[-2:]).transform(prepared)
    scored = materialise(scored.select(F.col("label").cast("int").alias("label"), vector_to_array("probability").alias("p"), "features"), "fitted-rows")
    n = scored.count()
    shown = [c for c in range(len(names)) if len(names) != 2 or c == 1]
    entries = sparse_features(scored, ["label", "p"])
    # One aggregation per feature; tasks add up their own rows first, so a frequent feature sends partial sums only.
    sums = entries.groupBy("bucket").agg(
        F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"),
        *[F.sum(F.when(F.col("label") == c, F.col("x")).otherwise(0.0)).alias(f"o{c}") for c in shown],
        *[F.sum(F.col("x") * F.get("p", F.lit(c))).alias(f"e{c}") for c in shown],
    )
    variance = (F.col("sxx") - F.col("sx") * F.col("sx") / n) / max(n - 1, 1)
    by_class = F.array(*[
        F.struct(F.lit(c).alias("position"), F.lit(names[c]).alias("class"), F.col(f"o{c}").alias("observed"), F.col(f"e{c}").alias("expected")) for c in shown
    ])
    long = sums.select("bucket", F.greatest(variance, F.lit(0.0)).alias("variance"), F.inline(by_class))
    met = long.join(coefficients(fitted, rows.sparkSession), ["position", "bucket"], "left")
    pull = F.lit(n * reg) * F.col("variance") * F.coalesce("beta", F.lit(0.0))
    sd = F.sqrt("variance")
    off = F.col("expected") + F.col("pull") - F.col("observed")
    return met.withColumn("pull", pull).select(
        "class", "bucket", "observed", "expected", "pull", sd.alias("sd"), F.when(sd > 0, off / (n * sd)).otherwise(0.0).alias("gradient"),
    )


def certificate(
    rows: DataFrame, fitted: PipelineModel, features: Features = model.TFIDF, reg: float | None = None, found: DataFrame | None = None
) -> DataFrame:
    """One row: ``loss`` at the fit, ``largest`` gradient component of coefficients, ``offset``, that of intercepts, and ``excess``.

    ``found`` is the result of ``gradient`` where that is at hand.

    The loss is at least ``reg``-strongly convex in the coefficients, so it lies no more than ``excess``, the squared
    gradient over ``2 reg``, above its minimum for the fitted intercepts; these are optimal where ``offset`` is zero,
    that is where the mean probability of each class is its share of the rows.
    """
    classifier = fitted.stages[-2]
    reg = classifier.getOrDefault("regParam") if reg is None else reg
    found = materialise(gradient(rows, fitted, features, reg), "gradient") if found is None else found
    used = model.label_position(model.with_text(rows, features), fitted, features.label).filter(F.col("label").isNotNull())
    scored = model.score(used, fitted, features).select(F.col("label").cast("int").alias("label"), vector_to_array("probability").alias("p"))
    shares = [F.abs(F.avg(F.get("p", F.lit(c)) - (F.col("label") == c).cast("double"))) for c in range(classifier.numClasses)]
    mean, offset = scored.agg(F.avg(-F.log(F.get("p", F.col("label")))), F.greatest(*shares, F.lit(0.0))).first()
    worst = found.agg(F.max(F.abs("gradient")), F.sum(F.col("gradient") ** 2)).first()
    squares = coefficients(fitted, rows.sparkSession).join(found.select("bucket", "sd").distinct(), "bucket")
    # The penalty of a coefficient is half of itself squared, in units of the feature's deviation.
    penalty = squares.agg(F.sum(F.col("beta") ** 2 * F.col("sd") ** 2)).first()[0] or 0.0
    return rows.sparkSession.createDataFrame(
        [(mean + reg / 2 * penalty, worst[0], offset, worst[1] / (2 * reg))], "loss double, largest double, offset double, excess double"
    )
