"""Spark ML classifiers on the TF vectors (FN15, ML16-ML19).

Both estimators run with ``maxIter=100`` and every other setting at its
default, as in the reference: no regularisation, an intercept,
standardisation, tolerance 1e-6; logistic regression thresholds the
probability at 0.5, the linear SVM the raw margin at 0.0. Their optimisers
aggregate gradients with ``treeAggregate`` over the cached vectors.
"""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow import params
from termflow.session import scratch_path


def fit_lr(train: DataFrame, max_iter: int = params.ML_MAX_ITER):
    """ML16."""
    return LogisticRegression(maxIter=max_iter, featuresCol="features", labelCol="label").fit(train)


def fit_svc(train: DataFrame, max_iter: int = params.ML_MAX_ITER):
    """ML18."""
    return LinearSVC(maxIter=max_iter, featuresCol="features", labelCol="label").fit(train)


def _portable(model, spark: SparkSession):
    """A fitted model's scoring function carries its training summary, and with
    it the session, which cannot travel once observed metrics were used in it.
    Saved and loaded, the model is its coefficients alone."""
    if not model.hasSummary:
        return model
    path = scratch_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def score(model, test: DataFrame) -> DataFrame:
    """ML17/ML19 + PR10 + FN15: (doc_id, label INT, prediction INT)."""
    return _portable(model, test.sparkSession).transform(test).select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )


ESTIMATORS = {"lr": fit_lr, "svm": fit_svc}
