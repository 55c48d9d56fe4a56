"""Evaluation reports (IO5, PR10, PR11, JN3, AG11, AG13, ML12-ML15, ML20-ML25).

Every report is one aggregation over the prediction table
``(doc_id, label, prediction)``; nothing is collected row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termflow import params


def _is(label: int, prediction: int) -> Column:
    return (F.col("label") == label) & (F.col("prediction") == prediction)


def outcomes(predictions: DataFrame) -> DataFrame:
    """ML12: TP / FN / FP / TN per document."""
    outcome = (F.when(_is(1, 1), "TP").when(_is(1, 0), "FN")
               .when(_is(0, 1), "FP").otherwise("TN"))
    return predictions.select("doc_id", "label", outcome.alias("outcome"))


def confusion(predictions: DataFrame) -> DataFrame:
    """AG11/ML13: one row (p, n, tp, fn, fp, tn)."""
    return predictions.agg(
        F.count_if(F.col("label") == 1).cast("long").alias("p"),
        F.count_if(F.col("label") == 0).cast("long").alias("n"),
        F.count_if(_is(1, 1)).cast("long").alias("tp"),
        F.count_if(_is(1, 0)).cast("long").alias("fn"),
        F.count_if(_is(0, 1)).cast("long").alias("fp"),
        F.count_if(_is(0, 0)).cast("long").alias("tn"),
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """ML20: the 2x2 matrix with rows = true label, columns = predicted label
    (``pred_0``, ``pred_1``), one row per label present."""
    return predictions.groupBy("label").agg(
        F.count_if(F.col("prediction") == 0).cast("long").alias("pred_0"),
        F.count_if(F.col("prediction") == 1).cast("long").alias("pred_1"),
    )


def f1_report(conf: DataFrame) -> DataFrame:
    """ML14: recall = TP/P, precision = TP/(TP+FP), F1 NULL when TP = 0
    (the reference prints 'NaN (zero TP)')."""
    tp, fp, p = (F.col(c).cast("double") for c in ("tp", "fp", "p"))
    precision = F.when(tp + fp > 0, tp / (tp + fp))
    recall = F.when(p > 0, tp / p)
    f1 = F.when(tp > 0, F.lit(2.0) * precision * recall / (precision + recall))
    return conf.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def false_positives(predictions: DataFrame, docs: DataFrame,
                    limit: int = params.FALSE_POSITIVE_LIMIT) -> DataFrame:
    """ML15 (PR11 + JN3 + AG13): the ``limit`` lowest false-positive ids, each
    with every whole text that has that id. The ids are cut first (a top-k on
    ids alone), so the broadcast side has at most ``limit`` rows and texts are
    scanned once without a shuffle."""
    ids = predictions.where(_is(0, 1)).select("doc_id").distinct().orderBy("doc_id").limit(limit)
    return docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")


def class_metrics(predictions: DataFrame) -> DataFrame:
    """ML20-ML24: confusion counts (rows = truth, labels 0 and 1), accuracy
    and precision / recall / F-measure of class 1, each 0.0 when undefined,
    as Spark's multiclass metrics report them."""
    c = predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_is(0, 0)).alias("c00"), F.count_if(_is(0, 1)).alias("c01"),
        F.count_if(_is(1, 0)).alias("c10"), F.count_if(_is(1, 1)).alias("c11"),
    )
    tp, fp, fn = F.col("c11").cast("double"), F.col("c01").cast("double"), F.col("c10").cast("double")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return c.select(
        F.col("c00").cast("long").alias("tn"), F.col("c01").cast("long").alias("fp"),
        F.col("c10").cast("long").alias("fn"), F.col("c11").cast("long").alias("tp"),
        F.when(F.col("total") > 0, (F.col("c00") + F.col("c11")) / F.col("total"))
        .otherwise(0.0).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
    ).withColumn(
        "f_measure",
        F.when(F.col("precision") + F.col("recall") > 0,
               2.0 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
        .otherwise(0.0),
    )
