"""Variance-based feature selection (AG5-AG9, FN14, ML4, ML5).

The reference makes three passes over dense 20k-wide rows (count, sum, sum of
squared deviations). Here one aggregation of the exploded TF arrays by ``pos``
gives the central moments of the non-zeros: their number, sum and squared
deviations m2 from their own mean. Partial aggregates of such moments merge
without ever subtracting sums of squares, so a nearly constant feature keeps
its digits. The ``n - nnz`` absent entries are zeros; merging them in gives the
un-normalised variance (S18: no division by n)
``ss = sum((x - mean)^2) = m2 + mean_nz^2 * nnz * (n - nnz) / n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termflow import params
from termflow.operators.tf import count_documents, entries, is_small
from termflow.session import materialize


def feature_moments(rows: DataFrame) -> DataFrame:
    """(pos, nnz, sum_tf, m2) of the non-zeros, in one pass that reads ``pos``
    and ``tf`` alone; partial aggregation leaves at most K rows per task for
    the shuffle."""
    nnz = F.count(F.lit(1))
    return entries(rows).groupBy(F.col("pos").cast("int").alias("pos")).agg(
        nnz.alias("nnz"), F.sum("tf").alias("sum_tf"), (F.var_pop("tf") * nnz).alias("m2"))


def merge_moments(parts: DataFrame) -> DataFrame:
    """One row per position of moments (pos, nnz, sum_tf, m2) taken over
    disjoint parts of the documents, such as yesterday's corpus and today's:
    ``m2`` grows by each part's squared distance from the common mean."""
    at = Window.partitionBy("pos")
    mean = F.sum("sum_tf").over(at) / F.sum("nnz").over(at)
    shift = F.col("sum_tf") / F.col("nnz") - F.col("mean")
    return parts.withColumn("mean", mean).groupBy("pos").agg(
        F.sum("nnz").alias("nnz"), F.sum("sum_tf").alias("sum_tf"),
        F.sum(F.col("m2") + F.col("nnz") * shift * shift).alias("m2"))


def stats_from_moments(moments: DataFrame, n_docs: int) -> DataFrame:
    """AG7/AG8: (pos, sum_tf, mean_tf, ss) over ``n_docs`` documents, those
    without the feature included as zeros."""
    n, nnz = F.lit(float(n_docs)), F.col("nnz").cast("double")
    mean_nz = F.col("sum_tf") / nnz
    return moments.select("pos", "sum_tf", (F.col("sum_tf") / n).alias("mean_tf"),
                          (F.col("m2") + mean_nz * mean_nz * nnz * (n - nnz) / n).alias("ss"))


def feature_stats(rows: DataFrame, n_docs: int | None = None) -> DataFrame:
    """AG6-AG8: (pos, sum_tf, mean_tf, ss)."""
    return stats_from_moments(feature_moments(rows), count_documents(rows) if n_docs is None else n_docs)


def select_by_variance(stats: DataFrame, m: int = params.SELECTED_FEATURES,
                       mode: str = "checkpoint") -> DataFrame:
    """AG9/ML4 (fit): (new_pos, pos) for the ``m`` highest-variance features,
    new_pos 0 = highest. The ordering key keeps a fixed number of significant
    digits (S18), so it separates variances of any magnitude and ignores
    summation noise; ties go to the lower position. At most K rows are
    ranked."""
    key = F.format_string(f"%.{params.VARIANCE_KEY_DECIMALS}e", F.col("ss")).cast("double")
    order = (key.desc(), F.col("pos").asc())
    top = stats.select("pos", "ss").orderBy(*order).limit(m)
    ranked = top.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("int").alias("new_pos"),
                        F.col("pos").cast("int").alias("pos"))
    return materialize(ranked, mode)


def slice_vectors(vectors: DataFrame, selected: DataFrame, col: str = "features") -> DataFrame:
    """FN14 on ML vectors: ``VectorSlicer`` with the selected positions in
    falling-variance order (it keeps the given order, S19). The index list
    has at most M entries, the only thing brought to the driver."""
    from pyspark.ml.feature import VectorSlicer
    indices = [r["pos"] for r in selected.orderBy("new_pos").select("pos").collect()]
    slicer = VectorSlicer(inputCol=col, outputCol=f"{col}_selected", indices=indices)
    return (slicer.transform(vectors).drop(col)
            .withColumnRenamed(f"{col}_selected", col))


def apply_selection(rows: DataFrame, selected: DataFrame, m: int) -> DataFrame:
    """FN14/ML5 (transform): (doc_id, new_pos, tf) of the selected features,
    renumbered in falling variance order; values are not re-normalised (S19).
    Training and test both use the training selection."""
    lookup = selected.select("pos", "new_pos")
    lookup = F.broadcast(lookup) if is_small(lookup, m) else lookup
    return entries(rows, "doc_id").join(lookup, "pos", "inner").select("doc_id", "new_pos", "tf")
