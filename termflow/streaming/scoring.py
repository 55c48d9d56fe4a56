"""Score document-line files as they arrive (IO2 + PR4 + ML3 + ML11, or
ML17/ML19 for a Spark ML model, per micro-batch).

A file stream of lines is parsed, turned into TF rows with the *training*
dictionary and scored with fitted gradient-descent weights, exactly like the
batch test phase. ``foreachBatch`` runs the batch operators on each
micro-batch; each batch is written to its own ``batch_id=N`` folder with
overwrite, so a batch that is retried after a failure replaces its own
output instead of duplicating it. A document id repeated across two batches
is scored in each batch separately (within a batch, repeats merge as in S9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termflow import params
from termflow.functions.parse import parse_doc_lines, quarantine_doc_lines
from termflow.operators import gd, ml, tf
from termflow.session import scratch_path


def score_frame(rows: DataFrame, model, size: int, prefix: str,
                selected: DataFrame | None = None, m: int | None = None) -> DataFrame:
    """(doc_id, label, prediction) for TF rows: gradient-descent weights
    (ML11), or a fitted Spark ML model on the full vectors or, with
    ``selected``, on the variance-selected ones (ML17/ML19)."""
    if isinstance(model, gd.GdModel):
        return gd.predict_gd(rows, model, prefix)
    if selected is None:
        vectors = tf.tf_vectors(rows, size, prefix)
    else:
        vectors = tf.selected_vectors(rows, selected, m, prefix)
    return ml.score(model, vectors)


def score_lines_stream(spark: SparkSession, source_dir: str, dictionary: DataFrame, size: int,
                       model, sink_dir: str, checkpoint: str | None = None,
                       prefix: str = params.REFERENCE_LABEL_PREFIX,
                       available_now: bool = True, max_files_per_trigger: int | None = None,
                       selected: DataFrame | None = None, m: int | None = None,
                       parse_mode: str = "FAILFAST") -> StreamingQuery:
    """Start the stream; returns the running query (call ``awaitTermination``).
    ``model`` is a ``GdModel`` or a fitted Spark ML classification model
    (with ``selected``/``m`` when it was trained on selected features).

    A malformed line fails the stream, as it fails a batch run. With
    ``parse_mode="DROPMALFORMED"`` it is kept apart and counted: every batch
    writes (n_ok, n_bad, n_null) to ``{sink_dir}_malformed/batch_id=N`` and the
    lines themselves to ``{sink_dir}_rejects/batch_id=N``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        sink = sink_dir.rstrip("/")
        if parse_mode == "DROPMALFORMED":
            kept = quarantine_doc_lines(batch, f"{sink}_rejects/batch_id={batch_id}", mode="overwrite")
            docs = kept.docs
            spark.createDataFrame([kept.counts], "n_ok long, n_bad long, n_null long").write.mode("overwrite").parquet(
                f"{sink}_malformed/batch_id={batch_id}")
        else:
            docs = parse_doc_lines(batch, parse_mode)
        preds = score_frame(tf.tf_rows(docs, dictionary, size), model, size, prefix, selected, m)
        preds.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{sink}/batch_id={batch_id}")

    writer = (lines.writeStream.foreachBatch(score_batch)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "score-stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
