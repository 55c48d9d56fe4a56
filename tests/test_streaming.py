from pyspark.sql import functions as F

from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.session import scratch_path
from termflow.sources.corpus import documents_as_lines
from termflow.streaming.scoring import score_lines_stream

from conftest import SF001


def test_stream_scores_like_batch(spark):
    p = pipeline(spark, SF001)
    lines = documents_as_lines(spark, SF001).where(F.col("src_id") % 5 == 0).select("value")
    src = scratch_path(spark, "stream-src")
    # two files arrive: the stream processes them in two micro-batches
    lines.where(F.length("value") % 2 == 0).coalesce(1).write.text(src + "/a")
    lines.where(F.length("value") % 2 == 1).coalesce(1).write.text(src + "/b")
    sink = scratch_path(spark, "stream-sink")
    q = score_lines_stream(spark, src + "/*", p.dictionary, p.size, p.gd_model(), sink,
                           prefix="EN", max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    assert got.select("batch_id").distinct().count() == 2
    streamed = sorted(tuple(r) for r in got.select("doc_id", "label", "prediction").collect())
    batch = sorted(tuple(r) for r in p.gd_predictions().collect())
    assert streamed == batch


def test_stream_scores_spark_ml_model_like_batch(spark):
    from termflow.operators import ml
    p = pipeline(spark, SF001)
    train, _ = p.ml_vectors("reduced")
    model = ml.fit_svc(train)
    lines = documents_as_lines(spark, SF001).where(F.col("src_id") % 5 == 0).select("value")
    src = scratch_path(spark, "stream-src-ml")
    lines.coalesce(2).write.text(src)
    sink = scratch_path(spark, "stream-sink-ml")
    q = score_lines_stream(spark, src, p.dictionary, p.size, model, sink, prefix="EN",
                           selected=p.selected, m=p.m_size)
    q.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).select("doc_id", "label", "prediction").collect())
    batch = sorted(tuple(r) for r in ml.score(model, p.ml_vectors("reduced")[1]).collect())
    assert streamed == batch


def test_malformed_lines_fail_the_stream_or_are_counted(spark):
    import pytest
    from pyspark.errors import StreamingQueryException
    p = pipeline(spark, SF001)
    src = scratch_path(spark, "stream-src-bad")
    spark.createDataFrame([('<doc id="EN1" url="u" title="t">the the end</doc>',), ("no markers",)], "value string"
                          ).coalesce(1).write.text(src)
    q = score_lines_stream(spark, src, p.dictionary, p.size, p.gd_model(), scratch_path(spark, "s"), prefix="EN")
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(300)
    sink = scratch_path(spark, "s")
    score_lines_stream(spark, src, p.dictionary, p.size, p.gd_model(), sink, prefix="EN",
                       parse_mode="DROPMALFORMED").awaitTermination(300)
    assert spark.read.parquet(sink).count() == 1
    assert tuple(spark.read.parquet(sink + "_malformed").select("n_ok", "n_bad").first()) == (1, 1)
