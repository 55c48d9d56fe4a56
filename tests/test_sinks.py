import pytest
from pyspark.sql import functions as F

from termflow.session import scratch_path
from termflow.sources import sinks

ROWS = [(0, 554.517744123, 13.65), (1, 280.9, 6.99), (2, 198.7, 4.88)]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_history_round_trip_single_file(spark, fmt):
    path = scratch_path(spark, f"hist-{fmt}")
    sinks.write_single_file(sinks.history_frame(spark, ROWS), path, fmt)
    back = sinks.read_single_file(spark, path, sinks.HISTORY_SCHEMA, fmt)
    assert sorted(tuple(r) for r in back.collect()) == ROWS
    assert back.inputFiles() and len(back.inputFiles()) == 1      # one part file
    with pytest.raises(Exception):                                # like saveAsTextFile: no overwrite
        sinks.write_single_file(sinks.history_frame(spark, ROWS), path, fmt)


def test_a_report_of_any_size_is_paged(spark, tmp_path):
    from termflow.operators import evaluate
    texts = spark.range(500).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("D"), "id")).alias("doc_id"),
                                    F.concat(F.lit("text "), "id").alias("text"))
    predictions = texts.select("doc_id", F.lit(0).alias("label"), (F.col("doc_id") == "HOT").cast("int").alias("prediction"))
    report = sinks.write_report(evaluate.false_positives(predictions, texts), str(tmp_path / "fp"))
    found = list(sinks.pages(report, 20))
    assert [len(p) for p in found] == [20] * 8 + [7] and report.count() == 167
    assert {r.text for p in found for r in p} == {f"text {i}" for i in range(0, 500, 3)}
    assert list(sinks.pages(report.limit(0))) == []
