from pyspark.sql import functions as F

from termflow.operators import evaluate
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.run import main
from termflow.session import scratch_path
from termflow.sources.corpus import documents_as_lines, write_doc_lines

from conftest import SF001


def _write_lines(spark):
    lines = documents_as_lines(spark, SF001)
    is_test = F.col("src_id") % 5 == 0
    train, test = scratch_path(spark, "cli-train"), scratch_path(spark, "cli-test")
    write_doc_lines(lines.where(~is_test), train)
    write_doc_lines(lines.where(is_test), test)
    return train, test


def test_gd_command_matches_table_pipeline(spark):
    train, test = _write_lines(spark)
    out = scratch_path(spark, "cli-history")
    res = main(["--prefix", "EN", "gd", train, test, "0.5", "3", "0.001", out], spark=spark)
    want = pipeline(spark, SF001)
    assert tuple(res["confusion"].first()) == tuple(evaluate.confusion(want.gd_predictions()).first())
    written = spark.read.option("header", "true").csv(out).count()
    assert written == len(want.gd_model().history) == 3


def test_ml_command_runs(spark):
    train, test = _write_lines(spark)
    res = main(["--prefix", "EN", "--m", "500", "ml", "svm", "reduced", train, test], spark=spark)
    row = res["metrics"].first()
    assert row.model == "svm" and row.features == "reduced" and row.tn + row.fp + row.fn + row.tp > 0
