from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from termflow.operators import evaluate

from conftest import docs_frame


def preds(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, label int, prediction int")


ROWS = [("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0), ("e", 0, 1), ("f", 0, 1), ("g", 0, 1), ("h", 1, 1)]


def test_outcomes_and_confusion(spark):
    p = preds(spark, ROWS)
    out = {r.doc_id: r.outcome for r in evaluate.outcomes(p).collect()}
    assert out == {"a": "TP", "b": "FN", "c": "FP", "d": "TN", "e": "FP", "f": "FP", "g": "FP", "h": "TP"}
    c = evaluate.confusion(p).first()
    assert tuple(c) == (3, 5, 2, 1, 4, 1)
    assert c.tp + c.fn == c.p and c.fp + c.tn == c.n


def test_f1_null_when_no_true_positive(spark):
    p = preds(spark, [("a", 1, 0), ("b", 0, 1)])
    r = evaluate.f1_report(evaluate.confusion(p)).first()
    assert r.f1 is None and r.recall == 0.0 and r.precision == 0.0
    r = evaluate.f1_report(evaluate.confusion(preds(spark, ROWS))).first()
    prec, rec = 2 / 6, 2 / 3
    assert abs(r.f1 - 2 * prec * rec / (prec + rec)) < 1e-15


def test_false_positive_report_limit(spark):
    p = preds(spark, ROWS)
    docs = docs_frame(spark, [(d, f"text of {d}") for d, _, _ in ROWS])
    got = [tuple(r) for r in evaluate.false_positives(p, docs).collect()]
    assert sorted(got) == [("c", "text of c"), ("e", "text of e"), ("f", "text of f")]


def test_false_positive_ids_keep_all_their_texts(spark):
    p = preds(spark, [("A", 0, 1), ("B", 0, 1), ("C", 0, 1), ("D", 0, 1), ("E", 0, 0)])
    docs = docs_frame(spark, [("A", "1"), ("A", "2"), ("A", "3"), ("B", "4"), ("C", "5"), ("D", "6"), ("E", "7")])
    got = sorted(tuple(r) for r in evaluate.false_positives(p, docs).collect())
    assert got == [("A", "1"), ("A", "2"), ("A", "3"), ("B", "4"), ("C", "5")]


def test_class_metrics_match_spark_evaluator(spark):
    p = preds(spark, ROWS)
    m = evaluate.class_metrics(p).first()
    d = p.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(m.accuracy - ev.evaluate(d, {ev.metricName: "accuracy"})) < 1e-12
    for name, metric in (("precision", "precisionByLabel"), ("recall", "recallByLabel"),
                         ("f_measure", "fMeasureByLabel")):
        want = ev.evaluate(d, {ev.metricName: metric, ev.metricLabel: 1.0})
        assert abs(m[name] - want) < 1e-12, name
    assert (m.tn, m.fp, m.fn, m.tp) == (1, 4, 1, 2)


def test_class_metrics_undefined_are_zero(spark):
    m = evaluate.class_metrics(preds(spark, [("a", 0, 0), ("b", 0, 0)])).first()
    assert (m.precision, m.recall, m.f_measure, m.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_confusion_matrix_rows_are_truth(spark):
    m = {r.label: (r.pred_0, r.pred_1) for r in evaluate.confusion_matrix(preds(spark, ROWS)).collect()}
    assert m == {0: (1, 4), 1: (1, 2)}
