from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from termflow.operators import evaluate, ml
from termflow.plans.catalog import shared_pipeline as pipeline

from conftest import SF01


def test_lr_and_svm_on_full_and_reduced_features(spark):
    p = pipeline(spark, SF01)
    for features in ("full", "reduced"):
        train = p.vectors("train", features).cache()
        test = p.vectors("test", features).cache()
        size = p.size if features == "full" else p.m_size
        assert train.first().features.size == size
        # every document with a TF row is kept, also with an all-zero reduced vector
        assert train.count() == p.tf_long("train").select("doc_id").distinct().count()
        assert test.count() == p.tf_long("test").select("doc_id").distinct().count()
        for fit in (ml.fit_lr, ml.fit_svc):
            scored = ml.score(fit(train), test)
            m = evaluate.class_metrics(scored).first()
            assert m.accuracy >= 0.99, (features, fit.__name__, m)
            d = scored.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
            ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
            assert abs(ev.evaluate(d, {ev.metricName: "accuracy"}) - m.accuracy) < 1e-12
        train.unpersist()
        test.unpersist()


def test_model_comparison_has_four_rows(spark):
    from termflow.plans.catalog import QUERIES
    rows = QUERIES["model_comparison"](spark, SF01).collect()
    assert {(r.model, r.features) for r in rows} == {("lr", "full"), ("svm", "full"),
                                                     ("lr", "reduced"), ("svm", "reduced")}
    # every run is whole: it reads, tokenises and builds its own vectors
    assert all(min(r.preprocess_sec, r.train_sec, r.test_sec) > 0 for r in rows)
    assert all(r.total_sec >= r.preprocess_sec + r.train_sec + r.test_sec for r in rows)


def test_vectors_are_released_after_both_models(spark):
    from termflow.plans.classify import Preset
    p = pipeline(spark, SF01, Preset(prefix="EN", k=300))
    train, test = p.ml_vectors("full")
    p.ml_run("lr", "full")
    assert train.is_cached and p.ml_vectors("full")[0] is train
    p.ml_run("svm", "full")
    assert not train.is_cached and not test.is_cached


def test_phases_are_counted_without_forcing_actions(spark):
    """Rows of every phase; no count or cache job of its own, so that the
    vectors are filled by the first pass of the fit."""
    from termflow.plans.classify import Preset, pipeline as fresh, timed_run
    jobs = spark.sparkContext.statusTracker()
    p = fresh(spark, SF01, Preset(prefix="EN", k=300))
    spark.sparkContext.setJobGroup("phases", "")
    run = timed_run(p, "svm", "full")
    spark.sparkContext.setJobGroup("after", "")
    assert run["train_rows"] == p.counts("train")[1] and run["test_rows"] == p.counts("test")[1]
    assert run["preprocess_rows"] == run["train_rows"] + run["test_rows"]
    assert all(run[c] > 0 for c in ("preprocess_sec", "train_sec", "test_sec"))
    assert run["total_sec"] >= run["preprocess_sec"] + run["train_sec"] + run["test_sec"]
    assert jobs.getJobIdsForGroup("phases")
