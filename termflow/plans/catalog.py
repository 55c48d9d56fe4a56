"""
each ``(spark, sf_dir) -> DataFrame`` over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from termflow.functions import parse, text
from termflow.operators import certify, evaluate, frequent, gd, selection, tf
from termflow.plans.classify import (DOCUMENTS_PREFIX, Pipeline, Preset, metrics_frame, pipeline,
                                     pipeline_from_lines, round_doubles, timed_run)
from termflow.session import scratch_path
from termflow.sources import sinks
from termflow.sources.corpus import (documents_as_lines, on_test_side, read_doc_lines, read_table,
                                     write_doc_lines)

# Presets of the registered queries (see FIXTURES.md).
MAIN = Preset(prefix=DOCUMENTS_PREFIX)
HARD = Preset(k=200, prefix="EN5", learning_rate=2.0, iterations=5)  # all four outcomes occur
NO_TRUE_POSITIVE = Preset(prefix="EN5")                              # S15: F1 without a true positive
DROPPED_K = 10                 # S8: a dictionary so small that documents drop out
SKETCH_K, SKETCH_COUNTERS = 200, 4_000  # so few counters that tasks drop words
SHORT_VOCAB_K = 1_000_000      # S6: K larger than the training vocabulary
CONVERGE_TOL = 5.0             # S12: tolerance reached within the iterations


BALANCED = (Preset(k=200, m=2, prefix="EN5"), Preset(k=2000, m=2, prefix=DOCUMENTS_PREFIX))  # classes that overlap
NARROW = Preset(prefix=DOCUMENTS_PREFIX, m=3)  # so few features that documents keep an all-zero vector
MICRO = 1e6                    # small statistics are reported in millionths, so that rounding keeps their digits

_SHARED: dict = {}


def shared_pipeline(spark: SparkSession, sf_dir: str, preset: Preset = MAIN) -> Pipeline:
    """The registered queries share one fitted dictionary, selection and set
    of models per (application, data folder, preset). ``clear`` forgets them,
    for use after the files of a folder were rewritten."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), preset)
    if key not in _SHARED:
        _SHARED[key] = pipeline(spark, sf_dir, preset)
    return _SHARED[key]


def clear() -> None:
    """Forget the shared pipelines and free what they cache."""
    for shared in _SHARED.values():
        shared.release()
    _SHARED.clear()


_p = shared_pipeline


# ---- IO / parsing --------------------------------------------------------------
def q_doc_lines_scan(spark, sf_dir):
    """IO1/IO2: write every document as a line to the shared folder, read the
    text files back, count lines and characters."""
    path = scratch_path(spark, "doc-lines")
    write_doc_lines(documents_as_lines(spark, sf_dir), path)
    lines = read_doc_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.sum(F.length("value")).cast("long").alias("n_chars"))


def q_parse_doc_lines(spark, sf_dir):
    """PR1/PR2/PR4: (doc_id, text) parsed from the rendered lines."""
    return parse.parse_doc_lines(documents_as_lines(spark, sf_dir), "FAILFAST")


def q_malformed_lines(spark, sf_dir):
    """PR3: well-formed document lines plus raw pages, which lack the markers."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("html").alias("value"))
    lines = documents_as_lines(spark, sf_dir).select("value").unionByName(pages)
    return parse.malformed_counts(lines)


def _mixed_lines(spark, sf_dir) -> DataFrame:
    """Document lines, raw pages (which lack the markers), and null lines in
    place of every tenth page."""
    html = F.when(F.col("page_id") % 10 != 0, F.col("html")).alias("value")
    pages = read_table(spark, sf_dir, "pages").select(html)
    return documents_as_lines(spark, sf_dir).select("value").unionByName(pages)


def q_line_quarantine(spark, sf_dir):
    """PR3/PR4: lines left out in one pass, counted beside the write; good,
    bad and null lines add up to the input."""
    kept = parse.quarantine_doc_lines(_mixed_lines(spark, sf_dir), scratch_path(spark, "rejects"))
    reasons = kept.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    good = kept.docs.agg(F.lit("ok").alias("reason"), F.count(F.lit(1)).alias("n"))
    counts = F.create_map(*[x for name, n in kept.counts.items() for x in (F.lit(name), F.lit(n).cast("long"))])
    return good.unionByName(reasons).select("reason", "n", *[counts[name].alias(name) for name in ("n_ok", "n_bad", "n_null")])


def q_line_rejects(spark, sf_dir):
    """PR3: the reject table itself."""
    kept = parse.quarantine_doc_lines(_mixed_lines(spark, sf_dir), scratch_path(spark, "rejects"))
    return kept.rejects.select("reason", F.length("value").cast("long").alias("n_chars"), F.md5("value").alias("line"))


def q_label_by_prefix(spark, sf_dir):
    """PR9/FN4."""
    return parse.label_by_prefix(_p(spark, sf_dir).corpus.all_docs, MAIN.prefix)


def q_tokenize(spark, sf_dir):
    """FN1-FN3."""
    return text.token_summary(_p(spark, sf_dir).corpus.all_docs)


def q_token_pairs(spark, sf_dir):
    """PR5/PR6."""
    return text.token_pairs(_p(spark, sf_dir).corpus.all_docs)


# ---- dictionary / TF -------------------------------------------------------------
def q_word_count(spark, sf_dir):
    """AG1 over the training corpus."""
    return _p(spark, sf_dir).word_counts


def q_dictionary_topk(spark, sf_dir):
    """DI1/DI2/ML1."""
    return _p(spark, sf_dir).dictionary


def q_dictionary_sketch(spark, sf_dir):
    """AG1/DI1 from a frequent-words sketch with few counters, and an exact
    count of its candidates."""
    return frequent.frequent_dictionary(_p(spark, sf_dir).corpus.train, SKETCH_K, SKETCH_COUNTERS)


def q_dictionary_short_vocab(spark, sf_dir):
    """S6: K above the vocabulary gives every word, no error."""
    return _p(spark, sf_dir, Preset(k=SHORT_VOCAB_K)).dictionary


def q_dictionary_join(spark, sf_dir):
    """JN1/JN2/PR7/PR8/AG2/AG3: (doc_id, pos, n)."""
    p = _p(spark, sf_dir)
    return tf.position_counts(p.corpus.train, p.dictionary, p.size)


def q_dictionary_join_shuffled(spark, sf_dir):
    """JN1/JN2 with a dictionary that is too large to broadcast: words outside
    it are left out at the scan by its Bloom filter."""
    p = _p(spark, sf_dir)
    return tf.position_counts(p.corpus.train, p.dictionary, p.size, broadcast_bytes=0)


def q_tf_train(spark, sf_dir):
    """AG4/ML2."""
    return _p(spark, sf_dir).tf_long("train").select("doc_id", "pos", "tf")


def q_tf_test(spark, sf_dir):
    """ML3: test documents with the training dictionary."""
    return _p(spark, sf_dir).tf_long("test").select("doc_id", "pos", "tf")


def q_tf_dropped_docs(spark, sf_dir):
    """S8: test documents without any word of a 10-word dictionary."""
    p = _p(spark, sf_dir, Preset(k=DROPPED_K))
    return tf.dropped_documents(p.corpus.test, p.rows("test"))


# ---- feature selection -----------------------------------------------------------
def q_feature_stats(spark, sf_dir):
    """AG5-AG8; means and sums of squares in millionths."""
    stats = _p(spark, sf_dir).stats()
    return round_doubles(stats.select("pos", "sum_tf", (F.col("mean_tf") * MICRO).alias("mean_tf_micro"),
                                      (F.col("ss") * MICRO).alias("ss_micro")))


def q_feature_moments(spark, sf_dir):
    """AG6-AG8 from moments of two parts of the training side, documents of
    each label, taken apart and merged."""
    p = _p(spark, sf_dir)
    label = parse.label_expr(F.col("doc_id"), MAIN.prefix)
    parts = [selection.feature_moments(p.rows("train").where(label == y)) for y in (0, 1)]
    merged = selection.merge_moments(parts[0].unionByName(parts[1]))
    stats = selection.stats_from_moments(merged, p.counts("train")[1])
    mean = F.col("sum_tf") / F.col("nnz")
    return round_doubles(merged.select("pos", "nnz", (mean * MICRO).alias("mean_nz_micro"), (F.col("m2") * MICRO).alias("m2_micro"))
                         .join(stats.select("pos", (F.col("ss") * MICRO).alias("ss_micro")), "pos"))


def q_variance_topm(spark, sf_dir):
    """AG9/ML4."""
    return _p(spark, sf_dir).selected


def q_tf_reduced_train(spark, sf_dir):
    """FN14/ML5."""
    return _p(spark, sf_dir).tf_reduced("train")


def q_tf_reduced_test(spark, sf_dir):
    """ML5 on the test side with the training selection."""
    return _p(spark, sf_dir).tf_reduced("test")


# ---- gradient descent ------------------------------------------------------------
def q_gd_history(spark, sf_dir):
    """AG10/FN5-FN12/ML6/ML7/ML9/IO3."""
    return round_doubles(sinks.history_frame(spark, _p(spark, sf_dir).gd_model().history))


def q_gd_converged(spark, sf_dir):
    """ML8/S12: a tolerance that the run reaches stops it without applying
    that update."""
    m = _p(spark, sf_dir).gd_model(tol=CONVERGE_TOL)
    return spark.createDataFrame([(m.iterations_applied, m.stopped)],
                                 "iterations_applied int, stopped boolean")


def q_gd_weights(spark, sf_dir):
    """ML6/ML7: final weights, one per dictionary position."""
    return round_doubles(gd.weights_frame(spark, _p(spark, sf_dir).gd_model().weights))


def q_gd_top_words(spark, sf_dir):
    """AG12/JN4/ML10."""
    p = _p(spark, sf_dir)
    return round_doubles(gd.top_words(spark, p.gd_model(), p.dictionary))


def q_gd_predict(spark, sf_dir):
    """ML11."""
    return _p(spark, sf_dir).gd_predictions()


def q_gd_outcomes(spark, sf_dir):
    """ML12."""
    return evaluate.outcomes(_p(spark, sf_dir).gd_predictions())


def q_gd_confusion(spark, sf_dir):
    """AG11/ML13."""
    return evaluate.confusion(_p(spark, sf_dir).gd_predictions())


def q_gd_confusion_matrix(spark, sf_dir):
    """ML20: rows = truth, columns = prediction."""
    return evaluate.confusion_matrix(_p(spark, sf_dir).gd_predictions())


def q_gd_f1(spark, sf_dir):
    """ML14."""
    return round_doubles(evaluate.f1_report(evaluate.confusion(_p(spark, sf_dir).gd_predictions())))


def q_gd_false_positives(spark, sf_dir):
    """PR11/JN3/AG13/IO5/ML15."""
    p = _p(spark, sf_dir)
    return evaluate.false_positives(p.gd_predictions(), p.corpus.test)


def q_class_metrics_gd(spark, sf_dir):
    """ML20-ML24/PR10 on the gradient-descent predictions."""
    return round_doubles(evaluate.class_metrics(_p(spark, sf_dir).gd_predictions()))


def _reports(preset: Preset, suffix: str) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The prediction reports of another preset, whose classifier makes errors."""
    predictions = lambda spark, sf_dir: _p(spark, sf_dir, preset).gd_predictions()
    return {
        f"gd_outcomes{suffix}": lambda spark, d: evaluate.outcomes(predictions(spark, d)),
        f"gd_confusion{suffix}": lambda spark, d: evaluate.confusion(predictions(spark, d)),
        f"gd_confusion_matrix{suffix}": lambda spark, d: evaluate.confusion_matrix(predictions(spark, d)),
        f"gd_f1{suffix}": lambda spark, d: round_doubles(evaluate.f1_report(evaluate.confusion(predictions(spark, d)))),
        f"gd_false_positives{suffix}": lambda spark, d: evaluate.false_positives(
            predictions(spark, d), _p(spark, d, preset).corpus.test),
        f"class_metrics_gd{suffix}": lambda spark, d: round_doubles(evaluate.class_metrics(predictions(spark, d))),
    }


def _vector_stats(vectors: DataFrame) -> DataFrame:
    """Per document: label, stored non-zeros and their sum, read from the ML
    vectors themselves (``vector_to_array``: at most K values per row)."""
    arr = vector_to_array(F.col("features"))
    return round_doubles(vectors.select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        F.size(F.filter(arr, lambda x: x != 0)).cast("long").alias("nnz"),
        F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x).alias("tf_sum"),
    ))


def _vectors(side: str, features: str, preset: Preset = MAIN) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return _vector_stats(_p(spark, sf_dir, preset).vectors(side, features))
    run.__doc__ = (f"FN13/FN14/ML5: the {side} vectors Spark ML sees on {features} features, checked entry-wise; "
                   "a document none of whose words was selected keeps an all-zero vector (nnz 0).")
    return run


def _ml_metrics(kind: str, features: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return round_doubles(metrics_frame(spark, [_p(spark, sf_dir).ml_run(kind, features)]))
    run.__doc__ = f"ML16-ML24: {kind} on {features} features."
    return run


ML_RUNS = [(kind, features) for features in ("full", "reduced") for kind in ("lr", "svm")]


def q_ml_checks(spark, sf_dir):
    """ML16-ML19/ML25/PR10/FN15: what holds of every fit and its scores. Each
    test document with a TF row is scored once, the four outcomes add up to
    the labels, accuracy is at least 0.99, and training lowered the loss."""
    p = _p(spark, sf_dir)
    runs = [p.ml_run(kind, features) for kind, features in ML_RUNS]
    labels = {r["label"]: r["n"] for r in p.vectors("test", "full").groupBy("label")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = labels.get(1.0, 0), labels.get(0.0, 0)
    facts = [(r["model"], r["features"], r["tp"] + r["fn"], r["fp"] + r["tn"], r["tp"] + r["fn"] == pos,
              r["fp"] + r["tn"] == neg, r["accuracy"] >= 0.99, r["loss_fell"]) for r in runs]
    return spark.createDataFrame(facts, "model string, features string, p long, n long, positives_add_up boolean, "
                                        "negatives_add_up boolean, accurate boolean, loss_fell boolean")


def q_ml_margins(spark, sf_dir):
    """ML16/ML18: the side on which each fit puts every training document, 0
    unless its margin is at least 1. Where all are on their label's side the
    mean hinge loss is 0, its optimum, and the mean log loss below log(1 + 1/e)."""
    p = _p(spark, sf_dir)
    found = None
    for kind, features in ML_RUNS:
        weights, intercept = p.fitted_weights(kind, features)
        margin = F.round("margin", 6)
        side = F.when(margin >= 1, 2 * F.col("label") - 1).otherwise(0).cast("int")
        at = certify.margins(p.rows("train"), p.label, weights, intercept)
        rows = at.select(F.lit(kind).alias("model"), F.lit(features).alias("features"), "doc_id",
                         parse.label_expr(F.col("doc_id"), MAIN.prefix).alias("label"), "margin")
        rows = rows.select("model", "features", "doc_id", side.alias("side"))
        found = rows if found is None else found.unionByName(rows)
    return found


def q_lr_mass(spark, sf_dir):
    """ML16: what the fitted logistic regressions of two presets that no line
    separates expect of class 1, by selected feature and over all documents
    (new_pos -1). At the optimum it is what class 1 holds; the fit's gradient is
    the difference."""
    rows = []
    for preset in BALANCED:
        p = _p(spark, sf_dir, preset)
        found = p.certificate("lr", "reduced")
        sums = {r["pos"]: r["s"] for r in tf.entries(p.rows("train").where(p.label == 1)).groupBy("pos")
                .agg(F.sum("tf").alias("s")).collect()}
        observed = np.array([sums.get(k, 0.0) for k in range(p.size)])
        mass = certify.expected_mass(found, observed)
        total = float(p.rows("train").where(p.label == 1).count()) + found.by_intercept
        rows += [(preset.prefix, -1, total)]
        rows += [(preset.prefix, r["new_pos"], float(mass[r["pos"]])) for r in p.selected.collect()]
    return round_doubles(spark.createDataFrame(rows, "prefix string, new_pos int, mass double"), 3)


def q_model_comparison(spark, sf_dir):
    """ML25/EX1-EX3: LR and SVM on full and reduced features, each a whole run
    of its own with its times."""
    runs = [timed_run(pipeline(spark, sf_dir, MAIN), kind, features) for kind, features in ML_RUNS]
    return metrics_frame(spark, runs, with_timing=True)


def q_lines_gd_confusion(spark, sf_dir):
    """IO1/IO2 end to end, as the reference runs: the train and test sides are
    written as document-line files to the shared folder, read back, parsed,
    and the whole dictionary -> TF -> gradient descent -> confusion pipeline
    runs on the parsed lines. Equal to ``gd_confusion`` on the table."""
    lines = documents_as_lines(spark, sf_dir)
    is_test = on_test_side(MAIN.test_every)
    train_path, test_path = scratch_path(spark, "train-lines"), scratch_path(spark, "test-lines")
    write_doc_lines(lines.where(~is_test), train_path)
    write_doc_lines(lines.where(is_test), test_path)
    p = pipeline_from_lines(spark, train_path, test_path, MAIN)
    return evaluate.confusion(p.gd_predictions())


def q_history_sink(spark, sf_dir):
    """IO4: history written as one CSV part file and read back."""
    path = scratch_path(spark, "gd-history")
    sinks.write_single_file(sinks.history_frame(spark, _p(spark, sf_dir).gd_model().history), path)
    return round_doubles(sinks.read_single_file(spark, path, sinks.HISTORY_SCHEMA))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "doc_lines_scan": q_doc_lines_scan,
    "parse_doc_lines": q_parse_doc_lines,
    "malformed_lines": q_malformed_lines,
    "line_quarantine": q_line_quarantine,
    "line_rejects": q_line_rejects,
    "label_by_prefix": q_label_by_prefix,
    "tokenize": q_tokenize,
    "token_pairs": q_token_pairs,
    "word_count": q_word_count,
    "dictionary_topk": q_dictionary_topk,
    "dictionary_sketch": q_dictionary_sketch,
    "dictionary_short_vocab": q_dictionary_short_vocab,
    "dictionary_join": q_dictionary_join,
    "dictionary_join_shuffled": q_dictionary_join_shuffled,
    "tf_train": q_tf_train,
    "tf_test": q_tf_test,
    "tf_dropped_docs": q_tf_dropped_docs,
    "feature_stats": q_feature_stats,
    "feature_moments": q_feature_moments,
    "variance_topm": q_variance_topm,
    "tf_reduced_train": q_tf_reduced_train,
    "tf_reduced_test": q_tf_reduced_test,
    "gd_history": q_gd_history,
    "gd_converged": q_gd_converged,
    "gd_weights": q_gd_weights,
    "gd_top_words": q_gd_top_words,
    "gd_predict": q_gd_predict,
    "gd_outcomes": q_gd_outcomes,
    "gd_confusion": q_gd_confusion,
    "gd_confusion_matrix": q_gd_confusion_matrix,
    "gd_f1": q_gd_f1,
    "gd_false_positives": q_gd_false_positives,
    "class_metrics_gd": q_class_metrics_gd,
    "vector_stats": _vectors("train", "full"),
    "vector_stats_test": _vectors("test", "full"),
    "reduced_vector_stats": _vectors("train", "reduced"),
    "reduced_vector_stats_test": _vectors("test", "reduced"),
    "reduced_vector_stats_narrow": _vectors("train", "reduced", NARROW),
    "ml_checks": q_ml_checks,
    "ml_margins": q_ml_margins,
    "lr_mass": q_lr_mass,
    "lr_full_metrics": _ml_metrics("lr", "full"),
    "svm_full_metrics": _ml_metrics("svm", "full"),
    "lr_reduced_metrics": _ml_metrics("lr", "reduced"),
    "svm_reduced_metrics": _ml_metrics("svm", "reduced"),
    "model_comparison": q_model_comparison,
    "history_sink": q_history_sink,
    "lines_gd_confusion": q_lines_gd_confusion,
    **_reports(HARD, "_hard"),
    **{name: q for name, q in _reports(NO_TRUE_POSITIVE, "_zero").items() if "false_positives" not in name},
}
