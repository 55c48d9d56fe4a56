import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from termflow.operators import blocks, gd
from termflow.operators import dictionary as dct
from termflow.operators import tf
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.classify import Preset

from conftest import SF001, docs_frame


def np_sigmoid(t):
    return np.where(t >= 0, 1 / (1 + np.exp(-np.abs(t))), np.exp(-np.abs(t)) / (1 + np.exp(-np.abs(t))))


def np_softplus(t):
    return np.maximum(t, 0) + np.log1p(np.exp(-np.abs(t)))


def brute_force_gd(x, y, lr, iterations, reg, tol):
    """Dense statement of the model: sums over documents, no intercept,
    stop before applying an update whose norm is <= tol."""
    r = np.zeros(x.shape[1])
    hist = []
    stopped = False
    for i in range(iterations):
        theta = x @ r
        g = x.T @ (np_sigmoid(theta) - y)
        cost = float(np.sum(np_softplus(theta) - y * theta) + reg * np.sum(r ** 2))
        new = r - (g + 2 * reg * r) * lr
        l2 = float(np.linalg.norm(new - r))
        if l2 <= tol:
            stopped = True
            break
        r = new
        hist.append((i, cost, l2))
    return r, hist, stopped


def dense_tf(p):
    rows = p.tf_long("train").collect()
    ids = sorted({r.doc_id for r in rows})
    index = {d: i for i, d in enumerate(ids)}
    x = np.zeros((len(ids), p.size))
    for r in rows:
        x[index[r.doc_id], r.pos] = r.tf
    y = np.array([1.0 if d.startswith(p.preset.prefix) else 0.0 for d in ids])
    return x, y


@pytest.mark.parametrize("lr,iters,reg,tol", [(0.5, 4, 0.001, 0.1), (0.05, 3, 0.0, 0.1), (0.5, 5, 0.01, 5.0)])
def test_gd_matches_dense_brute_force(spark, lr, iters, reg, tol):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=2000))
    x, y = dense_tf(p)
    want_r, want_hist, want_stop = brute_force_gd(x, y, lr, iters, reg, tol)
    m = gd.fit_gd(p.rows("train"), p.size, lr, iters, reg, tol, p.preset.prefix)
    assert m.stopped == want_stop
    assert len(m.history) == len(want_hist)
    for (i, c, l), (wi, wc, wl) in zip(m.history, want_hist):
        assert i == wi and math.isclose(c, wc, rel_tol=1e-9) and math.isclose(l, wl, rel_tol=1e-9)
    assert np.allclose(m.weights, want_r, rtol=1e-9, atol=1e-12)


def test_convergence_at_first_iteration_applies_nothing(spark):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=500))
    m = gd.fit_gd(p.rows("train"), p.size, 1e-6, 5, 0.0, 0.1, "EN")
    assert m.stopped and m.stopped_at == 0 and m.iterations_applied == 0
    assert not m.weights.any()


def test_large_theta_is_finite(spark):
    docs = docs_frame(spark, [("AU1", "big"), ("EN1", "small")])
    d = dct.build_dictionary(docs, 10, mode="none")
    t = tf.tf_rows(docs, d, 2)
    # a huge learning rate drives theta far beyond exp overflow (S13)
    m = gd.fit_gd(t, 2, 1e4, 4, 0.0, 0.0, "AU")
    assert all(math.isfinite(c) and math.isfinite(l) for _, c, l in m.history)
    assert np.isfinite(m.weights).all()


def test_theta_zero_predicts_zero(spark):
    docs = docs_frame(spark, [("AU1", "alpha"), ("EN1", "beta")])
    d = dct.build_dictionary(docs, 10, mode="none")
    t = tf.tf_rows(docs, d, 2)
    model = gd.GdModel(weights=np.zeros(2))
    preds = {r.doc_id: (r.label, r.prediction) for r in gd.predict_gd(t, model, "AU").collect()}
    assert preds == {"AU1": (1, 0), "EN1": (0, 0)}


def test_top_words_order_and_ties(spark):
    docs = docs_frame(spark, [("AU1", "a b c d e f g")])
    d = dct.build_dictionary(docs, 10, mode="none")  # all counts 1: pos by word
    model = gd.GdModel(weights=np.array([0.1, 0.5, 0.5, -1.0, 0.2, 0.5, 0.0]))
    got = [tuple(r) for r in gd.top_words(spark, model, d).orderBy("rank").collect()]
    assert got == [(1, 1, "b", 0.5), (2, 2, "c", 0.5), (3, 5, "f", 0.5), (4, 4, "e", 0.2), (5, 0, "a", 0.1)]


def test_pass_is_the_same_from_cache_from_parquet_and_for_any_task_count(spark):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=500))
    runs = [gd.fit_gd(p.rows("train"), p.size, 0.5, 3, 0.001, 0.1, "EN", mode=mode, tasks=tasks)
            for mode, tasks in (("cache", None), ("none", None), ("none", 1))]
    for m in runs[1:]:
        assert np.allclose(m.weights, runs[0].weights, rtol=1e-9, atol=1e-12)


def test_constant_array_is_exact(spark):
    values = np.array([0.1, -1e-300, 1 / 3, 1e22, 0.0, 5e-324])
    row = spark.range(1).select(tf.constant_array(values, "double").alias("v")).first()
    assert row.v == values.tolist()


def test_tree_of_tasks_sums_what_one_task_sums(spark, monkeypatch):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=300))
    weights = np.random.default_rng(1).normal(size=p.size)
    one = blocks.sums(blocks.pack(p.rows("train").coalesce(1), F.lit(1)), weights, 1, 0.3)
    monkeypatch.setattr(blocks, "BLOCK_ENTRIES", 50)
    monkeypatch.setattr(blocks, "FANIN", 2)
    packed = blocks.pack(p.rows("train").repartition(9), F.lit(1))
    many = blocks.sums(packed, weights, 9, 0.3)
    assert packed.count() > 50 and many.n == one.n == p.counts("train")[1]
    assert math.isclose(many.cost, one.cost, rel_tol=1e-12) and math.isclose(many.by_intercept, one.by_intercept, rel_tol=1e-12)
    assert np.allclose(many.gradient, one.gradient, rtol=1e-10, atol=1e-14)
    nothing = blocks.sums(packed.limit(0), weights, 9)
    assert nothing.n == 0 and nothing.cost == 0 and not nothing.gradient.any()


class Killed(Exception):
    pass


@pytest.mark.parametrize("after", [0, 1, 3])
def test_a_killed_descent_goes_on_from_its_log(spark, tmp_path, monkeypatch, after):
    """Killed after some steps, while a step is half written; the run started
    again has the history and the weights of one never interrupted, to the bit."""
    p = pipeline(spark, SF001, Preset(prefix="EN", k=400))
    rows, log = p.rows("train"), str(tmp_path / "log")
    run = lambda **more: gd.fit_gd(rows, p.size, 0.5, 5, 0.001, 0.1, "EN", mode="none", **more)
    whole, append = run(), gd.DescentLog.append

    def dying(self, model, step):
        if step == after:
            (tmp_path / "log" / f"step-{step:06d}").mkdir(parents=True)  # no _SUCCESS
            raise Killed
        append(self, model, step)

    monkeypatch.setattr(gd.DescentLog, "append", dying)
    with pytest.raises(Killed):
        run(log=log)
    monkeypatch.setattr(gd.DescentLog, "append", append)
    passes = []
    monkeypatch.setattr(gd, "gradient_pass", lambda *a, f=gd.gradient_pass: passes.append(1) or f(*a))
    again = run(log=log)
    assert len(passes) == 5 - after
    assert again.history == whole.history and (again.weights == whole.weights).all()
    assert run(log=log).history == whole.history and len(passes) == 5 - after  # nothing left to do
    further = gd.fit_gd(rows, p.size, 0.5, 7, 0.001, 0.1, "EN", mode="none", log=log)
    assert further.history[:5] == whole.history and len(further.history) == 7


def test_a_log_keeps_the_end_of_a_descent_and_belongs_to_its_run(spark, tmp_path):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=400))
    run = lambda lr, log: gd.fit_gd(p.rows("train"), p.size, lr, 9, 0.001, 5.0, "EN", log=log)
    first = run(0.5, str(tmp_path / "log"))
    again = run(0.5, str(tmp_path / "log"))
    assert first.stopped and again.stopped and again.stopped_at == first.stopped_at
    assert again.history == first.history and (again.weights == first.weights).all()
    with pytest.raises(ValueError, match="another run"):
        run(0.25, str(tmp_path / "log"))
