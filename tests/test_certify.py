"""Certificates against solvers of their own: Newton steps for the logistic
loss, all corners of the piecewise linear hinge loss."""
import itertools

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import functions as F

from termflow.operators import blocks, certify, tf
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.classify import Preset

from conftest import SF001


def newton(x, y, steps=50):
    """Optimal (weights, intercept) of the mean log loss."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x1 @ w)))
        w = w - np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]), x1.T @ (p - y))
    return w[:-1], w[-1]


def log_loss(x, y, w, b):
    t = x @ w + b
    return float(np.mean(np.logaddexp(0, t) - y * t))


def hinge_loss(x, y, w, b):
    return float(np.mean(np.maximum(0, 1 - (2 * y - 1) * (x @ w + b))))


def hinge_optimum(x, y):
    """One feature: the least loss is at a corner, where two documents of
    different classes lie on their margins, or at a constant score."""
    best = min(hinge_loss(x, y, np.zeros(1), b) for b in (-1.0, 1.0))
    for i, j in itertools.product(np.flatnonzero(y == 1), np.flatnonzero(y == 0)):
        if x[i, 0] != x[j, 0]:
            w = 2 / (x[i, 0] - x[j, 0])
            best = min(best, hinge_loss(x, y, np.array([w]), 1 - w * x[i, 0]))
    return best


@pytest.fixture(scope="module")
def problem(spark):
    """Two overlapping classes over three positions, as TF rows and as arrays."""
    rng = np.random.default_rng(8)
    n, y = 120, (np.arange(120) % 3 == 0).astype(float)
    x = rng.random((n, 3)) + 0.3 * y[:, None] * np.array([1, 0, -1])
    x[rng.random((n, 3)) < 0.2] = 0
    rows = [(f"{'AU' if v else 'EN'}{i}", [k for k in range(3) if r[k]], [float(u) for u in r if u])
            for i, (r, v) in enumerate(zip(x, y)) if r.any()]
    keep = x.any(axis=1)
    frame = spark.createDataFrame(rows, "doc_id string, pos array<int>, tf array<double>").repartition(4).cache()
    label = F.when(F.col("doc_id").startswith("AU"), 1).otherwise(0)
    return x[keep], y[keep], frame, label


def test_gradient_and_objective_of_any_weights(problem):
    x, y, rows, label = problem
    w, b = np.array([0.4, -2.0, 1.5]), 0.3
    for kind, loss in (("lr", log_loss), ("svm", hinge_loss)):
        found = certify.certify(blocks.pack(rows, label), kind, w, b, 3)
        assert found.n == len(x) and abs(found.objective - loss(x, y, w, b)) < 1e-12 and abs(found.radius - 4.2) < 1e-12
        for k in range(4):  # numerical derivative
            step = np.eye(4)[k] * 1e-6
            up, down = (loss(x, y, w + s * step[:3], b + s * step[3]) for s in (1, -1))
            slope = found.gradient[k] if k < 3 else found.by_intercept
            assert abs((up - down) / 2e-6 - slope / found.n) < 1e-5


def test_fitted_logistic_regression_is_certified(spark, problem):
    x, y, rows, label = problem
    fit = LogisticRegression(maxIter=100).fit(tf.tf_vectors(rows, 3, "AU"))
    packed = blocks.pack(rows, label)
    found = certify.certify(packed, "lr", fit.coefficients.toArray(), fit.intercept)
    best = log_loss(x, y, *newton(x, y))
    assert 0 <= found.objective - best <= found.gap + 1e-12 and found.gap < 1e-3 and found.gradient_max < 1e-4
    observed = x[y == 1].sum(axis=0)
    p = 1 / (1 + np.exp(-(x @ fit.coefficients.toArray() + fit.intercept)))
    assert np.allclose(certify.expected_mass(found, observed), x.T @ p) and np.allclose(x.T @ p, observed, atol=1e-2)
    early = LogisticRegression(maxIter=1).fit(tf.tf_vectors(rows, 3, "AU"))
    rough = certify.certify(packed, "lr", early.coefficients.toArray(), early.intercept)
    assert rough.gap > 10 * found.gap and rough.gradient_max > 1e-3  # a fit cut short shows


def test_fitted_svm_is_certified(spark, problem):
    x, y, rows, label = problem
    first = rows.select("doc_id", F.array(F.lit(0)).alias("pos"), F.array(F.coalesce(
        F.get(F.transform(F.filter(F.arrays_zip("pos", "tf"), lambda e: e["pos"] == 0), lambda e: e["tf"]), 0), F.lit(0.0))).alias("tf"))
    fit = LinearSVC(maxIter=100).fit(tf.tf_vectors(first, 1, "AU"))
    found = certify.certify(blocks.pack(first, label), "svm", fit.coefficients.toArray(), fit.intercept)
    best = hinge_optimum(x[:, :1], y)
    assert abs(found.objective - hinge_loss(x[:, :1], y, fit.coefficients.toArray(), fit.intercept)) < 1e-12
    assert best - 1e-12 <= found.objective <= best + found.gap + 1e-9 and found.objective - best < 1e-3


def test_a_separating_fit_is_optimal(spark):
    rows = spark.createDataFrame([("AU1", [0], [1.0]), ("EN1", [1], [1.0]), ("EN2", [1, 2], [0.5, 0.5])],
                                 "doc_id string, pos array<int>, tf array<double>")
    label = F.when(F.col("doc_id").startswith("AU"), 1).otherwise(0)
    w = np.array([2.0, -3.0, -3.0])
    found = certify.certify(blocks.pack(rows, label), "svm", w, 0.0)
    assert found.objective == 0 and found.gap == 0
    assert {r.doc_id: r.margin for r in certify.margins(rows, label, w, 0.5).collect()} == {"AU1": 2.5, "EN1": 2.5, "EN2": 2.5}


def test_every_fit_of_the_pipeline_has_a_small_gap(spark):
    p = pipeline(spark, SF001, Preset(prefix="EN", k=500, m=100))
    for kind in ("lr", "svm"):
        for features in ("full", "reduced"):
            found = p.certificate(kind, features)
            assert found.n == p.counts("train")[1] and 0 <= found.gap <= found.objective < 0.05
            outside = np.ones(p.size, bool)
            if features == "reduced":
                outside[[r.pos for r in p.selected.collect()]] = False
                assert not p.fitted_weights(kind, features)[0][outside].any() and not found.gradient[outside].any()
    p.release()
