"""Certificates of fitted linear classifiers (ML16, ML18): how far a fit can be
from the optimum, from one pass over the TF rows at its coefficients.

Both objectives, the mean log loss and the mean hinge loss, are convex. So at
weights w with (sub)gradient g no weights v, intercepts included, have a mean
loss below f(w) + g.(v - w); over all v with |v|_1 <= R that is f(w) less
``g.w + R * max|g|``, and never below 0. A fit is as good as its certificate
says, however its solver stopped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termflow.operators import blocks
from termflow.operators.gd import gradient_tasks, theta

LOSSES = {"lr": blocks.logistic, "svm": blocks.hinge}


@dataclass
class Certificate:
    n: int
    objective: float          # mean loss at the fit
    at_zero: float            # mean loss of zero weights and intercept
    gradient_max: float       # largest component of the mean gradient, by intercept included
    radius: float             # R: |w|_1 of the fit, intercept included
    gap: float                # objective less a lower bound over all |v|_1 <= R
    gradient: np.ndarray      # summed gradient by position
    by_intercept: float       # summed derivative by the intercept


def full_weights(coefficients: np.ndarray, size: int, selected: DataFrame | None = None) -> np.ndarray:
    """Coefficients by dictionary position: as they are, or those of selected
    features (``new_pos``) put back to their positions, zero elsewhere."""
    if selected is None:
        return np.asarray(coefficients, float)
    out, chosen = np.zeros(size), selected.select("pos", "new_pos").toPandas()
    out[chosen["pos"].to_numpy(dtype=np.int64)] = np.asarray(coefficients, float)[chosen["new_pos"].to_numpy(dtype=np.int64)]
    return out


def certify(packed: DataFrame, kind: str, weights: np.ndarray, intercept: float, tasks: int | None = None,
            free: np.ndarray | None = None) -> Certificate:
    """Certificate over packed TF rows; ``free`` marks the positions that the
    fit may use (default all)."""
    tasks = tasks or gradient_tasks(packed.sparkSession)
    loss = LOSSES[kind]
    at = blocks.sums(packed, weights, tasks, intercept, loss)
    n = max(at.n, 1)
    used = at.gradient if free is None else np.where(free, at.gradient, 0.0)
    largest = max(float(np.abs(used).max(initial=0.0)), abs(at.by_intercept)) / n
    radius = float(np.abs(weights).sum()) + abs(intercept)
    slope = (float(used @ weights) + at.by_intercept * intercept) / n
    objective = at.cost / n
    zero = float(loss(np.zeros(1), np.zeros(1))[0][0])
    return Certificate(at.n, objective, zero, largest, radius, min(objective, slope + radius * largest), used, at.by_intercept)


def expected_mass(found: Certificate, observed: np.ndarray) -> np.ndarray:
    """Sum over all documents of a feature's value times the fitted probability
    of class 1, from the gradient and the ``observed`` sums over class 1. At the
    optimum of an unpenalised logistic regression the two are equal for every
    feature, and for the constant one of the intercept."""
    return observed + found.gradient


def margins(rows: DataFrame, y: Column, weights: np.ndarray, intercept: float) -> DataFrame:
    """(doc_id, margin): s * (w.x + b) of each document, s being +1 or -1 by its
    label. A hinge loss is the mean of max(0, 1 - margin)."""
    side = (2 * y - 1).cast("double")
    return theta(rows.select("doc_id", side.alias("side"), "pos", "tf"), weights, ("doc_id", "side")).select(
        "doc_id", (F.col("side") * (F.col("theta") + F.lit(float(intercept)))).alias("margin"))
