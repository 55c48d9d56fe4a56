"""Numerically stable logistic helpers (FN6-FN8, S13), over numpy arrays.

The reference computes ``log(1+exp(t))`` and ``exp(t)/(1+exp(t))`` directly,
which overflow to inf/NaN for t above about 709. These forms are equal
wherever the direct ones are finite and stay finite elsewhere.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle


def softplus(theta: np.ndarray) -> np.ndarray:
    """log(1 + exp(theta)) = max(theta, 0) + log1p(exp(-|theta|))."""
    return np.maximum(theta, 0.0) + np.log1p(np.exp(-np.abs(theta)))


def sigmoid(theta: np.ndarray) -> np.ndarray:
    """exp(theta) / (1 + exp(theta)) without overflow."""
    e = np.exp(-np.abs(theta))
    return np.where(theta >= 0, 1.0 / (1.0 + e), e / (1.0 + e))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy, not this package
