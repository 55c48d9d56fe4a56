"""Batch gradient-descent logistic regression (ML6-ML11, AG10, AG12, JN4,
FN5-FN12).

Model and semantics follow the reference: no intercept, weights start at 0,
cost and gradient are sums over documents (S11), an L2 penalty ``reg*|r|^2``
with gradient ``2*reg*r``, update ``r - (g + 2*reg*r)*lr``, and the loop stops
*before* applying an update whose L2 norm is <= ``tol`` (S12).

Execution: the TF rows, one per document, are packed once into blocks of
flat buffers, which are cached (EX1). Each iteration is one Spark job over the
blocks (``operators.blocks``): scores, costs and gradients are array operations
on whole blocks, a task keeps one K-vector, and the tasks' vectors are summed
in a tree. Only the K-long weight and gradient vectors live on the driver,
like the coefficients of any Spark ML model; the plan of each iteration is
built from fresh driver data, so lineage does not grow across iterations. With
a ``log`` the descent survives the loss of its driver: every step is committed
to the shared folder, and a run that finds steps there goes on after them.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termflow import params
from termflow.functions.parse import label_expr
from termflow.operators import blocks
from termflow.session import materialize

WEIGHT_SCHEMA = T.StructType([
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
])


@dataclass
class GdModel:
    weights: np.ndarray
    history: list[tuple[int, float, float]] = field(default_factory=list)
    stopped: bool = False          # True when the tolerance test ended the loop
    stopped_at: int | None = None  # iteration whose update was not applied

    @property
    def iterations_applied(self) -> int:
        return len(self.history)

    def advance(self, data_gradient: np.ndarray, data_cost: float, learning_rate: float, reg: float,
                tol: float) -> None:
        """One descent step on the ridge objective (FN10-FN12, ML7-ML9): the
        penalty ``reg * |w|^2`` joins cost and gradient of the data at the
        current weights. A step no longer than ``tol`` ends the descent and is
        not taken; any other is taken and recorded."""
        penalty = reg * float(self.weights @ self.weights)
        step = -learning_rate * (data_gradient + 2.0 * reg * self.weights)
        length = math.sqrt(float(step @ step))
        if length <= tol:
            self.stopped, self.stopped_at = True, self.iterations_applied
            return
        self.history.append((self.iterations_applied, data_cost + penalty, length))
        self.weights = self.weights + step


def weights_frame(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    """(pos, weight) rows from the driver-side vector (at most K rows)."""
    frame = pd.DataFrame({"pos": np.arange(len(weights), dtype=np.int32),
                          "weight": weights.astype(np.float64)})
    return spark.createDataFrame(frame, WEIGHT_SCHEMA)  # Arrow transfer


def gradient_tasks(spark: SparkSession) -> int:
    """Tasks of a gradient pass: the cluster's slots, or its shuffle sizing
    where that is larger (with dynamic allocation few slots may be up yet)."""
    return max(spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def gradient_pass(packed: DataFrame, weights: np.ndarray, tasks: int) -> tuple[np.ndarray, float]:
    """AG10, one job: summed gradient (K-vector) tf * (sigmoid(theta_d) - y) and
    summed cost softplus(theta_d) - y*theta_d before regularisation (FN5-FN9)."""
    total = blocks.sums(packed, weights, tasks)
    return total.gradient, total.cost


class DescentLog:
    """The steps of one descent in a folder of the cluster's file system: one
    folder per step, written with its weights and committed by Spark's own
    writer, so a half-written step is not there. ``settings`` name the run; a
    log of another run is an error."""

    SCHEMA = "step int, cost double, length double, stopped boolean, settings string, weights array<double>"

    def __init__(self, spark: SparkSession, path: str, settings: dict):
        self.spark, self.path, self.settings = spark, path.rstrip("/"), json.dumps(settings, sort_keys=True)

    def _folder(self, step: int) -> str:
        return f"{self.path}/step-{step:06d}"

    def append(self, model: "GdModel", step: int) -> None:
        """Step ``step`` of the history, or the end when it was not taken."""
        taken = step < len(model.history)
        cost, length = model.history[step][1:] if taken else (None, None)
        row = (step, cost, length, not taken, self.settings, model.weights.tolist())
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(self._folder(step))

    def steps(self) -> int:
        """Committed steps, without a gap."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        n = 0
        while files.exists(path(f"{self._folder(n)}/_SUCCESS")):
            n += 1
        return n

    def resume(self, model: "GdModel", iterations: int) -> None:
        """Put ``model`` where the log ends, or after ``iterations`` steps of it."""
        found = min(self.steps(), iterations)
        if not found:
            return
        read = self.spark.read.schema(self.SCHEMA)
        rows = sorted(read.parquet(*[self._folder(k) for k in range(found)]).drop("weights").collect(), key=lambda r: r.step)
        if any(r.settings != self.settings for r in rows):
            raise ValueError(f"{self.path} holds the log of another run: {rows[0].settings}, not {self.settings}")
        model.history = [(r.step, r.cost, r.length) for r in rows if not r.stopped]
        model.weights = np.array(read.parquet(self._folder(found - 1)).first().weights)
        if rows[-1].stopped:
            model.stopped, model.stopped_at = True, rows[-1].step


def fit_gd(rows: DataFrame, size: int, learning_rate: float, iterations: int, reg: float,
           tol: float = params.GD_TOLERANCE, prefix: str = params.REFERENCE_LABEL_PREFIX,
           mode: str = "cache", tasks: int | None = None, log: str | None = None) -> GdModel:
    """ML6-ML9: run gradient descent over the TF rows of ``size`` positions.
    ``mode="none"`` repacks ``rows`` in every pass instead of caching the
    blocks; ``tasks`` sets the tasks of a pass (default ``gradient_tasks``).
    ``log`` names a folder for the steps; a run that was cut off goes on after
    its last step there, and one with more ``iterations`` goes further. The
    rows must be those the log was begun with (their number is checked)."""
    packed = materialize(blocks.pack(rows, label_expr(F.col("doc_id"), prefix)), mode)
    tasks = tasks or gradient_tasks(rows.sparkSession)
    model = GdModel(weights=np.zeros(size))
    steps = None
    try:
        if log is not None:
            settings = {"size": size, "learning_rate": learning_rate, "reg": reg, "tol": tol, "prefix": prefix,
                        "documents": rows.count()}
            steps = DescentLog(rows.sparkSession, log, settings)
            steps.resume(model, iterations)
        while len(model.history) < iterations and not model.stopped:
            step = len(model.history)
            model.advance(*gradient_pass(packed, model.weights, tasks), learning_rate, reg, tol)
            if steps is not None:
                steps.append(model, step)
    finally:
        if mode == "cache":
            packed.unpersist()
    return model


def top_words(spark: SparkSession, model: GdModel, dictionary: DataFrame,
              n: int = params.TOP_WORDS) -> DataFrame:
    """ML10 (AG12 + JN4): the ``n`` largest weights with their words;
    ties by position (the reference's argsort leaves them unordered)."""
    order = (F.desc("weight"), F.asc("pos"))
    top = weights_frame(spark, model.weights).orderBy(*order).limit(n)
    ranked = top.select((F.row_number().over(Window.orderBy(*order))).cast("int").alias("rank"),
                        "pos", "weight")
    return ranked.join(dictionary.select("pos", "word"), "pos", "inner").select(
        "rank", "pos", "word", "weight")


def _theta(weights: np.ndarray, kept: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = np.repeat(np.arange(batch.num_rows), batch.column("pos").value_lengths().to_numpy())
            pos, tf = (batch.column(c).flatten().to_numpy() for c in ("pos", "tf"))
            theta = blocks.scores(owner, pos, tf, weights, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(theta)], [*kept, "theta"])
    return run


def theta(rows: DataFrame, weights: np.ndarray, kept: tuple[str, ...]) -> DataFrame:
    """FN5: the ``kept`` columns of ``rows`` with theta, the dot product of a
    document's entries with the weights."""
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.select(*kept, "pos", "tf").mapInArrow(_theta(weights, kept), ", ".join([*kinds, "theta double"]))


def predict_gd(rows: DataFrame, model: GdModel, prefix: str = params.REFERENCE_LABEL_PREFIX) -> DataFrame:
    """ML11: (doc_id, label, prediction); prediction 1 iff theta > 0 strictly
    (S14). Batch by batch in the scan stage."""
    labelled = rows.select("doc_id", label_expr(F.col("doc_id"), prefix).alias("label"), "pos", "tf")
    return theta(labelled, model.weights, ("doc_id", "label")).select(
        "doc_id", "label", F.when(F.col("theta") > 0, 1).otherwise(0).alias("prediction"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy, not this package
