"""Passes over the TF rows as compressed sparse row blocks (AG10, FN5-FN9).

``pack`` turns TF rows into blocks once: the entries of some documents as four
flat buffers. A pass reads a block without taking it apart, works on all its
documents with a handful of array operations, and keeps one dense vector per
task, whatever the number of documents; the tasks' vectors are summed in a tree
of FANIN. So a pass moves tasks x K numbers up the tree and FANIN x K to the
driver. Sums are taken in the order of tasks and blocks: the same blocks give
the same bits again.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termflow.functions.logistic import sigmoid, softplus

#: Entries of a block (a document, of at most K entries, is never cut).
BLOCK_ENTRIES = 1 << 18
#: Vectors that one task, or the driver, sums.
FANIN = 32
SCHEMA = "y binary, ends binary, pos binary, tf binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("y").to_numpy().astype(np.float64)
        size = batch.column("pos").value_lengths().to_numpy()
        ends = np.cumsum(size, dtype=np.int64)
        pos, tf = (batch.column(c).flatten().to_numpy() for c in ("pos", "tf"))
        lo = 0
        while lo < len(y):
            start = int(ends[lo] - size[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, start + BLOCK_ENTRIES, "right")))
            stop = int(ends[hi - 1])
            parts = (y[lo:hi], ends[lo:hi] - start, pos[start:stop].astype(np.int32), tf[start:stop].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["y", "ends", "pos", "tf"])
            lo = hi


def pack(rows: DataFrame, y: Column) -> DataFrame:
    """Blocks of TF rows (pos, tf), with ``y`` as the label of a row."""
    return rows.select(y.cast("double").alias("y"), "pos", "tf").mapInArrow(_pack, SCHEMA)


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, document of each entry, positions, values) of every block."""
    kinds = (np.float64, np.int64, np.int32, np.float64)
    for k in range(batch.num_rows):
        y, ends, pos, tf = (np.frombuffer(batch.column(c)[k].as_buffer(), kind)
                            for c, kind in zip(("y", "ends", "pos", "tf"), kinds))
        yield y, np.repeat(np.arange(len(y)), np.diff(ends, prepend=0)), pos, tf


def scores(owner: np.ndarray, pos: np.ndarray, tf: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """FN5: theta of each of n documents, the dot product of its entries with the weights."""
    return np.bincount(owner, weights=tf * weights[pos], minlength=n)


def logistic(theta: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, derivative by theta) of the log loss for labels 0 and 1 (FN6-FN8)."""
    return softplus(theta) - y * theta, sigmoid(theta) - y


def hinge(theta: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, a subderivative by theta) of the hinge loss for labels 0 and 1."""
    sign = 2.0 * y - 1.0
    gap = 1.0 - sign * theta
    return np.maximum(gap, 0.0), np.where(gap > 0, -sign, 0.0)


@dataclass
class Sums:
    """Over all documents: cost, gradient by weight and by intercept, number."""
    cost: float
    gradient: np.ndarray
    by_intercept: float
    n: int


def _partial(weights: np.ndarray, intercept: float, loss):
    """One dense vector per task: K gradient entries, then cost, derivative by
    intercept and number of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(weights)
        total, some = np.zeros(k + 3), False
        for batch in batches:
            for y, owner, pos, tf in _entries(batch):
                cost, slope = loss(scores(owner, pos, tf, weights, len(y)) + intercept, y)
                total[:k] += np.bincount(pos, weights=tf * slope[owner], minlength=k)
                total[k:] += cost.sum(), slope.sum(), len(y)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], ["task", "total"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column("total"):
            part = np.frombuffer(part.as_buffer(), np.float64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          pa.array([total.tobytes()], pa.binary())], ["task", "total"])


def partial_sums(blocks: DataFrame, weights: np.ndarray, intercept: float, loss, tasks: int) -> DataFrame:
    """(task, total): at most FANIN vectors, those of ``tasks`` tasks summed in a tree."""
    out = blocks.coalesce(tasks).mapInArrow(_partial(weights, intercept, loss), "task int, total binary")
    while tasks > FANIN:
        tasks = math.ceil(tasks / FANIN)
        out = (out.repartitionById(tasks, F.floor(F.col("task") / FANIN).cast("int")).sortWithinPartitions("task")
               .mapInArrow(_merge, "task int, total binary"))
    return out


def sums(blocks: DataFrame, weights: np.ndarray, tasks: int, intercept: float = 0.0, loss=logistic) -> Sums:
    """One pass: cost and gradient at the given weights."""
    k = len(weights)
    rows = sorted(partial_sums(blocks, weights, intercept, loss, tasks).collect(), key=lambda r: r["task"])
    total = np.zeros(k + 3)
    for row in rows:
        total += np.frombuffer(bytes(row["total"]), np.float64)
    return Sums(float(total[k]), total[:k], float(total[k + 1]), int(total[k + 2]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy, not this package
