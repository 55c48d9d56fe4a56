"""Quality classifier: histogram gradient-boosted trees over statistics of the
text, fitted with numpy and flattened into arrays; scoring walks all trees for
a block of documents at once.

Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0,
and from a bounded sample of them: the ``max_rows`` (20,000) labelled ids of
smallest hash. Inputs of a score are statistics of the text alone, never lang,
source, doc_id or labels.

Defined results: null and empty texts have zero statistics and get a score
like any other. A document with several labels is good if any says so; ids that
repeat train once. Without labels of both kinds the score is the constant
share of label 1 (0.5 without labels). Rows with a null doc_id are not trained
on and not held out. Extra columns pass through ``score``; an input column
named ``score`` is replaced.

Scale: training broadcasts at most ``max_rows`` ids and gathers at most as many
rows of statistics. Scoring is one pass without a shuffle; its memory is that
of a block of texts, about 1 MB or the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, SPACES, Rolling, blocks, byte_set, lines, multiplicity, owners, sums, within, words
from .common import append_columns

MAX_ROWS = 20_000
#: Fixed by the query's contract.
FOLDS, CUT = 5, 0.3

_CLASSES = np.full(256, 9, np.int64)
for _k, _table in enumerate((
        byte_set((0x61, 0x7A)), byte_set((0x41, 0x5A)), byte_set((0x30, 0x39)), SPACES,
        byte_set((0x80, 0xBF)), byte_set((0xC0, 0xFF)),
        np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8)),
        np.isin(np.arange(256), np.frombuffer(b".,;:?'\"()-", np.uint8)),
        np.isin(np.arange(256), np.frombuffer(b"!", np.uint8)))):
    _CLASSES[_table] = _k
STATISTICS = (
    "chars", "words", "lower", "upper", "digits", "spaces", "non_ascii", "symbols", "punctuation", "exclaims",
    "other", "word_bytes", "long_words", "short_words", "caps_words", "capitalised", "symbol_ends", "stop_ends",
    "exclaim_ends", "one_byte_symbols", "distinct_words", "top_word", "same_as_previous", "lines", "words_a_line",
    "repeated_lines", "one_word_lines", "stop_lines")


def document_statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a block."""
    n = len(offs) - 1
    owner = owners(offs)
    kinds = np.bincount(owner * 10 + _CLASSES[buf], minlength=10 * n).reshape(n, 10).astype(float)
    chars = kinds.sum(1) - kinds[:, 4]
    some = np.maximum(chars, 1)
    start, end, bounds = words(buf, offs)
    size, word_owner = end - start, owners(bounds)
    count = np.diff(bounds).astype(float)
    many = np.maximum(count, 1)
    kind = _CLASSES[buf]
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    lower = np.concatenate([[0], np.cumsum(kind == 0)])
    has_upper, has_lower = upper[end] > upper[start], lower[end] > lower[start]
    last, first = kind[end - 1], kind[start]
    stop = np.isin(buf, np.frombuffer(b".?!", np.uint8))
    keys = within(Rolling(LOWER[buf]).ranges(start, end), word_owner)
    times, is_first = multiplicity(keys)
    top = np.zeros(n)
    np.maximum.at(top, word_owner, times)
    same = np.zeros(len(keys), bool)
    same[1:] = keys[1:] == keys[:-1]
    l_start, l_end, l_bounds = lines(buf, offs)
    l_words = np.searchsorted(start, l_end) - np.searchsorted(start, l_start)
    l_keys = within(Rolling(buf, 1).ranges(l_start, l_end), owners(l_bounds))
    _, l_first = multiplicity(l_keys)
    full = l_words > 0
    n_lines = np.maximum(sums(full, l_bounds), 1)
    l_stop = np.zeros(len(l_end), bool)
    l_stop[full] = stop[l_end[full] - 1]
    of_words = lambda flags: sums(flags, bounds) / many
    of_lines = lambda flags: sums(flags & full, l_bounds) / n_lines
    columns = [
        np.log1p(chars), np.log1p(count), kinds[:, 0] / some, kinds[:, 1] / some, kinds[:, 2] / some,
        kinds[:, 3] / some, kinds[:, 5] / some, kinds[:, 6] / some, kinds[:, 7] / some, kinds[:, 8] / some,
        kinds[:, 9] / some, sums(size, bounds) / many, of_words(size > 12), of_words(size <= 3),
        of_words(has_upper & ~has_lower & (size > 1)), of_words((first == 1) & has_lower), of_words(last == 6),
        of_words(last == 7), of_words(last == 8), of_words((size == 1) & (last == 6)), of_words(is_first),
        top / many, of_words(same), np.log1p(sums(full, l_bounds)), np.log1p(count / n_lines),
        of_lines(~l_first), of_lines(l_words == 1), of_lines(l_stop)]
    return np.stack(columns, 1)


def statistics(column: pa.Array) -> np.ndarray:
    parts = [document_statistics(buf, offs) for _, _, buf, offs in blocks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
              l2: float = 1.0, least: int = 20) -> dict:
    """Logistic boosting on histograms. The model is flat: heap-ordered nodes
    of all trees in (trees, 2**depth - 1) arrays of feature and threshold, and
    (trees, 2**depth) leaf values; an unsplit node sends every row left."""
    n, f = x.shape
    share = float(np.mean(y)) if n else 0.5
    inner, leaves = 2**depth - 1, 2**depth
    model = {"depth": depth, "feature": np.zeros((0, inner), np.int64), "threshold": np.zeros((0, inner)),
             "value": np.zeros((0, leaves)), "base": 0.0, "constant": share}
    if not n or not 0 < share < 1:
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(f)], 1)  # bin b: edge b-1 < x <= edge b
    slots = binned + np.arange(f) * bins
    margin = np.full(n, np.log(share / (1 - share)))
    model["base"], model["constant"] = margin[0], None
    kept = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)  # within the level
        for level in range(depth):
            width = 2**level
            cell = (node[:, None] * (f * bins) + slots).ravel()
            shape = (width, f, bins)
            sum_g, sum_h, sum_n = (np.bincount(cell, np.repeat(v, f), width * f * bins).reshape(shape).cumsum(2)
                                   for v in (g, h, np.ones(n)))
            all_g, all_h, all_n = (s[:, :, -1:] for s in (sum_g, sum_h, sum_n))
            gain = (sum_g**2 / (sum_h + l2) + (all_g - sum_g)**2 / (all_h - sum_h + l2) - all_g**2 / (all_h + l2))
            gain[(sum_n < least) | (all_n - sum_n < least)] = -1
            best = gain.reshape(width, -1).argmax(1)
            value = gain.reshape(width, -1)[np.arange(width), best]
            cut_f, cut_b = best // bins, best % bins
            right = np.zeros(n, bool)
            for k in range(width):
                if value[k] > 1e-9 and cut_b[k] < len(edges[cut_f[k]]):
                    feature[width - 1 + k], threshold[width - 1 + k] = cut_f[k], edges[cut_f[k]][cut_b[k]]
                    right |= (node == k) & (binned[:, cut_f[k]] > cut_b[k])
            node = node * 2 + right
        leaf = -rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + l2)
        margin = margin + leaf[node]
        kept.append((feature, threshold, leaf))
    model["feature"], model["threshold"], model["value"] = (np.stack(part) for part in zip(*kept, strict=True))
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1: all trees step down together, a level a time."""
    if model["constant"] is not None:
        return np.full(len(x), model["constant"])
    trees = np.arange(len(model["feature"]))
    node = np.zeros((len(x), len(trees)), np.int64)
    rows = np.arange(len(x))[:, None]
    for _ in range(model["depth"]):
        node = 2 * node + 1 + (x[rows, model["feature"][trees, node]] > model["threshold"][trees, node])
    leaf = node - (2**model["depth"] - 1)
    return 1 / (1 + np.exp(-(model["base"] + model["value"][trees, leaf].sum(1))))


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod FOLDS; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings) -> dict:
    """Fit on the ``max_rows`` labelled ids of smallest hash outside fold 0."""
    ids = (labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))

    def measure(batches):
        for batch in batches:
            x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    # At most max_rows pairs of numbers are broadcast, and as many rows come back.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = sample.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")
    rows = (sample.mapInArrow(measure, "doc_id long, y int, x array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("r")).select("doc_id", "r.y", "r.x")
            .toArrow())
    rows = rows.sort_by("doc_id")
    x = np.array(rows.column("x").to_pylist(), float).reshape(rows.num_rows, len(STATISTICS))
    return fit_trees(x, np.array(rows.column("y").to_pylist(), float), **settings)


def score(docs: DataFrame, model: dict, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a score column."""
    return append_columns(docs, text, lambda texts: [pa.array(predict(model, statistics(texts)), pa.float64())],
                          [(column, "double")])


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, max_rows))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
