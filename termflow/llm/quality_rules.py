"""Quality rules by line sequence labelling: a linear-chain conditional random
field marks each line of a text as content or boilerplate by Viterbi decoding,
and the share of content decides whether the document stays.

The field has a weight per line feature and label and a weight per pair of
neighbouring labels. It is trained here by gradient ascent on the exact
log-likelihood (forward-backward), on the lines of a bounded sample of labelled
documents: the ``max_docs`` (2,000) labelled ids of smallest hash outside fold
0, without those of more than ``max_lines`` (500) lines. Lines are taught one
by one: a line that stands in texts of ``MIN_PLACES`` (5) kinds or more, and of
half as many as there are texts with it, is boilerplate wherever it stands, so
also within good prose. The kind of a text, as a line sees it, is its longest
other line: near copies of one text mostly share it, pages with one menu do
not. Of the other lines, those of documents labelled good are content, those of
bad ones boilerplate. A blank line takes the label of the line before it.
Decoding reads every line of every text.

Defined results: null and empty texts have no words and fail the base rules.
Blank lines are labelled, but only word characters count for the content
share. Without labels of both kinds every line is content. Input columns named
like a result column are replaced, others pass through; rows that repeat are
judged each for itself.

Scale: one pass without a shuffle, memory of one block of texts (about 1 MB,
or the longest text). Training broadcasts at most ``max_docs`` ids and the
hashes of their lines (``max_docs * max_lines``), and counts the kinds of text
with these lines over all documents, two sketches a line, combined in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, SPACES, Rolling, blocks, byte_set, covered, lines, multiplicity, owners, sums, windows, within, words
from .common import append_columns, written
from .quality_classifier import fold

MAX_DOCS, MAX_LINES, MIN_PLACES = 2_000, 500, 5
#: Fixed by the query's contract.
SYMBOLS, WINDOW, LEAST_WORDS, MOST_REPEATED = b"#*$%&|<>", 8, 20, 30
#: A document stays when at least this share of its word characters is content.
LEAST_CONTENT = 0.5

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_CONTINUATION = byte_set((0x80, 0xBF))
_UPPER, _LOWER, _DIGIT = byte_set((0x41, 0x5A)), byte_set((0x61, 0x7A)), byte_set((0x30, 0x39))
_STOP = np.isin(np.arange(256), np.frombuffer(b".?!:", np.uint8))
_COMMA = np.isin(np.arange(256), np.frombuffer(b",;", np.uint8))
_EXCLAIM = np.isin(np.arange(256), np.frombuffer(b"!", np.uint8))
FEATURES = ("bias", "blank", "words_1_3", "words_4_9", "words_10", "symbols", "symbol_words", "upper", "caps_words",
            "digits", "exclaims", "commas", "stop_end", "distinct", "repeats_line", "repeated_words")


def _counter(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


class Block:
    """The words, lines and base counts of a block of texts."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.n = len(offs) - 1
        self.start, self.end, self.bounds = words(buf, offs)
        self.owner = owners(self.bounds)
        self.n_words = np.diff(self.bounds)
        self.l_start, self.l_end, self.l_bounds = lines(buf, offs)
        self.points = _counter(~SPACES[buf] & ~_CONTINUATION[buf])
        self.symbols = _counter(_SYMBOL[buf])
        self.word_chars = self.points[offs[1:]] - self.points[offs[:-1]]
        self.n_symbols = self.symbols[offs[1:]] - self.symbols[offs[:-1]]
        # Lines with a word that equal an earlier line of the text.
        self.l_first_word = np.searchsorted(self.start, self.l_start)
        self.l_words = np.searchsorted(self.start, self.l_end) - self.l_first_word
        full = self.l_words > 0
        rolling = Rolling(buf)
        _, first = multiplicity(within(rolling.ranges(self.l_start, self.l_end), owners(self.l_bounds)))
        self.l_again = full & ~first
        self.n_dup_lines = sums(self.l_again, self.l_bounds)
        # Words in windows that the text holds twice or more.
        self.hashes = rolling.ranges(self.start, self.end)
        at, keys = windows(self.hashes, self.bounds, WINDOW)
        times, _ = multiplicity(within(keys, self.owner[at]))
        self.repeated = covered(at[times > 1], WINDOW, len(self.start))
        self.n_repeat_words = sums(self.repeated, self.bounds)
        self.base_failed = (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED * self.n_words)
        self.buf = buf

    def line_features(self) -> np.ndarray:
        """One row of FEATURES for each line."""
        buf, s, e, w = self.buf, self.l_start, self.l_end, self.l_words
        points = self.points[e] - self.points[s]
        some, many, full = np.maximum(points, 1), np.maximum(w, 1), w > 0
        share = lambda table: (lambda c: (c[e] - c[s]) / some)(_counter(table[buf]))
        low, high = self.l_first_word, self.l_first_word + w
        by_word = lambda flags: (lambda c: (c[high] - c[low]) / many)(_counter(flags))
        upper, lower = _counter(_UPPER[buf]), _counter(_LOWER[buf])
        caps = (upper[self.end] > upper[self.start]) & (lower[self.end] == lower[self.start])
        line_of_word = np.repeat(np.arange(len(s)), w)
        folded = within(Rolling(LOWER[buf], 1).ranges(self.start, self.end), line_of_word)
        _, first = multiplicity(folded)
        stop = np.zeros(len(s), bool)
        last = np.where(full, self.end[np.maximum(high - 1, 0)] - 1 if len(self.end) else 0, 0)
        stop[full] = _STOP[buf[last[full]]]
        return np.stack([
            np.ones(len(s)), ~full, (w > 0) & (w < 4), (w > 3) & (w < 10), w > 9, share(_SYMBOL),
            by_word(_SYMBOL[buf[self.end - 1]]), share(_UPPER), by_word(caps), share(_DIGIT), share(_EXCLAIM),
            share(_COMMA), stop, by_word(first), self.l_again, by_word(self.repeated)], 1).astype(float)


def _steps(bounds: np.ndarray):
    """For t = 0, 1, ...: the element at position t of every sequence that is
    longer than t, and those sequences, longest first."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    ordered = size[order]
    for t in range(int(ordered[0]) if len(ordered) else 0):
        active = order[:np.searchsorted(-ordered, -t, "left")]
        yield t, active, bounds[active] + t


def viterbi(emission: np.ndarray, transition: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Best label of every line; sequences by ``bounds``, all decoded together."""
    n = len(emission)
    back = np.zeros((n, 2), np.int8)
    best = np.zeros((len(bounds) - 1, 2))
    steps = list(_steps(bounds))
    for t, active, at in steps:
        if t:
            options = best[active][:, :, None] + transition[None]
            back[at] = options.argmax(1)
            best[active] = options.max(1) + emission[at]
        else:
            best[active] = emission[at]
    label, state = np.zeros(n, np.int8), best.argmax(1)
    for t, active, at in reversed(steps):
        ends = bounds[active + 1] == at + 1
        state_here = np.where(ends, best[active].argmax(1), state[active])
        label[at] = state_here
        state[active] = back[at, state_here]
    return label


def crf_objective(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, l2: float = 1.0):
    """Penalised log-likelihood per line of all sequences, and its gradient, as
    a function of the weights (features by label, then label by next label)."""
    n, f = x.shape
    steps = list(_steps(bounds))
    one_hot = np.eye(2)[y]
    inner = np.ones(n, bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    seen_pairs = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(seen_pairs, (y[at - 1], y[at]), 1)
    ends = bounds[1:][np.diff(bounds) > 0] - 1

    def value_and_gradient(theta: np.ndarray) -> tuple[float, np.ndarray]:
        w, trans = theta[:2 * f].reshape(f, 2), theta[2 * f:].reshape(2, 2)
        emission = x @ w
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        for t, _, here in steps:
            alpha[here] = emission[here]
            if t:
                alpha[here] += np.logaddexp.reduce(alpha[here - 1][:, :, None] + trans[None], axis=1)
        for t, _, here in reversed(steps):
            if t:
                beta[here - 1] = np.logaddexp.reduce(trans[None] + (emission[here] + beta[here])[:, None, :], axis=2)
        total = alpha + beta
        norm = np.logaddexp(total[:, 0], total[:, 1])
        unary = np.exp(total - norm[:, None])
        pair = np.exp(alpha[at - 1][:, :, None] + trans[None] + (emission[at] + beta[at])[:, None, :]
                      - norm[at][:, None, None]).sum(0)
        seen = (emission * one_hot).sum() + (trans * seen_pairs).sum()
        value = (seen - np.logaddexp(alpha[ends, 0], alpha[ends, 1]).sum() - l2 * (theta @ theta) / 2) / n
        grad = np.concatenate([(x.T @ (one_hot - unary)).ravel(), (seen_pairs - pair).ravel()]) / n - l2 * theta / n
        return float(value), grad

    return value_and_gradient


def fit_crf(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, rounds: int = 150, rate: float = 0.1,
            l2: float = 1.0) -> dict:
    """Weights of maximum penalised likelihood by Adam steps on exact
    gradients (forward-backward over all sequences at once)."""
    n, f = x.shape
    model = {"w": np.zeros((f, 2)), "t": np.zeros((2, 2))}
    if not n or y.min() == y.max():
        model["w"][0, 0] = 1.0  # everything is content
        return model
    objective = crf_objective(x, y, bounds, l2)
    theta, m, v = np.zeros(2 * f + 4), np.zeros(2 * f + 4), np.zeros(2 * f + 4)
    for k in range(1, rounds + 1):
        _, grad = objective(theta)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return {"w": theta[:2 * f].reshape(f, 2), "t": theta[2 * f:].reshape(2, 2)}


def line_names(text: Column) -> Column:
    """Of each line, blanks around it aside: minus its length, and its hash (0
    for blank lines)."""
    def name(line):
        return F.when(F.length(line) > 0, F.xxhash64(line)).otherwise(0).cast("long")

    stripped = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)))
    return F.transform(stripped, lambda x: F.struct((-F.length(x)).alias("size"), name(x).alias("line")))


def placed_lines(docs: DataFrame, wanted: DataFrame, min_places: int = MIN_PLACES) -> DataFrame:
    """(line): those of ``wanted`` that ``docs`` (text) hold in texts of
    ``min_places`` kinds or more, and of half as many as there are texts with
    them. Texts and kinds are counted by mergeable sketches (5 % error)."""
    rows = docs.select(F.xxhash64("text").alias("tid"), F.array_sort(F.array_distinct(line_names(F.col("text")))).alias("lines"))
    longest, next_longest = (F.get("lines", F.lit(k))["line"] for k in (0, 1))
    at = rows.select("tid", longest.alias("a"), next_longest.alias("b"), F.explode("lines.line").alias("line")).where("line <> 0")
    place = F.when(F.col("line") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    found = (at.select("tid", "line", place.alias("place")).join(F.broadcast(wanted), "line").groupBy("line")
             .agg(F.approx_count_distinct("place").alias("places"), F.approx_count_distinct("tid").alias("texts")))
    return found.where((F.col("places") >= min_places) & (2 * F.col("places") >= F.col("texts"))).select("line")


def teach(y: np.ndarray, lines: np.ndarray, placed: np.ndarray) -> np.ndarray:
    """Labels of the lines of one document from its own (1 is boilerplate) and
    the lines found in many places."""
    label = np.where(np.isin(lines, placed), 1, y)
    for k in np.flatnonzero(lines == 0):  # in order, so runs of blank lines agree
        label[k] = label[k - 1] if k else y[k]
    return label


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> dict:
    """Fit the field; label 0 is content, 1 boilerplate."""
    ids = (labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))

    def measure(batches):
        for batch in batches:
            rows = []
            for _, _, buf, offs in blocks(batch.column(2)):
                block = Block(buf, offs)
                x = block.line_features()
                rows += [x[a:b].ravel().tolist() if b - a <= max_lines else []
                         for a, b in zip(block.l_bounds[:-1], block.l_bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64())),
                                              batch.column(3)], ["doc_id", "y", "x", "lines"])

    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most max_docs pairs of numbers are broadcast; at most max_docs * max_lines lines come back.
    sample = written(every.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text", line_names(F.col("text"))["line"].alias("lines"))
                     .mapInArrow(measure, "doc_id long, y int, x array<double>, lines array<long>").where(F.size("x") > 0)
                     .groupBy("doc_id").agg(F.min(F.struct("y", "x", "lines")).alias("r"))
                     .select("doc_id", "r.y", "r.x", "r.lines"), "crf-sample")
    wanted = sample.select(F.explode("lines").alias("line")).where("line <> 0").distinct()
    placed = np.array([r["line"] for r in placed_lines(every, wanted).collect()], np.int64)
    rows = sample.toArrow().sort_by("doc_id")
    xs = [np.array(x, float).reshape(-1, len(FEATURES)) for x in rows.column("x").to_pylist()]
    sizes = [len(x) for x in xs]
    x = np.concatenate(xs) if xs else np.zeros((0, len(FEATURES)))
    own = 1 - np.array(rows.column("y").to_pylist(), int).clip(0, 1)
    taught = [teach(np.full(len(lines), label), np.array(lines, np.int64), placed)
              for label, lines in zip(own, rows.column("lines").to_pylist(), strict=True)]
    y = np.concatenate(taught).astype(int) if taught else np.zeros(0, int)
    return fit_crf(x, y, np.concatenate([[0], np.cumsum(sizes)]).astype(int))


_ADDED = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
          ("n_repeat_words", "long"), ("base_failed", "boolean"), ("kept", "boolean"), ("n_lines", "long"),
          ("n_boilerplate_lines", "long"), ("content_share", "double")]


def judge(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, the labelled line counts, the content
    share and the verdict ``kept``."""

    def compute(column):
        parts = []
        for _, _, buf, offs in blocks(column):
            b = Block(buf, offs)
            label = viterbi(b.line_features() @ model["w"], model["t"], b.l_bounds)
            chars = b.points[b.l_end] - b.points[b.l_start]
            share = sums(np.where(label == 0, chars, 0), b.l_bounds) / np.maximum(b.word_chars, 1)
            parts.append((b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
                          ~b.base_failed & (share >= LEAST_CONTENT), np.diff(b.l_bounds),
                          sums(label == 1, b.l_bounds), share))
        if not parts:
            parts = [tuple(np.zeros(0, bool if k in (5, 6) else float if k == 9 else np.int64) for k in range(10))]
        return [pa.array(np.concatenate(values)) for values in zip(*parts, strict=True)]

    return append_columns(docs, text, compute, _ADDED)


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels and judge every document."""
    return judge(docs.select("doc_id", "text"), train(docs, labels)).drop("text")
