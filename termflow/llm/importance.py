"""Importance resampling towards a target corpus: documents are drawn without
replacement in proportion to how much likelier their word n-grams are in the
target than in the corpus (Gumbel top-k over hashed n-gram features).

Weights come from one array of gains per hashed bucket. Ranks come from
parallel sorting by regular sampling: every written file of weights is a
locally sorted run, regular samples of the runs give splitters, the segments
between splitters are exchanged and sorted each on its own, and the counts of
the segments before it make a segment's places exact ranks.

Defined results: a null or empty text has no words, so no features, weight 0,
and is not drawn. Documents order by score, highest first, ties to the smaller
id (null ids last); rows equal in id and score, so also repeated rows, by
features and weight, and each has a rank of its own. The noise of a null id is
that of the empty string. An empty target or corpus gives gains from the other
alone; an empty table no rows. Extra columns, whatever their names, take no part.

Scale: texts are read twice (counts, weights) and never shuffled; counts are
one array per task. What is sorted is a few numbers per document. Splitters are
of the whole order, the place in the run included, so equal rows are split too
and a segment holds about a share of the rows, however they repeat. A driver
sees the counts of the buckets, one count per segment, and the splitters. A
text is held whole in its task; its words are taken in slices.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays
from .common import pick, written

BUCKETS = 10_000
#: A document needs so many words to be drawn; percent of those drawn; noise seed.
MIN_WORDS, PERCENT, SEED = 20, 5, 42
#: Regular samples of all runs together, and segments, at most.
SAMPLES, SEGMENTS = 1 << 18, 1 << 10
#: Words hashed at a time.
WORDS_AT_ONCE = 1 << 19
#: Words up to this many bytes are hashed by tables.
TABLE_BYTES = 48

#: Bytes outside [\x00-\x2F\x3A-\x60\x7B-\x7F], after A-Z became a-z, are word bytes.
SEPARATORS = arrays.byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def _byte_table() -> np.ndarray:
    """The CRC-32 register after each byte, from 0."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _zeros_tables(longest: int) -> np.ndarray:
    """[n, k, b]: the register after n zero bytes, from byte b in place k. The
    register is linear over XOR, so its four bytes add up."""
    table = _byte_table()
    out = np.empty((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(longest):
        out[n + 1] = table[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


class NgramHash:
    """CRC-32 of all runs of one to three words joined by a space. A word's own
    register is found byte by byte for all words at once; a run's by moving the
    register of the run before it over the word (zero bytes) and adding the
    word's."""

    def __init__(self) -> None:
        self.table, self.zeros = _byte_table(), _zeros_tables(TABLE_BYTES + 1)

    def _moved(self, register: np.ndarray, n: np.ndarray) -> np.ndarray:
        z, r = self.zeros, register
        return z[n, 0, r & 0xFF] ^ z[n, 1, (r >> 8) & 0xFF] ^ z[n, 2, (r >> 16) & 0xFF] ^ z[n, 3, r >> 24]

    def buckets(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the runs of one, two and three words from each word on;
        runs beyond the last word are missing."""
        size = end - start
        order = np.argsort(-size, kind="stable")
        first, lengths = start[order], size[order]
        long = int(np.searchsorted(-lengths, -TABLE_BYTES, "left"))
        state = np.zeros(len(order), np.uint32)
        for j in range(int(lengths[long]) if long < len(order) else 0):
            stop = int(np.searchsorted(-lengths, -j, "left"))
            part = state[long:stop]
            state[long:stop] = self.table[(part ^ buf[first[long:stop] + j]) & 0xFF] ^ (part >> 8)
        own = np.empty(len(order), np.uint32)
        own[order] = state
        known = np.minimum(size, TABLE_BYTES)
        slow = {int(k): buf[start[k]:end[k]].tobytes() for k in order[:long]}

        def after(register: np.ndarray, word: slice, space: bool) -> np.ndarray:
            n, w = known[word], own[word]
            if space:
                register = self.table[(register ^ 0x20) & 0xFF] ^ (register >> 8)
            out = self._moved(register, n) ^ w
            for k, text in slow.items():
                at = k - word.start
                if 0 <= at < len(out):
                    out[at] = zlib.crc32(text, int(register[at]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            return out

        n = len(start)
        one = after(np.full(n, 0xFFFFFFFF, np.uint32), slice(0, n), False)
        two = after(one[:max(n - 1, 0)], slice(1, n), True)
        three = after(two[:max(n - 2, 0)], slice(2, n), True)
        return tuple((~x % np.uint32(BUCKETS)).astype(np.int64) for x in (one, two, three))


def _slices(column: pa.Array) -> Iterator[tuple]:
    """(first row, end row, bytes, word starts, word ends, words left in the
    text from each on, word offsets by row): words of whole rows; of a longer
    text, slices that each hold two words of the next, which they do not own."""
    for lo, hi, buf, offs in arrays.blocks(column):
        buf = arrays.LOWER[buf]
        start, end, bounds = arrays.words(buf, offs, SEPARATORS)
        last = np.repeat(bounds[1:], np.diff(bounds))
        for a in range(0, len(start), WORDS_AT_ONCE):
            b = min(a + WORDS_AT_ONCE, len(start))
            c = min(b + 2, len(start))
            yield lo, hi, buf, start[a:c], end[a:c], last[a:b] - np.arange(a, b), np.clip(bounds, a, b) - a


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, hasher = np.zeros(BUCKETS, np.int64), NgramHash()
    for batch in batches:
        for _, _, buf, start, end, left, _ in _slices(batch.column(0)):
            for k, found in enumerate(hasher.buckets(buf, start, end)):
                own = min(len(left), len(found))
                total += np.bincount(found[:own][left[:own] > k], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all rows of the ``text`` column by bucket."""
    counts = pick(texts, "text").select(F.col("text").cast("string")).mapInArrow(_count, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths of a nat, floored."""
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + BUCKETS) / ((float(a) + 1) * (t + BUCKETS))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = NgramHash()
        for batch in batches:
            words, features, weight = np.zeros((3, batch.num_rows), np.int64)
            for lo, hi, buf, start, end, left, bounds in _slices(batch.column(1)):
                value = np.zeros(len(left), np.int64)
                for k, found in enumerate(hasher.buckets(buf, start, end)):
                    own = min(len(left), len(found))
                    value[:own] += np.where(left[:own] > k, gain[found[:own]], 0)
                weight[lo:hi] += arrays.sums(value, bounds)
                words[lo:hi] += np.diff(bounds)
                features[lo:hi] += arrays.sums(np.minimum(left, 3), bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return run


def scores(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row of ``docs``."""
    rows = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    gain = gains(bucket_counts(docs), bucket_counts(target))
    kind = rows.schema["doc_id"].dataType.simpleString()
    weighed = rows.mapInArrow(_weigh(gain), f"doc_id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


# ---- parallel sorting by regular sampling ----------------------------------------

def _segment(splitters: list[tuple], columns: list[str], down: list[bool]):
    """Adds seg, the number of splitters before a row in the whole order."""
    marks = [np.array([s[k] for s in splitters], np.int64) for k in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            # Splitters go first among equals; the last key of np.lexsort weighs most.
            both = [np.concatenate([m, v]) for m, v in zip(marks, values)]
            order = np.lexsort([-x if falling else x for x, falling in zip(both, down)][::-1])
            is_mark = order < len(splitters)
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(is_mark)
            seg = pa.array(before[len(splitters):].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, seg], [*batch.schema.names, "seg"])
    return run


def _number(offsets: dict[int, int]):
    """Adds rank to rows that come sorted within their segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = dict(offsets)
        for batch in batches:
            seg = batch.column("seg").to_numpy()
            rank = np.empty(len(seg), np.int64)
            for s in np.unique(seg).tolist():
                own = np.flatnonzero(seg == s)
                rank[own] = done[s] + 1 + np.arange(len(own))
                done[s] += len(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], [*batch.schema.names, "rank"])
    return run


def ranked(rows: DataFrame, order: list[tuple[str, bool]], name: str) -> DataFrame:
    """``rows`` with rank, their exact place (1, 2, ...) in ``order``: pairs of
    a long column without nulls and whether it falls. Rows equal in all of them
    have ranks of their own."""
    spark = rows.sparkSession
    kept = rows.columns
    ways = [F.desc(c) if falling else F.asc(c) for c, falling in order]
    runs = written(rows.sortWithinPartitions(*ways).withColumn("at", F.monotonically_increasing_id()), f"{name}-runs")
    run, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = runs.groupBy(run.alias("run")).agg(F.count("*").alias("n")).agg(F.count("*").alias("runs"), F.sum("n").alias("n")).first()
    total = sizes["n"] or 0
    segments = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), SEGMENTS, total))
    columns, down = [*[c for c, _ in order], "at"], [*[falling for _, falling in order], False]
    splitters: list[tuple] = []
    if segments > 1:
        # One sample a `step` rows of each run: a segment then holds at most
        # total / segments rows, and `step` more of each run.
        step = max(1, total // min(SAMPLES, segments * max(sizes["runs"], 8)))
        samples = written(runs.where(place % step == 0).select(*columns), f"{name}-samples")
        every = samples.count() / segments
        # All samples, SAMPLES and one a run, in one task: their number is bounded, not the data's.
        numbered = samples.withColumn("k", F.row_number().over(Window.orderBy(*ways, "at")) - 1)
        chosen = F.floor((F.col("k") + 1) / F.lit(every)) > F.floor(F.col("k") / F.lit(every))
        splitters = [tuple(r[c] for c in columns)
                     for r in numbered.where(chosen & (F.col("k") > 0)).select(*columns).collect()]
    schema = f"{runs.schema.simpleString()[7:-1].replace(':', ' ')}, seg int"
    cut = runs.mapInArrow(_segment(splitters, columns, down), schema)
    counts = {r["seg"]: r["n"] for r in cut.groupBy("seg").agg(F.count("*").alias("n")).collect()}
    offsets, before = {}, 0
    for seg in sorted(counts):
        offsets[seg] = before
        before += counts[seg]
    exchanged = cut.repartitionById(len(splitters) + 1, "seg").sortWithinPartitions("seg", *ways, "at")
    return exchanged.mapInArrow(_number(offsets), f"{schema}, rank long").select(*kept, "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``;
    rank numbers the floor(percent * N / 100) rows drawn of the N that have
    ``min_words`` words, and is null for the others."""
    found = written(scores(docs, target).withColumn("no_id", F.col("doc_id").isNull().cast("long"))
                    .withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0))), "resample-scores")
    able = found.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    order = [("score", True), ("no_id", False), ("id", False), ("n_features", False), ("weight", False)]
    placed = ranked(able, order, "resample").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = found.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Whole rows of the documents drawn by ``resample``: all rows of ``docs``
    whose doc_id has a rank."""
    ids = pick(found.where(F.col("rank").isNotNull()), "doc_id").distinct().withColumnRenamed("doc_id", "drawn_id")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    own = F.col(f"c{docs.columns.index('doc_id')}")
    return plain.join(ids, own.eqNullSafe(F.col("drawn_id")), "left_semi").toDF(*docs.columns)
