"""Substring deduplication with a logarithmic family of suffix arrays.

Every byte covered by a ``LENGTH``-byte (200) string that starts anywhere else
too is removed. Texts are bytes (UTF-8); matches never cross documents.

Suffix arrays are sparse: of the suffixes that start within a 200-byte window
and have ``GRAM`` (100) bytes left in it, the one whose first 100 bytes hash
lowest (leftmost on ties) is the window's anchor. Equal windows have equal
anchors, so every repeated window is found at anchors alone, about one in fifty
suffixes. An array holds its anchors ordered by (hash of the first 100 bytes,
hash of all windows of the anchor); adjacent entries that agree in the first
are matches of 100 bytes, in both are matches of all their windows.

Batches become arrays; a new array is merge-scanned against each level of the
index, and levels of one size class merge to the next, so n batches keep
log n levels. The scan looks at neighbours only and marks entries that match
wholly, and entries whose windows must be compared one by one; for those the
bytes of the anchor's windows are fetched from their texts and windows are
compared by a second hash within the group of equal first 100 bytes.

Defined results: null and empty texts have no bytes; texts under 200 bytes lose
none. Copies of a text of 200 bytes or more lose everything, every copy.
Repeated rows are copies. Extra columns pass through ``remove_repeats``; those
named like a result column are replaced.

Scale: anchors, not suffixes, are shuffled (about 25 bytes for 50 of text).
No group is held: the scan keeps one entry, and groups of windows above
``CELL`` members are dealt to several cells, whose single windows meet again by
hash. Texts are shuffled once, and those with windows to compare a second time.
Anchors and texts are named by 64-bit hashes, windows by two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import Rolling, blocks, mix, multiplicity, sliding_min
from .common import Passed, delete, release, scratch_path, written

#: Fixed by the query's contract: bytes of a repeated string.
LENGTH = 200
GRAM = 100
#: Windows groups are dealt to cells of about this many members.
CELL = 2_000
#: Batches that the whole-table query cuts its documents into.
BATCHES = 2
RESULT = ("n_bytes", "n_removed", "n_spans", "kept")

_U = np.uint64


def anchors(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, first window, last window, hash of the gram, hash of all its
    windows' bytes) of every anchor of a block; windows by their first byte."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    roll = Rolling(buf)
    g = roll.grams(gram)
    key = (g & _U(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    low = sliding_min(key, length - gram + 1)
    at = (low & _U(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(offs)
    starts = np.maximum(size - length + 1, 0)
    text = np.repeat(np.arange(len(size)), starts)
    if not len(text):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    window = np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts) + np.repeat(offs[:-1], starts)
    pos = at[window]
    new = np.ones(len(pos), bool)
    new[1:] = (pos[1:] != pos[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pos)) - 1
    s1, s2, p = window[first], window[last], pos[first]
    whole = Rolling(buf, 1).ranges(s1, s2 + length)
    whole = mix(whole + (p - s1).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return text[first], s1, s2, g[p], whole


_ENTRY = pa.schema([("g", pa.int64()), ("c", pa.int64()), ("tid", pa.int64()), ("k", pa.int32())])
_ENTRY_DDL = "g long, c long, tid long, k int"


def _entries(length: int, gram: int):
    def run(batches):
        """Anchors of texts; a text this task has seen is not entered again."""
        seen = set()
        for batch in batches:
            tids = batch.column(0).to_numpy()
            for lo, hi, buf, offs in blocks(batch.column(1)):
                text, _, _, g, c = anchors(buf, offs, length, gram)
                mine = tids[lo:hi]
                fresh = np.zeros(hi - lo, bool)
                for k in range(hi - lo):
                    if int(mine[k]) not in seen:
                        seen.add(int(mine[k]))
                        fresh[k] = True
                keep = fresh[text]
                text, g, c = text[keep], g[keep], c[keep]
                # An anchor that a text repeats is one entry.
                order = np.lexsort((c, g, text))
                text, g, c = text[order], g[order], c[order]
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(g))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[at].view(np.int64)), pa.array(c[at].view(np.int64)), pa.array(mine[text[at]]),
                     pa.array(count)], schema=_ENTRY)

    return run


def _neighbours(only_matches: bool):
    def run(batches):
        """Entries in (g, c) order with ``whole`` (all windows match
        elsewhere) and ``some`` (windows must be compared). Holds one entry
        back until its successor is known."""
        held, before = None, None  # the entry held back, and the (g, c) before it
        pieces = iter(batches)
        ended = False
        while not ended:
            batch = next(pieces, None)
            ended = batch is None
            if held is not None:
                batch = held if ended else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if batch is None or not batch.num_rows:
                continue
            g, c, k = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_numpy()
            same_g, same_c = np.zeros(len(g) + 1, bool), np.zeros(len(g) + 1, bool)  # entry and the one before it
            same_g[1:-1] = g[1:] == g[:-1]
            same_c[1:-1] = same_g[1:-1] & (c[1:] == c[:-1])
            if before is not None:
                same_g[0] = before[0] == g[0]
                same_c[0] = same_g[0] and before[1] == c[0]
            whole = same_c[:-1] | same_c[1:] | (k > 1)
            some = (same_g[:-1] & ~same_c[:-1]) | (same_g[1:] & ~same_c[1:])
            n = len(g) if ended else len(g) - 1
            held = None if ended else batch.slice(n, 1)
            if n:
                before = (g[n - 1], c[n - 1])
                out = pa.RecordBatch.from_arrays([*batch.slice(0, n).columns, pa.array(whole[:n]), pa.array(some[:n])],
                                                 [*_ENTRY.names, "whole", "some"])
                yield out.filter(pa.array((whole | some)[:n])) if only_matches else out

    return run


_MARKED_DDL = _ENTRY_DDL + ", whole boolean, some boolean"


class SuffixIndex:
    """A family of sorted anchor tables in the shared folder. ``insert`` adds a
    batch (tid, text) and returns the matches it makes, on both sides."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.length, self.gram = spark, length, gram
        self.levels: list[tuple[int, str]] = []  # (batches merged, path), largest first

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(_ENTRY_DDL).parquet(path)

    def _sorted(self, frame: DataFrame) -> DataFrame:
        return frame.repartition("g").sortWithinPartitions("g", "c")

    def insert(self, texts: DataFrame, report: bool = True) -> DataFrame | None:
        """``report=False`` skips the scan of a first batch by itself, when the
        next one will merge with it anyway."""
        run = scratch_path(self.spark, "array")
        self._sorted(texts.mapInArrow(_entries(self.length, self.gram), _ENTRY_DDL)).write.parquet(run)
        release(self.spark)
        size, path, found = 1, run, []
        # Levels of its size merge with it, and the scan that merges finds the matches.
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            merged, marked = scratch_path(self.spark, "array"), scratch_path(self.spark, "matches")
            (self._sorted(self._read(path).union(self._read(other)))
             .mapInArrow(_neighbours(False), _MARKED_DDL).write.parquet(merged))
            everything = self.spark.read.schema(_MARKED_DDL).parquet(merged)
            everything.where("whole or some").write.parquet(marked)
            found.append(self.spark.read.schema(_MARKED_DDL).parquet(marked))
            release(self.spark)
            delete(self.spark, path)
            delete(self.spark, other)
            size, path = size * 2, merged
        # The larger levels are scanned and stay.
        for _, other in self.levels:
            found.append(written(self._sorted(self._read(path).union(self._read(other)))
                                 .mapInArrow(_neighbours(True), _MARKED_DDL), "matches"))
        if not found and report:
            found.append(written(self._read(path).repartition("g").sortWithinPartitions("g", "c")
                                 .mapInArrow(_neighbours(True), _MARKED_DDL), "matches"))
        self.levels.append((size, path))
        out = found[0] if found else None
        for more in found[1:]:
            out = out.union(more)
        return out


_OPEN = pa.schema([("tid", pa.int64()), ("spans", pa.list_(pa.int64())), ("text", pa.binary()),
                   ("g", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])
_OPEN_DDL = "tid long, spans array<long>, text binary, g long, at long, bytes binary"


def _locate(length: int, gram: int):
    def run(batches):
        """(tid, text, marks) -> a row per text with the spans (flat list of
        from, to) that match wholly, and a row per anchor to be compared."""
        for batch in batches:
            tids = batch.column(0)
            marks = batch.column(2)
            for lo, hi, buf, offs in blocks(batch.column(1)):
                text, s1, s2, g, c = anchors(buf, offs, length, gram)
                cut = np.searchsorted(text, np.arange(hi - lo + 1))
                rows = []
                for k in range(hi - lo):
                    mark = {(m["g"], m["c"]): (m["whole"], m["some"]) for m in marks[lo + k].as_py()}
                    a, b = cut[k], cut[k + 1]
                    gs, cs = g[a:b].view(np.int64).tolist(), c[a:b].view(np.int64).tolist()
                    spans, asked, base, tid = [], set(), int(offs[k]), tids[lo + k].as_py()
                    compare = []
                    for i, pair in enumerate(zip(gs, cs, strict=True)):
                        whole, some = mark.get(pair, (False, False))
                        first, end = int(s1[a + i]), int(s2[a + i]) + length
                        if whole:
                            spans += [first - base, end - base]
                        if some and pair not in asked:
                            asked.add(pair)
                            compare.append({"tid": tid, "g": pair[0], "at": first - base, "bytes": buf[first:end].tobytes()})
                    rows.append({"tid": tid, "spans": spans, "text": buf[base:offs[k + 1]].tobytes()})
                    rows += compare
                yield pa.RecordBatch.from_pylist(rows, schema=_OPEN)

    return run


_WINDOW = pa.schema([("tid", pa.int64()), ("at", pa.int64()), ("g", pa.int64()), ("w", pa.int64())])
_WINDOW_DDL = "tid long, at long, g long, w long"


def _compare(length: int):
    def run(batches):
        """Anchor rows (g, salt, cells, tid, at, bytes) in (g, salt) order ->
        (tid, at, null, null) for windows found twice in the cell, and (tid,
        at, g, hash) for the windows of groups of several cells."""
        def solve(table):
            if not table.num_rows:
                return
            g, salt, cells, tid, at = (table.column(k).to_numpy() for k in range(5))
            column = table.column(5)
            data = [x.as_py() for x in column]
            offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
            buf = np.frombuffer(b"".join(data), np.uint8)
            count = np.diff(offs) - length + 1
            row = np.repeat(np.arange(len(data)), count)
            start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            first = offs[row] + start
            w = Rolling(buf, 1).ranges(first, first + length)
            group = mix(mix(g.view(np.uint64)) + salt.astype(np.uint64))
            times, is_first = multiplicity(mix(w + group[row]))
            twice = times > 1
            spread = is_first & (cells[row] > 1)
            for pick, known in ((twice, True), (spread, False)):
                r = row[pick]
                nothing = pa.nulls(len(r), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tid[r]), pa.array(at[r] + start[pick]), nothing if known else pa.array(g[r]),
                     nothing if known else pa.array(w[pick].view(np.int64))], schema=_WINDOW)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [*held, batch]).combine_chunks()
            g, salt = table.column(0).to_numpy(), table.column(1).to_numpy()
            cut = int(np.argmax((g == g[-1]) & (salt == salt[-1])))
            yield from solve(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    return run


def _remove(length: int):
    def run(batches):
        """(tid, spans, text, windows) -> (tid, n_removed, n_spans, kept)."""
        schema = pa.schema([("tid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        for batch in batches:
            rows = []
            for tid, spans, text, starts in zip(*(batch.column(k) for k in range(4)), strict=True):
                buf = np.frombuffer(text.as_py(), np.uint8)
                edge = np.zeros(len(buf) + 1, np.int64)
                span = np.array(spans.as_py() or [], np.int64)
                one = np.array(starts.as_py() or [], np.int64)
                np.add.at(edge, span[0::2], 1)
                np.add.at(edge, span[1::2], -1)
                np.add.at(edge, one, 1)
                np.add.at(edge, one + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append({"tid": tid.as_py(), "n_removed": int(gone.sum()), "n_spans": runs,
                             "kept": buf[~gone].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES
                   ) -> tuple[DataFrame, DataFrame]:
    """(tid, n) for texts that occur n > 1 times, and (tid, n_removed, n_spans,
    kept) for the texts with a match; tid is a text's hash."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = docs.select(F.xxhash64(body).alias("tid"), body.alias("body"))
    copies = written(source.where(F.octet_length("body") >= length).groupBy("tid").agg(F.count("*").alias("n"))
                     .where("n > 1"), "copies")
    index, matches = SuffixIndex(spark, length, gram), None
    for b in range(batches):
        part = source.where(F.pmod(F.xxhash64("tid"), F.lit(batches)) == b).where(F.octet_length("body") >= length)
        found = index.insert(part.select("tid", "body"), report=b > 0 or batches == 1)
        matches = found if matches is None else matches.union(found)
    marks = written(matches.groupBy("tid", "g", "c").agg(F.max("whole").alias("whole"), F.max("some").alias("some"))
                    .groupBy("tid").agg(F.collect_list(F.struct("g", "c", "whole", "some")).alias("marks")), "marks")
    release(spark)
    # Merged at any size, so that the plan does not change as the corpus grows. Texts with copies
    # come once for each copy; one is enough, chosen before their bytes are worked on.
    at_hand = (source.select("tid", "body").join(marks.hint("merge"), "tid")
               .mapInArrow(_once(_locate(length, gram)), _OPEN_DDL))
    located = written(at_hand, "located")
    release(spark)

    asked = located.where("bytes is not null").select("g", "tid", "at", "bytes").dropDuplicates(["g", "tid", "at"])
    sizes = written(asked.groupBy("g").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells")), "cells")
    windows = written(asked.join(sizes, "g").withColumn("salt", F.pmod(F.xxhash64("tid", "at"), F.col("cells")).cast("int"))
                      .select("g", "salt", "cells", "tid", "at", "bytes")
                      .repartition("g", "salt").sortWithinPartitions("g", "salt")
                      .mapInArrow(_compare(length), _WINDOW_DDL), "windows")
    single = windows.where("g is not null")
    twice = written(single.groupBy("g", "w").agg(F.count("*").alias("n")).where("n > 1").select("g", "w"), "twice")
    hits = (windows.where("g is null").select("tid", "at")
            .union(single.join(twice, ["g", "w"]).select("tid", "at"))
            .groupBy("tid").agg(F.collect_set("at").alias("windows")))
    texts = located.where("bytes is null").select("tid", "spans", "text").dropDuplicates(["tid"])
    result = written(texts.join(hits, "tid", "left").select("tid", "spans", "text", "windows")
                     .mapInArrow(_remove(length), "tid long, n_removed long, n_spans long, kept binary"), "kept")
    release(spark)
    return copies, result


def _once(step):
    """``step`` on the rows whose first column this task has not met before."""
    def run(batches):
        seen = set()

        def fresh():
            for batch in batches:
                keep = []
                for tid in batch.column(0).to_pylist():
                    keep.append(tid not in seen)
                    seen.add(tid)
                yield batch.filter(pa.array(keep, pa.bool_()))

        yield from step(fresh())

    return run


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   batches: int = BATCHES) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (binary: the bytes
    left, which may cut a character)."""
    own = Passed(docs, RESULT)
    copies, result = repeated_spans(own.frame, own.name(text), length, gram, batches)
    body = F.coalesce(own.col(text).cast("string"), F.lit(""))
    all_gone = copies.select("tid", F.lit(True).alias("copied"))
    some_gone = result.select("tid", F.col("n_removed").alias("removed"), F.col("n_spans").alias("spans"), F.col("kept").alias("left"))
    verdicts = written(all_gone.join(some_gone, "tid", "full"), "verdicts")
    copied = F.col("copied").isNotNull()
    size = F.octet_length(body).cast("long")
    return (own.frame.select("*", F.xxhash64(body).alias("tid")).join(verdicts, "tid", "left")
            .select(*own.kept, size.alias("n_bytes"),
                    F.when(copied, size).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copied, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(copied, F.lit(b"")).when(F.col("left").isNotNull(), F.col("left"))
                    .otherwise(body.cast("binary")).alias("kept")).toDF(*own.names, *RESULT))
