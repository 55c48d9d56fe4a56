"""Tokens counted by array operations, a slice of documents at a time (FN1-FN3,
AG1-AG3).

A row for every token costs far more than the token itself. Here a slice of
about ``SLICE_BYTES`` of text is cut into words by one pass over its bytes: a
table turns letters into lower case and all else, every byte of a non-ASCII
character included, into a separator, which is the rule of ``functions.text``.
Words are numbered by Arrow's hash table and counted by sorting their numbers.
What leaves the kernel is a row for every distinct word of a slice; the
dictionary stays a broadcast join of such rows, and never is in a worker.

A worker holds a batch of its task's text and the arrays of one slice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text of a slice. Its arrays take about twenty times as much.
SLICE_BYTES = 1 << 20
POSTINGS = "slice int, word string, pairs binary"
DOCUMENTS = "doc_id string, pos array<int>, n array<bigint>, tf array<double>"

LOWER = np.zeros(256, np.uint8)
for _upper, _lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1)):
    LOWER[[_upper, _lower]] = _lower


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): document i is ``bytes[bounds[i]:bounds[i + 1]]``."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words in order, the document of each) of the documents between
    ``bounds``. A word ends with its document."""
    start = bounds - bounds[0]
    low = LOWER[data[bounds[0]:bounds[-1]]]
    letter = low != 0
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begin = start[:-1][start[:-1] < len(low)]
    first[begin] = letter[begin]
    kept, at = low[letter], np.flatnonzero(first[letter])
    owner = np.repeat(np.arange(len(start) - 1), np.diff(np.searchsorted(np.flatnonzero(first), start)))
    ends = np.append(at, len(kept)).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(kept)), owner


def _pieces(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``bounds`` with documents longer than a slice cut between words."""
    cuts = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        while hi - lo > SLICE_BYTES:
            lo += SLICE_BYTES
            while lo < hi and LOWER[data[lo]]:
                lo += 1
            cuts.append(lo)
    return np.sort(np.append(bounds, np.array(cuts, np.int64)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            data, bounds = _texts(batch.column("text"))
            bounds = _pieces(data, bounds)
            for lo, hi in _slices(bounds):
                seen = words(data, bounds[lo:hi + 1])[0].dictionary_encode()
                n = np.bincount(seen.indices.to_numpy(), minlength=len(seen.dictionary))
                more = pa.array(n.astype(np.int64) - 1, mask=n == 1)
                yield pa.RecordBatch.from_arrays([seen.dictionary, more], ["word", "more"])


def word_rows(docs: DataFrame) -> DataFrame:
    """(word, more): the distinct words of every slice, and how many more of
    each there are in it, null for none. A text of any length is counted in
    pieces of a slice."""
    return docs.select("text").where(F.col("text").isNotNull()).mapInArrow(_count, "word string, more bigint")


def _packed(ids: pa.Array) -> bytes:
    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], ["doc_id"])
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every slice one row without a word, which holds its ids, then one for
    each word, whose ``pairs`` are 32-bit (document of the slice, count)."""
    number, names = 0, ["slice", "word", "pairs"]
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("doc_id").cast(pa.string())
        data, bounds = _texts(batch.column("text"))
        for lo, hi in _slices(bounds):
            head = pa.array([_packed(ids.slice(lo, hi - lo))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.nulls(1, pa.string()), head], names)
            found, owner = words(data, bounds[lo:hi + 1])
            seen = found.dictionary_encode()
            key, n = np.unique(seen.indices.to_numpy().astype(np.int64) * (hi - lo) + owner, return_counts=True)
            word, doc = np.divmod(key, hi - lo)
            pairs = np.stack((doc, n), axis=1).astype(np.int32)
            size = len(seen.dictionary)
            ends = (8 * np.searchsorted(word, np.arange(size + 1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, number, np.int32)), seen.dictionary,
                pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(ends), pa.py_buffer(pairs)])], names)
            number += 1


def _rows(ids: pa.Array, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The documents of one slice, those without a word of the dictionary left out."""
    pos, pairs = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    doc, n = pairs[:, 0], pairs[:, 1].astype(np.int64)
    order = np.argsort((doc.astype(np.int64) << 32) | pos)
    doc, pos, n = doc[order], pos[order], n[order]
    size = np.bincount(doc, minlength=len(ids))
    has = np.flatnonzero(size)
    total = np.bincount(doc, weights=n, minlength=len(ids))  # whole numbers far below 2^53
    ends = pa.array(np.concatenate(([0], np.cumsum(size[has]))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (pos.astype(np.int32), n, n / total[doc])]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(has)), *lists], ["doc_id", "pos", "n", "tf"])


def _binary(column: pa.Array) -> tuple[bytes, np.ndarray]:
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return data.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).to_pybytes(), np.diff(bounds)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of a task, whose rows come in order, turned back into a row
    for each document."""
    number, ids, parts = -1, None, []
    for batch in batches:
        slices, known, pairs = (batch.column(c) for c in ("slice", "pos", "pairs"))
        slices = slices.to_numpy()
        heads = np.flatnonzero(batch.column("word").is_null().to_numpy(zero_copy_only=False)).tolist()
        for lo, hi in zip([-1, *heads], [*heads, batch.num_rows]):
            if lo >= 0:
                if parts:
                    yield _rows(ids, parts)
                number, parts = int(slices[lo]), []
                ids = pa.ipc.open_stream(pairs[lo].as_buffer()).read_all().column(0).combine_chunks()
            if lo + 1 < hi:
                if not (slices[lo + 1:hi] == number).all():
                    raise RuntimeError("rows of a slice are out of order")
                data, size = _binary(pairs.slice(lo + 1, hi - lo - 1))
                pos = known.slice(lo + 1, hi - lo - 1).to_numpy().astype(np.int64)
                parts.append((np.repeat(pos, size // 8), np.frombuffer(data, np.int32).reshape(-1, 2)))
    if parts:
        yield _rows(ids, parts)


def document_counts(texts: DataFrame, lookup: DataFrame) -> DataFrame:
    """(doc_id, pos[], n[], tf[]) of ``texts`` (doc_id, text), one row each,
    through a broadcast dictionary (word, pos). Both kernels and the join run
    in one stage, and the join keeps the order of its rows."""
    found = texts.mapInArrow(_postings, POSTINGS).join(F.broadcast(lookup), "word", "left")
    found = found.where(F.col("pos").isNotNull() | F.col("word").isNull())
    return found.select("slice", "word", "pos", "pairs").mapInArrow(_documents, DOCUMENTS)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy, not this package
