"""Frequent words from a mergeable sketch (AG1, DI1): the top-K dictionary of a
corpus whose vocabulary is too large to shuffle.

Every task keeps at most a few counters (Misra-Gries): when it holds twice as
many, it subtracts one count from all of them and drops those used up, so a
counter is short of its word's count by at most what was subtracted. Counters
of all tasks add up, and so do the shortfalls: with the sum E of the latter, a
word without a counter occurs at most E times, and one with the counter c
between c and c + E times. If T is the k-th largest counter and T > E, the k
most frequent words, ties included, are among those with c + E >= T. A second
pass counts these exactly; without any shortfall the counters are exact as
they are. If T <= E the sketch says nothing, and all words are counted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow import params
from termflow.functions.text import explode_tokens
from termflow.operators.dictionary import dictionary_from_counts, word_counts
from termflow.operators.tf import is_small
from termflow.session import materialize

#: Counters a task keeps, as a multiple of the dictionary size.
COUNTERS_PER_WORD = 8


def _sketch(counters: int):
    def cut(held: dict[str, int]) -> int:
        """Subtract the count of the first word beyond ``counters`` from all."""
        spare = sorted(held.values(), reverse=True)[counters]
        for word in [w for w, n in held.items() if n <= spare]:
            del held[word]
        for word in held:
            held[word] -= spare
        return spare

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        short = 0
        for batch in batches:
            seen = pc.value_counts(batch.column("word"))
            for word, n in zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist()):
                held[word] = held.get(word, 0) + n
            if len(held) > 2 * counters:
                short += cut(held)
        if len(held) > counters:
            short += cut(held)
        yield pa.RecordBatch.from_arrays([pa.array([*held, None], pa.string()), pa.array([*held.values(), short], pa.int64())],
                                         ["word", "n"])
    return run


@dataclass
class Sketch:
    """(word, n) counters of the whole corpus, at most ``short`` below the
    counts, and the rows that tasks sent."""
    counters: DataFrame
    short: int
    sent: int


def sketch_words(docs: DataFrame, counters: int, mode: str = "checkpoint") -> Sketch:
    """One pass over ``docs`` with at most ``counters`` counters a task."""
    rows = explode_tokens(docs).select("word").mapInArrow(_sketch(counters), "word string, n long")
    kept = materialize(rows, mode)
    ends = kept.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("short")).first()
    total = materialize(kept.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), mode)
    return Sketch(total, int(ends["short"]), int(ends["rows"]))


def candidates(found: Sketch, k: int) -> DataFrame | None:
    """The words that can be among the ``k`` most frequent; None when the
    sketch cannot tell."""
    last = found.counters.orderBy(F.desc("n")).limit(k).agg(F.min("n").alias("t"), F.count(F.lit(1)).alias("words")).first()
    if last["words"] < k or last["t"] <= found.short:
        return None
    return found.counters.where(F.col("n") + found.short >= last["t"]).select("word")


def frequent_dictionary(docs: DataFrame, k: int = params.DICTIONARY_SIZE, counters: int | None = None,
                        mode: str = "checkpoint") -> DataFrame:
    """ML1 (fit): the dictionary that ``build_dictionary`` gives, with at most
    ``counters`` (default ``COUNTERS_PER_WORD * k``) words a task shuffled in
    place of its whole vocabulary."""
    found = sketch_words(docs, counters or COUNTERS_PER_WORD * k, mode)
    if not found.short:
        return dictionary_from_counts(found.counters, k, mode=mode)
    words = candidates(found, k)
    if words is None:
        return dictionary_from_counts(materialize(word_counts(docs), mode), k, mode=mode)
    words = materialize(words, mode)
    hint = F.broadcast(words) if is_small(words, words.count(), "word") else words
    counts = explode_tokens(docs).join(hint, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return dictionary_from_counts(materialize(counts, mode), k, mode=mode)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need pyarrow, not this package
