"""Word counts and the top-K dictionary (AG1, DI1, DI2, ML1).

Ties are broken by the word (S5: the reference's ``top`` orders by count only,
so tied words come out in no defined order), and a vocabulary smaller than K
gives a smaller dictionary instead of an IndexError (S6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termflow import params
from termflow.functions.text import spread
from termflow.operators import slices
from termflow.session import materialize

def _rank_order():
    return (F.desc("n"), F.asc("word"))


def word_counts(docs: DataFrame) -> DataFrame:
    """AG1: (word, n) over all tokens. HashAggregate partial/final: every map
    task emits each distinct word once, so a word that makes up a third of all
    tokens costs one row per task in the shuffle, not a third of the data.
    A row stands for one occurrence of its word, and for the ``more`` others of
    the same slice of texts."""
    rows = slices.word_rows(spread(docs))
    return rows.groupBy("word").agg((F.count(F.lit(1)) + F.coalesce(F.sum("more"), F.lit(0))).alias("n"))


def count_threshold(counts: DataFrame, k: int) -> int | None:
    """Smallest count ``t`` such that at least ``k`` words have ``n >= t``;
    ``None`` when the vocabulary has fewer than ``k`` words.

    Works on the histogram of counts (one row per distinct count value, far
    smaller than the vocabulary). Fewer than ``k`` words lie strictly above
    the cut, so only the ``k`` largest distinct counts are needed to find it;
    the running sum then runs over at most ``k`` rows."""
    hist = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    top = hist.orderBy(F.desc("n")).limit(k)
    running = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (top.withColumn("at_least", F.sum("words").over(running))
           .where(F.col("at_least") >= k)
           .agg(F.max("n").alias("t"))
           .first())
    return None if row is None or row["t"] is None else int(row["t"])


def rank_dictionary(candidates: DataFrame, k: int) -> DataFrame:
    """DI1+DI2: the ``k`` most frequent words, position 0 = most frequent.
    ``orderBy().limit()`` plans as TakeOrderedAndProject (per-partition top-k,
    no full sort); the row_number runs over at most ``k`` rows."""
    top = candidates.orderBy(*_rank_order()).limit(k)
    rank = Window.orderBy(*_rank_order())
    return top.select(
        (F.row_number().over(rank) - 1).cast("int").alias("pos"),
        F.col("word"),
        F.col("n").cast("long").alias("n"),
    )


def dictionary_from_counts(counts: DataFrame, k: int = params.DICTIONARY_SIZE,
                           prefilter: bool = True, mode: str = "checkpoint") -> DataFrame:
    """DI1+DI2 from word counts that are already materialized (read twice:
    once for the threshold, once for the candidates)."""
    if prefilter:
        threshold = count_threshold(counts, k)
        candidates = counts if threshold is None else counts.where(F.col("n") >= threshold)
        return materialize(rank_dictionary(candidates, k), mode)
    return materialize(rank_dictionary(counts, k), mode)


def build_dictionary(docs: DataFrame, k: int = params.DICTIONARY_SIZE,
                     prefilter: bool = True, mode: str = "checkpoint") -> DataFrame:
    """ML1 (fit): (pos INT, word STRING, n BIGINT) from training documents.

    With ``prefilter`` the counts are first cut at the exact count threshold
    of the k-th word, so the final top-k merge sees about ``k`` rows instead
    of ``k`` rows from every partition. The result is materialized (``mode``)
    because it is read by every later stage and broadcast to every task."""
    counts = word_counts(docs)
    if not prefilter:
        return dictionary_from_counts(counts, k, False, mode)
    counts = materialize(counts, "cache" if mode != "none" else "none")
    dictionary = dictionary_from_counts(counts, k, True, mode)
    if mode != "none":
        counts.unpersist()
    return dictionary
