"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. A
test item is the set of its windows of ``span`` (10) words; a shorter item is
one window. Of every ``t - k + 1`` neighbouring k-word grams of a text, the
one of smallest hash (leftmost on ties) is kept as fingerprint, so that any
two texts that share ``t`` words in a row share a fingerprint (t is the
shortest window, 10 unless there are shorter items; k is 5 or t if that is
smaller). Training and test fingerprints are joined on the hash; every hit is
extended to the windows around it, and windows count only when all their words
are equal. Hash collisions can only add candidates.

Defined results: null and empty texts have no words, hits or items. Results
depend on the text alone, so repeated rows and ids give equal rows. An item
without words has no windows; an item without an id makes hits but is not
listed. With an empty benchmark nothing is hit. Extra columns pass through;
those named like a result column, in any case, are replaced.

Scale: a text travels only as its md5. The test side is broadcast when its
measured bytes are at most ``BROADCAST_BYTES``; else both joins shuffle and the
few documents hit are read again for their words. Copies of a document
collapse with the first shuffle of hits, and the windows of all items that are
equal are one row with the list of their items, so a passage that a third of
the corpus quotes makes a row per distinct text and word position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Passed, written

#: Fixed by the query's contract: words of a window.
SPAN = 10
#: Words of a fingerprint's gram.
GRAM = 5
#: Fingerprints, or windows with the names of their items, are broadcast up to
#: this many measured bytes.
BROADCAST_BYTES = 32 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_words(text: Column) -> Column:
    """Array of the words of a text."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATORS), "")


def count_words(text: Column) -> Column:
    """Number of words; folding A-Z does not change it."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), ""))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not at each use in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fingerprints(words: Column, t: int, k: int) -> Column:
    """Distinct winnowed grams of a word array, each a long: hash in the upper
    32 bits, word position in the lower. Null when there are under t words."""
    def hashes(w):
        return F.transform(w, lambda x: F.xxhash64(x))

    def grams(h):
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - k),
            lambda i: F.shiftleft(F.xxhash64(*[F.get(h, i + j) for j in range(k)]), 32).bitwiseOR(i.cast("long")))

    def lowest(g):
        if t == k:
            return g
        return F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(g) - (t - k + 1)),
            lambda i: F.least(*[F.get(g, i + j) for j in range(t - k + 1)])))

    return _let(words, lambda w: F.when(F.size(w) >= t, _let(_let(hashes(w), grams), lowest)))


def _winnowed(frame: DataFrame, t: int, k: int) -> DataFrame:
    """``frame`` (with a column ``words``) with a column ``prints``."""
    return frame.withColumn("prints", fingerprints(F.col("words"), t, k))


def _split_print(frame: DataFrame) -> DataFrame:
    return (frame.withColumn("fp", F.shiftright("print", 32).cast("int"))
            .withColumn("pos", F.col("print").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).drop("print"))


def _small(frame: DataFrame, size: Column) -> DataFrame:
    """A broadcast hint once the measured ``size`` of all rows is within the bound."""
    return F.broadcast(frame) if (frame.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else frame


def window_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM
                ) -> DataFrame:
    """(tid, start, size, items): the item windows that occur in each distinct
    text (named by its md5), at which word, and in which items."""
    items = written(benchmark.select("item_id", text_words(F.col("text").cast("string")).alias("words"))
                    .where(F.size("words") > 0), "items")
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(span))).distinct().collect())
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.unhex(F.md5(body)).alias("tid"), body.alias("body"))
    if not sizes:
        return texts.limit(0).select("tid", F.lit(0).alias("start"), F.lit(0).alias("size"),
                                     F.array(F.lit("")).alias("items"))
    t = sizes[0]
    k = min(gram, t)
    item_windows = items.select(
        "item_id", F.least(F.size("words"), F.lit(span)).alias("size"), "words",
        F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - span + 1, F.lit(1)))).alias("at"))
    windows = written(
        item_windows.select(F.array_join(F.slice("words", "at", F.col("size")), " ").alias("window"), "item_id")
        .groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")), "item-windows")
    known = written(_split_print(_winnowed(items, t, k).select(F.explode("prints").alias("print")))
                    .select("fp").distinct(), "item-prints")

    worded = _winnowed(texts.select("tid", text_words(F.col("body")).alias("words")), t, k)
    # The words from the start of the first window around a hit to the end of the last.
    low = F.greatest(F.col("pos") - (span - k), F.lit(0))
    around = F.slice("words", low + 1, F.col("pos") + span - low)
    near = _small(known, F.lit(16))
    if near is not known:
        hits = (_split_print(worded.select("tid", "words", F.explode("prints").alias("print")))
                .join(near, "fp").select("tid", "pos", low.alias("low"), around.alias("near"))
                .groupBy("tid", "pos").agg(F.first("low").alias("low"), F.first("near").alias("near")))
    else:
        found = (_split_print(worded.select("tid", F.explode("prints").alias("print"))).join(known, "fp", "left_semi")
                 .groupBy("tid").agg(F.collect_set("pos").alias("at")))
        again = (texts.join(found, "tid").groupBy("tid").agg(F.min(F.struct("body", "at")).alias("r"))
                 .select("tid", text_words(F.col("r.body")).alias("words"), F.explode("r.at").alias("pos")))
        hits = again.select("tid", "pos", low.alias("low"), around.alias("near"))
    spread = hits.select("tid", "pos", "low", "near", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"))
    first = F.greatest(F.col("pos") - F.greatest(F.col("size") - k, F.lit(0)), F.col("low"))
    last = F.least(F.col("pos"), F.col("low") + F.size("near") - F.col("size"))
    spread = (spread.withColumn("first", first).withColumn("last", last).where("last >= first")
              .select("tid", "low", "near", "size", F.explode(F.sequence("first", "last")).alias("start")))
    candidates = spread.select("tid", "start", "size", F.array_join(
        F.slice("near", F.col("start") - F.col("low") + 1, F.col("size")), " ").alias("window"))
    held = F.octet_length("window") + F.aggregate("items", F.lit(32), lambda n, x: n + F.octet_length(x) + 16)
    return (candidates.join(_small(windows, held.cast("long")), "window")
            .groupBy("tid", "start", "size").agg(F.first("items").alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit (words within an occurring window), n_items
    (items with one), items_sha256 and contaminated."""
    own = Passed(docs, RESULT)
    body = F.coalesce(own.col(text), F.lit(""))
    hits = written(window_hits(own.frame, benchmark, own.name(text)), "window-hits")
    covered = (hits.select("tid", F.explode(F.expr("sequence(start, start + size - 1)")).alias("at")).distinct()
               .groupBy("tid").agg(F.count("*").alias("hit")))
    listed = (hits.select("tid", F.explode("items").alias("item")).distinct()
              .groupBy("tid").agg(F.sort_array(F.collect_list("item")).alias("items")))
    verdicts = written(covered.join(listed, "tid", "left"), "verdicts")
    keyed = own.frame.select(*own.kept, F.unhex(F.md5(body)).alias("tid"), count_words(body).cast("long").alias("n_words"))
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return keyed.join(verdicts, "tid", "left").select(
        *own.kept, "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated")).toDF(*own.names, *RESULT)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated). The text
    is dropped before the join, so only ids and counts are shuffled."""
    return decontaminate(docs.select("doc_id", "text"), benchmark).drop("text")
