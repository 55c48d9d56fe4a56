"""Line deduplication across documents: lines are exploded with their
position, normalised and hashed; a hash found in too many documents loses all
its lines, and the other lines are put together again by position.

Defined results: a null or empty text is one empty line and stays empty. Every
row is one document, also when rows repeat or share an id. A line whose key
has fewer than ``min_chars`` code points is never dropped. Other columns pass
through; input columns named like a result column are replaced. An empty table
gives an empty result.

Scale: lines travel as (text hash, line hash, positions). Copies of a text
collapse in the first, partially aggregated shuffle, and counts per line hash
are partially aggregated too, so a line or a text that makes up a third of the
corpus costs a row per task. Texts are shuffled once, for the final join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Passed, written

#: Characters stripped at both ends of a line: [\x20\x09-\x0D].
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("kept_text", "n_lines", "n_dropped")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def line_occurrences(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """(tid, kh, at, docs): of each distinct text (its hash), each line hash,
    the positions that have it, and the number of documents with that text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = docs.select(_hash(body).alias("tid"), F.posexplode(split_lines(body)).alias("pos", "line"))
    keys = lines.select("tid", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return (keys.select("tid", _hash(F.col("key")).alias("kh"), "pos")
            .groupBy("tid", "kh").agg(F.collect_set("pos").alias("at"), F.count("*").alias("n"))
            .select("tid", "kh", "at", (F.col("n") / F.size("at")).cast("long").alias("docs")))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """``docs`` with kept_text, n_lines (before) and n_dropped."""
    own = Passed(docs, RESULT)
    occurrences = written(line_occurrences(own.frame, own.name(text), min_chars), "line-occurrences")
    # Written, so that the joins below are between plain exchanges, which adaptive execution may split.
    common = written(occurrences.groupBy("kh").agg(F.sum("docs").alias("docs"))
                     .where(F.col("docs") >= min_docs).select("kh"), "common-lines")
    drops = written(occurrences.join(common, "kh").groupBy("tid")
                    .agg(F.flatten(F.collect_list("at")).alias("gone")), "drops")
    body = F.coalesce(own.col(text), F.lit(""))
    wanted = own.kept if own.name(text) in own.kept else [*own.kept, own.name(text)]
    joined = own.frame.select(*wanted, _hash(body).alias("tid")).join(drops, "tid", "left")
    lines = split_lines(own.col(text))
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")),
        lambda i: F.get(lines, i)), "\n")
    return joined.select(
        *own.kept, F.when(F.col("gone").isNull(), body).otherwise(kept).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")).toDF(*own.names, *RESULT)
