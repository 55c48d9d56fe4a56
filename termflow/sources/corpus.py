"""Corpus sources (IO1, IO2).

The reference reads text files with one pseudo-XML document per line. Here
the same corpus can come from text files (``read_doc_lines``) or from a
parquet table of documents (``documents_corpus``); ``documents_as_lines``
renders a table in the line format so that both paths can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow import params


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_key(lang: Column, doc_id: Column) -> Column:
    """String document id: upper-cased language followed by the numeric id,
    e.g. ``EN42``; the language prefix plays the role of the reference's
    ``AU`` prefix for labelling."""
    return F.concat(F.upper(lang), doc_id.cast("string"))


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id STRING, src_id BIGINT, text STRING) from ``documents``.
    Only the three columns used are read (column pruning at the scan), in the
    splits of ``spark.sql.files.maxPartitionBytes``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.select(
        document_key(F.col("lang"), F.col("doc_id")).alias("doc_id"),
        F.col("doc_id").alias("src_id"),
        F.col("text"),
    )


def one_line(text: Column) -> Column:
    """Line breaks inside a body become spaces so a document stays one line;
    tokens are unchanged because every non-letter is a separator anyway."""
    return F.regexp_replace(text, r"[\r\n]", " ")


def documents_as_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_id, value) with value = ``<doc id=".." url=".." title="..">body</doc>``.
    A row without an id has an empty one in its line, as a key needs both parts;
    a missing source or text is empty, so every row has a line."""
    docs = read_table(spark, sf_dir, "documents")
    src = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.coalesce(document_key(F.col("lang"), F.col("doc_id")), F.lit(""))
    source = F.coalesce(F.col("source"), F.lit(""))
    value = F.concat(
        F.lit('<doc id="'), key,
        F.lit('" url="doc://'), source, F.lit("/"), src,
        F.lit('" title="'), source, F.lit(" "), src,
        F.lit('">'), one_line(F.coalesce(F.col("text"), F.lit(""))), F.lit(params.DOC_CLOSE),
    )
    return docs.select(F.col("doc_id").alias("src_id"), value.alias("value"))


def read_doc_lines(spark: SparkSession, path: str) -> DataFrame:
    """IO1/IO2: one row per line, column ``value``. Files are split by size,
    unlike the reference's single-partition ``textFile(path, 1)``; how finely
    is the session's ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.text(path)


def write_doc_lines(lines: DataFrame, path: str) -> None:
    """Write a ``value`` column as plain text files; fails if ``path`` exists."""
    lines.select("value").write.mode("errorifexists").text(path)


def on_test_side(test_every: int = 5) -> Column:
    """Whether a row with ``src_id`` is a test row; without an id it is not."""
    return F.coalesce((F.col("src_id") % F.lit(test_every)) == 0, F.lit(False))


def split_corpus(docs: DataFrame, test_every: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train / test split of one table: a document goes to the test side iff
    ``src_id % test_every == 0``; a row without an id is a training row. Every
    row lands on exactly one side; the reference instead receives two separate
    corpora."""
    is_test = on_test_side(test_every)
    train = docs.where(~is_test).select("doc_id", "text")
    test = docs.where(is_test).select("doc_id", "text")
    return train, test
