"""Corpus pipeline: quality classifier, line dedup, near-duplicate removal,
benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
to the shared folder and read again as the next stage's docs. All but the last
return the columns of ``documents``; the last returns token counts and digests
per document. Stages keep every document their decision does not reject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termflow.llm import decontaminate, jaccard_join, line_dedup, quality_classifier
from termflow.llm.common import release, written
from termflow.llm.queries import digest_tokens

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model, column="__score").where(F.col("__score") >= quality_classifier.CUT).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that 10 documents or more hold."""
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                       F.length("kept_text").cast("long").alias("n_chars"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: of smallest id (rows without
    an id last), then of smallest text hash, and of rows equal in both the one
    whose other columns are smallest. Rows without words all stay."""
    heads = jaccard_join.representatives(docs).select(F.col("doc_id").alias("head"), F.col("tid").alias("__tid"), "copies")
    heads = written(heads, "heads").hint("merge")
    of_head = (F.xxhash64(F.col("text").cast("string")) == F.col("__tid")) & F.col("doc_id").eqNullSafe(F.col("head"))
    found = written(docs.select(*COLUMNS).join(heads, of_head).select(*COLUMNS, "__tid", "copies"), "found")
    rest = [c for c in COLUMNS if c != "doc_id"]
    smallest = F.min(F.struct("lang", "source", "n_chars", "text")).alias("row")
    one = found.where("copies > 1").groupBy("doc_id", "__tid").agg(smallest)
    return found.where("copies = 1").select(*COLUMNS).union(one.select("doc_id", *[f"row.{c}" for c in rest]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    judged = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return digest_tokens(docs)


STAGES = [("quality_classifier", keep_good), ("line_dedup", drop_common_lines), ("jaccard_join", keep_one_of_each),
          ("decontaminate", drop_contaminated), ("bpe", encode_tokens)]

#: Boosted trees and BPE have no SQL form; the tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
