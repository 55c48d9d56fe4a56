"""Sinks and small local sources (IO3, IO4)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

HISTORY_SCHEMA = T.StructType([
    T.StructField("iteration", T.IntegerType(), False),
    T.StructField("cost", T.DoubleType(), False),
    T.StructField("l2", T.DoubleType(), False),
])


def history_frame(spark: SparkSession, rows: list[tuple[int, float, float]]) -> DataFrame:
    """IO3: the gradient-descent history (one row per applied iteration,
    bounded by the iteration count) as a typed DataFrame."""
    return spark.createDataFrame([(int(i), float(c), float(l)) for i, c, l in rows],
                                 HISTORY_SCHEMA)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """IO4: write a small result as one part file; fails if ``path`` exists,
    like ``saveAsTextFile``. Only for results whose size is bounded by a
    parameter (history, reports), never for corpus-sized data."""
    writer = df.coalesce(1).write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt in ("json", "parquet"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_report(df: DataFrame, path: str) -> DataFrame:
    """IO5: a report without a bound on its rows, written by the executors as
    Parquet to a new folder and read back; the driver never holds it."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pages(report: DataFrame, rows: int = 20) -> Iterator[list[Row]]:
    """The rows of a written report, ``rows`` at a time; the driver holds one
    file split, and one page, at once."""
    page: list[Row] = []
    for row in report.toLocalIterator():
        page.append(row)
        if len(page) == rows:
            yield page
            page = []
    if page:
        yield page


def read_single_file(spark: SparkSession, path: str, schema: T.StructType,
                     fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "true").csv(path)
    return spark.read.schema(schema).format(fmt).load(path)
