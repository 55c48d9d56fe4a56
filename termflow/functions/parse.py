"""Parsing of pseudo-XML document lines and labelling (PR1-PR4, PR9, FN4).

A line looks like ``<doc id="ID" url="URL" title="TITLE">BODY</doc>``.
The id is the text between the first ``id="`` and the first ``" url=``; the
body is everything after the first ``">`` with the last six characters cut,
whatever they are (S1). All of it is built-in string expressions, so it runs
inside whole-stage codegen.

A line without a marker, and a null line, is malformed. FAILFAST fails the run
at the first one; ``quarantine_doc_lines`` keeps them apart in a reject table
and counts every line, so that no path drops one unseen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from termflow import params

PARSE_MODES = ("FAILFAST", "DROPMALFORMED")


def _marker_positions(value: Column) -> tuple[Column, Column, Column]:
    return (F.instr(value, params.ID_OPEN), F.instr(value, params.ID_CLOSE),
            F.instr(value, params.BODY_OPEN))


def well_formed(value: Column) -> Column:
    """True when all three markers occur (PR3); a missing one is an error in
    the reference."""
    i_id, i_url, i_body = _marker_positions(value)
    return F.coalesce((i_id > 0) & (i_url > 0) & (i_body > 0), F.lit(False))


def reject_reason(value: Column) -> Column:
    """Why a line is malformed: the first marker it lacks; null if it is not."""
    i_id, i_url, i_body = _marker_positions(value)
    return (F.when(value.isNull(), "null line").when(i_id == 0, "no id").when(i_url == 0, "no url")
            .when(i_body == 0, "no body"))


def _line_counts(value: Column) -> list[Column]:
    """Every line is good, bad or null."""
    ok = well_formed(value)
    return [F.count_if(ok).cast("long").alias("n_ok"),
            F.count_if(~ok & value.isNotNull()).cast("long").alias("n_bad"),
            F.count_if(value.isNull()).cast("long").alias("n_null")]


def doc_id_expr(value: Column) -> Column:
    """PR1: Python slice ``x[x.index('id="')+4 : x.index('" url=')]``.
    A negative length yields the empty string, as the slice does."""
    i_id, i_url, _ = _marker_positions(value)
    start = i_id + F.lit(len(params.ID_OPEN))
    return value.substr(start, F.greatest(i_url - start, F.lit(0)))


def body_expr(value: Column) -> Column:
    """PR2: ``x[x.index('">')+2:][:-6]``."""
    _, _, i_body = _marker_positions(value)
    start = i_body + F.lit(len(params.BODY_OPEN))
    length = F.length(value) - start + F.lit(1) - F.lit(params.BODY_TAIL_CHARS)
    return value.substr(start, F.greatest(length, F.lit(0)))


def parse_doc_lines(lines: DataFrame, mode: str = "FAILFAST",
                    column: str = "value") -> DataFrame:
    """PR1+PR2+PR3(+PR4 for the test corpus): lines -> (doc_id, text).

    FAILFAST raises at the first malformed line (reference behaviour, S2);
    DROPMALFORMED leaves such lines out and reports (n_ok, n_bad, n_null) of
    every query that reads them as the observed metrics ``doc_lines``.
    ``quarantine_doc_lines`` also keeps them."""
    if mode not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    value = F.col(column)
    ok = well_formed(value)
    if mode == "DROPMALFORMED":
        return _parsed(lines.observe("doc_lines", *_line_counts(value)), column)
    failure = F.raise_error(F.concat(F.lit("malformed document line: "),
                                     F.coalesce(F.substring(value, 1, 120), F.lit("(null)"))))
    # The check is a filter predicate, not part of the doc_id expression, so
    # column pruning cannot drop it when a later step never reads doc_id.
    checked = lines.where(F.when(ok, F.lit(True)).otherwise(failure))
    return checked.select(doc_id_expr(value).alias("doc_id"), body_expr(value).alias("text"))


def _parsed(lines: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    return lines.where(well_formed(value)).select(doc_id_expr(value).alias("doc_id"), body_expr(value).alias("text"))


@dataclass
class Quarantine:
    """Parsed documents, the table of lines left out, and the counts of all
    lines (n_ok, n_bad, n_null), which add up to the input."""
    docs: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def quarantine_doc_lines(lines: DataFrame, path: str, column: str = "value", mode: str = "errorifexists") -> Quarantine:
    """PR3/PR4 without a failure: malformed lines are written to ``path`` as
    (reason, value), and counted in the same pass. The counts ride on the write
    (observed metrics of its own tasks), so they hold also when tasks are
    repeated; the text of good lines is not copied."""
    value, seen = F.col(column), Observation("doc_lines")
    (lines.observe(seen, *_line_counts(value)).select(reject_reason(value).alias("reason"), value.alias("value"))
     .where(F.col("reason").isNotNull()).write.mode(mode).parquet(path))
    rejects = lines.sparkSession.read.schema("reason string, value string").parquet(path)
    return Quarantine(_parsed(lines, column), rejects, {name: int(n) for name, n in seen.get.items()})


def malformed_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """PR3 as a report: how many lines parse, how many would fail, and how
    many are null."""
    return lines.agg(*_line_counts(F.col(column)))


def label_expr(doc_id: Column, prefix: str = params.REFERENCE_LABEL_PREFIX) -> Column:
    """PR9/FN4: 1 iff the id starts with ``prefix`` (``docID[:2] == 'AU'``)."""
    return F.when(F.left(doc_id, F.lit(len(prefix))) == F.lit(prefix), 1).otherwise(0)


def label_by_prefix(docs: DataFrame, prefix: str = params.REFERENCE_LABEL_PREFIX) -> DataFrame:
    return docs.select("doc_id", label_expr(F.col("doc_id"), prefix).alias("label"))
