import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termflow.functions import parse

LINES = [
    '<doc id="AU123" url="http://x/1" title="A case">Body text here</doc>',
    '<doc id="EN7" url="u" title="t">short</doc>',
    '<doc id="X" url="u" title="t">ab',            # body shorter than the 6-char tail
    '<doc id="Y" url="u" title="t">">inner">x</doc>',  # first "> wins
]


def py_parse(x):
    """The line rule, stated apart from the code under test: the id ends where
    the url attribute begins; of what follows the opening tag all but six
    characters are the body."""
    found = re.fullmatch(r'.*?id="(?P<id>.*?)" url=.*', x, re.S)
    _, _, rest = x.partition('">')
    return found["id"], rest[:max(len(rest) - 6, 0)]


def test_parse_matches_python_slicing(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    got = [tuple(r) for r in parse.parse_doc_lines(lines).collect()]
    assert got == [py_parse(v) for v in LINES]


def test_failfast_raises_on_missing_marker(spark):
    lines = spark.createDataFrame([(LINES[0],), ("<doc no markers>",)], "value string")
    with pytest.raises(PySparkException):
        parse.parse_doc_lines(lines, "FAILFAST").collect()


def test_dropmalformed_and_counts(spark):
    bad = ['<doc id = "1" url="u">x</doc>', "plain", '<doc id="1" title="t">x</doc>']
    lines = spark.createDataFrame([(v,) for v in LINES + bad], "value string")
    assert parse.parse_doc_lines(lines, "DROPMALFORMED").count() == len(LINES)
    row = parse.malformed_counts(lines).first()
    assert (row.n_ok, row.n_bad) == (len(LINES), len(bad))


def test_label_by_prefix_default_au(spark):
    docs = spark.createDataFrame([("AU1", ""), ("AX1", ""), ("A", ""), ("au2", "")], "doc_id string, text string")
    got = {r.doc_id: r.label for r in parse.label_by_prefix(docs).collect()}
    assert got == {"AU1": 1, "AX1": 0, "A": 0, "au2": 0}


from hypothesis import given, settings
from hypothesis import strategies as st

_piece = st.text(alphabet=st.sampled_from(list('ab "=<>/éid url')), max_size=12)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(_piece, _piece, _piece, _piece), min_size=1, max_size=6))
def test_parse_property_against_python(spark, parts):
    """Random ids, urls and bodies (including quotes, '>' and marker
    fragments): the Spark expressions cut exactly where Python slicing does."""
    lines = [f'<doc id="{a}" url="{b}" title="{c}">{d}</doc>' for a, b, c, d in parts]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in parse.parse_doc_lines(df, "DROPMALFORMED").collect()]
    assert got == [py_parse(v) for v in lines]


def test_failfast_raises_even_when_doc_id_is_not_read(spark):
    lines = spark.createDataFrame([(LINES[0],), ("<doc no markers>",)], "value string")
    with pytest.raises(PySparkException):
        parse.parse_doc_lines(lines, "FAILFAST").count()
    with pytest.raises(PySparkException):
        parse.parse_doc_lines(lines, "FAILFAST").select("text").collect()


BAD = {'<doc id = "1" url="u">x</doc>': "no id", "plain": "no id", "": "no id", '<doc id="1" title="t">x</doc>': "no url",
       '<doc id="1" url="u" x': "no body", None: "null line"}


def test_quarantine_keeps_and_counts_every_line(spark, tmp_path):
    lines = spark.createDataFrame([(v,) for v in LINES + [*BAD, None, "plain"]], "value string").repartition(3)
    kept = parse.quarantine_doc_lines(lines, str(tmp_path / "rejects"))
    assert kept.counts == {"n_ok": len(LINES), "n_bad": len(BAD), "n_null": 2}
    assert sum(kept.counts.values()) == lines.count()
    assert sorted(tuple(r) for r in kept.docs.collect()) == sorted(py_parse(v) for v in LINES)
    rejects = [(r.value, r.reason) for r in kept.rejects.collect()]
    assert sorted(rejects, key=str) == sorted([*BAD.items(), (None, "null line"), ("plain", "no id")], key=str)
    row = parse.malformed_counts(lines).first()
    assert row.asDict() == kept.counts


@pytest.mark.parametrize("lines,counts", [([], (0, 0, 0)), (LINES, (4, 0, 0)), ([None], (0, 0, 1)), (["x"], (0, 1, 0))])
def test_quarantine_of_one_kind_of_lines(spark, tmp_path, lines, counts):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    kept = parse.quarantine_doc_lines(df, str(tmp_path / "rejects"))
    assert tuple(kept.counts[n] for n in ("n_ok", "n_bad", "n_null")) == counts
    assert kept.docs.count() == counts[0] and kept.rejects.count() == counts[1] + counts[2]


def test_failfast_names_a_null_line_and_dropping_reports_its_counts(spark):
    lines = spark.createDataFrame([(LINES[0],), (None,), ("x",)], "value string")
    with pytest.raises(PySparkException, match=r"malformed document line: (\(null\)|x)"):
        parse.parse_doc_lines(lines).collect()
    with pytest.raises(PySparkException, match=r"\(null\)"):
        parse.parse_doc_lines(lines.where("value is null")).collect()
    docs = parse.parse_doc_lines(lines, "DROPMALFORMED")
    assert docs.count() == 1
    assert "CollectMetrics doc_lines" in docs._jdf.queryExecution().optimizedPlan().toString()


def test_batch_run_reports_the_lines_it_leaves_out(spark, tmp_path):
    from termflow.plans.classify import Preset, line_report, pipeline_from_lines
    for side, n in (("train", 6), ("test", 3)):
        good = [f'<doc id="{"AU" if i % 2 else "EN"}{i}" url="u" title="t">alpha w{i}</doc>' for i in range(n)]
        spark.createDataFrame([(v,) for v in [*good, "no marker", "", '<doc id="1" url="u" x']], "value string").write.text(
            str(tmp_path / side))
    p = pipeline_from_lines(spark, str(tmp_path / "train"), str(tmp_path / "test"), Preset(k=10), "DROPMALFORMED",
                            str(tmp_path / "rejects"))
    assert [tuple(r) for r in line_report(spark, p.corpus).orderBy("side").collect()] == [("test", 6, 3, 3, 0), ("train", 9, 6, 3, 0)]
    assert spark.read.parquet(str(tmp_path / "rejects" / "train")).count() == 3
    assert p.counts("train")[1] == 6


def test_rows_with_missing_parts_have_a_line(spark, tmp_path):
    from termflow.sources.corpus import documents_as_lines
    rows = [(1, "t", "en", "s"), (2, None, "en", "s"), (3, "t", None, None), (None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    docs = parse.parse_doc_lines(documents_as_lines(spark, str(tmp_path)).select("value"))
    assert sorted(tuple(r) for r in docs.collect()) == [("", ""), ("", "t"), ("EN1", "t"), ("EN2", "")]
