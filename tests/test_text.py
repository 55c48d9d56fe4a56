import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termflow.functions import text

from conftest import docs_frame

NON_LETTER = re.compile("[^a-zA-Z]")


def py_words(t):
    return NON_LETTER.sub(" ", t).lower().split()


TRICKY = [
    "Hello, World! 123abc DEF",
    "café naïve École",          # accents split words
    "Kelvin İstanbul",                # Kelvin sign and dotted I are not letters here
    "",
    "   ...   ",
    "a",
    "x1y2z3",
    "tab\tnew\nline\r\nend",
    "\U0001F600emoji\U0001F600",
]


def test_tokens_match_python_rule(spark):
    df = docs_frame(spark, [(str(i), t) for i, t in enumerate(TRICKY)])
    got = {r.doc_id: list(r.words) for r in text.tokenize(df).collect()}
    assert got == {str(i): py_words(t) for i, t in enumerate(TRICKY)}
    exploded = {}
    for r in text.explode_tokens(df).collect():
        exploded.setdefault(r.doc_id, []).append(r.word)
    assert {k: v for k, v in exploded.items()} == {str(i): py_words(t) for i, t in enumerate(TRICKY) if py_words(t)}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_tokens_property(spark, texts):
    df = docs_frame(spark, [(str(i), t) for i, t in enumerate(texts)])
    got = {r.doc_id: list(r.words) for r in text.tokenize(df).collect()}
    assert got == {str(i): py_words(t) for i, t in enumerate(texts)}


def test_token_summary_and_pairs(spark):
    df = docs_frame(spark, [("d1", "b a b"), ("d2", "!!")])
    s = {r.doc_id: (r.n_tokens, r.first_word, r.last_word) for r in text.token_summary(df).collect()}
    assert s == {"d1": (3, "b", "b"), "d2": (0, None, None)}
    pairs = {(r.doc_id, r.word): r.n for r in text.token_pairs(df).collect()}
    assert pairs == {("d1", "a"): 1, ("d1", "b"): 2}


def test_spread_bounds_the_text_of_a_task(spark, monkeypatch):
    """All documents in one partition, as one row group is read: they are dealt
    by size, whole and with their nulls and repeats."""
    rows = [(f"D{k % 50}", None if k == 3 else f"word{k} " * 20) for k in range(400)] + [("D1", "same same")] * 3
    docs = spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)
    monkeypatch.setattr(text.params, "TASK_TEXT_BYTES", 2000)
    dealt = text.spread(docs)
    size = dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0]
    assert size <= 4 * 2000
    assert sorted(map(str, dealt.collect())) == sorted(map(str, docs.collect()))
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "xxhash64" in plan(text.token_pairs(docs))
