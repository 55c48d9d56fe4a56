"""Extra columns of any name pass through every operator on documents."""
import pytest
from pyspark.sql import functions as F

from llm_support import documents  # noqa: F401
from termflow.llm import (bpe, common, decontaminate, importance, line_dedup, merkle, quality_classifier, quality_rules, secret_scan,
                          suffix_dedup, url_filter)
from termflow.llm.queries import vocabulary

EXTRA = ("__drop", "__tid", "__hit", "__items", "__key", "__host", "__node", "__copied", "tid", "gone", "hit", "items", "node",
         "key", "p0", "p1", "c0", "n0", "source_", "a.b", "KEPT", "Found", "N_Lines", "HOST", "Kept_Text", "TEXT")
ROWS = [(1, "one two three\nfour"), (2, None), (3, "one two three\nfour"), (None, "password = abcdef1")]


def operators(spark):
    bench = spark.createDataFrame([("i", "one two three")], "item_id string, text string")
    rules = {"w": quality_rules.np.eye(len(quality_rules.FEATURES), 2), "t": quality_rules.np.zeros((2, 2))}
    return {
        "line_dedup": (lambda d: line_dedup.drop_repeated_lines(d, 2), line_dedup.RESULT),
        "decontaminate": (lambda d: decontaminate.decontaminate(d, bench), decontaminate.RESULT),
        "suffix_dedup": (lambda d: suffix_dedup.remove_repeats(d, length=8, gram=4), suffix_dedup.RESULT),
        "scan": (secret_scan.scan, ("found",)),
        "judge": (lambda d: quality_rules.judge(d, rules), tuple(n for n, _ in quality_rules._ADDED)),
        "encode": (lambda d: bpe.encode(d, vocabulary()), ("n_tokens", "ids")),
    }


@pytest.mark.parametrize("name", ["line_dedup", "decontaminate", "suffix_dedup", "scan", "judge", "encode"])
def test_extra_columns_of_any_name(spark, documents, tmp_path, name):  # noqa: F811
    run, result = operators(spark)[name]
    plain = documents(ROWS).select("doc_id", "text")
    names = [n for n in EXTRA if n not in ("a.b",)]
    wide = plain.select("*", *[F.lit("x").alias(n) for n in names])
    got = run(wide)
    low = [c.lower() for c in got.columns]
    assert all(low.count(r.lower()) == 1 for r in result)  # replaced in any case
    assert [c for c in got.columns if c in names] == [n for n in names if n.lower() not in {r.lower() for r in result}]
    want = run(plain).toDF(*[f"r{k}" for k in range(len(result) + 2)]).collect()
    at = [0, 1, *range(len(got.columns) - len(result), len(got.columns))]
    assert sorted(map(str, ([r[k] for k in at] for r in got.collect()))) == sorted(map(str, map(list, want)))
    one_case = got.select(*[c for k, c in enumerate(got.columns) if low.index(c.lower()) == k and low.count(c.lower()) == 1])
    one_case.write.parquet(str(tmp_path / "out"))


def test_url_filter_passes_extra_columns(spark):
    pages = spark.createDataFrame([(1, "http://Example.com/en/x", "<p>"), (2, None, None)], "page_id long, url string, html string")
    wide = pages.select("*", *[F.lit("x").alias(n) for n in ("__key", "__host", "__node", "node", "key", "HOST", "Rule")])
    got = url_filter.filter_urls(wide)
    assert got.columns == ["page_id", "url", "html", "__key", "__host", "__node", "node", "key", "host", "path", "rule", "verdict"]
    assert {(r.page_id, r.host, r.verdict) for r in got.collect()} == {(1, "example.com", "block"), (2, "", "allow")}


def test_pick_takes_the_exact_name_first(spark):
    df = spark.range(1).select(F.lit(1).alias("TEXT"), F.lit(2).alias("text"), F.lit(3).alias("A.b"))
    assert common.pick(df, "text").first().text == 2 and common.pick(df, "Text").first().Text == 1
    assert common.pick(df, "a.b").collect()[0][0] == 3
    with pytest.raises(ValueError):
        common.pick(df, "other")
    assert importance and merkle and quality_classifier
