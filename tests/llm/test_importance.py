"""Importance resampling against plain Python, the n-gram hash against zlib,
and ranks over hot ties."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import importance as im
from termflow.llm.queries import op11_importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(FOLD))
    return words, [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, target, percent=5, least=20):
    s, t = (Counter(bucket(f) for x in side for f in features(x)[1]) for side in ([x for _, x in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0))))
            for b in range(10000)]
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, len(words) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = len(able) * percent // 100
    out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted(out + [(*r[:4], None) for r in rows if not r[4]], key=repr)


def rows_of(df):
    assert df.dtypes[1:] == [("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_query_matches_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = rows_of(op11_importance(spark, SF001))
    assert got == brute(docs, target) and sum(r[4] is not None for r in got) >= 5


def test_odd_texts_ties_and_empty_tables(odd, documents, spark, monkeypatch):  # noqa: F811
    rows, docs = odd
    target = ["word the the", None, "漢字 É"]
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    for percent, least in ((5, 20), (50, 1), (100, 0)):
        assert rows_of(im.resample(docs, bench, percent, least)) == brute(rows, target, percent, least)
    monkeypatch.setattr(im, "WORDS_AT_ONCE", 7)  # texts in many slices
    clash = documents(rows, extra=True).select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("rank"), F.lit(3).alias("seg"))
    assert rows_of(im.resample(clash, bench, 50, 1)) == brute(rows, target, 50, 1)
    assert rows_of(im.resample(docs, bench.limit(0), 50, 1)) == brute(rows, [], 50, 1)
    assert rows_of(im.resample(docs.limit(0), bench)) == []


def test_ranks_are_exact_over_hot_ties(spark):
    """A third of all rows is one row; keys repeat; ranks are 1 to n in order."""
    rng = np.random.default_rng(3)
    keys = [(7, 5)] * 1000 + [(int(a), int(b)) for a, b in rng.integers(0, 30, (2000, 2))]
    rows = spark.createDataFrame(keys, "score long, id long").repartition(7)
    got = sorted((r["rank"], -r.score, r.id) for r in im.ranked(rows, [("score", True), ("id", False)], "t").collect())
    assert [r[0] for r in got] == list(range(1, 3001))
    assert [r[1:] for r in got] == sorted((-a, b) for a, b in keys)
    assert im.ranked(rows.limit(0), [("score", True)], "t").count() == 0


def test_segments_of_equal_rows_are_even(spark):
    rows = spark.range(4000).select(F.lit(1).alias("score"), F.lit(1).alias("id"), F.spark_partition_id().alias("x"))
    placed = im.ranked(rows, [("score", True), ("id", False)], "t")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / 8


def test_drawn_documents_are_whole_rows(documents, spark):  # noqa: F811
    rows = [(i, f"word{i} " * 25) for i in range(40)] + [(None, "x " * 30)]
    docs = documents(rows).select("*", F.lit(1).alias("TEXT"))
    found = im.resample(docs, spark.createDataFrame([("word3",)], "text string"), 10)
    drawn = im.drawn_documents(docs, found)
    assert drawn.columns == docs.columns and drawn.count() == 4


@given(st.lists(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x | 0x80 for x in b)), max_size=30))
@settings(max_examples=60, deadline=None)
def test_ngram_hash_is_crc32(words):
    buf = np.frombuffer(b" ".join(words), np.uint8)
    start = np.cumsum([0] + [len(w) + 1 for w in words])[:len(words)].astype(np.int64)
    end = start + np.array([len(w) for w in words], np.int64)
    found = im.NgramHash().buckets(buf, start, end)
    for k in range(3):
        assert found[k].tolist() == [zlib.crc32(b" ".join(words[i:i + k + 1])) % 10000 for i in range(len(words) - k)]
