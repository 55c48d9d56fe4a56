"""Physical-plan properties that matter at scale, read from the executed
plan (AQE off so the static plan is visible)."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termflow.operators import dictionary as dct
from termflow.operators import blocks, gd, selection, tf
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.classify import Preset

from conftest import SF001, SF01, docs_frame
from test_text import py_words


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_tf_plan_broadcasts_dictionary_and_prunes_scan(no_aqe):
    p = pipeline(no_aqe, SF001)
    text = plan(tf.tf_long(p.corpus.train, p.dictionary, p.size))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    scan = [l for l in text.splitlines() if "FileScan parquet" in l]
    assert scan and all("source" not in l and "n_chars" not in l for l in scan)
    # partial aggregation happens before the shuffle
    assert text.count("HashAggregate") >= 2 and "partial_count" in text


def test_word_count_combines_map_side(no_aqe):
    p = pipeline(no_aqe, SF001)
    text = plan(dct.word_counts(p.corpus.train))
    first_exchange = text.index("Exchange hashpartitioning(word")
    assert "partial_count" in text[first_exchange:]


def test_dictionary_topk_uses_take_ordered(no_aqe):
    p = pipeline(no_aqe, SF001)
    counts = dct.word_counts(p.corpus.train)
    assert "TakeOrderedAndProject" in plan(dct.rank_dictionary(counts, 100))


def test_stored_tf_is_read_pruned_and_per_document_work_needs_no_shuffle(no_aqe):
    """The stored TF rows hold one document each: scores, vectors and
    predictions plan without an exchange and every reader takes only the
    columns it uses."""
    p = pipeline(no_aqe, SF001, Preset(prefix="EN", k=3000))
    rows = p.rows("train")
    weights = np.full(p.size, 0.01)
    for df in (gd.predict_gd(rows, gd.GdModel(weights=weights), "EN"),
               tf.tf_vectors(rows, p.size, "EN"), tf.selected_vectors(rows, p.selected, p.m_size, "EN")):
        text = plan(df)
        assert "Exchange" not in text and "ReadSchema: struct<doc_id:string,pos:array<int>,tf:array<double>>" in text
    stats = plan(selection.feature_stats(rows, 10))
    assert "ReadSchema: struct<pos:array<int>,tf:array<double>>" in stats
    assert stats.count("Exchange") == 1 and "partial_sum" in stats


def test_gradient_pass_keeps_one_vector_per_task(no_aqe, monkeypatch):
    """A pass works on packed blocks without a lambda, window, join or
    aggregation; it gives one vector per coalesced task, and a tree of tasks
    sums more than FANIN of them."""
    p = pipeline(no_aqe, SF001, Preset(prefix="EN", k=3000))
    monkeypatch.setattr(blocks, "BLOCK_ENTRIES", 50)
    packed = blocks.pack(p.rows("train"), F.lit(1)).repartition(8).cache()
    weights = np.full(p.size, 0.01)
    few = blocks.partial_sums(packed, weights, 0.0, blocks.logistic, 4)
    text = plan(few)
    assert "MapInArrow" in text and "Coalesce 4" in text and few.count() == 4
    assert not any(x in text for x in ("lambda", "Window", "Join", "Aggregate", "Generate"))
    assert all(len(r.total) == 8 * (p.size + 3) for r in few.collect())
    assert "Exchange" not in text.split("InMemoryTableScan")[0]
    assert plan(blocks.partial_sums(packed, weights, 0.0, blocks.logistic, 33)).split("InMemoryTableScan")[0].count("Exchange") == 1
    packed.unpersist()


def test_hot_document_id_is_exact(spark):
    """A third of all rows carry one document id (S9 at its worst): the
    aggregation-first plan merges them exactly."""
    from termflow.sources.corpus import documents_corpus
    docs = documents_corpus(spark, SF01).select("doc_id", "text")
    hot = docs.withColumn("doc_id", F.when(F.rand(7) < 1 / 3, F.lit("HOT")).otherwise(F.col("doc_id")))
    hot = hot.cache()
    d = dct.build_dictionary(hot, 5000, mode="none")
    d_rows = {r.word: r.pos for r in d.collect()}
    t = {(r.doc_id, r.pos): (r.n, r.tf) for r in tf.tf_long(hot, d, len(d_rows)).collect()}
    counts: dict = {}
    for r in hot.collect():
        c = counts.setdefault(r.doc_id, Counter())
        c.update(w for w in py_words(r.text) if w in d_rows)
    want = {}
    for doc, c in counts.items():
        total = sum(c.values())
        for w, n in c.items():
            want[(doc, d_rows[w])] = (n, n / total)
    assert t == want
    assert sum(1 for k in t if k[0] == "HOT") <= 5000
    hot.unpersist()
