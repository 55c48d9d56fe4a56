from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from termflow.operators import dictionary as dct
from termflow.operators import slices, tf
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.classify import Preset

from conftest import SF001, SF01, docs_frame
from test_text import TRICKY, py_words


def cut(texts):
    column = pa.array(texts, pa.string())
    found, owner = slices.words(*slices._texts(column))
    out = [[] for _ in texts]
    for word, k in zip(found.to_pylist(), owner.tolist()):
        out[k].append(word)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(TRICKY), st.text("aZ é1", max_size=6)), min_size=1, max_size=8))
def test_words_match_python_rule(texts):
    """Also where a document ends with a letter and the next begins with one."""
    assert cut(texts) == [py_words(t) for t in texts]


def test_words_of_every_character():
    texts = [f"a{chr(c)}B" for c in range(0x3000) if not 0xD800 <= c < 0xE000] + ["", "", "x"]
    assert cut(texts) == [py_words(t) for t in texts]


def test_slices_cut_between_documents(monkeypatch):
    monkeypatch.setattr(slices, "SLICE_BYTES", 10)
    bounds = np.array([0, 4, 9, 9, 30, 31, 41])
    assert list(slices._slices(bounds)) == [(0, 3), (3, 4), (4, 5), (5, 6)]


def test_counts_do_not_depend_on_slices(spark, monkeypatch):
    """Repeated and null ids, null texts, and texts longer than a slice or than
    a task reads."""
    rows = [(None if k % 9 == 0 else f"D{k % 40}", None if k % 11 == 0 else f"apple{'x' * (k % 3)} Banana café " * (k % 13))
            for k in range(150)] + [("LONG", "apple banana " * 400), ("E", ""), ("N", None)]
    docs = docs_frame(spark, rows)
    want = Counter(w for _, t in rows for w in py_words(t or ""))
    d = spark.createDataFrame([("apple", 0), ("banana", 1), ("caf", 2)], "word string, pos int")
    found = []
    for size, task in ((1 << 22, 1 << 23), (60, 1 << 23), (60, 2000)):
        monkeypatch.setattr(slices, "SLICE_BYTES", size)
        monkeypatch.setattr(dct.params, "TASK_TEXT_BYTES", task)
        counts = dct.word_counts(docs).collect()
        assert {r.word: r.n for r in counts} == want and len(counts) == len(want)
        found.append(sorted(map(str, tf.tf_rows(docs, d, 3).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 40


def test_no_token_is_a_row(spark):
    """TF rows, of which a comparison builds eight, come from slices: no
    explode of tokens, and one exchange of the text alone."""
    p = pipeline(spark, SF001)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = tf.tf_rows(p.corpus.train, p.dictionary, p.size)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Generate" not in text and text.count("MapInArrow") == 2 and "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_fits_read_stored_vectors(spark):
    """The vectors of a fit are read as such, not parsed, and are those of
    ``vectors``, to the same bits."""
    p = pipeline(spark, SF01, Preset(prefix="EN", k=400, m=50))
    for features in ("full", "reduced"):
        for side, frame in zip(("train", "test"), p.ml_vectors(features)):
            assert "from_json" not in frame._jdf.queryExecution().toString()
            seen = lambda df: {r.doc_id: (r.label, r.features) for r in df.collect()}
            assert seen(frame) == seen(p.vectors(side, features))
    p.release()


def test_a_run_of_one_model_caches_no_second_copy(spark):
    """Spark ML caches the blocks of a fit; a timed run leaves them the memory."""
    from termflow.plans.classify import pipeline as fresh, timed_run
    p = fresh(spark, SF001, Preset(prefix="EN", k=300))
    seen, vectors = [], p.ml_vectors
    p.ml_vectors = lambda features: seen.append(vectors(features)) or seen[-1]
    run = timed_run(p, "svm", "full")
    assert run["train_rows"] == p.counts("train")[1]
    assert seen and not any(frame.is_cached or frame.storageLevel.useMemory for pair in seen for frame in pair)
