import re

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from termflow.operators import dictionary as dct
from termflow.operators import tf

from conftest import docs_frame

TRAIN = [("AU1", "apple banana apple"), ("AU2", "banana cherry"), ("EN3", "cherry cherry apple date")]


def _dict(spark, k=3):
    return dct.build_dictionary(docs_frame(spark, TRAIN), k, mode="none")


def test_tf_values_and_sum_to_one(spark):
    d = _dict(spark)  # apple 3, cherry 3, banana 2 -> pos 0 apple, 1 cherry, 2 banana
    rows = {(r.doc_id, r.pos): (r.n, r.tf) for r in tf.tf_long(docs_frame(spark, TRAIN), d, 3).collect()}
    assert rows[("AU1", 0)] == (2, 2 / 3) and rows[("AU1", 2)] == (1, 1 / 3)
    # EN3: "date" is not in the dictionary, so the denominator is 3, not 4 (S7)
    assert rows[("EN3", 1)] == (2, 2 / 3) and rows[("EN3", 0)] == (1, 1 / 3)
    sums = tf.tf_long(docs_frame(spark, TRAIN), d, 3).groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)


def test_document_without_dictionary_word_drops_out(spark):
    d = _dict(spark)
    test_docs = docs_frame(spark, [("X1", "zebra only"), ("X2", "apple zebra")])
    t = tf.tf_rows(test_docs, d, 3)
    assert {r.doc_id for r in t.collect()} == {"X2"}
    rep = tf.dropped_documents(test_docs, t).first()
    assert (rep.n_docs, rep.n_with_tf, rep.n_dropped) == (2, 1, 1)


def test_repeated_ids_merge(spark):
    d = _dict(spark)
    docs = docs_frame(spark, [("D", "apple"), ("D", "apple banana")])
    rows = {r.pos: (r.n, r.tf) for r in tf.tf_long(docs, d, 3).collect()}
    assert rows == {0: (2, 2 / 3), 2: (1, 1 / 3)}


def test_vectors_equal_long_form(spark):
    d = _dict(spark)
    rows = tf.tf_rows(docs_frame(spark, TRAIN), d, 3)
    vecs = {r.doc_id: (r.label, r.features) for r in tf.tf_vectors(rows, 3, "AU").collect()}
    assert vecs["AU1"] == (1.0, SparseVector(3, {0: 2 / 3, 2: 1 / 3}))
    assert vecs["EN3"][0] == 0.0
    assert vecs["EN3"][1] == SparseVector(3, {0: 1 / 3, 1: 2 / 3})


def test_partition_count_does_not_change_tf(spark):
    d = _dict(spark)
    a = sorted(tuple(r) for r in tf.tf_long(docs_frame(spark, TRAIN), d, 3).collect())
    b = sorted(tuple(r) for r in tf.tf_long(docs_frame(spark, TRAIN).repartition(5), d, 3).collect())
    assert a == b


def test_lookup_is_broadcast_by_its_measured_bytes(spark, monkeypatch):
    """Few rows with long words are not small; the shuffle join gives the same
    counts."""
    d = _dict(spark)
    docs = docs_frame(spark, TRAIN)
    plan = lambda df: df._jdf.queryExecution().toString()
    small = tf.position_counts(docs, d, 3)
    assert "strategy=broadcast" in plan(small)
    monkeypatch.setattr(tf.params, "BROADCAST_MAX_BYTES", 32 * 3 + 10)  # the rows fit, the words do not
    large = tf.position_counts(docs, d, 3)
    assert "strategy=broadcast" not in plan(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_row_arrays_are_sorted_and_aligned(spark):
    d = _dict(spark)  # apple 0, cherry 1, banana 2
    rows = {r.doc_id: (r.pos, r.n, r.tf) for r in tf.tf_rows(docs_frame(spark, TRAIN), d, 3).collect()}
    assert rows["AU1"] == ([0, 2], [2, 1], [2 / 3, 1 / 3])
    assert rows["EN3"] == ([0, 1], [1, 2], [1 / 3, 2 / 3])


def test_selected_vectors_keep_documents_without_selected_words(spark):
    from pyspark.ml.linalg import SparseVector
    d = _dict(spark)  # apple 0, cherry 1, banana 2
    docs = docs_frame(spark, [("AU9", "banana banana"), ("EN9", "apple banana cherry")])
    t = tf.tf_rows(docs, d, 3)
    selected = spark.createDataFrame([(0, 1), (1, 0)], "new_pos int, pos int")  # cherry, apple
    got = {r.doc_id: (r.label, r.features) for r in tf.selected_vectors(t, selected, 2, "AU").collect()}
    assert got["AU9"] == (1.0, SparseVector(2, {}))                       # kept, all zero
    assert got["EN9"] == (0.0, SparseVector(2, {0: 1 / 3, 1: 1 / 3}))     # not re-normalised


def test_bloom_filter_passes_every_word_and_few_others(spark):
    words = spark.range(3000).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    passes = tf.bloom_filter(words, "word", 3000)
    assert words.where(passes(F.col("word"))).count() == 3000
    others = spark.range(20000).select(F.concat(F.lit("x"), F.col("id")).alias("word"))
    assert others.where(passes(F.col("word"))).count() < 0.06 * 20000
    none = tf.bloom_filter(words.limit(0), "word", 0)
    assert words.where(none(F.col("word"))).count() == 0


def test_out_of_dictionary_words_stay_at_the_scan(spark):
    """With a dictionary joined by shuffle, nearly all pairs that cross the
    network are of dictionary words."""
    docs = docs_frame(spark, [(f"D{i}", " ".join(f"common{chr(97 + j)}" for j in range(5)) + " " +
                               " ".join("rare" + chr(97 + j) * (i + 1) for j in range(20))) for i in range(40)])
    d = dct.build_dictionary(docs, 5, mode="none")
    assert {r.word for r in d.collect()} == {f"common{c}" for c in "abcde"}
    few = tf.position_counts(docs, d, 5, broadcast_bytes=0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, tf.position_counts(docs, d, 5).collect()))
    kept = tf.explode_tokens(docs).where(tf.bloom_filter(d, "word", 5)(F.col("word")))
    pairs = kept.distinct().count()
    assert 200 <= pairs < 200 + 0.1 * 800
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in text and text.index("Filter") < text.index("Generate")  # above the explode, below the count


def test_a_task_counts_a_bounded_number_of_documents(spark, monkeypatch):
    """One partition of documents, as a scan of one row group gives it, is
    dealt to as many tasks as its text needs before the partial counts."""
    docs = spark.createDataFrame([(f"EN{k}", f"apple banana w{k}") for k in range(300)],
                                 "doc_id string, text string").coalesce(1)
    monkeypatch.setattr(tf.params, "TASK_TEXT_BYTES", 200)
    plan = tf.position_counts(docs, _dict(spark), 3)._jdf.queryExecution().optimizedPlan().toString()
    found = [int(n) for n in re.findall(r"RepartitionByExpression \[xxhash64.*\], (\d+)", plan)]
    assert found and found[0] >= 300 * 16 // 200
    assert tf.position_counts(docs, _dict(spark), 3).count() == 600


def test_vectors_need_no_python_worker(spark, tmp_path):
    """Full and selected vectors are built in the scan's stage; odd doubles
    come back to the same bits, and a row without entries keeps its vector."""
    values = [1 / 3, 5e-324, 0.1 + 0.2, 1.7976931348623157e308, 1e-7]
    rows = spark.createDataFrame([("AU1", [0, 2, 3, 7, 9], values), ("X2", [], [])],
                                 "doc_id string, pos array<int>, tf array<double>")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    selected = spark.createDataFrame([(0, 9), (1, 2)], "new_pos int, pos int")
    full, some = tf.tf_vectors(rows, 20, "AU"), tf.selected_vectors(rows, selected, 2, "AU")
    for frame in (full, some):
        assert "Python" not in frame._jdf.queryExecution().toString()
    assert {r.doc_id: r.features for r in full.collect()} == {
        "AU1": SparseVector(20, [0, 2, 3, 7, 9], values), "X2": SparseVector(20, [], [])}
    assert {r.doc_id: r.features for r in some.collect()} == {
        "AU1": SparseVector(2, [0, 1], [1e-7, 5e-324]), "X2": SparseVector(2, [], [])}


def test_ids_with_too_much_text_are_counted_apart(spark, monkeypatch):
    """Hot ids, a hot null id, null texts and repeated rows: every token counts
    once, whichever way its document goes; without a hot id nothing but the
    text is shuffled."""
    words = ("apple", "banana", "cherry", "zzz")
    rows = [(i, None if k % 7 == 3 else " ".join(words[(k + j) % 4] for j in range(k % 5 + 1)))
            for i, n in (("HOT", 90), (None, 60), ("A", 2), ("B", 1), ("AU9", 3)) for k in range(n)]
    docs, d = docs_frame(spark, rows), _dict(spark)
    at = {r.word: r.pos for r in d.collect()}
    want = {}
    for i, t in rows:
        for w in (t or "").split():
            if w in at:
                want[i, at[w]] = want.get((i, at[w]), 0) + 1
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for most, hot in ((1 << 20, False), (400, True)):
        monkeypatch.setattr(tf.params, "TASK_TEXT_BYTES", most)
        got = tf.tf_rows(docs, d, 3)
        assert ("Union" in plan(got)) == hot
        found = got.collect()
        assert {(r.doc_id, p): n for r in found for p, n in zip(r.pos, r.n)} == want
        assert len(found) == len({i for i, _ in want})
        assert all(abs(sum(r.tf) - 1) < 1e-12 for r in found)
