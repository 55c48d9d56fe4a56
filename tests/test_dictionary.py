from collections import Counter

from termflow.operators import dictionary as dct
from termflow.session import materialize

from conftest import docs_frame
from test_text import py_words

DOCS = [("d1", "b a c a b d"), ("d2", "c c e b"), ("d3", "f a")]


def py_dictionary(docs, k):
    counts = Counter(w for _, t in docs for w in py_words(t))
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    return [(i, w, n) for i, (w, n) in enumerate(ranked)]


def test_dictionary_ties_by_word(spark):
    df = docs_frame(spark, DOCS)
    for k in (1, 2, 3, 4, 6, 100):
        got = [tuple(r) for r in dct.build_dictionary(df, k, mode="none").orderBy("pos").collect()]
        assert got == py_dictionary(DOCS, k), k


def test_prefilter_equals_plain_topk(spark):
    df = docs_frame(spark, DOCS)
    for k in (1, 2, 3, 5, 50):
        a = dct.build_dictionary(df, k, prefilter=True, mode="none").orderBy("pos").collect()
        b = dct.build_dictionary(df, k, prefilter=False, mode="none").orderBy("pos").collect()
        assert a == b


def test_short_vocabulary_gives_smaller_dictionary(spark):
    df = docs_frame(spark, DOCS)
    d = dct.build_dictionary(df, 20000, mode="checkpoint")
    assert d.count() == 6


def test_topk_is_prefix_and_partition_independent(spark):
    from conftest import SF001
    from termflow.sources.corpus import documents_corpus
    docs = documents_corpus(spark, SF001).select("doc_id", "text")
    small = dct.build_dictionary(docs, 500, mode="none").orderBy("pos").collect()
    big = dct.build_dictionary(docs, 1000, mode="none").orderBy("pos").collect()
    assert big[:500] == small
    other = dct.build_dictionary(docs.repartition(3), 500, mode="none").orderBy("pos").collect()
    assert other == small


def test_count_threshold(spark):
    df = docs_frame(spark, DOCS)
    counts = materialize(dct.word_counts(df), "cache")
    # counts: a3 b3 c3 d1 e1 f1
    assert dct.count_threshold(counts, 1) == 3
    assert dct.count_threshold(counts, 3) == 3
    assert dct.count_threshold(counts, 4) == 1
    assert dct.count_threshold(counts, 7) is None
