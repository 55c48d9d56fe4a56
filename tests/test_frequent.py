"""Dictionaries from the sketch against exact counts."""
import random
from collections import Counter

import pytest

from termflow.operators import dictionary as dct
from termflow.operators import frequent

from conftest import SF001, docs_frame
from termflow.sources.corpus import documents_corpus


def zipf(seed, n_docs=60, words=400):
    rng = random.Random(seed)
    names = ["w" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(f"D{i}", " ".join(rng.choices(names, weights, k=rng.randint(0, 120)))) for i in range(n_docs)]


def rows(df):
    return [tuple(r) for r in df.orderBy("pos").collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counters_are_short_by_no_more_than_they_say(spark, seed):
    docs = zipf(seed)
    df = docs_frame(spark, docs).repartition(5)
    exact = Counter(w for _, t in docs for w in t.split())
    found = frequent.sketch_words(df, 20, "cache")
    held = {r.word: r.n for r in found.counters.collect()}
    assert found.short > 0 and found.sent <= 5 * 21
    assert all(exact[w] - found.short <= held.get(w, 0) <= exact[w] for w in exact)


@pytest.mark.parametrize("k,counters", [(1, 10), (5, 20), (10, 40), (30, 60), (50, 400), (400, 500), (1000, 2000), (200, 3)])
def test_same_dictionary_as_from_exact_counts(spark, k, counters):
    """Pruned and certain, pruned and not, not pruned, vocabulary below k."""
    df = docs_frame(spark, zipf(7)).repartition(4)
    assert rows(frequent.frequent_dictionary(df, k, counters, "cache")) == rows(dct.build_dictionary(df, k, mode="none"))


def test_ties_at_the_cut_go_by_word(spark):
    docs = docs_frame(spark, [(f"D{i}", "b b c c a a " + " ".join(f"x{j}" for j in range(i * 9, i * 9 + 9)).replace("1", "q")) for i in range(8)])
    for k in (1, 2, 3):
        got = rows(frequent.frequent_dictionary(docs.repartition(3), k, 6, "cache"))
        assert got == rows(dct.build_dictionary(docs, k, mode="none"))


def test_fewer_rows_are_shuffled(spark):
    df = documents_corpus(spark, SF001).select("doc_id", "text").repartition(8)
    found = frequent.sketch_words(df, 800, "cache")
    whole = frequent.sketch_words(df, 10**6, "cache")
    assert whole.short == 0 and found.sent <= 8 * 801 < whole.sent / 2
    assert rows(frequent.frequent_dictionary(df, 100, 800, "cache")) == rows(dct.build_dictionary(df, 100, mode="none"))


def test_empty_corpus(spark):
    assert frequent.frequent_dictionary(docs_frame(spark, []), 5, 10, "cache").count() == 0
