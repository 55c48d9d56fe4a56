"""The line files of ``lines_gd_confusion`` against the split of the table."""
from types import SimpleNamespace

from termflow.plans import catalog
from termflow.plans.classify import lines_corpus
from termflow.session import scratch_path
from termflow.sources.corpus import documents_corpus, split_corpus


def test_rows_without_an_id_are_training_lines(spark, monkeypatch):
    folder = scratch_path(spark, "null-ids")
    rows = [(5, "test side", "en", "s"), (6, "train side", "en", "s"), (None, "no id", "en", "s"), (None, "none too", "fr", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    seen = []

    def taken(session, train, test, preset):
        seen.append(lines_corpus(session, train, test))
        empty = session.createDataFrame([], "doc_id string, label int, prediction int")
        return SimpleNamespace(gd_predictions=lambda: empty)

    monkeypatch.setattr(catalog, "pipeline_from_lines", taken)
    catalog.q_lines_gd_confusion(spark, folder)
    for got, want in zip((seen[0].train, seen[0].test), split_corpus(documents_corpus(spark, folder)), strict=True):
        assert sorted(map(tuple, got.collect())) == sorted((r.doc_id or "", r.text) for r in want.collect())
    assert seen[0].train.count() == 3
