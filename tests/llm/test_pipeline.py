"""The pipeline against its stages' brute-force versions, and the odd cases."""
import hashlib

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
import test_decontaminate
import test_jaccard_join
import test_line_dedup
from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import quality_classifier as qc
from tokenizers import Tokenizer


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = qc.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    texts = {r.doc_id: r.text for r in qc.score(docs, model).where("score >= 0.3").collect()}
    texts = {i: t for i, t, _, _ in test_line_dedup.brute(list(texts.items()))}
    texts = {i: texts[i] for i, _, c in test_jaccard_join.brute(list(texts.items())) if i == c}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    texts = {r[0]: texts[r[0]] for r in test_decontaminate.brute(list(texts.items()), bench) if not r[5]}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = {tuple(r) for r in cp.run(spark, SF001).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    assert got == want and 100 < len(got) < docs.count()


def test_stages_take_odd_rows(spark, odd, documents):  # noqa: F811
    rows, docs = odd
    for frame in (docs, documents(rows, extra=True), docs.limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, frame, SF001)
            if name != "bpe":
                assert out.columns == list(cp.COLUMNS) and out.count() <= len(rows)
            else:
                assert out.count() == frame.count()


def test_one_row_of_each_component_stays(spark, documents):  # noqa: F811
    """Repeated rows, ids that head another component, rows without an id, and
    rows without words."""
    def pair(name):
        words = [f"{name}{k}" for k in range(80)]
        return " ".join(words), " ".join([*words[:-1], "other"])
    a, a2 = pair("a")
    b, _ = pair("b")
    c, c2 = pair("c")
    d, _ = pair("d")
    e, e2 = pair("e")
    rows = [(1, a), (2, a2), (2, b), (3, d), (3, d), (3, d), (None, c2), (7, c), (None, e), (None, e2), (None, e),
            (8, ""), (8, ""), (None, None), (None, " ")]
    out = [(r.doc_id, r.text) for r in cp.keep_one_of_each(spark, documents(rows), SF001).collect()]
    heads = sorted((x for x in out if x[1] not in (e, e2)), key=str)
    assert heads == sorted([(1, a), (2, b), (3, d), (7, c), (8, ""), (8, ""), (None, None), (None, " ")], key=str)
    assert len(out) == len(heads) + 1


def test_equal_id_and_text_leave_the_smallest_row(spark, documents):  # noqa: F811
    docs = documents([(4, "one two three four five six")])
    both = docs.union(docs.selectExpr("doc_id", "text", "lang", "'a' as source", "n_chars"))
    assert [r.source for r in cp.keep_one_of_each(spark, both, SF001).collect()] == ["a"]
