"""Held-out accuracy, flat traversal against a recursive walk, odd cases."""
import zlib

import numpy as np
from llm_support import SF01, documents, odd  # noqa: F401
from termflow.llm import quality_classifier as qc


def test_held_out_accuracy_and_flags(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    r = qc.classify(docs, labels).toPandas()
    assert len(r) == docs.count() and r.score.between(0, 1).all()
    assert (r.held_out == r.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (r.predicted == (r.score >= 0.3)).all()
    m = r[r.held_out].merge(labels.toPandas(), on="doc_id")
    assert (m.predicted == m.quality).mean() > 0.95 and m[m.quality == 1].predicted.mean() > 0.97


def test_flat_traversal_equals_walking(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = qc.fit_trees(x, y, trees=15, depth=3, least=5)

    def walk(row):
        total = model["base"]
        for f, t, v in zip(model["feature"], model["threshold"], model["value"], strict=True):
            k = 0
            for _ in range(3):
                k = 2 * k + 1 + (row[f[k]] > t[k])
            total += v[k - 7]
        return 1 / (1 + np.exp(-total))

    p = qc.predict(model, x)
    assert np.allclose(p, [walk(r) for r in x]) and ((p > 0.5) == y).mean() > 0.95


def test_odd_cases(spark, odd, documents):  # noqa: F811
    rows, docs = odd
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(3, 1, 0), (None, 1, 0), (4, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = qc.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    wide = qc.score(documents(rows, extra=True), qc.train(docs, labels))
    assert dict(wide.dtypes)["score"] == "double" and wide.count() == len(rows) and "a.b" in wide.columns
    assert {r.score for r in qc.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert qc.classify(docs.limit(0), labels).count() == 0
