import numpy as np
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from termflow.operators import selection
from termflow.plans.catalog import shared_pipeline as pipeline
from termflow.plans.classify import Preset

from conftest import SF001


def dense(rows, n_docs_ids, size, col="pos"):
    ids = {d: i for i, d in enumerate(sorted(n_docs_ids))}
    x = np.zeros((len(ids), size))
    for r in rows:
        x[ids[r.doc_id], r[col]] = r.tf
    return x, ids


def test_stats_and_selection_match_dense_numpy(spark):
    p = pipeline(spark, SF001, Preset(prefix="EN", m=300))
    rows = p.tf_long("train").collect()
    docs = {r.doc_id for r in rows}
    x, _ = dense(rows, docs, p.size)
    mean = x.sum(axis=0) / len(docs)
    ss = ((x - mean) ** 2).sum(axis=0)
    stats = {r.pos: r for r in p.stats().collect()}
    assert len(stats) == p.size
    assert max(abs(stats[i].ss - ss[i]) for i in range(p.size)) < 1e-9
    assert max(abs(stats[i].mean_tf - mean[i]) for i in range(p.size)) < 1e-12
    key = np.array([float(f"{v:.9e}") for v in ss])
    order = sorted(range(p.size), key=lambda i: (-key[i], i))[:300]
    got = [r.pos for r in p.selected.orderBy("new_pos").collect()]
    assert got == order


def test_apply_selection_keeps_training_order_unnormalised(spark):
    p = pipeline(spark, SF001, Preset(prefix="EN", m=300))
    sel = {r.pos: r.new_pos for r in p.selected.collect()}
    full = {(r.doc_id, r.pos): r.tf for r in p.tf_long("test").collect()}
    red = {(r.doc_id, r.new_pos): r.tf for r in p.tf_reduced("test").collect()}
    expect = {(d, sel[pos]): v for (d, pos), v in full.items() if pos in sel}
    assert red == expect


def test_vector_slicer_equals_long_form_selection(spark):
    from termflow.operators import tf as tfo
    p = pipeline(spark, SF001, Preset(prefix="EN", m=300))
    full = tfo.tf_vectors(p.rows("test"), p.size, "EN")
    sliced = {r.doc_id: r.features for r in selection.slice_vectors(full, p.selected).collect()}
    via_long: dict = {}
    for r in p.tf_reduced("test").collect():
        via_long.setdefault(r.doc_id, {})[r.new_pos] = r.tf
    # documents whose selected entries are all zero have no reduced TF row
    assert set(via_long) <= set(sliced)
    for doc, v in sliced.items():
        assert v == SparseVector(300, via_long.get(doc, {}))


def test_selected_vectors_equal_vector_slicer(spark):
    from termflow.operators import tf as tfo
    p = pipeline(spark, SF001, Preset(prefix="EN", m=300))
    full = tfo.tf_vectors(p.rows("test"), p.size, "EN")
    sliced = {r.doc_id: (r.label, r.features) for r in selection.slice_vectors(full, p.selected).collect()}
    direct = {r.doc_id: (r.label, r.features)
              for r in tfo.selected_vectors(p.rows("test"), p.selected, 300, "EN").collect()}
    assert direct == sliced


def test_variances_of_any_magnitude_are_ranked_apart(spark):
    """Features of very long documents have tiny variances: they keep their
    order, while sums that differ in their last bits only are ties."""
    stats = spark.createDataFrame([(0, 1e-20), (1, 3e-20), (2, 2e-20), (3, 0.1 + 0.2), (4, 0.3), (5, 0.0)],
                                  "pos int, ss double")
    got = [r.pos for r in selection.select_by_variance(stats, 6, mode="none").orderBy("new_pos").collect()]
    assert got == [3, 4, 1, 2, 0, 5]
    got = [r.pos for r in selection.select_by_variance(
        stats.replace({0.1 + 0.2: 0.3, 0.3: 0.1 + 0.2}, subset="ss"), 2, mode="none").orderBy("new_pos").collect()]
    assert got == [3, 4]


def exact_stats(values, n):
    """(sum, sum of squared deviations over n documents), in exact fractions."""
    from fractions import Fraction
    x = [Fraction(v) for v in values]
    mean = sum(x) / n
    return float(sum(x)), float(sum((v - mean) ** 2 for v in x) + (n - len(x)) * mean ** 2)


def tf_frame(spark, columns):
    """TF rows of documents whose feature k has the k-th list's value; None is absent."""
    rows = [(str(i), [p for p, v in enumerate(doc) if v is not None], [v for v in doc if v is not None])
            for i, doc in enumerate(zip(*columns))]
    return spark.createDataFrame(rows, "doc_id string, pos array<int>, tf array<double>").repartition(7)


def test_nearly_constant_features_keep_their_digits(spark):
    """A sum of squares less a squared sum has no digit left here."""
    near = [0.5 if i % 2 else 0.5 + 1e-9 for i in range(1000)]
    gaps = [v if i % 10 else None for i, v in enumerate(near)]
    tiny = [1e-9 * (i % 7 + 1) for i in range(1000)]
    constant = [1 / 3] * 1000
    stats = {r.pos: r for r in selection.feature_stats(tf_frame(spark, [near, gaps, tiny, constant])).collect()}
    for pos, values in enumerate((near, gaps, tiny)):
        total, ss = exact_stats([v for v in values if v is not None], 1000)
        assert abs(stats[pos].sum_tf - total) <= 1e-12 * total and abs(stats[pos].ss - ss) <= 1e-6 * ss
    assert 0 <= stats[3].ss < 1e-28


def test_moments_of_parts_merge_to_those_of_the_whole(spark):
    rng = np.random.default_rng(4)
    columns = [[float(v) if keep else None for v, keep in zip(rng.random(400) + shift, rng.random(400) < share)]
               for shift, share in ((0, 1), (0, 0.3), (1e6, 0.5), (0, 0.01))]
    rows = tf_frame(spark, columns)
    number = F.col("doc_id").cast("int")
    parts = [selection.feature_moments(rows.where(p)) for p in (number < 30, (number >= 30) & (number < 31), number >= 31)]
    merged = selection.merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = {r.pos: r for r in selection.stats_from_moments(merged, 400).collect()}
    for pos, values in enumerate(columns):
        total, ss = exact_stats([v for v in values if v is not None], 400)
        assert abs(got[pos].sum_tf - total) <= 1e-12 * total and abs(got[pos].ss - ss) <= 1e-9 * ss
    assert selection.feature_stats(rows.limit(0), 0).count() == 0
