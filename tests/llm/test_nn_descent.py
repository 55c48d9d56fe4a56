"""NN-descent search against brute force: recall, exact scores, ties, and the
odd vectors."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import SF001, SF01  # noqa: F401
from termflow.llm import nn_descent as nn
from termflow.llm.queries import op12_nn_descent


def brute(rows, is_query, k=5):
    """{query id: [(id, score)]} of rows (id, vector): every pair, in double precision."""
    best = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    dim = max((len(v) for v in best.values()), default=1)
    ids = np.array(sorted(best))
    x = np.array([list(best[i]) + [0.0] * (dim - len(best[i])) for i in ids]).reshape(len(ids), dim)
    x = x / (np.abs(x).max(axis=1, keepdims=True) if len(x) else 1)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for k_, i in enumerate(ids):
        if is_query(int(i)):
            cos = (x * x[k_]).sum(axis=1) / (norm * norm[k_])
            cos[k_] = -9
            order = np.lexsort((ids, -np.round(cos, 12)))[:min(k, len(ids) - 1)]
            out[int(i)] = [(int(ids[j]), float(cos[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for rows in out.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1))
    return {i: [(x[1], x[2]) for x in rows] for i, rows in out.items()}


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in rows}) for q, rows in want.items())
    return hits / sum(map(len, want.values()))


def test_query_finds_what_brute_force_finds(spark):
    df = op12_nn_descent(spark, SF01)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    got, want = found(df), brute(rows, lambda i: i % 50 == 0)
    assert recall(got, want) >= 0.99 and set(got) == set(want) and all(len(x) == 5 for x in got.values())
    exact = {(q, i): s for q, near in brute(rows, lambda i: i % 50 == 0, 500).items() for i, s in near}
    assert all(abs(exact[q, i] - s) < 1e-14 for q, near in got.items() for i, s in near)


def test_many_blocks_rounds_and_steps(spark, monkeypatch):
    """Small blocks and beams, so that rounds and steps do the work; queries
    that are not indexed enter at the entry points alone."""
    for name, value in (("BLOCK", 60), ("ENTRIES", 50), ("BEAM", 100), ("STEP", 25)):
        monkeypatch.setattr(nn, name, value)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)) + 2 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1500)]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    want = brute(rows, lambda i: i % 25 == 0)
    assert recall(found(nn.nearest(vectors, F.col("id") % 25 == 0)), want) >= 0.95
    index = nn.build(vectors.where("vec_id % 25 <> 0"))
    outside = vectors.where("vec_id % 25 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("v"),
                                                      F.lit(None).cast("long").alias("node"))
    got = {}
    for r in nn.search(index, outside).collect():
        got.setdefault(r.query, []).append((r.score, r.node))
    want = {q: [(i, s) for i, s in near if i % 25][:5] for q, near in brute(rows, lambda i: i % 25 == 0, 20).items()}
    got = {q: [(i, s) for s, i in sorted(near, key=lambda t: (-t[0], t[1]))[:5]] for q, near in got.items()}
    assert recall(got, want) >= 0.9


def test_equal_vectors_ties_odd_vectors_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0])]
    same = [(100 + i, [3.0, 4.0]) for i in range(40)]
    rest = [(0, [1.0, 0.0]), (10, [2.0]), (20, [1e200, 1e200]), (30, [-1.0, 1e-300]), (30, [-1.0, 1e-300]),
            (40, [5.0, 5.0, 0.0]), (40, [9.0, 9.0, 0.0]), (50, [0.0, 0.0, 7.0])]
    rows = odd + same + rest
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    wide = lambda df: df.select("*", *[F.lit(1).alias(c) for c in ("VEC_ID", "node", "q", "rank", "id")])
    got, want = found(nn.nearest(wide(vectors), F.col("id") % 10 == 0)), brute(rows, lambda i: i % 10 == 0)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-14)
    for few in (vectors.limit(0), vectors.where("vec_id < 10"), vectors.where("vec_id = 50")):
        assert nn.nearest(few, F.col("id") % 10 == 0).count() == 0
    assert found(nn.nearest(vectors.where("vec_id in (0, 50)"), F.col("id") % 10 == 0)) == {0: [(50, 0.0)], 50: [(0, 0.0)]}


def test_graph_holds_true_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    graph = {r.node: r.nbr for r in nn.build(vectors, neighbours=10).graph.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argsort(-(u @ u.T), axis=1)[:, 1:11]
    assert np.mean([len(set(graph[i]) & set(near[i])) / 10 for i in range(600)]) >= 0.95
    assert all(len(set(n)) == 10 and i not in n for i, n in graph.items())


@pytest.mark.parametrize("sample", [1, 3])
def test_flags_choose_new_and_old_of_each_owner(sample):
    owner = np.repeat([0, 1, 2], [6, 2, 0])
    flag = nn._flags(owner, np.arange(8), np.array([1, 1, 1, 0, 0, 0, 1, 0]), 3, sample)
    for o in (0, 1):
        assert (flag[owner == o] == nn.JOINS_NEW).sum() == min(sample, 3 if o == 0 else 1)
        assert (flag[owner == o] == nn.JOINS_OLD).sum() == min(sample, 3 if o == 0 else 1)
