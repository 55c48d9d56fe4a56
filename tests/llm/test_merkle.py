"""Merkle manifest against a plain tree, log entries, and the odd cases."""
import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import merkle
from termflow.llm.queries import op13_merkle_manifest


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain_tree(leaves):
    """(root, proofs): by levels, without a log."""
    level, proofs, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, j in enumerate(at):
            proofs[k] += [level[j ^ 1]] if j ^ 1 < len(level) else []
            at[k] = j >> 1
        level = [H(level[k:k + 2]) for k in range(0, len(level), 2)]
    return level[0], proofs


def brute(rows):
    """Of rows (doc_id, source, lang, n_chars, text): the query's rows but folded_root."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    found = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[lang] = plain_tree([leaf(r) for r in trees[lang]])
    if not rows:
        return []
    root, tops = plain_tree([found[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        for r, proof in zip(trees[lang], found[lang][1]):
            touched = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            out.append((r[0], leaf(r), found[lang][0], root, H(proof + top), not touched))
    return sorted(out, key=repr)


def query(docs):
    rows = merkle.verify(merkle.proofs(*merkle.manifest(docs))).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in rows), key=repr)


def plain_rows(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.select(*merkle.FIELDS).collect()]


def test_query_matches_a_plain_tree(spark):
    got = op13_merkle_manifest(spark, SF001)
    rows = sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got.collect()), key=repr)
    assert rows == brute(plain_rows(spark.read.parquet(f"{SF001}/documents.parquet")))
    assert 0 < sum(not r[5] for r in rows) < len(rows)


@pytest.mark.parametrize("span", [1, 2, 3])
def test_small_builders_need_several_tiers(spark, monkeypatch, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = [(i, f"s{i % 3}", lang, i, "x" * i) for lang, n in ((None, 1), ("a", 2), ("b", 9), ("é", 21), ("z", 8)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    log, top = merkle.manifest(docs)
    assert len(log) > 1 and len(top) >= (2 if span < 3 else 1)
    found = merkle.verify(merkle.proofs(log, top)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in found), key=repr) == brute(rows)


def test_odd_rows_repeats_and_empty_tables(odd, documents, spark):  # noqa: F811
    rows, docs = odd
    same = spark.createDataFrame([(7, "s", None, None, "t")] * 5 + [(None, None, "x", 2**63 - 1, None)] * 3,
                                 "doc_id long, source string, lang string, n_chars long, text string")
    every = docs.select(*merkle.FIELDS).union(same)
    assert query(every) == brute(plain_rows(every))
    clash = documents(rows, extra=True).select("*", F.lit(1).alias("tree"), F.lit("y").alias("N_Chars"), F.lit(1).alias("h"))
    assert query(clash) == brute(plain_rows(documents(rows)))
    assert query(docs.limit(0)) == []


@given(st.integers(1, 200), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_log_is_postorder_and_entries_are_closed_form(n, more):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    levels = merkle.height(n) + more
    log = merkle.append_log(leaves, levels)
    level, seen = leaves, 0
    for k in range(levels + 1):
        for j, node in enumerate(level):
            assert log[merkle.position(k, j, n)] == node
            seen += 1
        level = [merkle.digest(level[i:i + 2]) for i in range(0, len(level), 2)]
    assert seen == len(log)
    for i in range(n):
        path = [None if p is None else log[p] for p in merkle.siblings(i, n, levels)]
        assert merkle.fold(leaves[i], i, path) == log[-1]


def test_segments_join_to_one_log():
    """Builders of aligned ranges write the entries that one builder writes."""
    leaves = [bytes([i]) * 32 for i in range(45)]
    whole = merkle.append_log(leaves, 3)
    parts = [merkle.append_log(leaves[k:k + 8], 3) for k in range(0, 45, 8)]
    for k, part in enumerate(parts):
        for level in range(4):
            for j in range(-(-min(8, 45 - 8 * k) >> level)):
                at = merkle.position(level, j, min(8, 45 - 8 * k))
                assert part[at] == whole[at + 15 * k]
