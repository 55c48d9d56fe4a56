"""Repeated strings against a table of all windows; levels of the index; odd
texts; groups cut into cells."""
import random
from collections import Counter

import pytest
from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import suffix_dedup as sd


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(d), sum(gone), runs, kept))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def test_documents_equal_all_windows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 200)
    assert rows_of(sd.remove_repeats(docs)) == want and sum(r[2] for r in want) > 0


@pytest.mark.parametrize("cell,batches", [(2000, 1), (3, 3)])
def test_planted_repeats(documents, monkeypatch, cell, batches):  # noqa: F811
    monkeypatch.setattr(sd, "CELL", cell)
    rng, rows = random.Random(7), []
    letters = "abcdé \n"
    line = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [line(n) for n in (30, 39, 40, 41, 60, 150)]
    for k in range(60):
        parts = [line(rng.randrange(80))]
        for _ in range(rng.randrange(4)):
            piece = rng.choice(shared)
            a = rng.randrange(max(1, len(piece) - 35))
            parts += [piece[a:] if rng.random() < 0.5 else piece, line(rng.randrange(60))]
        rows.append((k, "".join(parts)))
    rows += [(100, "x" * 90), (101, "xy" * 60), (102, rows[3][1]), (102, rows[3][1]), (103, shared[5] + "q" + shared[5]),
             (None, shared[4]), (104, None), (105, ""), (106, "ab" * 19)]
    assert rows_of(sd.remove_repeats(documents(rows), length=40, gram=20, batches=batches)) == brute(rows, 40)


def test_odd_texts(odd, documents):  # noqa: F811
    rows, docs = odd
    assert rows_of(sd.remove_repeats(docs)) == brute(rows, 200)
    wide = sd.remove_repeats(documents(rows, extra=True))
    assert rows_of(wide) == brute(rows, 200) and "a.b" in wide.columns
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    index = sd.SuffixIndex(spark, 40, 20)
    sizes = []
    for k in range(5):
        index.insert(spark.createDataFrame([(k, "".join(chr(97 + (i * i + k) % 23) for i in range(200)))], "tid long, body string"))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
