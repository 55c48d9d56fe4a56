"""Decontamination against plain Python, both join ways, and the odd cases."""
import hashlib
import re

import pytest
from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ws(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(rows, items):
    grams = {}
    for i, text in items:
        w = ws(text)
        for s in range(max(len(w) - 9, 1)):
            if w:
                grams.setdefault(tuple(w[s:s + 10]), set()).add(i)
    sizes, out = {len(g) for g in grams}, []
    for i, text in rows:
        w, hit, found = ws(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (got := grams.get(tuple(w[s:s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= got
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len([x for x in found if x is not None]),
                    hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()),
                  key=repr)


@pytest.mark.parametrize("bound", [dc.BROADCAST_BYTES, 0])
def test_matches_plain_python_both_ways(spark, monkeypatch, bound):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", bound)
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows_of(dc.report(docs, bench)) == want and any(r[5] for r in want)


@pytest.mark.parametrize("bound", [dc.BROADCAST_BYTES, 0])
def test_odd_items_and_texts(spark, odd, documents, monkeypatch, bound):  # noqa: F811
    monkeypatch.setattr(dc, "BROADCAST_BYTES", bound)
    rows, _ = odd
    long = " ".join(f"w{i % 23}" for i in range(200))
    rows = rows + [(200, long), (201, "x " + long[:60] + " y"), (202, "A b C d E f G h"), (203, long)]
    for items in ([(1, " ".join(long.split()[5:30])), (2, "the THE the"), (3, None), (4, ""), (None, "word"),
                   (5, "b c d e f g"), (6, "b c, d e-f g"), (10, "é e é")],
                  [(1, " ".join(long.split()[:10])), (2, " ".join(long.split()[7:40]))], []):
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert rows_of(dc.report(documents(rows), bench)) == brute(rows, items)
    wide = dc.decontaminate(documents(rows, extra=True), bench)
    assert wide.count() == len(rows) and "a.b" in wide.columns
    assert dc.report(documents(rows).limit(0), bench).count() == 0


def test_no_python_in_the_plan(spark):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = dc.report(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
