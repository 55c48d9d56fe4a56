"""The join against comparing all pairs, on prose with planted near copies."""
import random
import re

import numpy as np
import pytest
from llm_support import SF001, documents, odd, thue_morse  # noqa: F401
from termflow.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    """(doc_id, n, component) with all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(k)
    pairs = {(a, b) for ks in where.values() for i, a in enumerate(ks) for b in ks[i + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, (i, _) in enumerate(rows):
        if sets[k] and i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(s), low.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))),
                  key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, words, share):
    return [("x%d" % rng.randrange(10**6)) if rng.random() < share else w for w in words]


def test_documents_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(jj.near_duplicates(docs)) == want
    assert sum(i != c for i, _, c in want) > 3


def test_planted_copies_and_shared_passages(documents, monkeypatch):  # noqa: F811
    """Copies around the threshold at many sizes, chains, passages shared by
    many; cells of few members, so that groups are cut."""
    monkeypatch.setattr(jj, "CELL", 7)
    rng, rows = random.Random(1), []
    passage = ["p%d" % i for i in range(60)]
    for size in (5, 6, 7, 9, 12, 20, 45, 90, 200, 700):
        base = ["w%d" % rng.randrange(10**6) for _ in range(size)]
        for share in (0, 0, 0.003, 0.01, 0.02, 0.03, 0.05):
            rows.append(" ".join(edited(rng, base, share)))
        for k in range(4):  # a chain: each drops some words of the one before
            base = base[:max(4, int(len(base) * (0.93 if k else 0.85)))]
            rows.append(" ".join(base))
    rows += [" ".join(["q%d" % rng.randrange(10**6) for _ in range(rng.randrange(3, 40))] + passage) for _ in range(60)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert rows_of(jj.near_duplicates(documents(rows))) == brute(rows)


def test_odd_texts(odd, documents):  # noqa: F811
    rows, docs = odd
    assert rows_of(jj.near_duplicates(docs)) == brute(rows)
    assert rows_of(jj.near_duplicates(documents(rows, extra=True))) == brute(rows)
    assert jj.near_duplicates(docs.limit(0)).count() == 0


def test_linked_sets_share_a_signature_and_pass_the_sketch():
    rng = np.random.default_rng(2)
    for size in [*range(4, 40), 100, 333, 1000]:
        for _ in range(6):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            # The most differences that still link: some dropped, some added.
            drop = int(rng.integers(0, size // 9 + 1))
            b = a[drop:]
            while True:
                c = np.append(b, rng.integers(0, 2**63, 1, dtype=np.uint64))
                if not jj.linked(np.sort(a), np.sort(c)):
                    break
                b = c
            if not jj.linked(np.sort(a), np.sort(b)):
                continue
            a, b = np.sort(a), np.sort(b)
            sa, sb = jj.signatures([a])[0], jj.signatures([b])[0]
            assert set(sa.tolist()) & set(sb.tolist()) or a.tobytes() == b.tobytes()
            n = np.array([len(a)]), np.array([len(b)])
            assert jj.within_bound([jj.sketch(a)], [jj.sketch(b)], *n)[0]


def brute_links(rows):
    """(doc_id, number of different sets that its set is linked to)."""
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    different = {s for s in sets.values() if s}
    links = {s: sum(o != s and 100 * len(s & o) >= 80 * len(s | o) for o in different) for s in different}
    return {i: links.get(s, 0) for i, s in sets.items()}


def links_of(df):
    return {r.doc_id: r.n_links for r in df.collect()}


def test_links_of_three_near_copies(documents):  # noqa: F811
    """Two copies that each change one word of a text are linked too."""
    base = ["w%d" % k for k in range(204)]
    rows = [(0, " ".join(base)), (1, " ".join(["x", *base[1:]])), (2, " ".join([*base[:-1], "y"]))]
    assert links_of(jj.near_duplicates(documents(rows))) == {0: 2, 1: 2, 2: 2} == brute_links(rows)


@pytest.mark.parametrize("cell,block", [(2000, 1 << 18), (7, 900)])
def test_links_of_groups_and_chains(documents, monkeypatch, cell, block):  # noqa: F811
    """Groups of many near copies, some not alike among themselves, equal
    texts, and a chain; whole, and in cells and by signature groups."""
    monkeypatch.setattr(jj, "CELL", cell)
    monkeypatch.setattr(jj, "CELL_SHINGLES", block)
    rng, rows = random.Random(5), []
    for size, share in ((30, 0.01), (90, 0.01), (200, 0.008), (204, 0.015), (60, 0.03)):
        base = ["w%d" % rng.randrange(10**6) for _ in range(size)]
        rows += [" ".join(edited(rng, base, share)) for _ in range(25)]
        rows += [" ".join(base)] * 3
    long = ["c%d" % rng.randrange(10**6) for _ in range(300)]
    rows += [" ".join(long[k:k + 40]) for k in range(0, 260, 4)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want = brute_links(rows)
    assert links_of(jj.near_duplicates(documents(rows))) == want
    assert max(want.values()) > 15 and sum(v == 2 for v in want.values()) > 40


def test_texts_made_to_collide_are_not_linked(documents):  # noqa: F811
    a = thue_morse(2048)
    other = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three four {a} six"), (2, f"one two three four {other} six"), (3, f"one two three four {a} six")]
    got = {r.doc_id: r.component_id for r in jj.near_duplicates(documents(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
