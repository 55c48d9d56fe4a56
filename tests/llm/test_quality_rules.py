"""Base rules against a plain-Python version, Viterbi against enumeration,
gradients by training, and the odd cases."""
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from termflow.llm import arrays
from termflow.llm import quality_rules as q
from llm_support import ODD_TEXTS, SF001, SF01, documents, odd, thue_morse  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 4000 else set()
    if len(grams) >= 4000:
        from collections import Counter
        twice = {g for g, n in Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in twice for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_match_plain_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = q.apply_rules(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[n] for n in NAMES) == base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_verdict_follows_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    r = (q.apply_rules(docs, labels).join(labels, "doc_id").where("not base_failed")
         .where((F.crc32(F.col("doc_id").cast("string")) % 5) == 0).toPandas())
    assert (r.kept == (r.quality == 1)).mean() > 0.9
    assert r[r.quality == 1].kept.mean() > 0.97


def test_odd_texts(spark, odd, documents):
    rows, docs = odd
    model = {"w": np.eye(len(q.FEATURES), 2), "t": np.zeros((2, 2))}
    got = {(r.doc_id, r.text): r for r in q.judge(docs, model).collect()}
    for key in rows:
        assert tuple(got[key][n] for n in NAMES) == base(key[1])
    again = q.judge(documents(rows, extra=True), model)
    assert again.count() == len(rows) and "a.b" in again.columns and dict(again.dtypes)["kept"] == "boolean"
    none = documents([(1, "x")]).limit(0)
    assert q.apply_rules(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    no_labels = q.apply_rules(documents([(1, "word%d " * 30 % tuple(range(30)))]),
                              spark.createDataFrame([], "doc_id long, quality int, toxic int")).first()
    assert no_labels.kept and no_labels.content_share == 1.0
    assert len(ODD_TEXTS) > 10


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 1, 1, 5, 13, 15])
    e, t = rng.normal(size=(15, 2)), rng.normal(size=(2, 2))
    got = q.viterbi(e, t, bounds)
    for a, b in itertools.pairwise(bounds):
        score = lambda y: sum(e[a + i, v] for i, v in enumerate(y)) + sum(t[u, v] for u, v in itertools.pairwise(y))  # noqa: B023, E731
        if b > a:
            assert tuple(got[a:b]) == max(itertools.product((0, 1), repeat=b - a), key=score)


def test_training_learns_transitions_and_features():
    rng = np.random.default_rng(0)
    bounds = np.arange(0, 2001, 10)
    y = np.repeat(rng.integers(0, 2, 400), 5)
    x = np.zeros((2000, len(q.FEATURES)))
    x[:, 0], x[:, 5] = 1, y + rng.normal(scale=0.8, size=2000)
    model = q.fit_crf(x, y, bounds)
    assert model["t"][0, 0] + model["t"][1, 1] > model["t"][0, 1] + model["t"][1, 0]
    alone = ((x[:, 5] > 0.5) == y).mean()  # each line by itself
    assert (q.viterbi(x @ model["w"], model["t"], bounds) == y).mean() > alone + 0.08


def test_gradient_equals_differences():
    rng = np.random.default_rng(6)
    bounds, f = np.array([0, 1, 1, 5, 13, 15]), len(q.FEATURES)
    x, y = rng.normal(size=(15, f)), rng.integers(0, 2, 15)
    objective = q.crf_objective(x, y, bounds, 0.7)
    theta = rng.normal(scale=0.3, size=2 * f + 4)
    _, grad = objective(theta)
    for k in range(len(theta)):
        step = np.zeros(len(theta))
        step[k] = 1e-6
        assert abs((objective(theta + step)[0] - objective(theta - step)[0]) / 2e-6 - grad[k]) < 1e-7
    # The value is the log-probability of the labels, by enumeration.
    w, t = theta[:2 * f].reshape(f, 2), theta[2 * f:].reshape(2, 2)
    total = -0.7 * theta @ theta / 2
    for a, b in itertools.pairwise(bounds):
        score = lambda v: sum((x[a + i] @ w)[u] for i, u in enumerate(v)) + sum(t[u, s] for u, s in itertools.pairwise(v))  # noqa: B023, E731
        if b > a:
            total += score(y[a:b]) - np.logaddexp.reduce([score(v) for v in itertools.product((0, 1), repeat=b - a)])
    assert abs(objective(theta)[0] - total / 15) < 1e-12


PROSE = ["The river rose slowly that week, and the town's people watched it from the old stone bridge every evening.",
         "No one could say how high the water would come; the records went back only to the year of the great fire.",
         "She wrote her letters at the window, where the light was good until late, and posted them in the morning.",
         "When the rain stopped at last, the fields lay under a thin sheet of water that shone like polished tin."]
MENU = ["Home | About | Login", "Contact us", "Share this", "## Tags: #news #city", "Click here!!!"]


def corpus(documents):
    """Good prose with a menu in some of it, and bad pages of menus alone."""
    rng = np.random.default_rng(9)
    rows, quality, menus = [], [], {}
    for i in range(240):
        body = [" ".join(rng.permutation(PROSE[k].split()).tolist()) for k in rng.integers(0, 4, rng.integers(4, 9))]
        menu = rng.permutation(MENU).tolist()
        if i % 4 == 3:
            lines, good = [*menu, *rng.permutation(MENU).tolist(), *[f"Item {j} | {i}" for j in range(5)]], 0
        elif i % 2:
            at = int(rng.integers(1, len(body)))
            lines, good = [*body[:at], *menu, *body[at:]], 1
            menus[i] = set(range(at, at + len(menu)))
        else:
            lines, good = body, 1
            menus[i] = set()
        rows.append((i, "\n".join(lines)))
        quality.append((i, good, 0))
    return documents(rows), rows, quality, menus


def test_lines_are_labelled_within_documents(spark, documents):  # noqa: F811
    """A menu is cut out of good prose, in documents of the held-out fold too."""
    docs, rows, quality, menus = corpus(documents)
    labels = spark.createDataFrame(quality, "doc_id long, quality int, toxic int")
    model = q.train(docs, labels)
    right = total = mixed = 0
    for i, text in rows:
        b = q.Block(*arrays.flat(pa.array([text])))
        label = q.viterbi(b.line_features() @ model["w"], model["t"], b.l_bounds)
        if i in menus:
            want = np.isin(np.arange(len(label)), list(menus[i])).astype(int)
            right, total = right + (label == want).sum(), total + len(label)
            mixed += 0 < label.sum() < len(label)
        else:
            assert label.mean() > 0.8
    assert right / total > 0.97 and mixed >= 0.95 * sum(map(bool, menus.values()))
    got = {r.doc_id: r for r in q.judge(docs, model).collect()}
    assert all(got[i].kept == (i in menus) for i, _ in rows)


def test_lines_of_near_copies_are_not_boilerplate(spark, documents):  # noqa: F811
    """A line is boilerplate by its places, not by how many texts hold it."""
    rows = [(i, "\n".join([*PROSE, f"copy {i}"])) for i in range(30)]
    rows += [(100 + i, f"own line {i}\nShare this\nother {i}") for i in range(6)] + [(200, None), (201, "Share this")]
    docs = documents(rows).select("text")
    names = lambda text: {r[0] for r in spark.createDataFrame([(text,)], "text string").select(
        F.explode(q.line_names(F.col("text"))["line"])).collect()}
    wanted = docs.select(F.explode(q.line_names(F.col("text"))["line"]).alias("line")).where("line <> 0").distinct()
    placed = {r[0] for r in q.placed_lines(docs, wanted).collect()}
    assert placed == names("  Share this\t")
    lines = np.array([5, 0, 7, 0, 0, 9])
    assert q.teach(np.zeros(6, int), lines, np.array([7])).tolist() == [0, 0, 1, 1, 1, 0]
    assert q.teach(np.ones(6, int), lines, np.array([7])).tolist() == [1] * 6


def test_lines_made_to_collide_are_different():
    a = thue_morse(1024)
    text = f"one {a} two\none {a.translate(str.maketrans('ab', 'ba'))} two\none {a} two"
    assert q.Block(*arrays.flat(pa.array([text]))).n_dup_lines.tolist() == [1]
