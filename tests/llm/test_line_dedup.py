"""Line dedup against plain Python, and the odd cases."""
from collections import Counter

from llm_support import SF001, documents, odd  # noqa: F401
from termflow.llm import line_dedup as ld

FOLD = str.maketrans(ld.UPPER, ld.LOWER)


def brute(rows, least=10, min_chars=1):
    key = lambda line: line.strip(ld.STRIPPED).translate(FOLD)
    count = Counter()
    for _, text in rows:
        count.update({key(line) for line in (text or "").split("\n")})
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= min_chars and count[key(x)] >= least)]
        out.append((i, "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_matches_plain_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = rows_of(ld.drop_repeated_lines(docs))
    assert got == brute(rows) and sum(r[3] for r in got) > 0


def test_odd_texts_at_several_thresholds(odd, documents):  # noqa: F811
    rows, docs = odd
    for least, min_chars in ((1, 1), (2, 1), (3, 4), (100, 1)):
        assert rows_of(ld.drop_repeated_lines(docs, least, min_chars)) == brute(rows, least, min_chars)
    wide = ld.drop_repeated_lines(documents(rows, extra=True), 2)
    assert rows_of(wide) == brute(rows, 2) and wide.columns.count("n_lines") == 1 and "a.b" in wide.columns
    assert ld.drop_repeated_lines(docs.limit(0)).count() == 0


def test_copies_of_a_text_count_as_documents(documents):  # noqa: F811
    rows = [(i, "same\nSAME \nown") for i in range(9)] + [(50, "x\nsame"), (51, "\x0bown\ny")]
    assert rows_of(ld.drop_repeated_lines(documents(rows))) == brute(rows)
