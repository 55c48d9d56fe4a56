import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Texts that every operator on documents must handle: null, empty, blanks
#: only, one word, repeats, non-ASCII, odd separators, a very long text.
ODD_TEXTS = [None, "", " ", "\n", "\n\n \t\n", "word", "Word\r\nword", "a" * 500, "ab " * 3000, "É é ß ﬁ 漢字 😀  x y",
             "x\x0b\x0cy\x00z", "The The The", "İstanbul K ſ"]


def thue_morse(n: int) -> str:
    """Letters a and b by the parity of the bits of their place; with its
    complement it defeats polynomial hashes modulo a power of two."""
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) -> a documents table; with a clashing extra column."""
    def make(rows, extra=False):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        if extra:
            from pyspark.sql import functions as F
            for name in ("score", "kept", "key", "a.b", "n_lines", "tid", "component", "words"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def odd(documents):
    """ODD_TEXTS, some rows twice, one without an id."""
    rows = list(enumerate(ODD_TEXTS)) + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id here"), (5, "word")]
    return rows, documents(rows)
