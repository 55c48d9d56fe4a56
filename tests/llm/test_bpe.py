"""Encoding and decoding against the tokenizers library."""
import random
import unicodedata

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import ODD_TEXTS, SF001, documents, odd  # noqa: F401
from termflow.llm import bpe
from tokenizers import Tokenizer, normalizers

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), bpe.Encoder(bpe.load(PATH))


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = OWN.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want, text
    assert OWN.decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


def test_hard_texts():
    for text in [*[t or "" for t in ODD_TEXTS], "It's we'LL 'TIS don't", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ ΟΔΟΣ", "é É",
                 "x\x1cy\x1f z\x85w v u", "１２3 ½ Ⅷ", "​﻿", "ab" * 400, "각 각", "İI ı", "<|endoftext",
                 "x" * 49, "é" * 60, "!!!???...", "한" * 100]:
        same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdethingoers'", min_size=1, max_size=120))
def test_short_and_long_words_merge_alike(text):
    same(text)


def test_documents_and_odd_rows(spark, odd, documents):  # noqa: F811
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows, frame = odd
    for d in (docs.select("doc_id", "text"), frame, documents(rows, extra=True)):
        got = bpe.decode(bpe.encode(d, PATH), PATH).collect()
        assert len(got) == d.count()
        for r in got:
            want = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
            assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
            assert r.decoded == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_every_combining_mark_normalises_as_the_library_does():
    """Each mark in pairs with old marks of low, middle and high class, on a
    letter that composes and on one that does not."""
    nfc, encoder = normalizers.NFC(), OWN
    marks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.combining(chr(c))]
    for mark in marks:
        for other in "\u0301\u0316\u0334\u0345\u031b\u1ac3\u1e2ec":
            for text in (f"a{mark}{other}", f"a{other}{mark}", f"\u25cc{other}{mark}{other}"):
                parts = encoder.fixed.split(text) if encoder.fixed else [text]
                assert "".join(unicodedata.normalize("NFC", p) for p in parts) == nfc.normalize_str(text), ascii(text)


def test_texts_of_many_marks_encode_as_the_library_does():
    rng = random.Random(11)
    marks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.combining(chr(c))]
    letters = "aeoAEO\u1eb9 \u0415\u0391k\u212a\u0130\u3131\u1100\u1161\u11a8\u0958"
    for _ in range(4000):
        text = "".join(rng.choice(letters) + "".join(rng.choices(marks, k=rng.randint(0, 4))) for _ in range(rng.randint(1, 6)))
        same(text)
