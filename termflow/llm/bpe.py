"""BPE encoding and decoding with a public word vocabulary (end-of-word
suffix, lower case, white space dropped).

A word's parts and the merge ranks of neighbouring parts are two short arrays:
the smallest rank is looked for again and again, its boundary deleted and the
two neighbouring ranks refreshed. Words above ``LONG_WORD`` symbols take a heap
of ranks instead, which gives the same merges without the quadratic scan.

Normalisation and splitting follow the vocabulary file: NFC, lower case by
character, pieces by its pattern, bytes as characters; the strings of special
tokens in a text become those tokens. Decoding joins the tokens by blanks, as
the file names no decoder.

Defined results: null and empty texts have no tokens and decode to the empty
text. Extra columns pass through; those named like a result column are
replaced. Repeated rows are encoded alike.

Scale: one pass without a shuffle. The vocabulary (its size is fixed, about
50,000 entries) is broadcast. Each task keeps at most ``CACHE`` encoded chunks.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append_columns

LONG_WORD, CACHE = 48, 250_000
#: Fixed values of the vocabulary file's normaliser and splitter.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blanks}{letters}{numbers}]+"
SUFFIX = "</w>"
RESULT = ("n_tokens", "ids", "decoded")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters for themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


def _ranges(chars: list[int]) -> str:
    """Characters as the inside of a character class."""
    out, start = [], None
    for k, c in enumerate(chars):
        start = c if start is None else start
        if k + 1 == len(chars) or chars[k + 1] != c + 1:
            out.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return "".join(out)


@functools.cache
def unicode_tables() -> dict:
    """Letters, numbers, blanks, lower-case exceptions and unordered marks as
    the tokenizers library has them, since Unicode versions differ. The driver
    needs that library; Python's own tables would give other ids."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]

    def of(pattern):
        gone = pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str("".join(every))
        return _ranges(sorted(set(map(ord, every)) - set(map(ord, "".join(part for part, _ in gone)))))

    # Marks of a later Unicode than the library's: it does not move them when it
    # orders marks, and nothing moves past them. U+0345 belongs last of all
    # marks but those of class 240 and more, U+0334 first.
    nfc = normalizers.NFC()
    tried = [(c, f"\u25cc\u0345{c}" if unicodedata.combining(c) < 240 else f"\u25cc{c}\u0334")
             for c in every if unicodedata.combining(c) and c not in "\u0345\u0334"]
    fixed = [ord(c) for c, text in tried
             if unicodedata.normalize("NFC", text) != text and nfc.normalize_str(text) == text]
    lower = normalizers.Lowercase()
    changed = [c for c in every if not c.isascii() and (c.lower() != c or unicodedata.category(c) == "Cn")]
    return {"letters": of(r"\p{L}"), "numbers": of(r"\p{N}"), "blanks": of(r"\s"), "fixed": _ranges(fixed),
            "lower": {ord(c): low for c in changed if (low := lower.normalize_str(c)) != c.lower()}}


def load(path: str) -> dict:
    """Tokens by id, merges by rank and special tokens of a vocabulary file.
    Refuses a file with other steps than this module follows."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    model = spec["model"]
    if steps != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != SUFFIX or spec["decoder"] or model["unk_token"]:
        raise ValueError(f"{path} has steps that are not followed here: {steps}")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {i: t for t, i in {**model["vocab"], **special}.items()}
    return {"unicode": unicode_tables(), "vocab": model["vocab"], "merges": [tuple(m) for m in model["merges"]], "special": special,
            "tokens": [tokens.get(i, "") for i in range(max(tokens) + 1)]}


class Encoder:
    """Encoding and decoding of texts with one vocabulary."""

    def __init__(self, spec: dict):
        vocab = spec["vocab"]
        self.tokens, self.special = spec["tokens"], spec["special"]
        self.rank, self.merged = {}, {}
        for k, (a, b) in enumerate(spec["merges"]):
            pair = (vocab[a], vocab[b])
            self.rank.setdefault(pair, k)
            self.merged.setdefault(pair, vocab[a + b])
        names = byte_characters()
        self.inner = [vocab.get(c) for c in names]
        self.final = [vocab.get(c + SUFFIX) for c in names]
        tables = spec["unicode"]
        self.pieces = re.compile(PATTERN.format(**tables)).findall
        self.blank = re.compile(f"[{tables['blanks']}]+")
        self.lower = {**tables["lower"], ord("Σ"): "σ"}  # by character: no final sigma
        self.odd = re.compile(f"[{_ranges(sorted(self.lower))}]").search
        self.fixed = re.compile(f"([{tables['fixed']}])") if tables["fixed"] else None
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.any_mark = [s for s in self.special]
        self.cache: dict[str, bytes] = {}

    def word(self, data: bytes) -> list[int]:
        """Token ids of one piece, given as its bytes."""
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.final[data[-1]])
        parts = [p for p in parts if p is not None]
        if len(parts) > LONG_WORD:
            return self._long(parts)
        rank, never = self.rank, len(self.rank) + 1
        ranks = [rank.get(pair, never) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == never:
                break
            i = ranks.index(low)
            parts[i] = self.merged[parts[i], parts[i + 1]]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), never)
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), never)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(self.rank[p], i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i] = self.merged[pair]
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := (parts[a], parts[b])) in self.rank:
                    heapq.heappush(heap, (self.rank[new], a, new))
        return [p for p, live in zip(parts, alive, strict=True) if live]

    def chunk(self, text: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without blanks."""
        ids = []
        for piece in self.pieces(text):
            ids += self.word(piece.encode("utf-8"))
        out = np.array(ids, "<u4").tobytes()
        if len(text) <= 64:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[text] = out
        return out

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            if self.fixed and self.fixed.search(text):
                text = "".join(unicodedata.normalize("NFC", part) for part in self.fixed.split(text))
            else:
                text = unicodedata.normalize("NFC", text)
            if self.odd(text):
                text = "".join(self.lower.get(ord(c)) or c.lower() for c in text)
        text = text.lower()
        # str.split also cuts at U+001C to U+001F, which are not white space to the pattern.
        cut = self.blank.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        get, chunk = self.cache.get, self.chunk
        return b"".join([get(w) or chunk(w) for w in cut if w])

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed."""
        if not any(mark in text for mark in self.any_mark):
            return self._plain(text)
        return b"".join(np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part)
                        for part in self.marks.split(text))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and ids (binary, little-endian 32-bit)."""
    spec = docs.sparkSession.sparkContext.broadcast(load(path))
    held = []

    def compute(column):
        if not held:
            held.append(Encoder(spec.value))
        ids = [held[0].encode(t or "") for t in column.to_pylist()]
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    return append_columns(docs, text, compute, [("n_tokens", "long"), ("ids", "binary")])


def decode(frame: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``frame`` with the text ``decoded`` from its packed ids."""
    spec = frame.sparkSession.sparkContext.broadcast(load(path)["tokens"])

    def compute(column):
        tokens = spec.value
        return [pa.array([" ".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                          for x in column.to_pylist()], pa.string())]

    return append_columns(frame, ids, compute, [("decoded", "string")])
