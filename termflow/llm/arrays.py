"""Text batches as flat byte arrays, and the numpy steps several operators
share. A block holds whole texts back to back in one uint8 buffer with int64
offsets, so that one numpy call handles thousands of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text per block: the arrays derived from a block (8 bytes per byte
#: of text each) then stay small. A longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_U = np.uint64
#: Odd multipliers of the rolling hashes and the seeds of their byte tables.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)
_TABLES = tuple(np.random.default_rng(1234 + k).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
                for k in range(2))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive blocks of whole texts."""
    buf, offs = flat(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hashes of any byte ranges of one buffer, from prefix sums: range
    [s, e) hashes to sum(table[byte] * base**(offset in range)) mod 2**64.
    ``which`` picks one of two independent hashes.

    Sums modulo a power of two collide on texts made for it (a Thue-Morse
    word and its complement, whatever the base), but only on 2**10 bytes and
    more; ranges above LONG bytes are named by a keyed digest instead."""

    LONG = 512

    def __init__(self, buf: np.ndarray, which: int = 0):
        n = len(buf)
        self.buf, self.key = buf, b"range %d" % which
        self.powers = np.full(n + 1, _U(_BASES[which]))
        self.powers[0] = 1
        np.multiply.accumulate(self.powers, out=self.powers)
        self.inverse = np.full(n + 1, _U(_INVERSES[which]))
        self.inverse[0] = 1
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[which][buf] * self.powers[:-1], out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of every range [start, end); the length is mixed in."""
        size = np.asarray(end - start)
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        h = mix(h + size.astype(np.uint64) * _U(0x9FB21C651E98DF25))
        for k in np.flatnonzero(size > self.LONG).tolist():
            digest = hashlib.blake2b(self.buf[start[k]:end[k]], digest_size=8, key=self.key).digest()
            h[k] = int.from_bytes(digest, "little")
        return h

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k-byte string of the buffer, by start; k is at most LONG."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.inverse[:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    if len(x) < w:
        return x[:0]
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if span < w else x


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """256-entry table, True for bytes within one of the inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Bytes that separate words in [^\x20\x09-\x0D]+ (UTF-8 keeps ASCII bytes apart).
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACES
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word offsets by text): the words of a block's texts; a word
    never runs on into the next text."""
    n = len(buf)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~separators[buf]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    cut = offs[1:-1]
    cut = cut[cut < n]
    begins = inside & ~before
    begins[cut] = inside[cut]
    start = np.flatnonzero(begins[:n])
    ends = ~inside & before
    ends[cut] |= before[cut] & inside[cut]
    end = np.flatnonzero(ends)
    return start, end, np.searchsorted(start, offs)


def lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, line offsets by text) of the \\n-separated lines; a text of
    k line breaks has k + 1 lines."""
    breaks = np.flatnonzero(buf == 10)
    start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offs[1:]]))
    count = np.searchsorted(breaks, offs[1:]) - np.searchsorted(breaks, offs[:-1]) + 1
    return start, end, np.concatenate([[0], np.cumsum(count)])


def owners(bounds: np.ndarray) -> np.ndarray:
    """Text index of every element, from element offsets by text."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def within(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Keys made different between texts, so that equal keys are of one text."""
    return mix(keys ^ mix(owner.astype(np.uint64) + _U(0x51ED27)))


def multiplicity(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how often each key occurs, whether it is its first occurrence)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(keys)))
    count = np.empty(len(keys), np.int64)
    count[order] = np.repeat(runs, runs)
    is_first = np.zeros(len(keys), bool)
    is_first[order[at]] = True
    return count, is_first


def windows(keys: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first element, hash) of every k consecutive elements of one text."""
    n = len(keys)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power = np.full(n + 1, _U(_BASES[0]))
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    inverse = np.full(n + 1, _U(_INVERSES[0]))
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(keys * power[:-1], out=prefix[1:])
    end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + k <= end)
    return at, mix((prefix[at + k] - prefix[at]) * inverse[at])


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Of n elements, those within a run of k that starts at one of ``at``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + k, -1)
    return np.cumsum(step[:-1]) > 0


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, empty texts included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
