"""Secret scan with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must hold (A-Z folded to a-z). Documents are indexed by
segments of about 1 MB: for each trigram of the rules, the postings are the
sorted documents of the segment that hold it. A rule's query is answered by
intersecting and uniting postings, and only the candidates are searched with
the expression itself. Rules without mandatory trigrams (runs of hex digits)
search every document.

Base rules keep their leftmost non-overlapping matches and then drop those that
are too short; further rules add spans. Defined results: null and empty texts
hold nothing; spans count code points, end exclusive; repeated rows are scanned
alike; extra columns pass through, those named like a result column are
replaced.

Scale: a segment's index is used in the task that holds its texts, so neither
postings nor texts are shuffled, and a hot trigram is a list of one segment's
documents. ``postings`` writes the same index out as a table.
"""

from __future__ import annotations

import re
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import LOWER, blocks
from .common import append_columns

_JWT = r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
#: (kind, expression, group measured, least characters). The first three are
#: fixed by the query's contract, in the order they are listed there.
RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Whole runs of 24 or more are the runs that pass, found without visiting shorter ones.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("jwt", _JWT, 0, 1),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
)
BASE = ("assign", "access", "hex")
#: Strings that a run of optional or alternative literals may stand for, at most.
_MOST = 32

# A query is None (no condition), a trigram, or ("and" | "or", queries).


def _all(queries):
    queries = [q for q in queries if q is not None]
    return None if not queries else queries[0] if len(queries) == 1 else ("and", tuple(queries))


def _any(queries):
    queries = list(dict.fromkeys(queries))
    return None if None in queries or not queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _of_strings(strings) -> tuple | str | None:
    """What a text must hold if it holds one of the strings."""
    return _any([_all(list(dict.fromkeys(s[i:i + 3] for i in range(len(s) - 2)))) for s in sorted(strings)])


def _exact(items) -> set[str] | None:
    """The strings that a sequence can match, folded; None if there are many."""
    out = {""}
    for op, arg in items:
        if op is rc.LITERAL:
            part = {chr(arg).lower()} if arg < 128 else None
        elif op is rc.IN and all(o is rc.LITERAL and a < 128 for o, a in arg):
            part = {chr(a).lower() for _, a in arg}
        elif op is rc.SUBPATTERN:
            part = _exact(arg[3])
        elif op is rc.BRANCH:
            parts = [_exact(x) for x in arg[1]]
            part = None if None in parts else set().union(*parts)
        elif op is rc.MAX_REPEAT and arg[0] in (0, 1) and arg[1] == 1:
            part = _exact(arg[2])
            part = None if part is None else part | ({""} if arg[0] == 0 else set())
        elif op is rc.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 8:
            part = _exact(list(arg[2]) * arg[0])
        else:
            part = None
        if part is None or len(out) * len(part) > _MOST:
            return None
        out = {a + b for a in out for b in part}
    return out


def _query(items):
    """Query of a sequence: runs of literals, and what stands between them."""
    found, run = [], {""}
    for item in items:
        part = _exact([item])
        if part is not None and len(run) * len(part) <= _MOST:
            run = {a + b for a in run for b in part}
            continue
        found.append(_of_strings(run))
        run = part if part is not None else {""}
        if part is None:
            op, arg = item
            if op is rc.SUBPATTERN:
                found.append(_query(arg[3]))
            elif op is rc.BRANCH:
                found.append(_any([_query(x) for x in arg[1]]))
            elif op is rc.MAX_REPEAT and arg[0] > 0:
                found.append(_query(arg[2]))
    return _all([*found, _of_strings(run)])


def trigram_query(expression: str):
    """Boolean trigram query that every match's text satisfies."""
    return _query(list(rp.parse(expression)))


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class Segment:
    """Inverted index of one block of texts over a set of trigrams."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, wanted: list[str]):
        self.n = len(offs) - 1
        self.postings = {}
        low = LOWER[buf]
        codes = (low[:-2].astype(np.uint32) << 16 | low[1:-1].astype(np.uint32) << 8 | low[2:]) if len(low) > 2 else low[:0]
        names = np.array([int.from_bytes(t.encode(), "big") for t in wanted], np.uint32)
        table = np.zeros(1 << 16, bool)  # by the first two bytes; few positions are left
        table[names >> 8] = True
        at = np.flatnonzero(table[codes >> 8]) if len(codes) else np.zeros(0, np.int64)
        found = codes[at]
        doc = np.searchsorted(offs, at, "right") - 1
        inside = at + 3 <= offs[doc + 1] if len(at) else np.zeros(0, bool)
        for t, name in zip(wanted, names, strict=True):
            self.postings[t] = np.unique(doc[(found == name) & inside])

    def candidates(self, query) -> np.ndarray:
        """Documents of the segment that satisfy a query."""
        if query is None:
            return np.arange(self.n)
        if isinstance(query, str):
            return self.postings[query]
        lists = sorted((self.candidates(q) for q in query[1]), key=len)
        out = lists[0]
        for more in lists[1:]:
            out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
        return out


_RUNS = re.compile(r"[A-Za-z0-9_-]+", re.ASCII)


def _web_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the ``jwt`` rule, from whole runs of its characters: the
    expression alone would start anew at every ``eyJ`` of a long run."""
    found, before = [], []
    for m in _RUNS.finditer(text):
        a, b = m.span()
        if before and not (before[-1][1] + 1 == a and text[a - 1] == "."):
            before = []
        if len(before) == 2 and b - a >= 8 and text.startswith("eyJ", before[1][0]) and before[1][1] - before[1][0] >= 11:
            start = text.find("eyJ", *before[0])
            if 0 <= start <= before[0][1] - 11:
                found.append((start, b))
                before = []
                continue
        before = [*before, (a, b)][-2:]
    return found


def find(rule, text: str) -> list[tuple[int, int]]:
    """Spans of a rule's matches in a text."""
    _, expression, group, least = rule
    if expression == _JWT:
        return _web_tokens(text)
    return [m.span() for m in re.compile(expression, re.ASCII).finditer(text) if len(m.group(group)) >= least]


def scan(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``found``: an array of "kind:start:end" by start, then by
    the order of the rules."""
    rules = tuple(rules)
    queries = [trigram_query(r[1]) for r in rules]
    wanted = sorted(set().union(set(), *map(trigrams_of, queries)))

    def compute(column):
        found = []
        for _, _, buf, offs in blocks(column):
            segment = Segment(buf, offs, wanted)
            texts, hits = {}, [[] for _ in range(segment.n)]
            for order, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                for d in segment.candidates(query).tolist():
                    if d not in texts:
                        texts[d] = buf[offs[d]:offs[d + 1]].tobytes().decode("utf-8", "replace")
                    hits[d] += [(a, order, b) for a, b in find(rule, texts[d])]
            found += [[f"{rules[o][0]}:{a}:{b}" for a, o, b in sorted(h)] for h in hits]
        return [pa.array(found, pa.list_(pa.string()))]

    return append_columns(docs, text, compute, [("found", "array<string>")])


def postings(docs: DataFrame, rules=RULES) -> DataFrame:
    """The index as a table: (trigram, doc_ids), a row per segment."""
    wanted = sorted(set().union(set(), *(trigrams_of(trigram_query(r[1])) for r in rules)))

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, _, buf, offs in blocks(batch.column(1)):
                rows = [{"trigram": t, "doc_ids": ids.take(pa.array(p + lo)).to_pylist()}
                        for t, p in Segment(buf, offs, wanted).postings.items() if len(p)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                        [("trigram", pa.string()), ("doc_ids", pa.list_(pa.int64()))]))

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "trigram string, doc_ids array<long>")
