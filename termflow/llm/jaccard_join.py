"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct 5-word shingles. Sets are put into bands
of similar size. A pair with Jaccard >= 0.8 and sizes a, b differs in at most
h = (a + b) / 9 shingles. Within a band the shingle domain is cut by hash into
n1 > h parts, so such a pair agrees wholly on n1 - h parts; every part of a set
gives one signature, and similar sets share one.

Parts that are empty in both sets agree without meaning, so a set with so many
empty parts that they might be all it shares is signed again with another hash
and more parts (``LEVELS`` times, then by each shingle alone). Two similar sets
share every level up to the first at which one of them is sound, and there a
part that is not empty: no pair is lost.

Candidates are verified in two steps, each complete. First every signature
group is tested as a star around its member with most groups; verified links
are joined to components, so a group of a thousand copies costs a thousand
tests. Then members of a group that are still in different components are
compared with each other by parity sketches: a bit for each of 4 n buckets or more
holds the parity of the shingles in it, and the number of bits that differ is
at most the number of shingles that do, so a pair over the bound is no link.
Pairs that pass are tested on their whole sets.

Components are then known, and links are counted: all classes of a component
of three or more are compared with each other on their whole sets, in cells,
each of which gives counts and no pairs. A component above ``CELL`` classes
whose signature groups hold fewer pairs than it does (a long chain) is compared
group by group instead, and its links are made distinct before they are counted.

Defined results: null, empty and blank texts have no shingles and are a
component of their own; with fewer than five words the whole sequence is the
one shingle. Equal sets are one class whatever their number. Repeated rows give
repeated rows; component_id is the smallest id that is not null (null when the
component has none). Extra columns are ignored.

Scale: signatures are shuffled once, about a quarter as many as shingles, and
scanned in order, so no group is held. Groups above ``CELL`` members are cut
into cells of two blocks for the pairwise step. Sets are fetched only for
classes of pairs that pass the sketch. Shingles and classes are named by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, Rolling, blocks, mix, windows, words
from .common import connected_components, release, written

#: Fixed by the query's contract: words of a shingle, least similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Sketch buckets for each member of a set: more let fewer pairs pass.
WIDTH = 4
#: Ratio of a band's largest to its smallest set, signing levels, and members
#: of a signature group that one cell compares pairwise.
RATIO, LEVELS, CELL = 1.5625, 4, 2_000
#: Shingles of a block of a cell that compares whole sets.
CELL_SHINGLES = 1 << 18

_U = np.uint64


def _bands() -> tuple[np.ndarray, np.ndarray]:
    low, bounds = 1, []
    while low < 1 << 40:
        high = max(low, int(low * RATIO))
        bounds.append((low, high))
        low = high + 1
    return np.array([b[0] for b in bounds]), np.array([b[1] for b in bounds])


BAND_LOW, BAND_HIGH = _bands()


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    low = LOWER[buf]
    start, end, bounds = words(low, offs)
    h = Rolling(low).ranges(start, end)
    at, grams = windows(h, bounds, SHINGLE)
    cut = np.searchsorted(at, bounds)
    out = []
    for k in range(len(offs) - 1):
        size = bounds[k + 1] - bounds[k]
        if size >= SHINGLE:
            s = np.sort(grams[cut[k]:cut[k + 1]])
            fresh = np.ones(len(s), bool)
            fresh[1:] = s[1:] != s[:-1]
            out.append(s[fresh])
        elif size:
            x = np.full(1, _U(size))
            for w in h[bounds[k]:bounds[k + 1]]:
                x = mix(x * _U(0x9E3779B97F4A7C15) + w)
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(s.tobytes()).digest()[:8], "little", signed=True)


def sketch(s: np.ndarray) -> bytes:
    """Parity of the set's members in each of 2**j >= WIDTH * n hash buckets."""
    width = max(64, 1 << int(max(WIDTH * len(s) - 1, 0)).bit_length())
    bucket = (mix(s ^ _U(0xA5A5A5A5)) & _U(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(bucket, minlength=width).astype(np.uint8) & 1).tobytes()


def most_different(a, b):
    """Largest number of shingles in which linked sets of these sizes differ."""
    return (a + b) // 9


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) for a list of sets."""
    n_all = np.array([len(s) for s in sets], np.int64)
    out_sig, out_set = [], []
    band_of = np.searchsorted(BAND_HIGH, n_all)
    for step in (0, 1):
        band = np.minimum(band_of + step, len(BAND_LOW) - 1)
        high = BAND_HIGH[band]
        most = most_different(high, high)
        # Bands without differences need none; the next band only if a partner can be in it.
        todo = np.flatnonzero((n_all > 0) & (most > 0) & ((step == 0) | (5 * n_all // 4 >= BAND_LOW[band])))
        for level in range(LEVELS + 1):
            if not len(todo):
                break
            n, b, hi, k = n_all[todo], band[todo], high[todo], most[todo]
            values = np.concatenate([sets[i] for i in todo])
            owner = np.repeat(np.arange(len(todo)), n)
            tag = b.astype(np.uint64) * _U(1 << 20) + _U(level)
            salted = mix(values ^ _U(0x1234567 + 7919 * level))
            if level == LEVELS:  # every shingle alone
                out_sig.append(mix(salted + mix(tag)[owner]))
                out_set.append(todo[owner])
                break
            empty = 0.013 * (k + 1)
            parts = k + 1 + np.ceil((empty + 2 * np.sqrt(empty)) * (level + 1)).astype(np.int64)
            part = (((salted >> _U(32)) * parts[owner].astype(np.uint64)) >> _U(32)).astype(np.int64)
            offset = np.concatenate([[0], np.cumsum(parts)])
            slot = offset[owner] + part
            total = np.zeros(offset[-1], np.uint64)
            np.add.at(total, slot, mix(salted + _U(99)))
            full = np.bincount(slot, minlength=offset[-1]) > 0
            of = np.repeat(np.arange(len(todo)), parts)
            index = (np.arange(offset[-1]) - offset[of]).astype(np.uint64)
            out_sig.append(mix(total + mix(tag[of] * _U(1 << 32) + index))[full])
            out_set.append(todo[of[full]])
            partner = np.minimum(5 * n // 4, hi)
            empties = parts - np.bincount(of[full], minlength=len(todo))
            todo = todo[empties > parts - most_different(n, partner) - 1]
    if not out_sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


_ROW = pa.schema([("sig", pa.int64()), ("c", pa.int64()), ("n", pa.int32()), ("doc_id", pa.int64()),
                  ("sketch", pa.binary()), ("tid", pa.int64())])
_ROW_DDL = "sig long, c long, n int, doc_id long, sketch binary, tid long"


def _emit(batches):
    """A row per document (with its sketch) and per signature of a set; a set
    already signed by this task is not signed again."""
    seen = set()
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, buf, offs in blocks(batch.column(1)):
            sets = shingle_sets(buf, offs)
            keys = [class_key(s) for s in sets]
            c = pa.array(keys, pa.int64())
            n = pa.array([len(s) for s in sets], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [c, c, n, ids.slice(lo, hi - lo), pa.array([sketch(s) for s in sets], pa.binary()),
                 batch.column(2).slice(lo, hi - lo)], schema=_ROW)
            fresh = []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    fresh.append(k)
            sig, of = signatures([sets[k] for k in fresh])
            if len(sig):
                at = np.array(fresh)[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), c.take(pa.array(at)), n.take(pa.array(at)),
                     pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.int64())],
                    schema=_ROW)


def _shared_only(batches):
    """Of rows in (sig, c) order: document rows, and signature rows whose
    signature has two classes or more. Holds one row from batch to batch."""
    held, told = None, False  # last distinct row of the group so far; whether it was given
    for batch in batches:
        is_doc = batch.column(4).is_valid()
        docs = batch.filter(is_doc)
        if docs.num_rows:
            yield docs
        rows = batch.filter(pa.compute.invert(is_doc))
        if not rows.num_rows:
            continue
        if held is not None:
            rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
        sig, c = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        distinct = np.ones(len(sig), bool)
        distinct[1:] = (sig[1:] != sig[:-1]) | (c[1:] != c[:-1])
        rows, sig = rows.filter(pa.array(distinct)), sig[distinct]
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(sig)))
        give = np.repeat(size > 1, size)
        last_told = bool(give[-1]) or (told and at[-1] == 0)
        if told:
            give[0] = False
        out = rows.filter(pa.array(give))
        if out.num_rows:
            yield out
        held, told = rows.slice(rows.num_rows - 1, 1), last_told


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketch rows of more buckets brought to ``width`` bytes: bucket numbers
    are taken modulo, so parities of halves add up."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def within_bound(a: list[bytes], b: list[bytes], na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether the sketches leave a link possible."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    ok = np.zeros(len(a), bool)
    for x, y in {(int(p), int(q)) for p, q in zip(la, lb, strict=True)}:
        at = np.flatnonzero((la == x) & (lb == y))
        for part in np.array_split(at, max(1, len(at) * max(x, y) // (8 << 20))):
            left = np.frombuffer(b"".join(a[i] for i in part), np.uint8).reshape(len(part), x)
            right = np.frombuffer(b"".join(b[i] for i in part), np.uint8).reshape(len(part), y)
            width = min(x, y)
            apart = np.bitwise_count(_fold(left, width) ^ _fold(right, width)).sum(1, dtype=np.int64)
            ok[part] = apart <= most_different(na[part], nb[part])
    return ok


def _sketch_filter(batches):
    """(a, b, na, nb, ska, skb) -> the pairs (a, b) that may be links."""
    for batch in batches:
        ok = within_bound(batch.column(4).to_pylist(), batch.column(5).to_pylist(),
                          batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))


#: Pairs that the pairwise step looks at together.
_PAIRS_AT_ONCE = 1 << 19


def _cell_pairs(batches):
    """Rows (sig, ci, cj, blk, c, n, comp, sketch) in (sig, ci, cj) order ->
    pairs of different components that may be links."""
    held = None

    def pairs_of(table):
        n_rows = table.num_rows
        if n_rows < 2:
            return
        sig, ci, cj, blk, c, n, comp = (table.column(k).to_numpy() for k in range(7))
        sk = table.column(7).to_pylist()
        first = np.ones(n_rows, bool)
        first[1:] = (sig[1:] != sig[:-1]) | (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1])
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, n_rows))
        after = np.repeat(at + size, size) - np.arange(n_rows) - 1  # later rows of the same group
        upto = np.concatenate([[0], np.cumsum(after)])
        lo = 0
        while lo < n_rows:
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + _PAIRS_AT_ONCE, "right")) - 1)
            k = after[lo:hi]
            i = np.repeat(np.arange(lo, hi), k)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
            ok = (comp[i] != comp[j]) & (c[i] != c[j]) & ((ci[i] == cj[i]) | (blk[i] != blk[j]))
            ok &= 100 * np.minimum(n[i], n[j]).astype(np.int64) >= PERCENT * np.maximum(n[i], n[j]).astype(np.int64)
            i, j = i[ok], j[ok]
            if len(i):
                x, y = np.minimum(c[i], c[j]), np.maximum(c[i], c[j])
                order = np.lexsort((y, x))
                new = np.ones(len(order), bool)
                new[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
                pick = order[new]
                i, j, x, y = i[pick], j[pick], x[pick], y[pick]
                keep = within_bound([sk[p] for p in i], [sk[p] for p in j], n[i].astype(np.int64), n[j].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], ["a", "b"])
            lo = hi

    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held, batch]).combine_chunks()
        key = [table.column(k).to_numpy() for k in range(3)]
        last = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1])
        cut = int(np.argmax(last)) if len(last) else 0
        yield from pairs_of(table.slice(0, cut).combine_chunks())
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield from pairs_of(pa.Table.from_batches(held).combine_chunks())


def _fetch_sets(batches):
    """(c wanted, text) -> (c, set) of the texts whose class that is."""
    for batch in batches:
        want = batch.column(0).to_pylist()
        keys, found = [], []
        for lo, _, buf, offs in blocks(batch.column(1)):
            for k, s in enumerate(shingle_sets(buf, offs)):
                if class_key(s) == want[lo + k]:
                    keys.append(want[lo + k])
                    found.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], ["c", "members"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _verify(batches):
    """(a, b, sa, sb) -> the links (a, b)."""
    for batch in batches:
        ok = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
              for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links, by their whole sets."""
    return (pairs.join(sets.select(F.col("c").alias("a"), F.col("members").alias("sa")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("members").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(_verify, "a long, b long"))


def _whole_cells(batches):
    """Rows (key, ci, cj, ...) in that order -> a table for each cell."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = (np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if held and (last != key[:, lo]).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key[:, lo]
    if held:
        yield pa.Table.from_batches(held)


def _cell_links(table):
    """(row, rows it is linked to) of a cell (key, ci, cj, blk, c, members),
    each link once: between its two blocks, or within its one."""
    ci, cj = table.column(1)[0].as_py(), table.column(2)[0].as_py()
    blk = table.column(3).to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column(5).to_pylist()]
    n = np.array([len(s) for s in sets], np.int64)
    found, number = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.split(number, np.cumsum(n)[:-1])
    order = np.argsort(n, kind="stable")
    left, right = order[blk[order] == ci], order[blk[order] == cj]
    if not len(left) or not len(right):
        return
    n_right = n[right]
    numbers = np.concatenate([rows[k] for k in right])
    offs = np.concatenate([[0], np.cumsum(n_right)])
    present = np.zeros(len(found), bool)
    for at, i in enumerate(left):
        lo = at + 1 if ci == cj else int(np.searchsorted(n_right, -(-PERCENT * n[i] // 100)))
        hi = int(np.searchsorted(n_right, 100 * n[i] // PERCENT, "right"))
        if lo >= hi:
            continue
        present[rows[i]] = True
        both = np.add.reduceat(present[numbers[offs[lo]:offs[hi]]], offs[lo:hi] - offs[lo], dtype=np.int64)
        present[rows[i]] = False
        ok = 100 * both >= PERCENT * (n[i] + n_right[lo:hi] - both)
        if ok.any():
            yield i, right[lo:hi][ok]


def _count_links(batches):
    """Cells -> (c, number of its links in the cell)."""
    for table in _whole_cells(batches):
        count = np.zeros(table.num_rows, np.int64)
        for i, js in _cell_links(table):
            count[i] += len(js)
            count[js] += 1
        yield pa.RecordBatch.from_arrays([table.column(4).combine_chunks(), pa.array(count)], ["c", "n_links"]).filter(
            pa.array(count > 0))


def _list_links(batches):
    """Cells -> the links (a, b) in them."""
    for table in _whole_cells(batches):
        c = table.column(4).to_numpy()
        for i, js in _cell_links(table):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(c[i], c[js])), pa.array(np.maximum(c[i], c[js]))],
                                             ["a", "b"])


def _dealt(rows: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` (key, c) with their sets, in cells of two blocks of their key;
    ``sizes`` has (key, m, shingles)."""
    parts = F.ceil(F.greatest(F.col("m") / CELL, F.col("shingles") / CELL_SHINGLES)).cast("int")
    return (rows.join(sizes.select("key", parts.alias("parts")), "key").join(sets.select("c", "members"), "c")
            .withColumn("blk", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("key", F.least("blk", "o").alias("ci"), F.greatest("blk", "o").alias("cj"), "blk", "c", "members")
            .repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj"))


def count_links(component: DataFrame, sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(c, n_links) of every class of ``component`` (c, component)."""
    spark = component.sparkSession
    rows = component.select("c", F.col("component").alias("key"))
    extent = (F.count("*").alias("m"), F.sum(F.col("n").cast("long")).alias("shingles"))
    sizes = written(rows.join(sets.select("c", "n"), "c").groupBy("key").agg(*extent), "component-sizes")
    two = rows.join(sizes.where("m = 2"), "key").select("c", F.lit(1).cast("long").alias("n_links"))
    crowds, counts = sizes.where("m > 2"), two
    large = sizes.where(F.col("m") > CELL)
    if not large.isEmpty():
        pairs = F.col("m").cast("double") * (F.col("m") - 1)
        inside = rows.join(large.select("key"), "key").join(shared, "c").select("key", "sig", "c", "n")
        groups = written(inside.groupBy("key", "sig").agg(*extent).where("m > 1"), "component-groups")
        chains = written(groups.groupBy("key").agg(F.sum(pairs).alias("grouped"))
                         .join(large.select("key", pairs.alias("all")), "key").where("grouped < all").select("key"), "chains")
        crowds = crowds.join(chains, "key", "left_anti")
        name = F.xxhash64("key", "sig").alias("key")
        links = _dealt(inside.join(chains, "key", "left_semi").select(name, "c"),
                       groups.join(chains, "key", "left_semi").select(name, "m", "shingles"), sets
                       ).mapInArrow(_list_links, "a long, b long")
        links = written(links.distinct(), "chain-links")
        counts = counts.union(links.select(F.col("a").alias("c")).union(links.select(F.col("b").alias("c")))
                              .groupBy("c").agg(F.count("*").alias("n_links")))
    in_cells = _dealt(rows, crowds, sets).mapInArrow(_count_links, "c long, n_links long")
    counts = written(counts.union(in_cells.groupBy("c").agg(F.sum("n_links").alias("n_links"))), "link-counts")
    release(spark)
    return counts


def _sets_of(source: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(c, members, n) of the classes in ``pairs``, each from one document."""
    wanted = (pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
              .join(classes.select("c", "head"), "c").select("c", "head.doc_id", "head.tid"))
    wanted = written(wanted.withColumnRenamed("doc_id", "want_id"), "wanted")
    # Merged at any size: which side is small must not change the plan as the corpus grows.
    return written(source.join(wanted.hint("merge"), "tid").where(F.col("doc_id").eqNullSafe(F.col("want_id"))).select("c", "text")
                   .mapInArrow(_fetch_sets, "c long, members binary").dropDuplicates(["c"])
                   .withColumn("n", (F.octet_length("members") / 8).cast("int")), "sets")


def similarity_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents (doc_id, n, c, tid), links (a, b) between classes c that make the
    components, sets (c, members, n) of all linked classes, signatures (sig, c,
    n) of two classes or more)."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("tid", F.xxhash64("text"))
    rows = written(source.mapInArrow(_emit, _ROW_DDL).repartition("sig").sortWithinPartitions("sig", "c")
                   .mapInArrow(_shared_only, _ROW_DDL), "signatures")
    release(spark)
    members = rows.where("sketch is not null").select("doc_id", "n", "c", "sketch", "tid")
    shared = rows.where("sketch is null").select("sig", "c", "n")
    degree = shared.groupBy("c").agg(F.count("*").alias("degree"))
    classes = written(members.groupBy("c").agg(F.min(F.struct("doc_id", "tid")).alias("head"), F.first("n").alias("n"),
                                               F.first("sketch").alias("sketch"))
                      .join(degree, "c"), "classes")

    # Stars: every member against the one with most groups.
    rich = shared.join(classes.select("c", "degree"), "c")
    hub = written(rich.groupBy("sig").agg(F.max(F.struct("degree", "c", "n")).alias("hub"))
                  .select("sig", F.col("hub.c").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    near = PERCENT * F.greatest("n", "hub_n") <= 100 * F.least("n", "hub_n")
    star = (shared.join(hub, "sig").where((F.col("c") != F.col("hub")) & near)
            .select(F.least("c", "hub").alias("a"), F.greatest("c", "hub").alias("b")).distinct())
    side = lambda c, n, s: classes.select(F.col("c").alias(c), F.col("n").alias(n), F.col("sketch").alias(s))
    likely = written(star.join(side("a", "na", "ska"), "a").join(side("b", "nb", "skb"), "b")
                     .select("a", "b", "na", "nb", "ska", "skb").mapInArrow(_sketch_filter, "a long, b long"), "stars")
    sets = _sets_of(source, classes, likely)
    links = written(_links(likely, sets), "star-links")
    release(spark)

    # The rest: members of one group that are still in different components.
    component = written(connected_components(links).select(F.col("node").alias("c"), "component"), "star-components")
    placed = shared.join(component, "c", "left").withColumn("comp", F.coalesce("component", "c"))
    off = placed.join(hub.select("sig", "hub"), "sig").where("c <> hub")
    open_groups = written(off.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m"))
                          .where("x <> y").select("sig", "m"), "open-groups")
    blocks_of = F.ceil(F.col("m") / CELL).cast("int")
    cells = (off.join(open_groups, "sig").join(classes.select("c", "sketch"), "c")
             .withColumn("blk", F.pmod(F.xxhash64("c"), blocks_of).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), blocks_of - 1)))
             .select("sig", F.least("blk", "o").alias("ci"), F.greatest("blk", "o").alias("cj"), "blk", "c", "n", "comp",
                     "sketch"))
    rest = written(cells.repartition("sig", "ci", "cj").sortWithinPartitions("sig", "ci", "cj")
                   .mapInArrow(_cell_pairs, "a long, b long").distinct(), "rest")
    release(spark)
    if not rest.isEmpty():
        more = _sets_of(source, classes, rest)
        links = links.union(written(_links(rest, more), "rest-links"))
        sets = sets.union(more.join(sets.select("c"), "c", "left_anti"))
    return members.select("doc_id", "n", "c", "tid"), links, sets, shared


def representatives(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, copies) of the row that stands for each component, tid
    being its text's hash: the smallest id, none last, then the smallest hash.
    ``copies`` rows share both. Rows without shingles stand for themselves
    (copies 1)."""
    members, links, _, _ = similarity_classes(docs)
    component = connected_components(links).select(F.col("node").alias("c"), "component")
    same = members.where("n > 0").groupBy("c", "doc_id", "tid").agg(F.count("*").alias("copies"))
    lowest = same.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid", "copies")).alias("head"))
    heads = (lowest.join(component, "c", "left").groupBy(F.coalesce("component", "c").alias("component"))
             .agg(F.min("head").alias("head")).select("head.doc_id", "head.tid", "head.copies"))
    blank = members.where("n = 0").select("doc_id", "tid").distinct()
    return heads.union(blank.withColumn("copies", F.lit(1).cast("long")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): n_links counts the classes
    of other texts that the document's class is linked to."""
    members, links, sets, shared = similarity_classes(docs)
    component = written(connected_components(links).select(F.col("node").alias("c"), "component"), "components")
    degree = count_links(component, sets, shared)
    lowest = members.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("low"))
    placed = (lowest.join(component, "c", "left").withColumn("component", F.coalesce("component", "c"))
              .join(degree, "c", "left"))
    heads = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    # Written, so that the last join is between plain exchanges, which may be split.
    named = written(placed.join(heads, "component").select("c", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")),
                    "component-ids")
    return members.join(named, "c", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
