"""Merkle manifest of a dataset: an append log of tree nodes in completion
order (postorder), written by builders of aligned leaf ranges.

Every row is a leaf, a lower-case hex sha256 of its columns. The leaves of a
group ascend by id; every two consecutive nodes of a level become the hash of
their hex digests (a last one alone, of its own), up to the group's subroot.
The subroots, in the order of their groups, make the root in the same way.

Node j of level l covers leaves [j * 2**l, (j + 1) * 2**l). It is complete once
its last leaf is there, so an append log holds, after each leaf, the nodes that
end with it, from below: leaf i is entry 2 i - popcount(i), and a node stands l
entries after its last leaf (``position``). An aligned range of 2**SPAN leaves
is a subtree whose log is one contiguous segment; builders write segments side
by side. A tier of builders takes the roots of the tier below as its leaves,
until each group is one node. Proofs need no search: the sibling of node j is
j ^ 1, and its entry follows from the subtree sizes alone.

Defined results: null ids come first; rows equal in id follow each other by
digest, so repeated rows are leaves of their own. A null group is a group,
before all others, which go by their UTF-8 bytes. An empty table gives no rows.
Extra columns, whatever their names, take no part.

Scale: whole rows are read once, for their digests; only digests are shuffled,
sorted by (group, id, digest, salt), so that neither a group nor a repeated row
with a third of all rows is one partition. A builder holds at most 2**SPAN
digests, a proof one digest a level. The driver sees one count per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written

#: Levels of one builder: it covers 2**SPAN leaves.
SPAN = 9
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---- the tree ------------------------------------------------------------------

def digest(nodes: list[bytes]) -> bytes:
    """H: sha256 over the digests as hex text."""
    return hashlib.sha256("".join([x.hex() for x in nodes]).encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


def position(level: int, j: int, n: int) -> int:
    """Entry of node j of a level in the log of a tree of n leaves."""
    last = min((j + 1) << level, n) - 1
    return 2 * last - last.bit_count() + level


def siblings(i: int, n: int, levels: int) -> list[int | None]:
    """Log entries of the siblings on the way up from leaf i, one per level;
    None for a last node that is alone."""
    found = []
    for level in range(levels):
        j = (i >> level) ^ 1
        found.append(position(level, j, n) if j << level < n else None)
    return found


def append_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes over ``leaves`` up to ``levels``, in completion order."""
    log: list[bytes] = []
    waiting: list[bytes | None] = [None] * (levels + 1)  # a left node of each level
    for i, node in enumerate(leaves):
        log.append(node)
        for level in range(levels):
            if not (i >> level) & 1 and i + 1 < len(leaves):
                waiting[level] = node
                break
            node = digest([waiting[level], node] if (i >> level) & 1 else [node])
            log.append(node)
    return log


def fold(node: bytes, i: int, path: list[bytes | None]) -> bytes:
    """The root over leaf ``i`` with the given siblings, from below."""
    for sibling in path:
        node = digest([node] if sibling is None else [sibling, node] if i & 1 else [node, sibling])
        i >>= 1
    return node


# ---- leaves ----------------------------------------------------------------------

def _framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """sha256 over all values, each ``-`` if null, else byte count, ``:``, value."""
    return F.unhex(F.sha2(F.concat(*[_framed(v) for v in values]), 256))


def _in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` sorted side by side and written, with i, the place of a row in
    its tree, and n, the size of the tree. Trees follow each other in
    ``order``, which must be total, so that no key is one partition; the driver
    sees one count per partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = written(ordered.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = {r["p"]: r["n"] for r in at.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(counts):
        starts.append((p, before))
        before += counts[p]
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "p long, before long"))
    placed = (at.join(starts, part == F.col("p"))
              .withColumn("g", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "p", "before"))
    trees = written(placed.groupBy(F.col("tree").alias("t")).agg(F.min("g").alias("first"), F.count("*").alias("n")),
                    f"{name}-trees")
    return (placed.join(trees, F.col("tree").eqNullSafe(F.col("t")))
            .withColumn("i", F.col("g") - F.col("first")).drop("t", "g", "first"))


# ---- builders --------------------------------------------------------------------

def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            found, levels = row.column("found")[0].as_py(), row.column("levels")[0].as_py()
            log = append_log([x["h"] for x in found], levels)
            yield pa.RecordBatch.from_arrays([*row.columns, pa.array([log], pa.list_(pa.binary()))],
                                             [*row.schema.names, "log"])


def _segments(leaves: DataFrame, name: str) -> DataFrame:
    """Log segments (tree, n, levels, block, found, log) of one tier: builders
    take aligned ranges of the leaves (tree, n, i, h, carry)."""
    blocks = (leaves.groupBy("tree", "n", F.shiftright("i", SPAN).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("i", "h", "carry"))).alias("found")))
    levels = F.least(F.lit(SPAN), F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0))
    rows = blocks.select("tree", "n", levels.cast("int").alias("levels"), "block", "found")
    schema = f"{rows.schema.simpleString()[7:-1]}, log array<binary>"
    return written(rows.mapInArrow(_build, schema), name)


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The log of every tree over leaves (tree, n, i, h, carry), as tables of
    segments by tier. A tier's leaves are the segment roots of the one below;
    the last tier has one segment, and so the root, of each tree."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers = [_segments(leaves, f"{name}-log0")]
    while most > 1 << SPAN:
        most = -(-most >> SPAN)
        above = tiers[-1].select(
            "tree", F.shiftright(F.col("n") + ((1 << SPAN) - 1), SPAN).alias("n"), F.col("block").alias("i"),
            F.element_at("log", -1).alias("h"), F.lit(None).cast("int").alias("carry"))
        tiers.append(_segments(above, f"{name}-log{len(tiers)}"))
    return tiers


def roots(tiers: list[DataFrame]) -> DataFrame:
    return tiers[-1].select("tree", F.element_at("log", -1).alias("root"))


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every leaf of a segment its siblings up to the root: those within
    the segment, taken by their entries, then those above it."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            leaves, log = row.column("found").flatten(), row.column("log")[0].as_py()
            levels, above = row.column("levels")[0].as_py(), row.column("above")[0].as_py()
            found = [[None if p is None else log[p] for p in siblings(i, len(leaves), levels)] + above
                     for i in range(len(leaves))]
            same = pa.array([0] * len(leaves), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [row.column("tree").take(same), *leaves.flatten(), pa.array(found, pa.list_(pa.binary())),
                 row.column("more").take(same)], ["tree", "i", "h", "carry", "path", "more"])


def paths(tiers: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """(tree, i, h, carry, path, more) for every leaf of the lowest tier; path
    holds one sibling a level, null where a node is alone, then what stands
    above the tree. ``above`` (tree, above, more) gives that and a column to
    pass on."""
    key = F.lit(0).cast("long")
    for k in range(len(tiers) - 1, -1, -1):
        up = above.select(F.col("tree").alias("t"), key.alias("b"), "above", "more")
        rows = tiers[k].join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b"))).drop("t", "b")
        kind = {name: rows.schema[name].dataType.simpleString() for name in ("tree", "more")}
        carried = rows.schema["found"].dataType.elementType["carry"].dataType.simpleString()
        found = rows.mapInArrow(_climb, f"tree {kind['tree']}, i long, h binary, carry {carried}, path array<binary>, "
                                        f"more {kind['more']}")
        if k:
            above = written(found, f"{name}-paths{k}").withColumnRenamed("path", "above")
            key = F.col("i")
    return found


# ---- manifest and proofs ---------------------------------------------------------

def manifest(docs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(log of the languages' trees, log of the tree over their roots), by tier.
    A leaf carries its doc_id and, where the tampering touches it, the digest
    of the tampered row."""
    rows = pick(docs, *FIELDS)
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    touched = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0) & F.col("n_chars").isNotNull()
    changed = F.when(touched, leaf_digest(*[more if c == "n_chars" else F.col(c) for c in FIELDS]))
    leaves = rows.select(F.col("lang").alias("tree"), leaf_digest(*[F.col(c) for c in FIELDS]).alias("h"),
                         F.struct("doc_id", changed.alias("tampered")).alias("carry"),
                         F.monotonically_increasing_id().alias("salt"))
    leaves = written(leaves, "merkle-digests")  # texts are read once; the salt stays what it is
    order = [F.asc_nulls_first("tree"), F.asc_nulls_first("carry.doc_id"), F.asc("h"), F.asc("salt")]
    log = build(_in_order(leaves, order, "merkle-leaves").drop("salt"), "merkle")
    subroots = roots(log).select(F.lit(0).alias("tree"), F.col("root").alias("h"), F.col("tree").alias("carry"))
    top = _in_order(subroots, [F.asc_nulls_first("carry")], "merkle-subroots")
    return log, build(top, "merkle-top")


def proofs(log: list[DataFrame], top_log: list[DataFrame]) -> DataFrame:
    """(doc_id, lang, i, leaf, tampered, path, n, at, subroot, root): every
    leaf, its siblings from below to the root, its place i among the n leaves
    of its language and that language's place among all. Digests are binary."""
    root = top_log[-1].select("tree", F.array().cast("array<binary>").alias("above"),
                              F.element_at("log", -1).alias("more"))
    tops = paths(top_log, root, "merkle-top")
    sizes = log[0].select(F.col("tree").alias("t"), F.col("n").alias("size")).distinct()
    tops = written(tops.join(sizes, F.col("carry").eqNullSafe(F.col("t"))).select(
        F.col("carry").alias("tree"), F.col("path").alias("above"),
        F.struct(F.col("i").alias("at"), F.col("h").alias("subroot"), F.col("more").alias("root"),
                 F.col("size").alias("n")).alias("more")), "merkle-subroots-proved")
    return paths(log, tops, "merkle").select(
        "carry.doc_id", F.col("tree").alias("lang"), "i", F.col("h").alias("leaf"), "carry.tampered", "path",
        "more.n", "more.at", "more.subroot", "more.root")


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashed, folded = [], []
        columns = [batch.column(c).to_pylist() for c in ("leaf", "tampered", "path", "i", "n", "at")]
        for leaf, tampered, path, i, n, at in zip(*columns):
            hashed.append(digest([x for x in path if x is not None]).hex())
            own = height(n)
            subroot = fold(leaf if tampered is None else tampered, i, path[:own])
            folded.append(fold(subroot, at, path[own:]).hex())
        kept = [batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(hashed, pa.string()), pa.array(folded, pa.string())],
                                         ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def verify(found: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    ``proofs``: the root recomputed from the tampered leaf, else the leaf, with
    the original siblings, against the root."""
    kind = found.schema["doc_id"].dataType.simpleString()
    rows = found.select("doc_id", "leaf", "subroot", "root", "tampered", "path", "i", "n", "at").mapInArrow(
        _check, f"doc_id {kind}, leaf binary, subroot binary, root binary, proof_sha256 string, folded_root string")
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return rows.select("doc_id", *hexed, "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified"))
