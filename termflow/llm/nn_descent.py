"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour
graph, queries walk it greedily.

Graph: every vector starts with its nearest ones of two random blocks. In each
round a vector's neighbours, and those whose neighbour it is, meet and are
compared (neighbours of neighbours); pairs nearer than a vector's worst
neighbour replace it. Only pairs with a new neighbour are compared, of each
vector SAMPLE new and SAMPLE old ones on either side; the rest take their turn
later. Rounds end when few neighbours change.

Search: a beam of the nearest vectors seen so far starts at the nearest of some
fixed entry points, and at the query itself if it is indexed; each step looks
at the links of the nearest ones not yet looked at, until none is left. Links
are neighbours, reverse neighbours and the best few of the random blocks, which
lead from region to region. The nearest of the beam are then scored exactly, in
double precision on the original vectors.

Comparisons on the way use vectors of one byte a component, since every
neighbour's vector travels to where it is compared.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without an id, take no part. Shorter vectors count as
filled up with zeros. Of rows with one id the smallest vector counts, so
repeated rows are one. Equal vectors are one node of the graph, and results
name each of them; ties go to the smaller id. A table of one vector or none
gives no rows. Extra columns, whatever their names, take no part.

Scale: equal vectors collapse to their k + 1 smallest ids before anything
else (a partial aggregate), so a vector that a third of all rows share is one
node. Groups are bounded: a block by its hash, the meetings of a vector by
4 * SAMPLE, its candidates by NEIGHBOURS, both cut before the shuffle; a hub is
met by many but holds no more. The driver sees the entry points and counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import mix
from .common import delete, pick, release, scratch_path, written

#: Neighbours of a vector; how many new, and old, ones join in a round.
NEIGHBOURS, SAMPLE = 32, 14
#: Vectors of a random block; rounds at most; share of changes that ends them.
BLOCK, ROUNDS, SETTLED = 4096, 12, 0.04
#: Links of the random block kept for the search; entry points in all, and taken by a query.
FAR_LINKS, ENTRIES, ENTRIES_TAKEN = 4, 1024, 16
#: Beam width, vectors looked at in a step, steps at most, vectors scored exactly.
BEAM, STEP, STEPS, SCORED = 320, 48, 40, 32
#: Groups, or rows of a block, compared at a time.
AT_ONCE = 128

OLD, WAITING, JOINS_NEW, JOINS_OLD = 0, 1, 2, 3


# ---- vectors ---------------------------------------------------------------------

def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): one row per id, with vectors that have a direction."""
    rows = pick(vectors, id_col, vector).toDF("id", "v")
    rows = rows.withColumn("v", F.col("v").cast("array<float>") if "array<float>" in dict(rows.dtypes)["v"]
                           else F.col("v").cast("array<double>"))
    good = F.col("id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(good, F.lit(False))).groupBy("id").agg(F.min("v").alias("v"))


def _dense(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), kind)
    out[np.arange(dim) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _bytes(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column of one-byte vectors, scaled to length 1."""
    data = b"".join(column.to_pylist())
    x = np.frombuffer(data, np.int8).reshape(-1, dim).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _shrink(dim: int):
    """Vectors in one byte a component; the largest becomes 127."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _dense(batch.column("v"), dim)
            x = np.rint(x / np.abs(x).max(axis=1, keepdims=True) * 127).astype(np.int8)
            small = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), small], ["node", "q"])
    return run


class Index:
    """Tables in the shared folder: ``nodes`` (node, v), ``small`` (node, q),
    ``members`` (node, id: the least ids of a node), ``links`` (node, links),
    ``graph`` (node, nbr, sim) and the entry points."""

    def __init__(self, **parts):
        self.__dict__.update(parts)


# ---- graph -----------------------------------------------------------------------

def _top(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int, *more: np.ndarray) -> list[np.ndarray]:
    """The ``most`` nearest of each owner, nearest first; of entries equal in
    owner and id the first given."""
    order = np.lexsort((np.arange(len(ids)), ids, owner))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    order = order[new]
    order = order[np.lexsort((ids[order], -sims[order], owner[order]))]
    mine = owner[order]
    place = np.arange(len(mine)) - np.searchsorted(mine, mine)
    order = order[place < most]
    return [x[order] for x in (owner, ids, sims, *more)]


def _lists(owner: np.ndarray, n: int, *values: np.ndarray) -> list[pa.Array]:
    ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in values]


def _flags(owner: np.ndarray, ids: np.ndarray, flag: np.ndarray, turn: int, sample: int) -> np.ndarray:
    """Who joins the next round: of each owner ``sample`` new and old ones."""
    fresh = (flag == WAITING).astype(np.int64)
    order = np.lexsort((mix(ids.astype(np.uint64) + np.uint64(turn * 7919)), fresh, owner))
    group = (owner * 2 + fresh)[order]
    place = np.arange(len(group)) - np.searchsorted(group, group)
    out = flag.copy()
    joins = order[place < sample]
    out[joins] = np.where(flag[joins] == WAITING, JOINS_NEW, JOINS_OLD)
    return out


def _graph_rows(node, q, owner, ids, sims, flag) -> pa.RecordBatch:
    nbr, sim, flags = _lists(owner, len(node), ids, sims.astype(np.float32), flag.astype(np.int8))
    return pa.RecordBatch.from_arrays([node, q, nbr, sim, flags], ["node", "q", "nbr", "sim", "flag"])


GRAPH = "node long, q binary, nbr array<long>, sim array<float>, flag array<tinyint>"


def _start(dim: int, most: int, sample: int):
    """The nearest of each member of a block within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                members = batch.column("members").slice(k, 1).flatten()
                node, q = members.field("node"), members.field("q")
                x, ids = _bytes(q, dim), node.to_numpy()
                n, kept = len(ids), min(most, len(ids) - 1)
                found, values = np.empty((n, kept), np.int64), np.empty((n, kept), np.float32)
                for lo in range(0, n, AT_ONCE):
                    sims = x[lo:lo + AT_ONCE] @ x.T
                    sims[np.arange(len(sims)), lo + np.arange(len(sims))] = -4
                    near = np.argpartition(-sims, max(kept - 1, 0), axis=1)[:, :kept]
                    found[lo:lo + AT_ONCE], values[lo:lo + AT_ONCE] = ids[near], np.take_along_axis(sims, near, 1)
                owner, found, values = _top(np.repeat(np.arange(n), kept), found.ravel(), values.ravel(), kept)
                flag = _flags(owner, found, np.full(len(found), WAITING), 0, sample)
                yield _graph_rows(node, q, owner, found, values, flag)
    return run


def _meet(dim: int):
    """Compares the members met at a node; gives pairs with a new member that
    are nearer than one's worst neighbour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                lists = whole.column("members").slice(lo, AT_ONCE)
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                members = lists.flatten()
                there = np.arange(size.max()) < size[:, None]
                x = np.zeros((*there.shape, dim), np.float32)
                x[there] = _bytes(members.field("q"), dim)
                ids, worst, new = np.full(there.shape, -1), np.full(there.shape, 9, np.float32), np.zeros(there.shape, bool)
                ids[there] = members.field("u").to_numpy()
                worst[there] = members.field("worst").to_numpy()
                new[there] = members.field("new").to_numpy(zero_copy_only=False)
                sims = x @ x.transpose(0, 2, 1)
                pair = there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :])
                pair &= (ids[:, :, None] != ids[:, None, :]) & (sims > worst[:, :, None])
                g, a, b = np.nonzero(pair)
                a, b, s = ids[g, a], ids[g, b], sims[g, a, b]
                order = np.lexsort((b, a))
                first = np.ones(len(order), bool)
                first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
                order = order[first]
                yield pa.RecordBatch.from_arrays([pa.array(a[order]), pa.array(b[order]), pa.array(s[order])],
                                                 ["node", "nbr", "sim"])
    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(owner of each element, elements) of a list column; null is empty."""
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.repeat(np.arange(len(column)), size), column.flatten()


def _improve(most: int, sample: int, turn: int):
    """Neighbours and candidates merged; who joins the next round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, ids = _flat(batch.column("nbr"))
            flag = batch.column("flag").flatten().to_numpy()
            flag = np.where(flag >= JOINS_NEW, OLD, flag) if turn else np.full(len(flag), WAITING)
            more, found = _flat(batch.column("found"))
            every = [np.concatenate(x) for x in (
                (owner, more), (ids.to_numpy(), found.field("nbr").to_numpy()),
                (batch.column("sim").flatten().to_numpy(), found.field("sim").to_numpy()),
                (flag, np.full(len(more), WAITING)))]
            owner, ids, sims, flag = _top(*every[:3], most, every[3])
            yield _graph_rows(batch.column("node"), batch.column("q"), owner, ids, sims,
                              _flags(owner, ids, flag, turn, sample))
    return run


def _meetings(graph: DataFrame, sample: int, turn: int) -> DataFrame:
    """(m, u, new): members that meet at m in this round, its own neighbours
    and then those whose neighbour it is, only where one is new."""
    edges = graph.select("node", F.inline(F.arrays_zip("nbr", "flag"))).where(F.col("flag") >= JOINS_NEW)
    new = (F.col("flag") == JOINS_NEW).alias("new")
    both = (edges.select(F.col("node").alias("m"), F.col("nbr").alias("u"), new, F.lit(0).alias("back"))
            .union(edges.select(F.col("nbr").alias("m"), F.col("node").alias("u"), new, F.lit(1).alias("back"))))
    turn_order = Window.partitionBy("m").orderBy("back", F.desc("new"), F.xxhash64("u", F.lit(turn)))
    met = (both.withColumn("k", F.row_number().over(turn_order)).where(F.col("k") <= 4 * sample)
           .groupBy("m").agg(F.collect_list(F.struct("u", "new")).alias("members")))
    return met.where(F.exists("members", lambda x: x["new"])).select("m", F.inline("members"))


def _round(graph: DataFrame, dim: int, turn: int, neighbours: int, sample: int) -> DataFrame:
    worst = F.when(F.size("sim") < neighbours, F.lit(-2.0)).otherwise(F.element_at("sim", -1)).cast("float")
    known = graph.select(F.col("node").alias("u"), "q", worst.alias("worst"))
    groups = (_meetings(graph, sample, turn).join(known, "u").groupBy("m")
              .agg(F.collect_list(F.struct("u", "new", "worst", "q")).alias("members")))
    pairs = groups.select("members").mapInArrow(_meet(dim), "node long, nbr long, sim float")
    nearest = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    found = (pairs.withColumn("k", F.dense_rank().over(nearest)).where(F.col("k") <= neighbours)
             .groupBy("node").agg(F.collect_list(F.struct("nbr", "sim")).alias("found")))
    none = F.array().cast("array<struct<nbr:bigint,sim:float>>")
    return (graph.join(found, "node", "left").withColumn("found", F.coalesce("found", none))
            .mapInArrow(_improve(neighbours, sample, turn), GRAPH))


def build(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 5,
          neighbours: int = NEIGHBOURS, sample: int = SAMPLE) -> Index:
    """The index of all usable ``vectors``, for searches of up to ``k``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vector), "nn-rows")
    least = Window.partitionBy("v").orderBy("id")
    # The k + 1 smallest ids of equal vectors: a query leaves out its own.
    members = written(rows.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
                      .withColumn("node", F.min("id").over(Window.partitionBy("v"))), "nn-members")
    nodes = members.where(F.col("place") == 1).select("node", "v")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 1
    small = written(nodes.mapInArrow(_shrink(dim), "node long, q binary"), "nn-small")
    parts = max(1, round(n / BLOCK))

    def started(seed: int) -> DataFrame:
        block = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(parts))
        blocks = small.groupBy(block.alias("block")).agg(F.collect_list(F.struct("node", "q")).alias("members"))
        return blocks.select("members").mapInArrow(_start(dim, neighbours, sample), GRAPH)

    path = scratch_path(spark, "nn-graph")
    graph = started(11)
    if parts > 1:  # blocks of a second hash tie those of the first together
        more = started(12).select("node", F.arrays_zip("nbr", "sim").alias("found"))
        graph = graph.join(more, "node").mapInArrow(_improve(neighbours, sample, 0), GRAPH)
    graph.write.parquet(path)
    graph = spark.read.schema(GRAPH).parquet(path)
    far = written(graph.select("node", F.slice("nbr", 1, FAR_LINKS).alias("far")), "nn-far")
    for turn in range(1, ROUNDS + 1):
        fresh = scratch_path(spark, "nn-graph")
        _round(graph, dim, turn, neighbours, sample).write.parquet(fresh)
        delete(spark, path)
        graph, path = spark.read.schema(GRAPH).parquet(fresh), fresh
        changed = graph.agg(F.sum(F.size(F.filter("flag", lambda x: x.isin(WAITING, JOINS_NEW))))).first()[0] or 0
        release(spark)
        if changed <= SETTLED * n * neighbours:
            break
    entries = [(r["node"], bytes(r["q"])) for r in small.orderBy(F.xxhash64("node", F.lit(5))).limit(ENTRIES).collect()]
    return Index(nodes=nodes, small=small, members=members.select("node", "id"), dim=dim, k=k, entries=entries,
                 graph=graph.select("node", "nbr", "sim"), links=written(_links(graph, far, neighbours), "nn-links"))


def _links(graph: DataFrame, far: DataFrame, neighbours: int) -> DataFrame:
    """(node, links): neighbours, the nearest of those whose neighbour it is,
    and the best few of the random block."""
    edges = graph.select("node", F.inline(F.arrays_zip("nbr", "sim")))
    nearest = Window.partitionBy("nbr").orderBy(F.desc("sim"), "node")
    back = (edges.withColumn("k", F.row_number().over(nearest)).where(F.col("k") <= neighbours)
            .groupBy(F.col("nbr").alias("node")).agg(F.collect_list(F.col("node")).alias("back")))
    none = F.array().cast("array<long>")
    return (graph.join(far, "node").join(back, "node", "left")
            .select("node", F.array_distinct(F.concat("nbr", "far", F.coalesce("back", none))).alias("links")))


# ---- search ----------------------------------------------------------------------

STATE = "query long, q binary, ids array<long>, sims array<float>, open array<boolean>"


def _enter(entries: list[tuple[int, bytes]], dim: int):
    ids = np.array([i for i, _ in entries], np.int64)
    rows = pa.array([q for _, q in entries], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _bytes(rows, dim)
        taken = min(ENTRIES_TAKEN, len(ids))
        for batch in batches:
            n, own = batch.num_rows, batch.column("node")
            sims = _bytes(batch.column("q"), dim) @ x.T
            near = np.argpartition(-sims, taken - 1, axis=1)[:, :taken]
            mine = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            owner, found, values = _top(
                np.concatenate([mine, np.repeat(np.arange(n), taken)]),
                np.concatenate([own.drop_null().to_numpy(), ids[near].ravel()]),
                np.concatenate([np.ones(len(mine), np.float32), np.take_along_axis(sims, near, 1).ravel()]), BEAM)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("q"), *_lists(owner, n, found, values.astype(np.float32),
                                                                  np.ones(len(found), bool))],
                ["query", "q", "ids", "sims", "open"])
    return run


def _to_open(ids: Column, is_open: Column) -> Column:
    """The nearest STEP of a beam that were not looked at yet."""
    return F.slice(F.filter(F.transform(F.arrays_zip(ids.alias("i"), is_open.alias("o")),
                                        lambda x: F.when(x["o"], x["i"])), lambda x: x.isNotNull()), 1, STEP)


def _step(dim: int):
    """Beams with what was found in this step; the nearest STEP are now seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(lo, AT_ONCE)
                n = batch.num_rows
                owner, ids = _flat(batch.column("ids"))
                sims = batch.column("sims").flatten().to_numpy()
                is_open = batch.column("open").flatten().to_numpy(zero_copy_only=False)
                place = np.cumsum(is_open) - is_open
                start = np.searchsorted(owner, owner)
                is_open = is_open & (place - place[start] >= STEP) if len(owner) else is_open
                more, found = _flat(batch.column("found"))
                x, y = _bytes(batch.column("q"), dim), _bytes(found.field("q"), dim)
                near = np.einsum("ij,ij->i", x[more], y)
                owner, ids, sims, is_open = _top(
                    np.concatenate([owner, more]), np.concatenate([ids.to_numpy(), found.field("node").to_numpy()]),
                    np.concatenate([sims, near]), BEAM, np.concatenate([is_open, np.ones(len(more), bool)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("q"), *_lists(owner, n, ids, sims.astype(np.float32), is_open)],
                    ["query", "q", "ids", "sims", "open"])
    return run


def _score(dim: int):
    """Exact cosines; powers of two keep squares of any size finite."""
    def scaled(x: np.ndarray) -> np.ndarray:
        return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(lo, AT_ONCE)
                owner, found = _flat(batch.column("found"))
                x, y = scaled(_dense(batch.column("v"), dim)), scaled(_dense(found.field("v"), dim))
                x = x[owner]
                cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query").take(pa.array(owner)), found.field("node"), pa.array(cosine)],
                    ["query", "node", "score"])
    return run


def search(index: Index, queries: DataFrame, k: int | None = None) -> DataFrame:
    """(query, node, score) for queries (query, v, node): the ``k`` + 1 nearest
    distinct vectors found, query being unique and node the query's own in the
    index, else null."""
    spark, dim, k = queries.sparkSession, index.dim, k or index.k
    if not index.entries:
        return spark.createDataFrame([], "query long, node long, score double")
    asked = written(queries.select("query", "node", "v"), "nn-queries")
    small = asked.select(F.col("query").alias("node"), "v").mapInArrow(_shrink(dim), "node long, q binary")
    small = small.withColumnRenamed("node", "query").join(asked.select("query", "node"), "query")
    path = scratch_path(spark, "nn-beams")
    small.mapInArrow(_enter(index.entries, dim), STATE).write.parquet(path)
    beams = spark.read.schema(STATE).parquet(path)
    for _ in range(STEPS):
        looked = beams.select("query", F.explode(_to_open(F.col("ids"), F.col("open"))).alias("node"))
        seen = looked.join(index.links, "node").select("query", F.explode("links").alias("node")).distinct()
        found = (seen.join(index.small, "node").groupBy(F.col("query").alias("asker"))
                 .agg(F.collect_list(F.struct("node", "q")).alias("found")))
        none = F.array().cast("array<struct<node:bigint,q:binary>>")
        fresh = scratch_path(spark, "nn-beams")
        (beams.join(found, F.col("query") == F.col("asker"), "left").drop("asker")
         .withColumn("found", F.coalesce("found", none)).mapInArrow(_step(dim), STATE).write.parquet(fresh))
        delete(spark, path)
        beams, path = spark.read.schema(STATE).parquet(fresh), fresh
        release(spark)
        if beams.where(F.exists("open", lambda x: x)).isEmpty():
            break
    best = beams.select("query", F.explode(F.slice("ids", 1, max(SCORED, 2 * k))).alias("node"))
    near = (best.join(index.nodes, "node").groupBy(F.col("query").alias("asker"))
            .agg(F.collect_list(F.struct("node", "v")).alias("found")))
    scored = (asked.select("query", "v").join(near, F.col("query") == F.col("asker")).drop("asker")
              .mapInArrow(_score(dim), "query long, node long, score double"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return scored.withColumn("k", F.row_number().over(order)).where(F.col("k") <= k + 1).drop("k")


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): of every usable row whose id meets
    ``is_query`` (over a column ``id``) the ``k`` nearest other rows found."""
    index = build(vectors, id_col, vector, k)
    asks = usable(vectors, id_col, vector).where(is_query)
    own = index.nodes.select("node", F.col("v").alias("w"))
    asks = written(asks.join(own, F.col("v") == F.col("w")).select("id", "node"), "nn-asks")
    # Equal queries are one search.
    once = asks.select("node").distinct().join(index.nodes, "node").select(F.col("node").alias("query"), "node", "v")
    found = written(search(index, once, k), "nn-found")
    named = found.join(index.members, "node").select(F.col("query").alias("node"), F.col("id").alias("vec_id"), "score")
    every = asks.withColumnRenamed("id", "query_id").join(named, "node").where(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
