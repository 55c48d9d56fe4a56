"""Term-frequency rows (JN1, JN2, PR7, PR8, AG2-AG4, FN13, ML2, ML3).

The TF matrix is sparse, one row per document: ``(doc_id, pos[], n[], tf[])``
with the positions ascending, never K-wide dense rows. A document has at most
K entries, so a row is bounded whatever the corpus size.

Plan: documents dealt by id into tasks of bounded text -> texts of an id as one
-> words counted a slice of documents at a time (``operators.slices``), a row
for every distinct word of a slice -> broadcast hash join with the dictionary
(drops out-of-dictionary words, PR7) -> one row a document with at most K
pairs, all in one stage. The rows of an id with too much text for a
task, such as one that covers a third of the input, are dealt by a hash of the
row instead, exploded, combined map-side and shuffled on (doc_id, pos).
A dictionary whose measured size is too large to broadcast is joined by
shuffle: a Bloom filter of its words, ten bits each, leaves out nearly all
other words at the scan, and the rest are counted per document first, so that
neither raw tokens nor out-of-dictionary words cross the network and AQE can
split a word that is in most documents. The L1
denominator is summed in the same aggregation. Written as Parquet, the rows
are read back pruned: statistics and gradient passes read ``pos`` and ``tf``,
document counts no column at all.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termflow import params
from termflow.functions.parse import label_expr
from termflow.functions.text import explode_tokens, spread, spread_by_id
from termflow.operators import slices

#: Bloom filter: bits a word, and bits set in the one 64-bit entry of a word.
BLOOM_BITS, BLOOM_SET = 10, 4


def is_small(lookup: DataFrame, max_rows: int, text_col: str | None = None,
             most: int | None = None) -> bool:
    """Whether a lookup table may be broadcast: at most ``max_rows`` rows by
    construction, plus the measured bytes of its text column (a word has no
    length limit)."""
    size = 32 * max_rows
    if text_col:
        size += lookup.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return size <= (params.BROADCAST_MAX_BYTES if most is None else most)


def _bloom_place(word: Column, size: int) -> tuple[Column, Column]:
    """(entry, mask) of a word in a Bloom filter of ``size`` 64-bit entries:
    six bits of its hash choose each bit of the mask."""
    h, one = F.xxhash64(word), F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for k in range(BLOOM_SET):
        six = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, six))
    return F.pmod(F.shiftrightunsigned(h, 6 * BLOOM_SET), F.lit(size)).cast("int"), mask


def bloom_filter(lookup: DataFrame, word: str, max_rows: int):
    """A predicate on words that holds for every one of ``lookup`` and for few
    others, as built-in expressions over one constant array. The bits (ten for
    each of ``max_rows`` words) are set by one aggregation, a row an entry; a
    filter above ``BROADCAST_MAX_BYTES`` is not built, and every word passes."""
    size = max(1, max_rows * BLOOM_BITS // 64)
    if 8 * size > params.BROADCAST_MAX_BYTES:
        return lambda column: F.lit(True)
    at, mask = _bloom_place(F.col(word), size)
    rows = lookup.select(at.alias("at"), mask.alias("mask")).groupBy("at").agg(F.bit_or("mask").alias("bits")).toPandas()
    bits = np.zeros(size, np.int64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    filled = constant_array(bits, "bigint")

    def may_hold(column: Column) -> Column:
        at, mask = _bloom_place(column, size)
        return F.get(filled, at).bitwiseAND(mask) == mask

    return may_hold


def constant_array(values: np.ndarray, element_type: str) -> Column:
    """A K-vector as one constant array column, indexed by position. It goes
    to Catalyst as one string (``repr`` of a double is exact), which constant
    folding turns into an array literal; it travels to the tasks inside the
    plan, 8 bytes an entry."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast(f"array<{element_type}>")


def _lookup(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("word", F.col("pos").cast("int").alias("pos"))


def _broadcast_counts(docs: DataFrame, lookup: DataFrame) -> DataFrame:
    """(doc_id, pos, n) through a broadcast dictionary, as ``docs`` are dealt."""
    hits = explode_tokens(docs).join(F.broadcast(lookup), "word", "inner")
    return hits.groupBy("doc_id", "pos").agg(F.count(F.lit(1)).alias("n"))


def position_counts(docs: DataFrame, dictionary: DataFrame, k: int, broadcast_bytes: int | None = None) -> DataFrame:
    """JN1+JN2+PR7+PR8+AG2+AG3: (doc_id, pos, n), one row per document and
    dictionary word in it. Repeated doc ids merge (S9). A dictionary above
    ``broadcast_bytes`` (default ``BROADCAST_MAX_BYTES``) is joined by shuffle.
    Documents are spread first: the partial counts of a task hold a row for
    every word of every document it reads."""
    lookup = _lookup(dictionary)
    if is_small(lookup, k, "word", broadcast_bytes):
        return _broadcast_counts(spread(docs), lookup)
    tokens = explode_tokens(spread(docs))
    known = tokens.where(bloom_filter(lookup, "word", k)(F.col("word")))
    pairs = known.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(lookup, "word", "inner").select("doc_id", "pos", "n")


def tf_rows(docs: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """ML2/ML3 (transform): (doc_id, pos[], n[], tf[]) with tf = n /
    in-dictionary tokens of the document (S7). Documents without a dictionary
    word have no row and so drop out of training and scoring (S8). Behind a
    small dictionary all documents are dealt by their id once; the rows of an
    id with too much text for one task go by (doc_id, pos) first."""
    lookup = _lookup(dictionary)
    if not is_small(lookup, k, "word"):
        return _collected(position_counts(docs, dictionary, k))
    dealt, hot = spread_by_id(docs)
    merged = dealt.groupBy("doc_id").agg(F.collect_list("text").alias("texts"), F.count("text").alias("n"))
    texts = merged.where(F.col("n") > 0).select("doc_id", F.concat_ws(" ", "texts").alias("text"))
    rows = slices.document_counts(texts, lookup)
    return rows if hot is None else rows.unionByName(_collected(position_counts(hot, dictionary, k)))


def _collected(counts: DataFrame) -> DataFrame:
    """Counts (doc_id, pos, n) as one row per document."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", "n")))
    grouped = counts.groupBy("doc_id").agg(
        pairs.alias("pairs"), F.sum("n").alias("total"))
    return grouped.select("doc_id", F.col("pairs.pos").alias("pos"), F.col("pairs.n").alias("n"),
                          F.transform("pairs.n", lambda n: n / F.col("total")).alias("tf"))


def entries(rows: DataFrame, *keep: str, values: tuple[str, ...] = ("pos", "tf")) -> DataFrame:
    """The ``values`` arrays as long rows, one per non-zero, beside the
    columns to ``keep``. Only the named columns are read."""
    return rows.select(*keep, F.inline(F.arrays_zip(*values)))


def tf_long(docs: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """The long form of ``tf_rows``: (doc_id, pos, n, tf)."""
    return entries(tf_rows(docs, dictionary, k), "doc_id", values=("pos", "n", "tf"))


def count_documents(rows: DataFrame) -> int:
    """AG5: documents with a TF row (from Parquet, footers answer it)."""
    return int(rows.count())


def dropped_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """S8 report: documents, documents with a TF row, and those dropped."""
    n_docs = docs.select("doc_id").distinct().count()
    n_with = count_documents(rows)
    return docs.sparkSession.createDataFrame(
        [(int(n_docs), n_with, int(n_docs - n_with))],
        "n_docs long, n_with_tf long, n_dropped long")


def vector_layout(size: int, indices: Column, values: Column) -> Column:
    """The struct that Parquet holds of a sparse vector (``VECTORS`` reads it as one)."""
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
                    indices.alias("indices"), values.alias("values"))


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """ML sparse vectors from sorted (indices, values) arrays: the struct
    layout of VectorUDT, type 0 = sparse. ``array_to_vector`` only makes dense
    ones; a struct turns into a vector where it is read under that type, here
    from JSON, which writes a double so that it reads back to the same bits.
    Row by row, without a Python worker."""
    typed = T.StructType([T.StructField("v", VectorUDT())])
    laid = F.struct(vector_layout(size, indices, values).alias("v"))
    return F.from_json(F.to_json(laid), typed, {"mode": "FAILFAST"})["v"]


#: What ``tf_vectors`` and ``selected_vectors`` give.
VECTORS = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("label", T.DoubleType()),
                        T.StructField("features", VectorUDT())])


def tf_vectors(rows: DataFrame, size: int, prefix: str = params.REFERENCE_LABEL_PREFIX,
               build=sparse_vector) -> DataFrame:
    """FN13: (doc_id, label DOUBLE, features VECTOR) for Spark ML, row by row
    from the TF arrays. With ``build=vector_layout`` the features are ready to
    be written as Parquet and read under the schema ``VECTORS``, which spares
    the way through JSON."""
    return rows.select(
        "doc_id",
        label_expr(F.col("doc_id"), prefix).cast("double").alias("label"),
        build(size, F.col("pos"), F.col("tf")).alias("features"),
    )


def selected_vectors(rows: DataFrame, selected: DataFrame, m: int,
                     prefix: str = params.REFERENCE_LABEL_PREFIX, build=sparse_vector) -> DataFrame:
    """FN14/ML5 for Spark ML: (doc_id, label, features) with the ``m``
    selected positions renumbered by ``new_pos`` (falling variance, not
    re-normalised, S19). Every document with a TF row keeps a vector, an
    all-zero one when none of its words was selected, as when a full row is
    sliced. The selection (at most M rows) comes to the driver and goes out
    as a constant array, so the pass is row by row, without a shuffle, and
    linear in the non-zeros (``VectorSlicer`` on sparse vectors searches every
    selected index per row)."""
    chosen = selected.select("pos", "new_pos").toPandas()
    new_pos = np.full(int(chosen["pos"].max()) + 1 if len(chosen) else 1, -1)
    new_pos[chosen["pos"].to_numpy(dtype=np.int64)] = chosen["new_pos"].to_numpy()
    lookup = constant_array(new_pos, "int")
    moved = F.zip_with("pos", "tf", lambda p, t: F.struct(
        F.coalesce(F.get(lookup, p), F.lit(-1)).alias("i"), t.alias("v")))
    kept = rows.select("doc_id", F.sort_array(F.filter(moved, lambda x: x["i"] >= 0)).alias("pairs"))
    return kept.select(
        "doc_id",
        label_expr(F.col("doc_id"), prefix).cast("double").alias("label"),
        build(m, F.col("pairs.i"), F.col("pairs.v")).alias("features"),
    )
