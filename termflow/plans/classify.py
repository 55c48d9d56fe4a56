"""End-to-end plans: featurise a train/test corpus, fit the classifiers,
evaluate and compare them (ML1-ML5 wiring, ML25, EX1-EX3).

``Pipeline`` holds the fitted pieces (dictionary, selection, GD weights, ML
models) for one corpus so that several reports reuse them; every data-sized
object stays a DataFrame.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termflow import params
from termflow.operators import blocks, certify, evaluate, gd, ml, selection, tf
from termflow.operators.dictionary import dictionary_from_counts, word_counts
from termflow.session import materialize, scratch_path, write_and_read
from termflow.functions.parse import Quarantine, label_expr, parse_doc_lines, quarantine_doc_lines
from termflow.sources.corpus import documents_corpus, read_doc_lines, split_corpus


#: Label-1 prefix of the documents table as a corpus (FIXTURES.md): English documents.
DOCUMENTS_PREFIX = "EN"


@dataclass(frozen=True)
class Preset:
    """Parameters of one run. The defaults mirror the reference (K = 20,000
    words, M = 10,000 features, tolerance 0.1, label prefix ``AU``)."""
    k: int = params.DICTIONARY_SIZE
    m: int = params.SELECTED_FEATURES
    prefix: str = params.REFERENCE_LABEL_PREFIX
    test_every: int = 5
    learning_rate: float = 0.5
    iterations: int = 3
    reg: float = 0.001
    tol: float = params.GD_TOLERANCE
    persist: str = "checkpoint"
    gradient_tasks: int | None = None   # tasks of a gradient pass; None = the cluster's slots


@dataclass
class Corpus:
    all_docs: DataFrame
    train: DataFrame
    test: DataFrame
    quarantine: dict[str, Quarantine] = field(default_factory=dict)  # by side, when lines may be left out


def load_corpus(spark: SparkSession, sf_dir: str, preset: Preset) -> Corpus:
    docs = documents_corpus(spark, sf_dir)
    train, test = split_corpus(docs, preset.test_every)
    return Corpus(all_docs=docs.select("doc_id", "text"), train=train, test=test)


def lines_corpus(spark: SparkSession, train_path: str, test_path: str,
                 mode: str = "FAILFAST", rejects: str | None = None) -> Corpus:
    """The reference's input: two text corpora of document lines (IO1, IO2,
    PR1-PR4). With DROPMALFORMED the lines left out are counted and kept, by
    side, below ``rejects`` (default: the shared checkpoint folder)."""
    sides = {"train": read_doc_lines(spark, train_path), "test": read_doc_lines(spark, test_path)}
    if mode != "DROPMALFORMED":
        train, test = (parse_doc_lines(lines, mode) for lines in sides.values())
        return Corpus(all_docs=train.unionByName(test), train=train, test=test)
    root = rejects.rstrip("/") if rejects else scratch_path(spark, "rejects")
    kept = {side: quarantine_doc_lines(lines, f"{root}/{side}") for side, lines in sides.items()}
    train, test = kept["train"].docs, kept["test"].docs
    return Corpus(all_docs=train.unionByName(test), train=train, test=test, quarantine=kept)


def line_report(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """(side, n_lines, n_ok, n_bad, n_null): what became of every line."""
    rows = [(side, sum(q.counts.values()), q.counts["n_ok"], q.counts["n_bad"], q.counts["n_null"])
            for side, q in corpus.quarantine.items()]
    return spark.createDataFrame(rows, "side string, n_lines long, n_ok long, n_bad long, n_null long")


@dataclass
class Pipeline:
    spark: SparkSession
    corpus: Corpus
    preset: Preset
    cache_vectors: bool = True   # whether several models read the vectors
    _cache: dict = field(default_factory=dict)

    # ---- featurisation ---------------------------------------------------------
    @property
    def word_counts(self) -> DataFrame:
        """AG1 over the training corpus, written once to the shared folder:
        the word-count report and the dictionary share one corpus pass."""
        if "counts" not in self._cache:
            self._cache["counts"] = materialize(word_counts(self.corpus.train), self.preset.persist)
        return self._cache["counts"]

    @property
    def dictionary(self) -> DataFrame:
        if "dictionary" not in self._cache:
            self._cache["dictionary"] = dictionary_from_counts(self.word_counts, self.preset.k)
        return self._cache["dictionary"]

    @property
    def size(self) -> int:
        """Dictionary size: min(K, vocabulary) (S6)."""
        if "size" not in self._cache:
            self._cache["size"] = int(self.dictionary.count())
        return self._cache["size"]

    def rows(self, side: str) -> DataFrame:
        """TF rows of one side, one per document, written once as Parquet to
        the shared folder (EX1/EX2): every later stage (statistics, selection,
        each GD pass, vectors) reads only the columns it uses, and a lost
        executor does not force re-tokenising the corpus."""
        key = ("rows", side)
        if key not in self._cache:
            docs = self.corpus.train if side == "train" else self.corpus.test
            built = tf.tf_rows(docs, self.dictionary, self.size)
            if self.preset.persist != "none":
                seen = Observation(f"tf-{side}")
                built = write_and_read(built, f"tf-{side}", seen, F.sum(F.size("pos")).alias("e"), F.count(F.lit(1)).alias("d"))
                self._cache["counts", side] = (int(seen.get["e"] or 0), int(seen.get["d"]))
            self._cache[key] = built
        return self._cache[key]

    def tf_long(self, side: str) -> DataFrame:
        """The long form (doc_id, pos, n, tf) of one side."""
        return tf.entries(self.rows(side), "doc_id", values=("pos", "n", "tf"))

    def counts(self, side: str) -> tuple[int, int]:
        """(TF entries, documents with a TF row) of one side, counted by the
        write of its rows."""
        key = ("counts", side)
        rows = self.rows(side)
        if key not in self._cache:
            size = rows.agg(F.coalesce(F.sum(F.size("pos")), F.lit(0)).alias("e"),
                                       F.count(F.lit(1)).alias("d")).first()
            self._cache[key] = (int(size.e), int(size.d))
        return self._cache[key]

    def stats(self) -> DataFrame:
        return selection.feature_stats(self.rows("train"), self.counts("train")[1])

    @property
    def selected(self) -> DataFrame:
        if "selected" not in self._cache:
            self._cache["selected"] = selection.select_by_variance(self.stats(), self.preset.m)
        return self._cache["selected"]

    @property
    def m_size(self) -> int:
        if "m_size" not in self._cache:
            self._cache["m_size"] = int(self.selected.count())
        return self._cache["m_size"]

    def tf_reduced(self, side: str) -> DataFrame:
        return selection.apply_selection(self.rows(side), self.selected, self.m_size)

    def vectors(self, side: str, features: str, build=tf.sparse_vector) -> DataFrame:
        """(doc_id, label, features) for ``side`` in {train, test} over the
        full dictionary (``full``) or the variance selection (``reduced``).

        Reduced vectors keep every document with a TF row, as the reference
        slices each document's full row: a document none of whose words was
        selected keeps an all-zero vector instead of dropping out."""
        if features == "full":
            return tf.tf_vectors(self.rows(side), self.size, self.preset.prefix, build)
        return tf.selected_vectors(self.rows(side), self.selected, self.m_size, self.preset.prefix, build)

    # ---- gradient descent ------------------------------------------------------
    def gd_model(self, tol: float | None = None, log: str | None = None) -> gd.GdModel:
        p = self.preset
        tol = p.tol if tol is None else tol
        key = ("gd", tol)
        if key not in self._cache:
            self._cache[key] = gd.fit_gd(self.rows("train"), self.size, p.learning_rate,
                                         p.iterations, p.reg, tol, p.prefix, tasks=p.gradient_tasks, log=log)
        return self._cache[key]

    def gd_predictions(self) -> DataFrame:
        return gd.predict_gd(self.rows("test"), self.gd_model(), self.preset.prefix)

    # ---- Spark ML --------------------------------------------------------------
    def prepare(self, features: str) -> None:
        """Everything up to the written vectors: dictionary, TF rows of both
        sides, and the selection for reduced features."""
        for side in ("train", "test"):
            self.rows(side)
        if features == "reduced":
            self.m_size
        self.ml_vectors(features)

    def ml_vectors(self, features: str) -> tuple[DataFrame, DataFrame]:
        """(train, test) vectors of one feature set, written once, and cached as
        they are read back at the TF rows' parallelism; shared by the LR and
        SVM runs (EX1/EX2) until ``release`` frees them. A pipeline of one model
        reads them without ``cache_vectors``: the fit caches blocks of its own,
        and the memory is theirs."""
        key = ("vectors", features)
        if key not in self._cache:
            stored = (self.stored_vectors(side, features) for side in ("train", "test"))
            self._cache[key] = tuple(frame.cache() if self.cache_vectors else frame for frame in stored)
        return self._cache[key]

    def stored_vectors(self, side: str, features: str) -> DataFrame:
        """The rows of ``vectors``, by way of Parquet."""
        laid = self.vectors(side, features, tf.vector_layout)
        return write_and_read(laid, f"vectors-{side}", schema=tf.VECTORS)

    def packed(self) -> DataFrame:
        """The training side as blocks (``operators.blocks``), cached until
        ``release``."""
        if "packed" not in self._cache:
            self._cache["packed"] = blocks.pack(self.rows("train"), self.label).cache()
        return self._cache["packed"]

    @property
    def label(self) -> Column:
        return label_expr(F.col("doc_id"), self.preset.prefix)

    def fitted_weights(self, kind: str, features: str) -> tuple[np.ndarray, float]:
        """(weights by dictionary position, intercept) of a fit."""
        model = self.ml_run(kind, features)["fitted"]
        selected = self.selected if features == "reduced" else None
        return certify.full_weights(model.coefficients.toArray(), self.size, selected), float(model.intercept)

    def certificate(self, kind: str, features: str) -> certify.Certificate:
        """How far the fit can be from its optimum (ML16, ML18)."""
        weights, intercept = self.fitted_weights(kind, features)
        free = None
        if features == "reduced":
            free = np.zeros(self.size, bool)
            free[self.selected.select("pos").toPandas()["pos"].to_numpy(dtype=np.int64)] = True
        return certify.certify(self.packed(), kind, weights, intercept, self.preset.gradient_tasks, free)

    def release(self) -> None:
        """Unpersist every cached vector frame and block."""
        if "packed" in self._cache:
            self._cache.pop("packed").unpersist()
        for key in [k for k in self._cache if k[0] == "vectors"]:
            for frame in self._cache.pop(key):
                frame.unpersist()

    def ml_run(self, kind: str, features: str) -> dict:
        """Fit ``kind`` (lr | svm) on ``features`` (full | reduced) and score
        the test side, both timed by their own jobs. Once both kinds have run,
        the vectors of that feature set are unpersisted."""
        key = ("ml", kind, features)
        if key in self._cache:
            return self._cache[key]
        train, test = self.ml_vectors(features)
        started = time.perf_counter()
        model = ml.ESTIMATORS[kind](train)
        fitted = time.perf_counter()
        metrics = evaluate.class_metrics(ml.score(model, test)).first().asDict()
        scored = time.perf_counter()
        losses = list(model.summary().objectiveHistory if callable(model.summary)
                      else model.summary.objectiveHistory)
        self._cache[key] = {"model": kind, "features": features, **metrics, "fitted": model,
                            "loss_fell": losses[-1] < losses[0],
                            "train_sec": fitted - started, "test_sec": scored - fitted,
                            "train_rows": self.counts("train")[1], "test_rows": sum(metrics[c] for c in ("tn", "fp", "fn", "tp"))}
        if all(("ml", other, features) in self._cache for other in ml.ESTIMATORS):
            for frame in self._cache.pop(("vectors", features)):
                frame.unpersist()
        return self._cache[key]


def timed_run(fresh: Pipeline, kind: str, features: str) -> dict:
    """EX3: one whole run of a ``fresh`` pipeline, which has computed nothing
    yet, so that its times do not depend on what ran before. Every phase is
    timed by the jobs it needs anyway, and none is forced: preprocessing goes
    from reading the corpora to the written TF rows of both sides, the
    selection and the written vectors, and its rows are counted by the write
    of TF rows; the fit reads the vectors and caches its own blocks of them,
    which it unpersists at its end. The jobs of a phase carry its name as a
    tag."""
    session, started = fresh.spark, time.perf_counter()
    fresh.cache_vectors = False

    def tagged(name: str, work):
        tag = f"termflow-{kind}-{features}-{name}"
        session.addTag(tag)
        try:
            return work()
        finally:
            session.removeTag(tag)

    tagged("preprocess", lambda: fresh.prepare(features))
    prepared = time.perf_counter()
    run = tagged("fit-and-score", lambda: fresh.ml_run(kind, features))
    fresh.release()
    rows = sum(fresh.counts(side)[1] for side in ("train", "test"))
    return {**run, "preprocess_rows": rows, "preprocess_sec": prepared - started, "total_sec": time.perf_counter() - started}


METRIC_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("features", T.StringType(), False),
    T.StructField("tn", T.LongType(), False),
    T.StructField("fp", T.LongType(), False),
    T.StructField("fn", T.LongType(), False),
    T.StructField("tp", T.LongType(), False),
    T.StructField("accuracy", T.DoubleType(), False),
    T.StructField("precision", T.DoubleType(), False),
    T.StructField("recall", T.DoubleType(), False),
    T.StructField("f_measure", T.DoubleType(), False),
])
TIMING_FIELDS = [T.StructField(n, T.DoubleType(), False)
                 for n in ("preprocess_sec", "train_sec", "test_sec", "total_sec")]
ROW_FIELDS = [T.StructField(n, T.LongType(), False) for n in ("preprocess_rows", "train_rows", "test_rows")]


def metrics_frame(spark: SparkSession, runs: list[dict], with_timing: bool = False) -> DataFrame:
    """ML25: one row per model run (a bounded, driver-sized report)."""
    schema = T.StructType(METRIC_SCHEMA.fields + (ROW_FIELDS + TIMING_FIELDS if with_timing else []))
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in runs], schema)


def pipeline(spark: SparkSession, sf_dir: str, preset: Preset | None = None) -> Pipeline:
    """A fresh pipeline over the documents table of ``sf_dir``."""
    preset = preset or Preset(prefix=DOCUMENTS_PREFIX)
    return Pipeline(spark, load_corpus(spark, sf_dir, preset), preset)


def pipeline_from_lines(spark: SparkSession, train_path: str, test_path: str,
                        preset: Preset | None = None, mode: str = "FAILFAST", rejects: str | None = None) -> Pipeline:
    """A fresh pipeline over two document-line corpora."""
    return Pipeline(spark, lines_corpus(spark, train_path, test_path, mode, rejects), preset or Preset())


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (and turn -0.0 into 0.0) for comparisons
    across engines whose summation order differs."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
