"""Shared helpers: the shared scratch folder, written intermediates, and
connected components over an edge table."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a step on whole texts holds results for at a time.
ROWS_AT_ONCE = 1_000
_LOCAL_DIRS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a
    single-machine session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, since executors share no other
    folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="termflow-llm-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back: cuts
    the lineage, survives lost executors, and later reads prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that this library wrote."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now instead
    of at the driver's next garbage collection, which on an idle driver may be
    half an hour away."""
    for _ in range(2):  # plans let go in the first round, their shuffles in the second
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the component
    being its smallest node; any orderable type, nulls and loops ignored.

    Alternates the large-star and small-star steps: every node is linked to
    the smallest neighbour, until no edge changes. A hub with a third of the
    edges is pre-aggregated for its minimum, and is then one row joined to
    many, a join that adaptive execution may split. Each round is written to
    the shared folder, so plans stay short and lost executors cost one round."""
    spark = edges.sparkSession
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    path = scratch_path(spark, "edges")
    e.write.parquet(path)
    schema = e.schema
    e = spark.read.schema(schema).parquet(path)

    def sums(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    seen = sums(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # Large-star: every neighbour above u goes to the smallest of u and its neighbours.
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small-star: u and its neighbours below it go to the smallest of them.
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(small_low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        new_path = scratch_path(spark, "edges")
        small.write.parquet(new_path)
        small = spark.read.schema(schema).parquet(new_path)
        now = sums(small)
        delete(spark, path)
        e, path = small, new_path
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every edge points from a node to the smallest node of its component.
    settled = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return settled.union(settled.select(F.col("component").alias("node"), "component").distinct())


class Passed:
    """The columns of ``df`` under plain names, so that no name of an operator
    meets one of them: ``frame`` holds p0, p1, ...; ``kept`` are those that no
    result column replaces (names are compared without case, as Spark reads
    them), ``names`` their own names, and ``col(name)`` is a given column."""

    def __init__(self, df: DataFrame, replaced: tuple[str, ...]):
        gone = {name.lower() for name in replaced}
        self.columns = df.columns
        self.frame = df.toDF(*[f"p{k}" for k in range(len(df.columns))])
        at = [k for k, c in enumerate(df.columns) if c.lower() not in gone]
        self.kept, self.names = [f"p{k}" for k in at], [df.columns[k] for k in at]

    def name(self, column: str) -> str:
        exact = [k for k, c in enumerate(self.columns) if c == column]
        return f"p{(exact or [k for k, c in enumerate(self.columns) if c.lower() == column.lower()])[0]}"

    def col(self, column: str):
        return F.col(self.name(column))


def append_columns(df: DataFrame, source: str, compute, added: list[tuple[str, str]]) -> DataFrame:
    """``df`` with columns that ``compute(arrow column of source)`` gives as a
    list of arrow arrays, one per (name, Spark type) of ``added``. Columns pass
    through whatever their names; those named like an added one are replaced."""
    import pyarrow as pa
    from pyspark.sql.types import StructField, StructType

    own = Passed(df, tuple(name for name, _ in added))
    kept = own.names
    plain = own.frame.select(*[F.col(p).alias(f"c{k}") for k, p in enumerate(own.kept)], own.col(source).alias("source"))
    passed, named = len(kept), [f"c{k}" for k in range(len(kept))] + [f"n{k}" for k in range(len(added))]

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([*batch.columns[:passed], *compute(batch.column(passed))], named)

    fields = [StructField(f"c{k}", plain.schema[k].dataType) for k in range(len(kept))]
    extra = StructType.fromDDL(", ".join(f"n{k} {kind}" for k, (_, kind) in enumerate(added)))
    out = plain.mapInArrow(run, StructType([*fields, *extra.fields]))
    return out.toDF(*kept, *[name for name, _ in added])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns of ``df``, also where others differ from them only
    in case, repeat, or hold dots. A name that only occurs in another case is
    taken in that case."""
    at: dict[str, int] = {}
    for name in names:
        exact = [k for k, c in enumerate(df.columns) if c == name]
        near = [k for k, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not exact + near:
            raise ValueError(f"no column {name} among {df.columns}")
        at[name] = (exact + near)[0]
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return plain.select(*[F.col(f"c{k}").alias(name) for name, k in at.items()])
