"""Session helpers: building a session for tests/bench, and the shared folder
used for checkpoints and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "termflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is
    used instead and nothing here is called."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only when it is unset (tests, local runs) is one chosen here: a fresh
    temporary folder in local mode. On a cluster a missing setting is an error:
    executors and driver share no other folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="termflow-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Cut lineage of a result that later stages read several times.

    ``checkpoint`` writes it to the shared folder (survives executor loss and
    keeps iterative plans short); ``cache`` keeps it in executor memory and
    recomputes lost blocks from lineage; ``none`` returns it unchanged."""
    if mode == "none":
        return df
    if mode not in ("checkpoint", "cache"):
        raise ValueError(f"unknown materialize mode {mode!r}")
    if mode == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    df = df.cache()
    df.count()
    return df


def write_and_read(df: DataFrame, name: str, seen: Observation | None = None, *counts: Column,
                   schema: StructType | None = None) -> DataFrame:
    """A data-sized intermediate as Parquet in the shared folder, read back
    with column pruning: it survives executor loss and cuts lineage. ``counts``
    are taken by the write itself and end up in ``seen``. A ``schema`` may name
    other types of the same layout to read it under."""
    path = scratch_path(df.sparkSession, name)
    (df if seen is None else df.observe(seen, *counts)).write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
