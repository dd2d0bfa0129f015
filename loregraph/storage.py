"""Cutting lineage and keeping intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where that is unset, a temporary folder if driver and
    executors are one process (tests); on a cluster a machine's own folder would lose data, so it's refused."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at:
        return at
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not at and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(at or "file://" + os.path.join(tempfile.gettempdir(), "loregraph-checkpoints"))
    return sc.getCheckpointDir()


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: it outlives any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def table(df: DataFrame, kind: str = "table") -> DataFrame:
    """A written table in the shared folder. Unlike a checkpoint it hands on neither constraints nor a
    partitioning, and its size is known to the planner: right for loops, whose plans must not grow."""
    at = new_folder(df.sparkSession, kind)
    df.write.parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.folder = at
    return out


def done_with(*tables: DataFrame) -> None:
    """Delete written tables that later tables have taken the place of. Loops call it, so that they keep a
    round's tables and not all of them."""
    for t in tables:
        if getattr(t, "folder", None):
            drop(t.sparkSession, t.folder)
