"""Session preparation and reliable materialisation of intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on (UTC clock, adaptive execution)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def keep_no_shuffles(spark: SparkSession) -> None:
    """Let shuffle files go at the end of the query that wrote them, not when the driver collects its garbage.

    Stages of a job hand over written tables, so that none reads the shuffles of another.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up in local mode, where driver and
    executors are one process; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="opsignal-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the file system the path names."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def materialise(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The copy survives lost executors, carries file sizes for join planning and
    is column-pruned by its readers. ``compression`` is that of the files, the session's if not given.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    schema = df.schema
    keep_no_shuffles(spark)
    df.write.parquet(path, compression=compression)
    written = spark.read.schema(schema).parquet(path)
    written.written_to = path
    return written


def discard(written: DataFrame) -> None:
    """Delete the files of a table from ``materialise`` that nothing reads any more."""
    spark, path = written.sparkSession, written.sparkSession._jvm.org.apache.hadoop.fs.Path(written.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
