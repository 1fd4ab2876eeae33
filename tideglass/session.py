"""Session set-up and the shared folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app: str = "tideglass", **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the submitter's settings are used instead."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.master(master).appName(app).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor can reach. Where that is unset, a local
    session (tests) gets a temporary one; on a cluster that is an error."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    context = spark.sparkContext
    if not folder:
        if context.getCheckpointDir() is None and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = context.getCheckpointDir() or os.path.join(tempfile.gettempdir(), f"tideglass-{os.getuid()}")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table of the shared folder and reads it back, so that several branches use one computation.

    The table is compressed columnar data, smaller than an RDD checkpoint, and outlives the loss of any executor."""
    spark = df.sparkSession
    path = f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _tables(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tideglass/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes the tables that this application's `materialise` has written: for when no result is read any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
