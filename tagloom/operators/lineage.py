"""Cutting long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """df by checkpoint() in the folder that the session names (spark.checkpoint.dir). Where none is named, a temporary one
    in local mode and an error on a cluster."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def checkpoint_dir(spark: SparkSession) -> str:
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tagloom-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df by a Parquet table in the same folder, which goes with drop() or when the application ends.

    For loops: a checkpoint keeps the estimated size of its plan and joins multiply sizes, so these numbers get twice as long
    with each round until they fill the driver; a table has the size of its files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tagloom-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, p = _place(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing lazy reads any more."""
    for t in tables:
        fs, p = _place(t.sparkSession, t.written_path)
        fs.delete(p, True)


def _place(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
