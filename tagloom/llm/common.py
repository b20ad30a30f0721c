"""Shared plumbing of the training-data operators: scratch tables, text columns, value-range selection."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import time
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of a table up to which it may be broadcast; beyond it joins shuffle both sides. The session's setting
#: spark.tagloom.broadcastLimit goes first; 0 shuffles always.
BROADCAST_LIMIT = 8 << 20
#: A key with more than this part of all rows is dealt over several tasks.
SHARE = 512

#: Seconds between collections of the driver's garbage.
FREE_EVERY = 4.0
_freed = 0.0
_own_dir: dict[str, str] = {}


class _Scratch(threading.local):
    """Scratch tables that are still there, by thread: those of each settled() that is under way, the outermost first."""

    def __init__(self):
        self.frames: list[list[str]] = [[]]


_scratch = _Scratch()
_marked: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder where driver and executors share it, in one of the application's that goes when the application ends."""
    of_app = f"{shared_dir(spark)}/tagloom-{spark.sparkContext.applicationId}"
    if of_app not in _marked:
        _marked.add(of_app)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(of_app)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # Only what is there can be marked.
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{of_app}/{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a temporary folder in local mode and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_dir.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="tagloom-"))
    return base.rstrip("/")


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet in the scratch folder and read it again: cuts the lineage, survives lost executors.

    Shuffle files of the finished job are of no further use, so the driver's garbage is collected at once.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{scratch_dir(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(schema).parquet(path)
    _scratch.frames[-1].append(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote, once nothing lazy reads them any more."""
    for t in tables:
        remove(t.sparkSession, t.scratch_path)
        for frame in _scratch.frames:
            if t.scratch_path in frame:
                frame.remove(t.scratch_path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """cut(make()), and all the tables that were cut on the way deleted."""
    _scratch.frames.append([])
    try:
        out = cut(make(), name)
    finally:
        mine = _scratch.frames.pop()
    for path in mine[:-1]:
        remove(out.sparkSession, path)
    _scratch.frames[-1].append(mine[-1])
    return out


def free_shuffles(spark: SparkSession, now: bool = False) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished jobs, unless it was let a moment ago: jobs that are
    done in less than FREE_EVERY seconds leave little behind, and collecting costs as much as they do."""
    global _freed
    if now or time.monotonic() - _freed > FREE_EVERY:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _freed = time.monotonic()


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(df[name], F.lit(""))


def squeezed(text: Column) -> Column:
    """Text without any of the six ASCII white-space characters."""
    return F.translate(text, SPACES, "")


def unit_hash(seed: str, *cols: Column) -> Column:
    """Uniform number in (0, 1) from md5, the same in every engine and rerun: 52 bits, never 0 or 1."""
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def fits(spark: SparkSession, rows: int, width: int) -> bool:
    """Whether rows x width bytes may be broadcast."""
    return rows * width <= int(spark.conf.get("spark.tagloom.broadcastLimit", str(BROADCAST_LIMIT)))


def bounded_broadcast(small: DataFrame, rows: int, width: int) -> DataFrame:
    """Broadcast hint only where rows x width bytes stays under the limit."""
    return F.broadcast(small) if fits(small.sparkSession, rows, width) else small.hint("merge")


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], by: list[str], count: str = "n", how: str = "inner") -> DataFrame:
    """rows joined to keyed, a written table with one row per key and the number of rows that it meets.

    A key with more than 1/SHARE of these rows is dealt over tasks by a hash of the columns `by` and its row of keyed is
    repeated for each part. Such keys are fewer than SHARE by their definition, so they are broadcast. Both sides are
    shuffled at every size.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    hot = keyed.filter(F.col(count) * SHARE > total).select(*on, F.ceil(F.col(count) * SHARE / F.lit(max(total, 1))).cast("int").alias("_parts"))
    hot = F.broadcast(hot)
    left = rows.join(hot, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    right = keyed.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right.hint("merge"), [*on, "_part"], how).drop("_part")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors where neither PYTHONPATH nor the working folder leads them to it."""
    root = Path(__file__).resolve().parents[2]
    known = {Path(p).resolve() for p in [".", *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    app = spark.sparkContext.applicationId
    if root in known or app in _shipped:
        return
    to = Path(tempfile.mkdtemp(prefix="tagloom-")) / "tagloom.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted((root / "tagloom").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(to))
    _shipped.add(app)
