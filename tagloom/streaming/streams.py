"""Structured Streaming counterparts of the incremental steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, folder: str, schema: str, per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def late_dedup(rows: DataFrame, key: str = "id", when: str = "created_at", days: int = 7) -> DataFrame:
    """Each key once within the overlap window; state older than the watermark falls."""
    return rows.withWatermark(when, f"{days} days").dropDuplicatesWithinWatermark([key])


def without_excluded(rows: DataFrame, excluded: DataFrame, key: str = "id") -> DataFrame:
    """A stream without the keys of a static list."""
    return rows.join(excluded.select(key).distinct(), key, "left_anti")


def windowed_counts(rows: DataFrame, when: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key, final once the watermark has passed."""
    return rows.withWatermark(when, late).groupBy(F.window(when, width), by).agg(F.count(F.lit(1)).alias("count"))


def append_once(rows: DataFrame, out: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append rows whose key the output does not hold yet. A batch that is run again writes to its own folder again, so a
    restart neither loses nor doubles rows."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        new = batch.dropDuplicates([key])
        path = jvm.org.apache.hadoop.fs.Path(out)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path) and len(fs.listStatus(path)):
            old = spark.read.option("basePath", out).parquet(out).filter(F.col("batch") != number)
            new = new.join(old.select(key).distinct(), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
