"""Aspect-ratio buckets, length tiers, shards and their metadata."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tags
from .lineage import cut


def bucket_sizes(area: tuple[int, int] = (768, 512), least: int = 256, step: int = 64, base: tuple[int, int] = (512, 512), factor: int = 8, limit: int = 1024) -> list[tuple[int, int]]:
    """For each width the greatest height within area and limit and the other way round, and the base; by width."""
    room = (area[0] / factor) * (area[1] / factor)
    grid = range(least, limit + 1, step)
    fits = lambda w, h: (w / factor) * (h / factor) <= room
    found = set()
    for side in grid:
        other = [x for x in grid if fits(side, x)]
        if other:
            found |= {(side, other[-1]), (other[-1], side)}
    if fits(*base) and all(least <= x <= limit and x % step == 0 for x in base):
        found.add(base)
    if not found:
        raise ValueError("no bucket fits the constraints")
    return sorted(found, key=lambda r: r[0] * limit - r[1])


def bucket_table(spark: SparkSession, sizes: list[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(sizes)], "bucket int, target_width int, target_height int")


def nearest_bucket(width: Column, height: Column, sizes: list[tuple[int, int]]) -> Column:
    """(diff, bucket) of the bucket nearest in log aspect ratio, the first of equals: a literal list, no join at all."""
    own = F.log(width.cast("double") / height)
    each = F.array(*[F.struct(F.abs(F.lit(log(w / h)) - own).alias("diff"), F.lit(i).alias("bucket")) for i, (w, h) in enumerate(sizes)])
    return F.when((width > 0) & (height > 0), F.array_min(each))


def assigned(posts: DataFrame, sizes: list[tuple[int, int]], most: float = 0.3) -> DataFrame:
    """posts with their bucket and its size; those without a bucket near enough are left out."""
    near = posts.withColumn("_near", nearest_bucket(F.col("image_width"), F.col("image_height"), sizes)).filter(F.col("_near.diff") <= most)
    out = near.withColumn("bucket", F.col("_near.bucket")).drop("_near")
    return out.join(F.broadcast(bucket_table(posts.sparkSession, sizes)), "bucket")


def crowded(rows: DataFrame, least: int = 8) -> DataFrame:
    """Rows of buckets and tiers with at least so many rows; counts are aggregated first, so a hot group is no window. There
    are as many groups as buckets times tiers at most, which is what is broadcast."""
    rows = cut(rows)
    enough = rows.groupBy("bucket", "tier").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("bucket", "tier")
    return rows.join(F.broadcast(enough), ["bucket", "tier"], "left_semi")


def sharded(rows: DataFrame, per_shard: int, order: str = "id", start: DataFrame | None = None) -> DataFrame:
    """Rows numbered within bucket and tier in the order of a column, with their shard. start: (bucket, tier, next) of an
    earlier run.

    Rows are sorted over all tasks by ranges and written once with their place in their task; a row's number is its place,
    less where its group begins in that task, plus what earlier tasks hold of the group. So a group of any size spreads
    over tasks, whatever the values of the column, and what is broadcast has a row per task and group.
    """
    keys = ["bucket", "tier", order]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    piece = F.shiftright("_at", 33)
    sizes = placed.groupBy("bucket", "tier", piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("bucket", "tier").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("bucket", "tier", "_piece", (before - F.col("_first")).alias("_move"))
    if start is not None:
        offsets = offsets.join(start, ["bucket", "tier"], "left").withColumn("_move", F.col("_move") + F.coalesce("next", F.lit(0))).drop("next")
    out = placed.withColumn("_piece", piece).join(F.broadcast(offsets), ["bucket", "tier", "_piece"]).withColumn("idx", F.col("_at") + F.col("_move"))
    return out.withColumn("shard", F.floor(F.col("idx") / per_shard).cast("long")).drop("_piece", "_move", "_at")


def next_indices(done: DataFrame) -> DataFrame:
    """(bucket, tier, next) of rows that were numbered before."""
    return done.groupBy("bucket", "tier").agg((F.max("idx") + 1).alias("next"))


def metadata(rows: DataFrame, factor: int = 8) -> DataFrame:
    """One JSON row per bucket: its size, the size of what an encoder makes of it, its log aspect ratio and its samples by
    tier."""
    size = ["bucket", "target_width", "target_height"]
    per = rows.groupBy(*size, "tier").agg(F.count(F.lit(1)).alias("samples"))
    by_bucket = per.groupBy(*size).agg(F.array_sort(F.collect_list(F.struct("tier", "samples"))).alias("tiers"), F.sum("samples").alias("samples"))
    ratio = F.round(F.log(F.col("target_width") / F.col("target_height")), 6).alias("log_aspect_ratio")
    return by_bucket.select("bucket", F.to_json(F.struct(*size, F.floor(F.col("target_height") / factor).alias("latent_height"), F.floor(F.col("target_width") / factor).alias("latent_width"), ratio, "samples", "tiers")).alias("info"))


def dataset_info(rows: DataFrame, assigned_rows: int, per_shard: int) -> DataFrame:
    """One JSON row: samples written and assigned, rows of a shard, and the length tiers in use."""
    found = rows.agg(F.count(F.lit(1)).alias("samples"), F.array_sort(F.collect_set("tier")).alias("tiers"))
    return found.select(F.to_json(F.struct("samples", F.lit(assigned_rows).alias("assigned"), F.lit(per_shard).alias("per_shard"), "tiers")).alias("info"))


def sample_mapping(rows: DataFrame) -> DataFrame:
    """(id, bucket, tier, idx_in_tier, shard): where each numbered row is kept, one row each rather than one document."""
    return rows.select("id", "bucket", "tier", F.col("idx").alias("idx_in_tier"), "shard")


def reweighted(shards: DataFrame, weights: DataFrame, update_all: bool = False) -> DataFrame:
    """Rows of shards with their weight set anew from weights (id, weight): those that have none yet, or with update_all
    every one; ids without a weight get 1."""
    rows = shards if "weight" in shards.columns else shards.withColumn("weight", F.lit(None).cast("double"))
    joined = rows.withColumnRenamed("weight", "_old").join(weights.groupBy("id").agg(F.max("weight").cast("double").alias("_new")), "id", "left")
    own = ["_new"] if update_all else ["_old", "_new"]
    return joined.withColumn("weight", F.coalesce(*own, F.lit(1.0))).select(*rows.columns)


def write_shards(rows: DataFrame, path: str, per_file: int = 24_000) -> None:
    """Parquet by bucket and tier; files hold at most per_file rows."""
    rows.repartition("bucket", "tier", F.col("shard") if "shard" in rows.columns else F.lit(0)).write.mode("append").option("maxRecordsPerFile", per_file).option("compression", "snappy").partitionBy("bucket", "tier").parquet(path)


def crop_geometry(width: Column, height: Column, to_width: Column, to_height: Column) -> Column:
    """Size that covers the bucket, before it is cropped to it."""
    scale = F.greatest(to_width / width, to_height / height)
    return F.struct(F.greatest(F.ceil(width * scale), to_width).cast("int").alias("width"), F.greatest(F.ceil(height * scale), to_height).cast("int").alias("height"))


EXPORT = "booru_id string, image binary, prompt string, bucket_idx int, target_width int, target_height int, original_width int, original_height int, aspect_ratio float, tier int, aesthetic_tier int, tag_weight float"


def export_rows(rows: DataFrame) -> DataFrame:
    """The fixed export schema; image bytes are null where a caller joins none."""
    image = F.col("image") if "image" in rows.columns else F.lit(None)
    ratio = F.col("image_width").cast("double") / F.col("image_height")
    weight = F.col("weight") if "weight" in rows.columns else F.lit(1.0)
    aesthetic = F.col("aesthetic_tier") if "aesthetic_tier" in rows.columns else F.lit(-1)
    values = (F.col("id"), image, F.col("prompt"), F.col("bucket"), F.col("target_width"), F.col("target_height"), F.col("image_width"), F.col("image_height"), ratio, F.col("tier"), aesthetic, weight)
    return rows.select(*[v.cast(t).alias(n) for v, (n, t) in zip(values, (x.split(" ") for x in EXPORT.split(", ")), strict=True)])


def prompt_tier(prompt: Column) -> Column:
    """Length tier of a prompt by its words and commas, where no tokenizer is given."""
    return tags.length_tier(F.regexp_count(prompt, F.lit(r"[^\s,]+|,")) + 2)
