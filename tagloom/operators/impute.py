"""Missing metrics from the means of a post's artists, then of its characters, then of all posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tags
from .lineage import cut

METRICS = ("aes_score", "fav_count", "score")


def _group_guess(rows: DataFrame, metric: str, names: str) -> DataFrame:
    """(id, guess): unweighted mean of the means of a row's groups, over rows without the metric.

    Means come from the rows that have it; both sides are exploded and meet on the group's name. A row that names no
    group gets no guess.
    """
    each = rows.filter(F.col(names).isNotNull()).select("id", metric, names, F.explode(tags.split_tags(F.col(names))).alias("name"))
    means = each.filter(F.col(metric).isNotNull()).groupBy("name").agg(F.avg(metric).alias("mean"))
    return each.filter(F.col(metric).isNull() & (F.col(names) != "")).join(means, "name").groupBy("id").agg(F.avg("mean").alias("guess"))


def _fill(base: DataFrame, metric: str) -> DataFrame:
    """(id, fill) of the rows without the metric. Character means count what artists' means filled in; the overall mean
    does not."""
    by_artist = cut(_group_guess(base.select("id", metric, "tag_string_artist"), metric, "tag_string_artist"))
    so_far = base.select("id", metric, "tag_string_character").join(by_artist, "id", "left").withColumn(metric, F.coalesce(metric, "guess")).drop("guess")
    by_character = _group_guess(so_far, metric, "tag_string_character").withColumnRenamed("guess", "guess_2")
    overall = base.agg(F.coalesce(F.avg(metric), F.lit(0.0)).alias("mean"))
    rows = base.filter(F.col(metric).isNull()).select("id").join(by_artist, "id", "left").join(by_character, "id", "left").crossJoin(F.broadcast(overall))
    return cut(rows.select("id", F.coalesce("guess", "guess_2", "mean").alias(f"fill_{metric}")))


def imputed(posts: DataFrame) -> DataFrame:
    """posts with their metrics filled. Only narrow columns are worked on; the fills of rows without a metric are joined
    to the posts by id, so the posts themselves are read once."""
    metrics = [m for m in METRICS if m in posts.columns]
    base = cut(posts.select("id", *metrics, "tag_string_artist", "tag_string_character"))
    for metric in metrics:
        fill = _fill(base, metric)
        posts = posts.join(fill, "id", "left").withColumn(metric, F.coalesce(metric, f"fill_{metric}")).drop(f"fill_{metric}")
    return posts
