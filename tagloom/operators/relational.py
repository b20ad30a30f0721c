"""Deduplication, upserts, membership and group selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tags


def best_row(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def md5_dedup(posts: DataFrame) -> DataFrame:
    """Of posts with one md5 the one with the highest score, then lowest id; posts without md5 count as one, found by an
    ordered limit, so they are no key that all meet in."""
    order = F.col("score").desc_nulls_last(), F.col("id")
    return best_row(posts.filter("md5 is not null"), ["md5"], *order).unionByName(posts.filter("md5 is null").orderBy(*order).limit(1))


def best_duplicate(posts: DataFrame) -> DataFrame:
    """Of rows with one id the one with the longest tag string, then score, then fav_count."""
    return best_row(posts, ["id"], F.length("tag_string").desc_nulls_last(), F.col("score").desc_nulls_last(), F.col("fav_count").desc_nulls_last(), F.col("tag_string"))


def upsert(old: DataFrame, new: DataFrame, key: str = "id", last: Column | None = None) -> DataFrame:
    """old and new rows by key; a new row replaces the old one. No sort: old keys that return are anti-joined away.

    last: what is greatest in the last of several new rows of one key; without it new keys are taken as unique.
    """
    if last is not None:
        new = best_row(new, [key], last.desc_nulls_last())
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def target_filter(posts: DataFrame, characters: list[str], artists: list[str]) -> DataFrame:
    """Posts with a wanted character or artist; without any wish, all."""
    if not characters and not artists:
        return posts
    return posts.filter(tags.holds_any(F.col("tag_string_character"), characters) | tags.holds_any(F.col("tag_string_artist"), artists))


def target_join(posts: DataFrame, wanted: DataFrame) -> DataFrame:
    """As target_filter, for lists too long for a literal: wanted has a column tag."""
    names = F.array_distinct(F.concat(tags.split_words(F.col("tag_string_character")), tags.split_words(F.col("tag_string_artist"))))
    hits = posts.select("id", F.explode(names).alias("tag")).join(wanted.select("tag").distinct(), "tag", "left_semi").select("id").distinct()
    return posts.join(hits, "id", "left_semi")


def named_like(posts: DataFrame, wanted: list[str]) -> DataFrame:
    """Posts whose character or artist string holds a wanted tag between word borders, in any case; without any wish, all."""
    import re

    if not wanted:
        return posts
    pattern = "|".join(re.escape(t) for t in wanted)
    return posts.filter(tags.holds_word(F.col("tag_string_character"), pattern) | tags.holds_word(F.col("tag_string_artist"), pattern))


def downloaded(prior: DataFrame, files: DataFrame) -> DataFrame:
    """Different rows of earlier knowledge that are on disk, with their path. files: (id, relative_path)."""
    return prior.distinct().join(files.select("id", "relative_path"), "id")


def without(posts: DataFrame, *excluded: DataFrame) -> DataFrame:
    """Posts whose id is in none of the tables."""
    for ids in excluded:
        posts = posts.join(ids.select("id").distinct(), "id", "left_anti")
    return posts


def newest_ids(posts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tag, newest_id) of each wanted tag as character or artist: both kinds in one exploded equi-join, never an OR join."""
    both = F.array_union(tags.split_tags(F.col("tag_string_character")), tags.split_tags(F.col("tag_string_artist")))
    named = posts.select("id", F.explode(both).alias("tag"))
    return named.join(wanted.select("tag").distinct(), "tag").groupBy("tag").agg(F.max("id").alias("newest_id"))


def skip_tags(posts: DataFrame, chances: dict[str, float], key: Column, protected: list[str] | None = None, factor: float = 1.0) -> DataFrame:
    """Posts dropped with each skip tag's chance, drawn from key (tag -> number in [0, 1) by hash), artists protected.

    A skip tag is a regular expression that is looked for between word borders of the tag string, in any case.
    """
    safe = tags.holds_any(F.col("tag_string_artist"), protected or [])
    for tag, chance in chances.items():
        if chance * factor > 0:
            posts = posts.filter(~(tags.holds_word(F.col("tag_string"), tag) & ~safe & (key(tag) < chance * factor)))
    return posts


def face_filter(posts: DataFrame, meta: tuple[str, ...]) -> DataFrame:
    """Posts of one person alone, large enough and without unwanted meta tags."""
    general = tags.text(F.col("tag_string_general"))
    alone = general.rlike(r"\bsolo\b") & general.rlike(r"\b(1girl|1boy)\b")
    clean = ~tags.text(F.col("tag_string_meta")).rlike("|".join(meta)) if "tag_string_meta" in posts.columns else F.lit(True)
    return posts.filter((tags.tag_count(F.col("tag_string_character")) <= 1) & alone & clean & (F.col("image_width") >= 256) & (F.col("image_height") >= 256))


def download_choice(posts: DataFrame) -> DataFrame:
    """(id, url, suffix): the original where there is no sample or the post is small, else the sample; images only."""
    small = (F.col("image_width") * F.col("image_height") <= 768 * 768) | (F.col("image_height") <= 1200)
    url = F.when(F.col("large_file_url").isNull() | (F.col("large_file_url") == "") | small, F.col("file_url")).otherwise(F.col("large_file_url"))
    suffix = F.lower(F.regexp_extract(F.regexp_extract(url, r"^[^?#]*", 0), r"\.([A-Za-z0-9]+)$", 1))
    return posts.select("id", url.alias("url"), suffix.alias("suffix")).filter(F.col("suffix").isin("jpg", "jpeg", "png", "webp", "avif"))


def row_slice(df: DataFrame, start: int, stop: int | None, *order: str) -> DataFrame:
    """Rows start to stop in the given order."""
    out = df.orderBy(*order).offset(start)
    return out if stop is None else out.limit(max(0, stop - start))
