"""Tag counts, rarity weights of tags and captions, comparisons of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed, tags

CATEGORIES = {"general": "tag_string_general", "character": "tag_string_character", "artist": "tag_string_artist"}


def category_tags(posts: DataFrame, categories: dict[str, str] | None = None, upsampled: str | None = None) -> DataFrame:
    """(category, tag) of every tag; one scan, all categories exploded together.

    Strings are parted at each single blank, so an empty one has the empty tag; null has none. upsampled: a column of raw
    tags that count as general ones.
    """
    there = [(k, c) for k, c in [*(categories or CATEGORIES).items(), *([("general", upsampled)] if upsampled else [])] if c in posts.columns]
    each = F.array(*[F.struct(F.lit(k).alias("category"), F.when(F.col(c).isNotNull(), tags.split_tags(F.col(c))).alias("tags")) for k, c in there])
    return posts.select(F.explode(each).alias("c")).select("c.category", F.explode("c.tags").alias("tag"))


def tag_counts(posts: DataFrame, categories: dict[str, str] | None = None, upsampled: str | None = None) -> DataFrame:
    return category_tags(posts, categories, upsampled).groupBy("category", "tag").agg(F.count(F.lit(1)).alias("count"))


def parsed_counts(posts: DataFrame, column: str, least: int = 1) -> DataFrame:
    """(tag, count) of one column parted at any white space, tags of at least so many characters."""
    return posts.select(F.explode(tags.split_words(F.col(column))).alias("tag")).filter(F.length("tag") >= least).groupBy("tag").agg(F.count(F.lit(1)).alias("count"))


def top_tags(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent tags of each category; rank 1 is the most frequent, ties by name."""
    rank = F.row_number().over(W.partitionBy("category").orderBy(F.desc("count"), "tag"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def distribution(counts: DataFrame, by: str) -> DataFrame:
    """Counts by category and tag with one column for each value of `by`, 0 where a tag is missing."""
    return counts.groupBy("category", "tag").pivot(by).agg(F.sum("count")).na.fill(0)


def comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts of two tables (tag, count) side by side, with the change in percent; 0 where there was nothing before."""
    both = before.select("tag", F.col("count").alias("prior")).join(after.select("tag", F.col("count").alias("filtered")), "tag", "full").na.fill(0, ["prior", "filtered"])
    change = F.col("filtered") - F.col("prior")
    return both.withColumn("difference", change).withColumn("difference_percentage", F.coalesce(F.try_divide(change * 100.0, F.col("prior")), F.lit(0.0)))


def most_changed(compared: DataFrame, k: int, increases: bool = False) -> DataFrame:
    """The k tags of comparison() that lost most in percent, or gained most; ties by name."""
    change = F.col("difference_percentage")
    return compared.orderBy(change.desc() if increases else change.asc(), "tag").limit(k)


def tag_weights(counts: DataFrame, low: float = 0.25, high: float = 2.0, smoothing: float = 0.05) -> DataFrame:
    """(category, tag, weight): inverse smoothed frequency, spread over low to high within the category; 1 if all are equal."""
    category = W.partitionBy("category")
    freq = F.col("count") / F.sum("count").over(category)
    raw = counts.withColumn("raw", 1.0 / (freq + smoothing))
    least, most = F.min("raw").over(category), F.max("raw").over(category)
    spread = low + (F.col("raw") - least) / F.nullif(most - least, F.lit(0.0)) * (high - low)
    return raw.select("category", "tag", F.least(F.greatest(F.coalesce(spread, F.lit(1.0)), F.lit(low)), F.lit(high)).alias("weight"))


def caption_weights(captions: DataFrame, weights: DataFrame, artists: DataFrame | None = None, characters: DataFrame | None = None, normalize: bool = False) -> DataFrame:
    """(id, weight) of captions (id, caption): mean of its known tags' weights by category, geometric mean of these.

    A tag has one category, the last of CATEGORIES that it was counted in; other categories than these do not count.
    Tags of prior lists weigh 1.55 (artists) and 1.15 (characters) times as much, at most 2. No known tag gives 1.
    """
    name = tags.raw_tag(F.col("tag")) if normalize else F.col("tag")
    each = captions.select("id", F.explode(tags.comma_parts(F.col("caption"))).alias("tag")).withColumn("tag", name)
    order = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category"))
    one = weights.filter(order > 0).groupBy("tag").agg(F.max_by(F.struct("category", "weight"), order).alias("w")).select("tag", "w.category", "w.weight")
    known = each.join(one, "tag")
    for prior, category, factor in ((artists, "artist", 1.55), (characters, "character", 1.15)):
        if prior is not None:
            known = known.join(prior.select("tag", F.lit(True).alias("_prior")).distinct(), "tag", "left")
            known = known.withColumn("weight", F.when(F.col("_prior") & (F.col("category") == category), F.least(F.col("weight") * factor, F.lit(2.0))).otherwise(F.col("weight"))).drop("_prior")
    means = known.groupBy("id", "category").agg(F.avg("weight").alias("mean"))
    per = means.groupBy("id").agg(F.exp(F.avg(F.log("mean"))).alias("weight"))
    return captions.select("id").join(per, "id", "left").select("id", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def rare_shares(counts: DataFrame, limits: tuple[int, ...]) -> DataFrame:
    """By category: tags, tags counted less than each limit, and their share."""
    aggs = [x for n in limits for x in (F.count_if(F.col("count") < n).alias(f"below_{n}"), (F.count_if(F.col("count") < n) / F.count(F.lit(1))).alias(f"share_{n}"))]
    return counts.groupBy("category").agg(F.count(F.lit(1)).alias("tags"), *aggs)


def pruned(posts: DataFrame, counts: DataFrame, column: str, category: str, least: int) -> DataFrame:
    """posts with the column's tags of the category counted less than `least` taken out, order kept."""
    rare = counts.filter((F.col("category") == category) & (F.col("count") < least)).select("tag")
    each = posts.select("id", F.posexplode(tags.split_words(F.col(column))).alias("pos", "tag"))
    left = each.join(rare, "tag", "left_anti").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "tag"))).alias("kept"))
    joined = posts.join(left, "id", "left")
    return joined.withColumn(column, F.coalesce(F.array_join(F.col("kept.tag"), " "), F.lit(""))).drop("kept")


def clusters(counts: DataFrame) -> DataFrame:
    """(cluster, tags): counts of general tags summed by the first cluster one of whose keywords the tag contains."""
    first = F.coalesce(*[F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("tag"), w)), F.lit(name)) for name, words in fixed.TAG_CLUSTERS.items()])
    return counts.withColumn("cluster", first).filter("cluster is not null").groupBy("cluster").agg(F.sum("count").alias("tags"))


def persons(posts: DataFrame) -> DataFrame:
    """One row: posts with each person count and who is alone."""
    words = tags.split_words(F.col("tag_string_general"))
    general = tags.text(F.col("tag_string_general"))
    name = lambda t: "n_" + t.replace("+", "_plus")
    alone = general.rlike(r"\bsolo\b")
    return posts.agg(*[F.count_if(F.array_contains(words, t)).alias(name(t)) for t in fixed.PERSON_TAGS], F.count_if(alone & general.rlike(r"\b1girl\b")).alias("solo_girl"), F.count_if(alone & general.rlike(r"\b1boy\b")).alias("solo_boy"))


def describe(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Count, mean, sample deviation, least, quartiles and most of a column."""
    p = lambda x: F.percentile(column, F.lit(x))
    aggs = [F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), p(0.25).alias("p25"), p(0.5).alias("p50"), p(0.75).alias("p75"), F.max(column).alias("max")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def shares(df: DataFrame, column: str) -> DataFrame:
    """(value, count, share) of a column; the total is one more row, not a second scan."""
    per = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return per.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy()))


def length_stats(df: DataFrame, length: Column, limit: int = 225) -> DataFrame:
    """Mean, population deviation, quantiles and the share beyond the limit."""
    rows = df.select(length.alias("n"))
    return rows.agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), F.min("n").alias("min"), F.percentile("n", F.lit(0.5)).alias("median"), F.percentile("n", F.lit(0.9)).alias("p90"), F.percentile("n", F.lit(0.99)).alias("p99"), F.max("n").alias("max"), (F.count_if(F.col("n") > limit) / F.count(F.lit(1))).alias("over"))


def by_month(df: DataFrame, when: Column) -> DataFrame:
    """(month, year, count); rows without a readable date have no month."""
    return df.select(F.date_trunc("month", when).alias("month"), F.year(when).alias("year")).filter("month is not null").groupBy("month", "year").agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, low, count) of equal-width bins between least and most."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    at = F.least(F.width_bucket(F.col(column), F.col("_lo"), F.when(F.col("_hi") > F.col("_lo"), F.col("_hi")).otherwise(F.col("_lo") + 1.0), F.lit(bins)), F.lit(bins)) - 1
    rows = df.filter(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).select(at.cast("int").alias("bin"), "_lo", "_hi")
    return rows.groupBy("bin").agg((F.first("_lo") + F.col("bin") * (F.first("_hi") - F.first("_lo")) / bins).alias("low"), F.count(F.lit(1)).alias("count"))
