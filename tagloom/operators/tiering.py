"""Quality tiers: filters before them, parents and children, labels from percentiles, and their refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed, tags
from .lineage import cut
from .relational import md5_dedup

REQUIRED = ("id", "score", "fav_count", "aes_score", "tag_string")


def prune_children(posts: DataFrame, protected: Column) -> DataFrame:
    """Children of posts that are there: an only child stays if it has more tags than its parent, of two the better one
    (tags, then score), of more the one with most tags and the one with the best score; protected ones always stay.
    One shuffle on the parent's id joins parents and ranks children."""
    n_tags = F.size(tags.split_tags(F.col("tag_string")))
    rows = posts.withColumn("_tags", n_tags).withColumn("_safe", protected)
    parents = rows.select(F.col("id").alias("_parent"), F.col("_tags").alias("_parent_tags"))
    kids = rows.filter("parent_id is not null").join(parents, F.col("parent_id") == F.col("_parent"))
    family = W.partitionBy("_parent")
    kids = kids.withColumn("_n", F.count(F.lit(1)).over(family))
    rank = lambda *order: F.row_number().over(family.orderBy(*order))
    kids = kids.withColumn("_best", rank(F.desc("_tags"), F.desc_nulls_last("score"), F.col("id"))).withColumn("_most", rank(F.desc("_tags"), F.col("id"))).withColumn("_top", rank(F.desc_nulls_last("score"), F.col("id")))
    stays = F.when(F.col("_n") == 1, F.col("_tags") > F.col("_parent_tags")).when(F.col("_n") == 2, F.col("_best") == 1).otherwise((F.col("_most") == 1) | (F.col("_top") == 1))
    gone = kids.filter(~F.col("_safe") & ~stays).select("id")
    return posts.join(gone, "id", "left_anti")


def prefiltered(posts: DataFrame, artists: list[str] | None = None, most: int = 4) -> DataFrame:
    """Posts that may get a tier; a column protected marks the given artists'."""
    missing = [c for c in REQUIRED if c not in posts.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    false = lambda c: ~F.coalesce(F.col(c), F.lit(False)) if c in posts.columns else F.lit(True)
    rows = posts.filter(F.col("aes_score").isNotNull() & false("is_deleted") & false("is_banned"))
    if "md5" in rows.columns:
        rows = md5_dedup(rows)
    if {"image_width", "image_height"} <= set(rows.columns):
        rows = rows.filter(F.col("image_width") * F.col("image_height") >= 512 * 512)
    safe = tags.holds_any(F.col("tag_string_artist"), artists or []) if "tag_string_artist" in rows.columns else F.lit(False)
    rows = rows.withColumn("protected", safe)
    if "parent_id" in rows.columns:
        rows = prune_children(rows, F.col("protected"))
    few = lambda c: tags.tag_count(F.col(c)) <= most if c in rows.columns else F.lit(True)
    return rows.filter(few("tag_string_character") & few("tag_string_copyright"))


#: Bins of a histogram, and rows of an interval that are few enough to be counted by value.
BINS, FEW = 1024, 10_000


def percentiles(rows: DataFrame, points: dict[str, tuple[float, ...]], least: dict[str, int]) -> dict[str, list[float]]:
    """Exact percentiles (linear between neighbours) of several columns at once; zeros for a column that has no more than
    `least` different values.

    All columns are counted in one pass into histograms between their ends; each wanted rank leads to a bin, whose own
    least and greatest values bound the next, finer histogram, until an interval holds few rows or one value. So a pass
    gives the driver BINS rows for each interval, and no task holds a column's values.
    """
    names = list(points)
    ends = rows.agg(*[f(c).cast(t) for c in names for f, t in ((F.count, "long"), (F.min, "double"), (F.max, "double"))]).first()
    size, low, high = ({c: ends[3 * i + k] for i, c in enumerate(names)} for k in range(3))
    ranks = {c: sorted({r for p in points[c] for r in (int(p * (size[c] - 1)), min(int(p * (size[c] - 1)) + 1, size[c] - 1))}) for c in names if size[c]}
    # What is still open: (column, least, greatest, rows below it) -> ranks inside.
    todo, found, many = {(c, low[c], high[c], 0): rs for c, rs in ranks.items()}, {}, {c: False for c in names}

    def passed(intervals: list[tuple], value: bool) -> dict[int, list]:
        """Rows of each interval: (place, count, least, greatest), by bin or by value, in order."""
        each = []
        for i, (c, a, b, _) in enumerate(intervals):
            v = F.col(c).cast("double")
            place = v if value else F.least(F.floor((v - a) / ((b - a) / BINS or 1.0)), F.lit(BINS - 1)).cast("double")
            each.append(F.when(v.between(a, b), F.struct(F.lit(i).alias("i"), place.alias("place"), v.alias("v"))))
        cells = rows.select(F.explode(F.array_compact(F.array(*each))).alias("x")).groupBy("x.i", "x.place").agg(F.count(F.lit(1)).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
        out: dict[int, list] = {i: [] for i in range(len(intervals))}
        for i, place, n, lo, hi in cells.collect():
            out[i].append((place, n, lo, hi))
        return {i: sorted(x) for i, x in out.items()}

    first = True
    while todo:
        intervals, after = list(todo), {}
        for i, cells in passed(intervals, False).items():
            c, _, _, below = intervals[i]
            if first:
                many[c] = sum(1 + (lo < hi) for _, _, lo, hi in cells) > least[c]
            for _, n, lo, hi in cells:
                inside = [r for r in todo[intervals[i]] if below <= r < below + n]
                if inside and lo == hi:
                    found |= {(c, r): lo for r in inside}
                elif inside:
                    after[c, lo, hi, below, n] = inside
                below += n
        first = False
        few = [k[:4] for k in after if k[4] <= FEW]
        for i, cells in (passed(few, True) if few else {}).items():
            c, _, _, below = few[i]
            wanted = next(rs for k, rs in after.items() if k[:4] == few[i])
            for v, n, _, _ in cells:
                found |= {(c, r): v for r in wanted if below <= r < below + n}
                below += n
        todo = {k[:4]: rs for k, rs in after.items() if k[4] > FEW}
    out = {}
    for c in names:
        enough = size[c] and (many[c] or rows.select(c).filter(F.col(c).isNotNull()).distinct().limit(least[c] + 1).count() > least[c])
        at = [p * (size[c] - 1) for p in points[c]] if enough else []
        value = lambda r, c=c: found[c, min(r, size[c] - 1)]
        out[c] = [value(int(x)) + (x - int(x)) * (value(int(x) + 1) - value(int(x))) for x in at] if enough else [0.0] * len(points[c])
    return out


def thresholds(rows: DataFrame) -> DataFrame:
    """One row of exact percentiles; zeros where a metric has too few different values to part."""
    points = {"score": (0.20, 0.60, 0.92), "fav_count": (0.20, 0.60, 0.92), "aes_score": (0.25, 0.38, 0.50)}
    got = percentiles(rows, points, {"score": 3, "fav_count": 3, "aes_score": 4})
    return rows.sparkSession.createDataFrame([tuple(got[c] for c in points)], ", ".join(f"t_{c} array<double>" for c in points))


def labelled(rows: DataFrame) -> DataFrame:
    """Rows with quality_label, negative_tags and positive_tags. The thresholds are one row, broadcast; rows are cut
    before, since both the thresholds and the labels read them."""
    rows = cut(rows)
    rows = rows.withColumn("negative_tags", tags.contained(F.col("tag_string"), fixed.NEGATIVE_TAGS)).withColumn("positive_tags", tags.contained(F.col("tag_string"), fixed.POSITIVE_TAGS))
    out = rows.crossJoin(F.broadcast(thresholds(rows)))
    s, f, a = (lambda i, m=m: F.element_at(f"t_{m}", i) for m in ("score", "fav_count", "aes_score"))
    score, fav, aes, bad, good, safe = (F.col(c) for c in ("score", "fav_count", "aes_score", "negative_tags", "positive_tags", "protected"))
    top = (score >= s(3)) & (fav >= f(3)) & (aes >= a(3)) & (bad <= 1) & (good > 0)
    if {"image_width", "image_height"} <= set(rows.columns):
        top = top & (F.least("image_width", "image_height") >= 512)
    poor = ~safe & ((bad >= 2) | F.contains(F.lower("tag_string"), F.lit("banned_artist")) | ((score < s(1)) & (fav < f(1)) & (aes < a(1))))
    fine = (score >= s(2)) & (fav >= f(2)) & (aes >= a(2)) & (bad <= 2)
    label = F.when(top, "masterpiece").when(poor, "worse_score").when(fine, "good_score").otherwise("bad_score")
    if "new_aesthetic_label" in rows.columns:
        out = out.withColumn("_l", label)
        judged = F.coalesce("new_aesthetic_label", F.lit(""))
        down = F.when(F.col("_l").isin("masterpiece", "good_score") & (judged == "worst"), F.when(safe, "bad_score").otherwise("worse_score")).otherwise(F.col("_l"))
        out = out.withColumn("_l", down)
        label = F.when(F.col("_l").isin("bad_score", "worse_score") & (judged == "best"), "good_score").otherwise(F.col("_l"))
    out = out.withColumn("quality_label", label).withColumn("quality_label", F.when((F.col("quality_label") == "worse_score") & safe, "bad_score").otherwise(F.col("quality_label")))
    return out.drop("_l", "t_score", "t_fav_count", "t_aes_score")


def quality_tiers(posts: DataFrame, artists: list[str] | None = None, most: int = 4) -> DataFrame:
    return labelled(prefiltered(posts, artists, most))


def tier_stats(rows: DataFrame) -> DataFrame:
    aggs = [f(c).alias(f"{n}_{c}") for c in ("score", "fav_count", "aes_score", "negative_tags") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    return rows.groupBy("quality_label").agg(F.count(F.lit(1)).alias("posts"), *aggs)


def final_tier(tier: Column, label: Column) -> Column:
    """A tier refined by a classifier's label; all rules look at the tier as it came, later rules win."""
    return (
        F.when((tier == "worse_score") & (label == "better"), "good_score")
        .when(tier.isin("bad_score", "good_score") & (label == "best"), "masterpiece")
        .when((tier == "masterpiece") & (label == "worse"), "bad_score")
        .when(tier.isin("masterpiece", "good_score", "bad_score") & (label == "worst"), "worse_score")
        .otherwise(tier)
    )
