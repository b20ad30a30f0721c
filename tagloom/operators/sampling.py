"""Stratified weighted sampling with quotas by rating, tiers with deficit carry, and groups of parents kept apart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tags
from .lineage import cut

TIERS = ("masterpiece", "good_score", "bad_score", "worse_score")
Key = Callable[[str], Column]


def quotas(total: int, shares: dict[str, float]) -> dict[str, int]:
    """Whole numbers of each share, what is missing to the total handed out one by one in order."""
    got = {k: int(total * p) for k, p in shares.items()}
    names = list(shares)
    for i in range(total - sum(got.values())):
        got[names[i % len(names)]] += 1
    return got


def draw_key(u: Column, weight: Column) -> Column:
    """Efraimidis-Spirakis key: the smallest are a weighted draw without replacement; rows of no weight come last."""
    return F.when(weight > 0, -F.log(F.greatest(u, F.lit(1e-18))) / weight).otherwise(F.lit(float("inf")))


def draw(rows: DataFrame, target: int, shares: dict[str, float], weights: dict[str, float], u: Column) -> DataFrame:
    """target rows: each rating its quota by weighted draw, the rest from what is left of all ratings. One row per id."""
    if target <= 0:
        return rows.limit(0)
    want = quotas(target, shares)
    # Only ids, ratings and keys are ranked; the drawn ids fetch their rows.
    keyed = cut(rows.select("id", "rating", draw_key(u, tags.include_weight(F.col("tag_string"), weights)).alias("_key")))
    quota = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in want.items() for x in kv]), F.col("rating")), F.lit(0))
    rank = F.row_number().over(W.partitionBy("rating").orderBy("_key", "id"))
    # A rank limit by a literal lets every task drop what cannot be among the first before ratings meet in their tasks.
    first = keyed.withColumn("_rank", rank).filter(F.col("_rank") <= max(want.values())).filter(F.col("_rank") <= quota).drop("_rank")
    # The fill takes the next best of any rating, so both passes are one ordered limit.
    rest = keyed.join(first.select("id"), "id", "left_anti")
    drawn = first.withColumn("_late", F.lit(0)).unionByName(rest.withColumn("_late", F.lit(1))).orderBy("_late", "_key", "id").limit(target)
    return rows.join(drawn.select("id"), "id", "left_semi")


def sample_tiers(tiers: DataFrame, targets: dict[str, int], shares: dict[str, float], weights: dict[str, float], u: Callable[[str], Column], total: int | None = None) -> DataFrame:
    """Rows of quality_label tiers by target, best tier first; what a tier cannot give is asked of the next one.

    A post whose parent group gave a post in an earlier tier is left out. Four small driver steps; rows stay in Spark.
    """
    rows = tiers.withColumn("parent_group", F.coalesce("parent_id", "id"))
    taken, deficit, got = None, 0, 0
    for tier in TIERS:
        mine = rows.filter(F.col("quality_label") == tier)
        if taken is not None:
            mine = mine.join(taken.select("parent_group").distinct(), "parent_group", "left_anti")
        want = targets.get(tier, 0) + deficit
        part = cut(draw(mine, want, shares, weights, u(tier)))
        n = part.count() if want > 0 else 0
        deficit, got = max(0, want - n), got + n
        part = part.withColumn("quality_tier", F.lit(tier))
        taken = part if taken is None else taken.unionByName(part)
    if total is not None and got < total:
        rest = rows.join(taken.select("parent_group").distinct(), "parent_group", "left_anti")
        more = rest.orderBy(u("fill"), "id").limit(total - got).withColumn("quality_tier", F.col("quality_label"))
        taken = taken.unionByName(more)
    return taken


def uniform(rows: DataFrame, n: int, u: Column) -> DataFrame:
    return rows.orderBy(u, "id").limit(n)


def high_quality(labels: DataFrame, tiers: DataFrame, n: int, u: Callable[[str], Column], wanted: tuple[str, ...] = ("masterpiece", "good_score"), best: str = "best") -> DataFrame:
    """(id, relative_path, taken_as): n labelled files of each wanted tier, then n of the best label among the others.

    labels: (relative_path, aesthetic_label), whose id is the file's name; tiers: (id, final_tier).
    """
    rows = labels.withColumn("id", tags.id_of_path(F.col("relative_path"))).join(tiers.select("id", "final_tier"), "id", "left")
    parts = [rows.filter(F.col("final_tier") == t).orderBy(u(t), "relative_path").limit(n).withColumn("taken_as", F.lit(t)) for t in wanted]
    taken = cut(reduce(DataFrame.unionByName, parts).select("id", "relative_path", "taken_as"))
    rest = rows.filter(F.col("aesthetic_label") == best).join(taken.select("id"), "id", "left_anti").orderBy(u(best), "relative_path").limit(n)
    return taken.unionByName(rest.select("id", "relative_path", F.lit(best).alias("taken_as")))


SAMPLED = ("id", "quality_tier", "rating", "tag_string", "file_url", "large_file_url", "image_width", "image_height")


def sample_posts(main: DataFrame, prior: DataFrame, excluded: DataFrame, total: int, qualities: dict[str, float], shares: dict[str, float], weights: dict[str, float], u: Callable[[str], Column], artists: list[str], characters: list[str], skip: dict[str, float] | None = None) -> DataFrame:
    """The sampling run: earlier posts of wanted artists stay whole, then those of wanted characters, then tiers of main."""
    from .impute import imputed
    from .relational import skip_tags, target_filter, without
    from .tiering import quality_tiers

    main, prior = imputed(main), imputed(prior)
    main = without(target_filter(main, characters, artists), prior.select("id"), excluded.select("id"))
    prior = cut(quality_tiers(prior, artists))
    by_artist = prior.filter("protected").withColumn("quality_tier", F.when(F.col("quality_label") == "worse_score", "bad_score").otherwise(F.col("quality_label")))
    n_artist = by_artist.count() if artists else 0
    if not artists:
        by_artist = by_artist.limit(0)
    if n_artist >= total:
        return uniform(by_artist, total, u("prior")).select(*SAMPLED)
    by_character = prior.join(by_artist.select("id"), "id", "left_anti").withColumn("quality_tier", F.col("quality_label"))
    n_character = by_character.count()
    kept = by_artist
    if total - n_artist - n_character > 0:
        kept, tiers = by_artist.unionByName(by_character), quality_tiers(main, artists)
    else:
        tiers = by_character.drop("quality_tier")
    tiers = without(tiers, excluded.select("id"))
    if skip:
        tiers = skip_tags(tiers, skip, lambda tag: u(f"skip:{tag}"), artists)
    tiers = cut(tiers)
    have = {r["quality_tier"]: r["count"] for r in kept.groupBy("quality_tier").count().collect()}
    targets = {t: max(0, int(total * qualities.get(t, 0.0)) - have.get(t, 0)) for t in TIERS}
    new = sample_tiers(tiers, targets, shares, weights, u, total - sum(have.values()))
    columns = [c for c in SAMPLED if c in new.columns]
    return kept.select(*columns).unionByName(new.select(*columns))
