"""Near-duplicate groups of 64-bit hashes: exact Hamming pairs by bands, components, survivors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage import cut, drop, written


def sign_bits(vector: Column) -> Column:
    """The signs of a vector's first 64 numbers as a 64-bit integer, the first the highest bit."""
    bits = F.transform(F.slice(vector, 1, 64), lambda x: F.when(x > 0, "1").otherwise("0"))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b.cast("bigint")))


def band(value: Column, i: int, n: int) -> Column:
    """Bits of band i of n, counted from the low end."""
    low, high = 64 * i // n, 64 * (i + 1) // n
    if n == 1:
        return value
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def hamming_pairs(rows: DataFrame, distance: int, inclusive: bool = False) -> DataFrame:
    """(a, b, distance) with a < b of rows (id, hash) nearer than distance.

    Two hashes within d bits agree in one of d+1 bands, so equi-joins by band miss nothing. Equal hashes are joined as
    one: bands meet each different hash once, and pairs of ids come from the groups afterwards. All pairs are the result
    itself; for groups, near_groups needs none of them.
    """
    most = distance if inclusive else distance - 1
    if most < 0:
        return rows.sparkSession.createDataFrame([], "a long, b long, distance int")
    rows = rows.select("id", "hash")
    near = near_hashes(rows, most).union(rows.select("hash", F.col("hash").alias("other"), F.lit(0)).distinct())
    a, b = rows.select(F.col("id").alias("x"), "hash"), rows.select(F.col("id").alias("y"), F.col("hash").alias("other"))
    pairs = near.join(a, "hash").join(b, "other").filter((F.col("hash") != F.col("other")) | (F.col("x") < F.col("y")))
    return pairs.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance").distinct()


def near_hashes(rows: DataFrame, most: int) -> DataFrame:
    """(hash, other, distance) with hash < other of the different hashes within `most` bits."""
    bands = F.array(*[F.struct(F.lit(i).alias("band"), band(F.col("hash"), i, most + 1).alias("bits")) for i in range(most + 1)])
    one = cut(rows.select("hash").filter("hash is not null").distinct()).select("hash", F.explode(bands).alias("x")).select("hash", "x.band", "x.bits")
    far = F.bit_count(F.col("hash").bitwiseXOR(F.col("other")))
    met = one.join(one.withColumnRenamed("hash", "other"), ["band", "bits"]).filter((F.col("hash") < F.col("other")) & (far <= most))
    return met.select("hash", "other", far.cast("int").alias("distance")).distinct()


def near_groups(rows: DataFrame, distance: int, inclusive: bool = False) -> DataFrame:
    """(id, group) of the ids that have another one nearer than distance, over any steps; the group is its least id.

    Ids of one hash stand for each other, so no pairs of equal hashes are made.
    """
    most = distance if inclusive else distance - 1
    rows = rows.select("id", "hash").filter("hash is not null")
    if most < 0:
        return rows.select("id", F.col("id").alias("group")).limit(0)
    first = cut(rows.groupBy("hash").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("n")))
    named = first.select("hash", F.col("rep").alias("a")), first.select(F.col("hash").alias("other"), F.col("rep").alias("b"))
    found = groups(near_hashes(rows, most).join(named[0], "hash").join(named[1], "other").select("a", "b"))
    member = first.join(found.withColumnRenamed("id", "rep"), "rep", "left").filter("group is not null or n > 1")
    return rows.distinct().join(member.select("hash", F.coalesce("group", "rep").alias("group")), "hash").select("id", "group")


def groups(pairs: DataFrame) -> DataFrame:
    """(id, group): least id reachable over the pairs; labels spread by neighbours and jump over their own label.

    Each round is written as a table; rounds go on until no label changes, which jumps make few.
    """
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select("b", "a")).distinct()
    both = written(both)
    labels = written(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("group")))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "group"), "other").groupBy("id").agg(F.min("group").alias("near"))
        step = labels.join(near, "id").select("id", F.least("group", "near").alias("group"), F.col("group").alias("before"))
        jump = step.select(F.col("id").alias("group"), F.col("group").alias("root"))
        new = written(step.join(jump, "group", "left").select("id", F.coalesce("root", "group").alias("group"), "before"))
        drop(labels)
        labels = new
        if new.filter("group != before").isEmpty():
            drop(both)
            return labels.select("id", "group")


def survivors(members: DataFrame) -> DataFrame:
    """Members (id, group, tier, tags, score, fav_count) that stay. Several tiers: all of the highest. One tier: of two the
    one with more tags, then score, then fav_count; of more the one with most tags and the best other score.
    Groups with a member without metadata stay whole."""
    group = W.partitionBy("group")
    rows = members.withColumn("_gap", F.max(F.col("tags").isNull().cast("int")).over(group)).withColumn("_tiers", F.size(F.collect_set("tier").over(group))).withColumn("_n", F.count(F.lit(1)).over(group))
    rows = rows.withColumn("_high", F.max("tier").over(group))
    most = F.row_number().over(group.orderBy(F.desc("tags"), F.desc("score"), F.desc("fav_count"), F.col("id")))
    rows = rows.withColumn("_most", most).withColumn("_top", F.row_number().over(group.orderBy((F.col("_most") == 1).cast("int"), F.desc("score"), F.col("id"))))
    one = F.when(F.col("_n") <= 2, F.col("_most") == 1).otherwise((F.col("_most") == 1) | (F.col("_top") == 1))
    stays = F.when(F.col("_gap") == 1, F.lit(True)).when(F.col("_tiers") > 1, F.col("tier") == F.col("_high")).otherwise(one)
    return rows.filter(stays).drop("_gap", "_tiers", "_n", "_high", "_most", "_top")


def exclusion(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(id) of what is expected and not found."""
    return expected.select("id").distinct().join(found.select("id").distinct(), "id", "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
