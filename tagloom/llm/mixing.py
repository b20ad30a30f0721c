"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of all words by weight, held under a multiple of its own size with the excess shared out
again. Whole epochs of a source come first; what is left of the target is drawn without replacement: every document has
the exponential key -ln(u) / quality weight, documents are taken in key order while the prefix sum of their sizes stays
within half a document of the budget.

The prefix sums never need a source in one task: keys fall in ordered buckets, bucket sums give the bucket where the
budget ends, and only that bucket's documents are sorted.

Defined results: null text has size 0; null source is a source of its own, last in order; documents of size 0 take 0;
no words at all gives targets 0; repeated rows are separate documents; ties in key go to the smaller doc_id, then size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, text_of, unit_hash

#: Documents of one source that share a key bucket, on average.
PER_BUCKET = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target) of rows (source, size); one row per source all along."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("top", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("top") / F.col("w"))
    # Water level: sources fill up in order of cap / weight; the level is that of the first source that stays under its cap.
    everyone, before = W.partitionBy(), W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    left_w = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("top").over(before), F.lit(0.0))
    per = per.withColumn("level", left / left_w)
    level = F.min(F.when(F.col("level") <= F.col("ratio") * (1 + 1e-12), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(everyone)
    per = per.withColumn("level", level["level"])
    return per.select("source", "source_size", "n_docs", F.least("top", F.col("level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, quality_by_id: DataFrame | None = None, seed: str = "mix", weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs.

    quality_by_id: (doc_id, weight), one row per doc_id, weights above 0 (1 where missing); heavier documents tend to
    come earlier in the fractional part. It is joined to sizes, so texts are not shuffled.
    """
    rows = docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"), F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("long").alias("size"),
        F.coalesce(docs[source_col], F.lit("\u0001null")).alias("src"),
    )
    if quality_by_id is None:
        rows = rows.withColumn("weight", F.lit(1.0))
    else:
        rows = rows.join(quality_by_id, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    rows = rows.withColumn("key", -F.log(unit_hash(seed, F.coalesce("doc_id", F.lit(-1)))) / F.col("weight")).drop("weight")
    rows = cut(rows, "sizes")
    per = cut(source_targets(rows.select("source", "size"), weights, cap), "targets")
    per = per.withColumn("src", F.coalesce("source", F.lit("\u0001null"))).drop("source")
    per = per.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    per = per.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("n_buckets", F.ceil(F.col("n_docs") / PER_BUCKET))
    # 1 - exp(-key) grows with the key and lies in [0, 1).
    joined = rows.join(per, "src").withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("n_buckets")).cast("long"))
    sums = joined.groupBy("src", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.coalesce(F.sum("words").over(W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # first: a bucket wholly before the end of the budget is taken whole, one wholly after it not at all.
    sums = cut(sums.select("src", "bucket", upto.alias("before"), (upto + F.col("words")).alias("after")), "buckets")
    edge = joined.join(sums, ["src", "bucket"])
    inside = F.sum("size").over(W.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1))
    fields = ["doc_id", "source", "size", "source_size", "target", "epochs"]
    sure = edge.filter("after <= rest or before > rest").withColumn("more", F.col("after") <= F.col("rest")).select(*fields, "more")
    unsure = edge.filter("after > rest and before <= rest").withColumn("start", F.col("before") + F.coalesce(inside, F.lit(0)))
    unsure = unsure.withColumn("more", F.col("start") + F.col("size") / 2.0 <= F.col("rest")).select(*fields, "more")
    both = sure.unionByName(unsure)
    taken = F.col("size") * (F.col("epochs") + F.col("more").cast("long"))
    return both.select("doc_id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), taken.cast("long").alias("taken"), "epochs")
