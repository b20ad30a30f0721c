"""Training-corpus pipeline: five stages from documents to a weighted mix, each one operator of tagloom.llm.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept; its result is written
as Parquet and read again as the next stage's docs. All stages but the last return the columns of documents; the last
returns one row per document of the mix.

Stages decide on rows, told apart by a hash of doc_id and text, so of two texts that share a doc_id one may go and the
other stay, and rows without a doc_id take part. Of fully repeated rows exact dedup leaves one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import bounded_broadcast, cut, settled, ship, table
from tagloom.llm.decontaminate import contaminated
from tagloom.llm.exact_dedup import exact_groups
from tagloom.llm.jaccard_join import similarity_groups
from tagloom.llm.mixing import mix
from tagloom.llm.quality import classify
from tagloom.llm.queries import quality_weights

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


KEY = "tagloom_row"


def by_row(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def without(docs: DataFrame, rejected: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """docs without the rows that an operator rejects.

    The operator's scratch tables go as soon as the keys are written. These are broadcast while they are few and shuffled
    with docs beyond.
    """
    ship(docs.sparkSession)
    rows = by_row(docs)
    keys = settled(lambda: rejected(rows).select(KEY).distinct(), "keys")
    return rows.join(bounded_broadcast(keys, keys.count(), 16), KEY, "left_anti").select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return without(docs, lambda rows: classify(rows, table(spark, sf_dir, "labels"), key_col=KEY).filter("not kept"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    ship(spark)
    rows = by_row(docs)
    judged = settled(lambda: exact_groups(rows, key_col=KEY).groupBy(KEY).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1 or not stays"), "keys")
    out = rows.join(bounded_broadcast(judged.select(KEY), judged.count(), 16), KEY, "left_anti").select(docs.columns)
    # Rows that repeat in id and text: one of them stays, the least in its other columns.
    twice = judged.filter("stays")
    again = rows.join(bounded_broadcast(twice.select(KEY), twice.count(), 16), KEY, "left_semi").groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return out.unionByName(again.select("row.*"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 over five-word shingles the one with the smallest id stays; rows
    without an id stay."""
    return without(docs, lambda rows: similarity_groups(rows, words=5, percent=80, key_col=KEY).filter("component_id != doc_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with new numbers and names, go."""
    return without(docs, lambda rows: contaminated(rows, table(spark, sf_dir, "benchmark"), key_col=KEY))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, sources weighing 5, 2, 1 in turn; documents it leaves out have 0."""
    mixed = mix(docs, quality_weights(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "epochs")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot express the quality and template stages; tests/llm holds the pipeline against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
