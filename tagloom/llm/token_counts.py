"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer digest, content digest, n_tokens) that outlives the run. A run joins its
documents' digests to it, encodes each distinct text that is missing once, appends the new counts and reads all documents'
counts from the cache. A digest that many rows share is dealt over tasks where counts meet rows.

Content is normalised only as far as the tokenizer itself ignores it: with ``spaces=True`` (for tokenizers that turn any
white space into one space before splitting) runs of blanks, tabs and line ends become one space. ``pieces=True`` is for
tokenizers that never join over blanks either: blank-separated pieces are counted once and remembered per worker. Both
are off unless the caller knows the tokenizer to be of that kind.

Defined results: null text is empty and has 0 tokens; repeated rows and equal texts share one cache row; ids are handed
on as they are, null ones too; an empty table appends nothing; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, exists, spread_join, text_of

#: Distinct pieces whose counts a Python worker remembers.
MEMO = 400_000
_loaded: dict[str, tuple] = {}


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], {})
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _loaded[path] = (lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)], {})
    return _loaded[path]


def count_tokens(texts: list[str], path: str, pieces: bool) -> list[int]:
    """Tokens of each text. pieces: the tokenizer never joins over ASCII blanks, so blank-separated pieces are counted
    by the library once and remembered."""
    count, memo = _load(path)
    if not pieces:
        return count(texts)
    if len(memo) > MEMO:
        memo.clear()
    split = [[w for w in t.split(" ") if w] for t in texts]
    new = list({w for ws in split for w in ws if w not in memo})
    for i in range(0, len(new), 2000):
        memo.update(zip(new[i : i + 2000], count(new[i : i + 2000]), strict=True))
    get = memo.__getitem__
    return [sum(map(get, ws)) for ws in split]


def encoder(path: str, pieces: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                n = count_tokens(part.column(1).to_pylist(), path, pieces)
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    if not exists(spark, cache):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema("tokenizer string, digest binary, n_tokens long").parquet(cache).filter(F.col("tokenizer") == version).select("digest", "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, cache: str, spaces: bool = False, pieces: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    text = text_of(docs, text_col)
    norm = F.regexp_replace(text, "[ \\t\\n\\r]+", " ") if spaces else text
    digest = F.unhex(F.sha2(norm, 256)).alias("digest")
    texts = docs.select(digest, norm.alias("norm"))
    if exists(spark, cache):
        texts = texts.join(read_cache(spark, cache, version), "digest", "left_anti")
    # Partial aggregation keeps one text per digest and task before anything is shuffled.
    misses = texts.groupBy("digest").agg(F.first("norm").alias("norm"))
    counts = misses.mapInArrow(encoder(tokenizer, pieces and spaces), "digest binary, n_tokens long")
    counts.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    rows = cut(docs.select(docs[id_col].alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest), "digests")
    # A lost and repeated append may leave a digest twice; equal counts fold into one.
    known = read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counted = cut(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).join(known, "digest"), "counted")
    out = spread_join(rows, counted, ["digest"], ["doc_id", "n_bytes"], how="left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
