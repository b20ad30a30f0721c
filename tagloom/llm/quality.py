"""Quality classification by importance resampling.

Two generative models over hashed n-grams (words and punctuation runs, and pairs of neighbours), one of target text
(documents labelled good, a sample bounded by `sample` rows), one of raw text (all documents), give every document a
weight: the mean over its n-grams of log p_target - log p_raw (with SHORT further n-grams of weight 0, so a few words
cannot decide). Documents are then resampled without replacement by Gumbel top-k: key = `length` * weight + Gumbel noise by
hash of the id, the k largest keys stay. That is the log importance weight of a text of `length` n-grams with the
document's mean, so all documents are judged as if they were of one length; sums over their own n-grams would draw by
length first. As with sums, the noise (deviation 1.28) is small against the weights of long texts: it decides among
documents whose means differ by about 1 / length, that is near the cut, and leaves clear cases alone, which a filter that
must keep clean documents needs. A smaller `length` resamples more freely. k is the number of documents whose weight passes the
cut that best parts the labels of the sample's second half, which the target model has not seen.

The k-th key is found by counting keys in ever finer histograms, never by a global sort.

Defined results: null text is empty; a text without n-grams is not kept; ties at the cut are all kept; repeated rows
share key and fate; rows without a doc_id have no label and share one draw of noise; doc_ids are taken as longs; with no
labels all non-empty documents stay; an empty table gives an empty result; further columns of the input are ignored, but
the one that `key_col` names is handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import cut, unit_hash
from .hashed import hashed_counts, ids_of, label_at, sample_labels, sums_by_text

BUCKETS = 1 << 18
#: N-grams of weight 0 added to each text.
SHORT = 16
#: Bytes of one class make words; punctuation makes words of its own. Non-ASCII bytes and alphanumerics are letters.
_KIND = np.zeros(256, np.uint8)
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[128:] = 3
#: A capital and the lower-case letters after it stay together; capitals only are a shape of their own.
_SAME = np.where(_KIND == 2, 3, _KIND).astype(np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unigram hashes, bounds by text, bigram hashes, their bounds)."""
    h, bounds, _, _ = wordhash.words(data, offsets, also=_SAME)
    if len(h) < 2:
        return h, bounds, h[:0], np.zeros_like(bounds)
    pairs = wordhash.mix(h[:-1] * np.uint64(31) + h[1:])
    inside = np.ones(len(pairs), bool)
    inner = bounds[1:-1]
    inside[inner[(inner > 0) & (inner < len(h))] - 1] = False
    kept = np.concatenate(([0], np.cumsum(inside)))
    return h, bounds, pairs[inside], kept[np.minimum(bounds, len(pairs))]


def importance(docs: DataFrame, labels: DataFrame, sample: int = 20_000, smooth: float = 3.0) -> tuple[DataFrame, bool]:
    """(doc_id, weight, n_grams, label, key_of) of rows (doc_id, text, key_of), and whether there were any good and bad labels."""
    ids, marks = sample_labels(labels, "quality", sample)
    seen = (ids.view(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(2) == 0
    good, judged = ids[seen & (marks > 0.5)], (ids[~seen], marks[~seen])

    def both(ids_: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        h, bounds, pairs, pair_bounds = features(data, offsets)
        yield 0, h
        yield 1, pairs
        mine = np.isin(ids_, good)
        yield 2, h[np.repeat(mine, np.diff(bounds))]
        yield 3, pairs[np.repeat(mine, np.diff(pair_bounds))]

    counts = hashed_counts(docs, [BUCKETS] * 4, both)

    def ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
        # The target model leans on the raw one, so an n-gram that the sample lacks weighs little.
        p_raw = (raw + 1.0) / (raw.sum() + BUCKETS)
        p_target = (target + smooth * BUCKETS * p_raw) / (target.sum() + smooth * BUCKETS)
        return (np.log(p_target) - np.log(p_raw)).astype(np.float32)

    tables = docs.sparkSession.sparkContext.broadcast((ratio(counts[2], counts[0]), ratio(counts[3], counts[1])))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = tables.value
        for b in batches:
            all_ids = ids_of(b)
            for at, data, offsets in wordhash.chunks(b.column(1)):
                h, bounds, pairs, pair_bounds = features(data, offsets)
                mask = np.uint64(BUCKETS - 1)
                w = sums_by_text(one[h & mask], bounds) + sums_by_text(two[pairs & mask], pair_bounds)
                n = np.diff(bounds) + np.diff(pair_bounds)
                rows = slice(at, at + len(offsets) - 1)
                mark = label_at(all_ids[rows], *judged)
                yield pa.record_batch([b.column(0)[rows], pa.array(w / (n + SHORT)), pa.array(n.astype(np.int64)), pa.array(mark, mask=np.isnan(mark)), b.column(2)[rows]], ["doc_id", "weight", "n_grams", "label", "key_of"])

    both_kinds = bool(len(good) and (judged[1] > 0.5).any() and (judged[1] <= 0.5).any())
    return docs.mapInArrow(score, "doc_id long, weight double, n_grams long, label double, key_of long"), both_kinds


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight that parts good from bad labels with the best balanced accuracy."""
    order = np.argsort(weights)
    w, g = weights[order], good[order]
    lost = np.concatenate(([0.0], np.cumsum(g))) / max(g.sum(), 1)
    caught = np.concatenate(([0.0], np.cumsum(~g))) / max((~g).sum(), 1)
    at = int(np.argmax(caught - lost))
    return float(w[0] - 1 if at == 0 else w[-1] + 1 if at == len(w) else (w[at - 1] + w[at]) / 2)


def kth_largest(keys: DataFrame, k: int, bins: int = 4096, rounds: int = 6) -> float:
    """A lower bound of the k-th largest value of column key, exact to 1/bins^rounds of the range: ties stay in."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    for _ in range(rounds):
        step = (high - low) / bins
        if step <= 0 or low + step == low:
            break
        at = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(step)), F.lit(bins - 1)).cast("int")
        inside = keys.filter(F.col("key").between(low, high)).groupBy(at.alias("bin")).count().collect()
        per = np.zeros(bins, np.int64)
        for b, n in inside:
            per[b] = n
        upto = above + np.cumsum(per[::-1])
        hit = int(np.argmax(upto >= k)) if upto[-1] >= k else bins - 1
        b = bins - 1 - hit
        above = int(upto[hit] - per[b])
        low, high = low + b * step, low + (b + 1) * step
        if above + per[b] == k:
            break
    return low


def classify(docs: DataFrame, labels: DataFrame, sample: int = 20_000, length: float = 500.0, seed: str = "gumbel", id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, weight (mean log importance), n_grams, key, kept, and key_col's column."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), (docs[key_col] if key_col else F.lit(None)).cast("long").alias("key_of"))
    scored, both = importance(rows, labels, sample)
    scored = cut(scored, "weights")
    some = F.col("n_grams") > 0
    # The judged half of the sample: as many documents at most; rows that share an id count once, with the best weight.
    marked = scored.filter("label is not null and n_grams > 0").groupBy("doc_id").agg(F.max("weight"), F.max("label")).collect() if both else []
    if marked:
        edge = best_cut(np.array([r[1] for r in marked]), np.array([r[2] for r in marked]) > 0.5)
        gumbel = -F.log(-F.log(unit_hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))))
        scored = scored.withColumn("key", F.col("weight") * F.lit(float(length)) + gumbel)
        k = scored.filter(some & (F.col("weight") > edge)).count()
        kept = some & (F.col("key") >= F.lit(kth_largest(scored.filter(some), k)))
    else:
        scored, kept = scored.withColumn("key", F.col("weight")), some
    return scored.select("doc_id", "weight", "n_grams", "key", kept.alias("kept"), *([F.col("key_of").alias(key_col)] if key_col else []))
