"""Cross-entropy difference scores.

Two bigram models with one vocabulary, one order and one smoothing: the target model is counted on all documents labelled
good (of several labels of one document the mean counts), the background model on every document. A document's score is the mean over
its words of target loss minus background loss, in nats; lower is more like the target. The models are matched in all
but their counts: vocabulary, order and smoothing are one and the same, so what a single occurrence weighs against the
smoothing is the same in both. A document's own n-grams are left out of both models (of the target where it is labelled
good), so documents the models were counted on are not favoured.

Every n-gram has its own counter, told apart by 56-bit hashes. Documents are dealt into chunks; a chunk sends its different
n-grams, sorted and packed, in ranges of hashes to where each range is added up over all chunks, and gets the sums back in
the same order. So the counts are a distributed table that grows with the input, a task works on one range or one chunk
at a time, and a common n-gram is one entry of a chunk. Ids of good documents go to the chunks; nothing is broadcast.

Defined results: null text is empty and scores 0 with 0 words; a text of one word is scored by the unigram models; with
no document labelled good the target is the whole corpus and all scores are 0; repeated rows score alike; rows without a
doc_id are never labelled; doc_ids are taken as longs; an empty table gives an empty result; further columns of the input
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import cut, free_shuffles
from .hashed import sums_by_text

#: Words that the unigram models allow for at least; beyond it the corpus' different words count.
WORDS = 1 << 20
#: Words that the unigram model weighs in each bigram context.
BACKOFF = 8.0
#: Bytes of text whose n-grams are sent together, and bytes of all text for each range of hashes, at the least; large
#: inputs take up to 8 times as much, so the pieces that chunks send to ranges do not get ever smaller.
CHUNK, RANGE = 4 << 20, 16 << 20
#: Bytes of all text for each task.
TASK = 64 << 20
#: Bits of an n-gram's hash.
BITS = 56


def bigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, bounds by text, pair hashes, True where a word has a word before it in its text).

    Hashes of words are odd, hashes of pairs even.
    """
    h, bounds, _, _ = wordhash.words(data, offsets, lower=True)
    follows = np.ones(len(h), bool)
    follows[bounds[:-1][bounds[:-1] < len(h)]] = False
    pairs = wordhash.mix(np.concatenate((h[:1], h[:-1])) * np.uint64(31) + h)
    h, pairs = (x >> np.uint64(64 - BITS) for x in (h, pairs))
    return h | np.uint64(1), bounds, pairs & ~np.uint64(1), follows


def own(items: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """How often each item occurs in the item's own text."""
    _, at, n = np.unique(text * size + items, return_inverse=True, return_counts=True)
    return n[at]


def losses(word_n: np.ndarray, before_n: np.ndarray, pair_n: np.ndarray, total: np.ndarray, follows: np.ndarray, vocabulary: int) -> np.ndarray:
    """Loss of each word from counts of the word, of the word before it, of both, and of all words."""
    alone = (word_n + 1.0) / (total + vocabulary)
    # Words that begin their text have no word before them; what stands in before_n there is not theirs.
    before = np.where(follows, before_n, 0)
    return -np.log(np.where(follows, (pair_n + BACKOFF * alone) / (before + BACKOFF), alone))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, by planes of bytes, compressed."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in columns]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(data: bytes, n: int, *types: type) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize for t in types]
    raw, out, at = np.frombuffer(pa.decompress(data, n * sum(sizes), "zstd"), np.uint8), [], 0
    for t, size in zip(types, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(t).ravel())
        at += n * size
    return out


def chunk_grams(docs: pa.Table) -> tuple[np.ndarray, ...]:
    """(words of each text, True where a word has one before it, the chunk's different n-grams, numbers of words and of following pairs among these)."""
    parts = [bigrams(data, offsets) for _, data, offsets in wordhash.chunks(docs.column("text"))]
    h, pairs, follows = (np.concatenate([x[k] for x in parts]) for k in (0, 2, 3))
    n = np.concatenate([np.diff(x[1]) for x in parts])
    grams, at = np.unique(np.concatenate((h, pairs[follows])), return_inverse=True)
    return n, follows, grams, at[: len(h)], at[len(h) :]


def marked_good(docs: pa.Table, good: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.is_in(docs.column("doc_id").combine_chunks(), good).to_numpy(zero_copy_only=False), bool) & docs.column("doc_id").is_valid().to_numpy()


def _count(bits: int):
    """A chunk's documents and good ids: counts of its n-grams by range, with hashes as steps from one to the next."""

    def run(docs: pa.Table, good: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(docs):
            n, follows, grams, w, p = chunk_grams(docs)
            mine = np.repeat(marked_good(docs, good.column("doc_id").combine_chunks()), n)
            counts = [np.bincount(at, part, len(grams)) for at, part in ((w, None), (p, None), (w, mine), (p, mine[follows]))]
            counts = [(counts[k] + counts[k + 1]).astype(np.uint32) for k in (0, 2)]
            which = grams >> np.uint64(BITS - bits)
            starts = np.flatnonzero(np.diff(which, prepend=which[:1] + np.uint64(1)))
            steps = np.diff(grams, prepend=np.uint64(0))
            steps[starts] = grams[starts]
            chunk = docs.column("chunk")[0].as_py()
            out = [(chunk, int(which[a]), int(b - a), packed(steps[a:b], *(c[a:b] for c in counts))) for a, b in zip(starts, [*starts[1:], len(grams)], strict=True)]
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["chunk", "range", "size", "data"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, chunk, size, data) in order of range: for each the sums over all chunks; the range's totals once."""
    key, held = None, []

    def sums() -> Iterator[pa.RecordBatch]:
        parts = [unpacked(data, size, np.uint64, np.uint32, np.uint32) for _, size, data in held]
        grams, at = np.unique(np.concatenate([np.cumsum(x[0]) for x in parts]), return_inverse=True)
        totals = [np.bincount(at, np.concatenate([x[k] for x in parts]), len(grams)).astype(np.int64) for k in (1, 2)]
        word = (grams & np.uint64(1)).astype(bool)
        once = [[int(x), *[0] * (len(held) - 1)] for x in (word.sum(), *(t[word].sum() for t in totals))]
        ends = np.cumsum([x[1] for x in held])
        data = [packed(*(t[at[b - x[1] : b]] for t in totals)) for x, b in zip(held, ends, strict=True)]
        yield pa.record_batch([pa.array([x[0] for x in held], pa.int64()), pa.array([key] * len(held), pa.int32()), pa.array([x[1] for x in held], pa.int32()), pa.array(data, pa.binary()), *(pa.array(x, pa.int64()) for x in once)], ["chunk", "range", "size", "data", "words", "n", "n_good"])

    for b in batches:
        for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if k != key and held:
                yield from sums()
                held = []
            key = k
            held.append(row)
    if held:
        yield from sums()


def _score(total: int, back_total: int, vocabulary: int, whole: bool):
    """A chunk's documents, and its sums and good ids: the documents' scores. whole: the target is the whole corpus."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "target_loss", "background_loss", "difference"]
        if not len(docs):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), *[pa.float64()] * 3)], names)
        sums = sorted((r["range"], r["size"], r["data"]) for r in known.select(["range", "size", "data"]).filter(known.column("range").is_valid()).to_pylist())
        sums = [unpacked(data, size, np.int64, np.int64) for _, size, data in sums]
        back, target = (np.concatenate([x[k] for x in sums] or [np.zeros(0)]).astype(float) for k in (0, 1))
        if whole:
            target = back
        n, follows, grams, w, after = chunk_grams(docs)
        if len(grams) != len(back):
            raise RuntimeError("a chunk's n-grams are not those that were counted")
        bounds, text = np.concatenate(([0], np.cumsum(n))), np.repeat(np.arange(len(n)), n)
        p = np.zeros(len(w), np.int64)
        p[follows] = after
        own_w, own_p = own(w, text, len(grams)), np.zeros(len(w), np.int64)
        own_p[follows] = own(after, text[follows], len(grams))
        before, own_before = np.concatenate((w[:1], w[:-1])), np.concatenate((own_w[:1], own_w[:-1]))
        mine = np.ones(len(n), bool) if whole else marked_good(docs, known.column("doc_id").combine_chunks())
        part = mine[text]
        t = losses(target[w] - part * own_w, target[before] - part * own_before, target[p] - part * own_p, total - (mine * n)[text], follows, vocabulary)
        g = losses(back[w] - own_w, back[before] - own_before, back[p] - own_p, back_total - n[text], follows, vocabulary)
        t, g = (sums_by_text(x, bounds) / np.maximum(n, 1) for x in (t, g))
        return pa.table([docs.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(t), pa.array(g), pa.array(t - g)], names)

    return run


def sized(least: int, wanted: int, times: int) -> int:
    return max(least, min(wanted, least * times))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, target_loss, background_loss, difference."""
    n_bytes = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    n_chunks, bits = n_bytes // sized(CHUNK, n_bytes >> 13, 8) + 1, max(1, (n_bytes // sized(RANGE, n_bytes >> 10, 8)).bit_length())
    # Tasks grow with the input, so what one of them reads does not.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // TASK)
    dealt = lambda df: df.repartition(tasks, "chunk").groupBy("chunk")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(n_chunks)))
    good = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    good = cut(good.filter("quality > 0.5").select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).alias("chunk")), "good")
    parts = dealt(rows).cogroup(dealt(good)).applyInArrow(_count(bits), "chunk long, range int, size int, data binary")
    each = parts.select("range", "chunk", "size", "data").repartition(tasks, "range").sortWithinPartitions("range")
    sums = cut(each.mapInArrow(_add, "chunk long, range int, size int, data binary, words long, n long, n_good long"), "sums")
    words, back_total, total = (x or 0 for x in sums.agg(F.sum("words"), F.sum("n"), F.sum("n_good")).first())
    known = sums.select("chunk", "range", "size", "data").unionByName(good, allowMissingColumns=True)
    # The counting job's shuffles are let go before the texts are dealt out again.
    del parts, each
    free_shuffles(docs.sparkSession, now=True)
    score = _score(total or back_total, back_total, max(WORDS, words), not total)
    return dealt(rows).cogroup(dealt(known)).applyInArrow(score, "doc_id long, n_words long, target_loss double, background_loss double, difference double")
