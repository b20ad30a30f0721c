"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

A word falls when a window of `window` consecutive words that covers it also starts in a document with a smaller doc_id.

Documents are cut into reference blocks that depend on content alone: every window names one of its word runs (the one
of `window`/2+1 words with the least hash, the last of equals) as its anchor, and neighbouring windows with one anchor make a
block. The blocks of all documents are indexed by anchor and by the hash of the whole block. A document's matches in the
index are found block by block: a block that occurs whole in a smaller document is a match of its whole length; where
only the anchor agrees the match ends inside the block, at a factor's boundary, and windows are compared one by one there.
Equal windows always share their anchor, so nothing is missed. Then the document is factored greedily from left to right:
the longest match at the place reached is the next factor, a word without a match is a literal. Matches are as long as
the window at least, so every factor is part of a duplicate span. One document's copies of each different block stand for
all its copies (in later documents the whole block is duplicate), so nothing grows with the square of a group, and rows of
a common passage are dealt over tasks.

Blocks and windows are equal when two 64-bit hashes of them are; texts are not looked at again.

Defined results: null or empty text has no words; texts shorter than the window lose nothing; rows that repeat a doc_id
are taken for the same text; a null doc_id is neither smaller nor larger, so it keeps all; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import bounded_broadcast, cut, spread_join
from .hashed import ids_of


def least_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """Position of the least of each `size` neighbours, the last of equals."""
    at = np.arange(len(hashes))
    width = 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] <= hashes[a], b, a)

    while 2 * width <= size:
        at = better(at[:-width], at[width:])
        width *= 2
    if width < size:
        at = better(at[: len(at) - (size - width)], at[size - width :])
    return at


def span_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to each end."""
    up, down = wordhash.powers(len(h), 0xC2B2AE3D27D4EB4F)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return wordhash.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x165667B19E3779F9))


def blocks(h: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash, block hash) of each block, in order of the texts."""
    run = window // 2 + 1
    ok = np.flatnonzero(wordhash.within(bounds, window, len(h)))
    if not len(ok):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    grams = wordhash.runs(h, run)
    anchor = least_of(grams, window - run + 1)[ok]
    # Windows of different texts share no anchor, since an anchor lies inside its window.
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1] + 1))))
    size = np.diff(np.concatenate((first, [len(ok)])))
    start = ok[first]
    return start, size, grams[anchor[first]], span_hashes(h, start, start + size - 1 + window)


def repeats(text: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which blocks occur earlier in their own text."""
    order = np.lexsort((whole, text))
    out = np.zeros(len(text), bool)
    out[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    return out


def _index(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, data, offsets in wordhash.chunks(b.column(1)):
                h, bounds, _, _ = wordhash.words(data, offsets)
                n = np.diff(bounds)
                start, size, anchor, whole = blocks(h, bounds, window)
                ends = np.searchsorted(start, bounds).astype(np.int32)
                text = np.searchsorted(bounds, start, "right") - 1
                raw = data.tobytes()
                digests = [hashlib.sha256(b" ".join(raw[x:y].split())).digest() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in ((start - bounds[text]).astype(np.int32), size.astype(np.int32), anchor.view(np.int64), whole.view(np.int64), repeats(text, whole))]
                yield pa.record_batch([b.column(0)[at : at + len(n)], pa.array(n.astype(np.int64)), pa.array(digests, pa.binary()), *lists], ["doc_id", "n_words", "sha", "start", "size", "anchor", "whole", "again"])

    return run


def _windows(window: int):
    """Rows (doc_id, text, wanted): every window of the wanted blocks, as (anchor, hash, doc_id, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, wanted = ids_of(b), b.column(2)
            for at, data, offsets in wordhash.chunks(b.column(1)):
                h, bounds, _, _ = wordhash.words(data, offsets)
                each = wordhash.runs(h, window)
                again = span_hashes(h, np.arange(len(each)), np.arange(len(each)) + window)
                part = wanted[at : at + len(offsets) - 1]
                text = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy(zero_copy_only=False))
                flat = part.flatten()
                start, size, anchor = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
                which = np.repeat(np.arange(len(start)), size)
                own = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                there = own + bounds[text[which]]
                fits = (there + window <= bounds[text[which] + 1]) & (own >= 0)
                which, own, there = which[fits], own[fits], there[fits]
                yield pa.record_batch([pa.array(anchor[which]), pa.array((each[there] ^ again[there] * np.uint64(3)).view(np.int64)), pa.array(ids[at + text[which]]), pa.array(own.astype(np.int32))], ["anchor", "hash", "doc_id", "start"])

    return run


def factored(n: int, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Greedy factors [start, end) of n words, given the matches in the index [start, end); words between are literals."""
    order = np.argsort(starts, kind="stable")
    begins, reach = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    out, at = [], 0
    while at < n:
        # The tail of a match is a match as well, so the longest one here is the one that reaches farthest.
        k = int(np.searchsorted(begins, at, "right"))
        if k and reach[k - 1] > at:
            out.append((at, min(int(reach[k - 1]), n)))
            at = out[-1][1]
        elif k < len(begins):
            at = int(begins[k])
        else:
            break
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 100):
            ids, removed, digests, kept = [], [], [], []
            for doc_id, text, factors in zip(*(c.to_pylist() for c in b.slice(i, 100).columns), strict=True):
                words = (text or "").encode().split()
                spans = factored(len(words), np.array([f["start"] for f in factors], np.int64), np.array([f["end"] for f in factors], np.int64))
                edges = [0, *(x for span in spans for x in span), len(words)]
                left = b" ".join(w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y])
                ids.append(doc_id)
                removed.append(sum(y - x for x, y in spans))
                digests.append(hashlib.sha256(left).digest())
                kept.append(left.decode())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.string())], ["doc_id", "n_removed", "kept_sha", "kept_text"])


def parse(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(index, factors): one row per document (doc_id, n_words, sha, ...), and the long factors (doc_id, factors, text)."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    index = cut(rows.mapInArrow(_index(window), "doc_id long, n_words long, sha binary, start array<int>, size array<int>, anchor array<long>, whole array<long>, again array<boolean>"), "index")
    each = index.filter("doc_id is not null").select("doc_id", F.explode(F.arrays_zip("start", "size", "anchor", "whole", "again")).alias("b")).select("doc_id", "b.*")
    # Anchors that occur once cannot start a factor; counting is pre-aggregated, so a common passage costs no task more.
    shared = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), (F.min("whole") != F.max("whole")).alias("mixed")).filter("n > 1")
    met = cut(spread_join(each, cut(shared, "shared"), ["anchor"], ["doc_id", "start"]).drop("n"), "met")
    first = cut(met.groupBy("anchor", "whole", "mixed").agg(F.min(F.struct("doc_id", "start", "size")).alias("first"), F.count(F.lit(1)).alias("n")), "first")
    again = first.filter("n > 1").select("anchor", "whole", "n", F.col("first.doc_id").alias("holder"))
    long = spread_join(met, again, ["anchor", "whole"], ["doc_id", "start"]).filter("doc_id > holder").select("doc_id", "start", (F.col("start") + F.col("size") - 1 + window).alias("end"))
    ids = cut(met.select("doc_id").distinct(), "ids")
    texts = cut(rows.join(bounded_broadcast(ids, ids.count(), 16), "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text")), "texts")
    # Factor boundaries: of every block that differs from another one of its anchor, the windows of all copies in the
    # first document that holds it. Long factors reach later documents only, so that document's own repeats count too.
    edge = first.filter("mixed").select("anchor", "whole", F.col("first.doc_id").alias("doc_id"), F.col("first.start").alias("start"), F.col("first.size").alias("size"))
    own = met.filter("again and mixed").select("anchor", "whole", "doc_id", "start", "size").join(edge.select("anchor", "whole", "doc_id"), ["anchor", "whole", "doc_id"])
    edge = edge.unionByName(own).select("doc_id", F.struct("start", "size", "anchor").alias("b"))
    edge = texts.join(edge.groupBy("doc_id").agg(F.collect_list("b").alias("wanted")), "doc_id").select("doc_id", "text", "wanted")
    windows = cut(edge.mapInArrow(_windows(window), "anchor long, hash long, doc_id long, start int"), "windows")
    holders = cut(windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "holders")
    short = spread_join(windows, holders, ["anchor", "hash"], ["doc_id", "start"]).filter("doc_id > holder").select("doc_id", "start", (F.col("start") + window).alias("end"))
    # A document's factors are no more than its windows.
    factors = long.unionByName(short).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("factors"))
    return index.select("doc_id", "n_words", "sha"), texts.join(factors, "doc_id").select("doc_id", "text", "factors")


def removed(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    index, factors = parse(docs, window, id_col, text_col)
    hit = factors.mapInArrow(_remove, "doc_id long, n_removed long, kept_sha binary, kept_text string").drop("kept_text")
    out = index.join(hit, "doc_id", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"))


def deduplicated(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): kept words joined by one space of each document that lost some."""
    return parse(docs, window, id_col, text_col)[1].mapInArrow(_remove, "doc_id long, n_removed long, kept_sha binary, kept_text string").select("doc_id", F.col("kept_text").alias("text"))
