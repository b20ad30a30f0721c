"""Exact deduplication through counting quotient filters.

Every partition of the input builds a counting quotient filter over 64-bit fingerprints of its texts: a quotient names a
run, the run holds sorted remainders with counters. Quotient and remainder together are the whole fingerprint, so
filters merge without loss: two filters in one linear pass over their sorted remainders, many filters pairwise, those of
like size first. Filters are shipped and merged in blocks by leading quotient bits; the number of blocks grows with the
input, so a block's merged filter does not. Fingerprints counted more than once send their texts to verification byte by
byte; all others are unique for certain.

Defined results: null text is empty; empty (or white-space-only) texts form one group; of equal texts exactly one row is
kept, the one with the most code points, then the smallest doc_id (rows without one come last), then, among repeated rows
of one doc_id, the first as read; keep_id is that row's doc_id, so it is null where no row of the group has one; an empty
table gives an empty result; further columns of the input are ignored, but the one that `key_col` names is handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_join, squeezed, text_of

#: Quotient bits; the remaining 64 - Q bits are the remainder.
Q = 24
#: Fingerprints of a block on average, the unit in which filters are shipped and merged.
PER_BLOCK = 1 << 16


class CountingQuotientFilter:
    """Runs by quotient, each of sorted remainders with counters; lossless for 64-bit fingerprints."""

    def __init__(self, quotients: np.ndarray, run_ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.quotients, self.run_ends, self.remainders, self.counts = quotients, run_ends, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        order = np.argsort(fingerprints, kind="stable")
        f = fingerprints[order]
        c = np.ones(len(f), np.int64) if counts is None else counts[order].astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1]))) if len(f) else np.zeros(0, np.int64)
        return cls.sorted(f[new], np.add.reduceat(c, new) if len(f) else c)

    @classmethod
    def sorted(cls, f: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From different fingerprints in order."""
        q = (f >> np.uint64(64 - Q)).astype(np.uint32)
        last = np.flatnonzero(np.concatenate((q[1:] != q[:-1], [True]))) if len(f) else np.zeros(0, np.int64)
        return cls(q[last], (last + 1).astype(np.uint32), f & np.uint64((1 << (64 - Q)) - 1), counts)

    def fingerprints(self) -> np.ndarray:
        lengths = np.diff(np.concatenate(([0], self.run_ends)))
        return (np.repeat(self.quotients.astype(np.uint64), lengths) << np.uint64(64 - Q)) | self.remainders

    def __len__(self) -> int:
        return len(self.remainders)

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """One pass over both: remainders of this filter stay in place, new ones go between them, counters add up."""
        mine, theirs = self.fingerprints(), other.fingerprints()
        at = np.searchsorted(mine, theirs)
        met = np.zeros(len(theirs), bool)
        inside = at < len(mine)
        met[inside] = mine[at[inside]] == theirs[inside]
        counts = self.counts.copy()
        counts[at[met]] += other.counts[met]
        return CountingQuotientFilter.sorted(np.insert(mine, at[~met], theirs[~met]), np.insert(counts, at[~met], other.counts[~met]))

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        more = self.counts > 1
        return self.fingerprints()[more], self.counts[more]

    def blocks(self, bits: int) -> Iterator[tuple[int, bytes]]:
        """The filter in pieces by leading quotient bits: lengths, quotients, ends of runs, remainders of 5 bytes, and the
        places and values of counters other than 1."""
        f = self.fingerprints()
        if not len(f):
            return
        cuts = np.flatnonzero(np.diff((f >> np.uint64(64 - bits)).astype(np.int64), prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(f)], strict=True):
            part = CountingQuotientFilter.sorted(f[a:b], self.counts[a:b])
            more = np.flatnonzero(part.counts != 1)
            arrays = (
                np.array([len(part.quotients), len(part), len(more)], np.uint32), part.quotients, part.run_ends, (part.remainders & np.uint64(0xFFFFFFFF)).astype(np.uint32), more.astype(np.uint32),
                part.counts[more].astype(np.int64), (part.remainders >> np.uint64(32)).astype(np.uint8),
            )
            yield int(f[a] >> np.uint64(64 - bits)), b"".join(x.tobytes() for x in arrays)

    @classmethod
    def read(cls, blob: bytes) -> CountingQuotientFilter:
        at = 12

        def take(t: type, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, t, n, at)
            at += out.nbytes
            return out

        n, m, k = (int(x) for x in np.frombuffer(blob, np.uint32, 3))
        q, e, low, more, values = take(np.uint32, n), take(np.uint32, n), take(np.uint32, m), take(np.uint32, k), take(np.int64, k)
        counts = np.ones(m, np.int64)
        counts[more] = values
        return cls(q, e, low.astype(np.uint64) | take(np.uint8, m).astype(np.uint64) << np.uint64(32), counts)


class Merger:
    """Filters merged pairwise, those of like size first, so all of them cost a logarithm of passes."""

    def __init__(self):
        self.parts: list[CountingQuotientFilter] = []

    def add(self, part: CountingQuotientFilter) -> None:
        self.parts.append(part)
        while len(self.parts) > 1 and len(self.parts[-2]) <= 2 * len(self.parts[-1]):
            last = self.parts.pop()
            self.parts[-1] = self.parts[-1].merge(last)

    def whole(self) -> CountingQuotientFilter:
        out = CountingQuotientFilter.of(np.zeros(0, np.uint64))
        while self.parts:
            out = self.parts.pop().merge(out)
        return out


def _build(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, merger = [], 0, Merger()
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size > 1 << 20:
                merger.add(CountingQuotientFilter.of(np.concatenate(held)))
                held, size = [], 0
        if held:
            merger.add(CountingQuotientFilter.of(np.concatenate(held)))
        keys, blobs = [], []
        for key, blob in merger.whole().blocks(bits):
            keys.append(key)
            blobs.append(blob)
            if len(keys) == 256:
                yield pa.record_batch([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["block", "filter"])
                keys, blobs = [], []
        if keys:
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["block", "filter"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted, so all filters of one block are neighbours."""
    at, merger = None, Merger()

    def out() -> pa.RecordBatch:
        f, c = merger.whole().repeated()
        return pa.record_batch([pa.array(f.view(np.int64)), pa.array(c)], ["fp", "n"])

    for b in batches:
        for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k != at and at is not None:
                yield out()
            at = k
            merger.add(CountingQuotientFilter.read(v))
    if at is not None:
        yield out()


def repeated_fingerprints(fps: DataFrame, rows: int) -> DataFrame:
    """(fp, n): fingerprints that occur more than once in the one column of fps; rows: about how many there are."""
    bits = min(Q, max(4, (rows // PER_BLOCK).bit_length()))
    filters = fps.mapInArrow(_build(bits), "block int, filter binary")
    # Blocks are even (leading hash bits); equal texts were already counted once per partition.
    return filters.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, "fp long, n long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and key_col's column."""
    text = text_of(docs, text_col)
    norm = squeezed(text)
    rows = docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(norm).alias("fp"), F.unhex(F.sha2(norm, 256)).alias("sha"), F.length(text).cast("long").alias("n_chars"), F.monotonically_increasing_id().alias("row"),
        (docs[key_col] if key_col else F.lit(None)).alias("key"),
    )
    rows = cut(rows, "fingerprints")
    again = cut(repeated_fingerprints(rows.select("fp"), rows.count()), "repeated").select("fp")
    # Verification: only texts of repeated fingerprints are compared, as whole byte strings and pre-aggregated per task.
    texts = docs.select(norm.alias("norm"), F.xxhash64(norm).alias("fp"))
    same = texts.join(again, "fp", "left_semi").groupBy("norm").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1").select(F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size")
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.isnull("doc_id").alias("late"), "doc_id", "row")).alias("best")
    same = cut(same.join(rows.join(again, "fp", "left_semi").groupBy("sha").agg(best), "sha"), "verified")
    out = spread_join(rows, same, ["sha"], ["row"], count="group_size", how="left")
    alone = F.isnull("group_size")
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id"))
    out = out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("best.row"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "key")
    return out.withColumnRenamed("key", key_col) if key_col else out.drop("key")
