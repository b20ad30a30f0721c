"""Hashed counts over all documents, labelled samples of bounded size, and per-document sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash

#: Buckets of one shipped block of counters.
BLOCK = 1 << 16
#: Hashes held before they are counted.
HELD = 1 << 20
#: Map tasks whose counters are added up together, before the sums of all such groups are.
TOGETHER = 512
#: Stands for a missing doc_id in Python; a document of this id is taken for one without.
NO_ID = int(np.iinfo(np.int64).min)

Extract = Callable[[np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def sample_labels(labels: DataFrame, column: str, rows: int, seed: str = "sample") -> tuple[np.ndarray, np.ndarray]:
    """Sorted doc_ids and labels of at most `rows` labelled documents, drawn by hash; the same at every rerun.

    rows is the documented bound of what reaches the driver. Of several labels of one document the mean counts.
    """
    per = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (F.col("doc_id") != NO_ID)).groupBy("doc_id").agg(F.avg(column).alias("label"))
    got = per.orderBy(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(seed))), "doc_id").limit(rows).collect()
    got.sort(key=lambda r: r[0])
    return np.array([r[0] for r in got], np.int64), np.array([r[1] for r in got], float)


def label_at(ids: np.ndarray, known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Label of each id, NaN where it has none."""
    out = np.full(len(ids), np.nan)
    if len(known):
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        hit = known[at] == ids
        out[hit] = labels[at[hit]]
    return out


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def hashed_counts(docs: DataFrame, sizes: list[int], extract: Extract) -> list[np.ndarray]:
    """Counts of hashed items over all rows of docs (doc_id, text): one dense array for each of sizes.

    extract(ids, bytes, offsets) yields (kind, hashes). Each task counts its own rows and ships blocks of its nonzero
    counters; blocks are added up on the executors, first those of TOGETHER tasks, then these sums, so no task adds up the
    blocks of all tasks. What reaches the driver is sizes x 8 bytes, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(s, np.uint32) for s in sizes]
        held: list[list[np.ndarray]] = [[] for _ in sizes]
        n = [0] * len(sizes)
        group = TaskContext.get().partitionId() // TOGETHER

        def settle(k: int) -> None:
            if n[k]:
                totals[k] += np.bincount((np.concatenate(held[k]) & np.uint64(sizes[k] - 1)).view(np.int64), minlength=sizes[k]).astype(np.uint32)
                held[k], n[k] = [], 0

        for b in batches:
            ids = ids_of(b)
            for at, data, offsets in wordhash.chunks(b.column(1)):
                for k, h in extract(ids[at : at + len(offsets) - 1], data, offsets):
                    held[k].append(h)
                    n[k] += len(h)
                    if n[k] > HELD:
                        settle(k)
        for k, total in enumerate(totals):
            settle(k)
            for block in range(0, sizes[k], BLOCK):
                part = total[block : block + BLOCK]
                if len(at := np.flatnonzero(part)):
                    yield counters(k, block, group, at, part[at])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for b in batches:
            for k, block, group, at, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (k, block, group) != key:
                    if key is not None:
                        yield counters(*key, np.flatnonzero(total), total[total > 0])
                    key, total = (k, block, group), np.zeros(BLOCK, np.int64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(c, np.int64 if len(c) == 4 * len(at) else np.uint32)
        if key is not None:
            yield counters(*key, np.flatnonzero(total), total[total > 0])

    schema, keys = "kind int, block long, group int, at binary, n binary", ["kind", "block", "group"]
    parts = docs.mapInArrow(count, schema).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(add, schema)
    sums = parts.withColumn("group", F.lit(0)).repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(add, schema)
    found = [np.zeros(s, np.int64) for s in sizes]
    for k, block, _, at, c in sums.collect():
        found[k][block + np.frombuffer(at, np.uint16).astype(np.int64)] = np.frombuffer(c, np.int64)
    return found


def counters(kind: int, block: int, group: int, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row of a block's nonzero counters."""
    values = (pa.array([kind], pa.int32()), pa.array([block], pa.int64()), pa.array([group], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary()))
    return pa.record_batch(list(values), ["kind", "block", "group", "at", "n"])


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each two bounds."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]
