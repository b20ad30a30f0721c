"""Toxicity as ordinal regression with cumulative links.

Severity grades 0..K-1 come with labelled documents. One weight vector over sparse text features (presence of hashed
lower-case words) is shared by all K-1 ordered thresholds: P(grade >= k) = logistic(w.x - theta_k). A document's result is
its expected severity, the sum of these probabilities.

The model is fitted on a sample bounded by `sample` rows (by hash of the id); features are the words that tell the
grades of the sample apart. Besides words, the first PREFIX bytes of longer words are features, so inflected and
compounded forms of a stem share its weight. Scoring covers every word of every document; the broadcast weights have a
fixed size.

Where labels only say toxic or not, `degrees` above 1 parts the toxic documents of the sample into so many grades of equal
size, by how many features of a lexicon of toxic words they hold. The sample is split in two for that: a half's
lexicon is learned on the other half, so no document's grade comes from words that its own label made telling.

Defined results: null or empty text has no features and gets the severity of an empty text; documents flag at
P(grade >= 1) >= `flag_at`; with no labels, or one grade only, nothing is flagged and severity is 0; repeated rows score
alike; rows without a doc_id are scored but never labelled; doc_ids are taken as longs; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .hashed import hashed_counts, ids_of, sample_labels

BUCKETS = 1 << 20
#: Lengths in bytes of word beginnings that are features of their own.
PREFIX = (4, 5, 6, 7, 8)
#: Anything but ASCII letters, digits and bytes of longer characters parts words.
_PART = np.ones(256, bool)
_PART[48:58] = _PART[65:91] = _PART[97:123] = _PART[128:] = False


def presence(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature), each pair once, sorted; wanted: only features with True here."""
    h, bounds, starts, ends = wordhash.words(data, offsets, lower=True, space=_PART)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    kinds = [(np.arange(len(h)), h), *(wordhash.prefixes(data, starts, ends, k) for k in PREFIX if len(h))]
    found = []
    for at, hashes in kinds:
        f = (hashes & np.uint64(BUCKETS - 1)).view(np.int64)
        if wanted is not None:
            hit = wanted[f]
            at, f = at[hit], f[hit]
        found.append(text[at] * BUCKETS + f)
    both = np.unique(np.concatenate(found))
    return both // BUCKETS, both % BUCKETS


class OrdinalModel:
    """Cumulative-link logistic model: weights by feature, ascending thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """Probabilities (n, K-1) of grade >= 1, >= 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))

    @classmethod
    def fit(cls, rows: np.ndarray, features: np.ndarray, grades: np.ndarray, l2: float = 0.05, steps: int = 400) -> OrdinalModel:
        """rows, features: the ones of a sparse 0/1 matrix. Maximum likelihood by Adam, thresholds kept apart by exponents."""
        n, k = len(grades), int(grades.max())
        used, col = np.unique(features, return_inverse=True)
        w, share = np.zeros(len(used)), np.clip(np.array([(grades >= j).mean() for j in range(1, k + 1)]), 1e-4, 1 - 1e-4)
        theta = -np.log(share / (1 - share))
        free = np.concatenate((theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))))
        state, m1, m2 = np.concatenate((w, free)), 0.0, 0.0
        for t in range(1, steps + 1):
            w, free = state[: len(used)], state[len(used) :]
            gaps = np.exp(free[1:])
            theta = free[0] + np.concatenate(([0.0], np.cumsum(gaps)))
            s = np.bincount(rows, w[col], n)
            c = 1 / (1 + np.exp(np.clip(theta[None, :] - s[:, None], -40, 40)))
            full = np.concatenate((np.ones((n, 1)), c, np.zeros((n, 1))), 1)
            p = np.maximum(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-12)
            slope = c * (1 - c)
            # d log p / d(s - theta_j): plus for the threshold just below the grade, minus for the one just above.
            below, over = grades[:, None] == np.arange(1, k + 1)[None, :], grades[:, None] == np.arange(k)[None, :]
            d = (below * slope - over * slope) / p[:, None]
            d_theta = -d.sum(0)
            g_w = np.bincount(col, d.sum(1)[rows], len(used)) - l2 * w
            g_free = np.concatenate((d_theta.sum(keepdims=True), [d_theta[j:].sum() * gaps[j - 1] for j in range(1, k)]))
            g = np.concatenate((g_w, g_free)) / n
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.95 * m2 + 0.05 * g * g
            state = state + 0.1 * (1 - t / (steps + 1)) * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.95**t)) + 1e-9)
        out = np.zeros(BUCKETS, np.float32)
        out[used] = state[: len(used)]
        free = state[len(used) :]
        return cls(out, free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:])))))


def telling(df: np.ndarray, hit: np.ndarray, n: int, pos: int, least: int, most: int, score: float = 30.0) -> np.ndarray:
    """Features whose presence depends on grade > 0: chi-square above `score`, in at least `least` documents.

    df, hit: documents, and documents of grade > 0, that have each feature; n, pos: all of either.
    """
    expect = df * (pos / n)
    var = np.maximum(expect * (1 - pos / n) * (1 - df / n), 1e-9)
    chi = np.where((df >= least) & (df < n), (hit - expect) ** 2 / var, 0)
    found = np.flatnonzero(chi > score)
    return found[np.argsort(-chi[found])][:most]


def half(ids: np.ndarray) -> np.ndarray:
    """0 or 1 for each id, by hash."""
    return (wordhash.mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(2)).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, grade: str, sample: int = 20_000, features: int = 4096, degrees: int = 1) -> OrdinalModel | None:
    """docs: (doc_id, text). None if the sample has one grade only."""
    ids, marks = sample_labels(labels, grade, sample)
    grades_of = np.round(marks).astype(np.int64)
    if not len(ids) or grades_of.max() <= 0 or grades_of.min() > 0:
        return None
    spark = docs.sparkSession
    # At most `sample` ids: a broadcast of bounded size. Repeated ids count once.
    wanted_ids = spark.createDataFrame([(int(i),) for i in ids], "doc_id long")
    mine = docs.join(F.broadcast(wanted_ids), "doc_id", "left_semi")
    severe_ids = ids[grades_of > 0]

    def both(ids_: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        t, f = presence(data, offsets)
        severe, part = np.isin(ids_, severe_ids), half(ids_)
        for h in (0, 1):
            yield 2 * h, f[part[t] == h].view(np.uint64)
            yield 2 * h + 1, f[severe[t] & (part[t] == h)].view(np.uint64)
        yield 4, (2 * part + severe).view(np.uint64)

    *counts, sizes = hashed_counts(mine, [BUCKETS] * 4 + [4], both)
    n, pos = int(sizes.sum()), int(sizes[1] + sizes[3])
    if not 0 < pos < n:
        return None
    chosen = telling(counts[0] + counts[2], counts[1] + counts[3], n, pos, max(5, n // 2000), features)
    keep = np.zeros(BUCKETS, bool)
    keep[chosen] = True
    lexicon = np.zeros((2, BUCKETS), bool)
    for h in (0, 1):
        df, hit, n_h, pos_h = counts[2 * h], counts[2 * h + 1], int(sizes[2 * h] + sizes[2 * h + 1]), int(sizes[2 * h + 1])
        if 0 < pos_h < n_h:
            found = telling(df, hit, n_h, pos_h, max(5, n_h // 2000), features)
            # It judges the documents of the other half.
            lexicon[1 - h, found[hit[found] * n_h > df[found] * pos_h]] = True

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_ids = ids_of(b)
            for at, data, offsets in wordhash.chunks(b.column(1)):
                k = len(offsets) - 1
                t, f = presence(data, offsets)
                held = np.bincount(t, lexicon[half(all_ids[at : at + k])[t], f], k)
                t, f = t[keep[f]], f[keep[f]]
                ends = np.searchsorted(t, np.arange(k + 1))
                yield pa.record_batch([b.column(0)[at : at + k], pa.array([f[x:y].astype(np.int32).tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary()), pa.array(held)], ["doc_id", "features", "held"])

    got = mine.mapInArrow(pick, "doc_id long, features binary, held double").groupBy("doc_id").agg(F.max(F.struct("features", "held")).alias("x")).select("doc_id", "x.*").collect()
    grades = grades_of[np.searchsorted(ids, np.array([r[0] for r in got], np.int64))]
    parts = [np.frombuffer(r[1], np.int32) for r in got]
    rows, cols = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts).astype(np.int64)
    if degrees > 1 and grades.max() == 1:
        held, toxic = np.array([r[2] for r in got]), grades > 0
        edges = np.quantile(held[toxic], np.arange(1, degrees) / degrees)
        grades = grades + toxic * (held[:, None] > edges[None, :]).sum(1)
    return OrdinalModel.fit(rows, cols, grades)


def severity(docs: DataFrame, labels: DataFrame, grade: str = "grade", sample: int = 20_000, flag_at: float = 0.5, degrees: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, expected_severity, p_toxic (grade >= 1), grade (most likely), toxic."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    model = fit(rows, labels, grade, sample, degrees=degrees)
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("expected_severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        wanted = m.weights != 0
        for b in batches:
            for at, data, offsets in wordhash.chunks(b.column(1)):
                n = len(offsets) - 1
                t, f = presence(data, offsets, wanted)
                p = m.at_least(np.bincount(t, m.weights[f], n))
                full = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), 1)
                best = np.argmax(full[:, :-1] - full[:, 1:], 1).astype(np.int32)
                yield pa.record_batch([b.column(0)[at : at + n], pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(best), pa.array(p[:, 0] >= flag_at)], ["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])

    return rows.mapInArrow(score, "doc_id long, expected_severity double, p_toxic double, grade int, toxic boolean")
