"""N-gram Jaccard join with prefix trees.

A document's set holds its distinct word n-grams. Sets are ordered globally, frequent n-grams last (by hashed counts
over the corpus), so two sets can only be similar enough if their prefixes meet in an n-gram. Candidates that meet are
put in blocks; a block's sets are stored in a prefix tree in global order and the block's probe traverses it: paths
share partial overlaps, and subtrees are pruned by the overlap that their remaining lengths still allow.

Copies fold into one set before anything is joined. Only sets of like size can be similar, so members of an n-gram meet
in size slots: a set has its size class's slot and the next one, so two sets of like size have one in common, and an n-gram
that many sets of all sizes hold by chance is no crowd. In crowded prefix n-grams members are first held against the set in
the middle of the crowd, so groups of near copies become one component at linear cost; whoever is left out there is then
held against all of its crowd, block by block. Elsewhere all pairs of different components are compared whose prefixes
leave enough overlap possible. Links are exact: sets are rebuilt from the texts.

Sets are compared by their members' 64-bit hashes (58 bits and the order's 6), equal sets by 128-bit signatures.

Defined results: null, empty or white-space texts have the empty set and link with nothing; texts with fewer than `words`
words are one n-gram; equal sets are linked; repeated rows share a component; a row without a doc_id links nothing
and has the component of the documents with its very set, null if there is none; doc_ids are taken as longs; an empty
table gives an empty result; further columns of the input are ignored, but the one that `key_col` names is handed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import bounded_broadcast, cut, drop, settled
from .components import components
from .hashed import hashed_counts

BUCKETS = 1 << 22
#: Members of a prefix n-gram in a size slot beyond which they are first held against the middle of the crowd.
CROWD = 64
#: Sets and probes of one block, at the most usual.
MEMBERS, PROBES = 256, 64


def ngrams(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hash, text number) in order of the texts; a text of 1 to k-1 words is one n-gram."""
    h, bounds, _, _ = wordhash.words(data, offsets, lower=True)
    n = np.diff(bounds)
    text = np.repeat(np.arange(len(n)), np.maximum(n - k + 1, np.minimum(n, 1)))
    first = np.concatenate(([0], np.cumsum(np.maximum(n - k + 1, np.minimum(n, 1)))))
    start = np.arange(len(text)) - first[text] + bounds[text]
    out = np.zeros(len(text), np.uint64)
    full = n[text] >= k
    if full.any():
        out[full] = wordhash.runs(h, k)[start[full]]
    for m in range(1, k):
        if (short := n[text] == m).any():
            out[short] = wordhash.runs(h, m)[start[short]]
    return out, text


def distinct(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, key) once, sorted by text and key."""
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new]


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of a set of n with any set that is similar enough."""
    return (percent * n + 99) // 100


def ranks(counts: np.ndarray) -> np.ndarray:
    """Leading bits of the global order by bucket: 0 for rare, then by powers of two of the count."""
    mean = counts.sum() / len(counts)
    # A bucket holds other n-grams too, so only counts well over the usual load tell frequent ones.
    rare = mean + 5.0 * mean**0.5 + 8.0
    return np.where(counts < rare, 0, np.floor(np.log2(np.maximum(counts, 1))) + 1).astype(np.uint8)


def keyed(order: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes in the global order: the order's leading bits, then the hash."""
    return (order[h & np.uint64(BUCKETS - 1)].astype(np.uint64) << np.uint64(58)) | (h >> np.uint64(6))


def _sketch(k: int):
    def run(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        yield 0, ngrams(data, offsets, k)[0]

    return run


def _prefixes(rank, k: int, percent: int):
    """(doc_id, n, sig, tokens, key): the set's size, a 128-bit signature, and its prefix in global order.

    Of equal sets that a task meets only the first one with a doc_id carries tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = rank.value, set()
        for b in batches:
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            for at, data, offsets in wordhash.chunks(b.column(1)):
                size = len(offsets) - 1
                h, text = ngrams(data, offsets, k)
                keys, text = distinct(keyed(order, h), text)
                ends = np.searchsorted(text, np.arange(size + 1))
                n = np.diff(ends)
                one, two = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                if len(keys):
                    full = np.flatnonzero(n)
                    one[full] = np.add.reduceat(wordhash.mix(keys), ends[:-1][full])
                    two[full] = np.add.reduceat(wordhash.mix(keys ^ np.uint64(0x5851F42D4C957F2D)), ends[:-1][full])
                length = n - needed(n, percent) + 1
                tokens, sigs = [], []
                signed = keys.view(np.int64)
                for i in range(size):
                    sig = one[i].tobytes() + two[i].tobytes()
                    sigs.append(sig)
                    if not n[i] or not known[at + i] or sig in seen:
                        tokens.append(None)
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(sig)
                    tokens.append(signed[ends[i] : ends[i] + length[i]])
                yield pa.record_batch([b.column(0)[at : at + size], pa.array(n), pa.array(sigs, pa.binary()), pa.array(tokens, pa.list_(pa.int64())), b.column(2)[at : at + size]], ["doc_id", "n", "sig", "tokens", "key"])

    return run


class PrefixTree:
    """Sorted sets by shared beginnings; edges are runs of members, so a chain of single children is one node."""

    __slots__ = ("edge", "children", "ids", "least", "most")

    def __init__(self, sets: list[tuple[np.ndarray, int]], at: int = 0):
        """sets: (sorted members, id) in lexicographic order, equal in their first `at` members."""
        first, last = sets[0][0], sets[-1][0]
        n = min(len(first), len(last))
        diff = np.flatnonzero(first[at:n] != last[at:n])
        end = at + int(diff[0]) if len(diff) else n
        self.edge = first[at:end]
        self.least, self.most = min(len(s) for s, _ in sets), max(len(s) for s, _ in sets)
        self.ids = [i for s, i in sets if len(s) == end]
        rest = [x for x in sets if len(x[0]) > end]
        self.children, i = [], 0
        while i < len(rest):
            j = i
            while j < len(rest) and rest[j][0][end] == rest[i][0][end]:
                j += 1
            self.children.append(PrefixTree(rest[i:j], end))
            i = j

    def similar(self, probe: np.ndarray, percent: int) -> list[int]:
        """Ids of the sets with 100 * overlap >= percent * union."""
        found, todo = [], [(self, 0, 0, 0)]
        while todo:
            node, depth, overlap, passed = todo.pop()
            if len(node.edge):
                at = np.searchsorted(probe, node.edge)
                overlap += int((probe[np.minimum(at, len(probe) - 1)] == node.edge).sum())
                depth += len(node.edge)
                passed = int(np.searchsorted(probe, node.edge[-1], "right"))
            # The probe's and the subtree's remaining members bound the overlap that is still to come.
            bound = overlap + min(len(probe) - passed, node.most - depth)
            if bound * (100 + percent) < percent * (len(probe) + node.least):
                continue
            if node.ids and overlap * (100 + percent) >= percent * (len(probe) + depth):
                found += node.ids
            todo += [(c, depth, overlap, passed) for c in node.children]
        return found


def tree_of(sets: list[tuple[np.ndarray, int]]) -> PrefixTree:
    return PrefixTree(sorted(sets, key=lambda x: x[0].astype(">u8").tobytes()))


def _verify(rank, k: int, percent: int):
    """Rows (block, role, id, text), sorted by block and role: probes (role 0), then members. Gives links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, block, probes, members = rank.value, None, [], []

        def settle() -> list[tuple[int, int]]:
            if not probes or not members:
                return []
            tree = tree_of(members)
            return [(i, j) for s, i in probes for j in tree.similar(s, percent) if i != j]

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for b in batches:
            links = []
            keys, roles, ids = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for at, data, offsets in wordhash.chunks(b.column(3)):
                h, text = ngrams(data, offsets, k)
                sets, text = distinct(keyed(order, h), text)
                ends = np.searchsorted(text, np.arange(len(offsets)))
                for i in range(len(offsets) - 1):
                    s, row = sets[ends[i] : ends[i + 1]], at + i
                    if keys[row] != block:
                        links += settle()
                        block, probes, members = keys[row], [], []
                    if len(s):
                        (members if roles[row] else probes).append((s.copy(), ids[row]))
            if links:
                yield out(links)
        if links := settle():
            yield out(links)

    return run


def _checked(rows: DataFrame, texts: DataFrame, rank, k: int, percent: int) -> DataFrame:
    """Links of blocks (block, role, id); texts: (id, text)."""
    rows = rows.join(texts, "id").select("block", "role", "id", "text")
    return rows.repartition("block").sortWithinPartitions("block", "role").mapInArrow(_verify(rank, k, percent), "a long, b long")


def texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of some documents: few ids are broadcast, many are shuffled with the documents."""
    ids = cut(ids.select(F.col("id").alias("doc_id")).distinct(), "ids")
    texts = rows.join(bounded_broadcast(ids, ids.count(), 16), "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text"))
    return cut(texts.select(F.col("doc_id").alias("id"), "text"), "texts")


def verified(pairs: DataFrame, texts: DataFrame, rank, k: int, percent: int) -> DataFrame:
    """Links among the distinct pairs (probe, member)."""
    # A probe's members are dealt to blocks of about MEMBERS by hash, so a crowded probe is spread over tasks.
    per = cut(pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts")), "parts")
    blocked = pairs.join(per, "probe").select("probe", F.pmod(F.xxhash64("member"), F.col("parts")).alias("part"), "member")
    block = F.concat_ws(":", "probe", "part").alias("block")
    probes = blocked.select("probe", "part").distinct().select(block, F.lit(0).alias("role"), F.col("probe").alias("id"))
    return _checked(probes.unionByName(blocked.select(block, F.lit(1).alias("role"), F.col("member").alias("id"))), texts, rank, k, percent)


def families_checked(families: DataFrame, texts: DataFrame, rank, k: int, percent: int) -> DataFrame:
    """Links in families (family, rep, own): every rep that is not the family's own against all its reps, in blocks.

    Probes and members are dealt to parts; each part of probes meets each part of members in a block of its own, so rows
    grow with parts, not with pairs.
    """
    sizes = families.groupBy("family").agg(F.count_if(~F.col("own")).alias("n_probes"), F.count(F.lit(1)).alias("n_members")).filter("n_probes > 0")
    sizes = cut(sizes.select("family", F.ceil(F.col("n_probes") / PROBES).alias("p_parts"), F.ceil(F.col("n_members") / MEMBERS).alias("m_parts")), "sizes")
    rows = families.join(sizes, "family")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    mine = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    probes = rows.filter(~F.col("own")).select("family", mine("p_parts").alias("p"), F.explode(upto("m_parts")).alias("m"), F.lit(0).alias("role"), F.col("rep").alias("id"))
    members = rows.select("family", F.explode(upto("p_parts")).alias("p"), mine("m_parts").alias("m"), F.lit(1).alias("role"), F.col("rep").alias("id"))
    both = probes.unionByName(members)
    return _checked(both.select(F.concat_ws(":", "family", "p", "m").alias("block"), "role", "id"), texts, rank, k, percent)


def size_class(n: Column, percent: int) -> Column:
    """Class of a set's size; sets that can be similar are of one class or of neighbouring ones."""
    # A little wider than the ratio of sizes asks for, so rounding never puts a class between two such sets.
    return F.floor(F.log(n) / (math.log(100.0 / percent) * (1 + 1e-6) + 1e-9))


def _components(rows: DataFrame, full: DataFrame, reps: DataFrame, rank, words: int, percent: int) -> DataFrame:
    """(node, component) of the linked sets. rows: (doc_id, text); full: sets that are not empty; reps: (sig, n, rep)."""
    tokens = full.filter("tokens is not null").select("doc_id", F.explode("tokens").alias("token"))
    shared = cut(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1").select("token"), "shared")
    met = cut(tokens.join(bounded_broadcast(shared, shared.count(), 16), "token"), "met")
    of_doc = full.filter("tokens is not null").select("doc_id", "sig", "n", F.element_at("tokens", -1).alias("last")).join(reps.select("sig", "rep"), "sig").drop("sig")
    once = cut(met.join(of_doc, "doc_id").select("token", "rep", "n", "last").distinct(), "once")
    drop(shared, met)
    size = lambda n: size_class(F.col(n), percent)
    met = once.withColumn("slot", F.explode(F.array(size("n"), size("n") + 1)))
    crowds = cut(met.groupBy("token", "slot").agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1"), "crowds")
    met = cut(met.join(crowds, ["token", "slot"]), "met")
    drop(once, crowds)
    # How much of a prefix is crowded tells how close a set is to the middle of its crowd, and bounds what pairs share there.
    held = cut(met.groupBy("rep", "slot").agg(F.count_if(F.col("crowd") > CROWD).alias("crowded"), F.count(F.lit(1)).alias("shared")), "held")
    met = met.join(held, ["rep", "slot"])
    few = met.filter(F.col("crowd") <= CROWD)
    close = lambda x, y: (x * 100 >= y * percent) & (y * 100 >= x * percent)
    least = lambda x, y: F.ceil((x + y) * percent / (100.0 + percent) - 1e-9)
    tail = lambda n: F.ceil(n * percent / 100.0 - 1e-9) - 1
    # First, members of an n-gram against the set in the middle of them, which makes near copies one component at linear
    # cost. Nothing is settled by what is not linked here, so pairs that share little can wait.
    middle = met.groupBy("token", "slot").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), (-F.col("rep")).alias("neg"), F.col("n").alias("n"))).alias("m")).select("token", "slot", (-F.col("m.neg")).alias("pivot"), F.col("m.n").alias("pivot_n"))
    middle = cut(middle, "middle")
    around = met.join(middle, ["token", "slot"]).select("slot", "rep", "n", "crowd", "pivot", "pivot_n")
    crowd = around.filter(F.col("crowd") > CROWD)
    # Sets of one class meet in two slots.
    top = lambda x, y: F.greatest(size(x), size(y))
    common = F.greatest(F.count_if(F.col("slot") == top("n", "pivot_n")), F.count_if(F.col("slot") > top("n", "pivot_n")))
    stars = around.filter(close(F.col("n"), F.col("pivot_n")) & (F.col("rep") != F.col("pivot"))).groupBy("pivot", "rep", "n", "pivot_n").agg(common.alias("common"), F.max("crowd").alias("crowd"))
    likely = 2 * F.col("common") >= least(F.col("n"), F.col("pivot_n")) - tail(F.least("n", "pivot_n"))
    stars = stars.filter(likely | (F.col("crowd") > CROWD)).select(F.col("pivot").alias("probe"), F.col("rep").alias("member"))
    stars = cut(stars, "stars")
    links = cut(verified(stars, texts_of(rows, stars.select(F.explode(F.array("probe", "member")).alias("id"))), rank, words, percent), "links")
    first = components(links)
    named = first.select("node", "component")
    family = crowd.select("pivot", "rep").distinct().join(named.select(F.col("node").alias("rep"), F.col("component").alias("of_rep")), "rep", "left").join(named.select(F.col("node").alias("pivot"), F.col("component").alias("of_pivot")), "pivot", "left")
    family = family.select(F.coalesce("of_pivot", "pivot").alias("family"), "rep", (F.coalesce("of_rep", "rep") == F.coalesce("of_pivot", "pivot")).alias("own")).distinct()
    family = cut(family, "families")
    # The rest: pairs of different components that meet outside crowds. What a pair shares is at most what it shares among
    # the first members up to the lesser last token of both prefixes, and all that follows in the set that ends there.
    rest = cut(few.select("token", "slot", "rep", "n", "last", "crowded").join(named.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "rest")
    a, b = (rest.select("token", "slot", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "last", "crowded", "component")]) for s in "ab")
    cross = a.join(b, ["token", "slot"]).filter((F.col("slot") == top("n_a", "n_b")) & (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b")) & close(F.col("n_a"), F.col("n_b")))
    room = F.least("crowded_a", "crowded_b") + tail(F.when(F.col("last_a") <= F.col("last_b"), F.col("n_a")).otherwise(F.col("n_b"))) - least(F.col("n_a"), F.col("n_b"))
    cross = cross.groupBy(F.col("rep_b").alias("probe"), F.col("rep_a").alias("member"), room.alias("room")).agg(F.count(F.lit(1)).alias("common")).filter("common + room >= 0").select("probe", "member")
    cross = cut(cross, "cross")
    mixed = family.groupBy("family").agg(F.count_if(~F.col("own")).alias("n")).filter("n > 0").select("family")
    family = cut(family.join(cut(mixed, "mixed"), "family"), "families")
    texts = texts_of(rows, cross.select(F.explode(F.array("probe", "member")).alias("id")).union(family.select("rep")))
    more = cut(verified(cross, texts, rank, words, percent).unionByName(families_checked(family, texts, rank, words, percent)), "links")
    return components(links.unionByName(more))


def similarity_groups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), and key_col's column."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), (docs[key_col] if key_col else F.lit(None)).cast("long").alias("key"))
    order = spark.sparkContext.broadcast(ranks(hashed_counts(rows, [BUCKETS], _sketch(words))[0]))
    sets = cut(rows.mapInArrow(_prefixes(order, words, percent), "doc_id long, n long, sig binary, tokens array<long>, key long"), "sets")
    full = sets.filter("n > 0 and doc_id is not null")
    # Copies: equal sets go by the smallest doc_id from here on. Tokens are carried once per set and task.
    reps = cut(full.groupBy("sig", "n").agg(F.min("doc_id").alias("rep")), "reps")
    groups = settled(lambda: _components(rows.select("doc_id", "text"), full, reps, order, words, percent), "groups")
    of_set = reps.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").select("sig", F.coalesce("component", "rep").alias("component"))
    of_set = cut(of_set, "classes")
    out = sets.select("doc_id", "n", "sig", "key").join(of_set, "sig", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "key")
    return out.withColumnRenamed("key", key_col) if key_col else out.drop("key")
