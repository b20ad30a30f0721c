"""The training-data operators against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import common, components, decontaminate, exact_dedup, html_extract, jaccard_join, lm_scoring, mixing, quality, substring_dedup, token_counts, toxicity, wordhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, hash long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghiklmnoprstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def corpus(n=120, seed=1):
    """Texts with copies, near copies, a common passage, odd white space, empty, null and long ones, and repeated rows."""
    rng, words = random.Random(seed), vocabulary(400, seed)
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts = []
    for i in range(n):
        kind = i % 10
        if kind < 4 or not texts:
            t = " ".join(rng.choice(words) for _ in range(rng.randint(1, 260)))
        elif kind == 4:
            t = (rng.choice(texts) or "x").replace(" ", "\n\t ")
        elif kind < 7:
            w = (rng.choice(texts) or "x").split()
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(words).upper()
            t = " ".join(w)
        elif kind == 7:
            t = " ".join(rng.choice(words) for _ in range(30)) + "\n" + passage + " " + rng.choice(words)
        elif kind == 8:
            t = rng.choice(["", " \n", None, "one", "Ünïcode ß   wörd", "a b c"])
        else:
            t = "same words all over again " * rng.randint(1, 40)
        texts.append(t)
    texts[5] = " ".join(rng.choice(words) for _ in range(30_000))
    return [(i, t, "en", f"src{i % 5}" if i % 11 else None, len(t or ""), "x", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 6 > 0), int(i % 5 == 0)) for i in range(0, 100, 2)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\nß.é", max_size=30), max_size=8))
def test_word_hashes(texts):
    found = []
    for _, data, offsets in wordhash.chunks(pa.array([*texts, None], pa.string())):
        h, bounds, starts, ends = wordhash.words(data, offsets, lower=True)
        found += [[bytes(data[s:e]) for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        by = defaultdict(set)
        for s, e, x in zip(starts, ends, h, strict=True):
            by[bytes(data[s:e]).lower()].add(int(x))
        assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert found == [[w.encode() for w in WORDS.findall(t)] for t in [*texts, ""]]


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_word_hashes_by_pieces(monkeypatch, piece):
    """Long texts are hashed piece by piece with the same words and hashes, long words included."""
    rng = random.Random(2)
    texts = [" ".join("x" * rng.choice((1, 3, 200)) + rng.choice("AbC,9") for _ in range(40)) for _ in range(5)] + ["", "  ", "y" * 500, " z"]
    _, data, offsets = next(wordhash.chunks(pa.array(texts)))
    whole = [wordhash.words(data, offsets, lower=low, also=also) for low, also in ((True, None), (False, quality._SAME))]
    heads = wordhash.prefixes(data, *whole[0][2:], 5)
    monkeypatch.setattr(wordhash, "PIECE", piece)
    for got, want in zip([wordhash.words(data, offsets, lower=low, also=also) for low, also in ((True, None), (False, quality._SAME))], whole, strict=True):
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, want, strict=True))
    assert len(heads[0]) and len({int(h) for h in heads[1]}) == len({bytes(data[a : a + 5]).lower() for a in whole[0][2][heads[0]]})


def test_token_counts(spark, docs, rows, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name, spaces in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path, cache = public_tokenizers.path(name), f"file://{tmp_path}/{name}"
        extra = [(900, "<|endoftext|>a <|EndOfText|> it's  we'LL x ý 12345 \x1c z", "", "", 0, "", 0)]
        all_docs = docs.unionByName(spark.createDataFrame(extra, SCHEMA)).unionByName(docs.limit(7))
        got = token_counts.token_counts(all_docs, path, cache, spaces=spaces, pieces=spaces)
        library = Tokenizer.from_file(path)
        want = {r[0]: (len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows + extra}
        found = got.collect()
        assert len(found) == len(rows) + 8 and {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == want
        again = token_counts.token_counts(all_docs, path, cache, spaces=spaces, pieces=spaces)
        assert again.count() == len(found)
        n = spark.read.parquet(cache).count()
        assert n == spark.read.parquet(cache).select("digest").distinct().count() <= len({r[1] or "" for r in rows}) + 1
        assert token_counts.token_counts(empty, path, cache, spaces=spaces).count() == 0


def test_token_cache_outlives_the_run(spark, monkeypatch):
    """A second run of the query reads the counts of the first and encodes nothing."""
    from tagloom.llm import queries

    first = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, "/root/testdata/sf0.001").collect()}
    cache = f"{common.shared_dir(spark)}/tagloom-token-cache"
    n = spark.read.parquet(cache).count()
    monkeypatch.setattr(token_counts, "encoder", lambda path, pieces: lambda batches: (1 / 0 for b in batches if b.num_rows))
    assert {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, "/root/testdata/sf0.001").collect()} == first
    assert spark.read.parquet(cache).count() == n


def test_sentencepiece_counts(docs, rows, tmp_path):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(docs, path, f"file://{tmp_path}/c", spaces=False, pieces=False)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {r[0]: len(model.encode(r[1] or "")) for r in rows}


def test_mixing(spark, rows, docs, empty):
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in rows}
    assert {i: r["size"] for i, r in got.items()} == size
    per, taken, target = Counter(), Counter(), {}
    for r in rows:
        per[r[3]] += size[r[0]]
        taken[r[3]] += got[r[0]].taken
        target[r[3]] = got[r[0]].target
    assert all(got[r[0]].source_size == per[r[3]] for r in rows)
    assert abs(sum(target.values()) - sum(per.values())) < 1e-6 * sum(per.values())
    weights = dict(zip(sorted((s for s in per if s), key=lambda s: s) + [None], [5, 2, 1] * 9, strict=False))
    under = {target[s] / weights[s] for s in per if target[s] < 3 * per[s] - 1e-6}
    assert len({round(x, 6) for x in under}) == 1 and all(target[s] <= 3 * per[s] + 1e-6 for s in per)
    largest = {s: max(size[r[0]] for r in rows if r[3] == s) for s in per}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in per)
    assert all(r.taken <= 3 * r["size"] and r.taken in (r["size"] * r.epochs, r["size"] * (r.epochs + 1)) for r in got.values())
    assert {r.doc_id: r.taken for r in mixing.mix(docs.repartition(3)).collect()} == {i: r.taken for i, r in got.items()}
    assert mixing.mix(empty).count() == 0
    assert [r.target for r in mixing.mix(spark.createDataFrame([(1, None, "", None, 0, "", 0)], SCHEMA)).collect()] == [0.0]


def test_mixing_buckets_agree(docs, monkeypatch):
    whole = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "PER_BUCKET", 3)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == whole


def test_ordinal_model():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6)) < 0.3
    score = x @ np.array([3.0, 2.0, 1.0, 0, 0, -1.0]) + rng.logistic(size=3000)
    grades = (score > 1).astype(int) + (score > 3) + (score > 4.5)
    at, col = np.nonzero(x[:2000])
    m = toxicity.OrdinalModel.fit(at, col, grades[:2000])
    assert np.all(np.diff(m.thresholds) > 0) and m.weights[0] > m.weights[1] > m.weights[2] > abs(m.weights[3])
    p = m.at_least(x[2000:] @ m.weights[:6])
    assert np.all(np.diff(p, axis=1) <= 0)
    assert np.corrcoef(p.sum(1), grades[2000:])[0, 1] > 0.6


def test_toxicity_held_out(spark, empty, labels):
    sf = "/root/testdata/sf0.1"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fit_on, judge = lab.filter("doc_id % 4 != 0"), lab.filter("doc_id % 4 = 0")
    got = toxicity.severity(d, fit_on, "toxic", degrees=3).join(judge.withColumnRenamed("toxic", "true"), "doc_id").select("toxic", "true", "expected_severity").collect()
    hit, flagged, real = sum(r.toxic and r["true"] for r in got), sum(r.toxic for r in got), sum(r["true"] for r in got)
    assert hit / flagged > 0.9 and hit / real > 0.75  # a few labels in a hundred are wrong
    assert toxicity.severity(empty, labels, "toxic").count() == 0


def test_toxicity_edges(docs, rows, labels):
    got = toxicity.severity(docs, labels, "toxic").collect()
    assert len(got) == len(rows) and all(0 <= r.p_toxic <= 1 for r in got)
    none = toxicity.severity(docs, labels.filter("toxic = 0"), "toxic").collect()
    assert len(none) == len(rows) and not any(r.toxic for r in none)


def toxic_corpus(spark, n=600):
    """Toxic documents hold one to nine of twenty bad words, with the number as a grade that the labels do not tell."""
    rng, words, bad = random.Random(3), vocabulary(300, 3), [f"bad{w}" for w in vocabulary(20, 4)]
    texts, amount = {}, {}
    for i in range(n):
        amount[i] = rng.choice((1, 4, 9)) if i % 3 == 0 else 0
        w = [rng.choice(words) for _ in range(60)] + rng.sample(bad, amount[i])
        rng.shuffle(w)
        texts[i] = " ".join(w)
    rows = [(i, t, "", "", 0, "", 0) for i, t in texts.items()] + [(None, texts[0], "", "", 0, "", 0)]
    lab = spark.createDataFrame([(i, int(amount[i] > 0)) for i in range(n)], "doc_id long, toxic int")
    return spark.createDataFrame(rows, SCHEMA).repartition(3), lab, texts, amount


def test_toxicity_grades(spark):
    """Scores are the model's, computed here for each text by itself, and severity follows how toxic a text is."""
    d, lab, texts, amount = toxic_corpus(spark)
    got = toxicity.severity(d, lab, "toxic", degrees=3).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(texts) + 1 and by[None].expected_severity == by[0].expected_severity
    model = toxicity.fit(d.select("doc_id", "text"), lab, "toxic", degrees=3)
    assert len(model.thresholds) == 3 and np.all(np.diff(model.thresholds) > 0)
    for i, t in texts.items():
        raw = t.encode()
        _, f = toxicity.presence(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        p = 1 / (1 + np.exp(model.thresholds - sum(float(model.weights[x]) for x in sorted(set(f.tolist())))))
        assert by[i].expected_severity == pytest.approx(p.sum(), abs=1e-4)
    mean = {n: np.mean([by[i].expected_severity for i in texts if amount[i] == n]) for n in (0, 1, 4, 9)}
    assert mean[0] < mean[1] < mean[4] < mean[9]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=20), min_size=1, max_size=9), st.integers(4, 24))
def test_quotient_filters_merge(parts, bits):
    small = [[x % 50 * 2**58 // 7 for x in p] for p in parts]
    merger = exact_dedup.Merger()
    for p in small:
        merger.add(exact_dedup.CountingQuotientFilter.of(np.array(p, np.uint64)))
    whole = merger.whole()
    want = Counter(x for p in small for x in p)
    assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist(), strict=True)) == dict(want)
    again = [exact_dedup.CountingQuotientFilter.read(b) for _, b in whole.blocks(bits)]
    assert sum((x.fingerprints().tolist() for x in again), []) == sorted(want) and [n for x in again for n in x.counts.tolist()] == [want[f] for f in sorted(want)]


def test_exact_dedup(rows, docs, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    by = defaultdict(list)
    for r in rows:
        by[norm(r[1])].append(r)
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        group = by[norm(rows[r.doc_id][1])]
        keep = min(group, key=lambda x: (-len(x[1] or ""), x[0]))[0]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(group), keep == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(norm(rows[r.doc_id][1]).encode()).hexdigest()
    assert exact_dedup.exact_groups(empty).count() == 0
    twice = exact_dedup.exact_groups(docs.filter("doc_id = 5").unionByName(docs.filter("doc_id = 5"))).collect()
    assert [r.group_size for r in twice] == [2, 2] and sorted(r.kept for r in twice) == [False, True]


def test_exact_dedup_ids(spark):
    """Exactly one row of each group stays, whatever ids are missing or repeated; the key goes along."""
    texts = [(None, "a b"), (3, "ab"), (3, "ab"), (None, "ab "), (7, "a  b"), (7, "a  b"), (None, "c"), (None, "c"), (8, "d"), (None, None), (9, "")]
    d = spark.createDataFrame([(i, t, "", "", 0, str(k), k) for k, (i, t) in enumerate(texts)], SCHEMA).repartition(4)
    got = sorted(exact_dedup.exact_groups(d, key_col="hash").collect(), key=lambda r: r.hash)
    assert [r.hash for r in got] == list(range(len(texts)))
    assert [r.keep_id for r in got] == [7] * 6 + [None, None, 8, 9, 9] and [r.group_size for r in got] == [6] * 6 + [2, 2, 1, 2, 2]
    kept = [r.hash for r in got if r.kept]
    assert len(kept) == 4 and kept[0] in (4, 5) and kept[1] in (6, 7) and kept[2:] == [8, 10]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(d, lab.filter("doc_id % 4 != 0")).join(lab.filter("doc_id % 4 = 0"), "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality], [r.kept for r in got if not r.quality]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.06


def test_quality_weights_and_draw(spark):
    """Brute force of both models, of all weights and of the draw; a small length lets the noise decide."""
    rng, words = random.Random(6), vocabulary(80, 6)
    texts = {i: " ".join(rng.choice(words[:50] if i % 2 else words[30:]) for _ in range(rng.randint(0, 60))) + " " + str(i) for i in range(400)}
    d = spark.createDataFrame([(i, t, "", "", 0, "", i) for i, t in texts.items()], SCHEMA).repartition(3)
    lab = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")

    def grams(t):
        raw = t.encode()
        h, _, pairs, _ = quality.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return [Counter((x % quality.BUCKETS for x in v.tolist())) for v in (h, pairs)]

    each = {i: grams(t) for i, t in texts.items()}
    ids = np.arange(300)
    seen = (ids.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(2) == 0
    good = [i for i in ids[seen].tolist() if i % 2]
    raw, target = ([sum((each[i][k] for i in which), Counter()) for k in (0, 1)] for which in (each, good))

    def log_ratio(k, x):
        p = (raw[k][x] + 1) / (sum(raw[k].values()) + quality.BUCKETS)
        return np.log((target[k][x] + 3 * quality.BUCKETS * p) / (sum(target[k].values()) + 3 * quality.BUCKETS)) - np.log(p)

    weight = {i: sum(n * log_ratio(k, x) for k in (0, 1) for x, n in c[k].items()) / (sum(sum(v.values()) for v in c) + quality.SHORT) for i, c in each.items()}
    for length in (500.0, 2.0):
        got = {r.doc_id: r for r in quality.classify(d, lab, length=length, key_col="hash").collect()}
        assert all(r.weight == pytest.approx(weight[i], abs=1e-5) and r.hash == i for i, r in got.items())
        noise = {i: r.key - length * r.weight for i, r in got.items()}
        assert len(set(noise.values())) > 300 and abs(np.mean(list(noise.values())) - 0.5772) < 0.3
        kept, n = {i for i, r in got.items() if r.kept}, sum(r.kept for r in got.values())
        assert kept == set(sorted(got, key=lambda i: -got[i].key)[:n])
        plain = set(sorted(got, key=lambda i: -got[i].weight)[:n])
        assert (len(kept & plain) < 0.9 * n) == (length == 2.0)


def test_quality_edges(docs, rows, empty, labels):
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and not any(r.kept for r in got if not (rows[r.doc_id][1] or "").strip())
    assert all(r.kept == (r.n_grams > 0) for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(empty, labels).count() == 0


def test_kth_largest(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [5.0] * 4
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 4, 100, 2999):
        least = quality.kth_largest(df, k)
        assert sum(v >= least for v in values) == max(k, 4)
    assert quality.kth_largest(df.limit(0), 3) == float("inf")


def test_substring_dedup(rows, docs, empty):
    for window in (50, 8):
        words = {r[0]: WORDS.findall(r[1] or "") for r in rows}
        first = {}
        for i in sorted(words):
            for j in range(len(words[i]) - window + 1):
                first.setdefault(tuple(words[i][j : j + window]), i)
        got = {r.doc_id: r for r in substring_dedup.removed(docs, window).collect()}
        assert len(got) == len(rows)
        for i, w in words.items():
            out = set()
            for j in range(len(w) - window + 1):
                if first[tuple(w[j : j + window])] < i:
                    out |= set(range(j, j + window))
            kept = " ".join(x for j, x in enumerate(w) if j not in out)
            assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(out), hashlib.sha256(kept.encode()).hexdigest())
    assert substring_dedup.removed(empty).count() == 0
    assert substring_dedup.removed(docs.withColumn("doc_id", F.lit(None).cast("long"))).filter("n_removed > 0").count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 40), st.lists(st.tuples(st.integers(0, 39), st.integers(1, 25)), max_size=8))
def test_greedy_factors(n, found):
    """Factors cover what the matches cover, follow one another, and each reaches as far as any match there."""
    spans = [(a, min(n, a + k)) for a, k in found if a < n]
    got = substring_dedup.factored(n, np.array([a for a, _ in spans], np.int64), np.array([b for _, b in spans], np.int64))
    assert {i for a, b in got for i in range(a, b)} == {i for a, b in spans for i in range(a, b)}
    assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
    assert all(b == max(y for x, y in spans if x <= a < y) for a, b in got)


def test_spread_join(spark):
    """A third of all rows under one key are dealt over tasks, and nothing is lost or doubled."""
    rows = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 700).alias("k"))
    per = common.cut(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    for how in ("inner", "left"):
        got = common.spread_join(rows, per.filter("k < 500"), ["k"], ["id"], how=how)
        want = rows.join(per.filter("k < 500"), "k", how)
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect(), key=lambda r: tuple(r)) if how == "inner" else got.count() == 6000


def test_substring_dedup_repeats_inside_a_document(spark):
    """Lines and passages that one document repeats and smaller ones hold with other neighbours."""
    rng, words = random.Random(11), vocabulary(300, 3)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    texts = {}
    for i in range(0, 90, 3):
        line = some(rng.randint(9, 30))
        texts[i] = some(6) + line[rng.randint(0, 4) :] + some(9)
        texts[i + 1] = some(5) + line[: rng.randint(8, 12)] + some(5)
        around = some(12)
        texts[i + 2] = some(7) + (around + line + around) * 2 + some(7) + line * 3 + some(3) + line + some(9) + around + line + around
    d = spark.createDataFrame([(i, " ".join(w), "", "", 0, "", 0) for i, w in texts.items()], SCHEMA)
    for window in (8, 12):
        first = {}
        for i in sorted(texts):
            for j in range(len(texts[i]) - window + 1):
                first.setdefault(tuple(texts[i][j : j + window]), i)
        for r in substring_dedup.removed(d, window).collect():
            w = texts[r.doc_id]
            out = {j + k for j in range(len(w) - window + 1) if first[tuple(w[j : j + window])] < r.doc_id for k in range(window)}
            kept = " ".join(x for j, x in enumerate(w) if j not in out)
            assert (r.n_removed, r.kept_sha256) == (len(out), hashlib.sha256(kept.encode()).hexdigest())


def test_decontamination(spark, docs, empty):
    items = ["If Alice has 5 apples and gives 2 of them to Bob then how many apples are left for Alice to eat", "short plain item words", "", None, "what is the total weight in pounds of these 3.5 kg of flour on the table", "9 8 7 6 5 4 3 2 1"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    texts = {
        1: "Before. If Carol has 9 apples and gives 4 of them to Dan then how many apples are left for Carol to eat. After",
        2: "Before. If Carol has 9 apples and gives 4 of them to Dan then how many apples are left for Eve to eat. After",
        3: "it says: short plain item words",
        4: "x what is the total weight in pounds of these 12 lb of flour on the table",
        5: "nothing of this kind",
        6: None,
        7: items[0],
        8: "If Alice has 5 apples she is glad of it",
        9: "9 8 7 6 5 4 3 2 1",
    }
    d = spark.createDataFrame([(i, t, "", "", 0, "", 0) for i, t in texts.items()], SCHEMA)
    got = {(r.doc_id, r.item_id): r.exact for r in decontaminate.contaminated(d.unionByName(d), bench).collect()}
    assert got == {(1, 0): False, (3, 1): True, (4, 4): False, (7, 0): True}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_ids_and_slots(spark):
    """Documents without an id, repeated ids, items of all lengths, and slots that disagree in part."""
    items = {1: "Anna sold 3 red and 5 blue balls to her brother Tom on a sunny day in May", 2: "how many stars are there", 3: "long way to go", 4: " ".join(f"word{chr(97 + i)}" for i in range(12))}
    bench = spark.createDataFrame([*items.items(), (None, items[4])], "item_id long, text string")
    rows = [(None, f"x {items[4]} y"), (None, f"x {items[4]} y"), (5, items[2]), (5, items[3]), (5, "nothing"), (None, "nothing"), (6, "we saw Anna sold 4 red and 4 blue balls to her brother Jim on a sunny day in May"), (7, items[1] + " then " + items[2])]
    d = spark.createDataFrame([(i, t, "", "", 0, "", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    got = [(r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(d, bench).collect()]
    assert sorted(got, key=str) == sorted([(None, 4, True), (5, 2, True), (5, 3, True), (6, 1, False), (7, 1, True), (7, 2, True)], key=str)
    spark.conf.set("spark.tagloom.broadcastLimit", "0")
    try:
        assert sorted(((r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(d, bench).collect()), key=str) == sorted(got, key=str)
    finally:
        spark.conf.unset("spark.tagloom.broadcastLimit")
    long = " ".join(f"Word{i % 977} w{i % 1009} {i}" for i in range(40_000)) + " " + items[4]
    assert [r.item_id for r in decontaminate.contaminated(spark.createDataFrame([(1, long, "", "", 0, "", 0)], SCHEMA), bench).collect()] == [4]
    keyed = {r.hash for r in decontaminate.contaminated(d, bench, key_col="hash").collect()}
    assert keyed == {0, 1, 2, 3, 6, 7}


def test_decontamination_of_literal_poor_items(spark):
    """Windows that are mostly numbers or names match as they are, and only so."""
    items = ["Compute 12 + 7 * 3 - 4 = 29 and 8 / 2 + 1 = 5", "these: Anna Berta Carla Dora Emma Frida Greta Hanna Ida", "meet Tom Baker", "12 3"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"We read: {t} and went on" for t in items[:3]] + ["We read: Compute 11 + 7 * 3 - 5 = 27 and 9 / 3 + 1 = 4", "We read: these: Anja Berit Clara Doris Elsa Fanny Gerda Heidi Ines", "we meet Ann Baker 12 3"]
    d = spark.createDataFrame([(i, t, "", "", 0, "", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.doc_id, r.item_id): (r.exact, r.coverage) for r in decontaminate.contaminated(d, bench).collect()}
    assert got == {(i, i): (True, 1.0) for i in range(3)}


def test_decontamination_finds_every_planted_item(spark):
    """Brute force: word windows of items, without their slots, in sf0.01."""
    sf = "/root/testdata/sf0.01"
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}
    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    index = defaultdict(set)
    n = {}
    for r in b.collect():
        w = plain(r.text)
        n[r.item_id] = len(w) - 7
        for j in range(len(w) - 7):
            index[tuple(w[j : j + 8])].add((r.item_id, j))
    want = set()
    for r in d.collect():
        w, hits = plain(r.text), defaultdict(set)
        for j in range(len(w) - 7):
            for i, k in index.get(tuple(w[j : j + 8]), ()):
                hits[i].add(k)
        want |= {(r.doc_id, i) for i, ks in hits.items() if len(ks) >= 0.5 * n[i]}
    assert got == want


def test_native_plan(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    plan = decontaminate.contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lm_scores(spark, empty, labels):
    rng, a, b = random.Random(5), vocabulary(200, 1), vocabulary(200, 2)
    texts = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(20, 90))), "", "", 0, "", 0) for i in range(400)]
    d = spark.createDataFrame([*texts, (401, None, "", "", 0, "", 0), (402, "one", "", "", 0, "", 0)], SCHEMA)
    lab = spark.createDataFrame([(i, i % 2) for i in range(0, 200)], "doc_id long, quality int")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(d, lab).collect()}
    assert len(got) == 402 and got[401].n_words == 0 and got[401].difference == 0
    unseen = range(200, 400)
    assert max(got[i].difference for i in unseen if i % 2) < min(got[i].difference for i in unseen if not i % 2)
    # Brute force of one document that is not in the sample.
    w = texts[301][1].split()
    c1, c2 = Counter(), Counter()
    for i in range(1, 200, 2):
        x = texts[i][1].split()
        c1.update(x)
        c2.update(zip(x, x[1:], strict=False))
    total = sum(c1.values())
    p = lambda x: (c1[x] + 1) / (total + lm_scoring.WORDS)
    loss = [-np.log(p(w[0]))] + [-np.log((c2[x, y] + lm_scoring.BACKOFF * p(y)) / (c1[x] + lm_scoring.BACKOFF)) for x, y in zip(w, w[1:], strict=False)]
    assert abs(np.mean(loss) - got[301].target_loss) < 0.3  # a pair may share its bucket with another one
    assert all(r.difference == pytest.approx(0, abs=1e-6) for r in lm_scoring.cross_entropy_difference(d, lab.limit(0)).collect())
    assert lm_scoring.cross_entropy_difference(empty, lab).count() == 0


def test_lm_counts_are_exact(spark, monkeypatch):
    """Brute force of both models with each document left out of them, in several chunks and ranges."""
    for name in ("CHUNK", "RANGE"):
        monkeypatch.setattr(lm_scoring, name, 50_000, raising=False)
    rng, words = random.Random(8), vocabulary(4000, 8)
    texts = {i: [rng.choice(words[: rng.choice((60, 4000))]) for _ in range(rng.randint(0, 400))] for i in range(300)}
    d = spark.createDataFrame([(i, " ".join(w), "", "", 0, "", 0) for i, w in texts.items()], SCHEMA).repartition(3)
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 200)], "doc_id long, quality int")
    grams = {i: (Counter(w), Counter(zip(w, w[1:], strict=False))) for i, w in texts.items()}
    good = {i for i in range(0, 200) if i % 3 == 0}
    models = [[sum((grams[i][k] for i in ids), Counter()) for k in (0, 1)] for ids in (good, texts)]

    def loss(i, model, left_out):
        (c1, c2), (o1, o2), w = model, grams[i] if left_out else (Counter(), Counter()), texts[i]
        total = sum(c1.values()) - sum(o1.values())
        alone = lambda x: (c1[x] - o1[x] + 1) / (total + lm_scoring.WORDS)
        pair = lambda x, y: (c2[x, y] - o2[x, y] + lm_scoring.BACKOFF * alone(y)) / (c1[x] - o1[x] + lm_scoring.BACKOFF)
        return -sum(np.log([alone(w[0]), *(pair(x, y) for x, y in zip(w, w[1:], strict=False))])) / len(w) if w else 0.0

    got = lm_scoring.cross_entropy_difference(d, lab).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_words == len(texts[r.doc_id])
        assert r.target_loss == pytest.approx(loss(r.doc_id, models[0], r.doc_id in good), abs=1e-9)
        assert r.background_loss == pytest.approx(loss(r.doc_id, models[1], True), abs=1e-9)


def test_lm_target_is_every_good_document(spark, docs, rows):
    """Where all documents are good, both models are one, however many labels there are."""
    lab = spark.range(45_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    got = lm_scoring.cross_entropy_difference(docs, lab.unionByName(lab.limit(50))).collect()
    assert len(got) == len(rows) and all(r.difference == pytest.approx(0, abs=1e-9) for r in got)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<!-- <p>no</p> --><div class="{main}"><h1>Head {i}</h1><p>First &amp; {body}<br>more   words<p>Second <b>bold</b> a < b<div class="share-box">Share this</div>
<form><input value="a > b">Search</form></div><div class="sidebar">Also read other things {i}</div><section id="comments"><p>Nice post {i}</p></section><footer>&copy; us</footer></body></html>"""


def test_html(spark):
    rng, words = random.Random(1), vocabulary(100)
    body = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)]
    pages = [(i, f"https://u@H.example:80/{i}" if i % 2 else f"http://h.example/{i}?q", PAGE.format(main="content-x7", i=i, body=body[i])) for i in range(12)]
    pages += [(50, None, None), (51, "", ""), (52, "http://one.example/", "<p>Only text"), (53, "http://h.example/cut", "<html><body><div class='content-x7'><p>Cut of&am"), (0, pages[0][1], pages[0][2])]
    got = html_extract.extract(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")).collect()
    assert len(got) == len(pages)
    text = {r.page_id: r.text for r in got}
    for i in range(12):
        assert text[i] == f"Head {i}\n\nFirst & {body[i]} more words\n\nSecond bold a < b"
    assert text[50] == text[51] == "" and text[52] == "Only text" and text[53] == "Cut of&am"
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_main_slot_keeps_the_whole_article(spark):
    """Headings, leads and siblings of the container that holds most of the text stay."""
    rng, words = random.Random(4), vocabulary(200)
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    pages, want = [], {}
    for i in range(8):
        head, lead, body = some(4), some(20), some(80)
        around = "<html><body><nav>Menu</nav><p>Welcome to this site</p>{}<footer>us</footer></body></html>"
        pages.append((i, "http://a.example/", around.format(f"<article class=story><h1>{head}</h1><p>{lead}</p><section><p>{body}</p></section></article>")))
        pages.append((i + 10, "http://b.example/", around.format(f"<div class=post><h1>{head}</h1><div class=intro><p>{lead}</p></div><div class=body><p>{body}</p></div></div>")))
        pages.append((i + 20, f"http://c{i}.example/", f"<html><body><nav>Menu</nav><div class=post><h1>{head}</h1><div class=intro><p>{lead}</p></div><div class=body><p>{body}</p></div></div></body></html>"))
        want |= {i + k: f"{head}\n\n{lead}\n\n{body}" for k in (0, 10, 20)}
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_html_deep_nesting():
    deep = "<div>" * 5000
    page = f"<body><article>{deep}<p>in</p>{'</div>' * 5000}<p>after</p></article><div class=menu>{deep}{'</div>' * 5000}<p>menu</p></div></body>"
    assert html_extract.main_text(html_extract.parse(page)) == "in\n\nafter"


def extracted(spark, pages):
    got = html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages)
    return {r.page_id: r.text for r in got}


def test_html_repeats(spark):
    """Pages that repeat as a whole, sentences on all pages, and halves in lists, tables and sections stay."""
    rng, words = random.Random(7), vocabulary(200)
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    frame = "<html><body><nav><a href=/>Home</a></nav><div class=top><p>Welcome to this site</p></div><div class=post>{}</div><div class=cookie-note>We use cookies</div><p>All rights reserved</p></body></html>"
    same = f"<h1>{some(4)}</h1><p>{some(60)}</p>"
    lines, want, pages = [some(9) for _ in range(30)], {}, []
    for i in range(6):
        # 0: one article on all pages of a host, with and without an article container.
        pages += [(i, "http://a.example/", frame.format(same)), (10 + i, "http://b.example/", f"<body><nav>Menu</nav><article>{same}</article></body>")]
        # 20: a sentence that all pages hold between others; template text at both ends goes.
        parts = [lines[i], "As we say every week", lines[i + 6]]
        pages.append((20 + i, "http://c.example/", frame.format("".join(f"<p>{x}</p>" for x in parts))))
        want[20 + i] = "\n\n".join(parts)
        # 30: half of the text in a list, a table or a section; div-only host.
        kind = [f"<ul><li>{lines[i]} {lines[i + 1]}</li><li>{lines[i + 2]}</li></ul>", f"<table><tr><td>{lines[i]}</td><td>{lines[i + 1]}</td></tr><tr><th>{lines[i + 2]}</th></tr></table>", f"<section><p>{lines[i]}<br>{lines[i + 1]}</p><p>{lines[i + 2]}</p></section>"][i % 3]
        pages += [(30 + i, "http://d.example/", frame.format(f"<h1>T {i}</h1><p>{lines[i + 12]}</p>{kind}<p>{lines[i + 20]}</p>")), (40 + i, "http://e.example/", f"<body><article><h1>T {i}</h1><p>{lines[i + 12]}</p>{kind}<p>{lines[i + 20]}</p></article></body>")]
        want[30 + i] = want[40 + i] = "\n\n".join([f"T {i}", lines[i + 12], f"{lines[i]} {lines[i + 1]}", lines[i + 2], lines[i + 20]])
    got = extracted(spark, pages)
    head, text = re.findall(r">([^<]+)<", same)
    assert all(f"{head}\n\n{text}" in got[i] and "Home" not in got[i] and "cookies" not in got[i] for i in range(6))
    assert all(got[10 + i] == f"{head}\n\n{text}" for i in range(6))
    assert {i: got[i] for i in want} == want
    # Nothing broadcast: the same texts.
    spark.conf.set("spark.tagloom.broadcastLimit", "0")
    try:
        assert extracted(spark, pages) == got
    finally:
        spark.conf.unset("spark.tagloom.broadcastLimit")


def test_html_long_page():
    parts = [f"<p>line {i} &amp; more</p>" for i in range(60_000)]
    got = html_extract.main_text(html_extract.parse("<body><nav>x</nav><article>" + "".join(parts) + "</article>"))
    assert got == "\n\n".join(f"line {i} & more" for i in range(60_000))


def test_html_names():
    some = "Some words of the article that are long enough"
    text = lambda page: html_extract.main_text(html_extract.parse(page))
    assert text(f"<body><div class='social-history'><p>{some}</p></div><div class='social-links'>Share</div></body>") == some
    assert text(f"<body><form id=frame><div class=menu>Menu</div><h1>Head</h1><p style='overflow: hidden'>{some}</p></form><form>Search</form><div hidden>no</div><div style='x:y; display: none'>no</div></body>") == f"Head\n\n{some}"
    assert text(f"<html><head><title>T</title><meta charset=utf-8><body><p>{some}") == some
    assert text(f"<body><p>{some} <svg>no end<p>More") == f"{some} no end\n\nMore"


def test_html_template_is_ordered_and_nested():
    tokens = [{"token": html_extract.ROOT, "class": 1, "rank": 0}, *({"token": t, "class": 1, "rank": t} for t in (1, 2, 3)), {"token": 4, "class": 2, "rank": 5}, {"token": 5, "class": 2, "rank": 6}, {"token": 6, "class": 3, "rank": 7}]
    template, root = html_extract.Template.make(tokens), html_extract.ROOT

    def valid(*pages):
        bad = {}
        for p in pages:
            for c, t, low, high in html_extract.faults(template, [root, *p]):
                was = bad.get((c, t), (low, high))
                bad[c, t] = (min(was[0], low), max(was[1], high))
        return html_extract.valid_tokens(template, [{"class": c, "token": t, "low": a, "high": b} for (c, t), (a, b) in bad.items()])

    assert valid([1, 4, 5, 4, 5, 2, 3], [1, 4, 5, 2, 6, 3]) == {root, 1, 2, 3, 4, 5, 6}
    # Out of order on one page: the token goes. Spread over gaps, or not in whole rounds: the class goes.
    assert valid([1, 2, 3], [1, 3, 2, 6]) in ({root, 1, 2, 4, 5, 6}, {root, 1, 3, 4, 5, 6})
    assert valid([1, 2, 6, 3], [1, 6, 2, 3]) == {root, 1, 2, 3, 4, 5}
    assert valid([1, 4, 5, 5, 4, 2, 3]) == {root, 1, 2, 3, 6}
    assert valid([1, 4, 2, 5, 3]) == {root, 1, 2, 3, 6}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=14))
def test_rising(ranks):
    from itertools import combinations

    got = sorted(html_extract.rising(ranks))
    assert all(ranks[a] < ranks[b] for a, b in zip(got, got[1:], strict=False))
    assert not any(all(x < y for x, y in zip(c, c[1:], strict=False)) for c in combinations(ranks, len(got) + 1)) if len(ranks) <= 9 else True


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<form>", "</form>", "<td>", "<br>", "<script>", "</script>", "<!--", "-->", "<a href='", "\"", "a &lt; b", " word ", "<", ">", "<svg>", "<head>", "<h1>"]), max_size=25))
def test_html_broken_markup(parts):
    page = html_extract.parse("".join(parts))
    assert len(page.where) == len(page.text) == len(page.after) and all(t == " ".join(t.split()) and t for t in page.text)
    assert isinstance(html_extract.main_text(page), str)
    seq, nth = html_extract.sequence(page)
    assert len(seq) == len(nth) == len(page.parent) + len(page.text)


def test_html_on_pages(spark):
    """Every paragraph and heading of the article, found here by a plain pattern."""
    from html import unescape

    d = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(d).collect()}
    for r in d.collect():
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", re.search(r"<article[^>]*>(.*?)</article>", r.html, re.S)[1])
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)


def shingles(text, k):
    w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_groups(rows, k, percent):
    sets = {r[0]: shingles(r[1], k) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent", "crowd"), [(4, 85, 16), (5, 80, 16), (4, 85, 2)])
def test_jaccard_groups(docs, rows, monkeypatch, k, percent, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    got = jaccard_join.similarity_groups(docs, k, percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, k, percent)


def test_jaccard_crowds(spark, monkeypatch):
    """One large group of near copies with few and many edits, in small blocks."""
    monkeypatch.setattr(jaccard_join, "CROWD", 4)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 7)
    monkeypatch.setattr(jaccard_join, "PROBES", 3)
    rng, words = random.Random(9), vocabulary(500)
    base, rows = [rng.choice(words) for _ in range(200)], []
    for i in range(90):
        w = list(base)
        for _ in range(i % 12):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w), "", "", 0, "", 0))
    got = jaccard_join.similarity_groups(spark.createDataFrame(rows, SCHEMA).repartition(4), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 4, 85)


def test_jaccard_crowd_of_all_sizes(spark, monkeypatch):
    """An n-gram that sets of all sizes hold by chance brings no texts together; links stay whole (F1)."""
    monkeypatch.setattr(jaccard_join, "CROWD", 3)
    rng, words = random.Random(4), vocabulary(30000)
    grams = [" ".join(rng.choice(words) for _ in range(4)) for _ in range(4000)]
    key = lambda g: int(jaccard_join.ngrams(np.frombuffer(g.encode(), np.uint8), np.array([0, len(g)]), 4)[0][0]) >> 6
    # The n-gram that comes first in the global order is in all prefixes.
    shared = min(grams, key=key)
    texts = [shared + " " + " ".join(rng.choice(words) for _ in range(int(12 * 1.5**i))) for i in range(7)]
    texts.append(texts[5] + " " + rng.choice(words))
    rows = [(i, t, "", "", 0, "", 0) for i, t in enumerate(texts)]
    seen, checked = [], jaccard_join._checked
    monkeypatch.setattr(jaccard_join, "_checked", lambda r, *a: seen.extend(r.select("id").collect()) or checked(r, *a))
    got = jaccard_join.similarity_groups(spark.createDataFrame(rows, SCHEMA), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 4, 85)
    assert {r.id for r in seen} == {5, 7}


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 2, 3)])
def test_jaccard_null_ids(spark, order):
    """Rows without an id link nothing and take no links from others, wherever they come."""
    words = vocabulary(60, 3)
    near = words[:50] + ["x"]
    rows = [(None, " ".join(words[:50])), (1, " ".join(words[:50])), (2, " ".join(near)), (None, "only here and nowhere else at all")]
    d = spark.createDataFrame([(rows[k][0], rows[k][1], "", "", 0, "", k) for k in order], SCHEMA).coalesce(1)
    got = {r.hash: (r.doc_id, r.component_id) for r in jaccard_join.similarity_groups(d, 4, 85, key_col="hash").collect()}
    assert got == {0: (None, 1), 1: (1, 1), 2: (2, 1), 3: (None, None)}


def test_jaccard_edges(spark, empty):
    assert jaccard_join.similarity_groups(empty).count() == 0
    odd = spark.createDataFrame([(7, "a b", "", "", 0, "", 0), (8, "A  b", "", "", 0, "", 0), (9, None, "", "", 0, "", 0), (10, "", "", "", 0, "", 0), (7, "a b", "", "", 0, "", 0)], SCHEMA)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similarity_groups(odd, 4, 85).collect()) == [(7, 1, 7), (7, 1, 7), (8, 1, 7), (9, 0, 9), (10, 0, 10)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=15), min_size=1, max_size=12), st.integers(50, 100))
def test_prefix_tree(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    tree = jaccard_join.tree_of([(a, i) for i, a in enumerate(arrays)])
    for a in sets:
        want = {i for i, b in enumerate(sets) if 100 * len(a & b) >= percent * len(a | b)}
        assert set(tree.similar(np.array(sorted(a), np.uint64), percent)) == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(500, x) for x in range(501, 560)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in list(root)}


def test_scratch_is_shared_and_dropped(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    t = common.settled(lambda: common.cut(spark.range(5), "inner").filter("id > 1"), "outer")
    assert t.scratch_path.startswith(base) and t.count() == 3
    common.drop(t)
    assert not common.exists(spark, t.scratch_path)
