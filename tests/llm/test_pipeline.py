"""The pipeline against plain Python where a stage has one answer, and its contract."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagloom.llm import common

SF = "/root/testdata/sf0.001"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.cut(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        seen[name] = (before, after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = seen["exact_dedup"]
    best = {}
    for r in before.values():
        best.setdefault(norm(r.text), []).append(r)
    assert set(after) == {min(g, key=lambda r: (-len(r.text or ""), r.doc_id)).doc_id for g in best.values()}
    before, after = seen["ngram_jaccard_join"]
    sets, root = {i: shingles(r.text) for i, r in before.items()}, {i: i for i in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert set(after) == {i for i in before if find(i) == i}
    before, after = seen["decontamination"]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(before) - set(after) == {i for i, r in before.items() if any(x in " ".join(r.text.split()) for x in items)}
    before, after = seen["mixing"]
    assert set(before) == set(after) and sum(r.taken for r in after.values()) > 0


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "some plain words of text", "en", "src0", 24)]])
def test_odd_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, SF), name)
    docs.collect()


def test_rows_of_one_id(spark):
    """Repeated rows leave one; two texts of one id, or of none, are judged by themselves."""
    text = " ".join(f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(1, text, "en", "a", 0), (1, text, "en", "a", 0), (1, "another text that stays " + text[::-1], "en", "a", 0), (2, text + " ", "en", "b", 0), (None, "of no id at all", "en", None, 0), (None, "of no id at all", "en", None, 0), (3, text + " more", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.exact_dedup_stage(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(1, rows[2][1]), (2, text + " "), (0, "of no id at all"), (3, text + " more")])
    near = corpus_pipeline.near_dedup_stage(spark, common.cut(kept), SF)
    assert sorted((r.doc_id or 0, r.text) for r in near.collect()) == sorted([(1, rows[2][1]), (2, text + " "), (0, "of no id at all")])


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "decontamination", "mixing"]
    assert corpus_pipeline.run(spark, SF).count() > 0
