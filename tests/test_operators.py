"""Hand-made cases of the curation operators."""

import math
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import fixed, tags, tokens
from tagloom.operators import buckets, counts, impute, incremental, models, prompts, relational, sampling, similarity, sinks, tiering
from tagloom.sources import tables
from tagloom.streaming import streams


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    ("function", "given_", "want"),
    [
        (tags.prompt_of, "1girl long_hair star_(symbol)", "1girl, long hair, star \\(symbol\\)"),
        (tags.prompt_of, None, ""),
        (tags.raw_tag, "star \\(symbol\\)", "star_(symbol)"),
        (tags.readable_tag, "looking_at_viewer", "looking at viewer"),
        (tags.tags_of_prompt, "long hair, blue eyes", "long_hair blue_eyes"),
        (tags.sanitized, "a,  b  c , ,d", "a, b c, d"),
        (tags.without_person_tags, "1girl 2boys smile", "smile"),
        (tags.without_person_tags, "solo smile", "smile"),
        (tags.without_person_tags, "6+girls 1boy x", "6+girls x"),
        (lambda c: F.array_join(tags.person_tags(c), ", "), "1girl 2boys smile", "1girl, 2boys"),
        (lambda c: F.array_join(tags.person_tags(c), ", "), "cowboy 3d", ""),
        (lambda c: tags.year_phrase(tags.year_of(c)), "2017-05", "oldest, year 2017"),
        (lambda c: tags.year_phrase(tags.year_of(c)), "2020-05", "modern, year 2020"),
        (lambda c: tags.year_phrase(tags.year_of(c)), "2023-05", "newest, year 2023"),
        (lambda c: tags.year_phrase(tags.year_of(c)), "abcd", ""),
        (tags.id_of_path, "a\\b/12.png", 12),
        (tags.id_of_path, "a/x.png", -1),
        (tags.tag_count, "", 0),
        (tags.tag_count, "a  b", 3),
    ],
)
def test_tag_functions(spark, function, given_, want):
    assert one(spark, function(F.lit(given_).cast("string"))) == want


def test_size_and_length_tiers(spark):
    size = lambda w, h: one(spark, tags.size_tag(F.lit(w), F.lit(h)))
    assert [size(500, 500), size(1600, 1200), size(4000, 3000), size(800, 800)] == ["lowres", "highres", "highres", ""]
    assert [one(spark, tags.length_tier(F.lit(n))) for n in (77, 78, 228)] == [77, 152, 227]


def test_validated_and_combined(spark):
    keep = lambda new, own, general="1girl": one(spark, tags.validated(F.lit(new), F.lit(own), F.lit(general)))
    assert keep("short hair, smile", "1girl, long hair") == "smile"
    assert keep("blue hair, red hair, x", "multicolored hair") == "blue hair, x"
    assert keep("blue eyes, red eyes", "heterochromia") == "blue eyes, red eyes"
    assert keep("black panties, shirt", "black bikini") == "shirt"
    assert keep("", "") == ""
    new = F.array(*[F.lit(t) for t in ("Hat", "2girls", "red hair", "smile")])
    assert one(spark, tags.combined(F.lit("1girl, long hair, hat"), new)) == ["smile"]


def test_token_arrays(spark):
    ids = [fixed.BOS, 10, 11, fixed.COMMA, 12, fixed.BRACKET_COMMA, 13, fixed.EOS]
    col = F.array(*[F.lit(i) for i in ids])
    parts = tokens.token_tags(col)
    assert one(spark, parts) == [[10, 11], [12, fixed.BRACKET_COMMA], [13]]
    assert one(spark, tokens.token_ids(parts)) == ids
    mixed = one(spark, tokens.shuffled(col, F.lit(1)))
    assert sorted(i for i in mixed if i != fixed.COMMA) == sorted(i for i in ids if i != fixed.COMMA)
    assert len(one(spark, tokens.shuffled(col, F.lit(1), most=6))) <= 7
    lead = tokens.leading_tags(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.lit(2), F.lit(5), F.lit(1)), F.lit(6))
    assert one(spark, lead) == ["a"]


def test_children(spark):
    def kept(children, parent_tags=5):
        rows = [(1, None, " ".join("t" * parent_tags), 0.0)] + [(i + 2, 1, " ".join("t" * n), float(s)) for i, (n, s) in enumerate(children)]
        df = spark.createDataFrame(rows, "id long, parent_id long, tag_string string, score double")
        return sorted(r.id for r in tiering.prune_children(df, F.lit(False)).collect() if r.id > 1)

    assert kept([(5, 0)]) == [] and kept([(6, 0)]) == [2]
    assert kept([(4, 9), (4, 3)]) == [2]
    assert kept([(9, 1), (2, 8), (1, 3)]) == [2, 3]


def test_final_tier(spark):
    cases = {("masterpiece", "worse"): "bad_score", ("worse_score", "best"): "worse_score", ("good_score", "best"): "masterpiece", ("bad_score", "worst"): "worse_score", ("worse_score", "better"): "good_score", ("bad_score", None): "bad_score"}
    for (tier, label), want in cases.items():
        assert one(spark, tiering.final_tier(F.lit(tier), F.lit(label).cast("string"))) == want


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        tiering.prefiltered(spark.range(1))


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10_000))
def test_quotas_sum(total):
    got = sampling.quotas(total, {"g": 0.20, "s": 0.35, "q": 0.30, "e": 0.15})
    assert sum(got.values()) == total and min(got.values()) >= 0


def test_quotas_and_draw(spark):
    assert sampling.quotas(10, {"g": 0.20, "s": 0.35, "q": 0.30, "e": 0.15}) == {"g": 3, "s": 3, "q": 3, "e": 1}
    rows = spark.range(100).select("id", F.element_at(F.array(*[F.lit(x) for x in "gsqe"]), (F.col("id") % 4 + 1).cast("int")).alias("rating"), F.lit("a").alias("tag_string"))
    got = sampling.draw(rows, 20, {"g": 0.5, "s": 0.5}, {}, F.rand(1)).groupBy("rating").count().collect()
    assert {r["rating"]: r["count"] for r in got} == {"g": 10, "s": 10}
    assert sampling.draw(rows, 1000, {"g": 1.0}, {}, F.rand(1)).count() == 100


def test_weights(spark):
    equal = counts.tag_weights(spark.createDataFrame([("a", "x", 1), ("a", "y", 1)], "category string, tag string, count long"))
    assert [r.weight for r in equal.collect()] == [1.0, 1.0]
    w = spark.createDataFrame([("general", "x", 2.0), ("artist", "y", 0.5)], "category string, tag string, weight double")
    captions = spark.createDataFrame([(1, "x, y"), (2, "none")], "id long, caption string")
    assert {r.id: round(r.weight, 9) for r in counts.caption_weights(captions, w).collect()} == {1: 1.0, 2: 1.0}


def test_buckets(spark):
    assert len(buckets.bucket_sizes()) == 19 and buckets.bucket_sizes()[0] == (256, 1024) and buckets.bucket_sizes()[-1] == (1024, 256)
    assert len(buckets.bucket_sizes((1024, 1024), base=(1024, 1024), limit=1536)) == 29
    with pytest.raises(ValueError, match="no bucket"):
        buckets.bucket_sizes((64, 64))
    sizes = buckets.bucket_sizes()
    rows = spark.createDataFrame([(1, 512, 512), (2, 0, 10), (3, 5000, 100)], "id long, image_width long, image_height long")
    assert [r.id for r in buckets.assigned(rows, sizes).collect()] == [1]


def test_shards_continue(spark, tmp_path):
    rows = spark.range(10_000).select("id", (F.col("id") % 2).alias("bucket"), F.lit(77).alias("tier"))
    start = spark.createDataFrame([(0, 77, 5)], "bucket long, tier int, next long")
    got = buckets.sharded(rows, 100, start=start)
    per = {r.bucket: (r.lo, r.hi, r.n) for r in got.groupBy("bucket").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.countDistinct("idx").alias("n")).collect()}
    assert per == {0: (5, 5004, 5000), 1: (0, 4999, 5000)}
    buckets.write_shards(got, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 10_000
    assert {r.bucket: r.next for r in buckets.next_indices(got).collect()} == {0: 5005, 1: 5000}


def test_hamming_and_groups(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(40)]
    values = base + [b ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for b in base[:20]] + base[:3]
    df = spark.createDataFrame(list(enumerate(values)), "id long, hash long")
    got = {(r.a, r.b) for r in similarity.hamming_pairs(df, 5).collect()}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() < 5}
    assert got == want
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in want:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    assert {r.id: r.group for r in similarity.groups(similarity.hamming_pairs(df, 5)).collect()} == {x: find(x) for p in want for x in p}
    assert {r.id: r.group for r in similarity.near_groups(df, 5).collect()} == {x: find(x) for p in want for x in p}


def test_many_equal_hashes(spark):
    """A crowd of one hash makes a group without any of its pairs."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id")).alias("hash"))
    got = similarity.near_groups(df, 1)
    assert got.count() == 6667 and got.filter("group != 0").isEmpty()


def test_sizes_of_groups_stay_small(spark):
    """The estimated size of the labels does not multiply with the rounds (F2)."""
    pairs = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    size = similarity.groups(pairs)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size < 2**40


def test_long_chain_of_pairs(spark):
    n = 3000
    pairs = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert similarity.groups(pairs).filter("group != 0").isEmpty()


def test_survivors(spark):
    rows = [(1, 0, 1, 9, 5.0, 0.0), (2, 0, 1, 2, 5.0, 0.0), (3, 0, 1, 1, 9.0, 0.0), (4, 1, 2, 1, 1.0, 0.0), (5, 1, 1, 9, 9.0, 0.0), (6, 2, 1, None, 1.0, 0.0), (7, 2, 1, 5, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, group long, tier int, tags int, score double, fav_count double")
    assert sorted(r.id for r in similarity.survivors(df).collect()) == [1, 3, 4, 6, 7]


def test_imputation(spark):
    rows = [(1, 1.0, "a", "c"), (2, 3.0, "a b", "c"), (3, None, "a", "c"), (4, None, "z", "c"), (5, None, "z", "y")]
    df = spark.createDataFrame(rows, "id long, score double, tag_string_artist string, tag_string_character string")
    got = {r.id: r.score for r in impute.imputed(df).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 2.0, 4: 2.0, 5: 2.0}
    rows = [(1, 20.0, "", "d"), (2, 10.0, "a", "c"), (3, None, "", "c"), (4, None, None, "c"), (5, None, "a  x", ""), (6, 30.0, None, None)]
    df = spark.createDataFrame(rows, "id long, score double, tag_string_artist string, tag_string_character string")
    got = {r.id: r.score for r in impute.imputed(df).collect()}
    # No artist: on to characters. A doubled blank names the empty artist, whose mean is that of the empty string.
    assert got == {1: 20.0, 2: 10.0, 3: 10.0, 4: 10.0, 5: 15.0, 6: 30.0}


def test_incremental(spark):
    rows = spark.createDataFrame([("t", i, f"2024-01-{i:02d} 00:00:00") for i in range(1, 29)], "tag string, id long, created_at string").withColumn("created_at", F.to_timestamp("created_at"))
    newest = spark.createDataFrame([("t", 20)], "tag string, newest_id long")
    assert sorted(r.id for r in incremental.fetched(rows, newest).collect()) == list(range(13, 29))


def test_paged_source(spark):
    calls = []

    class Source(incremental.PagedSource):
        pass

    def fetch(tag, page):
        calls.append(page)
        return [(page, "2024", tag)] if page < 3 else []

    Source.fetch = staticmethod(fetch)
    spark.dataSource.register(Source)
    got = spark.read.format("paged_posts").option("tags", "x,y").option("wait", "0").load()
    assert sorted((r.tag, r.id) for r in got.collect()) == [("x", 1), ("x", 2), ("y", 1), ("y", 2)]


def test_sources(spark, tmp_path):
    (tmp_path / "img").mkdir()
    for name, text in (("1.png", "x"), ("2.avif", "x"), ("2.jpg", "x"), ("n.png", "x"), ("1.txt", "a, b"), ("2.txt", "")):
        (tmp_path / "img" / name).write_text(text)
    images = tables.files(spark, str(tmp_path / "img"))
    assert sorted((r.id, r.suffix) for r in images.collect()) == [(-1, "png"), (1, "png"), (2, "avif"), (2, "jpg")]
    assert {r.path.rsplit("/", 1)[1] for r in tables.resolved(images).collect()} == {"1.png", "2.jpg", "n.png"}
    assert [r.id for r in tables.with_sidecars(images, tables.files(spark, str(tmp_path / "img"), ("txt",))).collect()] == [1]
    (tmp_path / "tags.txt").write_text("long hair\n\nstar \\(symbol\\)\nlong hair\n")
    assert sorted(r.tag for r in tables.tag_lists(spark, str(tmp_path / "tags.txt")).collect()) == ["long_hair", "star_(symbol)"]
    (tmp_path / "l.json").write_text('{"a/5.png": 3, "b/x.png": 0}')
    assert {(r.id, r.label) for r in tables.labels_of_json(spark, str(tmp_path / "l.json")).collect()} == {(5, "masterpiece"), (-1, "worse_score")}
    with pytest.raises(ValueError, match="format"):
        tables.read_any(spark, "x.foo")
    assert tables.read_any(spark, str(tmp_path / "none.csv"), tables.KNOWLEDGE).count() == 0
    (tmp_path / "long.csv").write_text("a,b\n1,2,3\n4,5\n")
    assert [r.value for r in tables.cut_long_rows(spark, str(tmp_path / "long.csv")).collect()] == ["a,b", "1,2", "4,5"]


def test_workbook(tmp_path):
    with zipfile.ZipFile(tmp_path / "x.xlsx", "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>character_tag</t></si><si><t>mia</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="B1" t="s"><v>0</v></c></row><row><c r="B2" t="s"><v>1</v></c></row></sheetData></worksheet>')
    assert tables.xlsx_column(str(tmp_path / "x.xlsx")) == ["mia"]


def test_models(spark):
    rows = spark.createDataFrame([(1, "good"), (2, None), (3, "bad")], "id long, text string")

    def scorer(texts):
        if "bad" in texts:
            raise ValueError
        return [[0.1, 0.9, 0.4, 0.2] for _ in texts]

    got = {r.id: r.scores for r in models.scored(rows, scorer, "text").collect()}
    assert got[2] is None and got[3] is None and len(got[1]) == 4
    scores = F.array(*[F.lit(x) for x in (0.1, 0.9, 0.4, 0.2)])
    assert one(spark, models.best_label(scores)) == "worse"
    assert one(spark, models.tags_over(scores, ["a", "b", "c", "d"], [0, 0, 9, 4])) == ["b"]
    assert one(spark, models.ranked_tags(scores, ["a", "b", "c", "d"]))[0].name == "b"


def test_paged_source_tells_failures(spark):
    class Failing(incremental.PagedSource):
        pass

    def fetch(tag, page):
        if tag == "y" and page == 2:
            raise OSError("gone")
        return [(page, "2024", tag)] if page < 3 else []

    Failing.fetch = staticmethod(fetch)
    spark.dataSource.register(Failing)
    got = spark.read.format("paged_posts").option("tags", "x,y").option("wait", "0").load().collect()
    assert sorted((r.tag, r.id) for r in got if r.id) == [("x", 1), ("x", 2), ("y", 1)]
    assert [(r.tag, r.payload) for r in got if r.id is None] == [("y", "failed: gone")]


def picture(values, channels=3):
    import numpy as np

    a = np.asarray(values, np.uint8)
    return (a.shape[1], a.shape[0], channels, bytearray(a.tobytes()))


IMAGE = "id long, image struct<width: int, height: int, nChannels: int, data: binary>"


def test_padded_pixels(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    wide = rng.integers(0, 256, (4, 8, 3))
    clear = np.zeros((2, 2, 4), int)
    clear[0, 0] = (10, 20, 30, 255)
    got = {r.id: np.array(r.pixels).reshape(3, 8, 8) for r in models.padded_pixels(spark.createDataFrame([(1, picture(wide)), (2, picture(clear, 4)), (3, picture(np.full((16, 16, 1), 9), 1))], IMAGE), 8, 8, (255, 0, 128)).collect()}
    assert (got[1][:, 2:6] == wide.transpose(2, 0, 1)).all()
    assert (got[1][:, :2].reshape(3, -1) == np.array([[128], [0], [255]])).all() and (got[1][:, 6:].reshape(3, -1) == np.array([[128], [0], [255]])).all()
    assert got[2][:, 0, 0].tolist() == [10, 20, 30] and got[2][:, 7, 7].tolist() == [128, 0, 255]
    assert (got[3] == 9).all()
    w = models.resize_weights(10, 4)
    assert np.allclose(w.sum(1), 1) and (w >= 0).all() and np.allclose(models.resize_weights(5, 5), np.eye(5))


def test_phash_by_cells(spark):
    """Against a plain loop over cells, for sizes below and above 32."""
    import numpy as np

    rng = np.random.default_rng(2)
    sizes = [(20, 50), (64, 64), (100, 33), (32, 32)]
    images = [rng.integers(0, 256, (*s, 3)) for s in sizes]
    got = {r.id: r.hash for r in models.phash(spark.createDataFrame([(i, picture(x)) for i, x in enumerate(images)], IMAGE)).collect()}
    k = np.arange(32)
    cosine = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64)
    for i, x in enumerate(images):
        grey, (h, w) = x.mean(2), x.shape[:2]
        ys, xs = np.linspace(0, h, 33).astype(int), np.linspace(0, w, 33).astype(int)
        small = np.array([[grey[ys[a] : max(ys[a + 1], ys[a] + 1), xs[b] : max(xs[b + 1], xs[b] + 1)].mean() for b in range(32)] for a in range(32)])
        low = (cosine @ small @ cosine.T)[:8, :8].ravel()
        low[0] = 0
        bits = "".join("1" if v else "0" for v in low > low.mean())
        assert got[i] & (2**64 - 1) == int(bits, 2)


def test_face_crop(spark):
    rows = [(1, 1000, 1000, 0, 0, 800, 800), (2, 1000, 1000, 100, 40, 300, 240), (3, 1000, 1000, 300, 300, 500, 500), (4, 1000, 1000, 0, 0, 100, 100)]
    df = spark.createDataFrame(rows, "id long, w int, h int, x0 int, y0 int, x1 int, y1 int")
    got = {r.id: r.crop for r in df.select("id", models.face_crop(F.col("w"), F.col("h"), F.struct("x0", "y0", "x1", "y1")).alias("crop")).collect()}
    assert tuple(got[1]) == (0, 0, 1000, 1000, True) and tuple(got[2]) == (60, 0, 340, 280, False)
    assert got[3] is None and got[4] is None  # not square; too small


def test_sources(spark, tmp_path):
    columns = "id long, score double, fav_count double, tag_string string"
    rows = [(1, 1.0, None, "a"), (1, 2.0, 4.0, "a b"), (2, 3.0, 8.0, "c")]
    spark.createDataFrame(rows, columns).write.parquet(f"file://{tmp_path}/k.parquet")
    scores = spark.createDataFrame([(1, 5.0)], "id long, score double")
    got = {r.id: (r.score, r.fav_count, r.aes_score) for r in tables.scan_knowledge(spark, f"file://{tmp_path}/k.parquet", scores).collect()}
    assert got == {1: (2.0, 4.0, 5.0), 2: (3.0, 8.0, 5.0)}
    with pytest.raises(ValueError, match="unknown format"):
        tables.read_any(spark, "x.duckdb")
    sinks.write_csv(spark.createDataFrame([(1, "a,b")], "id long, t string"), f"file://{tmp_path}/r.csv")
    sinks.write_csv(spark.createDataFrame([(2, 'q"')], "id long, t string"), f"file://{tmp_path}/r.csv")
    back = spark.read.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/r.csv")
    assert back.columns == ["id", "t"] and back.count() == 2
    for i, data in enumerate(("ä".encode(), "ä".encode("utf-16"), b"\xfe\xff" + "ä".encode("utf-16-be"))):
        assert one(spark, tables.decoded_text(F.unhex(F.lit(data.hex())))).strip("\ufeff") == "ä", i


def test_scans_and_sidecars(spark, tmp_path):
    import struct
    import zlib

    def png(w, h):
        part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress((b"\0" + b"\x10\x20\x30" * w) * h)) + part(b"IEND", b"")

    (tmp_path / "1").mkdir()
    for name, data in (("5.png", png(3, 2)), ("1/6.png", png(4, 5)), ("1/7.png", b"broken"), ("1/8.png", png(1, 1))):
        (tmp_path / name).write_bytes(data)
    root = str(tmp_path)
    assert sorted(r.id for r in tables.scanned(spark, root).collect()) == [6, 7, 8] and [r.id for r in tables.scanned(spark, f"{root}/1").orderBy("id").collect()] == [6, 7, 8]
    rows = tables.files(spark, root).filter("id in (6, 7)").select("id", "relative", F.concat(F.lit("prompt "), F.col("id").cast("string")).alias("prompt"), F.lit("{}").alias("json"))
    for _ in range(2):
        assert {(r.id, r.outcome) for r in sinks.applied(rows, sinks.sidecar_writer(root)).collect()} == {(6, ".txt .json"), (7, ".txt .json")}
    assert (tmp_path / "1/6.txt").read_text() == "prompt 6" and (tmp_path / "1/7.json").read_text() == "{}" and not list(tmp_path.rglob("*.part"))
    got = tables.sized(spark, root, tables.files(spark, root, ("txt",))).collect()
    assert [(r.id, r.width, r.height) for r in got] == [(6, 4, 5)]


def test_windowed_counts(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(0, 7200, 60)] + [(90_000, "a")], "at long, k string").select(F.timestamp_seconds("at").alias("at"), "k")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streams.windowed_counts(streams.file_stream(spark, str(tmp_path / "in"), "at timestamp, k string"), "at", "k")
    q = stream.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["count"] for r in spark.table("counted").collect()) == [1, 60, 60]


def test_redownload(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    missing, left = incremental.redownload(ids(1, 2, 3, 3), ids(1), spark.createDataFrame([(2, "masterpiece")], "id long, final_tier string"), ids(2, 9))
    assert {(r.id, r.final_tier) for r in missing.collect()} == {(2, "masterpiece"), (3, "good_score")} and [r.id for r in left.collect()] == [9]


def test_restore_and_subfolder(spark):
    names = ["0/5.png", "1/5.png", "cleaned/5.png", "2/7.jpg", "2/8.txt"]
    files = spark.createDataFrame([(n, n.rpartition(".")[2]) for n in names], "relative string, suffix string")
    copies, missing = incremental.restore_plan(files, spark.createDataFrame([("5 ",), ("7",), ("8",), ("",)], "stem string"))
    assert {(r.src, r.dst) for r in copies.collect()} == {("1/5.png", "cleaned/5.png"), ("1/5.txt", "cleaned/5.txt"), ("2/7.jpg", "cleaned/7.jpg"), ("2/7.txt", "cleaned/7.txt")}
    assert [r.stem for r in missing.collect()] == ["8"]
    assert one(spark, tags.subfolder(F.lit("x b a"), F.lit(2), ["a", "b"])) == "a/2" and one(spark, tags.subfolder(F.lit("x"), F.lit(2), ["a"])) == "2" and one(spark, tags.subfolder(F.lit("x"), F.lit(2), [])) == "2"


@pytest.mark.parametrize("few", [10_000, 5])
def test_percentiles(spark, monkeypatch, few):
    """Exact for ties, long tails, few values and nulls, however fine the histograms must get."""
    import numpy as np

    monkeypatch.setattr(tiering, "FEW", few)
    monkeypatch.setattr(tiering, "BINS", 16)
    rng = np.random.default_rng(5)
    columns = {"a": rng.integers(0, 40, 3000).astype(float), "b": np.exp(rng.normal(0, 6, 3000)), "c": np.repeat([1.0, 2.0, 3.0], 1000), "d": rng.normal(size=3000)}
    rows = [tuple(None if k == "d" and i % 3 == 0 else float(v[i]) for k, v in columns.items()) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    points = {k: (0.0, 0.2, 0.38, 0.5, 0.92, 1.0) for k in columns}
    got = tiering.percentiles(df, points, dict.fromkeys(columns, 3))
    columns["d"] = np.array([r[3] for r in rows if r[3] is not None])
    for k, v in columns.items():
        assert got[k] == pytest.approx([0.0] * 6 if k == "c" else np.quantile(v, points[k]).tolist(), rel=1e-12)
    assert tiering.percentiles(df.limit(0), {"a": (0.5,)}, {"a": 3}) == {"a": [0.0]}


def test_draw(spark):
    """Quotas by rating first, the rest by key; against plain Python."""
    rng = random.Random(4)
    rows = [(i, rng.choice("gsq"), rng.random(), "lowres" if i % 5 == 0 else "x") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, rating string, u double, tag_string string")
    shares = {"g": 0.1, "s": 0.5, "q": 0.1, "e": 0.3}
    got = {r.id for r in sampling.draw(df, 101, shares, {"lowres": 0.25}, F.col("u")).collect()}
    key = {i: -math.log(u) / (0.25 if t == "lowres" else 1.0) for i, _, u, t in rows}
    want = set()
    for rating, n in sampling.quotas(101, shares).items():
        want |= set(sorted((i for i, r, _, _ in rows if r == rating), key=key.get)[:n])
    want |= set(sorted((i for i in key if i not in want), key=key.get)[: 101 - len(want)])
    assert got == want and len(got) == 101


def test_phash(spark):
    data = bytearray(bytes(range(256)) * 12)
    image = spark.createDataFrame([(1, (32, 32, 3, data[:3072])), (2, (32, 32, 3, data[:3072]))], "id long, image struct<width: int, height: int, nChannels: int, data: binary>")
    got = [r.hash for r in models.phash(image).collect()]
    assert got[0] == got[1]


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(5).write.parquet(path)
    sinks.rewrite(spark.read.parquet(path).filter("id < 3"), path)
    assert spark.read.parquet(path).count() == 3
    # A rewrite that stopped between its renames.
    (tmp_path / "t").rename(tmp_path / "t.old")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert {r.outcome for r in sinks.applied(spark.range(3), lambda row: f"ok {row['id']}").collect()} == {"ok 0", "ok 1", "ok 2"}


def test_streams(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(100).select((F.col("id") % 60).alias("id"), F.timestamp_seconds(F.col("id")).alias("created_at"))
    rows.write.parquet(folder)
    stream = streams.late_dedup(streams.file_stream(spark, folder, "id long, created_at timestamp"))
    for _ in range(2):
        q = streams.append_once(streams.without_excluded(stream, spark.range(10)), out, str(tmp_path / "cp"), "id")
        q.awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10, 60))


def test_upsert_and_skip(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string"), spark.createDataFrame([(2, "c"), (3, "d")], "id long, x string")
    assert {(r.id, r.x) for r in relational.upsert(old, new).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    posts = spark.createDataFrame([(1, "Lowres x", "p"), (2, "lowres", "q"), (3, "lowres_x", "q")], "id long, tag_string string, tag_string_artist string")
    assert sorted(r.id for r in relational.skip_tags(posts, {"lowres": 1.0}, lambda t: F.lit(0.5), ["p"]).collect()) == [1, 3]
    posts = spark.createDataFrame([(1, "a multiple views b", "q"), (2, "comic_(x)", "q"), (3, "4koma-comic", "q"), (4, None, "q"), (5, "comics", "q")], "id long, tag_string string, tag_string_artist string")
    assert sorted(r.id for r in relational.skip_tags(posts, {"multiple views": 1.0, "comic": 1.0}, lambda t: F.lit(0.5)).collect()) == [2, 4, 5]
    twice = spark.createDataFrame([(2, "c"), (2, "d")], "id long, x string")
    assert {(r.id, r.x) for r in relational.upsert(old, twice, last=F.col("x")).collect()} == {(1, "a"), (2, "d")}
    none = spark.createDataFrame([(1, None, 1.0), (2, None, 5.0), (3, "m", 1.0), (4, "m", 2.0)], "id long, md5 string, score double")
    assert sorted(r.id for r in relational.md5_dedup(none).collect()) == [2, 4]


def test_prompts(spark):
    row = spark.createDataFrame([(1, "1girl long_hair", "mia", None, "ann", "g", "highres", "2020-01", "good_score")], "id long, tag_string_general string, tag_string_character string, tag_string_copyright string, tag_string_artist string, rating string, tag_string_meta string, created_at string, final_tier string")
    assert prompts.prompts(row).first().prompt == "1girl, mia, general, long hair, ann, good score, highres, modern, year 2020"
    assert prompts.prompts(row, F.lit(0.1)).first().prompt.count("quality") == 1
    assert math.isclose(one(spark, tags.include_weight(F.lit("a b a"), {"a": 2.0, "b": 1.5})), 3.0)
