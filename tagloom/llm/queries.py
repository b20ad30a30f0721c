"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table
from .decontaminate import contaminated
from .exact_dedup import exact_groups
from .html_extract import extract
from .jaccard_join import similarity_groups
from .lm_scoring import cross_entropy_difference
from .mixing import mix
from .quality import classify
from .substring_dedup import removed
from .token_counts import token_counts
from .toxicity import severity

TOKENIZER = "word_bpe_49k.json"
OVER_LIMIT = 2048


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight): 2 for documents labelled good, 0.5 for bad; the rest have no row."""
    per = labels.filter("quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    return per.select("doc_id", F.pow(F.lit(2.0), F.round(F.col("quality") * 2 - 1)).alias("weight"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # The cache stays for later runs. This tokenizer turns white space into one space and never joins over it.
    cache = spark.conf.get("spark.tagloom.tokenCache", None) or f"{shared_dir(spark)}/tagloom-token-cache"
    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), cache, spaces=True, pieces=True)
    return out.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))
    return out.withColumn("target", F.round("target", 6)).select("doc_id", "size", "source_size", "target", "taken", "epochs")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Labels only say toxic or not, so toxic documents are parted into three grades.
    return severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", degrees=3)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_groups(table(spark, sf_dir, "documents"), words=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_html_extraction": op9_html_extraction,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
}

OP2_SQL = r"""
WITH lab AS (SELECT doc_id, pow(2.0, round(avg(quality) * 2 - 1)) AS weight FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        (CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), 'mix')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents),
k AS (SELECT d.*, -ln(u) / coalesce(weight, 1.0) AS key FROM d LEFT JOIN lab USING (doc_id)),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w, 3.0 * source_size AS top FROM s),
r AS (SELECT *, top / w AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
t AS (SELECT source, source_size, least(top, w * first_value(CASE WHEN level <= ratio * (1 + 1e-12) THEN level END IGNORE NULLS) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS target FROM l),
j AS (SELECT k.doc_id, k.size, t.source_size, t.target, CAST(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS BIGINT) AS epochs,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
  CAST(size * (epochs + CASE WHEN start + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken, epochs FROM j
"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS holder FROM win) WHERE doc_id > holder),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM dup),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.k) AS t, count(*) AS n FROM x ANTI JOIN cov ON x.doc_id = cov.doc_id AND x.k = cov.k GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- Equal sets link; of each, the smallest doc_id stands for the rest.
f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY key) AS rep FROM (SELECT doc_id, md5(string_agg(g, chr(31) ORDER BY g)) AS key FROM s GROUP BY doc_id)),
r AS (SELECT s.doc_id, g FROM s JOIN f ON s.doc_id = f.doc_id AND f.doc_id = f.rep),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * hits >= 85 * (x.n + y.n - hits)),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
c AS (SELECT DISTINCT u AS node, u AS root FROM e UNION SELECT e.v, c.root FROM c JOIN e ON e.u = c.node),
m AS (SELECT node, min(root) AS root FROM c GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, f.rep, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN m ON m.node = f.rep
"""

ORACLES: dict[str, str] = {"op2_mixing": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op6_substring_dedup": OP6_SQL, "op10_ngram_jaccard_join": OP10_SQL}
