"""The derived view of posts over the supplied documents and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

#: Both engines' spelling differs in one expression only.
VIEW = r"""
SELECT d.doc_id AS id,
  CAST((d.doc_id * 7919) % 997 AS DOUBLE) AS score,
  CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE CAST(3 * ((d.doc_id * 7919) % 997) + (d.doc_id * 31) % 401 AS DOUBLE) END AS fav_count,
  CASE WHEN l.doc_id IS NULL THEN NULL ELSE CAST(l.quality * 5 + (d.doc_id * 31) % 50 / 10.0 AS DOUBLE) END AS aes_score,
  md5(d.text) AS md5,
  substr('gsqe', CAST(d.doc_id % 4 AS INT) + 1, 1) AS rating,
  CAST(256 + (d.doc_id * 37) % 1800 AS BIGINT) AS image_width,
  CAST(256 + (d.doc_id * 53) % 1500 AS BIGINT) AS image_height,
  CASE WHEN d.doc_id > 0 AND d.doc_id % 4 = 1 AND d.doc_id % 7 > 1 THEN CAST(floor(d.doc_id / 12) AS BIGINT) ELSE NULL END AS parent_id,
  d.doc_id % 97 = 0 AS is_deleted,
  d.doc_id % 89 = 0 AS is_banned,
  concat_ws(' ', {tokens},
    CASE d.doc_id % 3 WHEN 0 THEN '1girl' WHEN 1 THEN '2boys' END,
    CASE WHEN d.doc_id % 2 = 0 THEN 'solo' END,
    CASE WHEN d.doc_id % 5 < 2 THEN 'highres' END,
    CASE WHEN d.doc_id % 13 = 0 THEN 'lowres blurry' END,
    CASE WHEN d.doc_id % 17 = 0 THEN 'star_(symbol)' END) AS tag_string_general,
  d.lang AS tag_string_character,
  d.source AS tag_string_artist,
  CASE WHEN d.doc_id % 6 = 0 THEN 'north_saga' WHEN d.doc_id % 6 = 1 THEN 'north_saga south_(game)' WHEN d.doc_id % 6 = 2 THEN 'a b c d e' END AS tag_string_copyright,
  CASE WHEN d.doc_id % 7 = 0 THEN 'highres official_art' WHEN d.doc_id % 7 = 1 THEN 'animated' WHEN d.doc_id % 7 = 2 THEN 'absurdres' END AS tag_string_meta,
  concat(CAST(2014 + d.doc_id % 12 AS VARCHAR(4)), '-0', CAST(1 + d.doc_id % 9 AS VARCHAR(1)), '-11T08:30:00.000+00:00') AS created_at,
  concat('https://cdn.example.org/original/', CAST(d.doc_id AS VARCHAR(20)), CASE d.doc_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.mp4' END) AS file_url,
  CASE WHEN d.doc_id % 4 > 0 THEN concat('https://cdn.example.org/sample/', CAST(d.doc_id AS VARCHAR(20)), '.jpg') END AS large_file_url,
  CASE d.doc_id % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' ELSE 'mp4' END AS file_ext,
  CASE WHEN l.toxic = 1 THEN 'worst' WHEN l.quality = 1 THEN 'best' WHEN l.quality = 0 THEN 'worse' END AS new_aesthetic_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
# Java lower-cases U+0130 to two characters, the second of which would part a word; DuckDB to one.
SPARK_TOKENS = "array_join(slice(regexp_extract_all(lower(replace(d.text, '\u0130', 'i')), '[a-z]+', 0), 1, CAST(10 + (d.doc_id * 13) % 31 AS INT)), ' ')"
DUCKDB_TOKENS = "array_to_string(list_slice(regexp_extract_all(lower(d.text), '[a-z]+'), 1, 10 + (d.doc_id * 13) % 31), ' ')"
FULL = "SELECT *, concat_ws(' ', tag_string_general, tag_string_character, tag_string_artist) AS tag_string FROM ({view}) v"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a lazy plan; Catalyst prunes what a query does not read."""
    frames = {"documents": table(spark, sf_dir, "documents"), "labels": table(spark, sf_dir, "labels")}
    view = VIEW.format(tokens=SPARK_TOKENS).replace("FROM documents d LEFT JOIN labels l", "FROM {documents} d LEFT JOIN {labels} l")
    return spark.sql(FULL.format(view=view), **frames)


def posts_sql() -> str:
    """The view for DuckDB, as a common table expression named posts."""
    return f"posts AS MATERIALIZED ({FULL.format(view=VIEW.format(tokens=DUCKDB_TOKENS))})"


def hash_key(seed: str, *cols):
    """A number in [0, 1) from md5, the same in every engine: 13 hex digits."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols], F.lit(seed))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def hash_key_sql(seed: str, *cols: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"(CAST('0x' || substr(md5(concat_ws(':', {parts}, '{seed}')), 1, 13) AS BIGINT) / 4503599627370496.0)"
