"""Scans: posts, scores, earlier knowledge, labels, tag lists, and trees of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, tags

#: Columns of a posts table that no operator reads.
UNREAD = ("source", "up_score", "down_score", "last_commented_at", "last_comment_bumped_at", "last_noted_at", "uploader_id", "approver_id", "pixiv_id", "bit_flags")
#: Rows that one counted parquet unit stands for.
UNIT = 100_000
KNOWLEDGE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("id", "parent_id", "image_width", "image_height")]
    + [T.StructField(n, T.DoubleType()) for n in ("score", "fav_count")]
    + [T.StructField(n, T.BooleanType()) for n in ("is_deleted", "is_banned")]
    + [T.StructField(n, T.StringType()) for n in ("created_at", "source", "md5", "rating", "tag_string", "file_ext", "file_url", "large_file_url", "preview_file_url", "tag_string_general", "tag_string_character", "tag_string_copyright", "tag_string_artist")]
)
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp", "bmp", "gif", "avif")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns that df has, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet or CSV by suffix; an empty table of the schema where nothing is there."""
    if not path.endswith((".csv", ".parquet", ".json")):
        raise ValueError(f"unknown format: {path}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema or T.StructType([]))
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".json"):
        return spark.read.json(path, schema=schema)
    return spark.read.csv(path, header=True, schema=schema, inferSchema=schema is None, multiLine=True, escape='"')


def with_scores(posts: DataFrame, scores: DataFrame | None) -> DataFrame:
    """posts with aes_score of a table (id, score); posts without a score stay."""
    if scores is None:
        return posts
    return posts.drop("aes_score").join(scores.select("id", F.col("score").alias("aes_score")), "id", "left")


def scan_posts(spark: SparkSession, path: str, scores: DataFrame | None = None, units: int | None = None) -> DataFrame:
    """Posts without the columns nobody reads; units caps the rows, lowest ids first, so a cap is the same every time."""
    posts = spark.read.parquet(path).drop(*UNREAD)
    posts = with_scores(posts, scores)
    return posts if units is None else posts.orderBy("id").limit(units * UNIT)


def scan_knowledge(spark: SparkSession, path: str, scores: DataFrame | None = None) -> DataFrame:
    """Earlier knowledge, one row per id (the best duplicate), missing metrics filled with the mean."""
    from ..operators.relational import best_duplicate

    rows = with_scores(read_any(spark, path, KNOWLEDGE), scores)
    rows = best_duplicate(rows) if {"tag_string", "score", "fav_count"} <= set(rows.columns) else rows.dropDuplicates(["id"])
    filled = [c for c in ("aes_score", "fav_count") if c in rows.columns]
    means = rows.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in filled])
    return rows.crossJoin(F.broadcast(means)).withColumns({c: F.coalesce(c, f"mean_{c}") for c in filled}).drop(*means.columns) if filled else rows


def labels_of_json(spark: SparkSession, path: str) -> DataFrame:
    """(relative_path, id, label) of a JSON object {path: number}."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,int>")).alias("relative_path", "number"))
    names = F.create_map(*[F.lit(x) for name, n in fixed.TIER_NUMBER.items() for x in (n, name)])
    return rows.select("relative_path", tags.id_of_path(F.col("relative_path")).alias("id"), F.try_element_at(names, "number").alias("label"))


def tag_lists(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct raw tags of text files with one readable tag per line."""
    return spark.read.text(list(paths)).select(tags.raw_tag(F.trim("value")).alias("tag")).filter("tag != ''").distinct()


def xlsx_column(path: str, name: str = "character_tag") -> list[str]:
    """One column of a workbook's first sheet, read on the driver: such lists are short and have no Spark source."""
    import re
    import xml.etree.ElementTree as ET
    import zipfile

    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        sheet = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        rows = []
        for row in ET.fromstring(z.read(sheet)).iter(f"{ns}row"):
            cells = {}
            for c in row.iter(f"{ns}c"):
                v = c.find(f"{ns}v")
                value = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else (shared[int(v.text)] if c.get("t") == "s" else v.text) if v is not None else None
                cells[re.match(r"[A-Z]+", c.get("r"))[0]] = value
            rows.append(cells)
    column = next((k for k, v in rows[0].items() if v == name), None) if rows else None
    return [r[column] for r in rows[1:] if column and r.get(column)]


def files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """(path, name, id, suffix, length, relative) of the files under root with one of the suffixes; contents stay unread."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(root)
    base = str(root).removeprefix("file://").rstrip("/")
    relative = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + base.replace(".", r"\.") + "/", "")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return rows.select("path", name.alias("name"), tags.id_of_path(F.col("path")).alias("id"), F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("suffix"), "length", relative.alias("relative"))


def scanned(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """files(), but those directly in the root are left out where it has any folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(root)
    folders = [s for s in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where) if s.isDirectory()]
    found = files(spark, root, suffixes)
    return found.filter(F.contains("relative", F.lit("/"))) if folders else found


def sized(spark: SparkSession, root: str, sidecars: DataFrame) -> DataFrame:
    """(id, path, width, height) of the images that can be opened and have a sidecar that is not empty."""
    decoded = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
    images = decoded.select(F.col("image.origin").alias("path"), "image.width", "image.height").withColumn("id", tags.id_of_path(F.col("path")))
    return images.join(sidecars.filter("length > 0 and id >= 0").select("id").distinct(), "id", "left_semi").select("id", "path", "width", "height")


def token_prompts(sidecars: DataFrame) -> DataFrame:
    """(id, prefix_tokens, general_tokens, suffix_tokens, tag_weight) of JSON sidecars (id, text); weight 1 and empty lists
    where a member, or the whole text, cannot be read."""
    lists = ("prefix_tokens", "general_tokens", "suffix_tokens")
    rows = sidecars.select("id", F.from_json("text", ", ".join(f"{c} array<int>" for c in lists) + ", tag_weight double").alias("j"))
    return rows.select("id", *[F.coalesce(f"j.{c}", F.array().cast("array<int>")).alias(c) for c in lists], F.coalesce("j.tag_weight", F.lit(1.0)).alias("tag_weight"))


def path_by_id(found: DataFrame) -> DataFrame:
    """(id, path): one path per integer name, the last by name."""
    return found.filter("id >= 0").groupBy("id").agg(F.max("path").alias("path"))


def with_sidecars(images: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Images whose text file of the same id is there and not empty."""
    texts = sidecars.filter("length > 0").select("id", F.col("path").alias("sidecar"))
    return images.filter("id >= 0").join(path_by_id(texts.withColumnRenamed("sidecar", "path")).withColumnRenamed("path", "sidecar"), "id")


def resolved(found: DataFrame) -> DataFrame:
    """One image per path without suffix; an .avif stands in where no other format is there."""
    stem = F.regexp_replace("path", r"\.[^./]*$", "")
    return found.groupBy(stem.alias("stem")).agg(F.min(F.struct((F.col("suffix") == "avif").alias("late"), "path")).alias("best")).select("stem", F.col("best.path").alias("path"))


def decoded_text(content):
    """Text of a binary column: UTF-16 where a byte-order mark says so, else UTF-8."""
    mark = F.hex(F.substring(content, 1, 2))
    return F.when(mark.isin("FFFE", "FEFF"), F.decode(content, "UTF-16")).otherwise(F.decode(content, "UTF-8"))


def cut_long_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV's lines with no more fields than its header, as text; quotes are not read."""
    lines = spark.read.text(path)
    header = lines.first()
    width = len(header[0].split(",")) if header else 0
    return lines.select(F.array_join(F.slice(F.split("value", ",", -1), 1, width), ",").alias("value")) if width else lines
