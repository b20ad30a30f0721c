"""Incremental ingestion: per-tag cutoffs with an overlap window, logs of finished work, append-only outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def fetched(pages: DataFrame, newest: DataFrame, days: int = 7) -> DataFrame:
    """Rows (tag, id, created_at) that a run takes: newer than the tag's newest known id, and those of the `days` before
    that id's own date, for late edits. Tags without a known id are taken whole."""
    known = pages.join(newest.select("tag", F.col("newest_id").alias("_stop")), "tag", "left")
    stop = known.filter(F.col("id") <= F.col("_stop")).groupBy("tag").agg(F.max_by("created_at", "id").alias("_seen"))
    cut = known.join(stop, "tag", "left")
    late = F.col("created_at") >= F.col("_seen") - F.make_dt_interval(F.lit(days))
    return cut.filter(F.col("_stop").isNull() | F.col("_seen").isNull() | (F.col("id") > F.col("_stop")) | late).drop("_stop", "_seen")


def remaining(wanted: DataFrame, done: DataFrame, key: str = "tag") -> DataFrame:
    """What a log of finished work does not name yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def carried_over(wanted: DataFrame, done: DataFrame, old_paths: DataFrame, tiers: DataFrame, folder: str) -> DataFrame:
    """(id, tier, relative_path) of wanted ids that an earlier run holds; unknown tiers are bad_score."""
    rows = remaining(wanted, done, "id").join(old_paths.select("id", "path"), "id").join(tiers.select("id", F.col("final_tier").alias("tier")), "id", "left")
    return rows.select("id", F.coalesce("tier", F.lit("bad_score")).alias("tier"), F.concat_ws("/", F.lit(folder), F.regexp_extract("path", r"([^/]*)$", 1)).alias("relative_path"))


def redownload(upsampled: DataFrame, on_disk: DataFrame, tiers: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing ids with their tier, the exclusion list without them); unknown tiers are good_score."""
    missing = remaining(upsampled.select("id").distinct(), on_disk, "id").join(tiers.select("id", "final_tier"), "id", "left").withColumn("final_tier", F.coalesce("final_tier", F.lit("good_score")))
    return missing, remaining(excluded, missing, "id")


def move_plan(files: DataFrame, tiers: DataFrame, numbers: dict[str, int], characters: list[str] | None = None) -> DataFrame:
    """(id, src, dst) of files whose folder is not their tier's number; unknown tiers count as 1.

    Tier folders stand at the root, or in a wanted character's folder at the root where the file's tier folder stood in a
    folder of that name; other folders above are given up.
    """
    table = F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv])
    rows = files.join(tiers.select("id", "final_tier"), "id")
    name, parent, above = F.regexp_extract("relative", r"([^/]*)$", 1), F.regexp_extract("relative", r"^(.*)/[^/]*$", 1), F.regexp_extract("relative", r"([^/]+)/[^/]+/[^/]*$", 1)
    number = F.coalesce(F.try_element_at(table, F.col("final_tier")), F.lit(1)).cast("string")
    kept = F.when(above.isin(*characters), above) if characters else F.lit(None).cast("string")
    folder = F.concat_ws("/", kept, number)
    return rows.filter(parent != folder).select("id", F.col("relative").alias("src"), F.concat_ws("/", folder, name).alias("dst"))


def companions(plan: DataFrame, suffixes: tuple[str, ...] = (".txt", ".json", ".tmp")) -> DataFrame:
    """(id, src, dst) of the files that stand beside the plan's files under another suffix; whoever moves skips missing ones."""
    plain = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    each = plan.select("id", plain("src").alias("src"), plain("dst").alias("dst"), F.explode(F.array(*[F.lit(s) for s in suffixes])).alias("suffix"))
    return each.select("id", F.concat("src", "suffix").alias("src"), F.concat("dst", "suffix").alias("dst"))


def with_paths(sampled: DataFrame, files: DataFrame) -> DataFrame:
    """sampled with the relative path of each id's file as it is now, null where there is none; the last of several by name."""
    now = files.filter("id >= 0").groupBy("id").agg(F.max("relative").alias("relative_path"))
    return sampled.drop("relative_path").join(now, "id", "left")


CURATED = ("jpg", "jpeg", "png", "gif", "webp")


def curated_ids(files: DataFrame) -> DataFrame:
    """(stem) of a curated folder's images, by name; files: (relative, suffix) as sources.tables.files gives."""
    return files.filter(F.col("suffix").isin(*CURATED) & ~F.contains("relative", F.lit("/"))).select(F.regexp_replace("relative", r"\.[^./]*$", "").alias("stem")).orderBy("stem")


def restore_plan(files: DataFrame, stems: DataFrame, folder: str = "cleaned") -> tuple[DataFrame, DataFrame]:
    """((stem, src, dst) copies of the listed images and of the texts beside them into the folder; (stem) of missing ones).

    Files that are in a folder of that name already are no sources; of several images of one stem the last by path wins.
    """
    stem = F.regexp_replace(F.regexp_extract("relative", r"([^/]*)$", 1), r"\.[^./]*$", "")
    images = files.filter(F.col("suffix").isin(*CURATED) & ~F.array_contains(F.split("relative", "/"), folder)).groupBy(stem.alias("stem")).agg(F.max("relative").alias("src"))
    wanted = stems.select(F.trim("stem").alias("stem")).filter("stem != ''").distinct()
    found = wanted.join(images, "stem")
    each = found.select("stem", F.explode(F.array("src", F.concat(F.regexp_replace("src", r"\.[^./]*$", ""), F.lit(".txt")))).alias("src"))
    return each.select("stem", "src", F.concat_ws("/", F.lit(folder), F.regexp_extract("src", r"([^/]*)$", 1)).alias("dst")), wanted.join(images, "stem", "left_anti")


class PagedSource(DataSource):
    """Pages of posts by tag through an injected fetch(tag, page) -> list of rows, with retries; one partition per tag.

    A tag whose pages stop with errors ends with a row of null id that holds the error, so it is not taken for finished.
    """

    fetch: Callable[[str, int], list[tuple]] | None = None

    @classmethod
    def name(cls) -> str:
        return "paged_posts"

    def schema(self) -> str:
        return "tag string, id long, created_at string, payload string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(self.options, type(self).fetch)


class _PagedReader(DataSourceReader):
    def __init__(self, options, fetch):
        self.tags, self.attempts, self.wait, self.fetch = options["tags"].split(","), int(options.get("attempts", "3")), float(options.get("wait", "1")), fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(t) for t in self.tags]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import time

        page = 1
        while True:
            for attempt in range(self.attempts):
                try:
                    rows = self.fetch(partition.value, page)
                    break
                except OSError as e:
                    if attempt + 1 == self.attempts:
                        yield (partition.value, None, None, f"failed: {e}")
                        return
                    time.sleep(self.wait * 2**attempt)
            if not rows:
                return
            yield from ((partition.value, *r) for r in rows)
            page += 1
