"""Writers: CSV reports, atomic rewrites, sidecars, moves and downloads on executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def _beside(spark: SparkSession, path: str):
    jvm, plain = spark.sparkContext._jvm, path.rstrip("/")
    now, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (plain, f"{plain}.new", f"{plain}.old"))
    return now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), now, new, old


def recover(spark: SparkSession, path: str) -> None:
    """Undo a rewrite that was stopped between its two renames."""
    fs, now, _, old = _beside(spark, path)
    if fs.exists(old) and not fs.exists(now) and not fs.rename(old, now):
        raise OSError(f"cannot rename {old} to {now}")


def rewrite(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace a table that df may itself read: written beside it, then both are renamed, then the old one is deleted.

    At every moment one whole table is there; recover() finds it after a crash.
    """
    spark = df.sparkSession
    fs, now, new, old = _beside(spark, path)
    df.write.mode("overwrite").partitionBy(*(by or [])).parquet(new.toString())
    if fs.exists(now):
        fs.delete(old, True)
        if not fs.rename(now, old):
            raise OSError(f"cannot rename {now} to {old}")
    if not fs.rename(new, now):
        raise OSError(f"cannot rename {new} to {now}")
    fs.delete(old, True)


def token_json(df: DataFrame) -> DataFrame:
    """(id, json) of prefix, general and suffix token ids and, where there is one, the tag weight."""
    fields = [c for c in ("prefix_tokens", "general_tokens", "suffix_tokens", "tag_weight") if c in df.columns]
    return df.select("id", F.to_json(F.struct(*fields)).alias("json"))


def with_weight(tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """tokens (id, json) with the member tag_weight set from weights (id, weight), all other members as they are; rows
    without a weight, or whose text is no JSON object, stay as they are."""
    rows = tokens.join(weights.select("id", F.col("weight").cast("float").alias("_w")), "id", "left")
    members = F.map_filter(F.from_json("json", "map<string,variant>"), lambda k, v: k != "tag_weight")
    new = F.to_json(F.map_concat(members, F.create_map(F.lit("tag_weight"), F.col("_w").cast("variant"))))
    return rows.select("id", F.when(F.col("_w").isNotNull(), F.coalesce(new, "json")).otherwise(F.col("json")).alias("json"))


def applied(rows: DataFrame, act: Callable[[dict], str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """rows (id, ...) with the outcome of act on each, on executors, tried again with growing waits: moves, sidecars,
    downloads. act must be safe to repeat, since a lost task runs again."""
    import time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, done = [], []
            for row in b.to_pylist():
                outcome = ""
                for attempt in range(attempts):
                    try:
                        outcome = act(row)
                        break
                    except OSError as e:
                        outcome = f"failed: {e}"
                        if attempt + 1 < attempts:
                            time.sleep(wait * 2**attempt)
                ids.append(row["id"])
                done.append(outcome)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(done, pa.string())], ["id", "outcome"])

    return rows.mapInArrow(run, "id long, outcome string")


def sidecar_writer(root: str) -> Callable[[dict], str]:
    """An act for applied(): a row's prompt and JSON beside its image, each by a rename, so a repeated task does no harm.

    Rows hold id, relative (the image's path below root), and prompt, json or both; root is a folder all executors share.
    """

    def act(row: dict) -> str:
        import os

        plain = os.path.join(root, os.path.splitext(row["relative"])[0])
        done = []
        for column, suffix in (("prompt", ".txt"), ("json", ".json")):
            if row.get(column) is None:
                continue
            part = f"{plain}{suffix}.{os.getpid()}.part"
            with open(part, "w", encoding="utf-8") as f:
                f.write(row[column])
            os.replace(part, plain + suffix)
            done.append(suffix)
        return " ".join(done)

    return act


def complete(listed: DataFrame, images: DataFrame, texts: DataFrame, jsons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that have image, text and json; ids of images without a prompt)."""
    with_image = listed.join(images.select("id").distinct(), "id", "left_semi")
    full = with_image.join(texts.select("id").distinct(), "id", "left_semi").join(jsons.select("id").distinct(), "id", "left_semi")
    return full, with_image.join(full.select("id"), "id", "left_anti").select("id")
