"""The curation run by stages. Each stage reads and writes tables of one folder, so stages can run one by one.

Model, tokenizer, download and page-fetch steps call functions named in the config as "module:function"; a stage whose
function is not named says so.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, tags
from ..operators import buckets, counts, incremental, models, prompts, relational, sampling, similarity, sinks, tiering
from ..sources import tables
from ..sources.posts import hash_key


@dataclass
class Config:
    work: str
    posts: str
    scores: str | None = None
    images: str | None = None
    artists: list[str] = field(default_factory=list)
    characters: list[str] = field(default_factory=list)
    total: int = 1_000_000
    qualities: dict[str, float] = field(default_factory=lambda: {"masterpiece": 0.2, "good_score": 0.4, "bad_score": 0.3, "worse_score": 0.1})
    ratings: dict[str, float] = field(default_factory=lambda: {"g": 0.2, "s": 0.35, "q": 0.3, "e": 0.15})
    include: dict[str, float] = field(default_factory=dict)
    skip: dict[str, float] = field(default_factory=dict)
    seed: str = "46"
    distance: int = 5
    per_shard: int = 24_000
    functions: dict[str, str] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)
    sidecars: bool = False
    categories: list[int] = field(default_factory=list)

    @classmethod
    def read(cls, path: str) -> Config:
        with open(path) as f:
            text = f.read()
        try:
            import yaml

            return cls(**yaml.safe_load(text))
        except ImportError:
            import json

            return cls(**json.loads(text))


class Run:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config

    def path(self, name: str) -> str:
        return f"{self.config.work.rstrip('/')}/{name}.parquet"

    def table(self, name: str, schema: str = "id long") -> DataFrame:
        from pyspark.sql.types import _parse_datatype_string

        sinks.recover(self.spark, self.path(name))
        return tables.read_any(self.spark, self.path(name), _parse_datatype_string(schema))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        sinks.rewrite(df, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def report(self, df: DataFrame, name: str) -> DataFrame:
        """A table that is given as CSV as well."""
        out = self.write(df, name)
        sinks.write_csv(out, f"{self.config.work.rstrip('/')}/{name}.csv", "overwrite")
        return out

    def function(self, name: str) -> Callable[..., Any]:
        where = self.config.functions.get(name)
        if not where:
            raise LookupError(f"functions.{name} is not set: this stage needs a function of the caller's, as module:function")
        module, _, attribute = where.partition(":")
        return getattr(importlib.import_module(module), attribute)

    def posts(self) -> DataFrame:
        scores = tables.read_any(self.spark, self.config.scores) if self.config.scores else None
        return tables.scan_posts(self.spark, self.config.posts, scores)

    def u(self, name: str):
        return hash_key(f"{self.config.seed}:{name}", "id")

    # Stages

    def generate_data(self) -> DataFrame:
        """Fetch what is new for each wanted tag and put it over earlier knowledge."""
        wanted = self.spark.createDataFrame([(t,) for t in self.config.artists + self.config.characters], "tag string")
        todo = incremental.remaining(wanted, self.table("finished_tags", "tag string"))
        incremental.PagedSource.fetch = staticmethod(self.function("fetch"))
        self.spark.dataSource.register(incremental.PagedSource)
        names = [r.tag for r in todo.collect()]  # the config's own list, no data
        pages = self.spark.read.format("paged_posts").option("tags", ",".join(names)).load()
        pages = self.write(pages, "fetched_pages")
        failed = pages.filter("id is null").select("tag").distinct()
        rows = pages.filter("id is not null").select("tag", "id", F.to_timestamp("created_at").alias("at"), F.from_json("payload", tables.KNOWLEDGE).alias("p"))
        old = self.table("knowledge", tables.KNOWLEDGE.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
        taken = incremental.fetched(rows.withColumnRenamed("at", "created_at"), relational.newest_ids(old, wanted))
        new = relational.best_duplicate(taken.select("p.*").filter("id is not null"))
        out = self.write(relational.upsert(old, new), "knowledge")
        self.write(similarity.union_all(self.table("finished_tags", "tag string"), incremental.remaining(todo, failed)).distinct(), "finished_tags")
        return out

    def analyze(self) -> DataFrame:
        rows = self.posts()
        per = self.report(counts.tag_counts(rows).select("category", "tag", "count"), "tag_counts")
        for name, df in (
            ("rating_share", counts.shares(rows, "rating")), ("score_summary", counts.describe(rows, "score")), ("rare_tags", counts.rare_shares(per, (200,))), ("tag_clusters", counts.clusters(per.filter("category = 'general'"))),
            ("persons", counts.persons(rows)), ("months", counts.by_month(rows, F.try_to_timestamp("created_at"))), ("prompt_lengths", counts.length_stats(rows, prompts.words_and_commas(tags.prompt_of(F.col("tag_string"))))),
        ):
            self.write(df, name)
        return per

    def sample(self) -> DataFrame:
        c, rows = self.config, self.posts()
        prior = self.table("knowledge", "")
        prior = rows.join(prior.select("id"), "id", "left_semi") if "id" in prior.columns else rows.limit(0)
        return self.report(sampling.sample_posts(rows, prior, self.table("excluded"), c.total, c.qualities, c.ratings, c.include, self.u, c.artists, c.characters, c.skip), "sampled")

    def sample_faces(self) -> DataFrame:
        return self.write(relational.face_filter(self.posts(), fixed.FACE_META), "faces")

    def download(self) -> DataFrame:
        """Outcome of fetching each sampled post that is not on disk; what fails is excluded from now on."""
        sampled, there = self.table("sampled"), self.images().select("id")
        rows = relational.download_choice(incremental.remaining(sampled, there, "id"))
        done = self.write(sinks.applied(rows, self.function("download")), "downloads")
        self.write(similarity.union_all(self.table("excluded"), done.filter(F.startswith("outcome", F.lit("failed"))).select("id")).distinct(), "excluded")
        return done

    def images(self) -> DataFrame:
        return tables.files(self.spark, self.config.images or self.config.work)

    def deduplicate(self) -> DataFrame:
        """Posts to exclude: all but the survivors of each near-duplicate group."""
        pictures = self.spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(self.config.images)
        hashes = self.write(models.phash(pictures.select(tags.id_of_path(F.col("image.origin")).alias("id"), "image").filter("id >= 0")), "hashes")
        groups = similarity.near_groups(hashes, self.config.distance)
        tier = tags.number_of(F.col("quality_tier"), fixed.TIER_NUMBER)
        facts = self.table("sampled").select("id", tier.alias("tier")).join(self.posts().select("id", F.size(tags.split_tags(F.col("tag_string"))).alias("tags"), "score", "fav_count"), "id", "left")
        members = groups.join(facts, "id", "left")
        gone = incremental.remaining(members.select("id"), similarity.survivors(members), "id")
        return self.report(similarity.union_all(self.table("excluded"), gone).distinct(), "excluded")

    def classify(self) -> DataFrame:
        scores = models.scored(self.images().filter("id >= 0"), self.function("classify"), "path")
        return self.write(scores.select("id", models.best_label(F.col("scores")).alias("aesthetic_label")), "labels")

    def upsample(self) -> DataFrame:
        scores = models.scored(self.images().filter("id >= 0"), self.function("tag"), "path")
        return self.write(models.upsampled(self.posts(), scores, self.config.names, self.config.categories), "upsampled")

    def unified(self) -> DataFrame:
        """Labels and upsampled tags from one pass: the function gives class scores first, then tag scores."""
        scores = self.write(models.scored(self.images().filter("id >= 0"), self.function("both"), "path"), "both_scores")
        n = len(fixed.LABEL_NUMBER)
        self.write(scores.select("id", models.best_label(F.slice("scores", 1, n)).alias("aesthetic_label")), "labels")
        rest = scores.select("id", F.slice("scores", F.lit(n + 1), F.greatest(F.size("scores") - n, F.lit(0))).alias("scores"))
        return self.write(models.upsampled(self.posts(), rest, self.config.names, self.config.categories), "upsampled")

    def generate_prompts(self) -> DataFrame:
        labels, more = self.table("labels", "id long, aesthetic_label string"), self.table("upsampled", "id long, upsampled_tags string")
        rows = self.posts().join(self.table("sampled").select("id", "quality_tier"), "id").join(labels, "id", "left").join(more, "id", "left")
        rows = rows.withColumn("final_tier", tiering.final_tier(F.col("quality_tier"), F.coalesce("aesthetic_label", F.lit(""))))
        self.report(rows.select("id", "final_tier"), "final_tiers")
        # A tokenizer of the caller's, from a text column to token ids, adds the ids that shards keep.
        encode = self.function("tokenize") if "tokenize" in self.config.functions else None
        out = prompts.prompts(rows, self.u("synonym"), None if encode else prompts.words_and_commas, encode=encode)
        out = self.write(out.select("id", "prompt", "final_tier", *[c for c in out.columns if c.endswith("_tokens")]), "prompts")
        if self.config.sidecars:
            at = self.images().filter("id >= 0").groupBy("id").agg(F.max("relative").alias("relative"))
            rows = out.join(at, "id")
            rows = rows.join(sinks.token_json(out), "id") if encode else rows
            self.write(sinks.applied(rows, sinks.sidecar_writer(str(self.config.images).removeprefix("file://"))), "sidecars")
        return out

    def tag_weights(self) -> DataFrame:
        rows = self.table("prompts", "id long, prompt string")
        weights = counts.tag_weights(counts.tag_counts(self.posts().join(rows.select("id"), "id", "left_semi")))
        artists, characters = (self.spark.createDataFrame([(t,) for t in ts], "tag string") for ts in (self.config.artists, self.config.characters))
        return self.write(counts.caption_weights(rows.select("id", F.col("prompt").alias("caption")), weights, artists, characters), "weights")

    def encode(self, name: str = "shards", encoder: bool = False) -> DataFrame:
        """Rows in buckets, length tiers and shards, with weights; with encoder, the caller's function adds values."""
        rows = self.table("prompts", "id long, prompt string, final_tier string").join(self.posts().select("id", "image_width", "image_height"), "id").join(self.table("weights", "id long, weight double"), "id", "left")
        n_rows = rows.count()
        rows = buckets.assigned(rows, buckets.bucket_sizes()).withColumn("tier", buckets.prompt_tier(F.col("prompt"))).withColumn("aesthetic_tier", tags.number_of(F.col("final_tier"), fixed.TIER_NUMBER))
        numbered = buckets.sharded(buckets.crowded(rows), self.config.per_shard)
        if encoder:
            numbered = numbered.join(models.scored(self.images().filter("id >= 0"), self.function("encode"), "path"), "id")
        buckets.write_shards(numbered, f"{self.config.work}/{name}", self.config.per_shard)
        self.write(buckets.sample_mapping(numbered), f"{name}_mapping")
        self.write(buckets.dataset_info(numbered, n_rows, self.config.per_shard), f"{name}_info")
        return self.write(buckets.metadata(numbered), f"{name}_metadata")

    def encode_weights(self, name: str = "shards", update_all: bool = True) -> DataFrame:
        """Weights of the prompts into the rows of shards that are there."""
        path = f"{self.config.work}/{name}"
        sinks.recover(self.spark, path)
        sinks.rewrite(buckets.reweighted(self.spark.read.parquet(path), self.table("weights", "id long, weight double"), update_all), path, ["bucket", "tier"])
        return self.spark.read.parquet(path)

    def export(self) -> DataFrame:
        """Images and prompts in the fixed export schema, in a seeded order."""
        rows = self.table("prompts", "id long, prompt string, final_tier string").join(self.posts().select("id", "image_width", "image_height"), "id").join(self.table("weights", "id long, weight double"), "id", "left")
        rows = buckets.crowded(buckets.assigned(rows, buckets.bucket_sizes()).withColumn("tier", buckets.prompt_tier(F.col("prompt"))))
        content = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.config.images).select(tags.id_of_path(F.col("path")).alias("id"), F.col("content").alias("image")).filter("id >= 0")
        return self.write(buckets.export_rows(rows.join(content, "id")).repartitionByRange(F.xxhash64(F.lit(self.config.seed), "booru_id")).sortWithinPartitions(F.xxhash64(F.lit(self.config.seed), "booru_id")), "export")

    def sync_tiers(self) -> DataFrame:
        """Moves of files to their tier's folder, applied by the caller's function."""
        plan = incremental.move_plan(self.images().filter("id >= 0"), self.table("final_tiers", "id long, final_tier string"), fixed.TIER_NUMBER, self.config.characters)
        plan = self.write(similarity.union_all(plan, incremental.companions(plan)), "moves")
        out = self.write(sinks.applied(plan, self.function("move")), "moved")
        if "id" in (sampled := self.table("sampled", "")).columns:
            self.report(incremental.with_paths(sampled, self.images()), "sampled")
        return out

    def prepare_hq(self) -> DataFrame:
        """Posts that have image, text and token file; the ids without a prompt go to missing_prompts."""
        root = self.config.images or self.config.work
        full, missing = sinks.complete(self.images().filter("id >= 0"), self.images(), tables.files(self.spark, root, ("txt",)), tables.files(self.spark, root, ("json",)))
        self.write(missing, "missing_prompts")
        return self.write(full, "hq")

    def crop_faces(self) -> DataFrame:
        """Face crops by the caller's detector, which gives x0, y0, x1, y1 of the surest face."""
        boxes = models.scored(self.images().filter("id >= 0"), self.function("detect"), "path")
        box = F.struct(*[F.element_at("scores", i + 1).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
        rows = self.posts().join(boxes, "id").withColumn("crop", models.face_crop(F.col("image_width"), F.col("image_height"), box)).filter("crop is not null")
        return self.write(rows.select("id", "crop").join(prompts.face_prompt(self.posts(), self.config.artists), "id"), "face_crops")
