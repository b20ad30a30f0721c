"""Prompt text from a post's tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, tags, tokens

Count = Callable[[Column], Column]


def words_and_commas(prompt: Column) -> Column:
    """Length of a prompt where no tokenizer is given."""
    return F.regexp_count(prompt, F.lit(r"[^\s,]+|,"))


def joined(*parts: Column) -> Column:
    """Parts that are not empty, joined by commas."""
    return F.concat_ws(", ", *[F.nullif(tags.text(p), F.lit("")) for p in parts])


def aesthetic(tier: Column, meta: Column, draw: Column | None = None) -> Column:
    """The tier in words, by draw (a number in [0, 1)) with a synonym, and the meta tags that count, by name."""
    words = tags.prompt_of(tier)
    if draw is not None:
        chosen = F.lit(None).cast("string")
        for name, options in fixed.QUALITY_SYNONYMS.items():
            first = F.element_at(F.array(*[F.lit(o) for o in options[:-1]]), (F.floor(draw * 2 * (len(options) - 1)) % (len(options) - 1) + 1).cast("int"))
            chosen = F.when(words == name, F.concat_ws(", ", words, first, F.lit(options[-1]))).otherwise(chosen)
        words = F.when(draw < 0.5, F.coalesce(chosen, words)).otherwise(words)
    readable = tags.prompt_of(meta)
    there = F.filter(F.array(*[F.lit(t) for t in fixed.META_TAGS]), lambda t: F.contains(readable, F.replace(t, F.lit("_"), F.lit(" "))))
    return F.concat_ws(", ", words, F.nullif(F.array_join(there, ", "), F.lit("")))


def prompts(posts: DataFrame, draw: Column | None = None, count: Count | None = None, general_last: bool = False, budget: int = 225, encode: Count | None = None) -> DataFrame:
    """posts with a prompt. With count, a length function, upsampled tags only fill what the budget leaves: the rest of
    prefix with its comma, suffix, and general tags without two commas.

    encode gives a text's token ids with a mark before and behind it; with it, ids are counted where count is missing, and
    prefix_tokens (no mark behind), general_tokens (no marks) and suffix_tokens (no mark before) are given as well.
    """
    if encode is not None and count is None:
        count = lambda c: F.size(encode(c)) - 2
    column = lambda name: F.col(name) if name in posts.columns else F.lit("")
    people = F.array_join(tags.person_tags(F.col("tag_string_general")), ", ")
    general = tags.prompt_of(tags.without_person_tags(F.col("tag_string_general")))
    rating = F.try_element_at(F.create_map(*[F.lit(x) for kv in fixed.RATINGS.items() for x in kv]), tags.text(column("rating")))
    prefix = joined(people, tags.prompt_of(column("tag_string_character")), tags.prompt_of(column("tag_string_copyright")), rating)
    year = tags.year_phrase(column("year").cast("int") if "year" in posts.columns else tags.year_of(column("created_at")))
    suffix = joined(tags.prompt_of(column("tag_string_artist")), aesthetic(column("final_tier"), column("tag_string_meta"), draw), year)
    more = tags.text(column("upsampled_tags"))
    if count is not None:
        free = F.lit(budget) - count(F.concat(prefix, F.lit(", "))) - count(suffix) - (count(general) - 2)
        parts = tags.comma_parts(more)
        some = F.array_join(tokens.leading_tags(parts, F.transform(parts, count), free), ", ")
        more = F.when(count(more) < free, more).when(free > 0, some).otherwise("")
    order = (prefix, suffix, general, more) if general_last else (prefix, general, more, suffix)
    out = posts.withColumn("prompt", joined(*order))
    if encode is None:
        return out
    first, middle, last = (encode(c) for c in (F.concat(prefix, F.lit(", ")), F.concat(general, F.lit(", "), more), suffix))
    return out.withColumns({"prefix_tokens": F.slice(first, F.lit(1), F.size(first) - 1), "general_tokens": F.slice(middle, F.lit(2), F.size(middle) - 2), "suffix_tokens": F.slice(last, F.lit(2), F.size(last) - 1)})


def own_prompts(images: DataFrame, sidecars: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """(id, prompt) of images: the text of the sidecar of the same id where it is not blank, else the post's tags as a
    prompt; images with neither are left out. sidecars: (id, text)."""
    texts = sidecars.filter(F.trim("text") != "").groupBy("id").agg(F.max("text").alias("text"))
    rows = images.select("id").distinct().join(texts, "id", "left")
    if posts is None:
        return rows.filter("text is not null").select("id", F.trim("text").alias("prompt"))
    rows = rows.join(posts.select("id", F.nullif(tags.prompt_of(F.col("tag_string")), F.lit("")).alias("_own")), "id", "left")
    return rows.select("id", F.coalesce(F.trim("text"), "_own").alias("prompt")).filter("prompt is not null")


def face_prompt(posts: DataFrame, artists: list[str]) -> DataFrame:
    """(id, prompt) of face crops: gender, characters, copyrights, allowed artists, rating."""
    general = tags.text(F.col("tag_string_general"))
    gender = F.when(general.rlike(r"\b1girl\b"), "1girl").when(general.rlike(r"\b1boy\b"), "1boy").otherwise("")
    rating = F.try_element_at(F.create_map(*[F.lit(x) for kv in fixed.RATINGS.items() for x in kv]), tags.text(F.col("rating")))
    allowed = tags.prompt_of(tags.only_allowed(F.col("tag_string_artist"), artists))
    return posts.select("id", joined(gender, tags.prompt_of(F.col("tag_string_character")), tags.prompt_of(F.col("tag_string_copyright")), allowed, rating).alias("prompt"))


def merged_upsampled(captions: DataFrame, least: int) -> DataFrame:
    """(id, prompt, short) of (id, caption, upsampled): upsampled tags not there yet and no rating words are appended;
    short keeps the tags that at least so many captions have."""
    own = tags.comma_parts(F.col("caption"))
    new = F.filter(tags.comma_parts(F.col("upsampled")), lambda t: ~F.array_contains(own, t) & ~t.isin(*fixed.RATINGS.values()))
    rows = captions.select("id", F.concat(own, new).alias("tags"))
    each = rows.select("id", F.posexplode("tags").alias("pos", "tag"))
    often = each.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("tag")
    short = each.join(often, "tag", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "tag"))).alias("x"))
    return rows.join(short, "id", "left").select("id", F.array_join("tags", ", ").alias("prompt"), F.coalesce(F.array_join("x.tag", ", "), F.lit("")).alias("short"))


def tags_after_years(prompt: Column, years: tuple[str, ...] = ("2023", "2024")) -> Column:
    """Tags of a prompt behind the first one that is such a year."""
    parts = tags.comma_parts(prompt)
    at = F.array_min(F.filter(F.array(*[F.nullif(F.array_position(parts, F.lit(y)), F.lit(0)) for y in years]), lambda x: x.isNotNull()))
    return F.when(at.isNotNull(), F.array_join(F.slice(parts, (at + 1).cast("int"), F.size(parts)), ", ")).otherwise("")
