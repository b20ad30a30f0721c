"""Column functions over tag strings, prompts, ids and dates; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

PERSON = r"\b\d+\+?(?:boy|girl)s?\b"


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def split_tags(c: Column) -> Column:
    """Tags parted at each single blank; an empty string has one empty tag, runs of blanks give empty tags."""
    return F.split(text(c), " ", -1)


def split_words(c: Column) -> Column:
    """Tags parted at any white space, without empty ones."""
    return F.filter(F.split(text(c), r"\s+", -1), lambda t: t != "")


def replaced(c: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def readable_tag(tag: Column) -> Column:
    """long_hair -> long hair, with brackets escaped."""
    return replaced(tag, ("_", " "), ("(", "\\("), (")", "\\)"))


def raw_tag(tag: Column) -> Column:
    """The inverse of readable_tag."""
    return replaced(tag, ("\\(", "("), ("\\)", ")"), (" ", "_"))


def prompt_of(tags: Column) -> Column:
    """Blank-separated tags as a readable comma list; null is empty."""
    return replaced(text(tags), ("(", "\\("), (")", "\\)"), (" ", ", "), ("_", " "))


def comma_parts(prompt: Column, empty: bool = False) -> Column:
    """Parts of a comma list, trimmed, without empty ones unless they are asked for."""
    parts = F.transform(F.split(text(prompt), ",", -1), lambda t: F.regexp_replace(t, r"^\s+|\s+$", ""))
    return parts if empty else F.filter(parts, lambda t: t != "")


def tags_of_prompt(prompt: Column, empty: bool = False) -> Column:
    """A readable comma list as blank-separated tags; null is empty. With its empty tags, the inverse of prompt_of."""
    return F.array_join(F.transform(comma_parts(prompt, empty), raw_tag), " ")


def sanitized(prompt: Column) -> Column:
    """A comma list without empty parts and doubled white space."""
    return F.array_join(F.transform(comma_parts(prompt), lambda t: F.regexp_replace(t, r"\s+", " ")), ", ")


def person_tags(general: Column) -> Column:
    """Tags that count persons, else solo if it is there, else none."""
    found = F.regexp_extract_all(text(general), F.lit(f"({PERSON})"), F.lit(1))
    return F.when(F.size(found) > 0, found).when(F.array_contains(split_tags(general), "solo"), F.array(F.lit("solo"))).otherwise(F.array().cast("array<string>"))


def without_person_tags(general: Column) -> Column:
    """The tag string without its person tags, single blanks between the rest.

    A found tag acts as a pattern, so the plus of 6+girls repeats the 6 and the tag itself stays.
    """
    found = person_tags(general)
    pattern = F.concat(F.lit(r"\b("), F.array_join(found, "|"), F.lit(r")\b"))
    rest = F.regexp_replace(F.regexp_replace(text(general), pattern, F.lit("")), r"\s+", " ")
    return F.when(F.size(found) > 0, F.trim(rest)).otherwise(text(general))


def size_tag(width: Column, height: Column) -> Column:
    """lowres up to 500 x 500, highres from 1600 x 1200, nothing between or without sizes."""
    area = width.cast("long") * height.cast("long")
    return F.when(area <= 500 * 500, "lowres").when(area >= 1600 * 1200, "highres").otherwise("")


def year_of(created: Column) -> Column:
    """Leading year of a date string if it lies in 1900 to 2100."""
    year = F.regexp_extract(text(created), r"^(\d{4})", 1).try_cast("int")
    return F.when(year.between(1900, 2100), year)


def era_of(year: Column) -> Column:
    return F.when(year <= 2017, "oldest").when(year <= 2019, "old").when(year <= 2020, "modern").when(year <= 2022, "recent").when(year.isNotNull(), "newest")


def year_phrase(year: Column) -> Column:
    return F.when(year.isNull(), F.lit("")).otherwise(F.concat(era_of(year), F.lit(", year "), year.cast("string")))


def length_tier(length: Column, tiers: tuple[int, ...] = fixed.LENGTH_TIERS) -> Column:
    """The first tier that a length fits, the last for longer ones."""
    fit = F.array_min(F.filter(F.array(*[F.lit(t) for t in tiers]), lambda t: t >= length))
    return F.coalesce(fit, F.lit(max(tiers)))


def tag_count(tags: Column) -> Column:
    """Tags of a blank-separated string; an empty one has none."""
    return F.when(text(tags) == "", 0).otherwise(F.size(split_tags(tags)))


def id_of_path(path: Column) -> Column:
    """Integer name of a file without its suffix, -1 for other names."""
    name = F.regexp_extract(F.replace(text(path), F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)
    return F.coalesce(F.regexp_replace(name, r"\.[^.]*$", "").try_cast("bigint"), F.lit(-1))


def holds_any(tags: Column, wanted: list[str]) -> Column:
    """A whole tag of the string is among the wanted ones."""
    return F.arrays_overlap(split_words(tags), F.array(*[F.lit(w) for w in wanted])) if wanted else F.lit(False)


def holds_word(tags: Column, pattern: str) -> Column:
    """The pattern, a regular expression, occurs between word borders in any case; null holds none."""
    return F.coalesce(F.rlike(tags, F.lit(f"(?iU)\\b(?:{pattern})\\b")), F.lit(False))


def subfolder(tags: Column, folder: Column, characters: list[str]) -> Column:
    """Folder of a post's file: below its first wanted character's folder where it has one of their tags."""
    own = split_words(tags)
    first = F.coalesce(*[F.when(F.array_contains(own, c), F.lit(c)) for c in characters], F.lit(None).cast("string")) if characters else F.lit(None).cast("string")
    return F.concat_ws("/", first, folder.cast("string"))


def only_allowed(tags: Column, allowed: list[str]) -> Column:
    """The string's tags that are allowed, in order."""
    return F.array_join(F.filter(split_words(tags), lambda t: t.isin(allowed)), " ")


def contained(tags: Column, parts: tuple[str, ...]) -> Column:
    """How many of the parts occur anywhere in the lower-cased string, inside other tags too."""
    low = F.lower(text(tags))
    return sum((F.contains(low, F.lit(p.lower())).cast("int") for p in parts), F.lit(0))


def include_weight(tags: Column, weights: dict[str, float]) -> Column:
    """Product of the weights of the distinct tags; others weigh 1."""
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.aggregate(F.array_distinct(split_words(tags)), F.lit(1.0), lambda a, t: a * F.coalesce(F.try_element_at(table, t), F.lit(1.0)))


def number_of(name: Column, numbers: dict[str, int], unknown: int = -1) -> Column:
    """A tier's or label's number."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv]), text(name)), F.lit(unknown))


def combined(prompt: Column, new_tags: Column) -> Column:
    """New tags that a prompt takes up: not there yet, no second person count, no second kind of a thing it has.

    new_tags: an array of readable tags. A tag's kind is the last of its several words.
    """
    own = comma_parts(prompt)
    kind = lambda t: F.substring_index(t, " ", -1)
    kinds = F.transform(F.filter(own, lambda t: F.contains(t, F.lit(" "))), kind)
    counted = F.exists(own, lambda t: F.regexp_like(t, F.lit(r"^\d+\+?(?:boy|girl)s?\b")))
    fits = lambda t: ~F.array_contains(own, F.lower(t)) & ~(counted & F.regexp_like(F.lower(t), F.lit(r"^\d+\+?(?:boy|girl)s?\b"))) & ~(F.contains(t, F.lit(" ")) & F.array_contains(kinds, kind(F.lower(t))))
    return F.filter(new_tags, fits)


def character_count(count: Column, general: Column) -> Column:
    """Given count, else the sum of 1girl .. 4boys in the general tags, else 1."""
    exact = [f"{n}{w}{'s' * (n > 1)}" for n in range(1, 5) for w in ("girl", "boy")]
    listed = F.aggregate(F.filter(split_words(general), lambda t: t.isin(*exact)), F.lit(0), lambda a, t: a + F.substring(t, 1, 1).cast("int"))
    given = F.coalesce(count.cast("int"), F.lit(0))
    return F.when(given != 0, given).when(listed != 0, listed).otherwise(1)


def validated(upsampled: Column, prompt: Column, general: Column, count: Column | None = None) -> Column:
    """Upsampled tags that agree with the prompt: no more hair lengths, hair colours and eye colours than characters
    allow, nothing that its clothes exclude. An ordered fold, so earlier tags use up the room of later ones."""
    people = character_count(count if count is not None else F.lit(None), general)
    own = comma_parts(F.lower(text(prompt)))
    has = lambda names: F.size(F.filter(own, lambda t: t.isin(*names)))
    extra = lambda name: F.array_contains(own, name).cast("int")
    kinds = ((fixed.HAIR_LENGTHS, people), (fixed.HAIR_COLORS, people + extra("multicolored hair")), (fixed.EYE_COLORS, people + extra("heterochromia")))
    room = [F.greatest(limit - has(names), F.lit(0)) for names, limit in kinds]
    own_words = F.flatten(F.transform(own, lambda t: F.split(t, " ", -1)))
    barred = F.flatten(F.array(*[F.when(F.array_contains(own_words, k), F.array(*[F.lit(v) for v in vs])).otherwise(F.array().cast("array<string>")) for k, vs in fixed.CONFLICTS.items()]))

    def step(state: Column, tag: Column) -> Column:
        kind = F.when(tag.isin(*fixed.HAIR_LENGTHS), 1).when(tag.isin(*fixed.HAIR_COLORS), 2).when(tag.isin(*fixed.EYE_COLORS), 3).otherwise(0)
        fits = (kind == 0) | (F.element_at(state["room"], F.greatest(kind, F.lit(1))) > 0)
        left = F.transform(state["room"], lambda n, i: n - F.when((i + 1 == kind) & fits, 1).otherwise(0))
        ok = fits & ~F.arrays_overlap(F.split(tag, " ", -1), F.array_union(barred, F.array(F.lit("\x00"))))
        return F.struct(left.alias("room"), F.when(ok, F.concat(state["kept"], F.array(tag))).otherwise(state["kept"]).alias("kept"))

    start = F.struct(F.array(*room).alias("room"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(comma_parts(upsampled), start, step, lambda s: s["kept"]), ", ")
