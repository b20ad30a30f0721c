"""Array functions over token ids of prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

_EMPTY = "array<array<int>>"


def token_tags(ids: Column, special: bool = True) -> Column:
    """Token ids as an array of tags: commas part them and fall, a closing bracket with comma ends its tag and stays.

    special: the first and last id are marks and fall as well.
    """
    core = F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 2, F.lit(0))) if special else ids
    start = F.struct(F.array().cast(_EMPTY).alias("done"), F.array().cast("array<int>").alias("open"))

    def step(s: Column, t: Column) -> Column:
        some, comma, bracket = F.size(s["open"]) > 0, t == fixed.COMMA, t == fixed.BRACKET_COMMA
        closed = F.when(bracket, F.concat(s["open"], F.array(t))).otherwise(s["open"])
        done = F.when((comma | bracket) & some, F.concat(s["done"], F.array(closed))).otherwise(s["done"])
        return F.struct(done.alias("done"), F.when(comma | bracket, F.array().cast("array<int>")).otherwise(F.concat(s["open"], F.array(t))).alias("open"))

    return F.aggregate(core, start, step, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def token_ids(tags: Column, special: bool = True, comma_last: bool = False) -> Column:
    """Tags joined by commas again; none behind a closing bracket with comma, none at the end unless comma_last."""
    last = F.size(tags) - (0 if comma_last else 1)
    parts = F.transform(tags, lambda t, i: F.when((i < last) & (F.element_at(t, -1) != fixed.BRACKET_COMMA), F.concat(t, F.array(F.lit(fixed.COMMA)))).otherwise(t))
    flat = F.flatten(parts)
    return F.concat(F.array(F.lit(fixed.BOS)), flat, F.array(F.lit(fixed.EOS))) if special else flat


def shuffled(ids: Column, key: Column, most: int | None = None, special: bool = True) -> Column:
    """A prompt's tags in an order drawn by hash of key and tag; with most, tags drop in that order until ids fit."""
    tags = token_tags(ids, special)
    drawn = F.array_sort(F.transform(tags, lambda t, i: F.struct(F.xxhash64(key, i).alias("k"), t.alias("t"))))
    order = F.transform(drawn, lambda x: x["t"])
    if most is not None:
        # A dropped tag frees its own ids; what remains to be freed shrinks by just that.
        start = F.struct(F.greatest(F.size(ids) - most, F.lit(0)).alias("free"), F.array().cast(_EMPTY).alias("kept"))
        order = F.aggregate(order, start, lambda s, t: F.struct(F.when(s["free"] > 0, s["free"] - F.size(t)).otherwise(s["free"]).alias("free"), F.when(s["free"] > 0, s["kept"]).otherwise(F.concat(s["kept"], F.array(t))).alias("kept")), lambda s: s["kept"])
    return token_ids(order, special, comma_last=not special)


def leading_tags(tags: Column, lengths: Column, free: Column) -> Column:
    """The first tags whose lengths stay under the free room; the first that does not fit ends it."""
    start = F.struct(free.alias("left"), F.lit(True).alias("on"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, x: Column) -> Column:
        fits = s["on"] & (x["n"] < s["left"])
        return F.struct(F.when(fits, s["left"] - x["n"]).otherwise(s["left"]).alias("left"), fits.alias("on"), F.when(fits, F.concat(s["kept"], F.array(x["t"]))).otherwise(s["kept"]).alias("kept"))

    return F.aggregate(F.arrays_zip(tags.alias("t"), lengths.alias("n")), start, step, lambda s: s["kept"])


def padded_ids(ids: Column, length: int, pad: int = fixed.EOS) -> Column:
    """Token ids with their marks cut or filled to a length; a cut prompt keeps its last mark."""
    whole = F.concat(F.slice(ids, 1, length - 1), F.array(F.element_at(ids, -1)))
    return F.when(F.size(ids) > length, whole).otherwise(F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(ids), F.lit(0)))))


def chunks(ids: Column, size: int = 77, pad: int = fixed.EOS) -> Column:
    """Padded ids of a long prompt as chunks of `size` that each begin and end with a mark, as an encoder of that length
    takes them; ids that fit stay one chunk."""
    starts = F.sequence(F.lit(2), F.greatest(F.size(ids) - size + 2, F.lit(2)), F.lit(size - 2))

    def chunk(i: Column) -> Column:
        inner = F.slice(ids, i, size - 2)
        # What goes on in the next chunk ends with a mark here; a chunk of nothing but filling begins with one.
        last = F.when(~F.element_at(inner, -1).isin(fixed.EOS, pad), F.lit(fixed.EOS)).otherwise(F.element_at(ids, -1))
        first = F.when(F.element_at(inner, 1) == pad, F.array(F.lit(fixed.EOS))).otherwise(F.slice(inner, 1, 1))
        return F.concat(F.slice(ids, 1, 1), first, F.slice(inner, 2, size - 3), F.array(last))

    return F.when(F.size(ids) <= size, F.array(ids)).otherwise(F.transform(starts, chunk))
