"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

Numbers, units after numbers, and names (capitalised words inside a sentence) become typed placeholders, all else is
lower-cased and parted at punctuation. Windows of WINDOW words of the templates of both sides meet in a hash join; what
agrees at one offset of document and item forms an alignment. In an alignment a value that an item holds in a slot must
always face the same value of the document, so a question with new numbers or names is caught while texts that only
share a mould are not; where an alignment breaks this, only its windows whose values are all the item's own count. A
document is contaminated by an item when consistent windows cover at least `coverage` of the item's windows.

All documents are read once for the join, whatever lengths items have, and the few with a hit once more to check the hits
word by word. The benchmark's windows are broadcast only where their number times their width is under
common.BROADCAST_LIMIT; beyond it the join shuffles both sides.

Windows with fewer than LITERAL literal words would fit anything as templates, so they match on their values alone.

Defined results: null or empty text has no windows; items shorter than WINDOW words are matched whole; items of fewer
than LITERAL words or of numbers only are not used, since they fit anything, nor are rows of the benchmark without an
item_id; equal items each report; repeated rows of a document count once; texts that share a doc_id (or have none, which
counts as one) are judged one by one and share a row per item, that of the text which holds most of it; an empty table
gives an empty result; further columns of either table are ignored, but the one of docs that `key_col` names takes part
in the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, cut, text_of

WINDOW = 8
LITERAL = 3
#: Bytes that one window of the benchmark takes in memory, at the most usual: its hash and place, and with its words.
WIDTH, WORDY = 64, 512
#: Units that become placeholders behind a number.
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards yd mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl l liter liters litre litres gallon gallons "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years w kw kwh v volt volts watt watts hz khz mhz ghz kb mb gb tb byte bytes "
    "percent degree degrees cent cents dollar dollars euro euros usd eur gbp yen mph kmh"
).split()

_SEP = "\\x04-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\xBF\\u2000-\\u206F"
_LETTER = f"[^{_SEP}0-9\\x00-\\x03]"
_NUMBER = "[0-9]+(?:[.,:/][0-9]+)*"


def marked(text: Column) -> Column:
    """Text with \\x03 before each name and \\x02 before each unit."""
    names = F.regexp_replace(F.translate(text, "\x00\x01\x02\x03", ""), "(?<=[A-Za-z0-9\\u00C0-\\u024F,;] )(?=[A-Z\\u00C0-\\u00DE][a-z\\u00DF-\\u024F])", "\x03")
    return F.regexp_replace(names, f"(?<=[0-9] ?)(?=(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?!{_LETTER}))", "\x02")


def template(mark: Column) -> Column:
    """Words of the template: literals, \\x01 for a number, \\x02 for a unit, \\x03 for a name."""
    slots = F.regexp_replace(F.regexp_replace(mark, f"([\\x02\\x03]){_LETTER}+", " $1 "), _NUMBER, " \x01 ")
    return F.array_remove(F.split(F.lower(slots), f"[{_SEP}]+"), "")


def values(mark: Column) -> Column:
    """The words themselves, one for each word of the template."""
    return F.regexp_extract_all(F.lower(mark), F.lit(f"({_NUMBER}|[\\x02\\x03]?{_LETTER}+)"), F.lit(1))


def literals(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: w > "\x03"))


def window_hashes(words: Column, own: Column, sizes: list[int]) -> Column:
    """(k, at, hash) of all windows of k template words for each k, or of their values where fewer than LITERAL words are
    literal.

    words are bound once; values, and the literals of each window, are looked at only in texts where slots stand dense
    enough for such a window.
    """

    def of_size(w: Column, k: int) -> Column:
        dense = f"(?:[\\x01-\\x03](?: [^\\x01-\\x03 ]+){{0,{LITERAL - 1}}} ?){{{max(1, k - LITERAL + 1)}}}"
        starts = F.sequence(F.lit(1), F.size(w) - (k - 1))
        row = lambda i, *x: F.struct(F.lit(k).alias("k"), (i - 1).alias("at"), F.xxhash64(*x).alias("hash"))
        plain = F.transform(starts, lambda i: row(i, F.slice(w, i, k)))
        either = lambda v: F.transform(starts, lambda i: F.when(literals(F.slice(w, i, k)) >= LITERAL, row(i, F.slice(w, i, k))).otherwise(row(i, F.slice(v, i, k), F.lit("values"))))
        return F.when(F.size(w) >= k, F.when(F.array_join(w, " ").rlike(dense), F.element_at(F.transform(F.array(own), either), 1)).otherwise(plain)).otherwise(F.array().cast("array<struct<k:int,at:int,hash:bigint>>"))

    return F.element_at(F.transform(F.array(words), lambda w: F.concat(*[of_size(w, k) for k in sizes])), 1)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_matched, n_windows, coverage, exact, and key_col's
    column."""
    items = benchmark.filter(benchmark[item_col].isNotNull()).select(benchmark[item_col].alias("item_id"), text_of(benchmark, item_text_col).alias("t"))
    items = items.select("item_id", template(marked(F.col("t"))).alias("item_words"), values(marked(F.col("t"))).alias("item_values")).distinct()
    items = items.filter((F.size("item_words") >= LITERAL) & F.exists("item_words", lambda w: w != "\x01"))
    items = cut(items.withColumn("own_k", F.least(F.size("item_words"), F.lit(WINDOW))), "items")
    sizes = sorted(r[0] for r in items.select("own_k").distinct().collect())
    keys = ["doc_id", *([key_col] if key_col else [])]
    if not sizes:
        types = [docs.schema[id_col].dataType, *([docs.schema[key_col].dataType] if key_col else [])]
        named = ", ".join(f"{k} {t.simpleString()}" for k, t in zip(keys, types, strict=True))
        return docs.sparkSession.createDataFrame([], f"{named}, item_id {benchmark.schema[item_col].dataType.simpleString()}, n_matched long, n_windows long, coverage double, exact boolean")
    rows = docs.select(docs[id_col].alias("doc_id"), *([docs[key_col]] if key_col else []), docs[text_col].alias("text")).filter("text is not null")
    rows = rows.withColumn("doc", F.xxhash64(*keys, "text"))
    mine = items.select("item_id", "own_k", "item_words", "item_values", F.explode(window_hashes(F.col("item_words"), F.col("item_values"), sizes)).alias("w")).filter("w.k = own_k")
    mine = mine.select("w.hash", "w.k", "item_id", F.col("w.at").alias("item_at"), F.slice("item_words", F.col("w.at") + 1, F.col("own_k")).alias("slot"), F.slice("item_values", F.col("w.at") + 1, F.col("own_k")).alias("theirs"))
    mine = cut(mine, "windows")
    n_mine = mine.count()
    # Explode carries keys and hashes only; texts of documents with a hit are fetched again afterwards.
    each = rows.select("doc", F.explode(window_hashes(template(marked(F.col("text"))), values(marked(F.col("text"))), sizes)).alias("w")).select("doc", "w.*")
    hits = cut(each.join(bounded_broadcast(mine.select("hash", "k", "item_id", "item_at"), n_mine, WIDTH), ["hash", "k"]).drop("hash"), "hits")
    # Equal hashes are checked word by word, for which the documents with a hit are parted into words once more. A document
    # has no more places than words, however many items meet there.
    places = cut(hits.groupBy("doc").agg(F.collect_set(F.struct("k", "at")).alias("places")), "places")
    words_of = rows.join(bounded_broadcast(places.select("doc"), places.count(), 16), "doc", "left_semi").dropDuplicates(["doc"])
    words_of = words_of.select(*keys, "doc", template(marked(F.col("text"))).alias("words"), values(marked(F.col("text"))).alias("values"))
    part = lambda p: F.struct(p["k"].alias("k"), p["at"].alias("at"), F.slice("words", p["at"] + 1, p["k"]).alias("words"), F.slice("values", p["at"] + 1, p["k"]).alias("ours"))
    found = words_of.join(places, "doc").select(*keys, "doc", F.explode(F.transform("places", part)).alias("p")).select(*keys, "doc", "p.*")
    met = found.join(hits, ["doc", "k", "at"]).join(bounded_broadcast(mine.drop("hash", "k"), n_mine, WORDY), ["item_id", "item_at"])
    met = met.filter((F.col("words") == F.col("slot")) & ((literals(F.col("slot")) >= LITERAL) | (F.col("ours") == F.col("theirs"))))
    pairs = F.filter(F.transform(F.arrays_zip("slot", "theirs", "ours"), lambda z: F.struct(z["slot"].alias("kind"), z["theirs"].alias("theirs"), z["ours"].alias("ours"))), lambda z: z["kind"] <= "\x03")
    met = met.select("doc", *keys, "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), pairs.alias("pairs")).withColumn("exact", F.forall("pairs", lambda z: z["theirs"] == z["ours"]))
    # An alignment has each item position once, so what it gathers is bounded by the item's length.
    aligned = met.groupBy("doc", *keys, "item_id", "shift").agg(F.collect_set(F.struct("item_at", "pairs", "exact")).alias("windows"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("facing"))
    same = lambda x, y: (x["kind"] == y["kind"]) & (x["theirs"] == y["theirs"])
    clash = F.exists("facing", lambda x: F.size(F.filter("facing", lambda y: same(x, y))) > 1)
    kept = F.when(clash, F.filter("windows", lambda w: w["exact"])).otherwise(F.col("windows"))
    per_at = aligned.select("doc", *keys, "item_id", F.explode(kept).alias("w")).groupBy("doc", *keys, "item_id", F.col("w.item_at").alias("item_at")).agg(F.max("w.exact").alias("exact"))
    per = per_at.groupBy("doc", *keys, "item_id").agg(F.count(F.lit(1)).alias("n_matched"), F.min("exact").alias("exact"))
    per = per.groupBy(*keys, "item_id").agg(F.max(F.struct("n_matched", "exact")).alias("best")).select(*keys, "item_id", "best.*")
    n_windows = items.groupBy("item_id").agg(F.max(F.size("item_words") - F.col("own_k") + 1).cast("long").alias("n_windows"))
    out = per.join(bounded_broadcast(n_windows, n_mine, WIDTH), "item_id").withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
    return out.filter(F.col("coverage") >= coverage).select(*keys, "item_id", "n_matched", "n_windows", "coverage", "exact")
