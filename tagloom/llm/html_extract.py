"""Main-text extraction from pages by deducing each host's template from equivalence classes of tokens.

Tokens of a page are its containers (by path of tag and class from the root) and its text blocks (by path and content).
Over the pages of a host every token has an occurrence vector; tokens that share a vector form an equivalence class.
A class on at least half of the host's pages is a candidate for the template. It is valid if its tokens come in one
order on all pages, as often as they come, and if all of them fall into one gap of the root class (the class of what
occurs once on every page). Tokens that break the order are taken out of their class; a class that is spread over
several gaps is no part of the template. Valid classes nested into the root class' gaps are the template.

Slots are what the template's containers enclose. The main slot of a page is the outermost article or main container
that holds most of the page's running text; without one, the lowest container of the template that holds all running
text which is not the template's. Everything in it is the text, but the parts that are never article (menus, forms,
adverts, comments, ...) and, where the slot is not an article or main container, template text and mere links before
the first and behind the last block of other running text. So repeated text between others, and pages that repeat as
a whole, stay whole.

Vectors are compared by a fingerprint (exclusive or of hashes of page and occurrence), so they are aggregated piece by
piece and no host's pages meet in one task. A template is as long as a page, however many pages a host has.

Defined results: null or empty html gives an empty text; a null url belongs to the host ''; hosts with fewer than
MIN_PAGES pages have no template, so the page alone decides; repeated page_ids and null page_ids are separate rows;
repeated rows get equal results; markup may be unclosed or cut off anywhere; containers may nest to any depth; page_id
is taken as a long; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fits, spread_join

#: Pages that a host needs before its template is trusted.
MIN_PAGES = 3
#: Share of a page's running text that article or main containers hold at least to be the main slot.
MOST = 0.5

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_CLASS = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|\Z)", re.I)
_STYLED = re.compile(r"""(?<![\w-])style\s*=\s*(?:"[^"]*|'[^']*)\bdisplay\s*:\s*none""", re.I)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_CONTAINERS = frozenset("html head body div section article main nav header footer aside form table ul ol dl figure details dialog fieldset menu center".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre blockquote figcaption address hr caption summary thead tbody tfoot".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: They end a word, not a block.
_GAPS = frozenset("br td th img wbr input".split())
#: Read as text up to their end tag; where that is missing, up to the end of the page.
_RAW = frozenset("script style noscript iframe textarea title".split())
#: Left out up to their end tag; where that is missing, only the tag itself.
_SKIPPED = frozenset("template svg math object select canvas audio video button".split())
_HEAD_ONLY = frozenset("head title meta link base script style noscript template".split())
_NEVER = frozenset("head nav footer aside form dialog menu".split())
#: Names of parts that are never article, in whatever compound.
_SIGNS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsored sidebar navbar navigation breadcrumb breadcrumbs footer contentinfo complementary masthead "
    "comments disqus cookie cookies newsletter popup modal toolbar pagination".split()
)
#: Names that tell only alone or in compounds with each other, with signs and with names of layout.
_WEAK = frozenset("sponsor promo promotion menu nav banner comment respond replies consent notice notices alert share sharing social related subscribe signup login widget search".split())
_LAYOUT = frozenset(
    "box bar list item items block wrapper wrap container section area link links button buttons icon icons form left right top bottom main site page content header inner outer posts articles stories "
    "media panel column col row group toggle body text".split()
)
_ENDS = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in _RAW | _SKIPPED}
#: What a container is: never article; an article or main container; inside of one.
NEVER, ARTICLE, INSIDE = 1, 2, 4


class Page(NamedTuple):
    """Containers (parent, token, kind), number 0 being the page itself, and blocks (container, text, characters inside
    links, containers opened before)."""

    parent: list[int]
    token: list[int]
    kind: list[int]
    where: list[int]
    text: list[str]
    links: list[int]
    after: list[int]


def hashed(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


ROOT = hashed("root")


@lru_cache(maxsize=100_000)
def is_sign(names: str) -> bool:
    """Whether one of the names (classes, ids, roles) names a part that is never article."""
    for name in names.lower().split():
        parts = [p for p in re.split(r"[_-]+", re.sub(r"\d+", "", name)) if p]
        if any(p in _SIGNS for p in parts):
            return True
        if any(p in _WEAK for p in parts) and all(p in _WEAK or p in _LAYOUT for p in parts):
            return True
    return False


@lru_cache(maxsize=100_000)
def named(tag: str, attributes: str) -> tuple[str, bool]:
    """(name of a container in its path, whether it is never article by its attributes)."""
    names = [next(filter(None, x), "") for x in _CLASS.findall(attributes)]
    first = next((n.split()[0] for n in names if n.split()), "")
    out = bool(_HIDDEN.search(_QUOTED.sub("=", attributes)) or _STYLED.search(attributes)) or (tag not in ("html", "body") and is_sign(" ".join(names)))
    return tag + ("." + re.sub(r"\d+", "#", first.lower()) if first else ""), out


def parse(html: str) -> Page:
    parent, token, own, inside = [-1], [ROOT], [0], [False]
    where, texts, links, after = [], [], [], []
    stack, is_open = [("", 0)], Counter()
    wraps: set[int] = set()
    parts: list[str] = []
    begun, in_links, link, heading, at, end = 0, 0, False, False, 0, len(html)

    def settle() -> None:
        nonlocal in_links
        if parts:
            if joined := " ".join("".join(parts).split()):
                where.append(begun)
                texts.append(joined)
                links.append(min(in_links, len(joined)))
                after.append(len(parent))
            parts.clear()
            in_links = 0

    def close(tag: str) -> None:
        while is_open[tag]:
            last = stack.pop()[0]
            is_open[last] -= 1
            if last == tag:
                break

    while at < end:
        m = _TAG.search(html, at)
        start = m.start() if m else end
        if start > at:
            piece = html[at:start]
            piece = unescape(piece) if "&" in piece else piece
            if not parts:
                begun = stack[-1][1]
            parts.append(piece)
            in_links += len(piece) if link and not heading else 0
        if not m:
            break
        at, tag = m.end(), m[2] or m[5]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "a":
            link = not closing
        if is_open["head"] and not closing and tag not in _HEAD_ONLY:
            settle()
            close("head")
        if tag in _GAPS:
            if parts:
                parts.append(" ")
            continue
        if tag in _RAW or tag in _SKIPPED:
            if not closing and not attributes.endswith("/"):
                stop = _ENDS[tag].search(html, at)
                at = stop.end() if stop else end if tag in _RAW else at
            continue
        if tag not in _BLOCKS:
            continue
        settle()
        heading = not closing and tag in _HEADINGS
        if closing:
            if tag in _CONTAINERS:
                close(tag)
            continue
        if tag == "h1":
            wraps.update(i for t, i in stack if t == "form")
        if tag not in _CONTAINERS:
            continue
        up = stack[-1][1]
        name, out = named(tag, attributes)
        main = tag in ("article", "main") and not inside[up]
        if main:
            wraps.update(i for t, i in stack if t == "form")
        number = len(parent)
        parent.append(up)
        token.append(hashed(token[up], name))
        own.append((NEVER if out or tag in _NEVER or (tag == "header" and not inside[up]) else 0) | (ARTICLE if main else 0))
        inside.append(inside[up] or main)
        stack.append((tag, number))
        is_open[tag] += 1
    settle()
    # A form around the article itself is only its page's frame.
    kind = [0] * len(parent)
    for i in range(1, len(parent)):
        mine = own[i] & ~NEVER if i in wraps else own[i]
        kind[i] = mine | (kind[parent[i]] & NEVER) | (INSIDE if inside[i] else 0)
    return Page(parent, token, kind, where, texts, links, after)


def sequence(page: Page) -> tuple[list[int], list[int]]:
    """(tokens of a page in order, containers and blocks alike, and how often each occurred up to there)."""
    out, at, seen = [], 0, Counter()
    for w, t, a in zip(page.where, page.text, page.after, strict=True):
        out += page.token[at:a]
        at = a
        out.append(hashed(page.token[w], "#", t))
    out += page.token[at:]
    nth = []
    for t in out:
        seen[t] += 1
        nth.append(seen[t])
    return out, nth


def rising(ranks: list[int]) -> set[int]:
    """Places of a longest strictly rising subsequence."""
    tops, places, before = [], [], []
    for i, r in enumerate(ranks):
        k = bisect_left(tops, r)
        before.append(places[k - 1] if k else -1)
        if k == len(tops):
            tops.append(r)
            places.append(i)
        else:
            tops[k], places[k] = r, i
    out, i = set(), places[-1] if places else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


class Template(NamedTuple):
    """A host's candidates: class and rank of each token; ranks follow the order of one page."""

    of: dict[int, tuple[int, int]]
    root: int
    sizes: Counter

    @classmethod
    def make(cls, tokens: list[dict]) -> Template:
        of = {t["token"]: (t["class"], t["rank"]) for t in tokens}
        return cls(of, of[ROOT][0] if ROOT in of else 0, Counter(c for c, _ in of.values()))


def faults(template: Template, seq: list[int]) -> Iterator[tuple[int, int | None, int, int]]:
    """(class, token out of order or None, first and last gap of the root class that the class falls in) on one page."""
    places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for i, t in enumerate(seq):
        if (hit := template.of.get(t)) is not None:
            places[hit[0]].append((i, hit[1], t))
    root = places.pop(template.root, [])
    kept = rising([r for _, r, _ in root])
    for k, (_, _, t) in enumerate(root):
        if k not in kept:
            yield template.root, t, 0, 0
    starts = [root[k][0] for k in sorted(kept)]
    ranks = [root[k][1] for k in sorted(kept)]
    for c, found in places.items():
        n, size = len(found), template.sizes[c]
        if n <= size:
            good = rising([r for _, r, _ in found])
            for k, (_, _, t) in enumerate(found):
                if k not in good:
                    yield c, t, 0, 0
        elif [r for _, r, _ in found] != [r for _, r, _ in found[:size]] * (n // size):
            # A class that repeats comes in whole rounds of one order.
            yield c, None, -1, 1 << 30
            continue
        gaps = [bisect_left(starts, i) for i, _, _ in (found[0], found[-1])]
        yield c, None, *(ranks[g - 1] if g else -1 for g in gaps)


def valid_tokens(template: Template, bad: list[dict]) -> frozenset[int]:
    """Tokens of the valid classes, from the faults of all pages: (class, token, least gap, greatest gap)."""
    lost = {b["token"] for b in bad if b["token"] is not None}
    dividers = sorted(r for t, (c, r) in template.of.items() if c == template.root and t not in lost)
    spread = {b["class"] for b in bad if b["token"] is None and (b["low"] < -1 or b["high"] >= 1 << 30 or bisect_left(dividers, b["low"] + 1) != bisect_left(dividers, b["high"] + 1))}
    return frozenset(t for t, (c, _) in template.of.items() if t not in lost and c not in spread)


def main_text(page: Page, valid: frozenset[int] = frozenset()) -> str:
    """Text of the page's main slot; valid: the template's tokens."""
    n = len(page.parent)
    blocks = [i for i, w in enumerate(page.where) if not page.kind[w] & NEVER]
    if not blocks:
        return ""
    running = [len(page.text[i]) - page.links[i] for i in blocks]
    fixed = [bool(valid) and hashed(page.token[page.where[i]], "#", page.text[i]) in valid for i in blocks]
    other = [r > 0 and not f for r, f in zip(running, fixed, strict=True)]
    if not any(other):
        # Nothing but the template, as on pages that repeat as a whole: then the page alone decides.
        other = [r > 0 for r in running]
        fixed = [False] * len(blocks)
    if not any(other):
        other = [True] * len(blocks)
    # Outermost article and main containers, by path; the one that holds most.
    top = list(range(n))
    for c in range(1, n):
        top[c] = c if page.kind[c] & ARTICLE else top[page.parent[c]] if page.kind[c] & INSIDE else -1
    held: Counter = Counter()
    for i, r in zip(blocks, running, strict=True):
        if top[page.where[i]] > 0:
            held[page.token[top[page.where[i]]]] += r
    if held:
        best, most = max(held.items(), key=lambda x: (x[1], -x[0]))
        if most >= MOST * sum(r for r, o in zip(running, other, strict=True) if o):
            return "\n\n".join(page.text[i] for i in blocks if top[page.where[i]] > 0 and page.token[top[page.where[i]]] == best)
    # The lowest container of the template that holds all other running text.
    below = [0] * n
    for i, o in zip(blocks, other, strict=True):
        below[page.where[i]] += o
    for c in range(n - 1, 0, -1):
        below[page.parent[c]] += below[c]
    slot = max(c for c in range(n) if below[c] == below[0] and (c == 0 or not valid or page.token[c] in valid))
    within = [False] * n
    within[slot] = True
    for c in range(slot + 1, n):
        within[c] = within[page.parent[c]]
    mine = [k for k, i in enumerate(blocks) if within[page.where[i]]]
    first, last = (next(k for k in order if other[k]) for order in (mine, mine[::-1]))
    # At both ends, template text and mere links belong to the frame.
    return "\n\n".join(page.text[blocks[k]] for k in mine if first <= k <= last or not (fixed[k] or running[k] <= 0))


_ARRAYS = {"parent": "int", "token": "long", "kind": "int", "container": "int", "text": "string", "links": "int", "after": "int", "seq": "long", "nth": "int"}
_PAGE = list(_ARRAYS)[:7]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    for b in batches:
        for i in range(0, b.num_rows, 64):
            part = b.slice(i, 64)
            rows = []
            for html in part.column(4).to_pylist():
                page = parse(html or "")
                rows.append((*page, *sequence(page)))
            arrays = [pa.array([r[k] for r in rows], pa.list_(types[t])) for k, t in enumerate(_ARRAYS.values())]
            yield pa.record_batch([*(part.column(k) for k in range(4)), *arrays], ["host", "row", "page_id", "url", *_ARRAYS])


def _faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, template, seq): the faults of each page."""
    host, template = None, None
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part, rows = b.slice(i, 256), []
            for h, at, seq in zip(part.column(0).to_pylist(), range(part.num_rows), part.column(2).to_pylist(), strict=True):
                if template is None or h != host:
                    host, template = h, Template.make(part.column(1)[at].as_py())
                rows += [(h, *f) for f in faults(template, seq)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["host", "class", "token", "low", "high"])


def with_template(pages: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """pages (host, row, ...) joined to one row per host: broadcast while all templates are small; beyond that both sides
    are shuffled and the pages of a large host are dealt over tasks."""
    size = known.agg(F.sum(F.size("template") + 8)).first()[0] or 0
    if fits(pages.sparkSession, size, 32):
        return pages.join(F.broadcast(known), "host", how)
    return spread_join(pages, known, ["host"], ["row"], "all_pages", how)


def templates(parsed: DataFrame) -> DataFrame:
    """(host, template, all_pages, bad): candidates of each host's template and their faults over all pages. parsed: as
    _parse gives."""
    each = parsed.select("host", "row", F.posexplode(F.arrays_zip("seq", "nth")).alias("at", "s")).select("host", "row", "at", "s.seq", "s.nth")
    first = F.col("nth") == 1
    vectors = each.groupBy("host", F.col("seq").alias("token")).agg(
        F.bit_xor(F.xxhash64("row", "nth")).alias("vector"), F.count_if(first).alias("pages"), F.count(F.lit(1)).alias("n"), F.min(F.when(first, F.struct("row", "at"))).alias("first")
    )
    vectors = cut(vectors.filter((F.col("pages") > MIN_PAGES // 2) | (F.col("token") == ROOT)), "vectors")
    root = vectors.groupBy("host").agg(F.max(F.when(F.col("token") == ROOT, F.col("pages"))).alias("all_pages"), F.count(F.lit(1)).alias("tokens")).filter(F.col("all_pages") >= MIN_PAGES)
    root = cut(root, "hosts")
    own = vectors.join(F.broadcast(root), "host") if fits(parsed.sparkSession, root.count(), 64) else spread_join(vectors, root, ["host"], ["token"], "tokens")
    often = own.filter(F.col("pages") * 2 >= F.col("all_pages"))
    # Tokens on at least half of a host's pages: at most twice as many as a page has. A class is told by its vector.
    one = F.struct("token", F.xxhash64("vector", "pages", "n").alias("class"), F.col("first.at").cast("int").alias("rank"))
    found = cut(often.groupBy("host").agg(F.array_sort(F.collect_list(one)).alias("template"), F.max("all_pages").alias("all_pages")), "classes")
    met = with_template(parsed.select("host", "row", "seq"), found, "inner").select("host", "template", "seq")
    broken = met.mapInArrow(_faults, "host string, class long, token long, low int, high int").groupBy("host", "class", "token").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    bad = broken.groupBy("host").agg(F.collect_list(F.struct("class", "token", "low", "high")).alias("bad"))
    return found.join(bad, "host", "left")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset[int]] = {}
    for b in batches:
        for i in range(0, b.num_rows, 64):
            part, texts = b.slice(i, 64), []
            pages = [part.column(3 + k).to_pylist() for k in range(len(_PAGE))]
            for k, host in enumerate(part.column(0).to_pylist()):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    template = part.column(3 + len(_PAGE))[k].as_py()
                    known[host] = valid_tokens(Template.make(template), part.column(4 + len(_PAGE))[k].as_py() or []) if template else frozenset()
                texts.append(main_text(Page(*(c[k] for c in pages)), known[host]))
            yield pa.record_batch([part.column(1), part.column(2), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col], F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    number, html = pages[id_col].cast("long"), pages[html_col]
    rows = pages.select(host.alias("host"), F.xxhash64(number, pages[url_col], html).alias("row"), number.alias("page_id"), pages[url_col].alias("url"), html.alias("html"))
    schema = "host string, row long, page_id long, url string, " + ", ".join(f"{k} array<{t}>" for k, t in _ARRAYS.items())
    parsed = cut(rows.mapInArrow(_parse, schema), "parsed")
    known = cut(templates(parsed), "templates")
    joined = with_template(parsed.select("host", "row", "page_id", "url", *_PAGE), known, "left")
    return joined.select("host", "page_id", "url", *_PAGE, "template", "bad").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
