r"""Main text of pages by equivalence-class template deduction.

A page is a sequence of tokens: element starts, named by their path from the root
(tag, classes and id without digits), and runs of text, named by path and text.
Within a host, a token's *occurrence vector* says how often it stands on each
page; tokens with equal vectors form an equivalence class. The class of the most
pages whose tokens stand there once is the host's root; those of its tokens that keep
their order cut a page into slots. A class is valid - part of what generates the pages - if

* ordered: its tokens t1..tm follow each other as (t1 .. tm)(t1 .. tm)... in the same
  order on every page that holds them, and
* nested: a round t1 .. tm lies in one slot of the root, or spans the same tokens of the
  root on all those pages; then its parts in different slots are classes of their own.

Tokens that break a rule become classes of one, which keep both. Valid classes are
template if they stand on ``SUPPORT`` of the host's pages, or if they show a rarer
page type: ``LARGE`` tokens or more, an element among them (passages that articles
share are text alone), on ``TYPE_SUPPORT`` of the pages. Named by path, template
classes nest by their paths. What is left are the slots: the text below a template
element.

Per host the template keeps

* its element paths, one list per nesting of valid classes,
* its constant texts, if they stand on ``PAGES`` different pages or more, inside
  ``article`` and ``main`` on ``MAIN_PAGES``, and
* slots that hold mostly links.

Pages differ when their text outside boilerplate differs, so copies of one article
are one page and prove no constant. Every token keeps a bitmap of ``CELLS`` cells
of its pages' text hashes; the cells set never exceed the different pages.

A page's text belongs to the slot of its deepest template element. Slots under
elements that are boilerplate by their tag (``BOILERPLATE_TAGS``), scripts and styles
are left out. A form, ``noscript`` or ``object`` element, or one whose class, id or
role names a menu, header, footer, side bar, notice, advert, form or comment section
(every letter run of one class is such a word, but for words of place) is left out
too, unless it is or holds an ``article`` or ``main``, or holds most of the page's
text while next to no text under such a tag stands outside it. Left out are also constant texts and link
slots, under ``article`` and ``main`` as elsewhere (there a block goes with its slot
if it is mostly links itself). Of the slots that remain, those under ``article`` or
``main`` come first: they are the main text unless the others hold more than
``OUTWEIGH`` times their text; then all are. If nothing remains, the constant texts
under ``article`` or ``main`` are the main text.

Vectors are compared by hash: every page adds hash(page, count) of each of its
tokens with exclusive or, so a host's pages are never gathered - a batch sends one
row per host and token, whatever the size of the host - and a class is a group
of equal sums. Order is compared by hash in a second pass: at the j-th occurrence of a
token, the sum of its class's tokens so far less j - 1 times the sum of the whole class is the
sum of those before it in its round, the same everywhere if the class is ordered; a
minimum and a maximum per token decide. For slots every token keeps, as bits, the root's
tokens that stand between its round's start and some or all of its occurrences. A host's template
has at most as many tokens as fit its pages ``1 / TYPE_SUPPORT`` times over. It is
joined to the pages by host, by broadcast when all templates are small and else by a
join whose large hosts Spark splits.

Text: character references are decoded, white space in a block becomes one blank,
blocks are trimmed and joined in page order by an empty line.

Defined cases: null html is empty; pages without a usable url share one host;
unclosed and stray tags are tolerated, an unclosed comment, script or style runs to
the end, other unclosed elements without page text end at their tag; element depth beyond ``DEPTH`` counts as the last one; repeated rows are pages
of their own; other columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepared, scratch

SUPPORT = 0.5
TYPE_SUPPORT = 0.02  # of a page type with markup of its own; bounds a host's template
LARGE = 3
PAGES = 5
MAIN_PAGES = 8  # of CELLS: a constant needs more pages where the markup says main text
CELLS = 63
OUTWEIGH = 2
DEPTH = 64
SALTS = 64
BITS = 63  # root tokens per long
MASKS = 100_000  # rows of a broadcast

#: Element names and the words by which boilerplate names itself.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe svg select textarea button annotation annotation-xml".split())
TO_END = frozenset(("script", "style"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript object ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSED_BY_SAME = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "tr": "table tbody thead tfoot", "td": "tr table", "th": "tr table", "option": "datalist"}
BOILERPLATE_TAGS = frozenset("head title nav header footer aside menu dialog".split())
TELLING_TAGS = frozenset(("form", "noscript", "object"))
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer form "
    "header login menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted related reply replies search "
    "share sharing sidebar sidebars signup social sponsor sponsored subscribe toolbar widget widgets".split())
PLACE_WORDS = frozenset(
    "area article bar block bottom box container content global inner item left link links list main page post primary right secondary section site top "
    "wrap wrapper".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAME = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")


def _telling(name: str) -> bool:
    words = set(_WORDS.findall(name)) - PLACE_WORDS
    return bool(words) and words <= BOILERPLATE_WORDS


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """An element's name in paths, and whether it names itself boilerplate."""
    name, telling = tag, tag in TELLING_TAGS
    if "=" in attributes:
        for key, a, b, c in _NAME.findall(attributes):
            value = (a or b or c).strip().lower()
            telling = telling or any(map(_telling, value.split()))
            if key.lower() != "role" and value:
                name += ("#" if key.lower() == "id" else ".") + _DIGITS.sub("0", ".".join(sorted(value.split())))
    return name, telling and tag not in ("html", "body")


class _Element:
    """``chars`` and ``main_chars`` are of the text below, outside boilerplate tags; ``blocks`` fills them in with the flags that rest on them."""

    __slots__ = ("tag", "path", "up", "telling", "main", "linked", "closed", "boilerplate", "headed", "chars", "main_chars", "holds_main")

    def __init__(self, tag, path, up, telling, main, linked):
        self.tag, self.path, self.up, self.telling, self.main, self.linked = tag, path, up, telling, main, linked
        self.closed = self.boilerplate = self.headed = False
        self.chars = self.main_chars = 0
        self.holds_main = tag in MAIN_TAGS


def walk(page: str):
    """Yield ``(element, text, linked)``: ``text`` is None at an element's start, else one block of text with the element
    it began in; ``linked`` is how much of it stands in links."""
    stack = [_Element("", "", None, False, False, False)]
    parts: list[str] = []
    links: list[str] = []
    began = stack[0]
    at, n = 0, len(page)

    def flushed():
        text = " ".join("".join(parts).split())
        linked = min(len(text), sum(len(" ".join(x.split())) for x in links))
        parts.clear()
        links.clear()
        return text, linked

    while at < n:
        lt = page.find("<", at)
        end = n if lt < 0 else lt
        if end > at:
            if not parts:
                began = stack[-1]
            piece = page[at:end]
            parts.append(html.unescape(piece) if "&" in piece else piece)
            if stack[-1].linked:
                links.append(parts[-1])
        if lt < 0:
            break
        m = _TAG.match(page, lt)
        if m is None:  # a lone "<" is text
            if not parts:
                began = stack[-1]
            parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag, attributes = (m.group(2) or m.group(4)), (m.group(3) or m.group(5) or "")
        if tag:
            tag = tag.lower()
            if tag == "br":
                parts.append(" ")
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = close.end() if close else n if tag in TO_END else at
                parts.append(" ")
                continue
            block = tag in BLOCK
            if block and parts:
                text, linked = flushed()
                if text:
                    yield began, text, linked
            if tag in VOID:
                continue
            if block:
                stop = CLOSED_BY_SAME.get(tag)
                for i in range(len(stack) - 1, 0, -1):
                    open_ = stack[i].tag
                    if open_ == "p" or (stop is not None and open_ == tag):
                        del stack[i:]
                        break
                    if stop is not None and open_ in stop.split():
                        break
                    if open_ in BLOCK and (stop is None or open_ in MAIN_TAGS):
                        break
            up = stack[-1]
            name, telling = _named(tag, attributes)
            path = f"{up.path}>{name}" if len(stack) <= DEPTH else up.path
            stack.append(_Element(tag, path, up, telling, up.main or tag in MAIN_TAGS, up.linked or tag == "a"))
            yield stack[-1], None, 0
        elif m.group(1):
            tag = m.group(1).lower()
            if tag in BLOCK and parts:
                text, linked = flushed()
                if text:
                    yield began, text, linked
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    stack[i].closed = True
                    del stack[i:]
                    break
    if parts:
        text, linked = flushed()
        if text:
            yield began, text, linked


def blocks(page: str) -> list[tuple[_Element, str | None, int]]:
    """``walk`` with the elements' ``boilerplate`` and ``headed`` (in an article's header, but no heading) decided."""
    out = list(walk(page))
    elements = [e for e, text, _ in out if text is None]  # parents stand before their children
    certain = {None: False}
    for e in elements:
        # an article's own header: its headings stay
        certain[e] = certain.get(e.up, False) or e.tag in BOILERPLATE_TAGS and not (e.tag == "header" and e.up.main)
    total = total_main = 0
    for e, text, _ in out:
        if text is not None and not certain.get(e, False):
            e.chars += len(text)
            e.main_chars += len(text) * e.main
            total += len(text)
            total_main += len(text) * e.main
    for e in reversed(elements):
        e.up.chars += e.chars
        e.up.main_chars += e.main_chars
        e.up.holds_main |= e.holds_main
    for e in elements:
        up = e.up
        own_header = e.tag == "header" and up.main
        telling = e.telling and (e.closed or e.tag not in TELLING_TAGS)  # one without an end would take the rest of the page along
        only_named = telling and not own_header and not e.holds_main and not (
            2 * e.chars > total and 10 * (total_main - e.main_chars) <= e.chars)
        e.boilerplate = up.boilerplate or certain[e] or only_named
        e.headed = own_header and not up.boilerplate or up.headed and e.tag not in HEADINGS
    return out


def _h(x: str) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


def _text_token(path: str, text: str) -> int:
    return _h(f"{path}\0{text}")


def host_of(url):
    """SQL host of a url column, in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


TOKENS = "host string, token long, pages long, vector long, text boolean, main boolean, seen long, chars long, linked long, most long"
TEMPLATE = "paths array<long>, constants array<long>, links array<long>"


def tokens(pages: DataFrame) -> DataFrame:
    """Per host and token: pages, the vector's hash, the cells of its different pages, for elements the text in them
    and the linked part of it, and the most occurrences on a page."""

    def counted(batches):
        row = TaskContext.get().partitionId() << 40
        for pdf in batches:
            sums: dict[tuple, list] = {}
            for host, page in zip(pdf["host"], pdf["html"]):
                row += 1
                count: dict[int, list] = {}
                page_text = xxhash.xxh64()
                for element, text, linked in blocks(page or ""):
                    token = _h(element.path) if text is None else _text_token(element.path, text)
                    one = count.setdefault(token, [0, text is not None, element.main, 0, 0])
                    one[0] += 1
                    if text is not None:
                        of = count.setdefault(_h(element.path), [0, False, element.main, 0, 0])
                        of[3] += len(text)
                        of[4] += linked
                        if not element.boilerplate:
                            page_text.update(text)
                            page_text.update("\0")
                cell = 1 << page_text.intdigest() % CELLS
                count[0] = [1, False, False, 0, 0]
                for token, (n, is_text, main, chars, linked) in count.items():
                    one = sums.setdefault((host, token), [0, 0, is_text, main, 0, 0, 0, 0])
                    one[0] += 1
                    one[1] ^= _h(f"{row}:{n}")
                    one[4] |= cell
                    one[5] += chars
                    one[6] += linked
                    one[7] = max(one[7], n)
            yield pd.DataFrame([(h, t, *x) for (h, t), x in sums.items()], columns=[x.split()[0] for x in TOKENS.split(", ")])

    return pages.mapInPandas(counted, TOKENS).groupBy("host", "token", "text").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.max("main").alias("main"), F.bit_or("seen").alias("seen"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        F.max("most").alias("most"))


def _template_like(support: float):
    """Condition on ``pages, of, seen, members``: frequent on the host, or a page type with markup of its own."""
    page_type = (F.size("members") >= LARGE) & F.exists("members", lambda m: ~m["text"]) & (F.bit_count("seen") >= PAGES)
    return (F.col("pages") >= support * F.col("of")) | page_type & (F.col("pages") >= TYPE_SUPPORT * F.col("of"))


def classes(counted: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``host, vector, pages, of, seen, most, members``: equivalence classes by vector that can be template; ``of`` is the host's number of pages."""
    # a host's tokens grow with its pages: they meet its total in SALTS parts
    total = counted.where("token = 0").select("host", F.col("pages").alias("of"), F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt"))
    salted = counted.where("token <> 0").withColumn("salt", F.pmod("token", F.lit(SALTS)).cast("int"))
    often = (F.col("pages") >= support * F.col("of")) | (F.col("pages") >= TYPE_SUPPORT * F.col("of")) & (F.bit_count("seen") >= PAGES)
    frequent = salted.join(total, ["host", "salt"]).where(often)
    found = frequent.groupBy("host", "vector", "pages", "of").agg(
        F.bit_or("seen").alias("seen"), F.max("most").alias("most"),
        F.collect_list(F.struct("token", "text", "main", "chars", "linked")).alias("members"))
    return found.where(_template_like(support))


def placements(page: str, vectors: dict, sums: dict, root: dict) -> dict:
    """Per token of a class on the page: least and greatest place in its class's round, and the root tokens, as bits, that stand
    between the round's start and some or every occurrence (None on pages without the root). ``sums`` has the sum of each
    class's tokens."""
    before = dict.fromkeys(sums, 0)
    began: dict[int, tuple] = {}
    count: dict[int, int] = {}
    out: dict[int, list] = {}
    bits = 0
    for element, text, _ in walk(page):
        token = _h(element.path) if text is None else _text_token(element.path, text)
        vector = vectors.get(token)
        if vector is None:
            continue
        j = count.get(token, 0)
        count[token] = j + 1
        place = (before[vector] - j * sums[vector]) % (1 << 64) - (1 << 63)
        before[vector] += token
        if began.get(vector, (-1, 0))[0] < j:
            began[vector] = j, bits
        between = bits ^ began[vector][1]
        one = out.get(token)
        if one is None:
            out[token] = [place, place, between, between]
        else:
            one[:] = min(one[0], place), max(one[1], place), one[2] | between, one[3] & between
        bits |= root.get(token, 0)
    if not bits:
        for one in out.values():
            one[2:] = None, None
    return out


PLACES = "host string, token long, first long, last long, chunk int, some long, every long"


def valid_classes(pages: DataFrame, found: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``found`` with its classes tested for order and nesting on all pages: ``host, vector, pages, of, seen, members``."""
    in_class = F.array_sort(F.col("members").getField("token"))
    # the root: tokens that stand once on the most pages
    root = F.max(F.when(F.col("most") == 1, F.struct("pages", F.size("members").alias("n"), "vector", in_class.alias("tokens")))).getField("tokens")
    of_host = found.groupBy("host").agg(F.collect_list(F.struct("vector", in_class.alias("tokens"))).alias("c"), root.alias("root"))
    of_host = of_host.select("host", F.coalesce("root", F.expr("cast(array() AS array<bigint>)")).alias("root"),
                             F.expr("flatten(transform(c, x -> x.tokens))").alias("tokens"),
                             F.expr("flatten(transform(c, x -> array_repeat(x.vector, size(x.tokens))))").alias("vectors"))
    of_host = scratch(of_host, "html-hosts")

    def placed(batches):
        for pdf in batches:
            known: dict[str, tuple] = {}
            ends: dict[tuple, list] = {}
            for host, page, root, of_tokens, of_vectors in zip(pdf["host"], pdf["html"], pdf["root"], pdf["tokens"], pdf["vectors"]):
                if host not in known:
                    vectors = dict(zip(map(int, of_tokens), map(int, of_vectors)))
                    sums: dict[int, int] = {}
                    for token, vector in vectors.items():
                        sums[vector] = sums.get(vector, 0) + token
                    known[host] = vectors, sums, {int(t): 1 << i for i, t in enumerate(root)}
                for token, (first, last, some, every) in placements(page or "", *known[host]).items():
                    one = ends.get((host, token))
                    if one is None:
                        ends[host, token] = [first, last, some, every]
                        continue
                    one[0], one[1] = min(one[0], first), max(one[1], last)
                    if some is not None:
                        one[2], one[3] = (some, every) if one[2] is None else (one[2] | some, one[3] & every)
            out = []
            for (host, token), (first, last, some, every) in ends.items():
                for chunk in range(max(1, -(-len(known[host][2]) // BITS))):
                    cut = [None if x is None else x >> chunk * BITS & (1 << BITS) - 1 for x in (some, every)]
                    out.append((host, token, first, last, chunk, *cut))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PLACES.split(", ")], dtype=object)

    rows = pages.join(of_host, "host").select("host", "html", "root", "tokens", "vectors")
    at = rows.mapInPandas(placed, PLACES).groupBy("host", "token", "chunk").agg(
        (F.min("first") == F.max("last")).alias("ordered"), F.bit_or("some").alias("some"), F.bit_and("every").alias("every"))
    at = scratch(at, "html-places")
    # slots lie between the root's tokens that keep their order
    of_root = of_host.select("host", F.posexplode("root").alias("i", "token"))
    steady = of_root.join(at.where("chunk = 0 AND ordered").select("host", "token"), ["host", "token"])
    mask = steady.groupBy("host", F.expr(f"cast(i DIV {BITS} AS int)").alias("chunk")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, i % {BITS})")).alias("mask"))
    mask = F.broadcast(mask) if mask.count() <= MASKS else mask
    slotted = at.join(mask, ["host", "chunk"], "left").withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
    some, every = F.col("some").bitwiseAND(F.col("mask")), F.col("every").bitwiseAND(F.col("mask"))
    one = slotted.groupBy("host", "token").agg(F.min(F.col("ordered") & some.eqNullSafe(every)).alias("kept"), F.bit_xor(F.xxhash64("chunk", every)).alias("slot"))
    member = found.select("host", "vector", "pages", "of", "seen", F.explode("members").alias("m")).withColumn("token", F.col("m.token"))
    kept = F.col("kept")
    return member.join(one, ["host", "token"]).groupBy(
        "host", "vector", "pages", "of", "seen", F.when(kept, F.col("slot")).alias("slot"), F.when(~kept, F.col("token")).alias("alone")).agg(
        F.collect_list("m").alias("members")).where(_template_like(support)).drop("slot", "alone")


def templates(pages: DataFrame) -> DataFrame:
    """``host, paths, constants, links``: one row per host."""
    found = scratch(classes(scratch(tokens(pages), "html-tokens")), "html-classes")
    valid = valid_classes(pages, found)
    member = valid.select("host", F.bit_count("seen").alias("cells"), F.explode("members").alias("m")).select("host", "cells", "m.*")
    constant = F.col("text") & (F.col("cells") >= F.when(F.col("main"), MAIN_PAGES).otherwise(PAGES))
    return member.groupBy("host").agg(
        F.collect_list(F.when(~F.col("text"), F.col("token"))).alias("paths"),
        F.collect_list(F.when(constant, F.col("token"))).alias("constants"),
        F.collect_list(F.when(~F.col("text") & (2 * F.col("linked") > F.col("chars")), F.col("token"))).alias("links"))


def main_text(page: str, paths: set, constants: set, links: set) -> str:
    """Text of the remaining slots of a page."""
    slots: dict[str, int] = {}

    def slot(path: str) -> int:
        """The deepest template element on the way to ``path``."""
        if path not in slots:
            h = _h(path)
            slots[path] = h if not path or h in paths else slot(path.rpartition(">")[0])
        return slots[path]

    kept, constant = [], []  # (under article or main, text) in page order
    for element, text, linked in blocks(page):
        if text is None or element.boilerplate or element.headed:
            continue
        if slot(element.path) in links and (not element.main or 2 * linked > len(text)):
            continue
        (constant if _text_token(element.path, text) in constants else kept).append((element.main, text))
    inside = sum(len(t) for main, t in kept if main)
    if inside and sum(len(t) for main, t in kept if not main) <= OUTWEIGH * inside:
        kept = [x for x in kept if x[0]]
    return "\n\n".join(t for _, t in kept or [x for x in constant if x[0]])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``page_id, url, html``."""
    rows = prepared(pages).select(F.col("page_id").cast("long").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"),
                                  host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    template = scratch(templates(rows.select("host", "html")), "html-templates")
    both = rows.join(template, "host", "left")

    def extracted(batches):
        none = np.zeros(0, dtype=np.int64)
        for pdf in batches:
            kept: dict[str, tuple] = {}
            texts = []
            for host, page, *sets in zip(pdf["host"], pdf["html"], pdf["paths"], pdf["constants"], pdf["links"]):
                if host not in kept:
                    kept[host] = tuple(set(map(int, none if x is None else x)) for x in sets)
                texts.append(main_text(page or "", *kept[host]))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    out = both.select("page_id", "url", "host", "html", "paths", "constants", "links").mapInPandas(
        extracted, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast("long"))
