"""Main text of web pages by site template removal (operator 1).

A page is parsed into elements. Each element subtree is hashed (tag, attributes and all it holds), and
Spark counts on how many pages of a host each hash occurs; pages of one content (the same text outside of
useless elements) count as one page, so that copies are no template. Subtrees on more than ``SHARE`` of a
host's pages, and on more than ``LEAST``, are the site's template and are deleted. An ``article`` or
``main`` element is never deleted so, and template hits that would take over half of the page's main block
(near copies of one page), or all of its text, are not followed. On pages without such an element, subtrees outside of
the block that holds most text go by the lower ``OUTER_SHARE`` and ``OUTER_LEAST``: a menu of one section of a large
host is template, a passage that some articles share is not. Elements that say
themselves that they are no article (navigation, footers, forms, scripts and the like, by tag, role or class)
are deleted on any page, since a host with few pages has no counts to go by; some words that an article's own parts may
bear (``WEAK_NAMES``) say nothing inside of an article. Classes and ids count as whole words,
a heading's id not at all, and they never take the page's largest article or, on a page without one, most of its text (reader
comments: all of its text). If what is left holds an ``article`` or ``main`` element with text that is no reader's comment,
text outside of such elements goes too.

What remains is cut into blocks at block elements. Character references are decoded, white
space inside a block becomes one space, and blocks are joined by a line feed in page order.

Edge cases: null or empty html gives an empty text. Tags that are never closed end with their
parent, or where HTML implies it; a stray end tag is ignored; an unfinished comment, script, tag or quoted
attribute runs to the end of the page. Tags, attributes and comments end where the HTML tokenizer ends them, but ``/>`` ends any element.
Hidden elements are text as any other. A null url is a host of its own. Rows that repeat a page_id
are pages of their own. Only page_id, url and html are read. A page of any length is parsed whole, in
time linear in its length.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import IdFilter, store

SHARE, LEAST = 0.5, 3
#: The same outside of the block that holds most of a page's text.
OUTER_SHARE, OUTER_LEAST = 0.05, 10
# Names of HTML elements, roles and usual class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset(
    "script style noscript template title head nav footer aside form button select option textarea input label fieldset "
    "iframe object embed svg math canvas audio video dialog menu".split()
)
NO_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Whole class words and ids; parts of compound names say nothing about what an element holds.
COMMENT_NAMES = frozenset("comment comments commentlist comment-list comments-area comment-respond respond disqus disqus_thread".split())
NO_NAMES = COMMENT_NAMES | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar side-bar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent notice gdpr popup modal newsletter subscribe share social related "
    "widget pagination pager login signup skip-link site-footer site-header page-footer main-nav site-nav top-nav nav-menu main-menu "
    "cookie-banner cookie-notice cookie-consent share-buttons social-share social-links related-posts related-articles "
    "widget-area sidebar-left sidebar-right left-sidebar right-sidebar ad-container ad-banner newsletter-signup".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements above any block of a page, and elements that group blocks.
ROOTS = frozenset("html-root html body".split())
CONTAINERS = frozenset("address aside center details div dl footer header hgroup nav ol section table tbody td tr ul".split())
#: A start tag ends an open element of these names.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: Elements that keep an implied end from reaching further up.
WALLS = frozenset("ul ol dl table select td th article section div body html".split())
#: Class words that say nothing inside of an article; there only the counts decide.
WEAK_NAMES = frozenset("related social share promo widget notice".split())
# The states of the HTML tokenizer, without backtracking: quotes count only after an equals sign, and what is unfinished
# runs to the end of the page.
_ATTRIBUTE_TEXT = r"""[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+)?+)?+"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|</(?![A-Za-z]|\Z)[^>]*+>?"
    rf"|<(/?)([A-Za-z][^ \t\n\f\r/>]*+)((?:[ \t\n\f\r]++|/(?!>)|{_ATTRIBUTE_TEXT})*+)(?:(/?)>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+("[^"]*+"?+|'[^']*+'?+|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+)?+)?+"""
)
#: Only attributes that hold one of these words are read.
_NAMING = re.compile(r"class|id|role", re.I)


@dataclass
class Element:
    tag: str
    attributes: str = ""
    role: str = ""
    names: frozenset[str] = frozenset()  # class words and the id; a heading's id is an anchor, not a name
    children: list = field(default_factory=list)  # elements and strings
    digest: int = 0
    size: int = 0  # characters of text, without elements of NO_TEXT
    best: int = 0  # size of the largest article or main, itself included


def _element(tag: str, attributes: str) -> Element:
    if not _NAMING.search(attributes):
        return Element(tag, attributes)
    values: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        values.setdefault(name.lower(), references.unescape(value).lower())  # the first of a name counts
    names = values.get("class", "").split()
    if tag not in HEADINGS:
        names += values.get("id", "").split()
    return Element(tag, attributes, values.get("role", ""), frozenset(names))


def parse(page: str) -> Element:
    """The element tree of a page; raw text elements hold their text as one string."""
    root = Element("html-root")
    stack = [root]
    opened: Counter[str] = Counter()  # names on the stack
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at: m.start()])
        at = m.end()
        if m[2] is None or m[4] is None:  # a comment, or a tag that the page's end cuts
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                _close(stack, opened, k)
            continue
        if tag in BLOCKS:
            _imply(stack, opened, tag)
        element = _element(tag, m[3].strip())
        stack[-1].children.append(element)
        if tag in VOID or m[4]:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[ \t\n\f\r/>])", re.I).search(page, at)
            element.children.append(page[at: close.start() if close else n])
            at = close.start() if close else n  # its end tag is read as one of no open element
            continue
        stack.append(element)
        opened[tag] += 1
    return root


def _close(stack: list[Element], opened: Counter[str], k: int) -> None:
    """End the open elements from the k-th on."""
    for e in stack[k:]:
        opened[e.tag] -= 1
    del stack[k:]


def _imply(stack: list[Element], opened: Counter[str], tag: str) -> None:
    """End the open elements that a block's start tag ends: a paragraph, or an item of its kind."""
    ends = ENDS.get(tag, ())
    k = len(stack) - 1
    while k > 0 and (opened["p"] or any(opened[x] for x in ends)):
        own = stack[k].tag
        if own in ends:
            _close(stack, opened, k)
            if tag not in ("tr", "tbody", "tfoot", "thead"):
                return
        elif own == "p":
            _close(stack, opened, k)
        elif own in WALLS and own not in ends or own in BLOCKS and not ends:
            return
        k -= 1


def digest(root: Element) -> list[int]:
    """Hash every subtree that holds anything; returns the distinct hashes, the whole page's left out."""
    found: set[int] = set()
    todo: list[tuple[Element, bool]] = [(root, False)]
    while todo:  # no recursion: a page may nest thousands deep
        e, ready = todo.pop()
        if not ready:
            todo.append((e, True))
            todo += [(c, False) for c in e.children if isinstance(c, Element)]
            continue
        h = xxhash.xxh3_64(f"{e.tag} {e.attributes}")
        full = bool(e.attributes)
        e.size = e.best = 0
        for c in e.children:
            if isinstance(c, Element):
                h.update(c.digest.to_bytes(8, "big", signed=True))
                full = full or c.digest != 0
                e.size += c.size
                e.best = max(e.best, c.best)
            elif not c.isspace():
                text = " ".join(c.split())
                h.update(text)
                e.size += len(text)
                full = True
        if e.tag in NO_TEXT:
            e.size = e.best = 0
        elif e.size and _is_article(e):
            e.best = e.size
        e.digest = int.from_bytes(h.digest(), "big", signed=True) if full else 0
        if full and e.tag not in ("html-root", "html", "body", "head"):
            found.add(e.digest)
    return list(found)


def _is_article(e: Element) -> bool:
    return e.tag in ("article", "main") and not COMMENT_NAMES & e.names


def _useless(e: Element, whole: Element, best: int) -> bool:
    """Whether an element says itself that it is no article; whole is the article around it or the page, best the page's."""
    if e.tag in NO_TEXT:
        return True
    if e.tag in ROOTS or e.tag in ("article", "main") and _is_article(e):
        return False
    if e.role in NO_ROLE:
        return True
    named = NO_NAMES & e.names
    if whole.tag not in ROOTS:
        named -= WEAK_NAMES
    if not named:
        return False
    # a name does not outweigh the page's largest article, or most of the text around; comments may be most of a page
    if e.best and e.best == best:
        return False
    return e.size < whole.size if named & COMMENT_NAMES else 2 * e.size <= whole.size


def _inner(e: Element, root: Element) -> Element | None:
    """The container in an element that holds most of the page's text, unless paragraphs stand beside it."""
    largest = None
    for c in e.children:
        if isinstance(c, str):
            if not c.isspace():
                return None
        elif c.tag in CONTAINERS or c.tag in ROOTS:
            if 2 * c.size > root.size:
                largest = c
        elif c.size and c.tag not in HEADINGS:
            return None
    return largest


def _main_block(root: Element) -> Element:
    """The innermost element that holds most of the page's text; of the ROOTS if no block does."""
    at = root
    while inner := _inner(at, root):
        at = inner
    return at


def _outer(root: Element) -> list[Element]:
    """Elements outside of the main block of a page without article: all of them, or its outermost containers if no block holds most text."""
    if root.best:
        return []
    found, at = [], root
    block = _main_block(root)
    while at is not block:  # down to the block: what stands beside the path
        path = _inner(at, root)
        todo = [c for c in at.children if isinstance(c, Element) and c is not path]
        while todo and path.tag not in ROOTS:
            e = todo.pop()
            found.append(e)
            todo += [c for c in e.children if isinstance(c, Element)]
        at = path
    if block.tag in ROOTS:
        found += [c for c in block.children if isinstance(c, Element) and c.tag in CONTAINERS]
    return [e for e in found if e.size and e.tag not in ROOTS and e.tag not in NO_TEXT]


def _hits_size(e: Element, template: frozenset[int] | set[int], every: bool) -> int:
    """Characters of the outermost template hits in an element; only those that are no containers unless ``every``."""
    total, todo = 0, [e]
    while todo:
        x = todo.pop()
        if x.digest in template and not _is_article(x) and (every or x.tag not in CONTAINERS):
            total += x.size
        elif every or x.digest not in template:
            todo += [c for c in x.children if isinstance(c, Element)]
    return total


def _copied(root: Element, template: frozenset[int] | set[int]) -> tuple[Element | None, bool]:
    """(block, whether) the page's main block, null for its articles, and whether most of it is template hits.

    A page most of whose main block recurs is a near copy, and what recurs is its content.
    """
    if root.best:
        held, todo = [], [root]
        while todo:
            e = todo.pop()
            if _is_article(e):
                held.append(e)
            else:
                todo += [c for c in e.children if isinstance(c, Element)]
        return None, 2 * sum(_hits_size(e, template, True) for e in held) > sum(e.size for e in held)
    block = _main_block(root)
    return block, 2 * _hits_size(block, template, block.tag not in ROOTS) > block.size


def main_text(root: Element, template: frozenset[int] | set[int], outer: frozenset[int] | set[int] = frozenset()) -> str:
    """Blocks of what is left when template and useless subtrees are deleted; ``digest`` must have seen the page.

    outer has subtrees that are template only outside of the main block.
    """
    beside = {id(e) for e in _outer(root) if e.digest in outer} if outer else set()
    text = _text(root, template, beside, *_copied(root, template)) if template or beside else ""
    return text or _text(root, frozenset(), set(), None, False)


def _text(root: Element, template: frozenset[int] | set[int], beside: set[int], block: Element | None, copied: bool) -> str:
    blocks: list[list[str]] = [[]]
    main: list[bool] = [False]
    todo: list = [(root, None, False)]
    while todo:
        e, inside, kept = todo.pop()
        if isinstance(e, str):
            blocks[-1].append(e)
            continue
        if e is None:
            blocks.append([])
            main.append(inside is not None)
            continue
        article = _is_article(e)
        kept = kept or copied and (article or e is block)
        flat = block is not None and block.tag in ROOTS and e.tag in CONTAINERS  # a container beside the copied paragraphs
        hit = e.digest in template and not article and (not kept or flat) or id(e) in beside
        if _useless(e, inside or root, root.best) or hit or e.tag == "header" and not inside:
            if e.tag in BLOCKS:
                blocks.append([])
                main.append(inside is not None)
            continue
        own = e if article else inside
        if e.tag == "br" or e.tag == "wbr":
            blocks[-1].append(" " if e.tag == "br" else "")
        if e.tag in BLOCKS:
            blocks.append([])
            main.append(own is not None)
            todo.append((None, inside, kept))
        todo += [(c, own, kept) for c in reversed(e.children)]
    texts = [" ".join(references.unescape("".join(b)).split()) for b in blocks]
    chosen = [t for t, m in zip(texts, main, strict=True) if t and m] or [t for t in texts if t]
    return "\n".join(chosen)


def _pages(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    named = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host")
    )
    return named.withColumn("row", F.xxhash64("page_id", "url", "html"))  # equal rows hold the same hits


def page_subtrees(pages: DataFrame) -> DataFrame:
    """(row, host, content, subtrees, outer) of each page: hashes of its text, its subtrees, and those outside of its main block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, "html"):
            content, subtrees, outer = [], [], []
            for page in part.column("html").to_pylist():
                root = parse(page or "")
                subtrees.append(np.sort(np.array(digest(root), np.int64)).tobytes())
                outer.append(list({e.digest for e in _outer(root)}))
                content.append(xxhash.xxh3_64(main_text(root, frozenset())).intdigest() - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"), part.column("host"), pa.array(content, pa.int64()), pa.array(subtrees, pa.binary()),
                    pa.array(outer, pa.list_(pa.int64())),
                ],
                ["row", "host", "content", "subtrees", "outer"],
            )

    schema = "row long, host string, content long, subtrees binary, outer array<bigint>"
    return _pages(pages).select("row", "host", "html").mapInArrow(run, schema)


def recurring_subtrees(parsed: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, subtree, everywhere) of the subtrees that recur on a host's distinct contents; if not everywhere, by the outer bar only.

    parsed is what ``page_subtrees`` returns.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # counts of the batch; the row without a subtree counts the contents
            counts: dict[str, Counter] = defaultdict(Counter)
            for name, own in zip(batch.column("host").to_pylist(), batch.column("subtrees").to_pylist(), strict=True):
                counts[name].update([None, *np.frombuffer(own, np.int64).tolist()])
            rows = [(name, subtree, n) for name, held in counts.items() for subtree, n in held.items()]
            host, subtree, n = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(subtree, pa.int64()), pa.array(n, pa.int64())], ["host", "subtree", "n"]
            )

    # one page stands for all of its host with the same content
    contents = parsed.groupBy("host", "content").agg(F.min("subtrees").alias("subtrees")).select("host", "subtrees")
    counts = contents.mapInArrow(spread, "host string, subtree long, n long").groupBy("host", "subtree").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("subtree").isNull(), F.col("n")))
    several = counts.where((F.col("n") > min(least, OUTER_LEAST)) | F.col("subtree").isNull())
    sizes = several.groupBy("host").agg(total.alias("pages"))
    everywhere = (F.col("n") > least) & (F.col("n") > share * F.col("pages"))
    outer = (F.col("n") > OUTER_LEAST) & (F.col("n") > OUTER_SHARE * F.col("pages"))
    often = several.where("subtree is not null").join(sizes, "host").where(everywhere | outer)
    return often.select("host", "subtree", everywhere.alias("everywhere"))


def _lists(recurring: DataFrame) -> DataFrame:
    """(host, template) of the subtrees that are template everywhere.

    A host's list is short whatever its size: the subtrees on over half of its pages are at most
    twice as many as a page has on average.
    """
    return recurring.where("everywhere").groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("template"))


def template_subtrees(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, template): hashes of the subtrees on more than ``share`` of a host's distinct contents."""
    return _lists(recurring_subtrees(page_subtrees(pages), share, least))


def _outer_hits(parsed: DataFrame, recurring: DataFrame) -> DataFrame:
    """(row, beside) of the pages that hold recurring subtrees outside of their main block.

    The list of such subtrees may be long, so it is not held by host: its rows are joined to those of the pages.
    """
    own = parsed.select("row", "host", F.explode("outer").alias("subtree"))
    hits = own.join(recurring.select("host", "subtree"), ["host", "subtree"])
    return hits.groupBy("row").agg(F.collect_set("subtree").alias("beside"))


def extract(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(page_id, url, text, n_chars, n_template) of every row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, "html"):
            text, held = [], []
            for page, template, beside in zip(*(part.column(c).to_pylist() for c in ("html", "template", "beside")), strict=True):
                root = parse(page or "")
                own = set(digest(root))
                known, outer = own.intersection(template or ()), own.intersection(beside or ())
                text.append(main_text(root, known, outer))
                held.append(len(known | outer))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"), part.column("url"), pa.array(text, pa.string()),
                    pa.array([len(t) for t in text], pa.int64()), pa.array(held, pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars", "n_template"],
            )

    spark = pages.sparkSession
    parsed = store(spark, page_subtrees(pages), "subtrees")
    recurring = store(spark, recurring_subtrees(parsed, share, least), "templates")
    hits = store(spark, _outer_hits(parsed, recurring), "beside")
    held = IdFilter(spark, hits, "row")
    keyed = _pages(pages).withColumn("key", IdFilter.key("row"))

    def sieve(wanted: bool) -> DataFrame:
        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(held.may_hold(batch.column("key").to_numpy(zero_copy_only=False)) == wanted))

        return keyed.mapInArrow(some, keyed.schema)

    # only pages that may have hits outside of their main block are shuffled to them
    names = ["page_id", "url", "html", "host", "beside"]
    beside = sieve(True).join(hits, "row", "left").select(names)
    alone = sieve(False).withColumn("beside", F.lit(None).cast("array<bigint>")).select(names)
    templates = _lists(recurring).withColumnRenamed("host", "site")
    joined = beside.unionByName(alone).join(templates, F.col("host") == F.col("site"), "left")
    joined = joined.select("page_id", "url", "html", "template", "beside")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_template long")
