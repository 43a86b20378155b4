"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass one labels what the
structure and three densities decide: blocks in menus, headers, footers,
sidebars, notices, adverts, forms and reader comments are bad, and so are
blocks that stand outside the article of a page that marks one; link-dense
lists are bad; blocks rich in stop words, and long ones with some, are good.
Others stay open, and pass two gives them the label of the nearest decided
neighbour, inside the article if there is one; a long one is dropped only
between bad neighbours.  On a page without any good
block (a language that the list does not know) long open blocks are good, and
without those all open ones that are not links.

Names of classes and ids, and forms, may speak for a whole page: such an
element is left aside where it holds the only marked article, or, in a page
that marks none, most of the good text.

Every page is one row of a map, so nothing is shuffled.  NULL and empty pages
have an empty text; repeated rows are repeated; other columns are left alone;
broken markup never fails: unknown, unclosed and stray tags are tolerated.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from larkspur.llm.common import map_texts, without

# A quotation mark opens a value only behind an equals sign.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)(?:>|\Z)""", re.S)
HINT = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# HTML element names by their role.
RAW = frozenset("script style textarea title noscript noembed noframes xmp iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = frozenset("head nav footer aside menu select button dialog template svg canvas object audio video math search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role names of what is no article text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs header masthead topbar footer contentinfo sidebar aside complementary widget widgets "
    "notice notices cookie cookies consent gdpr popup modal overlay dialog alert newsletter subscribe subscription signup "
    "login search share sharing social comment comments commentlist disqus reply replies respond related recommended "
    "pagination pager toolbar toc skip".split())
HEADER_HINTS = frozenset("header masthead topbar banner".split())
MAIN_HINTS = frozenset("main articlebody".split())
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have in is it of on or that the this to was were which with "
    "auf aus das dem den der des die ein eine für ist im mit nicht sich sie und von zu "
    "au aux avec ce dans de des du elle est et la le les ne pas par pour que qui se sur un une "
    "al como con del el en es esta la las lo los más no para por que se su sus un una y".split())

# Settings of the rules.
LONG, STOP_SHARE, LONG_STOP_SHARE, LINK_SHARE = 70, 0.25, 0.06, 0.5
# Shares of the good text that an element holds to speak for the page: with its main heading, and without.
MOST, NEARLY_ALL = 0.5, 0.75


def _hints(attributes: str, hints: frozenset) -> tuple[bool, bool, bool]:
    """Whether attributes hide an element, name something outside the text, or name the main part."""
    hidden = outside = main = False
    if "=" in attributes or "hidden" in attributes:
        for name, value in HINT.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                hidden = True
            words = {w.lower() for w in CAMEL.findall(value)}
            outside = outside or bool(words & hints)
            main = main or (name in ("role", "itemprop") and value.lower() in MAIN_HINTS)
    return hidden, outside, main


class _Page:
    """Blocks ``(text, link characters, links, tag, cause, in article)`` of a page.

    ``cause`` numbers the innermost open element that would drop the block
    (0: none); ``parent`` gives the next one around each, ``firm`` whether its
    tag says so, not a name.
    """

    def __init__(self, page: str):
        self.found: list[tuple] = []
        self.parent, self.firm = [0], [False]
        self._read(page)

    def _read(self, page: str) -> None:
        parts: list[tuple[str, bool]] = []
        stack: list[tuple] = []  # (tag, cause before it, in article) of open elements
        block_places: list[int] = []  # where block elements stand in it
        open_tags: Counter = Counter()
        cause = article = links = 0
        at, end = 0, len(page)

        def close_block() -> None:
            nonlocal links
            if parts:
                text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
                if text:
                    linked = len(" ".join(html.unescape("".join(p if is_link else " " for p, is_link in parts)).split()))
                    tag = stack[block_places[-1]][0] if block_places else ""
                    self.found.append((text, linked, links, tag, cause, article > 0))
                parts.clear()
            links = 0

        def pop() -> None:
            nonlocal cause, article
            tag, before, inside = stack.pop()
            if block_places and block_places[-1] == len(stack):
                block_places.pop()
            cause = before
            article -= inside
            open_tags[tag] -= 1

        while at < end:
            match = TAG.search(page, at)
            if match is None:
                parts.append((page[at:], open_tags["a"] > 0))
                break
            if match.start() > at:
                parts.append((page[at:match.start()], open_tags["a"] > 0))
            at = match.end()
            tag = (match[2] or "").lower()
            if not tag:
                continue
            if match[1]:
                if open_tags[tag]:
                    if tag in BLOCK:
                        close_block()
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = closing.end() if closing else end
                continue
            if tag == "br":
                parts.append((" ", open_tags["a"] > 0))
            if tag in BLOCK:
                close_block()
                # A block ends an open paragraph; items and cells end their like.
                ends = ENDS.get(tag, ENDS["p"])
                while block_places and stack[block_places[-1]][0] in ends:
                    keep = block_places[-1]
                    while len(stack) > keep:
                        pop()
            if tag in VOID or match[3].endswith("/") and tag not in BLOCK and tag != "a":
                continue
            hidden, out, main = _hints(match[3], HINTS - HEADER_HINTS if article else HINTS)
            inside = tag in ("article", "main") or main
            whole = tag in ("html", "body") or (tag in ("article", "main") and main)
            # A header inside an article is part of it, by tag and by name.
            firm = tag in OUTSIDE or (tag == "header" and not article) or (hidden and not whole)
            before = cause
            if firm or tag == "form" or (out and not whole):
                self.parent.append(cause)
                self.firm.append(firm)
                cause = len(self.parent) - 1
            if tag in BLOCK:
                block_places.append(len(stack))
            stack.append((tag, before, inside))
            article += inside
            open_tags[tag] += 1
            if tag == "a":
                links += 1
        close_block()

    def _held(self, amounts: Iterable[tuple[int, float]]) -> list[float]:
        """For each cause, the sum of the amounts of blocks anywhere inside it."""
        held = [0.0] * len(self.parent)
        for cause, amount in amounts:
            held[cause] += amount
        for cause in range(len(held) - 1, 0, -1):
            held[self.parent[cause]] += held[cause]
        return held

    def _dropped(self, left_aside: list[bool]) -> list[bool]:
        """For each cause, whether blocks in it are outside, if some causes are left aside."""
        dropped = [False]
        for cause in range(1, len(self.parent)):
            dropped.append(dropped[self.parent[cause]] or not left_aside[cause])
        return dropped

    def blocks(self) -> list[tuple]:
        """Blocks as ``(text, link characters, links, tag, outside, in article)``."""
        named = [False] + [not firm for firm in self.firm[1:]]
        strict, firm = self._dropped([False] * len(named)), self._dropped(named)
        marked = [b for b in self.found if b[5]]
        if any(named) and not any(not strict[b[4]] for b in marked):
            inner = [b for b in marked if not firm[b[4]]] or [b for b in self.found if not firm[b[4]] and (
                decide((*b[:4], False, False), False) or len(b[0]) >= LONG and b[1] <= LINK_SHARE * len(b[0]))]
            held = self._held((b[4], len(b[0])) for b in inner)
            every = self._held((b[4], len(b[0])) for b in self.found if not firm[b[4]])
            titles = self._held((b[4], 1) for b in self.found if b[3] == "h1" and not firm[b[4]])
            speaks = [n and held[0] > 0 and every[c] > MOST * every[0] and (
                held[c] > NEARLY_ALL * held[0] or (held[c] > MOST * held[0] and titles[c] > 0)) for c, n in enumerate(named)]
            strict = self._dropped(speaks)
        return [(*b[:4], strict[b[4]], b[5] and not strict[b[4]]) for b in self.found]


# Open elements that a block element ends, by its tag.
ENDS = {"p": {"p"}, "li": {"p", "li"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tr": {"p", "tr", "td", "th"},
        "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "option": {"p", "option"}}


def decide(block: tuple, marked: bool) -> bool | None:
    """Pass one: good, bad, or open."""
    text, linked, links, tag, outside, inside = block
    if outside or (marked and not inside):
        return False
    share = linked / len(text)
    if share > LINK_SHARE:
        return False if links > 1 or tag == "li" or not inside else None
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words)
    return stops >= (LONG_STOP_SHARE if len(text) >= LONG else STOP_SHARE) * len(words) or None


def main_text(page: str | None) -> str:
    """The article of a page, one line per block."""
    found = _Page(page or "").blocks()
    marked = any(b[5] for b in found)
    labels = [decide(b, marked) for b in found]
    for least in (LONG, 1):
        if not any(labels):
            labels = [True if good is None and len(b[0]) >= least and b[1] <= LINK_SHARE * len(b[0]) else good
                      for good, b in zip(labels, found)]
    n, never = len(found), len(found) + 1
    # Distance to and label of the nearest decided block on either side; where
    # the page marks its article, only neighbours inside it count.
    def nearest(places):
        out, seen, label = {}, None, None
        for i in places:
            if labels[i] is not None and not (marked and not found[i][5]):
                seen, label = i, labels[i]
            out[i] = (abs(i - seen), label) if seen is not None else (never, None)
        return out

    before, after = nearest(range(n)), nearest(range(n - 1, -1, -1))
    kept = []
    for i, block in enumerate(found):
        good = labels[i]
        if good is None:
            (far, left), (near, right) = before[i], after[i]
            if len(block[0]) >= LONG and block[1] <= LINK_SHARE * len(block[0]):
                good = bool(left or right)
            elif block[3] in HEADINGS and right is not None:
                good = right
            elif far == near:
                good = bool(left or right) if far != never else block[5]
            else:
                good = left if far < near else right
        if good:
            kept.append(block[0])
    return "\n".join(kept)


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the raw column, with ``text`` and ``n_chars`` (code points).

    Columns of ``pages`` with these names are replaced.
    """
    kept = without(pages, ["text", "n_chars", html_col])
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column("_page")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:-2]), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_texts(pages.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(html_col).alias("_page")), extract, schema)
