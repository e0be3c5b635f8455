"""Main text of HTML pages by two-pass block rules.

The page is cut into blocks at block-level tags. Blocks in menus, headers, footers, sidebars, notices, adverts, forms
and comments (by tag, role, class or id) are bad; in an element with a hint of mere layout half the links suffice. The first pass classifies the others by length, link density and
stop-word density as good, bad, nearly good or short; inside an article or main element text counts as good whatever
its words. The second pass gives nearly good and short blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from vigiframe.llm.common import map_batches
from vigiframe.llm.features import stop_words

# Element names and the words in class, id and role that mark what isn't main text.
SKIPPED = frozenset("script style head nav footer aside form noscript iframe template svg math button select textarea object canvas audio video dialog menu".split())
BLOCK_TAGS = frozenset("""address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hr html legend li main ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie
cookies consent disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo related
respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
CONTAINERS = frozenset(("article", "main"))
# Words that may stand beside a hint word in a compound ("cookie-notice", "ad-top", "site-footer") without changing it. In
# a compound with any other word ("social-policy", "search-results") the hint may be part of the page's subject: it
# only halves the links a block may have.
NEUTRAL = frozenset("""area bar block body bottom box button buttons col column container floating foot global group head home icon icons inner item items
left list main middle mobile outer page panel post primary right row secondary section site small sticky sub the tool tools top wrap wrapper""".split())
# A hint word after one of these says how the page is laid out, not what the element holds; so does a hint beside a
# class or id made of wrapper words only.
STATES = frozenset("has no with without".split())
WRAPPERS = frozenset("content main article post entry story page".split())
# Elements that may stay unclosed: the start tags that end one, and the elements that shield such tags inside it.
_ROWS = frozenset("tr tbody thead tfoot".split())
UNCLOSED = {"p": (BLOCK_TAGS, frozenset()), "li": (frozenset(("li",)), frozenset(("ul", "ol"))), "tr": (_ROWS, frozenset(("table",))),
            **{x: (frozenset(("dd", "dt")), frozenset(("dl",))) for x in ("dd", "dt")},
            **{x: (_ROWS | {"td", "th"}, frozenset(("table",))) for x in ("td", "th")}, "option": (frozenset(("option", "optgroup")), frozenset())}
LONG, SHORT = 200, 70           # characters
STOP_HIGH, STOP_LOW = 0.30, 0.15
LINKS, LINKS_INSIDE = 0.33, 0.66  # share of linked characters that makes a block bad, outside and inside a container

# Scripts written without spaces between words: Thai to Burmese, Khmer, kana, Chinese characters.
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
UNSPACED_SHARE, UNSPACED_LENGTH = 0.5, 3    # share of such characters that makes a text unspaced; how many others one of them stands for

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_ENDS = {x: re.compile(rf"</{x}(?=[\s>/])", re.I) for x in ("script", "style")}
_IN_TAG = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)


def tokens(page: str):
    """Comments, scripts, styles and tags of a page: (start, end, name, whether it is an end tag, attributes); the name
    is empty where there is nothing to look at.

    Every search that found nothing is not made again further on, and a tag that, its quotes heeded, never ends puts an
    end to the heeding of quotes, so the time is linear in the page's length whatever it holds.
    """
    absent: dict[str, bool] = {}
    quotes, at, size = True, 0, len(page)

    def find(mark: str, start: int) -> int:
        if absent.get(mark):
            return -1
        found = page.find(mark, start)
        absent[mark] = found < 0
        return found

    while (i := page.find("<", at)) >= 0:
        if page.startswith("<!--", i):
            end = find("-->", i + 4)
            at = size if end < 0 else end + 3
            yield i, at, "", False, ""
            continue
        if page.startswith("<![CDATA[", i) and (end := find("]]>", i)) >= 0:
            at = end + 3
            yield i, at, "", False, ""
            continue
        ends = page.startswith("/", i + 1)
        m = _NAME.match(page, i + 1 + ends)
        if m is None:
            end = find(">", i) if page[i + 1:i + 2] in ("/", "!", "?") and i + 1 < size else -1
            at = i + 1 if end < 0 else end + 1
            if end >= 0:
                yield i, at, "", False, ""
            continue
        end, close = -1, m.end()
        while quotes and not absent.get(">") and (mark := _IN_TAG.search(page, close)):
            if mark[0] == ">":
                end = mark.start()
                break
            close = page.find(mark[0], mark.end()) + 1
            if not close:
                break
        if end < 0:
            quotes = False                          # looked at to the end of the page in vain
            end = find(">", m.end())
        if end < 0:                                 # no tag ends any more: the rest is text
            at = i + 1
            continue
        name, at = m[0].lower(), end + 1
        if name in _ENDS and not ends:
            over = None if absent.get(name) else _ENDS[name].search(page, at)
            absent[name] = over is None
            shut = find(">", over.end()) if over else -1
            at = size if shut < 0 else shut + 1
            yield i, at, "", False, ""
            continue
        yield i, at, name, ends, page[m.end():end]


@dataclass
class Block:
    text: str
    tag: str
    inside: bool        # in an article or main element
    linked: int         # characters in links
    doubted: bool       # in an element with a hint of layout
    label: str = ""


def _hinted(attributes: str, inside: bool) -> str:
    """hard: the element isn't main text; soft: only a hint of layout; else empty. Header hints don't count inside a container."""
    if not attributes:
        return ""
    values = [(name.lower(), value.strip("\"'").lower()) for name, value in _ATTRIBUTE.findall(attributes)]
    if any(n == "hidden" or n == "aria-hidden" and v == "true" or n == "style" and _NONE.search(v) for n, v in values):
        return "hard"
    names = [re.split(r"[^a-z0-9]+", x) for n, value in values if n in ("class", "id", "role") for x in value.split()]
    hard = soft = wrapper = False
    for words in names:
        wrapper = wrapper or all(w in WRAPPERS for w in words)
        alone = all(w in HINTS or w in NEUTRAL or w in STATES or w.isdigit() or not w for w in words)
        for before, w in zip(["", *words], words):
            if w in HINTS and not (inside and w == "header"):
                state = before in STATES or not alone
                hard, soft = hard or not state, soft or state
    return "hard" if hard and not wrapper else "soft" if hard or soft else ""


def blocks_of(page: str) -> list[Block]:
    """The blocks with text that aren't in a skipped element, in page order, references decoded, white space single."""
    out: list[Block] = []
    parts, linked, tag = [], 0, ""
    containers = links = 0
    skip, depth = "", 0     # the skipped element that is open, and how many of its name are open in it
    inner: Counter = Counter()  # what is open in a skipped element that may stay unclosed
    doubt, doubts = "", 0   # the outermost element with a hint of layout, and how many of its name are open in it

    def close() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tag, containers > 0, min(linked, len(text)), bool(doubt)))
        parts, linked = [], 0

    at = 0
    for start, end, name, ends, attributes in tokens(page):
        if at < start and not skip:
            piece = page[at:start]
            parts.append(piece)
            linked += len(html.unescape(piece).strip()) if links else 0
        at = end
        if not name:
            continue
        empty = name in VOID or attributes.endswith("/")
        if skip in UNCLOSED:
            siblings, shields = UNCLOSED[skip]
            over = False
            if not ends:
                over = name in siblings and not any(inner[x] for x in shields) or name == "body"
                inner[name] += not empty
            elif inner[name]:
                inner[name] -= 1
                if name in shields and not inner[name]:
                    for x in (skip, *siblings):  # unclosed ones of the nested list or table
                        inner[x] = 0
            elif name == skip:
                skip = ""
                continue
            else:  # the end of an element around the skipped one
                over = name in BLOCK_TAGS and name not in UNCLOSED or name in SKIPPED or name in CONTAINERS or name in ("body", "html") or name in siblings and skip != "p" and name != "p"
            if not over and not (name in CONTAINERS and not ends):
                continue
            skip = ""
        if skip:
            if name == skip and not empty:
                depth += -1 if ends else 1
                if not depth:
                    skip = ""
                    continue
            # A skipped element that was never closed ends where an article begins or ends, or the body begins.
            if not (name in CONTAINERS and (not ends or containers)) and name != "body":
                continue
            skip = ""
        if name in BLOCK_TAGS or name in SKIPPED:
            close()
            tag = "" if ends else name
        if name == doubt and not empty:
            doubts += -1 if ends else 1
            doubt = doubt if doubts else ""
        hint = "" if ends or empty or name in ("html", "body") else _hinted(attributes, containers > 0)
        if name in CONTAINERS:
            containers = max(0, containers + (-1 if ends else 1))
        elif not ends and not empty and (name in SKIPPED or name == "header" and not containers or hint == "hard"):
            close()
            skip, depth, inner = name, 1, Counter()
        elif name == "a":
            links = 0 if ends else 1
        elif name == "br":
            parts.append(" ")
        if hint == "soft" and not skip and not doubt:
            close()
            doubt, doubts = name, 1
    if at < len(page) and not skip:
        parts.append(page[at:])
    close()
    return out


def first_pass(block: Block) -> str:
    """good, bad, near (nearly good) or short; plain: bad for its words alone, which may be of a language without a list.

    A text in a script without spaces has no words to count: its length and links decide."""
    n, density = len(block.text), block.linked / len(block.text)
    unspaced = len(_UNSPACED.findall(block.text))
    whole = unspaced >= UNSPACED_SHARE * n
    n += unspaced * (UNSPACED_LENGTH - 1)
    if density > (LINKS_INSIDE if block.inside else LINKS) / (2 if block.doubted else 1):
        return "bad"
    if block.inside:
        return "good" if n >= SHORT else "short"
    words = block.text.lower().split()
    stops = stop_words(words) / len(words)
    if n < SHORT:
        return "bad" if block.linked else "short"
    if whole:
        return "good" if n > LONG else "near"
    if stops >= STOP_HIGH:
        return "good" if n > LONG else "near"
    return "near" if stops >= STOP_LOW else "plain" if n > LONG else "bad"


def second_pass(blocks: list[Block]) -> None:
    """Labels good or bad for the undecided blocks from the nearest decided ones before and after.

    Inside a container only its own neighbours count, and a block without any is good. Outside, the page's edges count
    as bad; a nearly good block needs one good neighbour, a short one two, and a heading only the one after it.
    """
    decided = [b.label if b.label in ("good", "bad") else "" for b in blocks]
    before, after, last = [], [""] * len(blocks), ""
    for i, b in enumerate(blocks):
        if i and blocks[i - 1].inside != b.inside:
            last = ""
        before.append(last)
        last = decided[i] or last
    last = ""
    for i in range(len(blocks) - 1, -1, -1):
        if i + 1 < len(blocks) and blocks[i + 1].inside != blocks[i].inside:
            last = ""
        after[i] = last
        last = decided[i] or last
    for b, left, right in zip(blocks, before, after, strict=True):
        if b.label in ("good", "bad"):
            continue
        near = {x for x in (left, right) if x}
        if b.inside:
            good = not near or "good" in near
        elif b.label == "near":
            good = "good" in near
        else:
            good = near == {"good"} and left == right or right == "good" and b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        b.label = "good" if good else "bad"


def main_text(page: str | None) -> tuple[str, int]:
    """The main text of a page, its good blocks joined by one space, and their number.

    If no block is good, nearly good blocks stand in, and if there are none of these, long blocks without a stop word; a
    null or empty page has an empty text.
    """
    blocks = blocks_of(page or "")
    for b in blocks:
        b.label = first_pass(b)
    near, plain = ([b for b in blocks if b.label == x] for x in ("near", "plain"))
    for b in plain:
        b.label = "bad"
    second_pass(blocks)
    good = [b for b in blocks if b.label == "good"] or near or plain
    return " ".join(b.text for b in good), len(good)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, n_blocks)`` per row of ``pages(page_id, url, html)``, repeated rows included.

    Every page is parsed for itself and whole; other columns are not looked at, an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            found = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t for t, _ in found], pa.string()),
                                              pa.array([len(t) for t, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint")
