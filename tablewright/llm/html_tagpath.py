"""Main text of web pages by tag-path ratios.

A page is read tag by tag into blocks (headings, paragraphs, list items, table
rows, ...), each under its root-to-leaf path of tags with their first class.
Per path, text length outside links and punctuation are added up over its
blocks. A path's ratio, text per block with its share of punctuation, is fused
with the path's whole text; the page-order sequence of blocks is smoothed with
Gaussian weights among blocks of one container; paths whose mean falls below a
share of the best are not content, and neither is a path that is links alone.
A heading goes with what follows it.

Elements that say what they are decide first: menus, page headers and footers,
asides, forms, scripts, hidden parts, and classes, ids or roles that name
menus, sidebars, adverts, notices or reader comments hold no content (unless
such a class stands on a wrapper of the article itself). Where a page has an
``article`` (else ``main``) with text, its other blocks are content unless
their path's ratio is near nothing; without one the ratios choose among all
blocks, with the stricter share.

Nulls and edges: a null or empty page and one without content give an empty
text; unclosed and misnested tags are closed as browsers do in common cases, a
tag cut off by the end of the page ends it; a null ``page_id`` and repeated
rows are kept, a row each; an empty table gives an empty result; other columns
are not read. Work per page is linear in its length.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready

#: Share of the best path that a path needs, in an article and elsewhere.
IN_ARTICLE = 0.02
ELSEWHERE = 0.5
#: Gaussian weights of a block's neighbours up to this distance.
REACH = 2
WEIGHTS = [math.exp(-(k * k) / 2) for k in range(REACH + 1)]

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe noembed noframes xmp template svg".split())
CELLS = frozenset(("td", "th"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: Elements that begin and end blocks; all others, unknown ones too, stand
#: within a block.
BLOCKS = ENDS_P | frozenset("html head body li dt dd tr td th thead tbody tfoot caption legend option optgroup select button object".split())
#: Start tags that end an open element of the named kinds, up to a parent.
ENDS_LIKE = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
SCOPE = frozenset("html table td th caption button object".split())
CONTAINERS = frozenset("body article main section div td".split())

#: Elements without content of the article.
BOILERPLATE = frozenset("head nav aside footer button select dialog menu search object audio video canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead topbar share sharing social related recommended newsletter subscribe "
    "subscription signup login widget popup modal overlay toolbar pagination pager form".split()
)

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
OTHER_MARKUP = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|[!?/][^>]*+(?:>|\Z))", re.S)
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"""[.,;:!?…。，、；：！？"'“”„«»()]""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Flag:
    """A class, id or form that names a part without content; it does not
    count where the part turns out to wrap the article or a first heading."""

    __slots__ = ("outer", "wraps", "comment")

    def __init__(self, outer, comment: bool):
        self.outer, self.comment, self.wraps = outer, comment, False

    def holds(self) -> bool:
        flag = self
        while flag is not None and flag.wraps:
            flag = flag.outer
        return flag is not None


class Element:
    __slots__ = ("tag", "path", "out", "flag", "home", "container", "link", "in_header", "flagged")

    def __init__(self, tag, path, out, flag, home, container, link, in_header, flagged):
        self.tag, self.path, self.out, self.flag, self.home = tag, path, out, flag, home
        self.container, self.link, self.in_header, self.flagged = container, link, in_header, flagged


class Block:
    __slots__ = ("text", "path", "container", "home", "flag", "link", "heading")

    def __init__(self, text, path, container, home, flag, link, heading):
        self.text, self.path, self.container, self.home, self.flag, self.link, self.heading = text, path, container, home, flag, link, heading


class Reader:
    """The blocks of a page outside of parts that never hold content."""

    def __init__(self):
        self.paths: dict[tuple, int] = {}
        self.stack = [Element("", 0, False, None, "", 0, False, False, False)]
        self.open: Counter = Counter()
        self.blocks: list[Block] = []
        self.parts: list[tuple[str, bool]] = []
        self.owner: Element | None = None
        self.containers = 0

    def read(self, page: str) -> list[Block]:
        at, end = 0, len(page)
        while at < end:
            lt = page.find("<", at)
            if lt < 0:
                self.text(page[at:])
                break
            if lt > at:
                self.text(page[at:lt])
            tag = TAG.match(page, lt)
            if tag:
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self.end(name)
                elif name in RAW:
                    close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                    at = close.end() if close else end
                else:
                    self.start(name, tag[3])
                continue
            other = OTHER_MARKUP.match(page, lt)
            if other:
                at = other.end()
            elif page[lt + 1 : lt + 2].isalpha() and page[lt + 1].isascii():
                break  # the page ends within a tag
            else:
                self.text("<")
                at = lt + 1
        self.flush()
        return self.blocks

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.out:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append((text, top.link))
        if self.owner is None and not text.isspace():
            self.owner = top

    def flush(self) -> None:
        """Ends the block that is being read."""
        if self.owner is not None:
            text = " ".join("".join([p for p, _ in self.parts]).split())
            if text:
                link = sum(len("".join(p.split())) for p, linked in self.parts if linked)
                at = self.owner
                heading = any(self.open[h] for h in HEADINGS)
                if heading or not at.in_header:
                    self.blocks.append(Block(text, at.path, at.container, at.home, at.flag, link, heading))
        self.parts, self.owner = [], None

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.parts.append(("\n", False))
            elif tag == "hr":
                self.close_p()
                self.flush()
            return
        if tag in ENDS_P:
            self.close_p()
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.pop_to(len(self.stack) - 1)
        if tag in ENDS_LIKE:
            self.close_like(*ENDS_LIKE[tag])
        if tag in CELLS:
            self.parts.append((" ", False))
        elif tag in BLOCKS:
            self.flush()
        up = self.stack[-1]
        names = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
        first = names.get("class", "").split()[:1]
        step = (up.path, tag, *first)
        path = self.paths.setdefault(step, len(self.paths) + 1) if tag in BLOCKS else up.path
        out = up.out or tag in BOILERPLATE or "hidden" in names or names.get("aria-hidden") == "true"
        out = out or names.get("role", "").lower() in ROLES or bool(HIDDEN.search(names.get("style", "")))
        words = {w.lower() for k in ("class", "id") if k in names for w in WORD_PARTS.findall(names[k])} & WORDS
        home = up.home
        comment = bool(words & COMMENT_WORDS)
        if tag in ("article", "main") and not words and home != "article":
            home = tag
            for e in self.stack:  # what wraps an article is not what its class says
                if e.flagged and not e.flag.comment:
                    e.flag.wraps = True
        in_header = up.in_header
        if tag == "header":
            out, in_header = out or not home, True
        if home and not up.out:
            words -= {"header"}
        if tag == "form":
            words = words | {"form"}
        if tag == "h1":
            for e in self.stack:
                if e.flagged and not e.flag.comment:
                    e.flag.wraps = True
        flagged = bool(words) and tag not in ("html", "body")
        flag = Flag(up.flag, comment) if flagged else up.flag
        if tag in CONTAINERS:
            self.containers += 1
        container = self.containers if tag in CONTAINERS else up.container
        self.stack.append(Element(tag, path, out, flag, home, container, up.link or tag == "a", in_header, flagged))
        self.open[tag] += 1

    def end(self, tag: str) -> None:
        if tag in HEADINGS:
            tag = next((h for h in HEADINGS if self.open[h]), tag)
        if not self.open[tag]:
            if tag in ("p", "br"):
                self.flush() if tag == "p" else self.parts.append(("\n", False))
            return
        k = len(self.stack) - 1
        while self.stack[k].tag != tag:
            if tag not in BLOCKS and self.stack[k].tag in BLOCKS:
                # misnested: the blocks opened inside stay open
                while self.stack[k].tag != tag:
                    k -= 1
                del self.stack[k]
                self.open[tag] -= 1
                return
            if self.stack[k].tag in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return
            k -= 1
        self.pop_to(k)

    def pop_to(self, k: int) -> None:
        gone = self.stack[k:]
        if any(e.tag in BLOCKS and e.tag not in CELLS for e in gone):
            self.flush()
        elif any(e.tag in CELLS for e in gone):
            self.parts.append((" ", False))
        for e in gone:
            self.open[e.tag] -= 1
        del self.stack[k:]

    def close_p(self) -> None:
        if self.open["p"]:
            self.close_like(("p",), SCOPE)

    def close_like(self, kinds, parents) -> None:
        """Closes the outermost open element of ``kinds`` above ``parents``."""
        if not any(self.open[t] for t in kinds):
            return
        found = None
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in kinds:
                found = k
            elif self.stack[k].tag in parents:
                break
        if found is not None:
            self.pop_to(found)


def path_scores(blocks: list[Block]) -> dict[int, float]:
    """Score of every path: its ratio fused with its text, smoothed."""
    n, text, signs = Counter(), Counter(), Counter()
    for b in blocks:
        n[b.path] += 1
        text[b.path] += max(len(b.text) - b.link - b.text.count(" "), 0)
        signs[b.path] += len(PUNCTUATION.findall(b.text))
    raw = {p: math.log1p(text[p] / n[p] * (1 + signs[p] / n[p])) * math.log1p(text[p]) for p in n}
    total: Counter = Counter()
    for i, b in enumerate(blocks):
        weight = value = 0.0
        for j in range(max(0, i - REACH), min(len(blocks), i + REACH + 1)):
            if blocks[j].container == b.container:
                weight += WEIGHTS[abs(i - j)]
                value += WEIGHTS[abs(i - j)] * raw[blocks[j].path]
        total[b.path] += value / weight
    # a path that is links alone stays at nothing, whatever is beside it
    return {p: total[p] / n[p] if text[p] else 0.0 for p in n}


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks of the main text, in page order."""
    blocks = [b for b in blocks if b.flag is None or not b.flag.holds()]
    homes = {b.home for b in blocks}
    home = "article" if "article" in homes else "main" if "main" in homes else ""
    if home:
        blocks = [b for b in blocks if b.home == home]
    if not blocks:
        return []
    scores = path_scores(blocks)
    least = max(scores.values()) * (IN_ARTICLE if home else ELSEWHERE)
    content = [scores[b.path] > 0 and scores[b.path] >= least for b in blocks]
    for i in range(len(blocks) - 2, -1, -1):
        if blocks[i].heading:  # with what follows it
            content[i] = content[i + 1] or (content[i] and bool(home))
    if blocks[-1].heading and not home:
        content[-1] = content[-1] and len(blocks) == 1
    return [b for b, c in zip(blocks, content) if c]


def main_text(page: str) -> str:
    """The main text of a page: blocks joined by an empty line."""
    return "\n\n".join(b.text for b in content_blocks(Reader().read(page)))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    python_ready(pages.sparkSession)
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    page_id, url = (read.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return read.mapInArrow(run, f"page_id {page_id}, url {url}, text string, n_chars long")
