"""Main text of web pages: blocks classified in two passes.

A page is cut into blocks of running text at its block-level elements. The first
pass decides blocks by what stands in them: stop-word density, length and link
density. Short or middling ones stay ambiguous. The second pass gives these the
label of their nearest decided neighbours; a heading goes with what follows it.

Elements that say what they are (navigation, forms, asides, hidden parts, names such as
``ad``, ``sidebar`` or ``comments``) are decided by that. Where a page marks its
article, neighbours are sought inside it and what is outside goes.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shorter blocks are ambiguous, blocks from LONG on can be good by themselves.
SHORT, LONG = 70, 200
#: Stop words per word: at least this is running text, at most the other is none.
DENSE, SPARSE = 0.15, 0.05
#: Linked characters per character above which a block is a list of links.
LINKED = 0.33
#: So many stop words of one language on a page, or the page's language is unknown.
KNOWN = 5

# Frequent function words per language.
STOP_WORDS = {
    "en": "the of and to in is that for as with on be this by or from at an it are a was not have has he his they you we".split(),
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par sur pas au avec elle ce il plus ne se son sont aux ou".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya o este fue".split(),
    "it": "di e il la che in un a per è una sono del si non con i le da al dei della come più ma nel gli alla lo anche".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou".split(),
}
# Names of parts that are not the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promoted promotion recommended related replies search share sharing "
    "sidebar signup social sponsor sponsored subscribe teaser toolbar topbar widget".split()
)
# "has-sidebar" or "no-comments" on a wrapper says nothing of the wrapper itself.
ABOUT_OTHERS = frozenset("has with no without".split())
NOT_ARTICLE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NOT_ARTICLE_TAGS = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head label menu nav noscript object option picture "
    "select svg template video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = (
    frozenset(
        "address article blockquote body caption center dd details div dl dt figcaption figure header hgroup html li main "
        "ol pre section summary table tbody td tfoot th thead tr ul".split()
    )
    | HEADINGS
    | NOT_ARTICLE_TAGS
)
BREAKS = frozenset("p hr".split())
# A start tag on the left ends open elements on the right, as far up as one of the last column.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}

_INSIDE = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|textarea|title|iframe|noembed|noframes)(?=[\s/>]){_INSIDE}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>{_INSIDE})>
    |<[!?/][^>]*(?:>|\Z)
    |<[a-zA-Z][^>]*\Z""",
    re.X | re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, AMBIGUOUS = "good", "bad", "ambiguous"


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    #: An element around it says that it is not the article.
    named: bool
    #: Number of the outermost article around it, or 0, and the same for main.
    article: int
    main: int
    words: int = 0
    stops: int = 0
    label: str = ""


@dataclass
class _Open:
    name: str
    named: str
    heading: bool
    article: int
    main: int


@dataclass
class _Cutter:
    """Open elements, and the text since the last block boundary."""

    stack: list = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    blocks: list = field(default_factory=list)
    pieces: list = field(default_factory=list)
    linked: int = 0
    # Number of open elements at which the open link began, or None.
    link: int | None = None
    link_in_p: bool = False
    in_p: bool = False
    articles: int = 0
    mains: int = 0

    def text(self, raw: str) -> None:
        if "&" in raw:
            raw = unescape(raw)
        self.pieces.append(raw)
        if self.link is not None:
            self.linked += sum(map(len, raw.split()))

    def cut(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1] if self.stack else _Open("", "", False, 0, 0)
            self.blocks.append(Block(text, self.linked, top.heading, bool(top.named), top.article, top.main))
        self.pieces, self.linked = [], 0

    def end_p(self) -> None:
        self.in_p = False
        if self.link_in_p:
            self.link, self.link_in_p = None, False

    def pop(self) -> str:
        name = self.stack.pop().name
        self.open[name] -= 1
        if self.link is not None and self.link > len(self.stack):
            self.link = None
        return name

    def start(self, name: str, attributes: str) -> None:
        self.cut()
        self.end_p()
        if name in IMPLIED:
            ended, bounds = IMPLIED[name]
            if any(self.open[e] for e in ended):
                for depth in range(len(self.stack) - 1, -1, -1):
                    if self.stack[depth].name in bounds:
                        break
                    if self.stack[depth].name in ended:
                        while len(self.stack) > depth:
                            self.pop()
        above = self.stack[-1] if self.stack else _Open("", "", False, 0, 0)
        named, article, main = above.named, above.article, above.main
        if name in ("article", "main") and named == "form":
            named = ""  # a form around the whole page
        if not named:
            named = _named(name, attributes, bool(article or main))
        if name == "article" and not article and not named:
            self.articles += 1
            article = self.articles
        if name == "main" and not main and not named:
            self.mains += 1
            main = self.mains
        self.stack.append(_Open(name, named, above.heading or name in HEADINGS, article, main))
        self.open[name] += 1

    def end(self, name: str) -> None:
        if self.open[name] > 0:
            self.cut()
            self.end_p()
            while self.pop() != name:
                pass


def _named(name: str, attributes: str, inside: bool) -> str:
    """What says that an element is not the article, or ''."""
    if name in NOT_ARTICLE_TAGS or name == "header" and not inside:
        return name
    if not attributes or attributes.isspace() or name in ("html", "body"):
        return ""
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), unescape("".join(values))
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return "hidden"
        if key == "role" and value.lower() in NOT_ARTICLE_ROLES:
            return value.lower()
        if key in ("class", "id"):
            for one in value.split():
                parts = {part.lower() for part in _NAME.findall(one)}
                if parts & NOT_ARTICLE and not parts & ABOUT_OTHERS:
                    return one
    return ""


def cut(html: str) -> list[Block]:
    """Blocks of a page in order, not yet labelled."""
    page, done = _Cutter(), 0
    for token in _TOKEN.finditer(html):
        if token.start() > done:
            page.text(html[done : token.start()])
        done = token.end()
        name = token["name"]
        if name is None:
            continue
        name, end = name.lower(), bool(token["end"])
        if name == "a":
            page.link, page.link_in_p = (None, False) if end else (len(page.stack), page.in_p)
        elif name == "br":
            page.text(" ")
        elif name in BREAKS:
            page.cut()
            page.end_p()
            page.in_p = name == "p" and not end
        elif name in CONTAINERS:
            page.end(name) if end else page.start(name, token["attributes"])
    if done < len(html):
        page.text(html[done:])
    page.cut()
    return page.blocks


def _count_stops(blocks: list[Block]) -> bool:
    """Sets words and stops by the language with most stop words on the page; False if none is known."""
    words = [[w.lower() for w in _WORD.findall(b.text)] for b in blocks]
    counts = Counter(w for ws in words for w in ws)
    hits = {lang: sum(counts[w] for w in stops) for lang, stops in STOP_WORDS.items()}
    best = max(hits, key=hits.get)
    stops = frozenset(STOP_WORDS[best]) if hits[best] >= KNOWN else frozenset()
    for block, ws in zip(blocks, words):
        block.words, block.stops = len(ws), sum(w in stops for w in ws)
    return bool(stops)


def _reads(block: Block, density: float) -> bool:
    return block.words > 0 and block.stops >= density * block.words


def _first_pass(block: Block, known: bool) -> str:
    length = len(block.text)
    if block.named or "©" in block.text or block.linked > LINKED * length:
        return BAD
    if length < SHORT or block.heading:
        return AMBIGUOUS
    if not known:
        return GOOD if length >= LONG else AMBIGUOUS
    if _reads(block, DENSE):
        return GOOD if length >= LONG else AMBIGUOUS
    if not block.article and not _reads(block, SPARSE):
        return BAD
    return AMBIGUOUS


def _region(blocks: list[Block]) -> list[Block] | None:
    """Blocks of the marked article, or of main, where the page marks one; None where it does not."""
    for place in ("article", "main"):
        inside = [b for b in blocks if getattr(b, place)]
        if not inside:
            continue
        good = sum(len(b.text) for b in blocks if b.label == GOOD)
        held = sum(len(b.text) for b in inside if b.label == GOOD)
        if len({getattr(b, place) for b in inside}) == 1 or 2 * held >= good:
            return inside
    return None


def _second_pass(blocks: list[Block], default: str) -> None:
    """Ambiguous blocks take the label of the nearest decided one; a heading, of the next."""
    n = len(blocks)
    before, after = [None] * n, [None] * n
    last = None
    for i, block in enumerate(blocks):
        before[i] = last
        if block.label != AMBIGUOUS:
            last = i
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = last
        if blocks[i].label != AMBIGUOUS:
            last = i
    labels, found = [], {block.label for block in blocks}
    for i, block in enumerate(blocks):
        label, left, right = block.label, before[i], after[i]
        if label == AMBIGUOUS:
            if default == BAD and GOOD not in found and _reads(block, DENSE):
                label = GOOD  # a short page: its best blocks
            elif left is None and right is None:
                label = default
            elif left is None or right is None:
                label = blocks[left if right is None else right].label
            elif block.heading or right - i < i - left:
                label = blocks[right].label
            elif i - left < right - i:
                label = blocks[left].label
            else:
                # As near on both sides: of different labels its own density decides.
                one, other = blocks[left].label, blocks[right].label
                label = one if one == other else GOOD if block.article or _reads(block, SPARSE) else BAD
        labels.append(label)
    for block, label in zip(blocks, labels):
        block.label = label


def classify(blocks: list[Block]) -> list[Block]:
    """Sets the labels of all blocks of a page: good or bad."""
    if not blocks:
        return blocks
    known = _count_stops(blocks)
    for block in blocks:
        block.label = _first_pass(block, known)
    region = _region(blocks)
    if region is None:
        _second_pass(blocks, BAD)
        return blocks
    # What is named in the article is no neighbour of its text.
    _second_pass([b for b in region if not b.named], GOOD)
    inside = set(map(id, region))
    for block in blocks:
        if id(block) not in inside:
            block.label = BAD
    return blocks


_BLOCK = "text:string,label:string,words:int,stops:int,linked:int,heading:boolean"


def blocks_of(pages: DataFrame) -> DataFrame:
    """(page_id, url, blocks) of every page; a block has its text, label and figures.

    A null or empty html has no blocks. Any html is taken: unclosed or stray tags, a
    page that breaks off, very long pages (time grows with the length). Rows with equal ids are
    pages of their own; only page_id, url and html are read, other columns may have any name.
    """
    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    names = ("text", "label", "words", "stops", "linked", "heading")
    types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())

    def cut_batch(batches):
        for batch in batches:
            ends, flat = [0], []
            for html in batch["html"]:
                flat += classify(cut(html.as_py() or ""))
                ends.append(len(flat))
            columns = [pa.array([getattr(b, name) for b in flat], kind) for name, kind in zip(names, types)]
            blocks = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, list(names))
            )
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], blocks], ["page_id", "url", "blocks"])

    return pages.select("page_id", "url", "html").mapInArrow(
        cut_batch, f"page_id {kinds['page_id']}, url {kinds['url']}, blocks array<struct<{_BLOCK}>>"
    )


def main_text(blocks: Column) -> Column:
    """The good blocks in page order, with one space between them; empty where there is none."""
    good = F.filter(blocks, lambda b: b["label"] == GOOD)
    return F.array_join(F.transform(good, lambda b: b["text"]), " ")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, blocks), a row per page."""
    text = main_text(F.col("blocks"))
    return blocks_of(pages).select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"), "blocks")
