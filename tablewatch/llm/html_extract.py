"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with the path of tags from the root to
it.  Elements that are never article text by their tag, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, comments) are set
aside.  Over the rest, text length and punctuation are added up per tag path
and divided by the path's number of blocks; both ratios are smoothed along the
page (Gaussian), fused by product, and blocks above a share of the page's
spread are content.  The article is then the innermost article or main element
around the content, if such elements hold most of its weight, or else the
innermost element that holds it; all blocks in
it that are not set aside belong to it, so that short paragraphs and headings
stay.

White space inside a block becomes one space, character references are decoded
and blocks are joined by a line break.  ``br`` is white space.

Defined cases: null or empty html, or html without text, gives the empty text;
markup cut off in the middle is read as far as it goes; unclosed scripts and
comments run to the end; stray closing tags are ignored; a class name does not
set aside a wrapper of the article or of most of the text, nor does a form or dialog round the article;
if everything was set aside by class names alone, class names are disregarded; repeated rows are read
one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewatch.llm.common import col, trimmed

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
           "tfoot": {"thead", "tbody", "tr", "td", "th"}}
P_SCOPE = frozenset("article body table td th button main section div".split())
SCOPE = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
# Elements, roles and class or id words that mark what is not the article.
ASIDE_TAGS = frozenset("aside audio button canvas datalist footer head header iframe input map menu nav noembed "
                       "noframes noscript object script select style svg template textarea title video".split())
ASIDE_ROLES = frozenset("alert banner complementary contentinfo menu menubar navigation search toolbar".split())
# Tags and roles of what is set aside unless it is wrapped round the article.
FORMS = frozenset("alertdialog dialog form".split())
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
                        "consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation "
                        "newsletter notice notification notifications overlay pager pagination popup promo promotion recommended "
                        "related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription "
                        "toolbar widget widgets".split())
KEEP_TAGS = frozenset(("html", "body", "main", "article"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w=-])(hidden)(?![\w=-])""", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCT = re.compile(r"""[.,;:!?…。、，；：！？"'()«»“”-]""")


class Element:
    """``path`` numbers the page's tag paths, ``enter`` its elements in order;
    ``leave`` is the number of the first element after this one's own."""

    __slots__ = ("tag", "parent", "path", "depth", "hard", "mark", "firm", "section", "para", "enter", "leave")

    def __init__(self, tag: str, parent: Element | None, path: int, enter: int, hard: bool, soft: bool, firm: bool):
        self.tag, self.parent, self.path, self.enter, self.leave = tag, parent, path, enter, None
        self.depth = parent.depth + 1 if parent else 0
        up = parent is not None
        self.hard = hard or (up and parent.hard)
        # The nearest element that a class or id word marks, and the nearest article or main.
        self.mark: Element | None = self if soft or firm else parent.mark if up else None
        self.firm = firm
        self.section: Element | None = self if tag in ("article", "main") else parent.section if up else None
        self.para: Element | None = self if tag == "p" else None if tag in P_SCOPE or not up else parent.para

    @property
    def article(self) -> bool:
        return self.section is not None

    def holds(self, inner: Element) -> bool:
        return self.enter <= inner.enter and (self.leave is None or inner.enter < self.leave)


class Block:
    __slots__ = ("element", "text", "link")

    def __init__(self, element: Element, text: str, link: int):
        self.element, self.text, self.link = element, text, link


def set_aside(tag: str, attrs: str, parent: Element) -> tuple[bool, bool, bool]:
    """Whether an element is set aside by its tag, role or hidden state,
    whether by its class or id words, and whether as a form or dialog."""
    hard, firm = tag in ASIDE_TAGS, tag in FORMS
    if tag in KEEP_TAGS:
        return False, False, False
    if hard and tag == "header" and parent.article:
        hard = False  # an article's own header: only its headings are text
    if parent.tag == "header" and parent.article and tag not in HEADINGS and tag not in ("div", "hgroup"):
        hard = True
    soft = False
    for name, a, b, c, bare in _ATTR.findall(attrs) if attrs.strip() else ():
        name, value = (name or bare).lower(), (a or b or c).lower()
        if name == "role":
            hard |= value.strip() in ASIDE_ROLES
            firm |= value.strip() in FORMS
        elif name == "hidden" or name == "aria-hidden" and value == "true" or \
                name == "style" and "display:none" in value.replace(" ", ""):
            hard = True
        elif name in ("class", "id"):
            soft |= not ASIDE_WORDS.isdisjoint(_WORD.findall(value))
    return hard, soft, firm


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order."""
    here = Element("#", None, 0, 0, False, False, False)
    paths: dict[tuple[int, str], int] = {}
    is_open: Counter = Counter()  # elements open by tag
    made = 0
    out: list[Block] = []
    text: list[str] = []
    owner, link, linked = here, 0, 0

    def add(piece: str) -> None:
        nonlocal owner, link
        if piece:
            if not "".join(text).strip():
                owner = here
            text.append(piece)
            if linked:
                link += len(piece)

    def flush() -> None:
        nonlocal link
        joined = " ".join(html_lib.unescape("".join(text)).split())
        if joined:
            out.append(Block(owner, joined, link))
        text.clear()
        link = 0

    def close(to: Element) -> None:
        """Closes elements down to ``to`` inclusive."""
        nonlocal here, linked
        while True:
            if here.tag not in INLINE:
                flush()
            linked -= here.tag == "a"
            last, here = here, here.parent
            last.leave = made + 1
            is_open[last.tag] -= 1
            if last is to:
                return

    def opened(tags, stop) -> Element | None:
        at, found, left = here, None, sum(is_open[t] for t in tags)
        while left and at.parent:
            if at.tag in tags:
                found, left = at, left - 1
            if at.tag in stop:
                break
            at = at.parent
        return found

    at = 0
    while True:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if m[1]:
            if not is_open[tag]:
                continue
            found = here
            while found.parent and found.tag != tag:
                if found.tag in ("article", "main", "body", "table") and tag in INLINE:
                    found = None  # an inline end tag does not close a section
                    break
                found = found.parent
            if found is not None and found.parent:
                close(found)
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                close_tag = page.find(">", at)
                at = close_tag + 1 if close_tag >= 0 else len(page)
            if tag not in INLINE:
                add(" ")
            continue
        if tag in CLOSES_P:
            if here.para:
                close(here.para)
        if tag in IMPLIED:
            old = opened(IMPLIED[tag], SCOPE.get(tag, {"dl", "select", "table"}))
            if old:
                close(old)
        if tag not in INLINE:
            flush()
        if tag == "a":
            linked += 1
        made += 1
        is_open[tag] += 1
        path = paths.setdefault((here.path, tag), len(paths) + 1)
        here = Element(tag, here, path, made, *set_aside(tag, m[3], here))
    flush()
    return out


def smooth(values: np.ndarray, radius: int = 2) -> np.ndarray:
    weight = np.exp(-np.arange(-radius, radius + 1) ** 2 / 2.0)
    total = np.convolve(values, weight)[radius:radius + len(values)]
    return total / np.convolve(np.ones(len(values)), weight)[radius:radius + len(values)]


def content(found: list[Block], share: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks are content by the smoothed, fused ratios of their paths,
    and the fused ratios."""
    paths = {p: i for i, p in enumerate(dict.fromkeys(b.element.path for b in found))}
    of = np.array([paths[b.element.path] for b in found])
    n = np.bincount(of)
    chars = np.array([len(b.text) for b in found], float)
    points = np.array([len(_PUNCT.findall(b.text)) for b in found], float)
    links = np.array([min(b.link, len(b.text)) for b in found], float)
    length = smooth((np.bincount(of, chars) / n)[of])
    punct = smooth((np.bincount(of, points) / n)[of])
    unlinked = 1 - np.bincount(of, links) / np.bincount(of, chars)
    fused = length * (1 + punct) * unlinked[of]
    return fused >= min(share * fused.std(), 0.5 * fused.max()), fused


def unmarked(found: list[Block]) -> list[Block]:
    """The blocks that no class or id word, form or dialog sets aside.  A
    marked element that
    holds a main, more text in articles than stands unmarked outside it, or
    most of the page's text is a wrapper and sets nothing aside, unless an
    unmarked article is longer than each of its articles and a quarter of its
    other text (comments can outgrow what they are about).  A form or dialog
    is a wrapper only if it also holds an article or main, or half of its text
    stands in paragraphs.  Links do not count as text.  If nothing is left,
    class and id words are disregarded, forms and dialogs are not.

    Sums run once up the tree of marked elements, so that time does not grow
    with the nesting depth."""
    every = free = 0
    held, within, prose, longest, own, alone = Counter(), Counter(), Counter(), Counter(), Counter(), Counter()
    marks: set[Element] = set()
    seen: set[Element] = set()
    mains: set[Element | None] = set()
    for b in found:
        n, e = max(0, len(b.text) - b.link), b.element
        every += n
        section, mark = e.section, e.mark
        if mark is None:
            free += n
            if section:
                alone[section] += n
        else:
            held[mark] += n
            prose[mark] += n * (e.para is not None)
        if section:
            own[section] += n
            within[section.parent.mark] += n
        while mark and mark not in marks:
            marks.add(mark)
            mark = mark.parent.mark
        while section and section not in seen:
            seen.add(section)
            if section.tag == "main":
                mains.add(section.parent.mark)
            section = section.parent.section
    for section, n in own.items():
        outer = section.parent.mark
        longest[outer] = max(longest[outer], n)
    most = max(alone.values(), default=0)
    downward = sorted(marks, key=lambda m: m.depth)
    for m in reversed(downward):
        up = m.parent.mark
        if up:
            for sums in (held, within, prose):
                sums[up] += sums[m]
            longest[up] = max(longest[up], longest[m])
            if m in mains:
                mains.add(up)
    passes, passes_words = {None: True}, {None: True}
    for m in downward:
        n, plain = held[m], held[m] - within[m]
        wrapper = m in mains or (within[m] > free or 2 * n > every) and max(longest[m], plain / 4) > most
        if m.firm:
            wrapper = wrapper and (m in mains or longest[m] > 0 or 2 * prose[m] >= n)
        up = m.parent.mark
        passes[m] = wrapper and passes[up]
        passes_words[m] = (wrapper or not m.firm) and passes_words[up]
    return [b for b in found if passes[b.element.mark]] or [b for b in found if passes_words[b.element.mark]]


def extract(page: str) -> str:
    """The article's text."""
    every = [b for b in blocks(page) if not b.element.hard]
    found = unmarked(every)
    if not found:
        return ""
    ok, fused = content(found)
    chosen = [b for b, yes in zip(found, ok) if yes] or found
    # Teasers are articles too: a page's articles hold its text only if they weigh most.
    inside = np.array([b.element.article for b in found])
    most = 2 * fused[ok & inside].sum() >= fused[ok].sum()
    within = [b for b in chosen if b.element.article and most] or chosen
    box = within[0].element
    for b in within[1:]:
        while not box.holds(b.element):
            box = box.parent
    if box.article:
        while box.tag not in ("article", "main"):
            box = box.parent
    elif box.tag not in ("body", "html", "#") and (box.tag in INLINE or box.tag in CLOSES_P - {"div", "section", "td"}):
        while box.tag not in ("div", "section", "td", "body", "html", "#"):
            box = box.parent
    inside = [b for b in found if box.holds(b.element)]
    if box.tag in ("body", "html", "#"):
        # No section of its own: from the first to the last content block,
        # with a heading before it, without lists of links.
        picked = {id(b) for b in chosen}
        ok = [id(b) in picked for b in inside]
        first, last = ok.index(True), len(ok) - 1 - ok[::-1].index(True)
        while first and inside[first - 1].element.tag in HEADINGS:
            first -= 1
        inside = [b for b in inside[first:last + 1] if id(b) in picked or 2 * b.link < len(b.text)]
    return "\n".join(b.text for b in inside)


def extract_pages(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All columns but the html, with the article's text and its code points."""
    rest = [c for c in pages.columns if c not in (html_col, out_col, "n_chars")]
    schema = T.StructType([pages.schema[c] for c in rest] + [T.StructField(out_col, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(html_col)
            for k in range(0, batch.num_rows, 500):
                texts = [extract(x) if x else "" for x in column.slice(k, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(rest).slice(k, 500).columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=schema.names)

    return pages.select(*map(col, rest), col(html_col)).mapInArrow(trimmed(run), schema)
