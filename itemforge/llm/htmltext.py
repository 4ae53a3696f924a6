"""Layout-aware HTML rendering: all visible text, with block spacing, lists and aligned table cells.

A tree builder reads tags, ends elements that others imply to be over, and passes well-nested openings and closings to
a renderer. Nothing recurses, so depth is bounded by memory alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, table, text_bytes

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript noembed noframes iframe object datalist svg math audio video canvas".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure fieldset".split())
BLOCK = SPACED | frozenset("address article aside body dd details dialog div dt fieldset figcaption footer form header hgroup hr html legend li main menu nav option section summary tbody td tfoot th thead tr caption optgroup select".split())
ENDS_P = SPACED | frozenset("address article aside details div dl fieldset figcaption footer form header hgroup hr main menu nav section".split())
#: An opening tag ends the open elements named here, up to the nearest element of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "thead": ({"tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th", "caption"}, {"table"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: An end tag doesn't reach past these.
SCOPE = {"li": {"ul", "ol"}, "p": {"td", "th", "table", "li", "div"}} | {t: {"table"} for t in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption")}

#: Start tags that leave an open head open; all others, and text, end it.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template".split())

# Possessive, so a tag that never ends is read once. A quote in an unquoted value is a character of it.
_VALUE = r"\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+|"
_NAME = r"=[^ \t\n\r\f/>=]*+|[^ \t\n\r\f/>=]++"
_GIVES = r"[ \t\n\r\f]*+=[ \t\n\r\f]*+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^ \t\n\r\f/>]*+)((?:[ \t\n\r\f/]++|(?:{_NAME})(?:{_GIVES}(?:{_VALUE}))?+)*+)>|<[!?/][^>]*>", re.S)
_OPENS = re.compile(r"<(?:[!?/]|[a-zA-Z])")
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_GIVES}({_VALUE}))?+")
_MAY_HIDE = re.compile(r"hidden|style", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none(?![\w-])", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)(?![\w-])", re.I)
_CSS_COMMENT = re.compile(r"/\*.*?\*/", re.S)
#: Attributes that are numbers, and the largest that counts.
_NUMBERS = {"colspan": 1000, "rowspan": 65534, "start": 10**9, "value": 10**9}
_MAY_COUNT = re.compile("|".join(_NUMBERS), re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


def attributes_of(text: str) -> dict[str, str]:
    """A tag's attributes by name; of those with one name the first counts."""
    given: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        given.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return given


def hides(attributes: str) -> bool:
    """Whether a tag's attributes, or the style that they give, take its element and all in it off the page."""
    return look(attributes) == (True, None)


def look(attributes: str) -> tuple[bool, bool | None]:
    """Whether an element is off the page, and whether its own text is visible: None where that is as around it."""
    if not _MAY_HIDE.search(attributes):
        return False, None
    given = attributes_of(attributes)
    style = _CSS_COMMENT.sub("", unescape(given.get("style", "")))
    if "hidden" in given or _NO_DISPLAY.search(style):
        return True, None
    said = _VISIBILITY.findall(style)
    return False, said[-1].lower() == "visible" if said else None


def numbers(attributes: str) -> dict[str, int]:
    """The attributes of a tag that are whole numbers."""
    if not _MAY_COUNT.search(attributes):
        return {}
    given = attributes_of(attributes)
    return {k: min(int(v), most) for k, most in _NUMBERS.items() if re.fullmatch(r"\s*-?\d{1,9}\s*", v := given.get(k, ""))}


class Text:
    """Lines under construction; breaks are written when text follows."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.breaks = 0
        self.gap = False
        self.mark = ""
        self.held: list[str] | None = None  # preformatted text, until its element ends

    def line(self, n: int) -> None:
        if self.held is None:
            self.breaks, self.gap = max(self.breaks, n), False
        elif self.held and not self.held[-1].endswith("\n"):
            self.held.append("\n")

    def line_break(self) -> None:
        if self.held is None:
            self.breaks, self.gap = self.breaks + 1, False
        else:
            self.held.append("\n")

    def hold(self) -> None:
        """From here on text is preformatted: its blanks and line breaks stay."""
        if self.held is None:
            self.held = []

    def release(self) -> None:
        """The preformatted text is over; the break right behind its tag and those at its end don't count."""
        text = "".join(self.held or ())
        self.held = None
        text = text.removeprefix("\n").rstrip("\n")
        if text:
            self.add(text)

    def add(self, text: str) -> None:
        if self.held is not None:
            if self.mark:
                self.held.append(self.mark)
                self.mark = ""
            self.held.append(text)
            return
        if self.out and self.breaks:
            self.out.append("\n" * self.breaks)
        elif self.gap and self.out:
            self.out.append(" ")
        if self.mark:
            self.out.append(self.mark)
        self.out.append(text)
        self.breaks, self.gap, self.mark = 0, False, ""

    def flow(self, text: str) -> None:
        """Text whose white space counts as one blank between words."""
        words = _BLANK.sub(" ", text)
        bare = words.strip(" ")
        if not bare:
            self.gap = self.gap or bool(words)
            return
        if words[0] == " ":
            self.gap = True
        self.add(bare)
        self.gap = words[-1] == " "

    def done(self) -> str:
        if self.held is not None:
            self.release()
        return "".join(self.out).strip("\n").rstrip()


class Table:
    """Rows of cells; a cell that spans rows leaves its columns empty below."""

    def __init__(self) -> None:
        self.rows: list[list[str]] = []
        self.left: dict[int, int] = {}  # columns that cells above still fill, and for how many rows
        self.taken: frozenset[int] = frozenset()  # those of them in this row

    def row(self) -> None:
        self.taken = frozenset(self.left)
        self.left = {k: n - 1 for k, n in self.left.items() if n > 1}
        self.rows.append([])

    def cell(self, text: str, across: int, down: int) -> None:
        now = self.rows[-1]
        while len(now) in self.taken:
            now.append("")
        if down > 1:
            self.left |= dict.fromkeys(range(len(now), len(now) + across), down - 1)
        now += [text, *[""] * (across - 1)]


def aligned(rows: list[list[str]]) -> list[str]:
    """Rows of cells as lines with columns of one width, two blanks apart; a cell of several lines takes as many lines of its row."""
    cut = [[[line.rstrip() for line in cell.split("\n") if line.strip()] or [""] for cell in r] for r in rows]
    width = [max((len(line) for r in cut if k < len(r) for line in r[k]), default=0) for k in range(max(map(len, cut), default=0))]
    out = []
    for r in cut:
        for i in range(max(map(len, r), default=0)):
            out.append("  ".join((c[i] if i < len(c) else "").ljust(w) for c, w in zip(r, width, strict=False)).rstrip())
    return out


class Page:
    def __init__(self) -> None:
        self.open: list[tuple[str, bool, bool]] = []  # tag, whether the element is off the page, and whether text around it is invisible
        self.count: Counter[str] = Counter()  # open elements by tag, so that a search for none costs nothing
        self.hidden = 0
        self.unseen = False
        self.text = [Text()]
        self.tables: list[Table] = []
        self.lists: list[int | None] = []
        self.pre = 0
        self.spans: list[tuple[int, int]] = []  # columns and rows of the open cells

    def start(self, tag: str, hides: bool, visible: bool | None = None, given: dict[str, int] | None = None) -> None:
        given = given or {}
        self.open.append((tag, hides, self.unseen))
        self.count[tag] += 1
        self.hidden += hides
        if visible is not None:
            self.unseen = not visible
        if self.hidden:
            return
        now = self.text[-1]
        if tag in BLOCK and tag not in ("td", "th"):
            now.line(2 if tag in SPACED and not (tag in ("ul", "ol") and self.lists) else 1)
        if tag in ("ul", "ol", "menu"):
            self.lists.append(given.get("start", 1) - 1 if tag == "ol" else None)
        elif tag == "li":
            depth = max(0, len(self.lists) - 1)
            if self.lists and self.lists[-1] is not None:
                self.lists[-1] = given.get("value", self.lists[-1] + 1)
                mark = f"{'  ' * depth}{self.lists[-1]}. "
            else:
                mark = f"{'  ' * depth}- "
            now.mark = "" if self.unseen else mark
        elif tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].row()
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].row()
            self.text.append(Text())
            if self.pre:
                self.text[-1].hold()
            self.spans.append((max(1, given.get("colspan", 1)), given.get("rowspan", 1) or _NUMBERS["rowspan"]))
        elif tag == "pre":
            self.pre += 1
            now.hold()

    def end(self) -> None:
        tag, hides, unseen = self.open.pop()
        self.count[tag] -= 1
        self.unseen = unseen
        if self.hidden:
            self.hidden -= hides
            return
        if tag in ("td", "th") and self.tables and len(self.text) > 1:
            self.tables[-1].cell(self.text.pop().done(), *self.spans.pop())
        now = self.text[-1]
        if tag in ("ul", "ol", "menu") and self.lists:
            self.lists.pop()
        elif tag == "table" and self.tables:
            for row in aligned([r for r in self.tables.pop().rows if any(r)]):
                now.line(1)
                now.add(row)
        elif tag == "pre":
            self.pre -= 1
            if now.held is not None and not self.pre:
                now.release()
        elif tag == "li":
            now.mark = ""
        if tag in BLOCK and tag not in ("td", "th"):
            now.line(2 if tag in SPACED and not (tag in ("ul", "ol") and self.lists) else 1)

    def end_through(self, tags: set[str] | frozenset[str], stop: set[str] | frozenset[str] = frozenset()) -> None:
        """End the outermost open element of tags inside the nearest one of stop, and all in it."""
        if not any(self.count[t] for t in tags):
            return
        found = None
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in stop:
                break
            if self.open[k][0] in tags:
                found = k
        while found is not None and len(self.open) > found:
            self.end()

    def end_nearest(self, tag: str) -> None:
        if not self.count[tag]:
            return
        stop = SCOPE.get(tag, ())
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self.end()
                return
            if self.open[k][0] in stop:
                return

    def leave_head(self) -> None:
        """End an open head where something stands that none can hold."""
        if self.open and self.open[-1][0] == "head":
            self.end()

    def words(self, text: str) -> None:
        if self.hidden and self.open[-1][0] == "head" and unescape(text).strip(" \t\n\r\f"):
            self.leave_head()
        if not self.hidden and not self.unseen and text:
            text = unescape(text) if "&" in text else text
            if self.pre:
                self.text[-1].hold()
                self.text[-1].add(text)
            elif not (self.open and self.open[-1][0] in ("table", "tr", "tbody", "thead", "tfoot", "ul", "ol") and not text.strip()):
                self.text[-1].flow(text)


def render(html: str) -> str:
    """The visible text of a page; empty for an empty one. What follows a tag that never ends is text, so each character is read once."""
    page, at, n = Page(), 0, len(html)
    while at < n:
        opens = _OPENS.search(html, at)
        m = opens and _TAG.match(html, opens.start())
        page.words(html[at : m.start() if m else n])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                page.leave_head()
                page.text[-1].line_break()
            elif tag not in VOID:
                page.end_nearest(tag)
            continue
        if page.open and page.open[-1][0] == "head":
            if tag in ("html", "head"):
                continue
            if tag not in IN_HEAD:
                page.leave_head()
        if tag in VOID:
            if not page.hidden and tag == "br":
                page.text[-1].line_break()
            elif not page.hidden and tag == "hr":
                page.text[-1].line(2)
            continue
        if tag in IMPLIED:
            page.end_through(*IMPLIED[tag])
        elif tag in ENDS_P:
            page.end_through({"p"}, {"td", "th", "table", "li", "dd", "div", "body"})
        off, visible = look(m[3]) if m[3] else (False, None)
        page.start(tag, tag in UNSEEN or off, visible, numbers(m[3]) if m[3] and tag in ("td", "th", "ol", "li") else None)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if tag == "textarea":
                page.words(html[at : close.start() if close else n])
            at = close.end() if close else n
            page.end()
    while page.open:
        page.end()
    return page.text[0].done()


def extracted(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """(key, text, n_chars): the rendered text of each page; empty for null and empty html. One row for each row.

    Pages of any length are read whole, once. Columns other than html and key are not read, so their names are free.
    """
    schema = pa.schema([(key, pa.int64()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                texts = [render(t.decode("utf-8", "replace")) for t in b.column(1)[k : k + 1000].to_pylist()]
                yield batch({key: b.column(0)[k : k + 1000], "text": texts, "n_chars": [len(t) for t in texts]}, schema)

    return pages.select(F.col(key).cast("long").alias(key), text_bytes(html)).mapInArrow(run, f"{key} long, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
