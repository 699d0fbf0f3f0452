"""Operator 3: main text of a page by line-block distribution.

Markup is stripped to a list of lines, one for each run of text between block
elements. A line's weight is its text length less twice its link text. Sums of
weights over sliding windows of lines show where text surges and where it dives
to nothing again; the lines between are kept, lines of links among them too. A
region begins behind the last window without text before its surge, so short
paragraphs stay. A surge is SURGE characters in a window, or half of the page's
fullest window if that is less, so that short pages have a region too; inside a
marked article any text is a surge.

Furniture weighs nothing and is never kept: elements that are menus, footers,
sidebars and the like by their tag, and elements that say so in class, id or
role, also written together ("commentlist"). Such words are hints only: names like
"has-sidebar" and "comments-open" tell of the layout; an element that holds an
article or main element is no furniture; one whose name says so only in part is
none if it holds most of the page's text, unless it is one of reader comments
without the page's title (h1); and where hints leave no text at all, they are all
ignored. A form that holds the title or most of the text is one of the layout. An
article or main element bounds the region if it holds a surge or a quarter of the
page's text, else it is ignored.

Defined results: null or empty html gives an empty text. Character references
are decoded, white space inside a block becomes one space, blocks are joined in
page order by one newline, and nothing else is dropped or capped. Unclosed p, li,
table and option elements end where HTML ends them, others with their parent or
the page; a menu or header that is never closed ends where an article begins. A
tag that is cut off by the end of the page is markup. Time is linear in the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import small_batches

#: Lines in a window, and the text a window needs for a surge.
WINDOW = 3
SURGE = 90
#: Shares of a page's text: of marked articles that bound the region, of a container that its name makes furniture in part, or of a form.
MARKED_SHARE, PARTLY_SHARE = 0.25, 0.5

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"=\s*([\"'])|>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden)(?![\w:-])(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")

#: Elements whose content is no text of the page, up to their end tag.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "script style noscript template svg iframe object textarea select title".split()}
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li link main menu meta nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("article main".split())
_FURNITURE = frozenset("aside button dialog fieldset footer header head menu nav".split())
#: What an open element of these tags ends: the elements on top of it that HTML lets go unclosed.
_ENDS = {
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "option": {"option"},
    "optgroup": {"option", "optgroup"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    **dict.fromkeys(("thead", "tbody", "tfoot"), {"thead", "tbody", "tfoot", "tr", "td", "th", "p"}),
}
_ENDS_P = {"p"}
#: Words of class, id and role names that mark furniture.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies dialog disqus footer form gdpr hidden masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toc toolbar widget".split()
)
#: Words beside them that change nothing, and first words that make the name one of the layout.
_FILLERS = frozenset("area bar block bottom box buttons container content first global header inner item items last left link links list main module panel primary right secondary section site text thread top wrap wrapper".split())
_LAYOUT = frozenset("has with no not without is hide show enable disable".split())
#: Words of names for what readers wrote, and last words that make such a name one of the layout.
_COMMENTS = frozenset("comment comments disqus replies reply".split())
_STATES = frozenset("open opened closed on off enabled disabled allowed".split())


@dataclass(slots=True)
class _Hint:
    """An element that is furniture by its name; what its name says."""

    parent: int
    kind: str  # "form", "comments", "sure" or "partly"
    weight: int = 0
    holds: bool = False
    titled: bool = False


@dataclass(slots=True)
class _Line:
    inside: bool
    skipped: bool
    hint: int
    joined: bool  # to the line before, as furniture within a block parts its text
    parts: list[str] = field(default_factory=list)
    link: int = 0


def _split(word: str) -> tuple[str, ...]:
    """A word, or the two that it is made of if one of them is a hint: "commentlist"."""
    if word not in _HINTS and word not in _FILLERS:
        for i in range(2, len(word) - 1):
            parts = word[:i], word[i:]
            if all(p in _HINTS or p in _FILLERS for p in parts) and not _HINTS.isdisjoint(parts):
                return parts
    return (word,)


def _hint_of(attributes: str) -> str | None:
    """The kind of furniture that the attributes name, if any."""
    found = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
            return "sure"
        if name in ("class", "id", "role"):
            for token in value.split():
                words = [part for w in _PARTS.findall(token) for part in _split(w.lower())]
                if not words or words[0] in _LAYOUT or words[-1] in _STATES or _HINTS.isdisjoint(words):
                    continue
                if not _COMMENTS.isdisjoint(words):
                    found = "comments"
                elif all(w in _HINTS or w in _FILLERS for w in words):
                    return "sure"
                else:
                    found = found or "partly"
    return found


def _tag_end(page: str, at: int, ends: dict[str, int]) -> int:
    """Where the ">" of a tag is that goes on at `at`; quoted values may hold one. There is one for sure."""
    while (m := _QUOTE_OR_END.search(page, at))[1]:
        at = page.find(m[1], m.end()) + 1 if m.end() <= ends[m[1]] else m.end()
    return m.start()


class _Page:
    """The lines of a page, and its containers that are furniture by name."""

    def __init__(self, page: str):
        self.lines: list[_Line] = []
        self.hints: list[_Hint] = []
        self.stack: list[tuple[str, bool, int]] = []  # tag, furniture by tag, hint (-1: none)
        self.open: dict[str, int] = {}
        self.skips = self.containers = self.links = 0
        self.hint = -1
        self.line = _Line(False, False, -1, False)
        self._read(page)
        self._close()

    def _text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            self.line.parts.append(text)
            if self.links:
                self.line.link += len(text.strip())

    def _close(self, block: bool = True) -> None:
        joined = not block and (bool(self.line.parts) or self.line.joined)
        if self.line.parts:
            self.lines.append(self.line)
        self.line = _Line(self.containers > 0, self.skips > 0, self.hint, joined)

    def _pop(self) -> None:
        tag, skip, hint = self.stack.pop()
        self.open[tag] -= 1
        self.skips -= skip
        if hint >= 0:
            self.hint = self.hints[hint].parent
        self.containers -= tag in _CONTAINERS

    def _start(self, tag: str, attributes: str) -> None:
        ends = _ENDS.get(tag, _ENDS_P if tag in _BLOCKS else ())
        # furniture inside a paragraph that is never closed ends with the paragraph
        while self.stack and (self.stack[-1][0] in ends or self.stack[-1][0] not in _BLOCKS and len(self.stack) > 1 and self.stack[-2][0] in ends):
            self._pop()
        if tag in _CONTAINERS:
            while any(self.open.get(t) for t in ("nav", "header", "head", "menu")) and not self.containers:
                self._pop()
            at = self.hint
            while at >= 0 and not self.hints[at].holds:
                self.hints[at].holds = True
                at = self.hints[at].parent
        if tag == "h1":
            at = self.hint
            while at >= 0 and not self.hints[at].titled:
                self.hints[at].titled = True
                at = self.hints[at].parent
        if tag in _VOID:
            return
        skip = tag in _FURNITURE and not (self.containers and tag == "header")
        hint = -1
        if not skip and tag not in ("html", "body") and tag not in _CONTAINERS:
            kind = "form" if tag == "form" else _hint_of(attributes) if attributes else None
            if kind is not None:
                self.hints.append(_Hint(self.hint, kind))
                self.hint = hint = len(self.hints) - 1
        if tag in _BLOCKS or skip or hint >= 0:
            self.stack.append((tag, skip, hint))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.skips += skip
            self.containers += tag in _CONTAINERS

    def _end(self, tag: str) -> None:
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def _read(self, page: str) -> None:
        last = page.rfind(">")
        ends = {q: page.rfind(q, 0, last + 1) for q in "\"'"}
        at = 0
        while True:
            lt = page.find("<", at)
            while 0 <= lt and not (page[lt + 1 : lt + 2].isascii() and page[lt + 1 : lt + 2].isalpha()) and page[lt + 1 : lt + 2] not in ("/", "!", "?"):
                lt = page.find("<", lt + 1)  # a bare "<" is text
            self._text(page[at:] if lt < 0 else page[at:lt])
            if lt < 0 or lt > last:
                return
            if page.startswith("<!--", lt):
                at = page.find("-->", lt + 4) + 3
                if at < 3:
                    return
                continue
            closing = page[lt + 1] == "/"
            name = _NAME.match(page, lt + 1 + closing)
            if not name:
                at = page.index(">", lt) + 1
                continue
            end = page.index(">", lt) if closing else _tag_end(page, name.end(), ends)
            at = end + 1
            tag = name[0].lower()
            if tag == "br":
                self.line.parts.append(" ")
                continue
            if tag == "a":
                self.links = max(0, self.links + (-1 if closing else 1))
            if tag in _RAW and not closing:
                if not (tag == "svg" and page[end - 1] == "/"):
                    found = _RAW[tag].search(page, at)
                    if not found:
                        return
                    at = page.find(">", found.end()) + 1 or len(page)
                continue
            before = (self.skips > 0, self.hint)
            if closing:
                self._end(tag)
            else:
                self._start(tag, page[name.end() : end])
            if tag in _BLOCKS or before != (self.skips > 0, self.hint):
                self._close(tag in _BLOCKS)


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, weight, inside an article, furniture) of each line that has text."""
    read = _Page(page)
    hints = read.hints
    sizes = [max(0, len(_SPACE.sub(" ", "".join(line.parts)).strip()) - 2 * line.link) for line in read.lines]
    total = sum(size for line, size in zip(read.lines, sizes, strict=True) if not line.skipped)
    for line, size in zip(read.lines, sizes, strict=True):
        if line.hint >= 0 and not line.skipped:
            hints[line.hint].weight += size
    for hint in reversed(hints):  # parents come before their children
        if hint.parent >= 0:
            hints[hint.parent].weight += hint.weight

    def furniture(all_hints: bool) -> list[bool]:
        off: list[bool] = []
        for hint in hints:
            most = hint.weight > PARTLY_SHARE * total
            if hint.kind == "form":
                mine = not (hint.titled or most)
            else:
                mine = all_hints and (hint.kind == "sure" or not (hint.titled if hint.kind == "comments" else most))
            mine = mine and not hint.holds
            off.append(mine or hint.parent >= 0 and off[hint.parent])
        return [line.skipped or line.hint >= 0 and off[line.hint] for line in read.lines]

    gone = furniture(True)
    if not any(size and not away for size, away in zip(sizes, gone, strict=True)):
        gone = furniture(False)
    found: list[tuple[str, int, bool, bool]] = []
    at = 0
    while at < len(gone):
        end = at + 1
        while end < len(gone) and read.lines[end].joined:
            end += 1
        kept = [i for i in range(at, end) if not gone[i]]
        shown = kept or range(at, end)
        block = _SPACE.sub(" ", "".join(part for i in shown for part in read.lines[i].parts)).strip()
        if block:
            weight = max(0, len(block) - 2 * sum(read.lines[i].link for i in kept)) if kept else 0
            found.append((block, weight, any(read.lines[i].inside for i in shown), not kept))
        at = end
    return found


def main_text(page: str | None) -> str:
    """The text between surge and dive points."""
    lines = lines_of(page or "")
    kept = [line for line in lines if line[2] and not line[3]]
    marked, total = sum(line[1] for line in kept), sum(line[1] for line in lines)
    bound = bool(kept) and (marked >= SURGE or marked >= MARKED_SHARE * total)
    if not bound:
        kept = lines
    weights = [line[1] for line in kept]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    surge = 1 if bound else min(SURGE, max(sums, default=0) / 2)
    chosen: list[str] = []
    i, done = 0, 0
    while i < len(sums):
        if sums[i] < surge or not weights[i]:
            i += 1
            continue
        start = i  # the surge, and the short lines before it back to a window without text
        while start > done and any(weights[max(0, start - WINDOW) : start]):
            start -= 1
        while i < len(sums) and sums[i]:  # to the dive: a window without text
            i += 1
        chosen += [line[0] for line in kept[start:i] if not line[3]]
        done = i
    if bound and not chosen:  # links only: only the mark says that it is the text
        chosen = [line[0] for line in kept]
    return "\n".join(chosen)


def extract(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Add the main text of each page; other columns pass through."""
    small_batches(df.sparkSession)

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array((main_text(page.as_py()) for page in pages), pa.string())

    return df.withColumn(out_col, texts(F.col(html_col)))
