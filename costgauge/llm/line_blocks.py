"""Main text of web pages by the distribution of text over blocks of lines.

A page is cut into lines, one for each block element, with the markup stripped. Lines of page furniture (by element, role or
class) and text inside links weigh nothing; every other line weighs its length, and NAMED times that where the page names
its article. Summed over sliding windows of lines, the weights surge where the main text begins and dive where it ends, and the
lines between are kept. Where the largest run between a surge and a dive lies in a named article, the article's ends are the run's.

A page is worked on where it is read; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from costgauge.llm.rows import quoted

WINDOW = 3
SURGE = 80
HOME = 0.9  # share of the largest run's text in the element that other runs are compared with
NAMED = 3  # how much more a line weighs in an element that is named as the article

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:@][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "caption", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul", "option", "select", "head",
}
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dd", "dt", "pre", "figcaption", "caption", "td", "th", "blockquote"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that never hold main text.
FURNITURE = {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "template", "svg", "canvas", "object", "audio",
    "video", "dialog", "menu", "map", "math", "datalist", "label", "fieldset",
}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar", "alert",
    "form", "toolbar", "status", "note", "tablist",
}
# Words in a class or id that name page furniture.
NAMES = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "sponsors",
    "promo", "promos", "promotion", "banner", "nav", "navbar", "navigation", "menu", "menubar", "header", "masthead", "topbar",
    "footer", "bottombar", "sidebar", "sidebars", "aside", "rail", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "signin", "login",
    "register", "paywall", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "related",
    "recommended", "recommendations", "share", "sharing", "sharebar", "social", "breadcrumb", "breadcrumbs", "pagination",
    "pager", "widget", "widgets", "toolbar", "copyright", "search", "form", "disclaimer", "alert", "toast", "outbrain", "taboola",
}
# Words that may stand beside those in a name of furniture; inside an article, a name with any other word is about the text.
LAYOUT = {
    "area", "section", "box", "block", "wrap", "wrapper", "container", "inner", "outer", "content", "button", "buttons", "bar", "link",
    "links", "list", "post", "posts", "article", "articles", "story", "stories", "item", "items", "slot", "unit", "top", "bottom",
    "left", "right", "main", "site", "page", "global", "primary", "secondary", "col", "column", "row", "panel", "card", "cards",
    "group", "text", "title", "heading", "icon", "icons", "body", "thread", "feed", "mobile", "desktop", "sticky", "fixed", "js", "the",
    "reader", "readers", "user", "users", "media", "tools", "policy", "message", "to", "up", "by",
}
MAIN_NAMES = {"articlebody", "article-body", "entry-content", "post-content", "article-content", "post-body", "story-body"}


class _Element:
    __slots__ = ("tag", "parent", "named", "wholly", "anchor", "always", "main", "holds_main")

    def __init__(self, tag: str, parent: _Element | None, named: bool, always: bool, main: bool, anchor: bool, wholly: bool) -> None:
        self.tag, self.parent, self.named, self.always, self.main = tag, parent, named, always, main
        self.anchor, self.wholly = anchor, wholly
        self.holds_main = False


class _Line:
    __slots__ = ("text", "size", "linked", "element", "weight")

    def __init__(self, text: str, linked: int, element: _Element) -> None:
        self.text, self.size, self.linked, self.element, self.weight = text, len(text), linked, element, 0


def _names_furniture(token: str) -> bool:
    """Whether a whole class or id is a name of furniture, and not a title with such a word in it."""
    words = [word.lower() for word in _WORDS.findall(token)]
    return any(w in NAMES for w in words) and all(w in NAMES or w in LAYOUT or w.isdigit() for w in words)


def _element(tag: str, attributes: str, parent: _Element | None) -> _Element:
    named = main = anchor = wholly = False
    always = tag in FURNITURE
    if attributes and not attributes.isspace():
        found = {name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')}"
        if tag not in ("html", "body"):
            named = any(word.lower() in NAMES for word in _WORDS.findall(names))
            wholly = named and any(_names_furniture(token) for token in names.split())
            # The id of a heading or section is made from its title.
            by_class = named and any(word.lower() in NAMES for word in _WORDS.findall(found.get("class", "")))
            anchor = named and not by_class and (tag in HEADING or tag == "section")
        role = found.get("role", "").lower()
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
        always = always or role in ROLES or (hidden and tag not in ("html", "body"))
        main = role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
        main = main or any(name.lower() in MAIN_NAMES for name in names.split())
    main = (main or tag in ("article", "main")) and not named and not always
    return _Element(tag, parent, named, always, main, anchor, wholly)


def lines_of_page(page: str) -> list[_Line]:
    """The page's lines in order: block text with references decoded and white space made single."""
    lines: list[_Line] = []
    root = _Element("html", None, False, False, False, False, False)
    stack, pieces, linked, at = [root], [], 0, 0
    in_link = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                lines.append(_Line(text, min(linked, len(text)), stack[-1]))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            pieces.append(raw)
            if in_link:
                linked += len(html.unescape(raw).strip())

    def pop_to(i: int) -> None:
        nonlocal in_link
        for element in stack[i:]:
            in_link -= element.tag == "a"
        del stack[i:]

    while match := _TAG.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag in BLOCK:
                flush()
            if i:
                pop_to(i)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            flush()
            # A paragraph ends where the next block begins; so do an item, a cell and a row at the next of their kind.
            for i in range(len(stack) - 1, 0, -1):
                open_ = stack[i].tag
                if open_ == "p" or open_ == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                    pop_to(i)
                    break
                if open_ in BLOCK:
                    break
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or (match[3] or match[6] or "").endswith("/") and tag not in BLOCK:
            continue
        stack.append(_element(tag, match[3] or match[6] or "", stack[-1]))
        in_link += tag == "a"
        if stack[-1].main:
            for element in stack:
                element.holds_main = True
    add(page[at:])
    flush()
    return lines


def _state(element: _Element, seen: dict[int, tuple[bool, _Element | None]]) -> tuple[bool, _Element | None]:
    """Whether an element lies in page furniture, and the outermost article around it."""
    above: list[_Element] = []
    at: _Element | None = element
    while at is not None and id(at) not in seen:
        above.append(at)
        at = at.parent
    out, main = seen[id(at)] if at is not None else (False, None)
    for one in reversed(above):
        if one.tag == "header" and not main and not one.holds_main:
            out = True
        # A class may name furniture on an element that holds the article; such a name is only about the layout.
        named = (one.wholly if main else one.named) and not one.holds_main and not (one.anchor and main)
        out = out or one.always or named
        main = main or (one if one.main else None)
        seen[id(one)] = out, main
    return out, main


def _container(element: _Element) -> _Element:
    """The element around a line's own block."""
    while element.parent is not None and element.tag in TEXT | {"ul", "ol", "dl", "tr", "tbody", "table"} or element.tag not in BLOCK:
        if element.parent is None:
            break
        element = element.parent
    return element


def _home(lines: list[_Line]) -> _Element:
    """The innermost element around nearly all of the lines' text (see HOME); the container of most if that is the whole page."""
    weights: dict[int, int] = {}
    sizes: dict[int, int] = {}
    containers: dict[int, _Element] = {}
    for line in lines:
        one = _container(line.element)
        containers[id(one)] = one
        weights[id(one)] = weights.get(id(one), 0) + line.weight
        sizes[id(one)] = sizes.get(id(one), 0) + line.size
    sums: dict[int, int] = {}
    for key, one in containers.items():
        at: _Element | None = one
        while at is not None:
            sums[id(at)] = sums.get(id(at), 0) + weights[key]
            at = at.parent
    most = containers[max(sizes, key=sizes.__getitem__)]
    at, total = most, sum(weights.values())
    while at.parent is not None and sums[id(at)] < HOME * total:
        at = at.parent
    return most if at.tag in ("html", "body") else at


def _within(element: _Element, home: _Element, seen: dict[int, bool]) -> bool:
    """Whether an element lies in home; a whole page as home counts its own lines only."""
    if home.tag in ("html", "body"):
        return _container(element) is home
    above: list[_Element] = []
    at: _Element | None = element
    while at is not None and at is not home and id(at) not in seen:
        above.append(at)
        at = at.parent
    found = at is home or (at is not None and seen[id(at)])
    seen.update((id(one), found) for one in above)
    return found


def runs_of(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """First and last line of each run from a surge to the dive after it.

    A block is the sum of `window` lines. A run begins at a line of weight whose block reaches `surge`, and ends with the last line of
    weight before the next block without any.
    """
    blocks = [sum(weights[i : i + window]) for i in range(len(weights))]
    runs, i = [], 0
    while i < len(weights):
        if not weights[i] or blocks[i] < surge:
            i += 1
            continue
        end = i
        while end + 1 < len(weights) and blocks[end + 1] > 0:
            end += 1
        last = end
        while not weights[last]:
            last -= 1
        runs.append((i, last))
        i = end + 1
    return runs


def main_lines(page: str, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between the surges and dives of the line-block distribution."""
    lines, seen = lines_of_page(page), {}
    states = [_state(line.element, seen) for line in lines]
    for line, (out, main) in zip(lines, states, strict=True):
        if not out:
            line.weight = NAMED * line.size if main else max(0, line.size - 2 * line.linked)
    runs = runs_of([line.weight for line in lines], window, surge)
    if not runs:
        return [line.text for line in lines if line.weight]
    mass = [sum(line.weight for line in lines[a : b + 1]) for a, b in runs]
    top = max(range(len(runs)), key=mass.__getitem__)
    home = _home([line for line in lines[runs[top][0] : runs[top][1] + 1] if line.weight])
    article = _state(home, seen)[1]
    if article is not None:
        return [line.text for line, (out, main) in zip(lines, states, strict=True) if not out and main is article]
    around: dict[int, bool] = {}
    at_home = [_within(line.element, home, around) for line in lines]
    kept = set()
    for (a, b), weight in zip(runs, mass, strict=True):
        if (a, b) == runs[top] or 2 * sum(lines[i].weight for i in range(a, b + 1) if at_home[i]) >= weight:
            # Inside a run a line may be mostly link, but not a link alone.
            kept.update(i for i in range(a, b + 1) if not states[i][0] and lines[i].linked < lines[i].size)
    # Short lines at the ends, such as a heading, belong to the text if they stand in an element of it.
    own = {id(home)} | {id(_container(lines[i].element)) for i in kept if at_home[i]}
    kept.update(i for i, line in enumerate(lines) if line.weight and id(_container(line.element)) in own)
    return [lines[i].text for i in sorted(kept)]


def main_text(page: str | None) -> str:
    """The main text, lines joined by a space; empty for a page without any."""
    return " ".join(main_lines(page)) if page else ""


@F.pandas_udf(StringType())
def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(page) for page in pages], dtype=object)


def extracted(page: Column) -> Column:
    """Main text of a column of pages; null and empty pages have an empty text."""
    return _extract(page.cast("string"))


def extract(pages: DataFrame, *, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns but the page itself, and its main text as text_col, which replaces a column of that name."""
    kept = [quoted(c) for c in pages.columns if c not in (html_col, text_col)]
    return pages.select(*kept, extracted(quoted(html_col)).alias(text_col))
