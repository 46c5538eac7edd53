"""HTML as nested token streams: a tolerant reader, and the marks of parts that aren't the article."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

#: Elements nested deeper than this stand beside their parent.
DEEPEST = 120

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|[^<]++|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-\w:]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
#: Elements that begin and end a block of text.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: What an opening tag ends, and where the search for it stops.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_STOPS = {"article", "body", "button", "div", "li", "main", "section", "table", "td", "th", "html", "blockquote"}
MAIN = {"article", "main"}
#: Elements that are never part of an article.
APART = {
    "aside", "button", "canvas", "dialog", "footer", "form", "head", "iframe", "input", "menu", "nav", "noembed", "noframes",
    "noscript", "object", "script", "select", "style", "svg", "template", "textarea", "title",
}
_APART_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "navigation", "search"}
#: Whole classes and ids that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
_APART_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "comment", "comments",
    "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "modal", "nav", "navbar", "newsletter", "pager", "pagination",
    "popup", "promo", "sidebar", "signup", "sponsor", "sponsored", "toolbar", "topbar",
}
#: These mark such parts too, but name subjects of articles as well. They are weak marks, as are compounds that a
#: marking word heads ("cookie-notice") or that pair one with a word for a container ("ad-box"): the host's
#: wrapper overrules them, and so does the share of the page's text that the part holds.
_WEAK_NAMES = {
    "alert", "banner", "consent", "copyright", "dialog", "disclaimer", "discussion", "form", "menu", "navigation", "notice",
    "notification", "overlay", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share",
    "sharing", "skip", "social", "subscribe", "subscription", "widget",
}
_CONTAINERS = {
    "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "column", "container", "content", "icons", "inner",
    "item", "items", "label", "left", "link", "links", "list", "main", "outer", "panel", "posts", "right", "section", "slot", "thread",
    "title", "top", "unit", "wrap", "wrapper",
}
#: With one of these a compound says something about its surroundings.
_NOT_APART = {"has", "is", "layout", "no", "non", "not", "page", "with", "without"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _mark(name: str) -> int:
    """0 for a name that doesn't mark a part as apart, 1 for a weak mark, 2 for a certain one."""
    if name in _APART_NAMES:
        return 2
    if name in _WEAK_NAMES:
        return 1
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if not words or _NOT_APART.intersection(words):
        return 0
    while len(words) > 1 and words[-1] in _CONTAINERS:
        words.pop()
    return int(words[-1] in _APART_NAMES or words[-1] in _WEAK_NAMES)


class Node:
    """An element: its key (tag and names), whether (weakly) marked as apart from the article, and what it holds."""

    __slots__ = ("tag", "key", "apart", "weak", "kids")

    def __init__(self, tag: str, key: str = "", apart: bool = False, weak: bool = False):
        self.tag, self.key, self.apart, self.weak = tag, key or tag, apart or weak, weak and not apart
        self.kids: list[Node | str] = []


def _element(tag: str, rest: str) -> Node:
    names, role, hidden, mark = [], "", False, 0
    if rest and "=" in rest or "hidden" in rest:
        for name, value in _ATTRIBUTE.findall(rest):
            name = name.lower()
            if name in ("class", "id"):
                found = value.strip("\"'").lower().split()
                names += found
                # ids of headings are anchors, and so are ids of sections that may name a subject
                if found and not (name == "id" and tag in _HEADINGS):
                    least = 2 if name == "id" and tag == "section" else 1
                    mark = max(mark, max(m if (m := _mark(n)) >= least else 0 for n in found))
            elif name == "role":
                role = value.strip("\"'").lower()
            elif name == "hidden":
                hidden = True
    apart = tag in APART or role in _APART_ROLES or hidden or mark == 2
    marks = sorted(n for n in names if not any(c.isdigit() for c in n))
    return Node("main" if role == "main" else tag, ".".join([tag, *marks]), apart, mark == 1)


def read(page: str) -> Node:
    """The page as a tree; text is decoded, comments are gone, what is left open ends with its surroundings."""
    root = Node("html")
    stack = [root]
    weak = False

    def close(targets: set[str], stops: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in targets:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.match(page, at)
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            text = found[0]
            if not text.startswith(("<!", "<?")):
                stack[-1].kids.append(html.unescape(text) if "&" in text else text)
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            close({tag}, set())
            continue
        if tag in ("html", "body"):
            continue
        rest = found[3] or found[6] or ""
        node = _element(tag, rest)
        if tag in _RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            node.kids.append("")
            stack[-1].kids.append(node)
            at = len(page) if stop is None else (page.find(">", stop.end()) + 1 or len(page))
            continue
        if tag in BLOCKS and tag != "br":
            close({"p"}, _P_STOPS)
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        if node.tag in MAIN:  # an article doesn't stand in a part that was left open
            first = next((i for i, n in enumerate(stack) if i and n.apart), None)
            if first is not None and not node.apart:
                del stack[first:]
        stack[-1].kids.append(node)
        weak |= node.weak
        if tag not in _VOID and len(stack) < DEEPEST:
            stack.append(node)
    if weak:
        _settle(root)
    return root


def _settle(root: Node) -> None:
    """Takes weak marks from parts that hold more than half of the text of their article or, outside one, of the page."""

    def length(node: Node) -> int:
        if node.apart and not node.weak:
            return 0
        return sum(length(k) if isinstance(k, Node) else len("".join(k.split())) for k in node.kids)

    def clear(node: Node, whole: int) -> None:
        for kid in node.kids:
            if isinstance(kid, Node) and not (kid.apart and not kid.weak):
                if kid.weak and 2 * length(kid) > whole:
                    kid.apart = kid.weak = False
                if not kid.weak:
                    clear(kid, length(kid) if kid.tag in MAIN else whole)

    clear(root, length(root))


def articles(root: Node) -> list[Node]:
    """The outermost article or main elements that aren't apart, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.apart:
            continue
        if node.tag in MAIN:
            found.append(node)
        else:
            stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))
    return found


def blocks(parts: Iterator[str | None]) -> str:
    """Texts joined within blocks, white space made one space, blocks joined by one space; None ends a block."""
    out: list[str] = []
    held: list[str] = []
    for part in parts:
        if part is None:
            out.extend("".join(held).split())
            held = []
        else:
            held.append(part)
    out.extend("".join(held).split())
    return " ".join(out)
