"""HTML as a well-nested tree of blocks and texts, read from any tag soup in one pass.

White space inside a block is one space, character references are decoded, and a block's inline markup is gone. An element's label is
its tag and the part it plays on the page by tag, role or class name (navigation, advert, comment…).
"""

from __future__ import annotations

import hashlib
import html
import re

# HTML's own element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark picture q ruby s samp small source "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("audio button canvas head iframe noscript object script select style svg template textarea title video".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
HOLDERS = frozenset("ul ol dl table".split())
TAGS = INLINE | DROPPED | VOID | frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)

# Words of class names, ids and roles, and the part they stand for.
PARTS = {
    word: part
    for part, words in {
        "ad": "ad ads adsense advert advertisement advertising adverts banner promo promoted sponsor sponsored",
        "nav": "breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination",
        "side": "aside complementary recommended related sidebar widget widgets",
        "note": "alert alertdialog consent cookie cookies gdpr modal newsletter notice overlay paywall popup subscribe",
        "talk": "comment comments disqus replies reply respond",
        "head": "header masthead topbar",
        "foot": "colophon contentinfo footer",
        "share": "share sharing social",
        "form": "login search signin signup",
        "main": "main",
        "body": "articlebody",
    }.items()
    for word in words.split()
}
TAG_PARTS = {"nav": "nav", "menu": "nav", "aside": "side", "footer": "foot", "header": "head", "form": "form", "dialog": "note", "main": "main"}
WHOLE = frozenset(["article", "body", "html", "main"])  # their class names say what the page has, not what they are

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s<>/]*+)((?:[^<>\"']++|\"[^\"]{0,4000}+\"|'[^']{0,4000}+')*+)>"
    r"|<(/?)([a-zA-Z][^\s<>/]*+)([^<>]*+)>?|<[!?][^>]*>",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
DEEPEST = 60  # elements kept inside one another
MOST_OPEN = 512  # further ones only end a block, as in browsers


def label_of(tag: str, attributes: str) -> str:
    """The tag (x for unknown ones), with a dot and the part if it plays one."""
    part = TAG_PARTS.get(tag)
    if not part and attributes:
        for match in _NAMED.finditer(attributes):
            words = _WORD.findall((match[1] or match[2] or match[3] or "").lower())
            if tag in WHOLE:
                part = "talk" if words == ["comment"] else None
            else:
                part = next((PARTS[w] for w in words if w in PARTS), None)
            if part:
                break
    name = tag if tag in TAGS else "x"
    return f"{name}.{part}" if part else name


class Element:
    __slots__ = ("label", "kids")

    def __init__(self, label: str):
        self.label, self.kids = label, []


class Text:
    __slots__ = ("text", "links")
    label = "#"

    def __init__(self, text: str, links: int):
        self.text, self.links = text, links

    def digest(self) -> str:
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class _Reader:
    def __init__(self):
        self.root = Element("page")
        self.open: list[tuple[str, Element]] = [("", self.root)]
        self.spans: dict[str, list[bool]] = {}
        self.buffer: list[str] = []
        self.linked = self.in_link = self.dropping = 0

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.open[-1][1].kids.append(Text(text, min(self.linked, len(text))))
            self.buffer, self.linked = [], 0

    def text(self, raw: str) -> None:
        if self.dropping or not raw:
            return
        if "&" in raw:
            raw = html.unescape(raw)
        self.buffer.append(raw)
        if self.in_link:
            self.linked += len(raw)

    def push(self, tag: str, label: str) -> None:
        if self.dropping or tag in DROPPED:
            self.dropping += 1
            self.open.append((tag, self.open[-1][1]))
            return
        self.flush()
        # Deeper elements keep their place in the text, and their texts go to the deepest one kept.
        node = self.open[-1][1] if len(self.open) > DEEPEST else Element(label)
        if node is not self.open[-1][1]:
            self.open[-1][1].kids.append(node)
        self.open.append((tag, node))

    def pop(self) -> None:
        if self.dropping:
            self.dropping -= 1
        else:
            self.flush()
        self.open.pop()

    def close(self, tags: frozenset[str], until: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of these tags and all inside it, unless one of `until` lies between."""
        for k in range(len(self.open) - 1, 0, -1):
            name = self.open[k][0]
            if name in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if name in until:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self.close(frozenset(["p"]), HOLDERS)
                self.flush()
            elif tag == "br":
                self.text(" ")
            return
        if tag in INLINE:
            label = label_of(tag, attributes)
            apart = "." in label and len(self.open) <= MOST_OPEN
            if apart:
                self.push(tag, label)
            self.in_link += tag == "a"
            if len(self.spans.setdefault(tag, [])) < 10_000:
                self.spans[tag].append(apart)
            return
        if self.open[-1][0] == "head" and tag not in IN_HEAD or tag == "body":
            self.close(frozenset(["head"]))
        if attributes.endswith("/") and tag not in TAGS:
            return
        if len(self.open) > MOST_OPEN:
            self.flush()
            return
        if not self.dropping and tag not in DROPPED:
            self.close(frozenset(["p"]), HOLDERS | WHOLE)
            self.in_link = 0
            if tag in CLOSED_BY:
                self.close(CLOSED_BY[tag], HOLDERS)
        self.push(tag, label_of(tag, attributes))

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.in_link = max(0, self.in_link - 1)
            if self.spans.get(tag) and self.spans[tag].pop():
                self.close(frozenset([tag]))
            return
        self.close(frozenset([tag]))


_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "iframe", "noscript")}


def read(source: str) -> Element:
    """The page's tree. What no tag can be read from is text; an unclosed script or comment goes on to the end, as in browsers."""
    page, at = _Reader(), 0
    while True:
        match = _TOKEN.search(source, at)
        if match is None:
            page.text(source[at:])
            break
        page.text(source[at : match.start()])
        at = match.end()
        name = match[2] or match[5]
        if name is None:
            continue
        tag, attributes = name.lower(), match[3] or match[6] or ""
        if match[1] or match[4]:
            page.end(tag)
        elif tag in _ENDS:
            stop = _ENDS[tag].search(source, at)
            if stop is None and tag not in ("noscript", "iframe"):
                break
            if stop is not None:
                at = stop.start()
                page.start(tag, "")
        else:
            page.start(tag, attributes)
    page.dropping = 0
    while len(page.open) > 1:
        page.pop()
    page.flush()
    return page.root
