"""A small tree of a page's block elements, and the features of its nodes.

Only what main-text extraction needs. Block elements become nodes; all others, known or not,
melt into their block's text, unless an unknown one begins with a block (then it is a block, too).
Scripts, styles, titles, templates, form choices and comments are skipped; of these, one without
its end tag ends where an open element does, or else with the page (scripts, styles) or at the
next tag (others). Fallback text and formulas are text. Unclosed paragraphs and list items end
where the next one starts, the text of a data list's option is skipped up to the next element,
a "<" that begins no tag is text, stray end tags are ignored, a cut-off page ends all open
elements.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[a-zA-Z/!?][^<]*\Z", re.S)
_ATTR = re.compile(r"(class|id|role|itemprop|style|hidden|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Fixed by the markup language: elements without text of the page, without content, and
#: blocks, and elements within a line of text.
RAW = frozenset("script style template textarea title select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noframes ol optgroup p pre search section summary
    table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("""a abbr acronym audio b bdi bdo big button canvas cite code data datalist del dfn em font i iframe ins kbd label map mark math
    meter nobr noscript object output picture progress q rb rp rt rtc ruby s samp slot small span strike strong sub sup svg time tt u var
    video""".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_WHOLE = frozenset(("#page", "html", "body"))
_SCOPE = frozenset("ul ol dl table body article section div main aside nav header footer form".split())

#: Word stems of class, id and role attributes, by what they speak for.
STEMS = {
    "main": "article articlebody body content entry main post prose read story text".split(),
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination tabs toc topbar".split(),
    "head": "banner header head hero masthead brand logo".split(),
    "foot": "bottom colophon copyright foot footer legal".split(),
    "side": "aside related recommend recommended rail secondary side sidebar trending widget".split(),
    "ad": "ad ads advert advertisement promo promoted promotion sponsor sponsored outbrain taboola".split(),
    "notice": "alert consent cookie cookies disclaimer gdpr modal notice overlay popup privacy toast warning".split(),
    "form": "contact form login newsletter search signin signup subscribe subscription".split(),
    "comment": "comment comments commentlist discussion disqus feedback replies reply respond review reviews".split(),
    "share": "author byline follow meta share sharing social tags".split(),
}
_STEM_OF = {w: i for i, words in enumerate(STEMS.values()) for w in words}
_KINDS = {"article": 0, "main": 0, "nav": 1, "menu": 1, "header": 2, "footer": 3, "aside": 4, "form": 5, "fieldset": 5, "dialog": 6}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
FEATURES = 44
CHARS = 2 * len(STEMS) + 7 + 2  # the feature that is 0 for a node without text


class Node:
    __slots__ = ("tag", "parent", "depth", "stems", "kids", "own", "linked", "links", "inputs", "below", "chars", "link_chars", "tags", "words", "stops", "label", "start")

    def __init__(self, tag: str, parent: Node | None, attrs: str, start: int):
        self.tag, self.parent, self.start = tag, parent, start
        self.depth = parent.depth + 1 if parent else 0
        self.kids: list[Node] = []
        self.own = self.linked = self.links = self.inputs = self.words = self.stops = 0
        self.stems = 0
        self.label: int | None = None
        if attrs:
            for m in _ATTR.finditer(attrs):
                for w in _WORD.findall(m[2] or m[3] or m[4] or ""):
                    i = _STEM_OF.get(w.lower())
                    if i is not None:
                        self.stems |= 1 << i
            if "data-kept" in attrs:
                self.label = int('data-kept="1"' in attrs)


def _end_of(tags: list[str], html: str, pos: int) -> re.Match | None:
    """The next end tag of one of the elements."""
    return re.compile(rf"</(?:{'|'.join(map(re.escape, tags))})\b[^>]*>", re.I).search(html, pos) if tags else None


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order (the first is the page), and runs of text: (node, text),
    one for each stretch of text that no block boundary interrupts."""
    nodes = [Node("#page", None, "", 0)]
    runs: list[tuple[int, str]] = []
    index = {id(nodes[0]): 0}
    open_ = [nodes[0]]
    anchors = pos = seen = 0
    piece: list[str] = []

    def flush() -> None:
        nonlocal piece
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                node = open_[-1]
                runs.append((index[id(node)], text))
                node.words += text.count(" ") + 1
                node.stops += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            piece = []

    def text(raw: str) -> None:
        nonlocal seen
        if raw:
            raw = unescape(raw) if "&" in raw else raw
            piece.append(raw)
            n = len(raw.strip())
            open_[-1].own += n
            seen += n
            if anchors:
                open_[-1].linked += n

    def inline(tag: str) -> bool:
        """Whether an element that begins at ``pos`` is part of a line of text."""
        if tag in BLOCK or tag in INLINE:
            return tag in INLINE
        m = find(html, pos)
        return m is None or bool(m[1]) or (m[2] or "").lower() not in BLOCK or bool(html[pos:m.start()].strip())

    n, find = len(html), _TOKEN.search
    while pos < n:
        m = find(html, pos)
        if m is None:
            text(html[pos:])
            break
        text(html[pos:m.start()])
        pos = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, attrs = tag.lower(), m[3] or ""
        if m[1]:  # an end tag
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag == "p" and not any(x.tag == "p" for x in open_):
                flush()
            elif any(x.tag == tag for x in open_[1:]):
                flush()
                while open_.pop().tag != tag:
                    pass
            continue
        if tag == "br":
            piece.append(" ")
            continue
        if tag in VOID:
            if tag in ("input", "embed"):
                open_[-1].inputs += 1
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            if tag in ("textarea", "select"):
                open_[-1].inputs += 1
            if not attrs.rstrip().endswith("/"):
                end = _end_of([tag], html, pos)
                if end:
                    pos = end.end()
                else:
                    end = _end_of([x.tag for x in open_[1:]], html, pos)
                    m = None if end or tag in ("script", "style") else find(html, pos)
                    pos = end.start() if end else m.start() if m else n
            continue
        if tag == "option":  # outside a select: its text ends where another element begins or ends
            while (m := find(html, pos)) and (m[2] is None or m[2].lower() in INLINE - {"datalist"}):
                pos = m.end()
            pos = m.start() if m else n
            continue
        if inline(tag):
            if tag == "a":
                anchors += 1
                open_[-1].links += 1
            if tag == "button":
                open_[-1].inputs += 1
            continue
        flush()
        if tag in ("html", "body") and any(x.tag == tag for x in open_):
            continue
        anchors = 0
        if open_[-1].tag == "p":
            open_.pop()
        elif tag in _CLOSES:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in _CLOSES[tag]:
                    del open_[k:]
                    break
                if open_[k].tag in _SCOPE:
                    break
        if tag == "head":
            end = re.compile(r"</head\s*>|<body\b", re.I).search(html, pos)
            if end:
                pos = end.end() if html[end.start() + 1] == "/" else end.start()
            continue
        node = Node(tag, open_[-1], attrs, seen)
        open_[-1].kids.append(node)
        index[id(node)] = len(nodes)
        nodes.append(node)
        open_.append(node)
    flush()
    return nodes, runs


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: tag kind, attribute stems of the node and of those above it, depth,
    place, own and subtree text and link density, list and input counts, sibling statistics."""
    for x in reversed(nodes):
        x.below = len(x.kids) + sum(k.below for k in x.kids)
        x.chars = x.own + sum(k.chars for k in x.kids)
        x.link_chars = x.linked + sum(k.link_chars for k in x.kids)
        x.tags = 1 + x.links + sum(k.tags for k in x.kids)
        x.words += sum(k.words for k in x.kids)
        x.stops += sum(k.stops for k in x.kids)
        x.inputs += sum(k.inputs for k in x.kids)
    total = max(1, nodes[0].chars)
    out = np.zeros((len(nodes), FEATURES), np.float64)
    above: dict[int, tuple[int, int]] = {}
    stems = len(STEMS)
    for r, x in enumerate(nodes):
        up = x.parent
        s, kinds = above[id(up)] if up else (0, 0)
        kind = _KINDS.get(x.tag)
        own_kind = 1 << kind if kind is not None else 0
        above[id(x)] = (s | x.stems, kinds | own_kind)
        f = out[r]
        for i in range(stems):
            f[i] = x.stems >> i & 1
            f[stems + i] = s >> i & 1
        for i in range(7):
            f[2 * stems + i] = (kinds | own_kind) >> i & 1
        c = 2 * stems + 7  # 27
        chars = x.chars
        f[c] = x.depth
        f[c + 1] = x.start / total
        f[c + 2] = np.log1p(chars)
        f[c + 3] = np.log1p(x.own)
        f[c + 4] = x.link_chars / max(1, chars)
        f[c + 5] = chars / x.tags
        f[c + 6] = chars / max(1, x.words)
        f[c + 7] = x.stops / max(1, x.words)
        f[c + 8] = x.inputs
        f[c + 9] = chars / total
        f[c + 10] = x.tag in _HEADINGS
        f[c + 11] = x.tag == "p"
        f[c + 12] = x.tag in ("li", "ul", "ol", "dl")
        if up:
            peers = len(up.kids)
            f[c + 13] = peers
            f[c + 14] = chars / max(1, up.chars)
            f[c + 15] = np.log1p((up.chars - up.own) / peers)
            f[c + 16] = up.link_chars / max(1, up.chars)
    return out


def decode(nodes: list[Node], p: np.ndarray, leave: float = 3.0) -> np.ndarray:
    """Kept nodes under the likeliest consistent labelling: the page is mixed, kept or dropped
    if it has text of its own, else mixed; under a mixed node a child is mixed, kept or
    dropped; under a kept one, kept or, at the cost ``leave`` (none directly under a page or body
    with text of its own), dropped; under a dropped one all is dropped."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
    index = {id(x): i for i, x in enumerate(nodes)}
    mixed, kept, dropped = ([0.0] * len(nodes) for _ in range(3))
    out = [0.0 if x.own and x.tag in _WHOLE else leave for x in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        own = x.chars > 0
        m, k, d = (-0.9 if own else 0.0), (yes[i] if own else 0.0), (no[i] if own else 0.0)
        for c in x.kids:
            j = index[id(c)]
            m += max(mixed[j], kept[j], dropped[j])
            k += max(kept[j], dropped[j] - out[i])
            d += dropped[j]
        if x.own and x.tag in _WHOLE:  # mixed, the page's own text is dropped
            m += no[i] + 0.9
        elif x.own:  # a mixed node with text of its own would leave that text undecided
            m -= 2.0
        mixed[i], kept[i], dropped[i] = m, k, d
    state = np.zeros(len(nodes), np.int8)  # 0 mixed, 1 kept, 2 dropped
    for i, x in enumerate(nodes):
        if i or x.own:
            above = index[id(x.parent)] if i else 0
            up = state[above] if i else 0
            if up == 2:
                state[i] = 2
            elif up == 1:
                state[i] = 1 if kept[i] >= dropped[i] - out[above] else 2
            else:
                best = max(mixed[i], kept[i], dropped[i])
                state[i] = 1 if kept[i] == best else 2 if dropped[i] == best else 0
    return state == 1
