"""The small per-page helper behind the page pass.

A page is kept as flat lists in document order. Node `i` spans `i..stop[i]`, so a subtree is a
slice and nothing here recurses. It runs inside Spark tasks only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import escape
from html import unescape as decode_reference
from html.entities import html5

from folioflow import schemas as S

# Fixed values of HTML: tags without content, and tags that end others when they start.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "center", "details", "dir", "div", "dl",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
HEAD_TAGS = {"base", "link", "meta", "script", "style", "title", "noscript"}
RANK = {
    "div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5,
    "body": 6, "html": 6,
}
# started tag -> (tags it ends, tags it does not reach beyond)
ENDS = {
    "a": ({"a"}, {"div", "table", "td", "li", "body"}),
    "li": ({"li"}, {"ul", "ol", "menu", "table", "body"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "body"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "body"}),
    "option": ({"option"}, {"select", "body"}),
    "td": ({"td", "th"}, {"tr", "table", "body"}),
    "th": ({"td", "th"}, {"tr", "table", "body"}),
    "tr": ({"tr"}, {"table", "body"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table", "body"}),
    "body": ({"head"}, set()),
}
P_SCOPE = (BLOCKS | {"li", "dd", "dt", "td", "th", "body"}) - {"p"}
RAW_TEXT = {"script", "style"}

TEXT, COMMENT = "#text", "#comment"
# A comment, a tag with its attributes, or other markup. Possessive, so it reads in linear time.
_ATTRIBUTE = r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+"""
_MARKUP = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/=]++|" + _ATTRIBUTE + r")*+)(?:>|\Z)"
    r"|<[!?/][^>]*+>?",
    re.S,
)
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_REFERENCE = re.compile(r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;)")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I) for tag in RAW_TEXT}
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def collapse(text: str) -> str:
    return " ".join(text.split())


def _decode(found: re.Match) -> str:
    """Numbers, and known names that end with a semicolon."""
    reference = found[0]
    known = reference[1] == "#" or reference[1:] in html5
    return decode_reference(reference) if known else reference


def unescape(text: str) -> str:
    return _REFERENCE.sub(_decode, text) if "&" in text else text


class Page:
    def __init__(self, html: str) -> None:
        self.tags: list[str] = []
        self.data: list = []
        self.stop: list[int] = []
        self._open: list[int] = []
        self._count: Counter[str] = Counter()  # open elements by tag
        self._seen: set[str] = set()
        self._last_text = -1
        self._read(html)
        self._end_from(0)

    # -- building ---------------------------------------------------------

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _MARKUP.search(html, at)
            upto = m.start() if m else size
            if upto > at:
                self._text(html[at:upto])
            if m is None:
                return
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m["comment"] is not None:
                    self._add(COMMENT, m["comment"])
                continue
            tag = tag.lower()
            if m["end"]:
                self._end_tag(tag)
                continue
            self._start_tag(tag, m["attrs"])
            if tag in RAW_TEXT:
                end = _RAW_END[tag].search(html, at)
                upto = end.start() if end else size
                if upto > at:
                    self._add(TEXT, html[at:upto])
                at = upto

    def _add(self, tag: str, data) -> int:
        self.tags.append(tag)
        self.data.append(data)
        self.stop.append(len(self.tags))
        return len(self.tags) - 1

    def _end_from(self, depth: int) -> None:
        for i in self._open[depth:]:
            self.stop[i] = len(self.tags)
            self._count[self.tags[i]] -= 1
        del self._open[depth:]
        self._last_text = -1

    def _end_implied(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_nearest({"p"}, P_SCOPE)
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])

    def _end_nearest(self, ended: set[str], limits: set[str]) -> None:
        if not any(self._count[tag] for tag in ended):
            return
        for depth in range(len(self._open) - 1, -1, -1):
            tag = self.tags[self._open[depth]]
            if tag in ended:
                self._end_from(depth)
                return
            if tag in limits:
                return

    def _start_tag(self, tag: str, attrs: str) -> None:
        if tag in ("html", "head", "body"):
            if tag in self._seen:
                return
            self._seen.add(tag)
        self._end_implied(tag)
        values = {}
        if attrs and not attrs.isspace():
            for name, *value in _ATTRIBUTES.findall(attrs):
                values.setdefault(name.lower(), unescape("".join(value)))
        i = self._add(tag, values)
        if tag not in VOID:
            self._open.append(i)
            self._count[tag] += 1

    def _end_tag(self, tag: str) -> None:
        if tag in ("html", "body") or not self._count[tag]:
            return
        rank = RANK.get(tag, 0)
        for depth in range(len(self._open) - 1, -1, -1):
            open_tag = self.tags[self._open[depth]]
            if open_tag == tag:
                self._end_from(depth)
                return
            if RANK.get(open_tag, 0) > rank:
                return

    def _text(self, text: str) -> None:
        text = unescape(text)
        if self._last_text == len(self.tags) - 1 >= 0:  # only ignored markup lies between
            self.data[-1] += text
        else:
            self._last_text = self._add(TEXT, text)

    # -- reading ----------------------------------------------------------

    def matches(self, i: int, tag: str | None, classes: str | None = None, id_: str | None = None):
        if tag is not None and self.tags[i] != tag:
            return False
        if classes is None and id_ is None:
            return True
        data = self.data[i]
        if id_ is not None and data.get("id") != id_:
            return False
        return classes is None or set(classes.split()) <= set(data.get("class", "").split())

    def find(self, tag, classes=None, id_=None, within=None) -> Iterator[int]:
        first, last = within or (0, len(self.tags))
        for i in range(first, last):
            if self.matches(i, tag, classes, id_):
                yield i

    def inside(self, spans: list[int]) -> Iterator[int]:
        """Every node below one of the given nodes, once, in document order."""
        reached = 0
        for i in spans:
            yield from range(max(i + 1, reached), self.stop[i])
            reached = max(reached, self.stop[i])

    def kept(self, first: int, last: int, dropped=frozenset()) -> Iterator[int]:
        i = first
        while i < last:
            if self.tags[i] in dropped:
                i = self.stop[i]
            else:
                yield i
                i += 1

    def html(self, nodes, end: int) -> str:
        out, open_tags = [], []

        def close(upto):
            while open_tags and open_tags[-1][0] <= upto:
                out.append(f"</{open_tags.pop()[1]}>")

        for i in nodes:
            close(i)
            tag, data = self.tags[i], self.data[i]
            if tag == TEXT:
                raw = open_tags and open_tags[-1][1] in RAW_TEXT
                out.append(data if raw else escape(data, quote=False))
            elif tag == COMMENT:
                out.append(f"<!--{data}-->")
            else:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in data.items())
                out.append(f"<{tag}{attrs}{'/' if tag in VOID else ''}>")
                if tag not in VOID:
                    open_tags.append((self.stop[i], tag))
        close(end)
        return "".join(out)

    def text(self, nodes) -> str:
        return collapse(" ".join(self.data[i] for i in nodes if self.tags[i] == TEXT))


# --------------------------------------------------------------------------
# What the page pass reads off one page
# --------------------------------------------------------------------------


_CONTENT_TAGS = {tag for tag, _, _ in S.CONTENT_NODES}


def _main_node(page: Page, nodes) -> int | None:
    candidates = [i for i in nodes if page.tags[i] in _CONTENT_TAGS]
    for tag, classes, id_ in S.CONTENT_NODES:
        for i in candidates:
            if page.matches(i, tag, classes, id_):
                return i
    return None


def _body_start(page: Page) -> int | None:
    """Where an unmarked body begins: after the head, its tags and leading blanks."""
    i, n = 0, len(page.tags)
    while i < n:
        tag = page.tags[i]
        if tag == "html":
            i += 1
        elif tag == "head" or tag in HEAD_TAGS:
            i = page.stop[i]
        elif tag == COMMENT or (tag == TEXT and not page.data[i].strip()):
            i += 1
        else:
            return i
    return None


def cleaned(page: Page, wrap: bool) -> tuple[str, str]:
    """The page without its chrome, as HTML and as text."""
    chrome = frozenset(S.CHROME_TAGS)
    end = len(page.tags)
    everything = list(page.kept(0, end, chrome))
    node = _main_node(page, everything)
    if node is None:
        node = next(page.find("body"), None)
    if node is not None:
        nodes = list(page.kept(node, page.stop[node], chrome))
        inner = page.html(nodes, page.stop[node])
    elif wrap:
        start = _body_start(page)
        nodes = [] if start is None else list(page.kept(start, end, chrome))
        inner = f"<body>{page.html(nodes, end)}</body>" if nodes else ""
    else:
        nodes = everything
        inner = page.html(nodes, end)
    html = S.PAGE_OPEN + inner + S.PAGE_CLOSE if wrap else inner
    return html, page.text(nodes)


def content_html(page: Page) -> str:
    end = len(page.tags)
    node = _main_node(page, range(end))
    return "" if node is None else page.html(range(node, page.stop[node]), page.stop[node])


def content_text(page: Page) -> str:
    for tag, classes, id_ in S.CONTENT_NODES:
        nodes = list(page.inside(list(page.find(tag, classes, id_))))
        if any(page.tags[i] == TEXT for i in nodes):
            return page.text(nodes)
    return ""


def anchors(page: Page) -> list[dict]:
    """Links in the places where an attachment may be, with what the choice among them needs."""
    spans = {
        "content": list(page.find("div", "content")),
        "related": list(page.find("div", "related-items related-file")),
        "item": list(page.find("div", "related-item-content")),
        "loose": [i for i in page.find("div") if "content" in page.data[i].get("class", "")],
    }
    inside = {
        place: [i for i in page.inside(nodes) if page.tags[i] == "a" and "href" in page.data[i]]
        for place, nodes in spans.items()
    }
    places = {place: set(nodes) for place, nodes in inside.items()}
    saying = _saying(page, spans["loose"], inside["loose"])
    return [
        {
            "href": page.data[i]["href"],
            **{place: i in nodes for place, nodes in places.items()},
            "download": page.matches(i, "a", "download"),
            "says": i in saying,
        }
        for i in sorted(set().union(*places.values()))
    ]


def _saying(page: Page, spans: list[int], links: list[int]) -> set[int]:
    """Links whose text has the phrase. The text of the spans is joined once, and places in it looked up."""
    nodes = [i for i in page.inside(spans) if page.tags[i] == TEXT]
    ends, size = [], 0
    for i in nodes:
        size += len(page.data[i])
        ends.append(size)
    marks = _phrase_places("".join(page.data[i] for i in nodes))
    starts = [m for m, _ in marks]
    out = set()
    for i in links:
        first, last = bisect_left(nodes, i), bisect_left(nodes, page.stop[i])
        if first < last:
            k = bisect_left(starts, ends[first] - len(page.data[nodes[first]]))
            if k < len(marks) and marks[k][1] <= ends[last - 1]:
                out.add(i)
    return out


def _phrase_places(words: str) -> list[tuple[int, int]]:
    """(start, end) of the phrase in a text, whatever blanks are between its words."""
    pattern = r"[ \t\r\n]+".join(re.escape(w) for w in S.ATTACHMENT_PHRASE.split(" "))
    return [m.span() for m in re.finditer(pattern, words.translate(_ASCII_LOWER))]


def listings(page: Page) -> list[dict]:
    found = []
    for position, item in enumerate(page.find("li", "each-item clearfix")):
        span = (item, page.stop[item])

        def own_text(nodes):
            """First text node that is a direct child of one of the nodes."""
            for i in nodes:
                j = i + 1
                while j < page.stop[i]:
                    if page.tags[j] == TEXT:
                        return page.data[j]
                    j = page.stop[j]
            return None

        def title_links():
            heads = list(page.find("h2", "title", within=span))
            return [i for i in page.inside(heads) if page.tags[i] == "a"]

        def href(nodes):
            return next((page.data[i]["href"] for i in nodes if "href" in page.data[i]), None)

        reference = own_text(page.find("span", "refNO", within=span))
        button = href(page.find("a", "btn btn-primary", within=span))
        found.append(
            {
                "position": position,
                "identifier": reference,
                "title": own_text(title_links()),
                "description": own_text(page.find("p", "description", within=span)),
                "case_number": reference,
                "record_date": own_text(page.find("span", "date", within=span)),
                "href": button if button is not None else href(title_links()),
            }
        )
    return found


def next_href(page: Page) -> str | None:
    hits = (page.data[i]["href"] for i in page.find("a", "next") if "href" in page.data[i])
    return next(hits, None) or None


def base_href(page: Page) -> str | None:
    hits = (page.data[i]["href"] for i in page.find("base") if page.data[i].get("href"))
    return next(hits, None)
