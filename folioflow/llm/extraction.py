"""Main text of web pages by consensus host paths.

A page is read once into containers and text blocks. Containers are scored by the running text below
them that is neither link text nor within parts that are never an article (navigation, forms, adverts,
comments and so on, by tag, role and class). A page votes for the generalised path of its deepest container that
holds all of that text and all main headings: tags and classes from the root, digits made alike. Spark counts the
votes per host; the path with most votes wins, and pages are extracted anew from the elements on their host's path.
A page falls back to its own choice if it has no such element, or if a main heading, text of an article or main
element, or text right beside such an element, in a container around it, would be left out.

A class or id means such a part by its last word that says more than box or wrapper, by its first word unless that may as
well be a topic (an alert level, a notice period), and by words of adverts, cookies and readers' comments wherever they stand or
what they are joined to; not behind has, no, with and the like. Every element is judged: containers and blocks never on
an element that holds a main heading, a main element, the longest article or most of the page's running text (a discussion only
for the first two); inline ones take their own text out of the block they are in. Elements that are never text are skipped if they
are closed within their parent; else their tag alone is. Formulas are text, but for their sources in annotations.

Votes are aggregated before they are shuffled and the winners, one row per host, are a written table: while
small the planner broadcasts it by its measured size, else it is joined by a shuffle that Spark splits
where a host is hot.

Edge cases: null html is empty and gives an empty text; a null or unreadable url belongs to one host
without name; equal votes go to the first path; broken markup closes what it can; repeated rows get a row
each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.session import stored

SLICE_BYTES = 1 << 20

# Element names, by what they mean here.
RAW = frozenset("script style noscript template textarea title iframe svg select object canvas audio video annotation button".split())
CONTAINERS = frozenset(
    "html body div article section main table tbody thead tfoot tr td th ul ol dl form nav header footer aside center blockquote figure details fieldset menu dialog".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption caption summary address legend option hgroup".split())
NEVER = frozenset("nav footer aside form menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NAMES = frozenset(
    "nav navbar navigation menu sidebar footer header masthead ad ads adv advert adverts advertisement adsense banner promo sponsor sponsored cookie cookies "
    "consent gdpr notice notices alert popup modal overlay comment comments commentlist disqus reply replies share sharing social related recommended newsletter "
    "subscribe subscription signup login breadcrumb breadcrumbs pagination pager widget toolbar skip search".split()
)
DISCUSSION = frozenset("comment comments commentlist disqus reply replies reviews".split())
# Behind these the word before decides; these as first words may be a topic; these count anywhere in a name, and as beginnings of words.
PLAIN = frozenset("box wrapper wrap container area block section list item inner outer slot unit bar panel holder group row frame link links button buttons".split())
TOPICS = frozenset("alert notice notices search header banner widget skip promo share reply related overlay toolbar login signup subscription".split())
ANYWHERE = frozenset("ad ads advert adverts advertisement adsense cookie cookies comment comments commentlist disqus newsletter sponsored".split())
JOINED = re.compile("cookie(?:bar|box|banner|notice|consent|law)|adsby|adsense|advert(?:is|s)|(?:ad|comment|comments)(?:box|list|wrapper|container|slot|unit|area|form)$")
# Blocks that end where the next of their name begins.
ENDED = frozenset("li dt dd option".split())
# Elements without content.
EMPTY = frozenset("br img input hr wbr meta link source track area base col embed param".split())
# A class behind one of these says what else there is, or is not.
MODIFIERS = frozenset("has no not non with without hide".split())
# RAW elements whose content is text up to their end, or up to the end of the page.
TEXT_ONLY = frozenset("script style".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_STRUCTURE = re.compile(rf"</?(?:{'|'.join(sorted(CONTAINERS))})(?=[\s/>])", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TELLING = re.compile(r"class|id|hidden|style|role", re.I)
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")


def _closings(markup: str) -> dict[int, int]:
    """Where elements of RAW that are closed within their parent start (behind the tag) and end; linear."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    position = 0
    while token := _TOKEN.search(markup, position):
        position = token.end()
        name = (token[2] or "").lower()
        if name in TEXT_ONLY and not token[1] and not token[3].rstrip().endswith("/"):
            close = re.compile(rf"</{name}\s*>", re.I).search(markup, position)
            position = close.end() if close else len(markup)
        elif name not in RAW and name not in CONTAINERS:
            continue
        elif not token[1]:
            if name in CONTAINERS or not token[3].rstrip().endswith("/"):
                opened[name] += 1
                stack.append((name, position))
        elif opened[name]:
            while True:
                gone, start = stack.pop()
                opened[gone] -= 1
                if gone == name:
                    break
            if name in RAW:
                out[start] = position
    return out


def _chrome(classes: list[str]) -> int:
    """2 if a class or id names a discussion, 1 another part that is never an article, else 0."""
    found = 0
    for token in classes:
        words = [w.lower() for w in _NAME.findall(token)]
        if not words or words[0] in MODIFIERS:
            continue
        last = len(words) - 1
        while last and words[last] in PLAIN:
            last -= 1
        said = {words[last], *(w for w in words if w in ANYWHERE or JOINED.match(w))}
        if words[0] not in TOPICS:
            said.add(words[0])
        for word in said:
            joined = JOINED.match(word)
            found = max(found, 2 if word in DISCUSSION or joined and word.startswith("comment") else int(word in NAMES or joined is not None))
    return found


class Page:
    """Containers of a page, each with its parent, step and verdict, and blocks of text in page order.

    A path is held as its hash, made from the parent's, so that depth costs nothing.
    """

    def __init__(self, markup: str):
        self.parent: list[int] = [-1]
        self.kind: list[str] = [""]
        self.step: list[str] = [""]
        self.key: list[int] = [0]
        self.article: list[bool] = [False]
        self.never: list[bool] = [False]
        self.named: list[int] = [0]  # by class or id
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters of running text; a main heading is all that
        self.headings: list[int] = []  # blocks that are main headings
        self._read(markup)
        if any(self.named):
            self._judge_names()

    def _read(self, markup: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        opened: Counter[str] = Counter()
        run: list[str] = []
        linked = links = 0
        at = 0
        heading = False
        muted: list[tuple[str, str]] = []  # the inline element whose text is left out, and elements of its name in it
        ends: dict[int, int] | None = None

        def flush() -> None:
            nonlocal run, linked
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                if heading:
                    self.headings.append(len(self.blocks))
                self.blocks.append((stack[-1][1], text, len(text) if heading else max(0, len(text) - 2 * linked)))
            run, linked = [], 0

        position, size = 0, len(markup)
        while position < size:
            token = _TOKEN.search(markup, position)
            end = token.start() if token else size
            if end > at and not muted:
                run.append(markup[at:end])
                if links:
                    linked += end - at
            if not token:
                break
            position = at = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                if muted and name == muted[-1][0]:
                    muted.pop()
                if name == "a":
                    links = max(0, links - 1)
                if name in BLOCKS or opened[name]:
                    flush()
                    links, heading, muted = 0, False, []
                    if opened[name]:
                        while True:
                            gone = stack.pop()[0]
                            opened[gone] -= 1
                            if gone == name:
                                break
                continue
            if name in RAW:
                if token[3].rstrip().endswith("/"):
                    continue
                if name in TEXT_ONLY or ends is None:
                    close = re.compile(rf"</{name}\s*>", re.I).search(markup, position)
                    if name in TEXT_ONLY or (close and not _STRUCTURE.search(markup, position, close.start())):
                        position = at = close.end() if close else size
                        continue
                    ends = _closings(markup)
                position = at = ends.get(position, position)
                continue
            if name == "br" and not muted:
                run.append(" ")
            elif name in BLOCKS:
                flush()
                links, heading = 0, name == "h1"
                if muted:  # an inline element around blocks is one of them
                    opened[muted[0][0]] += 1
                    stack.append((muted[0][0], self._container(*muted[0], stack[-1][1])))
                    muted = []
                # A paragraph ends where a block begins, an item where the next does.
                while stack[-1][0] == "p" or stack[-1][0] == name and name in ENDED:
                    opened[stack.pop()[0]] -= 1
                if name in CONTAINERS or self._out(token[3]):
                    opened[name] += 1
                    stack.append((name, self._container(name, token[3], stack[-1][1])))
            elif name not in EMPTY and not token[3].rstrip().endswith("/"):
                if muted:
                    if name == muted[0][0]:
                        muted.append((name, ""))
                elif self._out(token[3]):
                    muted.append((name, token[3]))
                if name == "a":
                    links += 1
        flush()

    @staticmethod
    def _out(attributes: str) -> bool:
        """Whether an element other than a container is named like no part of an article, or hidden."""
        if not _TELLING.search(attributes):
            return False
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(_ATTRIBUTE.finditer(attributes)))}
        return "hidden" in found or bool(_HIDDEN.search(found.get("style", ""))) or found.get("role", "").lower() in ROLES or _chrome([*found.get("class", "").split(), found.get("id", "")]) > 0

    def _container(self, name: str, attributes: str, parent: int) -> int:
        found: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        classes = found.get("class", "").split()
        never = self.never[parent] or name in NEVER or found.get("role", "").lower() in ROLES or (name == "header" and not self.article[parent])
        never = never or "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
        named = 0 if name in ("html", "body", "article", "main") else _chrome([*classes, found.get("id", "")])
        step = name + "".join(f".{c}" for c in sorted({_DIGITS.sub("N", c.lower()).replace("/", "|") for c in classes}))
        self.parent.append(parent)
        self.step.append(step)
        self.key.append(hash((self.key[parent], step)))
        self.article.append(self.article[parent] or name in ("article", "main"))
        self.never.append(never)
        self.named.append(named)
        self.kind.append(name)
        return len(self.parent) - 1

    def _judge_names(self) -> None:
        """Elements named like no article are never one, unless they hold it."""
        below, holds, article = [0] * len(self.parent), [0] * len(self.parent), 0
        for container, _, running in self.blocks:
            if not self.never[container]:
                below[container] += running
        for number in self.headings:
            if not self.never[self.blocks[number][0]]:
                holds[self.blocks[number][0]] = 2
        for i in range(len(below) - 1, 0, -1):
            if self.kind[i] == "main" and not self.never[i]:
                holds[i] = 2
            if self.kind[i] == "article" and below[i] and below[i] >= below[article] * (article > 0):
                article = i
            below[self.parent[i]] += below[i]
            holds[self.parent[i]] = max(holds[self.parent[i]], holds[i])
        while article:
            holds[article] = max(holds[article], 1)
            article = self.parent[article]
        for i in range(1, len(below)):
            named = self.named[i] and holds[i] < self.named[i] and (self.named[i] == 2 or 2 * below[i] <= below[0])
            self.never[i] = self.never[i] or self.never[self.parent[i]] or bool(named)

    def choice(self) -> int:
        """The deepest container with all running text; 0 if there is none."""
        below = [0] * len(self.parent)
        for container, _, running in self.blocks:
            if not self.never[container]:
                below[container] += running
        for i in range(len(below) - 1, 0, -1):  # children come after their parents
            below[self.parent[i]] += below[i]
        if not below[0]:
            return 0
        best = 0
        for i in range(1, len(below)):
            if self.parent[i] == best and below[i] == below[0]:
                best = i
        return best

    def path(self, container: int) -> str:
        """Tags and classes from the root, joined by slashes; empty for the root."""
        steps = []
        while container > 0:
            steps.append(self.step[container])
            container = self.parent[container]
        return "/".join(reversed(steps))

    def text(self, path: str | None) -> str:
        """Blocks below the elements on a path, or below the page's own choice if those do not hold its article."""
        wanted = 0
        for step in path.split("/") if path else ():
            wanted = hash((wanted, step))
        roots = {i for i, k in enumerate(self.key) if i and k == wanted and not self.never[i]}
        inside = self._inside(roots)
        if not roots or self._leaves_out(roots, inside):
            inside = self._inside({self.choice()})
        return "\n".join(text for container, text, _ in self.blocks if inside[container] and not self.never[container])

    def _inside(self, roots: set[int]) -> list[bool]:
        inside = [i in roots for i in range(len(self.parent))]
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[self.parent[i]]
        return inside

    def _leaves_out(self, roots: set[int], inside: list[bool]) -> bool:
        """Whether running text of the article is not inside: a main heading, in an article or main, or right beside a root."""
        around = [False] * len(self.parent)
        for i in range(len(around) - 1, 0, -1):
            if around[i] or i in roots:
                around[self.parent[i]] = True
        headings = set(self.headings)
        return any(
            running and not inside[c] and not self.never[c] and (self.article[c] or around[c] or number in headings)
            for number, (c, _, running) in enumerate(self.blocks)
        )


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _host(F.col("url").cast("string")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path): one vote per page that has running text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "html", SLICE_BYTES):
            read = [Page(markup) for markup in batch.column("html").to_pylist()]
            paths = [page.path(page.choice()) or None for page in read]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])

    return C.map_arrow(_pages(pages).select("host", "html"), step, "host string, path string").where("path is not null")


def winners(cast: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host, by name among equals."""
    counted = cast.groupBy("host", "path").count()
    best = F.min(F.struct((-F.col("count")).alias("less"), F.col("path").alias("path"))).alias("best")
    return counted.groupBy("host").agg(best).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points), one row per page."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, "html", SLICE_BYTES):
            texts = [Page(m).text(p) for m, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    own = _pages(pages)
    joined = own.join(stored(winners(votes(pages))), "host", "left").select("page_id", "url", "html", "path")
    return C.map_arrow(joined, step, f"page_id {own.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
