"""Main text of web pages by consensus host paths.

Each page scores its containers by the text of their paragraphs and names
the best one by its generalised path of tags and classes. Forms and elements
with names of boilerplate are dropped only after the page is read, so that one
that wraps the page's content isn't: content is told by structure (main,
articles, the title with paragraphs), never by length. Spark counts the
votes for each host; the path that wins on a host is then extracted from all
of its pages. A page without that path falls back on its own best container.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hosts up to which the winning paths are broadcast (some 200 bytes each); beyond it they are joined on host and a salt.
MAX_BROADCAST_HOSTS = 20_000
SALTS = 64

# Elements of HTML by their role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg annotation annotation-xml iframe object select button canvas audio video datalist".split())
#: The rest of a page without their end tag is theirs; other raw elements without one are skipped as tags. Some can't hold their own kind.
TO_END = frozenset("script style textarea title".split())
FLAT = frozenset("select button".split())
DROPPED = frozenset("nav footer aside form head menu dialog".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
CLOSES_P = BLOCKS - {"body", "html", "option", "optgroup", "caption", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"}
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
BAD_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-?bar|widget|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookies?|consent|notices?|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|social|related|recommended|comments?|commentlist|disqus|replies|reply|respond|login|signup|search|pagination|pager)(?:$|[\s_-])", re.I)
#: Names that say something about the element, not that it is boilerplate: ``has-sidebar``, ``content-with-sidebar``, ``comments-open``.
STATE = re.compile(r"^(?:has|no|with|without|is|show|hide)[_-]|[_-](?:with|without|no)[_-]|[_-](?:open|opened|closed|enabled|disabled|on|off|active|inactive|count)$", re.I)
#: Words that are also said of content when they stand alone, such as the classes of ``social science`` or ``related research``.
AMBIGUOUS_NAME = re.compile(r"^(?:social|related|recommended|search|share|sharing|reply|banner|notices?|menu|overlay|widget)$", re.I)
COMMENT_NAME = re.compile(r"(?:^|[_-])(?:comments?|commentlist|disqus|replies|reply|respond)(?:$|[_-])", re.I)
#: What an element may be dropped by: its role or tag for good; a name or a form, unless its structure shows the page's content; a word of two meanings, unless a second sign speaks for content.
NO_DROP, HARD, NAMED, COMMENT, AMBIGUOUS = 0, 1, 2, 3, 4
#: Weight of text in an element that has a name of boilerplate and the page's content.
WRAPPED = 0.5
#: A content article that has no first-level heading has so many paragraphs; a named element of two meanings has so many, or a heading and one, and less than this share of links.
PARAGRAPHS, LINKED = 2, 0.3
HEADINGS = frozenset("h1 h2 h3 h4".split())
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|main|body|text)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class _Node:
    __slots__ = ("parent", "tag", "path", "end", "score", "mark", "drop", "wrapped", "inside")

    def __init__(self, parent: int, tag: str, path: str, mark: int, inside: bool):
        self.parent, self.tag, self.path, self.end, self.score, self.mark, self.drop, self.wrapped, self.inside = parent, tag, path, -1, 0.0, mark, False, False, inside


class Page:
    """Elements in page order and blocks of text (element, text) outside of boilerplate."""

    def __init__(self, source: str):
        self.nodes = [_Node(-1, "", "", NO_DROP, False)]
        self._found: list[tuple[int, str, int]] = []  # element, text, length of its links
        self._endless: set[str] = set()
        self.blocks: list[tuple[int, str]] = []
        self._stack, self._text, self._at, self._linked, self._in_link = [0], [], 0, 0, 0
        self._read(source)
        self._flush()
        for i in self._stack:
            self.nodes[i].end = len(self.nodes)
        self._decide()
        for at, text, linked in self._found:
            if not self.nodes[at].drop:
                self.blocks.append((at, text))
                self._count(at, len(text) - 2 * min(linked, len(text)))

    def _decide(self) -> None:
        """Which of the marked elements are dropped: those for good, and the others unless their structure shows content. How long they are doesn't count."""
        nodes, n = self.nodes, len(self.nodes)
        if any(x.mark > HARD for x in nodes):
            hard, marked, listed = [False] * n, [False] * n, [False] * n
            for i, x in enumerate(nodes):
                up = x.parent if i else 0
                hard[i], marked[i], listed[i] = x.mark == HARD or (i > 0 and hard[up]), x.mark != NO_DROP or (i > 0 and marked[up]), x.tag == "li" or (i > 0 and listed[up])
            length, linked, paragraphs = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
            outside = False
            for at, text, links in self._found:
                if hard[at]:
                    continue
                outside = outside or not marked[at]
                length[at + 1] += len(text)
                linked[at + 1] += min(links, len(text))
                while nodes[at].tag not in BLOCKS and at:
                    at = nodes[at].parent
                paragraphs[at + 1] += nodes[at].tag == "p"
            for sums in (length, linked, paragraphs):
                for i in range(n):
                    sums[i + 1] += sums[i]
            held = lambda i, sums: sums[nodes[i].end] - sums[i]
            among = lambda i, places: bisect.bisect_left(places, nodes[i].end) - bisect.bisect_left(places, i)
            mains = [i for i in range(n) if nodes[i].tag == "main" and held(i, length)]
            titles = [i for i in range(n) if nodes[i].tag == "h1" and not hard[i] and held(i, length)][:1]
            articles = [i for i in range(n) if nodes[i].tag == "article" and not listed[i] and not hard[i] and (among(i, titles) or held(i, paragraphs) >= PARAGRAPHS)]
            headed = [i for i in range(n) if nodes[i].tag in HEADINGS]
            free = [i for i in (*mains, *articles) if not marked[i]]
            for i, x in enumerate(nodes):
                if x.mark in (NAMED, COMMENT):
                    if among(i, mains):
                        x.mark = NO_DROP
                    elif x.mark == NAMED and (not outside or (among(i, titles) and held(i, paragraphs)) or (among(i, articles) and among(i, articles) == len(articles))):
                        x.mark, x.wrapped = NO_DROP, True
                elif x.mark == AMBIGUOUS:
                    shown = held(i, paragraphs) >= PARAGRAPHS or (held(i, paragraphs) and among(i, headed)) or among(i, mains) or among(i, articles)
                    if not outside or (shown and held(i, linked) < LINKED * held(i, length) and (x.inside or not free)):
                        x.mark, x.wrapped = NO_DROP, True
        for i, x in enumerate(nodes):
            x.drop = x.mark != NO_DROP or (i > 0 and nodes[x.parent].drop)
            x.wrapped = x.wrapped or (i > 0 and nodes[x.parent].wrapped)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self._found.append((self._at, text, self._linked))
            self._text, self._linked = [], 0

    def _count(self, node: int, score: float) -> None:
        """The nearest container gets a block's score, the next one half of it."""
        share = 1.0
        while node > 0 and share > 0.3:
            if self.nodes[node].tag in CONTAINERS:
                self.nodes[node].score += share * score
                share /= 2
            node = self.nodes[node].parent

    def _add(self, text: str) -> None:
        top = self._stack[-1]
        if text:
            if not self._text:
                if text.isspace():
                    return
                self._at = top
            self._text.append(text)
            if self._in_link:
                self._linked += len(text)

    def _pop(self, depth: int) -> None:
        if any(self.nodes[i].mark for i in self._stack[depth:]):
            self._flush()
        for i in self._stack[depth:]:
            self.nodes[i].end = len(self.nodes)
            self._in_link -= self.nodes[i].tag == "a"
        del self._stack[depth:]

    def _close(self, tag: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self.nodes[self._stack[depth]].tag == tag:
                self._pop(depth)
                return

    def _open(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            for depth in range(len(self._stack) - 1, 0, -1):
                t = self.nodes[self._stack[depth]].tag
                if t == "p":
                    self._pop(depth)
                    break
                if t in BLOCKS:
                    break
        if tag in CLOSES_SAME:
            for depth in range(len(self._stack) - 1, 0, -1):
                t = self.nodes[self._stack[depth]].tag
                if t in CLOSES_SAME[tag]:
                    self._pop(depth)
                    break
                if t in BARRIERS[tag]:
                    break
        parent = self.nodes[self._stack[-1]]
        mark, inside = NO_DROP, parent.inside or tag in ("article", "main")
        path = parent.path
        if tag in BLOCKS:
            names = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(attributes)} if "=" in attributes else {}
            words = [w for k, v in names.items() if k != "role" for w in v.split()]
            if (tag in DROPPED and tag != "form") or (tag == "header" and not inside) or names.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
                mark = HARD
            elif words and tag not in ("html", "body", "article", "main"):
                mark = self._named(words)
            if tag == "form" and mark == NO_DROP:
                mark = NAMED
            classes = ".".join(sorted({re.sub(r"\d+", "", c) for c in names.get("class", "").split()} - {""}))
            path = f"{path}/{tag}" + (f".{classes}" if classes else "")
        self.nodes.append(_Node(self._stack[-1], tag, path, mark, inside))
        self._stack.append(len(self.nodes) - 1)
        self._in_link += tag == "a"

    @staticmethod
    def _named(words: list[str]) -> int:
        """What the names of an element say of it; a plain word of boilerplate says more than one of two meanings."""
        found = NO_DROP
        for w in words:
            if BAD_NAME.search(w) and not STATE.search(w):
                kind = AMBIGUOUS if AMBIGUOUS_NAME.match(w) else COMMENT if COMMENT_NAME.search(w) else NAMED
                found = kind if found in (NO_DROP, AMBIGUOUS) else max(found, kind) if kind != AMBIGUOUS else found
        return found

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                self._add(source[at:])
                return
            self._add(source[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if tag in BLOCKS:
                self._flush()
            if tag == "br":
                self._add(" ")
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                if not m[3].endswith("/"):
                    at = self._after(tag, source, at)
            elif tag not in VOID:
                self._open(tag, m[3])

    def _after(self, tag: str, source: str, at: int) -> int:
        """Where a raw element's text ends."""
        if tag in self._endless:
            return at
        end = re.compile(rf"</{tag}\s*>" + (rf"|<{tag}(?=[\s>])" if tag in FLAT else ""), re.I).search(source, at)
        if end is None:
            if tag in TO_END:
                return len(source)
            self._endless.add(tag)
            return at
        return end.end() if end[0][1] == "/" else at

    def best(self) -> str | None:
        """Path of the container with the highest score; articles and telling names count more."""
        best, at = 0.0, None
        for n in self.nodes:
            if n.score > 0 and not n.drop:
                last = n.path.rpartition("/")[2]
                tag, _, names = last.partition(".")
                score = n.score * (4 if tag in ("article", "main") else 2 if GOOD_NAME.search(names.replace(".", " ")) else 1) * (WRAPPED if n.wrapped else 1)
                if score > best:
                    best, at = score, n.path
        return at

    def text(self, path: str) -> str | None:
        """Blocks of all containers with this path; None if there is none."""
        spans, last = [], -1
        for i, n in enumerate(self.nodes):
            if n.path == path and n.tag in CONTAINERS and i >= last:
                spans.append((i, n.end))
                last = n.end
        if not spans:
            return None
        out, k = [], 0
        for at, text in self.blocks:
            while k < len(spans) and at >= spans[k][1]:
                k += 1
            if k < len(spans) and at >= spans[k][0]:
                out.append(text)
        return "\n".join(out)


def _best_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [Page(x.as_py() or "").best() for x in b["html"]]
        yield pa.RecordBatch.from_arrays([b["host"], pa.array(found, pa.string())], names=["host", "path"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for source, path in zip(b["html"], b["path"], strict=True):
            page = Page(source.as_py() or "")
            text = page.text(path.as_py()) if path.is_valid else None
            if not text:
                own = page.best()
                text = (page.text(own) if own else None) or "\n".join(t for _, t in page.blocks)
            out.append(text)
        yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(out, pa.string())], names=["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``host`` and its winning ``path`` of pages (host, html)."""
    votes = pages.select("host", "html").mapInArrow(_best_paths, "host string, path string").where("path is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("n", "path")).alias("path"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars.

    A null or empty html has an empty text. Pages without a host (null or odd
    urls) share one host. Repeated rows and null ids are extracted like any
    other; other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    paths = host_paths(rows)
    known = paths.limit(MAX_BROADCAST_HOSTS + 1).collect()
    if len(known) <= MAX_BROADCAST_HOSTS:
        small = spark.createDataFrame([tuple(r) for r in known], "host string, path string")
        joined = rows.join(F.broadcast(small), "host", "left")
    else:
        salted = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    out = joined.select("page_id", "url", "html", "path").mapInArrow(_extract, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
