"""Main-text extraction by consensus host paths.

1. Each page's containers are scored: the text of the blocks directly inside
   them (their parents get half), less what stands in links, with a bonus for
   the elements that mark an article.
2. The best container's generalised path (tags with their classes, digits
   made ``#``) is the page's vote. Spark counts votes per host and path with
   map-side partial counts, so a hot host costs one row per path and task.
3. Each page is put beside its host's winning paths (those with at least
   ``MIN_SHARE`` of the host's votes, most votes first, so at most
   1 / MIN_SHARE of them; broadcast up to a measured size, else joined with
   salted hosts, so that no host's pages meet in one task) and the text of all its elements on the first
   winning path that it has is extracted again. A page that has none of them
   is extracted by its own best container.

Left out below a container: menus, sidebars, adverts, notices, forms,
comments and the like, by tag, role or name (a form not when it holds most of
the page's text); scripts, styles, drawings and
markup; headers but for their headings; footers. A class or id counts when it
is such a name itself, ends in one (``site-footer``) or is made of one and words
for a part of a page (``ad-slot``), but not when it tells a state
(``no-sidebar``), and never on an element that holds more than half of the
page's text outside of links, unless an article stands beside it. Character
references are decoded per run of text, white space inside a block becomes
one space and blocks are joined by one space.

Defined cases: a null or empty html, or a page of nothing but the parts left
out, gives the empty string; a null or odd url votes under its own host ``''``;
pages of any length are parsed whole; broken markup (unclosed or stray tags,
bare ``<``) never fails; repeated rows vote and come back once each; an empty
table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import md5
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlens.llm.common import free_name, slices, written

#: Share of a host's votes that makes a path a winning one.
MIN_SHARE = 0.1

_ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<empty>svg|math|object|iframe)\b{_ATTRS}(?<=/)>"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select)\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][\w:-]*)(?P<attrs>{_ATTRS}|[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
#: A whole attribute: its name and, quotes included, its value.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?|"[^"]*"|'[^']*'""")
#: Characters of a path that is written out; a longer one is named by a hash.
PATH_CHARS = 512
_NAMES = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[^a-z0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# Fixed values of the markup language and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark object q rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtext munder munderover semantics".split())
#: An open element of the key ends where one of the values begins.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
            "th": {"td", "th", "tr"}, "option": {"option"}}
CONTAINERS = frozenset("html body article main section div td blockquote form ul ol table tbody tr center header footer aside nav dl figure".split())
SKIPPED_TAGS = frozenset("nav aside footer button menu dialog head input".split())
#: Skipped like parts by name: not when they hold most of the page's text.
FORM_TAGS = frozenset(("form", "fieldset"))
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination popup promo promoted promotion recommended related reply replies "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split())
#: Words beside a skipped one in the name of such a part.
PART_WORDS = frozenset(
    "area articles bar block body bottom box button buttons center col column container content feed group holder icon icons inner item items left link "
    "links list outer panel posts right row section slot stories tab tabs text title top unit wrap wrapper zone".split())
#: With one of these a name tells what an element has or lacks, not what it is.
STATE_WORDS = frozenset("and disable disabled enable enabled has have hide hides is no non not off on show shows under when with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_TAGS = {"article": 1.5, "main": 1.3}
ARTICLE_WORDS = frozenset("article content entry main post story text body".split())


class Node:
    __slots__ = ("tag", "path", "parent", "skip", "first", "last", "bonus", "own", "linked", "hard", "number", "before", "link", "holder", "ends")

    def __init__(self, tag, path, parent, skip, first, bonus, hard=False, number=None, before=0):
        self.tag, self.path, self.parent, self.skip, self.first, self.bonus = tag, path, parent, skip, first, bonus
        inline = tag in INLINE
        self.link = inline and (tag == "a" or parent.link)  # its text is a link's
        # the container that a block's text is credited to
        self.holder = self if parent is None or tag in CONTAINERS else parent.holder
        # whether it or an open element up to the next container ends where some other begins
        self.ends = tag == "p" or tag in ENDED_BY or (tag not in CONTAINERS and parent is not None and parent.ends)
        self.last = -1  # end of its runs of text
        self.own = 0  # characters of its blocks and of runs directly in it
        self.linked = 0
        self.hard = hard  # skipped by more than names
        self.number = number  # if its own name has it skipped
        self.before = before  # unlinked characters before it


class Page:
    """A page's elements in page order and its runs of text; ``None`` ends a block."""

    def __init__(self, html: str):
        self._parse(html, frozenset())
        # an article beside it shows that even the longest of them is none
        held = frozenset(i for i, a, b in self.named if 2 * (b - a) > self.unlinked and not any(y <= a or b <= x for x, y in self.articles))
        if held:
            self._parse(html, held)

    def _parse(self, html: str, kept: frozenset[int]) -> None:
        """``kept``: numbers of elements that aren't skipped by their name."""
        self.kept = kept
        self.unlinked = 0  # characters outside of links, but for what is skipped by more than names
        self.named: list[tuple[int, int, int]] = []  # number, unlinked characters before and up to its end
        self.articles: list[tuple[int, int]] = []
        self.nodes: list[Node] = []
        self.runs: list[str | None] = []
        root = Node("", "", None, False, 0, 1.0)
        stack = [root]
        self.open: Counter = Counter()
        self.nodes.append(root)
        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at:m.start()], stack)
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if m["raw"] and m["raw"].lower() != "svg":
                    self.runs.append(None)
                continue
            tag = tag.lower()
            if tag not in INLINE:
                self.runs.append(None)
            if m["end"]:
                self._close(tag, stack)
            elif tag not in VOID:
                self._open(tag, m["attrs"], stack)
        if at < len(html):
            self._text(html[at:], stack)
        self._cut(stack, 0)

    def _open(self, tag: str, attrs: str, stack: list[Node]) -> None:
        if tag not in INLINE and stack[-1].ends:
            for k in range(len(stack) - 1, 0, -1):
                x = stack[k].tag
                if x == "p" or tag in ENDED_BY.get(x, ()):
                    self._cut(stack, k)
                    break
                if x in CONTAINERS:
                    break
        parent = stack[-1]
        classes, hard, number, bonus = "", parent.hard, None, ARTICLE_TAGS.get(tag, 1.0)
        if tag in SKIPPED_TAGS or tag == "header":
            hard = True
        if tag in FORM_TAGS:
            number = len(self.nodes)
        if attrs and not attrs.isspace():
            words: set[str] = set()
            names: list[str] = []
            seen: set[str] = set()
            for a in _ATTR.finditer(attrs):
                name, value = (a[1] or "").lower(), (a[2] or "").strip("\"'").lower()
                if name not in _NAMES or name in seen:  # the first of a name counts
                    continue
                seen.add(name)
                if name == "class":
                    classes = "." + ".".join(sorted({_DIGITS.sub("#", x) for x in value.split()})) if value.split() else ""
                if name in ("class", "id"):
                    words.update(_SPLIT.split(value))
                    names += value.split()
                elif name == "role":
                    hard = hard or value in SKIPPED_ROLES
                elif name == "hidden" or value == "true":  # hidden as such, or aria-hidden
                    hard = True
            if words & SKIPPED_WORDS and tag not in ("html", "body", "article", "main") and any(map(_skipped_name, names)):
                number = len(self.nodes)
            if words & ARTICLE_WORDS and tag in CONTAINERS:
                bonus = max(bonus, 1.2)
        skip = hard or parent.skip or (number is not None and number not in self.kept)
        if tag in HEADINGS and parent.tag == "header" and not _skipped_above_header(parent):
            skip = hard = False
            number = None
        path = parent.path
        if tag not in INLINE:
            path = f"{path}/{tag}{classes}"
            if len(path) > PATH_CHARS:
                path = f"#{md5(path.encode()).hexdigest()}"
        node = Node(tag, path, parent, skip, len(self.runs), bonus, hard, number, self.unlinked)
        self.nodes.append(node)
        stack.append(node)
        self.open[tag] += 1

    def _close(self, tag: str, stack: list[Node]) -> None:
        if not self.open[tag]:
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                self._cut(stack, k)
                return
            # a stray end tag of an inline element or paragraph doesn't end the container around it
            if stack[k].tag in CONTAINERS and (tag in INLINE or tag == "p"):
                return

    def _cut(self, stack: list[Node], k: int) -> None:
        for node in stack[k:]:
            self.open[node.tag] -= 1
            node.last = len(self.runs)
            if node.number is not None:
                self.named.append((node.number, node.before, self.unlinked))
            if node.tag in ARTICLE_TAGS and not node.skip and self.unlinked > node.before:
                self.articles.append((node.before, self.unlinked))
        del stack[k:]

    def _text(self, raw: str, stack: list[Node]) -> None:
        node = stack[-1]
        if node.hard:
            return
        skip = node.skip
        text = unescape(raw) if "&" in raw else raw
        if not skip:
            self.runs.append(text)
        n = len(text) if not text.isspace() else 0
        if n:
            if not node.link:
                self.unlinked += n
            if skip:
                return
            if node.link:
                node.holder.linked += n
            else:
                node.holder.own += n

    def best(self) -> Node:
        """The container with the best score; the first of equals, the root of an empty page."""
        score: dict[int, float] = {}
        for i, x in enumerate(self.nodes):
            if x.own:
                density = x.own / (x.own + x.linked)
                score[i] = score.get(i, 0.0) + x.own * density * x.bonus
        index = {id(x): i for i, x in enumerate(self.nodes)}
        total = dict(score)
        for i, s in score.items():
            up = self.nodes[i].parent
            up = up.holder if up is not None else None
            if up is not None and up.tag in CONTAINERS and not up.skip:
                j = index[id(up)]
                total[j] = total.get(j, 0.0) + s / 2 * up.bonus
        return self.nodes[min(total, key=lambda i: (-total[i], i))] if total else self.nodes[0]

    def text(self, nodes: list[Node]) -> str:
        """The runs below these elements, in page order, each once."""
        out, at = [], 0
        for x in nodes:
            for run in self.runs[max(at, x.first):x.last]:
                out.append(" " if run is None else run)
            out.append(" ")
            at = max(at, x.last)
        return " ".join("".join(out).split())

    def on_path(self, path: str) -> list[Node]:
        return [x for x in self.nodes if x.path == path and not x.skip and x.tag not in INLINE]


def _skipped_name(name: str) -> bool:
    """Whether a class or id is the name of a part left out."""
    words = [w for w in _SPLIT.split(name) if w and not w.isdigit()]
    if not words or not STATE_WORDS.isdisjoint(words):
        return False
    return words[-1] in SKIPPED_WORDS or (words[0] in SKIPPED_WORDS and all(w in SKIPPED_WORDS or w in PART_WORDS for w in words))


def _skipped_above_header(node: Node) -> bool:
    """Whether the header itself stands outside any article, or in a part left out."""
    up = node.parent
    if up is None or up.skip:
        return True
    while up is not None:
        if up.tag in ("article", "main", "section"):
            return False
        up = up.parent
    return True


def best_path(html: str | None) -> str | None:
    """The page's vote; None if it has no text to vote for."""
    if not html:
        return None
    best = Page(html).best()
    return best.path if best.path else None


def main_text(html: str | None, paths) -> str:
    """The text on the first of the paths that the page has, else in its own best container."""
    if not html:
        return ""
    page = Page(html)
    for path in paths or ():
        if text := page.text(page.on_path(path)):
            return text
    return page.text([page.best()])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_share: float = MIN_SHARE) -> DataFrame:
    """(host, paths): each host's winning paths, most votes first."""

    def run(batches):
        for batch in slices(batches, "pages", 64):
            hosts, paths = [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path := best_path(html):
                    hosts.append(host)
                    paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])

    votes = (pages.select(_host(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(run, "host string, path string")
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes")))
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    winning = votes.join(totals, "host").where(F.col("votes") >= min_share * F.col("total"))
    return winning.groupBy("host").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path"))), lambda x: x["path"]).alias("paths"))


def _host(url_col: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col), _HOST, 1), F.lit("")))


#: Most bytes of winning paths that are broadcast; beyond, hosts are salted.
BROADCAST_BYTES = 32 << 20
SALTS = 16


def _with_paths(pages: DataFrame, winners: DataFrame, host: str) -> DataFrame:
    """The pages beside their host's winning paths. A hot host's pages stay where they are or go to SALTS tasks."""
    winners = written(winners, "host-paths")
    paths = next(c for c in winners.columns if c != host)
    size = winners.agg(F.sum(F.octet_length(host) + F.octet_length(F.array_join(paths, "")) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(winners), host, "left")
    salt = free_name([*pages.columns, *winners.columns], "_salt")
    pages = pages.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    return pages.join(winners.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [host, salt], "left")


def extract(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    text_col: str = "text",
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The pages with their main text (the column must be a new one)."""
    if text_col.lower() in {c.lower() for c in pages.columns}:
        raise ValueError(f"the input has a column named {text_col}")
    host, paths = free_name(pages.columns, "_host"), free_name(pages.columns, "_paths")
    winners = host_paths(pages, url_col, html_col, min_share).select(F.col("host").alias(host), F.col("paths").alias(paths))
    joined = _with_paths(pages.withColumn(host, _host(url_col)), winners, host).select(*pages.columns, paths)
    schema = StructType([*pages.schema.fields, StructField(text_col, StringType())])
    where = pages.columns.index(html_col)

    def run(batches):
        for batch in slices(batches, "pages", 64):
            texts = [main_text(h, p) for h, p in zip(batch.column(where).to_pylist(), batch.column(len(pages_columns)).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    pages_columns = pages.columns
    return joined.mapInArrow(run, schema)
