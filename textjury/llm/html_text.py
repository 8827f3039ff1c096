"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored by the text right beneath them. A page votes for the
generalised path (tags with classes and ids, digits as 0) of its best container, and
votes are counted per host in Spark. Each page is then extracted again at the path that
has most of its host's votes and most of the page's text. A path is known by a 128-bit hash
of all its steps, and every path that has a vote counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.llm.common import lookup, stored

#: Votes are broadcast up to so many (host, path) rows; more are joined with the paths of each page.
BROADCAST_ROWS = 50_000

_NAME = r"[^\s/>]*+"
_ATTRIBUTES = (
    r"""(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+)*+"""
)
TAG = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|</([a-zA-Z]{_NAME})[^>]*+(?:>|\Z)|<([a-zA-Z]{_NAME})({_ATTRIBUTES})=?(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

_set = lambda names: frozenset(names.split())
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title noscript template iframe noembed noframes xmp svg math")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
PARAGRAPHS = HEADINGS | _set("p pre blockquote li dt dd figcaption address")
BLOCKS = PARAGRAPHS | _set(
    "html head body main article section div header footer nav aside form fieldset ul ol dl menu table caption thead"
    " tbody tfoot tr td th figure details summary hr center dialog search option select button hgroup"
)
DROPPED_TAGS = _set(
    "head nav aside footer form button select option input dialog menu search audio video object canvas label map"
)
DROPPED_ROLES = _set("navigation complementary banner contentinfo search dialog alert alertdialog menu menubar form")
_COMMENT = "comments? commentlist disqus replies respond reader-?comments?"
_DROPPED = (
    "ads? adv adverts? advertisements? advertising adsense sponsor sponsors sponsored promos? promotions? banners? sidebars? menus?"
    " nav navs navbar navigation breadcrumbs? footer cookies? consent gdpr notices? popups? modal overlay newsletter"
    " subscribe subscription signup social share sharing sharebar related recommended recommendations login pagination"
    " pager toolbar widgets? copyright masthead topbar alert"
)
_named = lambda words: re.compile(rf"(?:^|[-_])(?:{'|'.join(words.split())})(?:[-_]|$)", re.I)
COMMENT_NAME, DROPPED_NAME, HEADER_NAME = _named(_COMMENT), _named(_DROPPED), _named("header")
OPPOSITE = re.compile(r"^(?:no|has|with|without|non)[-_]", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Opening one of these closes an open element of the listed kinds within the same parent block.
CLOSES = {
    "li": _set("li"), "dt": _set("dt dd"), "dd": _set("dt dd"), "tr": _set("tr td th"), "td": _set("td th"),
    "th": _set("td th"), "option": _set("option"), "tbody": _set("thead tbody tr td th"), "body": _set("head"),
}
BOUNDS = {
    "li": _set("ul ol menu"), "dt": _set("dl"), "dd": _set("dl"), "tr": _set("table"), "td": _set("table tr"),
    "th": _set("table tr"), "option": _set("select"), "tbody": _set("table"), "body": _set("html"),
}

IN_ARTICLE, IN_MAIN = 4, 2
KEEP, HEADER, BY_NAME, DROP = 0, 1, 2, 3
#: A name or form drops nothing that holds so large a part of the page's text outside links.
WRAPS = 0.75


def _step(tag: str, names: list[str], ident: str) -> str:
    step = ".".join([tag, *sorted(set(names))]) + (f"#{ident}" if ident else "")
    return re.sub(r"\d+", "0", step)


class Page:
    """A page as a tree of its block elements and a list of its text blocks.

    Elements are numbered in page order, so an element and what is in it have consecutive numbers.
    blocks: (element, text, characters inside links, whether it is a heading). ``keys`` hold the
    hash of each element's path, made of its parent's key and its own step.
    ``own`` is what an element says of itself, ``firm`` what holds there even if wrappers drop nothing.
    """

    def __init__(self, html: str):
        self.tags, self.keys, self.parents, self.states = ["#root"], [b""], [-1], [KEEP]
        self.worth, self.article = [1], [0]  # how much text counts there; the nearest article around
        self.own, self.firm, self.comments = [KEEP], [KEEP], [False]
        self.blocks: list[tuple[int, str, int, bool]] = []
        self._stack: list[tuple[str, int]] = [("#root", 0)]  # tag, its block element
        self._text: list[str] = []
        self._linked: list[str] = []
        self._links = 0
        self._open_tags: Counter[str] = Counter()
        self._parse(html)
        self._unwrap()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                node = self._stack[-1][1]
                linked = len(" ".join(unescape("".join(self._linked)).split()))
                heading = any(tag in HEADINGS for tag, n in self._stack[-3:] if n == node)
                self.blocks.append((node, text, linked, heading))
            self._text, self._linked = [], []

    def _say(self, text: str) -> None:
        if text:
            self._text.append(text)
            if self._links:
                self._linked.append(text)

    def _pop_to(self, depth: int) -> None:
        if any(tag in BLOCKS for tag, _ in self._stack[depth:]):
            self._flush()
        for tag, _ in self._stack[depth:]:
            self._links -= tag == "a"
            self._open_tags[tag] -= 1
        del self._stack[depth:]

    def _close(self, tag: str) -> None:
        block = tag in BLOCKS
        if not self._open_tags[tag]:
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            open_tag = self._stack[depth][0]
            if open_tag == tag:
                self._pop_to(depth)
                return
            if not block and open_tag in BLOCKS:
                return

    def _close_before(self, tag: str) -> None:
        """End what opening ``tag`` ends: an open paragraph, or a sibling that needs no end tag."""
        kinds, bounds = CLOSES.get(tag, frozenset()), BOUNDS.get(tag, frozenset())
        for depth in range(len(self._stack) - 1, 0, -1):
            if not self._open_tags["p"] and not any(self._open_tags[kind] for kind in kinds):
                return
            open_tag = self._stack[depth][0]
            if open_tag in kinds:
                self._pop_to(depth)
                if not (kinds - {open_tag}):
                    return
            elif open_tag == "p":
                self._pop_to(depth)
            elif open_tag in bounds or (open_tag in BLOCKS and not kinds):
                return

    def _open(self, tag: str, attributes: str) -> None:
        given = {}
        for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
            given.setdefault(name.lower(), a or b or c)
        names, ident = given.get("class", "").split(), given.get("id", "").strip()
        state, firm, comment = KEEP, True, False
        if (
            tag in DROPPED_TAGS
            and tag != "form"
            or "hidden" in given
            or given.get("aria-hidden", "").lower() == "true"
            or given.get("role", "").lower() in DROPPED_ROLES
            or HIDDEN.search(given.get("style", ""))
        ):
            state = DROP
        elif tag == "form":
            state, firm = DROP, False
        else:
            marks = [n for n in [*names, ident] if n and not OPPOSITE.match(n)]
            if any(map(COMMENT_NAME.search, marks)):
                state, firm, comment = BY_NAME, False, True
            elif tag not in ("html", "body", "main", "article") and any(map(DROPPED_NAME.search, marks)):
                state, firm = BY_NAME, False
            elif tag == "header" or tag not in HEADINGS and any(map(HEADER_NAME.search, marks)):
                state, firm = HEADER, tag == "header"
        parent = self._stack[-1][1]
        if tag in BLOCKS or state > self.states[parent] or firm and state > self.firm[parent]:
            if tag not in BLOCKS:
                self._flush_inline()
            self.tags.append(tag)
            self.keys.append(blake2b(self.keys[parent] + _step(tag, names, ident).encode("utf-8", "replace"), digest_size=16).digest())
            self.parents.append(parent)
            self.worth.append(max(self.worth[parent], IN_ARTICLE if tag == "article" else IN_MAIN if tag == "main" else 1))
            self.article.append(len(self.tags) - 1 if tag == "article" else self.article[parent])
            self.states.append(max(state, self.states[parent]))
            self.own.append(state)
            self.firm.append(max(state if firm else KEEP, self.firm[parent]))
            self.comments.append(comment)
            self._stack.append((tag, len(self.tags) - 1))
        else:
            self._stack.append((tag, parent))
        self._open_tags[tag] += 1

    def _flush_inline(self) -> None:
        """An inline element that is dropped parts the text around it into blocks."""
        self._flush()

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            found = TAG.search(html, at)
            if not found:
                self._say(html[at:])
                break
            self._say(html[at : found.start()])
            at = found.end()
            closing, opening, attributes = found.groups()
            if closing:
                tag = closing.lower()
                if tag == "p" and not self._open_tags["p"]:
                    self._flush()
                elif tag == "br":
                    self._say(" ")
                else:
                    inside = self._stack[-1][1]
                    self._close(tag)
                    now = self._stack[-1][1]
                    if (self.states[now] < self.states[inside] or self.firm[now] < self.firm[inside]) and self._text:
                        self._text, self._linked = [], []
            elif opening:
                tag = opening.lower()
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(html, at)
                    if not attributes.endswith("/") or tag not in ("svg", "math"):
                        at = end.end() if end else n
                elif tag in VOID:
                    if tag in ("br", "hr"):
                        self._flush() if tag == "hr" else self._say(" ")
                else:
                    if tag in BLOCKS:
                        self._flush()
                        self._close_before(tag)
                    self._open(tag, attributes)
                    self._links += tag == "a"
            elif found.group().startswith("<![CDATA["):
                self._say(found.group()[9:].removesuffix("]]>"))
        self._flush()

    def _unwrap(self) -> None:
        """Elements dropped by their name, or as a form, that wrap the main text drop nothing.

        Those are the ones around the page's only main or single article, or around most of its
        text outside links where no article or main element stands free. Comments wrap only a main.
        """
        n = len(self.tags)
        soft = [self.own[i] > KEEP and self.firm[i] < self.own[i] for i in range(n)]
        if not any(soft):
            return
        text, mains, articles = [0] * n, [0] * n, [0] * n
        for node, block, linked, _ in self.blocks:
            if self.firm[node] < DROP:
                text[node] += len(block) - linked
        within = [False] * n  # an article or main is around
        free = False
        for i in range(1, n):
            within[i] = within[self.parents[i]] or self.tags[self.parents[i]] in ("article", "main")
            if self.tags[i] in ("article", "main") and self.firm[i] < DROP:
                mains[i], articles[i] = self.tags[i] == "main", self.tags[i] == "article"
                free = free or self.states[i] == KEEP
        for i in range(n - 1, 0, -1):
            for counts in (text, mains, articles):
                counts[self.parents[i]] += counts[i]
        for i in range(1, n):
            if soft[i] and not within[i] and not free and self.tags[i] not in ("article", "main"):
                wraps = mains[i] or not self.comments[i] and (articles[i] == 1 or text[i] >= WRAPS * text[0] > 0)
                self.own[i] = KEEP if wraps else self.own[i]
            self.states[i] = max(self.own[i], self.states[self.parents[i]])

    def clean(self, most: int) -> list[int]:
        """Numbers of the blocks outside dropped parts; of headers only headings."""
        return [
            i
            for i, (node, _, _, heading) in enumerate(self.blocks)
            if self.states[node] == KEEP or self.states[node] == HEADER and heading or HEADER < self.states[node] < most
        ]

    def kept(self) -> list[int]:
        """Clean blocks; if names alone would drop the whole page, names drop nothing."""
        return self.clean(BY_NAME) or self.clean(DROP)

    def sums(self, kept: list[int]) -> tuple[list[int], list[int], list[int]]:
        """Characters, blocks and headings among ``kept`` in each element and all that is in it."""
        sums = tuple([0] * len(self.tags) for _ in range(3))
        for i in kept:
            node, text, _, heading = self.blocks[i]
            for values, value in zip(sums, (len(text), 1, int(heading))):
                values[node] += value
        for node in range(len(self.tags) - 1, 0, -1):
            for values in sums:
                values[self.parents[node]] += values[node]
        return sums

    def within(self, nodes: set[int], kept: list[int]) -> list[int]:
        """The blocks among ``kept`` that are in one of ``nodes``."""
        inside = [False] * len(self.tags)
        for node in range(1, len(inside)):
            inside[node] = node in nodes or inside[self.parents[node]]
        return [i for i in kept if inside[self.blocks[i][0]]]

    def best(self, kept: list[int]) -> int:
        """The container with the best score; 0 if there is none.

        A block counts, by its characters outside links, for its container and half for
        that one's parent, and more inside elements made for a main text. An article around the best container stands in for it, and so
        does a parent that only adds headings.
        """
        score: dict[int, float] = {}
        container = list(range(len(self.tags)))
        for node in range(1, len(container)):
            if self.tags[node] in PARAGRAPHS:
                container[node] = container[self.parents[node]]
        for i in kept:
            node, text, linked, _ = self.blocks[i]
            node = container[node]
            worth = len(text) - linked
            for share in (1.0, 0.5):
                if node > 0:
                    score[node] = score.get(node, 0.0) + share * worth
                    node = self.parents[node]
        if not score:
            return 0
        best = max(score, key=lambda node: (score[node] * self.worth[node], -node))
        if self.article[best]:
            return self.article[best]
        _, blocks, headings = self.sums(kept)
        while True:
            parent = self.parents[best]
            if parent <= 0 or self.tags[parent] in ("body", "html"):
                return best
            added = blocks[parent] - blocks[best]
            if not added or headings[parent] - headings[best] < added:
                return best
            best = parent


def vote(html: str) -> tuple[bytes, int] | None:
    """The generalised path of a page's best container, as its key, and its characters."""
    page = Page(html)
    kept = page.kept()
    best = page.best(kept)
    return (page.keys[best], page.sums(kept)[0][best]) if best else None


def paths_of(page: Page, kept: list[int]) -> dict[bytes, int]:
    """The characters under each path of a page that has any."""
    found: dict[bytes, int] = {}
    for key, size in zip(page.keys[1:], page.sums(kept)[0][1:]):
        if size:
            found[key] = found.get(key, 0) + size  # equal paths are never inside one another
    return found


def extract(html: str, votes: dict[bytes, int], winner: bytes | None = None) -> str:
    """A page's main text, given its host's paths with their votes, or the ``winner`` among the page's paths.

    The winner has most votes times characters on the page, then the greater key. Without a
    path of the host on the page its own best container is taken, and without any container
    all its clean text.
    """
    page = Page(html)
    kept = page.kept()
    if votes:
        sizes = {key: size for key, size in paths_of(page, kept).items() if key in votes}
        winner = max(sizes, key=lambda key: (votes[key] * sizes[key], key), default=None)
    if winner is not None:
        chosen = page.within({node for node, key in enumerate(page.keys) if key == winner}, kept)
    elif best := page.best(kept):
        chosen = page.within({best}, kept)
    else:
        chosen = kept
    return "\n".join(page.blocks[i][1] for i in chosen)


def host(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.coalesce(found, F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, votes): every path, by its key, that a page of the host votes for."""

    def cast(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [(name, key[0]) for name, value in zip(*(c.to_pylist() for c in batch.columns)) if (key := vote(value))]
            hosts, paths = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.binary())], names=["host", "path"])

    named = pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html"))
    votes = named.where("host <> '' and html is not null").mapInArrow(cast, "host string, path binary")
    return votes.groupBy("host", "path").agg(F.count("*").alias("votes"))


def winners(pages: DataFrame, paths: DataFrame) -> DataFrame:
    """(page, winner): for each distinct (host, html) in ``pages`` the path that ``extract`` would choose.

    For votes of any number: the paths on a page meet their votes by (host, path); frequent
    ones, such as the body of a large host's pages, by broadcast.
    """

    def offer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for page, name, value in zip(*(c.to_pylist() for c in batch.columns)):
                parsed = Page(value)
                out += [(page, name, key, size) for key, size in paths_of(parsed, parsed.kept()).items()]
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["page", "host", "path", "size"])

    whole = pages.where("host <> '' and html is not null").select("page", "host", "html").dropDuplicates(["page"])
    offered = stored(whole.mapInArrow(offer, "page string, host string, path binary, size long"), "page-paths")
    uses = offered.groupBy("host", "path").agg(F.count("*").alias("weight"))
    met = lookup(offered, paths.join(uses, ["host", "path"]), ["host", "path"], "weight", offered.count())
    best = F.max(F.struct((F.col("votes") * F.col("size")).alias("score"), F.col("path").alias("winner"))).alias("best")
    return met.groupBy("page").agg(best).select("page", "best.winner")


def main_text(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    paths: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(page_id, url, text), one row per input row.

    The text is the article's blocks in page order, joined by a line feed, white space
    inside a block turned into one space, character references decoded. Null and empty
    pages, and pages without text, have an empty text. Pages without a host (null or
    odd url) take no part in votes and are extracted by their own best container. Null
    ids are kept, repeated rows vote and come out each by itself, ties between paths go
    to the greater key. An empty table gives no rows. Other columns are ignored. ``paths``
    may give the result of ``host_paths`` on an earlier, larger set of pages. Up to
    ``broadcast_rows`` of its rows are sent to the executors; more are joined with the
    paths of each page, which gives the same texts.
    """
    if paths is None:
        paths = stored(host_paths(pages, url, html), "host-paths")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        host(F.col(url)).alias("host"),
    )

    few = paths.limit(broadcast_rows + 1).collect()  # a bounded number of hashes
    by_host: dict[str, dict[bytes, int]] = {}
    if len(few) <= broadcast_rows:
        for row in few:
            by_host.setdefault(row["host"], {})[bytes(row["path"])] = row["votes"]
        chosen = rows.withColumn("winner", F.lit(None).cast("binary"))
    else:
        rows = rows.withColumn("page", F.md5(F.concat_ws("\u0000", "host", "html").cast("binary")))
        uses = rows.groupBy("page").agg(F.count("*").alias("weight"))
        won = stored(winners(rows, paths), "page-winners").join(uses, "page", "right")
        chosen = lookup(rows, won, ["page"], "weight", rows.count())
    sent = pages.sparkSession.sparkContext.broadcast(by_host)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(value, sent.value.get(name, {}), winner) if value else ""
                for name, value, winner in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "winner")))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return chosen.select("page_id", "url", "host", "html", "winner").mapInArrow(read, "page_id long, url string, text string")
