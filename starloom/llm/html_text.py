"""Main text of web pages by consensus of each host's pages.

First every page scores its containers by the running text in them.  The containers'
generalised paths (tags and classes from the root, numbers in class names levelled) get
votes, summed per host in Spark.  Then every page is extracted again from the host's
winning path that covers its own best container; without one that container is taken.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.sources.scratch import Workspace

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rt "
    "rp s samp small span strike strong sub sup time tt u var wbr label br nobr".split()
)
CONTAINERS = frozenset("article main section div td body blockquote center".split())
NEVER_TEXT = frozenset(
    "script style textarea title xmp noembed noframes iframe noscript template head nav footer "
    "aside form button select option input svg canvas object video audio dialog menu datalist "
    "applet map".split()
)
#: Elements without article text that stand within a line: they end no block.
INLINE_NEVER = frozenset(
    "script style template noscript button select svg canvas object video audio map datalist "
    "textarea iframe noembed".split()
)
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("table ul ol dl article main section body html td th div blockquote".split())

#: Words that mark what is not the article.  A class name, id or role has to
#: consist of them, but for words of place and form, or to end in one that says it alone.
SIDE_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo "
    "promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment "
    "comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations widget widgets toolbar pagination pager complementary "
    "contentinfo search banner hidden".split()
)
HEAD_WORDS = frozenset(["header", "banner"])
PLAIN_WORDS = frozenset(
    "area aside bar block bottom box button buttons container desktop fixed form global google gpt "
    "group icon icons "
    "inline inner item items js left link links list mobile outer panel posts primary right row "
    "secondary section site slot sticky title top unit wrap wrapper zone".split()
)
LAST_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adsense adslot sidebar navbar navigation breadcrumb "
    "breadcrumbs comments commentlist disqus newsletter pagination pager".split()
)
#: Words that make a name one of the page's layout, and what readers may write at length.
LAYOUT_WORDS = frozenset("has have with without no not is hide overflow backface".split())
HIDDEN_NAMES = frozenset(["hidden", "visually-hidden", "visuallyhidden", "is-hidden"])
READER_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
BODY_WORDS = frozenset("article content entry post story text main body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")

#: Share of the running text from which on an element is the article, whatever its name.
MOST = 2 / 3
PATH_STEPS = 8
LEVEL_SHARE = 0.95
VOTES_PER_PAGE = 3
WINNERS = 3
#: Share of the running text of a page's own best container that a winning path has to cover.
FIT = 0.9
#: Text right inside a container is running text from so many characters on.
RUNNING = 40
HEADINGS = {f"h{k}": k for k in range(1, 7)}
NO_HEADING = 7


@lru_cache(maxsize=1 << 14)
def side_name(name: str, inside: bool) -> tuple[bool, bool]:
    """Whether a class name, id or role marks what is not the article, and whether that is
    something readers write.  ``inside``: of an article, whose own header belongs to it."""
    if name.lower() in HIDDEN_NAMES:
        return True, False
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    if not words or words[-1] == "hidden" or LAYOUT_WORDS.intersection(words):
        return False, False
    marks = SIDE_WORDS if inside else SIDE_WORDS | HEAD_WORDS
    found = marks.intersection(words)
    side = bool(found) and (words[-1] in LAST_WORDS or found | PLAIN_WORDS >= set(words))
    return side, side and bool(found & READER_WORDS)


class Page:
    """A page as a list of elements, each with its parent, and text blocks in order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.side = [-1], ["#root"], [()], [False]
        self.soft_side: list[bool] = [False]
        self.by_readers: list[bool] = [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._buffer: list[str] = []
        self._linked = 0
        #: Open side elements within a line, each with the text of the block around it.
        self._aside: list[tuple[int, list[str], int]] = []
        self._parse(source)
        self._settle()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        classes = html.unescape(given.get("class", ""))
        named = f"{classes} {html.unescape(given.get('id', ''))} {given.get('role', '')}"
        inside = any(self._inside)
        marks = [side_name(name, inside) for name in named.split()]
        hard = (
            tag in NEVER_TEXT
            or (tag == "header" and not inside)
            or "hidden" in given
            or given.get("aria-hidden") == "true"
            or "display:none" in given.get("style", "").replace(" ", "").lower()
        )
        step = tag + "".join(
            f".{c}" for c in sorted(set(_DIGITS.sub("#", classes.lower()).split()))
        )
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append((*self.path[parent], step)[-PATH_STEPS:] if tag not in ("html", "body") else ())
        self.side.append(hard)
        named_side = tag not in ("html", "body", "main", "article")
        self.soft_side.append(named_side and any(side for side, _ in marks))
        self.by_readers.append(named_side and any(readers for _, readers in marks))
        return len(self.tag) - 1

    def _flush(self, node: int) -> None:
        text = _SPACE.sub(" ", html.unescape("".join(self._buffer))).strip()
        if text:
            self.blocks.append((node, text, min(self._linked, len(text))))
        self._buffer, self._linked = [], 0

    def _parse(self, source: str) -> None:
        stack, self._inside = [0], [False]
        at, holder = 0, 0
        links = 0

        def text(piece: str) -> None:
            if piece:
                self._buffer.append(piece)
                if links:
                    self._linked += len(piece)

        def pop_to(depth: int) -> None:
            nonlocal links
            while len(stack) > depth:
                self._inside.pop()
                node = stack.pop()
                links -= self.tag[node] == "a"
                if self._aside and self._aside[-1][0] == node:
                    # The block around goes on where the side element began.
                    self._flush(node)
                    _, self._buffer, self._linked = self._aside.pop()
                elif self._buffer and self.tag[node] not in INLINE:
                    self._flush(node)

        while (m := _TOKEN.search(source, at)) is not None:
            text(source[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            tag = name.lower()
            if m[1] or m[4]:
                if tag not in INLINE and tag not in INLINE_NEVER:
                    self._flush(holder)
                depth = len(stack) - 1
                while depth > 0 and self.tag[stack[depth]] != tag:
                    # An inline end tag does not close a block around it.
                    if tag in INLINE and self.tag[stack[depth]] not in INLINE:
                        depth = 0
                        break
                    depth -= 1
                if depth > 0:
                    pop_to(depth)
                holder = self._holder(stack)
                continue
            attributes = m[3] if m[2] else m[6]
            if tag in VOID:
                if tag in ("br", "wbr"):
                    text(" " if tag == "br" else "")
                elif tag == "hr":
                    self._flush(holder)
                continue
            if tag not in INLINE and tag not in INLINE_NEVER:
                self._flush(holder)
                closes = CLOSED_BY.get(tag, ()) or {"p"}
                for depth in range(len(stack) - 1, 0, -1):
                    if self._aside and stack[depth] == self._aside[-1][0]:
                        # What stands in a side element closes nothing around it.
                        break
                    if self.tag[stack[depth]] in closes:
                        pop_to(depth)
                        if tag not in CLOSED_BY or tag in ("li", "dt", "dd"):
                            break
                    elif self.tag[stack[depth]] in SCOPES and self.tag[stack[depth]] not in closes:
                        break
            node = self._open(stack[-1], tag, attributes)
            opens = not attributes.endswith("/") or tag not in ("svg", "path", "use", "g")
            if opens and (self.side[node] or self.soft_side[node]):
                if tag in INLINE or tag in INLINE_NEVER:
                    self._aside.append((node, self._buffer, self._linked))
                    self._buffer, self._linked = [], 0
                else:
                    self._flush(holder)
            if opens:
                stack.append(node)
                links += tag == "a"
                self._inside.append(self._inside[-1] or tag in ("article", "main"))
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = len(source) if end is None else end.end()
                pop_to(len(stack) - 1)
            holder = self._holder(stack)
        text(source[at:])
        self._flush(holder)
        pop_to(1)
        self._flush(0)

    def _holder(self, stack: list[int]) -> int:
        """The element that text found now belongs to: the innermost that is no mere style."""
        top = stack[-1]
        return top if top == 0 or not self._transparent(top) else self._climb(top)

    def _transparent(self, node: int) -> bool:
        return self.tag[node] in INLINE and not self.side[node] and not self.soft_side[node]

    def _climb(self, node: int) -> int:
        while node > 0 and self._transparent(node):
            node = self.parent[node]
        return node

    def _is_body(self, node: int) -> bool:
        """Whether an element is named as the article, or as what holds it."""
        if self.tag[node] in ("article", "main") or self.tag[node] not in CONTAINERS:
            return self.tag[node] in ("article", "main")
        steps = self.path[node][-1:]
        names = [set(_NAME_WORD.findall(c)) for step in steps for c in step.split(".")[1:]]
        return any(n & BODY_WORDS and n <= BODY_WORDS | PLAIN_WORDS for n in names)

    def _settle(self) -> None:
        """What a side name covers is left out, unless an article lies within, or most of
        the page's running text and no article besides, or nothing would be left."""
        holds = [t in ("article", "main") for t in self.tag]
        for node in range(len(self.tag) - 1, 0, -1):
            if holds[node] and not self.side[node]:
                holds[self.parent[node]] = True
        hard, readers = self.side, self.by_readers
        for node in range(1, len(self.tag)):
            hard[node] = hard[node] or hard[self.parent[node]]
            readers[node] = not holds[node] and (readers[node] or readers[self.parent[node]])
        given = [b for b in self.blocks if not hard[b[0]]]
        if any(self.soft_side):
            running, bodies = [0.0] * len(self.tag), [0.0] * len(self.tag)
            body = [0] * len(self.tag)
            for node in range(1, len(self.tag)):
                body[node] = body[self.parent[node]] or (node if self._is_body(node) else 0)
            for node, text, linked in given:
                if not readers[node]:
                    share = max(0.0, len(text) - 2.0 * linked)
                    running[node] += share
                    bodies[node] += share if body[node] else 0.0
            for node in range(len(self.tag) - 1, 0, -1):
                running[self.parent[node]] += running[node]
                bodies[self.parent[node]] += bodies[node]
            self.side = hard[:]
            for node in range(1, len(self.tag)):
                most = 0 < running[node] >= MOST * running[0] and bodies[body[node] or node] >= bodies[0]
                own = hard[node] or (self.soft_side[node] and not holds[node] and not most)
                self.side[node] = own or self.side[self.parent[node]]
        self.blocks = [b for b in given if not self.side[b[0]]]
        if not self.blocks:
            self.blocks, self.side = given, hard
        score = [0.0] * len(self.tag)
        for node, text, linked in self.blocks:
            score[node] += max(0.0, len(text) - 2.0 * linked)
        for node in range(len(self.tag) - 1, 0, -1):
            share = LEVEL_SHARE if self.tag[node] in CONTAINERS else 1.0
            score[self.parent[node]] += share * score[node]
        for node, tag in enumerate(self.tag):
            if tag in ("article", "main"):
                score[node] *= 1.25
            elif self.path[node] and BODY_WORDS & set(_NAME_WORD.findall(self.path[node][-1])[1:]):
                score[node] *= 1.1
        self.score = score
        self._weigh()

    def _weigh(self) -> None:
        """Running text and highest heading of each element with all below it, the headings
        in order, and the running text right inside a container, with none between."""
        size = len(self.tag)
        self.running, self.heading, self.beside = [0.0] * size, [NO_HEADING] * size, [0.0] * size
        self.near, self.rank, self.last = list(range(size)), [NO_HEADING] * size, list(range(size))
        self.titles: list[int] = []
        for node in range(1, size):
            up = self.parent[node]
            if self.tag[node] not in CONTAINERS:
                self.near[node] = self.near[up]
            self.rank[node] = HEADINGS.get(self.tag[node], self.rank[up])
        for node, text, linked in self.blocks:
            share = max(0.0, len(text) - 2.0 * linked)
            self.running[node] += share
            self.heading[node] = self.rank[node]
            if share >= RUNNING:
                self.beside[self.near[node]] += share
            if self.rank[node] < NO_HEADING:
                self.titles.append(node)
        for node in range(size - 1, 0, -1):
            up = self.parent[node]
            self.running[up] += self.running[node]
            self.heading[up] = min(self.heading[up], self.heading[node])
            self.last[up] = max(self.last[up], self.last[node])

    def outer(self, node: int) -> int:
        """The container around ``node`` that has what belongs to it: a title before it and
        running text right beside it; within an article's body, all running text."""
        up = node
        while up > 0:
            up = self.parent[up]
            if up > 0 and self.tag[up] not in CONTAINERS:
                continue
            # An article with a heading ends what belongs together, but for its title.
            whole = self.tag[node] in ("article", "main") and self.heading[node] < NO_HEADING
            body = not whole and self._is_body(up)
            title = any(
                up < h < node
                and self.rank[h] < self.heading[node]
                and (body or self.near[h] == up or self.heading[node] == NO_HEADING)
                for h in self.titles
            )
            more = self.running[up] > self.running[node] if body else self.beside[up] > 0
            if title or (more and not whole):
                node = up
        return node

    def candidates(self) -> list[tuple[float, int]]:
        """Containers with text, best first; of equal ones the outer."""
        found = [
            (self.score[n], n)
            for n, tag in enumerate(self.tag)
            if (tag in CONTAINERS or n == 0) and self.score[n] > 0 and not self.side[n]
        ]
        return sorted(found, key=lambda c: (-c[0], c[1]))

    def votes(self) -> list[tuple[str, float]]:
        best: dict[str, float] = {}
        seen: set[tuple[str, ...]] = set()
        for score, node in self.candidates():
            if self.path[node] in seen:
                continue
            seen.add(self.path[node])
            path = ">".join(self.path[self.outer(node)])
            best[path] = max(best.get(path, 0.0), score)
            if len(best) == VOTES_PER_PAGE:
                break
        top = max(best.values(), default=1.0)
        return [(path, score / top) for path, score in best.items()]

    def text(self, winners: list[str]) -> str:
        """The blocks of the containers on the first winning path that fits this page."""
        found = self.candidates()
        if not found:
            return "\n".join(text for _, text, _ in self.blocks)
        best = self.outer(found[0][1])
        own = self._inside_of({best})
        chosen = own
        for path in winners:
            on_path, end = set(), -1
            for n in sorted(n for _, n in found if ">".join(self.path[n]) == path):
                if n > end:
                    on_path.add(outer := self.outer(n))
                    end = self.last[outer]
            if on_path and self._covers(within := self._inside_of(on_path), own, best):
                chosen = within
                break
        return "\n".join(text for node, text, _ in self.blocks if chosen[node])

    def _inside_of(self, nodes: set[int]) -> list[bool]:
        within = [n in nodes for n in range(len(self.tag))]
        for node in range(1, len(self.tag)):
            within[node] = within[node] or within[self.parent[node]]
        return within

    def _covers(self, within: list[bool], own: list[bool], best: int) -> bool:
        """Whether nearly all running text of the own best container is covered, and its
        highest headings are."""
        covered, lost = 0.0, NO_HEADING
        for node, text, linked in self.blocks:
            if own[node] and within[node]:
                covered += max(0.0, len(text) - 2.0 * linked)
            elif own[node]:
                lost = min(lost, self.rank[node])
        return covered >= FIT * self.running[best] and (lost == NO_HEADING or lost > self.heading[best])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\w[\w+.-]*://([^/:?#]*)", 1))


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes) of pages (host, html), summed per host and path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, shares = [], [], []
            for host, source in zip(batch.column(0), batch.column(1)):
                for path, share in Page(source.as_py() or "").votes():
                    hosts.append(host.as_py())
                    paths.append(path)
                    shares.append(round(share * 1000))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())],
                ["host", "path", "votes"],
            )

    each = pages.select("host", "html").mapInArrow(run, "host string, path string, votes bigint")
    return each.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def winning_paths(votes: DataFrame, winners: int = WINNERS) -> DataFrame:
    """(host, paths): each host's paths with most votes, best first."""
    order = W.partitionBy("host").orderBy(F.desc("votes"), "path")
    best = votes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= winners)
    return best.groupBy(F.col("host").alias("voted_host")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "path"))), lambda p: p["path"]
        ).alias("paths")
    )


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """One row per page: key, url, text and n_chars.

    A null or empty page has an empty text.  Pages without a host form a host of their
    own.  Repeated rows and null keys are kept; other columns are not read.
    """
    work = Workspace(pages.sparkSession, "html")
    given = pages.select(
        F.col(f"`{key}`").alias("page"), F.col(f"`{url}`").alias("url"),
        host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{source}`").alias("html"),
    )
    winners = work.stage(winning_paths(page_votes(given)), "winners")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(page.as_py() or "").text(paths.as_py() or [])
                for page, paths in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                [key, url, "text", "n_chars"],
            )

    # Hosts are joined by shuffle where their paths are too many to broadcast; both sides
    # come from scans, so adaptive execution splits a host with most of the pages.
    joined = given.join(winners, F.col("host") == F.col("voted_host"), "left")
    kind = pages.schema[key].dataType.simpleString()
    return joined.select("page", "url", "html", "paths").mapInArrow(
        run, f"`{key}` {kind}, `{url}` string, text string, n_chars bigint"
    )
