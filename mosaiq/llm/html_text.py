"""Main text of web pages by composite text density.

The page becomes a tree of elements (lenient: unclosed and stray tags, raw
script and style, optional end tags). Elements that never hold an article's
text (navigation, footers, asides, forms, scripts) are cut; so are those named
after adverts, notices, comments and the like, unless they hold most of the
page's text and so are a frame around it. For every other node the
composite text density relates characters to tags and discounts links; a
node's density sum adds up its children's. The node of the largest sum is the
core; the smallest density on its path to the body is the threshold, and every
subtree that reaches it gives its own largest-sum node. A core inside an
``article`` or ``main`` element stays within the outermost such element.

A narrow pass, page by page; a page is parsed with explicit stacks, in time
that grows with its length.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*+(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|$)", re.S
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_WS = re.compile(r"[\x20\x09-\x0d\xa0]+")

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NOISE = frozenset("nav footer aside form script style noscript iframe template button select option textarea input svg canvas object embed head title menu dialog".split())
#: Roles and name parts of elements that are not the article.
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsbox banner breadcrumb breadcrumbs consent cookie cookies "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion "
    "related share sharing shares sidebar sidebars social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: A class name that begins so says what its element has or lacks, not what it is.
MODIFIERS = frozenset("has have with without no not is show hide js enable enabled disable disabled".split())
#: Which open elements a start tag closes (optional end tags).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",), "td": (), "th": ()}
CELLS = frozenset({"tr", "td", "th"})
STOPS = frozenset("ul ol dl table article section div main body html td th nav aside".split())
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


class Open:
    """The open elements. Counts by name, for all of them and for those since
    the innermost of ``STOPS``, tell at once that an end tag has nothing to
    close, so each element is opened and closed once and nothing is searched."""

    def __init__(self) -> None:
        self.nodes, self.names = [0], ["#document"]
        self.count: dict[str, int] = {}
        #: (place of the scope's first element, counts of the scope)
        self.scopes: list[tuple[int, dict[str, int]]] = [(0, {})]
        #: Places of block elements.
        self.blocks: list[int] = []

    def push(self, node: int, name: str) -> None:
        place = len(self.nodes)
        self.nodes.append(node)
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1
        inner = self.scopes[-1][1]
        inner[name] = inner.get(name, 0) + 1
        if name in STOPS:
            self.scopes.append((place, {}))
        if name in BLOCK:
            self.blocks.append(place)

    def cut(self, place: int) -> None:
        """Closes all from ``place`` on."""
        while len(self.nodes) > place:
            self.nodes.pop()
            name, at = self.names.pop(), len(self.nodes)
            self.count[name] -= 1
            if self.blocks and self.blocks[-1] == at:
                self.blocks.pop()
            if self.scopes[-1][0] == at and at:
                self.scopes.pop()
            self.scopes[-1][1][name] -= 1

    def cut_name(self, name: str) -> None:
        """Closes the innermost open element of a name that is open."""
        place = len(self.names) - 1
        while self.names[place] != name:
            place -= 1
        self.cut(place)

    def end(self, name: str) -> None:
        crossing = name in BLOCK or name in STOPS
        if (self.count if crossing else self.scopes[-1][1]).get(name):
            self.cut_name(name)

    def before(self, name: str) -> None:
        """Closes what the start tag of ``name`` ends."""
        if name in BLOCK and self.blocks and self.names[self.blocks[-1]] == "p":
            self.cut(self.blocks[-1])
        if name in CELLS:
            while self.names[self.scopes[-1][0]] in ("td", "th"):
                self.cut(self.scopes[-1][0])
        for other in CLOSES.get(name, ()):
            if self.scopes[-1][1].get(other):
                self.cut_name(other)


class Page:
    """Nodes by number, parents before children; 0 is the document."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent = ["#document"], [0]
        #: Cut for what it is; perhaps cut for its name (1), for a comments' name (2).
        self.noise, self.named = [False], [0]
        self._framed = [False]  # inside an article or main element
        #: (node, text) in page order, text None for the edge of a block.
        self.flow: list[tuple[int, str | None]] = []
        self.title = ""
        self.links: list[str] = []
        self._parse(source)

    def _parse(self, s: str) -> None:
        flow, open_, at, n = self.flow, Open(), 0, len(s)
        search = _TAG.search
        while at < n:
            m = search(s, at)
            if m is None:
                flow.append((open_.nodes[-1], s[at:]))
                break
            if m.start() > at:
                flow.append((open_.nodes[-1], s[at : m.start()]))
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                open_.end(name)
                if name in BLOCK:
                    flow.append((open_.nodes[-1], None))
                continue
            open_.before(name)
            node = self._add(name, m[3], open_.nodes[-1])
            if name in BLOCK:
                flow.append((node, None))
            elif name == "br":
                flow.append((self.parent[node], " "))
            if name == "a" and (href := re.search(r"href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", m[3], re.I)):
                self.links.append(html.unescape(href[1] or href[2] or href[3] or ""))
            if name in RAW and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(s, at)
                stop = end.start() if end else n
                if name == "title" and not self.title:
                    self.title = _WS.sub(" ", html.unescape(s[at:stop])).strip()
                flow.append((node, s[at:stop] if name == "textarea" else ""))
                at = (s.find(">", stop) + 1 or n) if end else n
            elif name not in VOID and not (m[3].endswith("/") and name not in BLOCK and name != "a"):
                open_.push(node, name)

    def _add(self, name: str, attributes: str, up: int) -> int:
        self.tag.append(name)
        self.parent.append(up)
        # a page's header; an article's own header holds its title
        noise = self.noise[up] or name in NOISE or (name == "header" and not self._framed[up])
        named = 0
        if attributes and not noise and name not in ("body", "html", "article", "main"):
            for m in _NAMES.finditer(attributes):
                value = (m[1] or m[2] or m[3] or "").lower()
                noise = noise or value in NOISE_ROLES
                for one in value.split():
                    words = _SPLIT.split(one)
                    if words[0] not in MODIFIERS:
                        named |= any(w in NOISE_WORDS for w in words) | 2 * any(w in COMMENT_WORDS for w in words)
        self.noise.append(noise)
        self.named.append(int(named))
        self._framed.append(self._framed[up] or name in ("article", "main"))
        return len(self.tag) - 1

    def _cut(self) -> list[bool]:
        """What is not the article: by element and role, and by name unless the
        element is a frame around the article. A frame holds at least half of
        the text that is no comment, and an article, main or top heading
        element if the page has any; one named after comments holds such a heading."""
        n = len(self.tag)
        chars, heading, anchor, talk = [0] * n, [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            talk[i] = talk[self.parent[i]] or self.named[i] & 2 > 0
            if not self.noise[i]:
                heading[i] = self.tag[i] == "h1"
                anchor[i] = heading[i] or self.tag[i] in ("article", "main")
        whole = 0
        for node, text in self.flow:
            if text and not self.noise[node]:
                c = len(text) if not text.isspace() else 0
                chars[node] += c
                whole += 0 if talk[node] else c
        for i in range(n - 1, 0, -1):
            if not self.noise[i]:
                up = self.parent[i]
                chars[up] += chars[i]
                heading[up] |= heading[i]
                anchor[up] |= anchor[i]
        out = list(self.noise)
        for i in range(1, n):
            if out[self.parent[i]]:
                out[i] = True
            elif self.named[i] & 2:
                out[i] = not heading[i]
            elif self.named[i]:
                out[i] = 2 * chars[i] < whole or anchor[0] > anchor[i]
        return out

    def visible(self) -> str:
        """All text but scripts, styles and the head, by blocks."""
        hidden = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            hidden[i] = hidden[self.parent[i]] or self.tag[i] in ("script", "style", "head", "template", "noscript", "iframe")
        return self._text([not h for h in hidden])

    def main(self) -> str:
        return self._text(self._content())

    def _text(self, wanted: list[bool]) -> str:
        blocks, now = [], []
        for node, text in self.flow:
            if text is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif wanted[node]:
                now.append(text)
            elif now and now[-1] != " ":
                now.append(" ")
        if now:
            blocks.append("".join(now))
        clean = (_WS.sub(" ", html.unescape(b)).strip() for b in blocks)
        return "\n".join(b for b in clean if b)

    def _content(self) -> list[bool]:
        n = len(self.tag)
        tag, parent, noise = self.tag, self.parent, self._cut()
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        link = [False] * n
        for i in range(1, n):
            link[i] = tag[i] == "a" or link[parent[i]]
        for node, text in self.flow:
            if text and not noise[node]:
                c = len(text) if not text.isspace() else 0
                chars[node] += c
                if link[node]:
                    link_chars[node] += c
        for i in range(n - 1, 0, -1):
            if noise[i]:
                continue
            up = parent[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i] + (tag[i] == "a")
        body = next((i for i in range(1, n) if tag[i] == "body"), 0)
        ratio = link_chars[body] / max(1, chars[body])
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c = chars[i]
            if noise[i] or not c:
                continue
            t, lc, lt = max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
            base = math.log(c / max(1, c - link_chars[i]) * lc + ratio * c + math.e)
            density[i] = max(0.0, c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(base))
            if i:
                total[parent[i]] += density[i]
        # leaves have no children whose densities could be summed
        own = [total[i] if total[i] else density[i] * 1e-9 for i in range(n)]
        below = list(range(n))  # the largest-sum node of each subtree
        for i in range(n - 1, 0, -1):
            if not noise[i] and own[below[i]] >= own[below[parent[i]]] and below[parent[i]] != 0 or not noise[i] and own[below[i]] > own[below[parent[i]]]:
                below[parent[i]] = below[i]
        core = below[body]
        frame, x, limit = body, core, density[core]
        while x != body and x:
            if density[x]:
                limit = min(limit, density[x])
            if tag[x] in ("article", "main"):
                frame = x
            x = parent[x]
        if density[body]:
            limit = min(limit, density[body])
        wanted = [False] * n
        inside = [i == frame for i in range(n)]
        if tag[frame] in ("article", "main"):
            wanted[frame] = True  # its own element bounds the article
        wanted[core] = True
        for i in range(frame + 1, n):
            if noise[i]:
                continue
            inside[i] = inside[i] or inside[parent[i]]
            if wanted[parent[i]]:
                wanted[i] = True
            elif inside[i] and density[i] >= limit:
                wanted[below[i]] = True
        if not any(wanted[node] for node, text in self.flow if text and not text.isspace() and not noise[node]):
            wanted = [not x for x in noise]
        return wanted


def main_text(source: str | None) -> str:
    """The article's text of a page; empty for null, empty and textless pages."""
    return Page(source).main() if source else ""


def extract_main_text(pages: DataFrame, *, source: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with ``to``, the main text of ``source`` (never null), and
    ``n_chars``, its code points; columns of these names are replaced, all
    others stay.

    Null and empty pages give an empty text, and so do pages without any; very
    long pages are read whole, in time that grows with their length, however
    their tags are left open. Rows are kept one to one, repeated ones too; an
    empty table gives an empty one."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None)

    return pages.withColumn(to, run(F.col(source))).withColumn("n_chars", F.char_length(to).cast("long"))
