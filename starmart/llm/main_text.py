"""Main text of web pages by composite text density.

A tolerant reader turns a page into a tree of its block elements; formatting elements (b, span, a, ...) belong to
the block around them, text between blocks is a block of its own. What an element's kind, role or
class and id words mark as menu, header, footer, sidebar, notice, advert, form, script, style or
reader comment takes no part. For each node, C characters (white space apart), L of them in links,
T elements and M link elements in its subtree give its link-adjusted density

    C / T * log((C T) / (L M)) to the base ln(C L / (C - L) + C L_body / C_body + e)

(zeros count as one; the base is e at least, or pages with few links would count blocks, not characters).
The node whose children's densities have the largest sum is the main one. The smallest density on its way up to
the body is the threshold: going down from the body, every node that reaches it gives its subtree's
largest-sum node to the text, and its children are looked at in turn. If the main node lies in an article element,
that element's bounds replace the threshold's: it is taken whole. Otherwise the page's last h1 before the main node is taken along, if
it stands beside the node or one around it. Blocks are written in page order.

A header inside an article or main element holds its title and stays. Class words never hide an element that holds an article or main element. A page
whose boilerplate leaves no text has an empty text. Null html: empty. Very long pages and deep trees take
linear time and no recursion. Repeated rows get the same result each. Further columns are kept by ``extract``;
columns named ``text`` or ``n_chars`` are replaced by its results.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import mapped

# fixed values: element kinds of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style textarea title iframe noembed noframes noscript template svg math canvas object audio video head select option button form nav footer aside menu dialog datalist map applet".split())
ARTICLE = frozenset("body article main".split())
UNSEEN_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert status".split())
# words of class and id that mark boilerplate
UNSEEN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored promo promotion promoted outbrain taboola "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sitemap skip toolbar "
    "header masthead topbar footer foot copyright colophon sidebar sidebars sidenav aside rail widget widgets "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall disclaimer "
    "comment comments commentlist respond replies reply disqus discussion "
    "share sharing social related recommended recommendations teaser teasers search form hidden".split()
)
ARTICLE_UNSEEN = frozenset("ad comment comments reply related teaser teasers promo sponsored".split())  # of article elements themselves
LAYOUT_WORDS = frozenset("has with without no layout".split())  # as in with-sidebar: the rest names the page's layout
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# an element closes open ones of its family, up to an element that shields them
FAMILIES = (
    (frozenset(["p"]), frozenset("table td th caption button object applet marquee template".split())),
    (frozenset(["li"]), frozenset("ul ol menu dir table td th template".split())),
    (frozenset(["dd", "dt"]), frozenset("dl table td th template".split())),
    (frozenset(["td", "th"]), frozenset("table template".split())),
    (frozenset(["tr"]), frozenset("table template".split())),
    (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset("table template".split())),
    (frozenset(["option", "optgroup"]), frozenset("select datalist template".split())),
)
CLOSES = {tag: k for k, (tags, _) in enumerate(FAMILIES) for tag in tags}
SPECIAL = frozenset().union(*(tags | shields for tags, shields in FAMILIES))
TOKEN = re.compile(
    r"<!--(?:(?=-?>)|.*?--!?>|.*\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^A-Za-z>][^>]*(?:>|\Z)|</>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=|[\"'])*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
PHRASING = frozenset("script style noscript template button select option textarea iframe object audio video svg math canvas map datalist applet".split())  # unseen, but inside a block
SILENT = frozenset("script style noscript template".split())  # no break in a text


def hidden(tag: str, attributes: str, in_article: bool) -> int:
    """2: an element's kind or role marks it as no part of an article; 1: its class and id words do; 0: neither."""
    if tag in UNSEEN or (tag == "header" and not in_article):
        return 2
    if not attributes or tag in ("html", "body"):
        return 0
    mark = 0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if (name == "role" and value.strip().lower() in UNSEEN_ROLES) or (name == "aria-hidden" and value.strip().lower() == "true"):
            return 2
        if name in ("class", "id") and value:
            words = {w.lower() for w in WORD.findall(html.unescape(value))}
            found = words & (UNSEEN_WORDS if tag not in ARTICLE else ARTICLE_UNSEEN)
            if in_article:
                found -= {"header", "foot"}
            if found and not words & LAYOUT_WORDS:
                mark = 1
    return mark


class Tree:
    """Blocks of a page in page order: node k has parent[k], tag[k] and, a text block, text[k]."""

    def __init__(self, page: str):
        self.parent: list[int] = [-1]
        self.text: list[str | None] = [None]
        self.chars: list[int] = [0]
        self.link_chars: list[int] = [0]
        self.tags: list[int] = [0]
        self.link_tags: list[int] = [0]
        self.tag: list[str] = [""]
        self.dropped: list[bool] = [False]
        self.around: set[int] = set()
        self._read(page)

    def _node(self, parent: int, tag: str = "", dropped: bool = False) -> int:
        self.parent.append(parent)
        self.text.append(None)
        self.tag.append(tag)
        self.dropped.append(dropped)
        for counts in (self.chars, self.link_chars, self.tags, self.link_tags):
            counts.append(0)
        return len(self.parent) - 1

    def _read(self, page: str) -> None:
        # an open element: tag, its node, is it unseen, links around it, is it in an article, nearest open element of each family
        stack = [("", 0, False, 0, False, (-1,) * len(FAMILIES))]
        opened: dict[str, int] = {}
        piece: list[tuple[str, bool]] = []
        place = 0

        def flush() -> None:
            if piece:
                words = "".join([t for t, _ in piece]).split()
                if words:
                    k = self._node(place)
                    self.text[k] = " ".join(words)
                    self.chars[k] = len(self.text[k]) - len(words) + 1
                    self.link_chars[k] = sum([len("".join(t.split())) for t, linked in piece if linked])
                piece.clear()

        def close(size: int) -> None:
            nonlocal place
            while len(stack) > size:
                tag = stack.pop()[0]
                opened[tag] -= 1
            if stack[-1][1] != place:
                flush()
                place = stack[-1][1]

        def words(raw: str) -> None:
            top = stack[-1]
            if raw and not top[2]:
                piece.append((html.unescape(raw), top[3] > 0))

        at, end = 0, len(page)
        search = TOKEN.search
        while at < end:
            found = search(page, at)
            if found is None:
                words(page[at:])
                break
            words(page[at : found.start()])
            at = max(found.end(), found.start() + 1)
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:
                if tag == "p" and not opened.get("p"):
                    flush()
                if opened.get(tag) and tag not in ("html", "body"):
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    close(k)
                continue
            if tag == "br":
                words(" ")
                continue
            family = CLOSES.get(tag)
            block = tag not in INLINE and tag not in PHRASING
            if block and stack[-1][5][0] >= 0:
                close(stack[-1][5][0])
            if family and stack[-1][5][family] >= 0:
                close(stack[-1][5][family])
            _, node, unseen, links, in_article, near = stack[-1]
            if not unseen:
                mark = hidden(tag, found[3], in_article)
                unseen = mark == 2 or (mark == 1 and not block)
                if block:
                    flush()
                    if not unseen:
                        node = place = self._node(node, tag, mark == 1)
                        if tag in ("article", "main") and not mark:
                            self._keep_around(node)
                elif tag not in INLINE and tag not in SILENT or tag == "img":
                    piece.append((" ", False))
                if not unseen:
                    self.tags[node] += not block
                    self.link_tags[node] += tag == "a"
            if tag in VOID:
                if block and place != stack[-1][1]:
                    flush()
                    place = stack[-1][1]
                continue
            if tag in RAW:
                shut = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                if shut is None:
                    break
                at = shut.end()
                continue
            if tag in SPECIAL:
                near = tuple(len(stack) if tag in tags else -1 if tag in shields else k for k, (tags, shields) in zip(near, FAMILIES))
            stack.append((tag, node, unseen, links + (tag == "a"), in_article or tag in ("article", "main"), near))
            opened[tag] = opened.get(tag, 0) + 1
        flush()

    def _keep_around(self, k: int) -> None:
        """An element around an article is no boilerplate, whatever its class."""
        while k > 0 and k not in self.around:
            self.around.add(k)
            self.dropped[k] = False
            k = self.parent[k]

    def measure(self) -> tuple[list[float], list[float]]:
        """Density and density sum of every node."""
        n = len(self.parent)
        for k in range(1, n):  # children come after their parents
            self.dropped[k] = self.dropped[k] or self.dropped[self.parent[k]]
        for k in range(n - 1, 0, -1):
            if not self.dropped[k]:
                p = self.parent[k]
                self.chars[p] += self.chars[k]
                self.link_chars[p] += self.link_chars[k]
                self.tags[p] += self.tags[k] + (self.text[k] is None)
                self.link_tags[p] += self.link_tags[k]
        share = self.link_chars[0] / max(1, self.chars[0])
        density, total = [0.0] * n, [0.0] * n
        for k in range(n - 1, -1, -1):
            c, links, t, m = self.chars[k], self.link_chars[k], max(1, self.tags[k]), max(1, self.link_tags[k])
            if c and not self.dropped[k]:
                base = max(math.e, math.log(c * links / max(1, c - links) + share * c + math.e))
                density[k] = max(0.0, c / t * math.log(c * t / (max(1, links) * m)) / math.log(base))
            if k:
                total[self.parent[k]] += density[k]
        return density, total

    def main(self) -> str:
        """Text of the nodes that the density selects."""
        n = len(self.parent)
        density, total = self.measure()
        if not self.chars[0]:
            return ""
        # the first node with the largest sum below each node, itself included
        best = list(range(n))
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            if total[best[k]] > total[best[p]] or (total[best[k]] == total[best[p]] and best[k] < best[p]):
                best[p] = best[k]
        k = chosen = best[0]
        threshold = density[k]
        while k > 0 and self.tag[k] != "article":
            k = self.parent[k]
            threshold = min(threshold, density[k])
        taken, open_ = [False] * n, [False] * n
        if k > 0:  # the article element around the chosen node is its whole text
            taken[k] = True
        else:
            for k in range(n):
                if k == 0 or open_[self.parent[k]]:
                    open_[k] = density[k] >= threshold
                    if open_[k]:
                        taken[best[k]] = True
            taken[self._title(chosen)] = True
        for k in range(1, n):
            taken[k] = taken[k] or taken[self.parent[k]]
        return " ".join([t for t, yes, no in zip(self.text, taken, self.dropped) if yes and t and not no])

    def _title(self, chosen: int) -> int:
        """The last main heading before a node that has none itself, beside the node or one around it (else the node)."""
        around, k = set(), chosen
        while k >= 0:
            around.add(k)
            k = self.parent[k]
        inside = {chosen}
        for k in range(chosen, len(self.parent)):
            if self.parent[k] in inside:
                inside.add(k)
                if self.tag[k] == "h1":
                    return chosen
        for k in range(chosen - 1, 0, -1):
            if self.tag[k] == "h1" and self.parent[k] in around and not self.dropped[k]:
                return k
        return chosen


def main_text(page: str | None) -> str:
    return Tree(page).main() if page else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages' other columns with text and n_chars (code points of the text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch[html_col].to_pylist()]
            columns = [batch[c] for c in others] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "text", "n_chars"])

    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    schema = pages.select(*others).schema.add("text", "string").add("n_chars", "long")
    return mapped(pages.select(*others, html_col), task, schema)


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages.select("page_id", "url", F.col("html")))
