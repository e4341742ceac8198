"""Main text of web pages by composite text density (operator 2).

For every node of the page's tree:

    CTD = C/T * log_b(C/LC * T/LT),  b = ln(C/NLC * LC + LCb/Cb * C + e)

with C characters, T tags, LC characters in links, NLC characters outside
links and LT links below the node, LCb and Cb those of the body (a zero
divisor counts as 1).  The subtree whose children's densities have the
largest sum is the article, or the part with the most text of one in several
containers.  The path from there is walked up to the body: a neighbour on it
belongs to the article if its density, or the sum of its children's, reaches
the least density on the path.  The path begins at the thinnest full line of
the article itself, as a part on its own is smaller than what encloses it
and so has less density at the same kind of text.  Headings before a part
that belongs to the article go with it unless they are links.
On a page whose best part lies in an article element, all article elements
whose density reaches the least one on the path are the article, as long as
most of their text is in no link.
Parts that say what they are (navigation, adverts, forms, comments, by tag,
role, class or id) are cut before densities are formed.  A class or id says
so as a whole, or as a compound of such names and words of place and shape
(``site-footer``, ``relatedStories``, not ``has-sidebar``).  A name of
readers' comments cuts always, an article element as well; a compound that
only has such a word in it (``comments-open``), or any other name, doesn't
cut what holds the longest article or main element or, on a page without
one, more than half of the text.  Each page is small
and independent: one pass, no shuffle.

Defined results: a null or empty page, and one without text, gives an empty
text; broken markup is read as browsers do (implied and missing end tags,
stray ``<``); rows are judged one by one, so repeated rows and null ids come
out as they went in; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_arrow

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# Elements and names of parts that are no article text.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
CUT = frozenset("nav aside footer form button select option menu dialog svg canvas object video "
                "audio map head label input fieldset".split())
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended "
    "trending widget outbrain taboola bio comment comments commentlist replies reply disqus respond pagination pager "
    "toolbar skip complementary contentinfo search hidden".split())
COMMENTS = frozenset("comment comments commentlist replies reply disqus respond".split())
#: Words of comments that may also name an article's own part.
TALK = frozenset("discussion discussions".split())
#: What may stand beside a name of CUT_NAMES in a compound.
BESIDE = frozenset(
    "site page main global top bottom left right primary secondary inner outer box bar block area section wrapper "
    "wrap container slot unit item items list links link icons buttons button form post posts articles content "
    "text title header row col column by google law info stories story author user users reader readers thread "
    "threads feed tree body view count".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption".split())
#: Elements that a new one of the key closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}}
#: Elements that end the search for one to close.
FENCE = {"ul", "ol", "dl", "table", "body", "article", "div", "section", "main", "td", "th"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters of a full line.
LINE = 80
SMALL = frozenset("p li h1 h2 h3 h4 h5 h6 b i em strong span a pre blockquote dd dt td".split())


#: How a part is cut: always, by a name, by a name of readers' comments.
ALWAYS, NAMED, COMMENTED = 1, 2, 3


SIZE = re.compile(r"\d+(?:x\d+)?")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _named(token: str, in_article: bool) -> int:
    """How a part is cut that has this class, id or role."""
    names = [x for x in re.split(r"[^a-z0-9]+", HUMP.sub("-", token).lower()) if x and not SIZE.fullmatch(x)]
    cuts = CUT_NAMES if in_article else CUT_NAMES | {"header"}
    if cuts.isdisjoint(names) or not all(x in cuts or x in BESIDE for x in names):
        return 0 if (COMMENTS | TALK).isdisjoint(names) else NAMED
    return NAMED if COMMENTS.isdisjoint(names) else COMMENTED


def _boilerplate(tag: str, rest: str, in_article: bool) -> int:
    if tag in CUT or (tag == "header" and not in_article):
        return ALWAYS
    if not rest.strip() or tag in ("html", "body", "main"):
        return 0
    found = 0
    for name, value in NAMES.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return ALWAYS if tag != "article" else 0
        if name == "style":
            if "display:none" in value.lower().replace(" ", "") and tag != "article":
                return ALWAYS
        elif name in ("class", "id", "role"):
            found = max([found, *(_named(x, in_article) for x in value.split())])
    # an article is cut only as a reader's comment
    return found if tag != "article" or found == COMMENTED else 0


class Page:
    """The tree of a page: nodes in document order, pieces of text."""

    def __init__(self, source: str):
        self.tag, self.parent = ["#root"], [-1]
        self.pieces: list[tuple[int, str | None]] = []  # None: a block ends or begins
        self.cut = [0]
        stack = [0]
        self.open: dict[str, int] = {}
        at, n = 0, len(source)
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                self.pieces.append((stack[-1], source[at:]))
                break
            if lt > at:
                self.pieces.append((stack[-1], source[at:lt]))
            m = TOKEN.match(source, lt)
            if not m:
                self.pieces.append((stack[-1], "<"))
                at = lt + 1
                continue
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if m["end"]:
                k = self._find(stack, tag) if self.open.get(tag) else 0
                if k:
                    self._leave(stack, k)
                if tag in BLOCK:
                    self.pieces.append((stack[-1], None))
                continue
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if tag in BLOCK:
                self._close_p(stack)
                self.pieces.append((stack[-1], None))
            if tag in CLOSES:
                self._close(stack, CLOSES[tag])
            if tag == "br":
                self.pieces.append((stack[-1], " "))
            if tag in VOID:
                continue
            self.cut.append(_boilerplate(tag, m["rest"], self.open.get("article", 0) > 0))
            self.tag.append(tag)
            self.parent.append(stack[-1])
            stack.append(len(self.tag) - 1)
            self.open[tag] = self.open.get(tag, 0) + 1
        self._drop()

    def _drop(self) -> None:
        """Takes out the text of parts that are cut."""
        n = len(self.tag)
        out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or self.cut[i] in (ALWAYS, COMMENTED)
        if NAMED in self.cut:
            chars = [0] * n
            for i, text in self.pieces:
                if text and not out[i]:
                    chars[i] += len(text) - text.count(" ")
            for i in range(n - 1, 0, -1):
                chars[self.parent[i]] += chars[i]
            holds = set()
            whole = [i for i in range(n) if self.tag[i] in ("article", "main") and chars[i]]
            at = max(whole, key=lambda i: (chars[i], -i), default=0)
            while at > 0:
                holds.add(at)
                at = self.parent[at]
            for i in range(1, n):
                kept = i in holds if holds else 2 * chars[i] > chars[0]
                out[i] = out[i] or out[self.parent[i]] or (self.cut[i] == NAMED and not kept)
        self.pieces = [(i, text) for i, text in self.pieces if text is None or not out[i]]

    def _leave(self, stack: list[int], k: int) -> None:
        """Closes all elements from place k of the stack."""
        for x in stack[k:]:
            self.open[self.tag[x]] -= 1
        del stack[k:]

    def _find(self, stack: list[int], tag: str) -> int:
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t == tag:
                return k
            if tag not in BLOCK and t in BLOCK:
                return 0
        return 0

    def _close_p(self, stack: list[int]) -> None:
        if not self.open.get("p"):
            return
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t == "p":
                return self._leave(stack, k)
            if t in BLOCK:
                return None

    def _close(self, stack: list[int], tags: set[str]) -> None:
        while any(self.open.get(t) for t in tags):
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t in tags:
                    self._leave(stack, k)
                    break
                if t in FENCE:
                    return
            else:
                return

    def densities(self) -> tuple[list[float], list[float]]:
        """(composite density, sum of the children's) of each node; keeps
        the characters below each node, in all and in links."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for i, text in self.pieces:
            if text:
                c = len(text) - text.count(" ")
                chars[i] += c
                links[i] += c * in_link[i]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (self.tag[i] == "a")
        share = links[0] / max(chars[0], 1)
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c, t, lc, lt = chars[i], max(tags[i], 1), links[i], max(link_tags[i], 1)
            if c:
                base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
                ratio = c / max(lc, 1) * t / lt
                # the base is 1 on a page without links: the plain logarithm
                density[i] = max(0.0, c / t * math.log(ratio) / max(math.log(base), 1.0)) if ratio > 0 else 0.0
            if i:
                total[self.parent[i]] += density[i]
        self.chars, self.links = chars, links
        return density, total

    def article(self) -> list[int]:
        """Roots of the subtrees that make up the article."""
        density, total = self.densities()
        best = max(range(len(total)), key=lambda i: (total[i], -i))
        if total[best] <= 0:
            return [0]
        path = [best]
        while path[-1] > 0:
            path.append(self.parent[path[-1]])
        inner = next((i for i in path if self.tag[i] in ("article", "main")), None)
        if inner is None and (inside := self._outermost()):
            # the best node holds several articles: they are its text, if most of it
            if 2 * sum(self.chars[i] for i in inside) > self.chars[best]:
                inner = max(inside, key=lambda i: (total[i], -i))
                path = [inner]
                while path[-1] > 0:
                    path.append(self.parent[path[-1]])
        path = [i for i in path if self.tag[i] not in ("#root", "html")]
        if inner is not None:
            return [inner] if self.tag[inner] == "main" else self._articles(inner, path, density, total)
        below = [density[i] for i in range(len(self.tag)) if self.parent[i] == best and self.chars[i] >= LINE]
        least = min((density[i] for i in path), default=0.0)
        if self.tag[best] not in SMALL:
            least = min([least, *below])
        children: dict[int, list[int]] = {}
        for i in range(1, len(self.tag)):
            children.setdefault(self.parent[i], []).append(i)
        found, on_path = {best}, set(path)
        for i in path:
            if self.tag[i] != "body":
                found.update(x for x in children[self.parent[i]]
                             if x not in on_path and self.chars[x] and max(density[x], total[x]) >= least)
        last, heading = max(found), self._headings()
        for i in path:
            if self.tag[i] != "body":
                found.update(x for x in children[self.parent[i]] if x not in on_path and x < last and heading[x])
        return sorted(found)

    def _articles(self, inner: int, path: list[int], density: list[float], total: list[float]) -> list[int]:
        """The article element on the path and the outermost others that are
        as dense as the thinnest node from it to the body."""
        least = min(density[i] for i in path[path.index(inner):])
        return sorted({inner, *(i for i in self._outermost() if i not in set(path) and max(density[i], total[i]) >= least)})

    def _outermost(self) -> list[int]:
        """Article elements that are in no other and have text of their own,
        most of it in no link."""
        inside, found = [False] * len(self.tag), []
        for i in range(1, len(self.tag)):
            inside[i] = inside[self.parent[i]] or self.tag[self.parent[i]] == "article"
            if self.tag[i] == "article" and not inside[i] and self.chars[i] >= LINE and 2 * self.links[i] <= self.chars[i]:
                found.append(i)
        return found

    def _headings(self) -> list[bool]:
        """Whether all text of each subtree is in headings and most of it in no link."""
        n = len(self.tag)
        own = [0] * n  # characters in children that are headings
        out = [False] * n
        for i in range(n - 1, 0, -1):
            if self.chars[i] and 2 * self.links[i] <= self.chars[i]:
                out[i] = self.tag[i] in HEADINGS or own[i] == self.chars[i]
            if out[i]:
                own[self.parent[i]] += self.chars[i]
        return out

    def text(self) -> str:
        keep = [False] * len(self.tag)
        for i in self.article():
            keep[i] = True
        for i in range(1, len(self.tag)):
            keep[i] = keep[i] or keep[self.parent[i]]
        blocks, now = [], []
        for i, text in [*self.pieces, (0, None)]:
            if text is None:
                block = " ".join(html.unescape("".join(now)).split())
                if block:
                    blocks.append(block)
                now = []
            elif keep[i]:
                now.append(text)
        return "\n\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                 keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id, *keep, text, n_chars) of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, *keep, "text", "n_chars"])

    source = pages.select(F.col(html_col).alias("__html"), id_col, *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:]]
    return map_arrow(source, run, ", ".join([*fields, "text string", "n_chars bigint"]))
