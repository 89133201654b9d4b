"""Main text of web pages by a maximum-scoring run of words and tags.

A page is read once into words and tags.  Words score positive and tags
negative; the scores are log ratios of how often each occurs inside and outside
the article of labelled pages.  One linear scan finds the contiguous run with
the largest sum, and its blocks are the text.

Some elements are never the article wherever they stand (menus, adverts,
comments): tags, class, id and role names that labelled pages show only outside
it.  Their subtrees are cut before the scan, so an advert in the middle ends
nothing, and only the cut itself scores.

Labelled pages are those of :mod:`labelled_pages` and a sample of the input's
own pages that mark their article (one outermost ``article`` or ``main``).  The
marking tag itself is no evidence on a page without one: pages that mark their
article and pages that do not have scores of their own.  The sample is bounded
by LABELLED_ROWS expected pages, chosen by a hash of their html; every page is
extracted.

Null and empty html give the empty text.  Repeated rows each get their text;
other columns of any name are ignored.  What a cut-off page ends with (an open
tag, comment or script) is markup.  Work is linear in the page's length.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled_pages
from .common import col, text_batches
from .labelled import sampled

# Expected number of the input's own labelled pages.
LABELLED_ROWS = 2000
# Names of the input's own pages count when this many of its labelled pages have them.
OWN_PAGES = 3
# Log ratio from which on an element counts as seen outside the article only.
OUTSIDE = -1.0
# Share of a type of token below which rates are not told apart, in millionths.
LEAST = 100
MILLION = 1_000_000
# Score of a tag that labelled pages do not show, the largest a tag and the smallest a word may have.
UNKNOWN_TAG, LARGEST_TAG, SMALLEST_WORD = -0.05, -0.01, 0.05

MARKS = {"article", "main"}
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section select summary table tbody td template tfoot th thead title tr ul""".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What an opening tag closes, up to the element in the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
          "option": ({"option"}, {"select"})}
NAMED = ("class", "id", "role", "itemprop")

TAG = re.compile(r"""([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
COMMENT_END = re.compile("--!?>")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Element:
    """An open or closed element: its tag, the place of its parent, its names, what it holds."""
    tag: str
    parent: int
    names: list[tuple[str, ...]]
    in_mark: bool
    paragraphs: int = 0
    headed: bool = False
    marked: bool = False


@dataclass
class Page:
    """Elements in order of opening, and tokens (kind, element, text or tag) in page order."""
    elements: list[Element] = field(default_factory=list)
    tokens: list[tuple[str, int, str]] = field(default_factory=list)


def parts(name: str) -> tuple[str, ...]:
    """The words of a class or id name, in lower case and without a plural s."""
    found = [p.lower() for p in PART.findall(name)]
    return tuple(p[:-1] if len(p) > 3 and p[-1] == "s" and p[-2] != "s" else p for p in found)


def names_of(attributes: str) -> list[tuple[str, ...]]:
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in NAMED:
            out += [p for p in map(parts, entities.unescape(value).split()) if p]
        elif (name == "hidden" or name == "aria-hidden" and value == "true"
              or name == "style" and re.search(r"display\s*:\s*none", value)):
            out.append(("hidden",))
    return out


class Reader:
    """Builds a Page; unclosed and misplaced tags are closed as browsers do."""

    def __init__(self) -> None:
        self.page = Page()
        self.open: list[int] = []
        self.by_tag: dict[str, list[int]] = {}

    def top(self, tag: str) -> int:
        """Place in ``open`` of the innermost open element of this tag, -1 without one."""
        found = self.by_tag.get(tag)
        return found[-1] if found else -1

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            element = self.page.elements[self.open.pop()]
            self.by_tag[element.tag].pop()
            if element.tag in BLOCK:
                self.by_tag["#block"].pop()
            if self.open:
                parent = self.page.elements[self.open[-1]]
                parent.paragraphs += element.paragraphs + (element.tag == "p")
                parent.headed |= element.headed or element.tag == "h1"
                parent.marked |= element.marked or element.tag == "main"

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES:
            closed, within = CLOSES[tag]
            place = max(self.top(t) for t in closed)
            if place > max(self.top(t) for t in within):
                self.pop_to(place)
        if tag in BLOCK and self.top("p") >= 0 and self.top("p") >= self.top("#block"):
            self.pop_to(self.top("p"))
        if tag in HEADINGS and self.open and self.page.elements[self.open[-1]].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        at, parent = len(self.page.elements), self.open[-1] if self.open else -1
        above = self.page.elements[parent] if parent >= 0 else None
        names = names_of(attributes) if attributes and tag not in ("html", "body") else []
        self.page.elements.append(Element(tag, parent, names, above is not None and (above.in_mark or above.tag in MARKS)))
        self.page.tokens.append(("start", at, tag))
        if tag in VOID:
            return
        if tag in BLOCK:
            self.by_tag.setdefault("#block", []).append(len(self.open))
        self.by_tag.setdefault(tag, []).append(len(self.open))
        self.open.append(at)

    def end(self, tag: str) -> None:
        place = self.top(tag)
        if place < 0 or tag not in BLOCK and place < self.top("#block"):
            return
        self.page.tokens.append(("end", self.open[place], tag))
        self.pop_to(place)

    def text(self, raw: str) -> None:
        if raw:
            self.page.tokens.append(("text", self.open[-1] if self.open else -1, entities.unescape(raw)))

    def read(self, html: str) -> Page:
        at, n = 0, len(html)
        plain = 0
        while True:
            lt = html.find("<", at)
            if lt < 0:
                self.text(html[plain:])
                break
            after = html[lt + 1:lt + 2]
            closing = after == "/"
            if closing:
                after = html[lt + 2:lt + 3]
            letter = "a" <= after <= "z" or "A" <= after <= "Z"
            if not (letter or closing or after in ("!", "?")) or lt + 1 == n:
                at = lt + 1  # a plain sign
                continue
            self.text(html[plain:lt])
            if not letter:
                if html.startswith("<!--", lt):
                    end = COMMENT_END.search(html, lt + 2)
                    if end:
                        self.page.tokens.append(("comment", -1, html[lt + 4:end.start()].strip()))
                    at = end.end() if end else n
                else:
                    end = html.find(">", lt)
                    at = end + 1 if end >= 0 else n
            else:
                found = TAG.match(html, lt + 1 + closing)
                if not found:
                    break  # cut off in a tag
                tag, at = found[1].lower(), found.end()
                if closing:
                    self.end(tag)
                elif tag in RAW:
                    at = self.skip(html, tag, at)
                else:
                    self.start(tag, found[2])
            plain = at
            if at >= n:
                break
        self.pop_to(0)
        return self.page

    @staticmethod
    def skip(html: str, tag: str, at: int) -> int:
        """Past the end tag of an element without markup or article text."""
        end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.IGNORECASE).search(html, at)
        return end.end() if end else len(html)


def read(html: str | None) -> Page:
    return Reader().read(html or "")


@dataclass(frozen=True)
class Scores:
    """Log ratios: of names and tags as elements, and of tokens on pages with and without a mark."""
    elements: dict[str, float]
    tokens: dict[bool, dict[str, float]]

    def name(self, name: tuple[str, ...]) -> float:
        """A name seen as a whole speaks for itself, else its worst part does."""
        whole = self.elements.get("-".join(name))
        if len(name) > 1 and whole is not None:
            return whole
        return min(self.elements.get(p, 0.0) for p in name)

    def outside(self, element: Element) -> bool:
        """True if the element is never part of the article."""
        by_tag = self.elements.get(tag_name(element), 0.0)
        if by_tag <= OUTSIDE and element.tag != "form":
            return True
        named = min((self.name(n) for n in element.names if not own_header(element, n)), default=0.0)
        # What holds the page's main part is a frame around it, whatever its name; so is a form.
        frame = element.marked or element.headed and element.paragraphs > 1
        return min(by_tag, named) <= OUTSIDE and not frame


def own_header(element: Element, name: tuple[str, ...]) -> bool:
    """True for the header of an article, which is not the page's."""
    return element.in_mark and name == ("header",)


def tag_name(element: Element) -> str:
    """An element's tag as a feature; a header in an article has one of its own."""
    return f"<{element.tag}{'^' if own_header(element, (element.tag,)) else ''}"


def cut(page: Page, scores: Scores | None) -> list[bool]:
    """For every element, whether it lies in a subtree that is never article."""
    out: list[bool] = []
    for element in page.elements:
        out.append(element.parent >= 0 and out[element.parent] or scores is not None and scores.outside(element))
    return out


def marks(page: Page, gone: list[bool]) -> list[int]:
    """The outermost uncut elements that mark the article."""
    return [i for i, e in enumerate(page.elements) if e.tag in MARKS and not e.in_mark and not gone[i]]


def within(page: Page, roots: list[int]) -> list[bool]:
    """For every element, whether it is one of ``roots`` or inside one."""
    out, chosen = [], set(roots)
    for i, element in enumerate(page.elements):
        out.append(i in chosen or element.parent >= 0 and out[element.parent])
    return out


def marked(page: Page, gone: list[bool]) -> list[bool]:
    """Elements inside the article's mark; nothing if the page has none.

    One mark is taken at its word, several if they hold half of the words left.
    """
    roots = marks(page, gone)
    if not roots:
        return []
    inside = within(page, roots)
    if len(roots) > 1:
        words: Counter = Counter()
        for kind, at, value in page.tokens:
            if kind == "text" and not (at >= 0 and gone[at]):
                words[at >= 0 and inside[at]] += len(value.split())
        if words[True] < words[False]:
            return []
    return inside


def items(page: Page, gone: list[bool], inside: list[bool]) -> Iterator[tuple[str, str, int]]:
    """(type of token, text of a block or '', element) in page order; a block's words come together."""
    words: list[str] = []
    place = -1

    def block() -> Iterator[tuple[str, str, int]]:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            yield ("word" if not inside or place >= 0 and inside[place] else "word outside"), text, place

    for kind, at, value in page.tokens:
        hidden = at >= 0 and gone[at]
        if kind == "text":
            if not hidden:
                words.append(value)
                place = at
        elif kind == "comment":
            yield "comment", value, at
        elif hidden:
            parent = page.elements[at].parent
            if kind == "start" and not (parent >= 0 and gone[parent]):
                if value in BLOCK:
                    yield from block()
                yield "cut", "", parent
        else:
            if value in BLOCK:
                yield from block()
            elif value == "br":
                words.append(" ")
            yield value, "", at
    yield from block()


def extract(html: str | None, scores: Scores) -> str:
    """The main text of a page."""
    page = read(html)
    gone = cut(page, scores)
    inside = marked(page, gone)
    score = scores.tokens[bool(inside)]
    blocks: list[str] = []
    total, start, best, found = 0.0, 0, 0.0, (0, 0)
    for kind, text, _ in items(page, gone, inside):
        if kind == "comment":
            continue
        if text:
            blocks.append(text)
            total += score.get(kind, 0.0) * len(text.split())
        else:
            total += score.get(kind, UNKNOWN_TAG)
        if total <= 0:
            total, start = 0.0, len(blocks)
        elif total > best:
            best, found = total, (start, len(blocks))
    return "\n".join(blocks[found[0]:found[1]])


def evidence(html: str, scores: Scores | None, own: bool) -> Iterator[tuple[str, str, int, int]]:
    """What a labelled page shows, as (kind, name, inside, outside).

    Kind "element": 1 where an element of this tag or name holds article text or
    other text.  Kind "token 0" (page without mark) or "token 1": the type's
    share of tokens in millionths, less what ``scores`` cut.  An ``own`` page has
    its article in its one mark (without what is cut), others between comments.
    """
    page = read(html)
    gone = cut(page, scores)
    roots = marks(page, gone)
    if own and len(roots) != 1:
        return
    inside = within(page, roots)
    seen: dict[bool, set[int]] = {True: set(), False: set()}
    article = False
    for kind, at, value in page.tokens:
        if kind == "comment":
            article = value == labelled_pages.START or article and value != labelled_pages.END
        elif kind == "text" and value.strip():
            label = at >= 0 and inside[at] and not gone[at] if own else article
            while at >= 0 and at not in seen[label]:
                seen[label].add(at)
                at = page.elements[at].parent
    shown = {label: {f for at in found for f in features(page.elements[at])} for label, found in seen.items()}
    for name in sorted(shown[True] | shown[False]):
        yield "element", name, int(name in shown[True]), int(name in shown[False])
    article = False
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for kind, text, at in items(page, gone, inside if roots else []):
        if kind == "comment":
            article = text == labelled_pages.START or article and text != labelled_pages.END
        else:
            label = at >= 0 and inside[at] and at != roots[0] if own else article
            counts[label][kind] += len(text.split()) if text else 1
    sums = {label: max(1, sum(c.values())) for label, c in counts.items()}
    for kind in sorted(counts[True] | counts[False]):
        yield (f"token {int(bool(roots))}", kind, counts[True][kind] * MILLION // sums[True],
               counts[False][kind] * MILLION // sums[False])


def features(element: Element) -> list[str]:
    return [tag_name(element), *("-".join(n) for n in element.names if not own_header(element, n))]


def element_scores(rows: list[tuple[str, int, int]]) -> dict[str, float]:
    """Log ratio of pages that show a name inside and outside; a tag seen inside is no evidence."""
    return {name: math.log((i + 0.5) / (o + 0.5)) for name, i, o in rows if not (name.startswith("<") and i)}


def token_scores(rates: dict[str, tuple[float, float]]) -> dict[str, float]:
    out = {}
    for kind, (i, o) in rates.items():
        ratio = math.log((i + LEAST) / (o + LEAST))
        out[kind] = max(ratio, SMALLEST_WORD) if kind == "word" else min(
            ratio, 0.0 if kind == "word outside" else LARGEST_TAG)
    return out


def sums_of(rows: Iterator[tuple[str, str, int, int]]) -> dict[tuple[str, str], list[int]]:
    out: dict[tuple[str, str], list[int]] = {}
    for kind, name, i, o in rows:
        at = out.setdefault((kind, name), [0, 0])
        at[0] += i
        at[1] += o
    return out


def fitted(own: dict[tuple[str, str], list[int]], own_pages: int) -> Scores:
    """Scores from the labelled pages and the sums over the input's own (token rates weigh half each)."""
    elements = element_scores([(name, *v) for (_, name), v in sums_of(
        r for page in labelled_pages.PAGES for r in evidence(page, None, False) if r[0] == "element").items()])
    first = Scores(elements, {})
    shown = sums_of(r for page in labelled_pages.PAGES for r in evidence(page, first, False))
    n_marked = sum(bool(marks(read(p), cut(read(p), first))) for p in labelled_pages.PAGES)
    pages = {"token 1": n_marked, "token 0": len(labelled_pages.PAGES) - n_marked}
    rates: dict[bool, dict[str, tuple[float, float]]] = {True: {}, False: {}}
    for kind in pages:
        for name in sorted({n for k, n in {*shown, *own} if k == kind}):
            both = [x / max(1, pages[kind]) for x in shown.get((kind, name), (0, 0))]
            if own_pages and kind == "token 1":
                both = [(x + y / own_pages) / 2 for x, y in zip(both, own.get((kind, name), (0, 0)), strict=True)]
            rates[kind == "token 1"][name] = both[0], both[1]
    names = element_scores([(name, *v) for (kind, name), v in own.items() if kind == "element"])
    # What the labelled pages say of a name holds; tags of the input's own pages are left to the scan.
    names = {k: v for k, v in names.items() if not k.startswith("<")}
    return Scores({**names, **elements}, {k: token_scores(v) for k, v in rates.items()})


def learned(pages: DataFrame, bound: int = LABELLED_ROWS, html_col: str = "html") -> Scores:
    """Scores from the labelled pages and a sample of about ``bound`` own pages that mark their article."""
    html = col(html_col)
    marking = pages.where(html.rlike(r"(?i)<(article|main)[\s>]")).select(html.alias("html"))
    n = marking.count()
    if not n:
        return fitted({}, 0)
    first = fitted({}, 0)

    def shown(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for page in frame["html"] for r in evidence(page, first, True)]
            yield pd.DataFrame(rows, columns=["kind", "name", "i", "o"])

    chosen = text_batches(marking).where(sampled(F.xxhash64("html"), bound, n, "own-pages")) if n > bound else marking
    rows = (chosen.mapInPandas(shown, "kind string, name string, i long, o long").groupBy("kind", "name")
            .agg(F.sum("i").alias("i"), F.sum("o").alias("o"), F.count("*").alias("n"))
            .where(F.col("kind").startswith("token") | (F.col("n") >= OWN_PAGES)).collect())
    # Every own page with evidence has its mark's tags among its tokens.
    n_own = max((r["n"] for r in rows if r["kind"] == "token 1"), default=0)
    return fitted({(r["kind"], r["name"]): [r["i"], r["o"]] for r in rows}, n_own)


def text_column(html: Column, scores: Scores) -> Column:
    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: extract(p, scores))
    return text(F.coalesce(html, F.lit("")))


def main_texts(pages: DataFrame, bound: int = LABELLED_ROWS, html_col: str = "html", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """page_id, url, text of every row of ``pages``."""
    scores = learned(pages, bound, html_col)
    return text_batches(pages).select(col(id_col).alias("page_id"), col(url_col).alias("url"),
                                      text_column(col(html_col), scores).alias("text"))
