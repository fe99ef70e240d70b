"""Main text of web pages: text-to-tag ratios of the parser's events, smoothed and clustered.

The events of the standard library's parser make lines: the text between two
block-level tags, with the number of tags on the way to it. A line's
text-to-tag ratio is its text outside links over its tags. Ratios are smoothed
by a Gaussian over neighbouring lines and split at a threshold between their
two clusters; the lines above it are content. The content region is the
article element (else main) that holds most content characters; without one,
the smallest section, div or body that holds all lines of content, and what
stands from the last h1 before them, else the last heading, down to it. All
lines of the region are returned, so short paragraphs stay, and all lines of a
page that has no content line.

Lines never count if they stand in elements that are no text (scripts, styles,
controls), that the markup names as navigation, page header, footer, aside or
hidden, or whose role says so. Forms go, too, but for one that wraps the page:
it holds more than half of the text outside links. Containers also go by their name (adverts,
notices, menus, sidebars, comments): a whole class, or the id of a div or list,
all of whose words are such names or plain words of layout, so that
``share-price`` stays. Inside article and main, names that articles use as well
go only if half of the element's text is linked, or no line of it is content.
Lists of links alone are dropped, too, and without article and main other
elements that are nothing but three links or more, without a heading.

Null, empty and text-free pages give the empty text. Unclosed and stray tags
are tolerated as a browser would: the next block ends a p, the next sibling an
li, dt, dd, tr, td or th. Other columns of the table are returned as
they came, except columns named text or n_chars, which are replaced; repeated
rows are extracted each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import slices

SIGMA = 1.0

CONTAINERS = {*"article main section div nav header footer aside form ul ol dl table blockquote figure body details fieldset dialog menu td".split()}
BLOCKS = CONTAINERS | {*"p h1 h2 h3 h4 h5 h6 li dt dd tr th thead tbody tfoot caption figcaption pre hr address summary legend html center".split()}
#: Elements whose text is no text of the page, or no part of an article.
NEVER = {*"script style noscript template head title svg math iframe object button select option textarea nav footer aside dialog menu".split()}
ROLES = {*"navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split()}
#: Words of names that are no part of an article anywhere.
ADS = {*"ad ads adv advert adverts advertisement advertising sponsor sponsored".split()}
CERTAIN = ADS | {*"cookie cookies consent gdpr newsletter sidebar sidebars navbar breadcrumb breadcrumbs pagination pager comments disqus".split()}
#: Words of names that mean something else in some articles.
NAMES = CERTAIN | {
    *"promo promotion notice notices alert popup modal overlay subscribe subscription signup aside".split(),
    *"nav navigation menu menus footer masthead topbar toolbar".split(),
    *"comment reply replies respond share sharing social related recommended widget widgets login".split(),
}
#: Names of reader comments, without a last s, whether or not their words are separated.
DISCUSSION = {*"commentlist commentthread commentarea commentsection commentform commentblock usercomment readercomment visitorcomment".split()}
#: Words that may stand beside them in a name.
LAYOUT = {*"area banner bar block blocks box button buttons container content group holder icons inner item items left link links list".split()}
LAYOUT |= {*"main mobile outer page panel post posts right section site slot stories top bottom unit wrap wrapper articles form thread".split()}
#: What the start of an element ends: the open elements, and those beyond which it ends none.
ROWS = {*"thead tbody tfoot".split()}
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, CONTAINERS - {"div"}),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, CONTAINERS - {"div"})),
    "tr": ({"tr"}, {"table"}),
    **dict.fromkeys(("td", "th"), ({"td", "th"}, {"table", "tr"})),
    **dict.fromkeys(ROWS, (ROWS, {"table"})),
}
#: No tag inside ends an element outside of these.
SCOPES = {*"table td th caption button object template html".split()}
TABLE = {*"table thead tbody tfoot tr td th caption".split()}
HEADINGS = {*"h1 h2 h3 h4 h5 h6".split()}
#: Elements kept on the stack.
KEPT = CONTAINERS | NEVER | TABLE | HEADINGS | {*"p li dt dd".split()}
#: Elements that can be the region.
REGIONS = {*"article main section div body center td".split()}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")


class Line:
    __slots__ = ("text", "linked", "tags", "links", "path")

    def __init__(self, text: str, linked: int, tags: int, links: int, path: tuple[int, ...]):
        self.text, self.linked, self.tags, self.links, self.path = text, linked, tags, links, path

    @property
    def size(self) -> int:
        return len(self.text.replace(" ", ""))  # as links are counted


class LineParser(HTMLParser):
    """Collects the lines of a page; ``elements`` holds the tag of each element by number, ``named`` those dropped if they look so."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.elements: list[str] = []
        self.named: set[int] = set()
        self.counts: Counter[str] = Counter()  # of open elements by tag
        self.open: list[tuple[str, int, bool]] = []  # tag, number, whether its text never counts
        self.text: list[str] = []
        self.linked, self.tags, self.links, self.in_link = 0, 0, 0, False

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append(Line(text, self.linked, max(1, self.tags), self.links, tuple(n for _, n, _ in self.open)))
            self.tags = 0
        self.text, self.linked, self.links = [], 0, 0

    def never(self, tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
        if tag in NEVER:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header" and not inside:
            return True
        given = dict(attributes)
        return "hidden" in given or given.get("aria-hidden") == "true" or (given.get("role") or "").lower() in ROLES

    def name(self, tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool | None:
        """Whether the element goes by its name; None if it must look so, too."""
        if tag in HEADINGS or tag in ("html", "body", "article", "main"):
            return False
        given, doubt = dict(attributes), False
        whole = (given.get("class") or "").split() + [given.get("id") or ""] * (tag in ("div", "ul", "ol", "table"))
        for words in ([t.lower() for t in _TOKEN.findall(name)] for name in whole):
            own = {*words} & NAMES
            if tag not in CONTAINERS:
                own &= ADS
            if not own and not inside and words in (["header"], ["site", "header"]) and tag in CONTAINERS:
                return True
            if tag in CONTAINERS and "".join(words).rstrip("s") in DISCUSSION:
                return True
            if own and {*words} <= NAMES | LAYOUT:
                if not inside or own & CERTAIN:
                    return True
                doubt = True
        return None if doubt else False

    def end_open(self, at: int) -> None:
        self.end_line()
        self.counts.subtract(tag for tag, _, _ in self.open[at:])
        del self.open[at:]

    def end_implied(self, tag: str) -> None:
        """Ends what the start of the tag ends."""
        ends, beyond = ENDS.get(tag, (set(), set()))
        if any(self.counts[t] > 0 for t in ends):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ends:
                    self.end_open(i)
                    break
                if self.open[i][0] in beyond:
                    break
        if self.counts["p"] > 0 and tag in BLOCKS and tag not in TABLE - {"table"}:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self.end_open(i)
                    break
                if self.open[i][0] in SCOPES:
                    break
        if tag in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self.end_open(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in NEVER:
            self.end_line()
            self.end_implied(tag)
        self.tags += 1
        if tag == "a":
            self.in_link = True
            self.links += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        never, named = bool(self.open and self.open[-1][2]), False
        if not never:
            inside = self.counts["article"] > 0 or self.counts["main"] > 0
            never = self.never(tag, attrs, inside)
            named = not never and self.name(tag, attrs, inside)
        if tag in KEPT or never and not (self.open and self.open[-1][2]) or named:
            if tag not in BLOCKS:
                self.end_line()
            if named is None:
                self.named.add(len(self.elements))
            self.open.append((tag, len(self.elements), never or bool(named)))
            self.counts[tag] += 1
            self.elements.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in NEVER:
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.in_link = False
        if self.counts[tag] <= 0:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag or tag in HEADINGS and self.open[i][0] in HEADINGS:
                self.end_open(i)
                break
            if self.open[i][0] in SCOPES and tag not in TABLE | {"html", "body"} or tag in TABLE and self.open[i][0] == "table":
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][2]:
            return
        self.text.append(data)
        if self.in_link:
            self.linked += len(_SPACE.sub("", data))


VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbouring lines; at the ends over those that exist."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return full / weight


def threshold(values: np.ndarray) -> float:
    """The middle between the means of two clusters, by moving it until nothing changes."""
    low, high = float(values.min()), float(values.max())
    at = (low + high) / 2
    for _ in range(50):
        upper = values >= at
        if upper.all() or not upper.any():
            break
        moved = (values[upper].mean() + values[~upper].mean()) / 2
        if moved == at:
            break
        at = moved
    return min(at, high)


def without_forms(lines: list[Line], elements: list[str]) -> list[Line]:
    """The lines outside of forms; their tags stay on the way to the next line. A form that wraps the page stays."""
    inside: dict[int, int] = {}
    for line in lines:
        for number in line.path:
            if elements[number] == "form":
                inside[number] = inside.get(number, 0) + max(0, line.size - line.linked)
    total = sum(max(0, line.size - line.linked) for line in lines)
    dropped = {number for number, chars in inside.items() if 2 * chars <= total}
    kept, tags = [], 0
    for line in lines:
        if dropped & {*line.path}:
            tags += line.tags
        else:
            line.tags += tags
            kept.append(line)
            tags = 0
    return kept


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = without_forms(parser.lines, parser.elements)
    if not lines:
        return ""
    sizes = np.array([line.size for line in lines], dtype=float)
    free = np.maximum(0.0, sizes - np.array([line.linked for line in lines]))
    ratios = smoothed(np.log1p(free / np.array([line.tags for line in lines])))
    content = ratios >= threshold(ratios)

    held: dict[int, float] = {}
    for line, chars in zip(lines, free * content, strict=True):
        for number in line.path:
            held[number] = held.get(number, 0.0) + chars
    total = float((free * content).sum())
    region = None
    for tag in ("article", "main"):
        best = max((n for n in held if parser.elements[n] == tag), key=lambda n: held[n], default=None)
        if region is None and best is not None and held[best] > 0.5 * total:
            region = best
    if region is not None:
        chosen = [line for line in lines if region in line.path]
    else:
        found = [i for i, chars in enumerate(free * content) if chars > 0]
        if not found:
            return "\n\n".join(line.text for line in lines)
        common = lines[found[0]].path
        for i in found:
            common = common[: sum(1 for _ in takewhile(lambda pair: pair[0] == pair[1], zip(common, lines[i].path)))]
        region = next((n for n in reversed(common) if parser.elements[n] in REGIONS), None)
        # The title may stand in an element before the region.
        tags = [next((t for n in reversed(line.path) if (t := parser.elements[n]) in HEADINGS), None) for line in lines[: found[0] + 1]]
        titles = [i for i, tag in enumerate(tags) if tag and free[i] > 0]
        first = max((i for i in titles if tags[i] == "h1"), default=max(titles, default=found[0]))
        chosen = [line for i, line in enumerate(lines) if region is None or region in line.path or first <= i <= found[0]]

    # Elements that hold nothing but links are menus.
    linked: dict[int, list[int]] = {}
    for line in chosen:
        for number in line.path:
            entry = linked.setdefault(number, [0, 0, 0])
            for i, count in enumerate((line.linked, line.size, line.links)):
                entry[i] += count
    looks = {n for n, (inside, size, _) in linked.items() if n in parser.named and (2 * inside >= size or not held[n])}
    menus = {n for n, (inside, size, _) in linked.items() if n != region and parser.elements[n] in ("ul", "ol", "menu", "dl") and inside >= size}
    if region is None or parser.elements[region] not in ("article", "main"):
        headed = {n for line in chosen if any(parser.elements[n] in HEADINGS for n in line.path) for n in line.path}
        menus |= {n for n, (inside, size, links) in linked.items() if n != region and n not in headed and inside >= size and links >= 3}
    return "\n\n".join(line.text for line in chosen if not (menus | looks) & set(line.path))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without the html, with text and n_chars."""
    kept = [f for f in pages.schema.fields if f.name.lower() not in (html.lower(), "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page) for page in batch.column(html).to_pylist()]
            columns = [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), "text", "n_chars"])

    schema = type(pages.schema)([*kept]).add("text", "string").add("n_chars", "long")
    return pages.select(*(F.col(f"`{f.name}`") for f in kept), F.col(html).cast("string").alias(html)).mapInArrow(run, schema)
