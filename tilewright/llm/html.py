"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams events. Text between two block borders is a
line, with the number of tags met in it. The ratios of text to tags along the page,
smoothed by a Gaussian, fall into two clusters; lines of the denser one that stand in
no menu, footer or the like mark the content. Names, forms and headers are hints only: an
element that holds the content by its dense text or its marks is none. The deepest part of the page that holds
most of them lies in the article: the <article> or <main> around it, or else the
smallest part that holds all of them. All lines of that are the text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import map_columns

# Element names of HTML by their role, and name parts that pages use.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog footer form head header iframe input label math "
    "menu nav noscript object optgroup option script search select style svg template textarea title "
    "video".split()
)
HINTS = frozenset(["form", "header"])  # of those dropped, the ones that can hold an article or its title
ARTICLES = frozenset(["article", "main"])
CONTAINERS = frozenset("article body center details dir div fieldset main section table td".split())
SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"),
}
ENDS_AT = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
    "td": ("tr", "table"), "th": ("tr", "table"),
}
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies copyright disqus footer gdpr header login masthead menu "
    "menubar modal nav navbar navigation newsletter notice overlay pagination pager popup promo promoted "
    "promotion related reply replies respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
# Of these, names that wrap no article however much text they hold.
NEVER_NAMES = frozenset(
    "comment commentlist comments consent cookie cookies disqus gdpr replies reply respond".split()
)
WORD = re.compile(r"[a-z0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def is_aside(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """Whether an element is kept out of the article: "" for no, "sure", or "hint" where its content decides."""
    if tag in DROPPED and tag not in HINTS:
        return "sure"
    if tag in ("html", "body", "h1", "main"):
        return ""
    if tag == "article":  # readers' comments are often marked up as articles
        words = WORD.findall(f"{dict(attrs).get('class')} {dict(attrs).get('id')}".lower())
        return "sure" if "comment" in words or "comments" in words else ""
    found = "hint" if tag in HINTS else ""
    for name, value in attrs:
        if name == "hidden":
            return "sure"
        lowered = (value or "").lower()
        if name in ("class", "id") and not ASIDE_NAMES.isdisjoint(WORD.findall(lowered)):
            found = "hint"
        if name == "role" and lowered.strip() in ASIDE_ROLES:
            return "sure"
        if name == "aria-hidden" and lowered.strip() == "true":
            return "sure"
        if name == "style" and HIDDEN.search(lowered):
            return "sure"
    return found


class Lines(HTMLParser):
    """Collects the lines of a page: text, tags met, innermost container, in a sure aside or not, innermost hint.

    Elements are numbered as they open, and for each container and hint the one around it and
    the last number inside it are kept, so that no line repeats what is around it and the
    work grows with the page alone, however deep it is nested. Text of inline elements that
    are no part of an article, such as scripts and buttons, is left out without ending the line.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, number, aside, muted
        self.places: dict[str, list[int]] = {}  # per tag the places of its open elements
        self.number = self.asides = self.muted = self.tags = 0
        self.parts: list[str] = []
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.articles: set[int] = set()
        self.open_articles = 0
        self.containers, self.around = [0], [0]  # the open containers and hints
        self.container_parent: dict[int, int] = {}
        self.hint_parent: dict[int, int] = {}
        self.last: dict[int, int] = {}  # of a container, the last number in it
        self.hints: dict[int, tuple[str, bool, bool]] = {}  # tag, in an article, in one that never is an article
        self.marks: list[tuple[str, int]] = []  # h1, article and main with the innermost hint

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no name follows: to browsers it is a comment up to the next >
            return self.parse_bogus_comment(i)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(1, self.tags), self.containers[-1], self.asides > 0, self.around[-1]))
            self.tags = 0
        self.parts = []

    def pop(self, at: int) -> None:
        """End the open element at a place of the stack and all inside it."""
        if any(tag in BLOCKS for tag, _, _, _ in self.open[at:]):
            self.flush()
        for tag, number, aside, muted in reversed(self.open[at:]):
            self.asides -= aside
            self.muted -= muted
            self.open_articles -= number in self.articles
            self.places[tag].pop()
            if self.containers[-1] == number:
                self.containers.pop()
                self.last[number] = self.number
            if self.around[-1] == number:
                self.around.pop()
        del self.open[at:]

    def innermost(self, tags: tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; a list item or cell ends the one before it."""
        own, ends = SAME.get(tag, ()), ENDS_AT.get(tag, ("td", "th", "table"))
        # Where a name is among both, an element of it is one to be ended.
        until = self.innermost(tuple(t for t in ends if t not in own and t != "p"))
        while (at := self.innermost((*own, "p"))) > until:
            self.pop(at)
            if not own:
                break

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag == "hr":
            self.close_implied(tag)
            self.flush()
        if tag in VOID:
            return
        aside = is_aside(tag, attrs)
        if tag in BLOCKS:
            self.close_implied(tag)
            self.flush()
        elif not aside and not self.muted:
            return
        muted = tag not in BLOCKS
        self.number += 1
        if aside == "hint" and not muted and not self.asides:
            names = f"{dict(attrs).get('class')} {dict(attrs).get('id')}".lower()
            around = self.around[-1]
            never = not NEVER_NAMES.isdisjoint(WORD.findall(names)) or around > 0 and self.hints[around][2]
            self.hints[self.number] = tag, self.open_articles > 0, never
        if tag in ("h1", "article", "main") and not aside and not self.asides:
            self.marks.append((tag, self.around[-1]))
        if self.number in self.hints:
            self.hint_parent[self.number] = self.around[-1]
            self.around.append(self.number)
        if tag in CONTAINERS:
            self.container_parent[self.number] = self.containers[-1]
            self.containers.append(self.number)
        sure = aside == "sure" or muted
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, self.number, sure, muted))
        self.asides += sure
        self.muted += muted
        if tag in ARTICLES:
            self.articles.add(self.number)
            self.open_articles += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if self.places.get(tag):
            self.pop(self.places[tag][-1])
        elif tag in BLOCKS:
            self.flush()

    def handle_data(self, data):
        if not self.muted:
            self.parts.append(data)

    def close(self):
        super().close()
        self.flush()
        self.pop(0)


def smooth(values: np.ndarray, sigma: float = 1.5) -> np.ndarray:
    """A Gaussian mean along the lines, renormalised at the ends."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / weight


def two_clusters(values: np.ndarray) -> float:
    """The border between the two clusters that k-means finds on a line."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        border = (low + high) / 2
        above = values > border
        if not above.any() or above.all():
            return border
        means = float(values[~above].mean()), float(values[above].mean())
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2


def gathered(values: dict[int, int], parent: dict[int, int]) -> dict[int, int]:
    """Sums over elements and all inside them; an element has a greater number than the one around it."""
    total = {n: values.get(n, 0) for n in parent}
    for n in sorted(parent, reverse=True):
        if parent[n]:
            total[parent[n]] += total[n]
    return total


def asides_by_hint(parser: Lines, dense: list[int], most: float) -> set[int]:
    """The elements that hints call asides and all hints inside of these, without those that hold the content.

    An element is none if it holds a <main>, the page's only <article>s or <h1>s, an <h1>
    within an article, or most of the dense text on a page that marks no article outside
    of it; neither is an article's own <header>.
    """
    own: dict[int, int] = {}
    whole = 0
    for i in dense:
        line, _, _, _, around = parser.lines[i]
        if not around or not parser.hints[around][2]:
            whole += len(line)
            own[around] = own.get(around, 0) + len(line)
    text = gathered(own, parser.hint_parent)
    marks = {
        tag: gathered({n: 1 for mark, n in parser.marks if mark == tag}, parser.hint_parent)
        for tag in ("h1", "article", "main")
    }
    outside = {tag for tag, around in parser.marks if not around}
    marked = not outside.isdisjoint(ARTICLES)
    asides = set()
    for n, (tag, within, never) in parser.hints.items():  # outer elements come first
        held = {mark for mark, count in marks.items() if count[n]}
        if parser.hint_parent[n] in asides or not (
            tag == "header" and within
            or "main" in held
            or "article" in held and not marked
            or "h1" in held and tag != "header" and (within or "h1" not in outside and not marked)
            or not never and not marked and whole and text[n] >= most * whole
        ):
            asides.add(n)
    return asides


def main_text(html: str, most: float = 0.6) -> str:
    """The article of a page, one line per block; empty if there is none."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratio = smooth(np.array([len(line[0]) / line[1] for line in lines]))
    border = two_clusters(ratio)
    sure = [i for i, line in enumerate(lines) if not line[3]]
    asides = asides_by_hint(parser, [i for i in sure if ratio[i] > border] or sure, most)
    inside = [i for i in sure if lines[i][4] not in asides]
    if not inside:
        return ""
    dense = [i for i in inside if ratio[i] > border] or inside
    # Per container the dense lines in it; the deepest one with most of their text is in the article.
    own_size: dict[int, int] = {}
    own_count: dict[int, int] = {}
    for i in dense:
        n = lines[i][2]
        own_size[n] = own_size.get(n, 0) + len(lines[i][0])
        own_count[n] = own_count.get(n, 0) + 1
    size = gathered(own_size, parser.container_parent)
    count = gathered(own_count, parser.container_parent)
    whole = sum(len(lines[i][0]) for i in dense)
    large = [n for n in size if count[n] and size[n] >= most * whole]
    anchor = max([n for n in large if count[n] > 1] or large, default=None)
    if anchor is None:
        return "\n".join(lines[i][0] for i in inside)
    around = anchor
    while around and around not in parser.articles:
        around = parser.container_parent[around]
    anchor = around or max((n for n in count if count[n] == len(dense)), default=None)
    return "\n".join(
        lines[i][0] for i in inside if anchor is None or anchor <= lines[i][2] <= parser.last[anchor]
    )


def extract_text(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of the main text of every whole page.

    A null or empty page, or one without text outside of menus and the like, has empty
    text. Broken markup is read as far as it goes; it is never an error. Null ids and urls stay
    null, repeated rows give one row each, an empty table an empty result. Only the three named columns are read.
    """

    def make():
        def rows(ids, urls, pages):
            for key, url, page in zip(ids, urls, pages):
                text = main_text(page or "")
                yield key, url, text, len(text)

        return rows

    chosen = df.select(
        F.col(f"`{id_col}`").cast("long"), F.col(f"`{url_col}`").cast("string"), F.col(f"`{html_col}`")
    )
    return map_columns(chosen, "page_id long, url string, text string, n_chars long", make)
