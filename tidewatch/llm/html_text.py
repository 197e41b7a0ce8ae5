"""Main text of HTML pages by line-block distribution.

Markup is stripped so that every block element leaves one line; what stands in menus, adverts and
the like leaves a line without weight. The text lengths of a few consecutive lines are summed in a
sliding window: where the sums surge text begins, where they dive it ends. Every such run is kept,
and what lies between two runs of one parent element. If the heaviest run lies in an article element,
the surge and the dive move to that element's first and last line, so that a short closing paragraph
is not lost; articles beside it are kept as well.
"""

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

# Lines in a window, and the characters in a window from which text counts as surging.
WINDOW = 3
SURGE = 80

# Element names and words of class, id and role.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr "
    "ul".split()
)
RAW = frozenset("script style noscript template iframe textarea svg math object".split())
DROPPED = frozenset(
    "head nav footer aside form button select option dialog menu noscript template iframe textarea "
    "svg math object script style title".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
    "note status toolbar".split()
)
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored "
    "promo promotion sidebar sidebars aside rail nav navbar navigation navi menu menus breadcrumb "
    "breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "comment comments commentlist disqus reply replies respond discussion related recommended "
    "recommendations widget widgets pagination pager skip".split()
)
# Words that mark noise only where they are the whole class or id, not a part of it.
WHOLE_NOISE = frozenset("header site-header page-header top bottom links tags meta".split())
MAIN = frozenset(("article", "main"))
ITEMS = frozenset("li dt dd option tr td th".split())
WALLS = frozenset(
    "ul ol dl table div article section main body select blockquote td th".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
    re.IGNORECASE,
)
# Classes that say what a layout has, not what the element is.
_LAYOUT = re.compile(r"(?:has|no|with|without)[-_].*|.*[-_](?:enabled|disabled)")
_WORDS = re.compile(r"[a-z0-9]+(?=[^a-z0-9]|\Z)|[a-z0-9]+")


# How sure noise is: a class or an id is a guess that an article inside refutes.
MAYBE, SURE = 1, 2


def _is_noise(name: str, rest: str, inside_main: bool) -> int:
    if name in DROPPED or (name == "header" and not inside_main):
        return SURE
    if not rest or name in ("html", "body"):
        return 0
    found = 0
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), next(filter(None, values), "").strip().lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return SURE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
        if key == "role" and value in ROLES:
            return SURE
        if key in ("class", "id") and name not in MAIN:
            for word in value.split():
                if _LAYOUT.fullmatch(word):
                    continue
                if word in WHOLE_NOISE or not NOISE.isdisjoint(_WORDS.findall(word)):
                    found = MAYBE
    return found


class _Open(NamedTuple):
    """An open element: ``sure`` if it is noise in any case, ``maybe`` the elements around a line
    whose class or id says noise, and the outermost main element, -1 for none."""

    name: str
    number: int
    sure: bool
    maybe: tuple[int, ...]
    scope: int

    @property
    def noise(self) -> bool:
        return self.sure or bool(self.maybe)


ROOT = _Open("", -1, False, (), -1)


class _Lines:
    """The lines of a page: text, whether it is noise, and the elements it stands in."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        # The element each line stands in, its link characters, its block and that one's parent.
        self.within: list[_Open] = []
        self.linked: list[int] = []
        self.blocks: list[tuple[int, int]] = []
        self.open: list[_Open] = []
        self.elements = 0
        # Elements that are no noise, as an article in them says.
        self.cleared: set[int] = set()
        # Name and parent element of each scope, and whether it has had an article.
        self.scopes_at: list[tuple[str, int]] = []
        self.told: list[bool] = []
        self.parts: list[str] = []
        self.links = 0
        self._read(page)
        self.noise = [x.sure or not self.cleared.issuperset(x.maybe) for x in self.within]
        # A line that is mostly links has no weight, though it stays if it stands in the text.
        self.weights = [
            0 if noise or 2 * links > len(text) else len(text) - links
            for text, noise, links in zip(self.texts, self.noise, self.linked)
        ]
        self.scopes = [-1 if noise else x.scope for x, noise in zip(self.within, self.noise)]

    def _read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            token = _TOKEN.search(page, at)
            if token is None:
                self._text(page[at:])
                break
            self._text(page[at : token.start()])
            at = token.end()
            name = (token["name"] or token["name2"] or "").lower()
            if not name:
                continue
            if token["close"] or token["close2"]:
                self._close(name)
            else:
                rest = token["rest"] if token["name"] else token["rest2"]
                self._begin(name, rest)
                if name in RAW and not rest.endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                    self.open.pop()
                    at = end.end() if end else size
        self._break()

    def _text(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if any(x.name == "a" for x in self.open[-3:]):
                self.links += len(text)

    def _break(self) -> None:
        """End the line; the state is that of the elements its text stands in."""
        text = " ".join(html.unescape("".join(self.parts)).split())
        links, self.parts, self.links = self.links, [], 0
        if not text:
            return
        self.texts.append(text)
        self.within.append(self.open[-1] if self.open else ROOT)
        self.linked.append(links)
        at = next((n for n in range(len(self.open) - 1, -1, -1) if self.open[n].name in BLOCKS), -1)
        block = self.open[at].number if at >= 0 else -1
        self.blocks.append((block, self.open[at - 1].number if at > 0 else -1))

    def _begin(self, name: str, rest: str) -> None:
        above = self.open[-1] if self.open else ROOT
        bad = _is_noise(name, rest, above.scope >= 0)
        if name in BLOCKS or bool(bad) != above.noise:
            self._break()
        if name in BLOCKS and name not in ("br", "hr"):
            self._end_paragraph(name)
            above = self.open[-1] if self.open else ROOT
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            return
        sure, maybe, scope = above.sure or bad == SURE, above.maybe, above.scope
        if name in MAIN and not sure:
            # Around the first article of a main element, and around one outside of any, no class
            # or id is right that says noise.
            if scope < 0:
                self.cleared.update(maybe)
                scope = len(self.told)
                self.told.append(name == "article")
                self.scopes_at.append((name, above.number))
            elif not self.told[scope]:
                self.cleared.update(maybe)
                self.told[scope] = name == "article"
        if bad == MAYBE:
            maybe = (*maybe, self.elements)
        self.open.append(_Open(name, self.elements, sure, maybe, scope))
        self.elements += 1

    def _end_paragraph(self, name: str) -> None:
        """A block ends an open paragraph, an item the item before it."""
        ends = ("p", name) if name in ITEMS else ("p",)
        for back in range(len(self.open) - 1, -1, -1):
            inner = self.open[back].name
            if inner in ends:
                del self.open[back:]
                return
            if inner in WALLS:
                return

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._break()
        for back in range(len(self.open) - 1, -1, -1):
            if self.open[back].name == name:
                if self.open[back].noise and not (back and self.open[back - 1].noise):
                    self._break()
                del self.open[back:]
                return


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page, its blocks joined by one space; empty if there is none."""
    lines = _Lines(page)
    noise, scopes = np.array(lines.noise, dtype=bool), np.array(lines.scopes)
    if noise.all():
        return ""
    weights = np.array(lines.weights)
    if not weights.any():
        weights = np.where(noise, 0, [len(text) for text in lines.texts])
    # The sum of the window that begins at each line, shorter at the end.
    sums = np.convolve(weights, np.ones(window, dtype=int))[window - 1 :]
    high = sums >= min(surge, sums.max())
    # Runs of high sums; the last window of a run reaches ``window - 1`` lines further.
    edges = np.flatnonzero(np.diff(np.r_[False, high, False].astype(int)))
    ends = np.minimum(edges[1::2] + window - 1, len(weights))
    runs, best, held, own = [], -1, scopes[:0], weights[:0]
    for a, b in zip(edges[::2].tolist(), ends.tolist()):
        # Windows that begin before the text have a surge point at its first line with weight.
        within = np.flatnonzero(weights[a:b])
        total = int(weights[a:b].sum())
        if not len(within):
            continue
        a, b = a + int(within[0]), a + int(within[-1]) + 1
        runs.append((a, b))
        if total > best:
            best, held, own = total, scopes[a:b], weights[a:b]
    keep = np.zeros(len(noise), dtype=bool)
    if (held >= 0).any():
        scope = int(np.bincount(held[held >= 0], own[held >= 0]).argmax())
        kind = lines.scopes_at[scope]
        beside = [n for n, at in enumerate(lines.scopes_at) if kind[0] == "article" and at == kind]
        keep = np.isin(scopes, [scope, *beside])
    else:
        # An element that holds lines of two runs holds all lines between these.
        before: dict[int, int] = {}
        for a, b in runs:
            keep[a:b] = True
            around = {element for at in range(a, b) if not noise[at] for element in lines.blocks[at]}
            first = min((before[element] for element in around if element in before), default=a)
            keep[first:a] = True
            before.update(dict.fromkeys(around - before.keys(), a))
        keep &= ~noise
    return " ".join(lines.texts[n] for n in np.flatnonzero(keep).tolist())


def extract(
    df: DataFrame, page: str = "html", out: str = "text", window: int = WINDOW, surge: int = SURGE
) -> DataFrame:
    """All columns of ``df`` and the page's main text, which replaces a column named ``out``.

    Character references are decoded and blanks inside a block become one space. A null or empty
    page, or one without text, gives the empty text; nothing is cut off. Pages are independent:
    repeated rows stay, an empty table gives an empty result.
    """
    df = df.drop(out)
    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(value.as_py() or "", window, surge) for value in batch.column(page)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type=pa.string())],
                names=[*batch.schema.names, out],
            )

    return df.mapInArrow(run, schema)
