"""The main text of web pages, from flat text blocks and a decision tree, in Arrow batches.

Method. A page becomes a flat list of text blocks: block-level tags separate them, inline tags do not.
Each block is described by its word count and its share of linked words, by those of the block before
and the one after, and by what its markup says: heading, list entry, innermost region (main
text, or navigation, notice, advert and the like), reader comments. A decision tree, trained on the
labelled pages of ``page_labels``, decides for each block. The blocks that it keeps, in
page order, joined by one space, are the main text.

Text: character references decoded, white space (also no-break spaces and line breaks) inside a block turned
into one space, both ends trimmed. Scripts, styles, templates, embedded media, comments, the
document's head and the contents of form controls are no text. Nothing else is dropped or cut.

Nothing is shuffled; each page is on its own. The tree is trained on the driver from the labelled
pages alone, a few hundred blocks whatever the corpus, and travels with the tasks.

Edge cases: null or empty html, and pages without a main block, give an empty text. Tags that stay
open, close twice or are cut off by the end of the page are read as browsers do: they reach as far as
they can, and a tag cut off is dropped. Pages may have any length; repeated rows are read
again. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import functools
import html
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm import page_labels
from stayscope.llm.common import map_text, ship

# Names of HTML elements.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul optgroup option select label button""".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Closed by the start of another of the same kind, or, for p, of any block.
SELF_CLOSING = frozenset("li dd dt tr td th option".split())
#: Elements whose contents are no text.
SILENT = frozenset(
    """script style noscript template title textarea select iframe object svg math canvas video audio button
    noframes applet map datalist""".split()
)
MAIN_TAGS = frozenset("article main".split())
SIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset label".split())
MAIN_ROLES = frozenset("main article".split())
SIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split()
)
#: Whole words of class and id attributes.
MAIN_WORDS = re.compile(r"article|content|post|entry|story|main|body|text|prose|read(able|er)?")
SIDE_WORDS = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|nav|navbar|navigation|menus?|breadcrumbs?|crumbs?|header|masthead|"
    r"topbar|footer|foot|bottom|colophon|copyright|legal|sidebars?|side|aside|widgets?|rail|cookies?|consent|gdpr|"
    r"notices?|banners?|popups?|modals?|overlay|alerts?|toast|newsletter|subscri\w*|signup|login|register|"
    r"paywall|forms?|search|social|shar(e|ing)|follow|related|recommend\w*|trending|popular|teasers?|more|"
    r"tags?|pagination|pager|toc|byline|meta|skip|toolbar|disclaimer|donate|comments?|disqus|responses?|replies"
)
COMMENT_WORDS = re.compile(r"comments?|disqus|responses?|replies|commentlist")
#: Phrases, in lower case, that say what a block is.
CUES = (
    "©", "(c) 19", "(c) 20", "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service",
    "subscribe", "sign up", "log in", "newsletter", "advertisement", "sponsored", "share this", "follow us",
    "read more", "related articles", "related stories", "related posts", "leave a comment", "leave a reply",
    "powered by", "skip to",
)
FEATURES = """words words_before words_after links links_before links_after in_main in_side in_comments
    around_main heading entry cue""".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)",
    re.IGNORECASE,
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[A-Za-z]+")

MAIN, SIDE, COMMENTS = 1, 2, 4


#: Regions of tags met before; sites repeat their tags on every page.
_KNOWN: dict[tuple[str, str], int] = {}


def _region(name: str, attributes: str) -> int:
    """What a tag says about the text inside it, 0 for nothing."""
    key = name, attributes
    if key not in _KNOWN:
        if len(_KNOWN) >= 4096:
            _KNOWN.clear()
        _KNOWN[key] = _new_region(name, attributes)
    return _KNOWN[key]


def _new_region(name: str, attributes: str) -> int:
    words, roles, hidden = [], [], False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            words += _WORD.findall(_CAMEL.sub(" ", value))
        elif key == "role":
            roles += value.lower().split()
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            hidden = True
    lower = [w.lower() for w in words]
    if any(COMMENT_WORDS.fullmatch(w) for w in lower):
        return COMMENTS
    if hidden or name in SIDE_TAGS or any(r in SIDE_ROLES for r in roles) or any(
        SIDE_WORDS.fullmatch(w) for w in lower
    ):
        return SIDE
    if name in MAIN_TAGS or any(r in MAIN_ROLES for r in roles) or any(MAIN_WORDS.fullmatch(w) for w in lower):
        return MAIN
    return 0


class Page:
    """Text blocks of one page and what is known of each."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.rows: list[tuple] = []
        self._parts: list[str] = []
        self._linked = 0
        #: Open block elements: name, innermost region, whether comments and whether main text enclose it.
        self._open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self._anchor = False
        self._read(source)
        self._flush()

    def _text(self, raw: str) -> None:
        if raw:
            decoded = html.unescape(raw) if "&" in raw else raw
            self._parts.append(decoded)
            if self._anchor:
                self._linked += len(decoded.split())

    def _flush(self) -> None:
        words = "".join(self._parts).split()
        if words:
            text = " ".join(words)
            lower = text.lower()
            names = [x[0] for x in self._open[-3:]]
            _, region, comments, main = self._open[-1]
            self.texts.append(text)
            self.rows.append(
                (
                    len(words),
                    min(1.0, self._linked / len(words)),
                    region,
                    comments,
                    main,
                    any(n in HEADINGS for n in names),
                    any(n in ("li", "dd", "dt", "td", "th") for n in names),
                    any(cue in lower for cue in CUES),
                )
            )
        self._parts, self._linked = [], 0

    def _start(self, name: str, attributes: str) -> None:
        self._flush()
        if self._open[-1][0] == "p" or name in SELF_CLOSING and self._open[-1][0] == name:
            self._open.pop()
        if name in EMPTY:
            return
        _, region, comments, main = self._open[-1]
        own = _region(name, attributes)
        self._open.append((name, own or region, comments or own == COMMENTS, main or own == MAIN))

    def _end(self, name: str) -> None:
        self._flush()
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == name:
                del self._open[i:]
                return

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        lower = None
        while at < size:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            self._text(source[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
            if name in SILENT and not closing:
                if lower is None:
                    lower = source.lower() if len(source.lower()) == size else source
                end = lower.find("</" + name, at)
                if end >= 0:
                    at = lower.find(">", end)
                    at = size if at < 0 else at + 1
                elif name in ("script", "style", "title", "textarea"):
                    at = size
            elif name == "a":
                self._anchor = not closing
            elif name == "br":
                self._parts.append("\n")
            elif name in BLOCK:
                if closing:
                    self._end(name)
                else:
                    self._start(name, attributes)

    def features(self) -> np.ndarray:
        """One row of ``FEATURES`` per block."""
        n = len(self.rows)
        out = np.zeros((n, len(FEATURES)))
        if not n:
            return out
        words, links, region, comments, main, heading, entry, cue = (np.array(x, dtype=float) for x in zip(*self.rows))
        for column, values in ((0, words), (3, links)):
            out[:, column] = values
            out[1:, column + 1] = values[:-1]
            out[:-1, column + 2] = values[1:]
        out[:, 6], out[:, 7] = region == MAIN, (region == SIDE) | (region == COMMENTS)
        out[:, 8], out[:, 9] = comments, main
        out[:, 10], out[:, 11], out[:, 12] = heading, entry, cue
        return out


class Tree:
    """A binary decision tree by Gini impurity; ties go to the first feature and the lowest threshold."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8, leaf: int = 2):
        self.feature, self.threshold, self.child, self.value = [], [], [], []
        self._grow(rows, labels.astype(float), depth, leaf)
        self.feature, self.threshold, self.child, self.value = map(
            np.array, (self.feature, self.threshold, self.child, self.value)
        )

    def _grow(self, rows: np.ndarray, labels: np.ndarray, depth: int, leaf: int) -> int:
        at = len(self.feature)
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.child.append((at, at))
        self.value.append(labels.mean() > 0.5)
        split = self._split(rows, labels, leaf) if depth and 0 < labels.mean() < 1 else None
        if split:
            feature, threshold = split
            below = rows[:, feature] <= threshold
            self.feature[at], self.threshold[at] = feature, threshold
            left = self._grow(rows[below], labels[below], depth - 1, leaf)
            self.child[at] = (left, self._grow(rows[~below], labels[~below], depth - 1, leaf))
        return at

    @staticmethod
    def _split(rows: np.ndarray, labels: np.ndarray, leaf: int) -> tuple[int, float] | None:
        n, best, found = len(labels), 1e-9, None
        impure = n * labels.mean() * (1 - labels.mean())
        for feature in range(rows.shape[1]):
            order = np.argsort(rows[:, feature], kind="stable")
            x, y = rows[order, feature], labels[order]
            left = np.arange(1, n)
            ones = np.cumsum(y)[:-1]
            right, rest = n - left, y.sum() - ones
            gain = impure - ones * (1 - ones / left) - rest * (1 - rest / right)
            gain[(x[1:] == x[:-1]) | (left < leaf) | (right < leaf)] = 0
            if len(gain) and gain.max() > best + 1e-9:
                best, i = gain.max(), int(gain.argmax())
                found = feature, (x[i] + x[i + 1]) / 2
        return found

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        every = np.arange(len(rows))
        while (inner := self.feature[at] >= 0).any():
            i, node = every[inner], at[inner]
            right = rows[i, self.feature[node]] > self.threshold[node]
            at[i] = self.child[node, right.astype(int)]
        return self.value[at].astype(bool)


def labelled_blocks(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    rows, labels = [], []
    for page in pages:
        parsed = Page(page)
        rows.append(parsed.features())
        labels += [page_labels.MARK in t for t in parsed.texts]
    return np.concatenate(rows), np.array(labels)


@functools.cache
def trained() -> Tree:
    """The tree of all labelled pages."""
    return Tree(*labelled_blocks(page_labels.table()))


def main_texts(sources: list[str], tree: Tree) -> list[str]:
    """The main text of each page."""
    pages = [Page(s) for s in sources]
    rows = np.concatenate([np.zeros((0, len(FEATURES))), *(p.features() for p in pages)])
    kept, at, out = tree.predict(rows), 0, []
    for p in pages:
        n = len(p.texts)
        out.append(" ".join(t for t, k in zip(p.texts, kept[at : at + n]) if k))
        at += n
    return out


def extract(pages: DataFrame, html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """``pages`` without the html, plus ``text`` and ``n_chars``, which replace columns of those names."""
    used = tree or trained()
    found = map_text(pages, html_col, [("text", "string")], lambda: lambda x: [main_texts(x, used)], keep_text=False)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


ship(__name__)
ship(page_labels.__name__)
