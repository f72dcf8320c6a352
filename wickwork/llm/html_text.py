"""Main text of web pages: flat text blocks, classified by a decision tree.

A block is the text between two block-level borders. The tree sees its number
of words and its share of words in links, those of the blocks before and after
it, and three marks: whether it stands in a part that is named as something
other than the article, whether it stands in the article element, and whether
it is a heading. It is trained on the small table in ``block_labels``.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wickwork.llm.block_labels import FEATURES, ROWS
from wickwork.llm.common import small_batches

# Elements of HTML by their part in a page.
BLOCK_TAGS = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html iframe legend li main menu "
    "nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead "
    "title tr ul video audio".split()
)
UNSEEN_TAGS = set(
    "script style noscript template head title svg canvas iframe select textarea button".split()
)
VOID_TAGS = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HEAD_TAGS = set(
    "head title base basefont bgsound link meta noframes noscript script style template".split()
)
OTHER_TAGS = set("nav footer aside form menu dialog search".split())
OTHER_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split()
)
# Words in the class or id of a part that is not the article.
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo "
    "promoted promotion banner cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login signin register form search nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar side rail aside widget "
    "widgets related recommended recommendations trending footer foot copyright legal masthead topbar "
    "toolbar share sharing social comment comments commentlist reply replies respond discussion disqus "
    "feedback toc skip hidden".split()
)
# Words that may stand beside one of these in a name of the same meaning, as in "related-posts".
PLAIN_NAMES = set(
    "area bar block box button buttons container icons inner item items link links list post posts section unit "
    "wrap wrapper".split()
)
ARTICLE_NAMES = set("article content post entry story main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NAMED, FIRM = 1, 2
WHITE = re.compile(r"\s+")


class Blocks(HTMLParser):
    """Collects (text, words, words in links, other part, in article, heading)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, bool]] = []
        # Where the open elements of each name stand, and those that border blocks.
        self.places: dict[str, list[int]] = {}
        self.borders: list[int] = []
        self.blocks: list[tuple] = []
        self.text: list[str] = []
        self.linked = 0

    def _state(self) -> tuple[bool, int, bool, bool]:
        """Unseen, other, article, link: each true inside any such element.

        other is NAMED by a name only, which an article or main element inside
        ends, or FIRM by an element or role.
        """
        return self.open[-1][1:] if self.open else (False, 0, False, False)

    def _end_block(self) -> None:
        text = WHITE.sub(" ", "".join(self.text)).strip()
        if text:
            _, other, article, _ = self._state()
            heading = any(tag in HEADINGS for tag, *_ in self.open[-4:])
            self.blocks.append((text, text.count(" ") + 1, self.linked, bool(other), article, heading))
        self.text, self.linked = [], 0

    def _open(self, entry: tuple) -> None:
        self.places.setdefault(entry[0], []).append(len(self.open))
        if entry[0] in BLOCK_TAGS:
            self.borders.append(len(self.open))
        self.open.append(entry)

    def _close(self, at: int) -> None:
        """Closes the element at this depth and all inside it."""
        while len(self.open) > at:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            if tag in BLOCK_TAGS:
                self.borders.pop()

    def _leave_head(self, tag: str) -> None:
        """Drops an open head, whose end tag may be left out, at what cannot stand in it."""
        at = self.places.get("head")
        if not at or (tag != "body" and tag in HEAD_TAGS):
            return
        # What stands in a template or the like is no part of the page yet.
        if tag == "body" or at[0] == len(self.open) - 1:
            self._close(at[0])

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self._end_block()
        self._leave_head(tag)
        # A new paragraph or list item ends an open one.
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th") and self.open and self.open[-1][0] == tag:
            self._close(len(self.open) - 1)
        if tag in VOID_TAGS:
            return
        unseen, other, article, link = self._state()
        values = {k: (v or "").lower() for k, v in attrs}
        tokens = (values.get("class", "") + " " + values.get("id", "")).split()
        parts = [set(re.split(r"[^a-z]+", t)) - {""} for t in tokens]
        names = set().union(*parts)
        hidden = "hidden" in values or values.get("aria-hidden") == "true"
        hidden |= "display:none" in values.get("style", "").replace(" ", "")
        whole = tag in ("html", "body", "main", "article")
        firm = tag in OTHER_TAGS or values.get("role") in OTHER_ROLES or (tag == "header" and not article)
        # Whole names only: "content has-sidebar" holds the article, "related-content" does not.
        holds = set(tokens) & ARTICLE_NAMES
        named = bool(names & OTHER_NAMES) and not holds
        within = article
        if within:
            # Inside an article one word of a name is not enough: "share-price" is a part of it.
            named &= any(p & OTHER_NAMES and p <= OTHER_NAMES | PLAIN_NAMES for p in parts)
        if tag in ("article", "main") and other == NAMED and not named:
            other = 0
        named &= not whole and not (names & {"content", "article"} and article)
        other = max(other, FIRM if firm else NAMED if named else 0)
        article |= tag in ("article", "main") or bool(names & ARTICLE_NAMES and tag in ("div", "section"))
        unseen |= tag in UNSEEN_TAGS or (hidden and not within)
        self._open((tag, unseen, other, article, link or tag == "a"))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self._end_block()

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self._end_block()
        at = self.places.get(tag)
        # An end tag of text markup does not close parts of the page.
        if at and (tag in BLOCK_TAGS or not self.borders or self.borders[-1] < at[-1]):
            self._close(at[-1])

    def handle_data(self, data):
        unseen, _, _, link = self._state()
        if not unseen:
            self.text.append(data)
            if link:
                self.linked += len(data.split())

    def finish(self) -> list[tuple]:
        self.close()
        self._end_block()
        return self.blocks


def block_features(blocks: list[tuple]) -> np.ndarray:
    """A row of FEATURES for each block; beyond the ends of the page all are 0."""
    own = np.array([(w, min(k / w, 1.0)) for _, w, k, *_ in blocks], dtype=np.float64).reshape(-1, 2)
    wide = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    marks = np.array([[float(x) for x in b[3:]] for b in blocks]).reshape(-1, 3)
    return np.hstack([wide[:-2, :1], own[:, :1], wide[2:, :1], wide[:-2, 1:], own[:, 1:], wide[2:, 1:], marks])


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """A decision tree: (feature, cut, at most, more), or the share of main text in a leaf.

    Each split lessens the Gini impurity most, ties to the first feature and
    smallest cut.
    """
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            a, b = y[low], y[~low]
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(cut), low
    if best is None:
        return share
    _, f, cut, low = best
    return f, cut, grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1)


def classify(tree, row) -> float:
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def trained_tree():
    table = np.array(ROWS, dtype=np.float64)
    return grow_tree(table[:, : len(FEATURES)], table[:, -1])


def main_text(html: str | None, tree) -> str:
    parser = Blocks()
    parser.feed(html or "")
    blocks = parser.finish()
    if not blocks:
        return ""
    rows = block_features(blocks)
    return " ".join(b[0] for b, row in zip(blocks, rows, strict=True) if classify(tree, row) >= 0.5)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars), one row for every page, repeated rows and missing
    ids or urls included.

    text is the main blocks in page order, joined by a space; it is empty for a
    missing or empty html and for a page without main blocks. Unclosed and
    misnested markup is read as it comes. Other columns are not read.
    """
    tree = trained_tree()
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))
    out = StructType(
        [rows.schema[0], rows.schema[1], StructField("text", StringType()), StructField("n_chars", LongType())]
    )

    def extracted(batches):
        for batch in small_batches(batches):
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[f.name for f in out],
            )

    return rows.mapInArrow(extracted, out)
