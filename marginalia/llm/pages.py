"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at every block-level tag. A block is described by its words and link
density, by those of the blocks before and behind it, and by where it lies: the nearest element
around it that names a part of a page, by its tag, role, class or id. A decision tree fitted on a
small labelled table (``page_labels``; its size is a parameter) tells article blocks from others.
The tree goes to the tasks as flat arrays, bounded by its depth; pages are read where they lie,
one at a time, so nothing is shuffled.

In a kept block character references are decoded, white space becomes one space and the ends are
trimmed; blocks without text vanish; the others are joined by line feeds in page order.

Defined cases: null, empty and text-free pages have empty text; markup that never ends (comments,
scripts, tags) runs to the end of the page; unclosed elements end with what holds them; a stray
``<`` is text; equal rows give equal rows, and null ids are kept; pages may have any length; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.page_labels import labelled_pages
from marginalia.llm.text import steps

# Pages of the labelled table, its seed, and the greatest depth of the tree.
LABELLED_PAGES, SEED, DEPTH = 400, 7, 10

# Elements whose content is no text, inline elements, elements without content.
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object", "select", "noembed", "noframes", "xmp"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "nobr", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements, and words in class, id or role, that name parts of a page.
ARTICLE_TAGS = {"article", "main"}
CLUTTER_TAGS = {"nav", "header", "footer", "aside", "form", "dialog", "button", "menu", "fieldset", "label"}
ARTICLE_NAMES = {"article", "content", "post", "entry", "story", "main", "body", "text"}
CLUTTER_NAMES = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer",
    "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notification", "overlay", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "search",
    "share", "sharing", "side", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "toc", "toolbar",
    "warning", "widget",
}

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|[^<]++|<",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

FEATURES = ["words", "links", "words_before", "links_before", "words_behind", "links_behind", "article", "clutter", "heading"]
# How much of a page's words lies inside article parts decides what a block outside of them is.
FEATURES += ["page_article"]


def _part(name: str, rest: str) -> int:
    """1 if an element names an article, -1 if another part of a page, else 0."""
    words = set()
    if "=" in rest:
        for found in NAMED.findall(rest):
            words.update(WORD.findall("".join(found).lower()))
    if name in CLUTTER_TAGS or words & CLUTTER_NAMES:
        # An article stays one whatever else its names say, unless they are all of the other kind.
        return 1 if name in ARTICLE_TAGS else -1
    return int(name in ARTICLE_TAGS or bool(words & ARTICLE_NAMES))


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    clutter: bool
    heading: bool


def blocks_of(html: str) -> list[Block]:
    """The flat text blocks of a page, in page order, without those that hold no text."""
    out: list[Block] = []
    # Open elements that matter: name, part of the page, and what was open around the part.
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    linked_pieces: list[str] = []
    heading = False

    def end() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                words = text.count(" ") + 1
                linked = len(unescape(" ".join(linked_pieces)).split())
                parts = [part for _, part in stack if part]
                article = 1 in parts
                nearest = parts[-1] if parts else 0
                # A heading in the header of an article is the article's.
                if nearest < 0 and heading and stack and article and _headed(stack):
                    nearest = 1
                out.append(Block(text, words, min(linked, words), article, nearest < 0, heading))
            pieces.clear()
            linked_pieces.clear()

    position, size = 0, len(html)
    while position < size:
        match = TOKEN.match(html, position)
        position = match.end()
        name = match["name"]
        if name is None:
            text = match[0]
            if text[0] != "<" or text == "<":
                pieces.append(text)
                if any(opened == "a" for opened, _ in stack):
                    linked_pieces.append(text)
            continue
        name = name.lower()
        if name in RAW:
            if not match["close"] and not match["rest"].endswith("/"):
                found = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(html, position)
                position = found.end() if found else size
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in INLINE:
            end()
            heading = name in HEADINGS and not match["close"]
        elif name != "a":
            continue
        if name in EMPTY:
            continue
        if match["close"]:
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == name:
                    del stack[place:]
                    break
        elif name == "a":
            if not any(opened == "a" for opened, _ in stack):
                stack.append((name, 0))
        else:
            if name in HEADINGS or name in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
                # These are closed by what follows; only their links end with them.
                while stack and stack[-1][0] == "a":
                    stack.pop()
                part = _part("", match["rest"])
                if not part:
                    continue
                if name in ("p", "li") and stack and stack[-1][0] == name:
                    stack.pop()
                stack.append((name, part))
            else:
                # A paragraph ends where another block begins.
                while stack and stack[-1][0] in ("p", "a"):
                    stack.pop()
                stack.append((name, _part(name, match["rest"])))
    end()
    return out


def _headed(stack: list[tuple[str, int]]) -> bool:
    """Whether the nearest part is a plain header whose own holder is an article."""
    parts = [item for item in stack if item[1]]
    return len(parts) > 1 and parts[-1][0] == "header" and parts[-2][1] > 0


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block."""
    rows = np.zeros((len(blocks) + 2, len(FEATURES)))
    for number, block in enumerate(blocks, 1):
        rows[number, :2] = block.words, block.linked / block.words
        rows[number, 6:9] = block.article, block.clutter, block.heading
    rows[1:-1, 2:4], rows[1:-1, 4:6] = rows[:-2, :2], rows[2:, :2]
    held = sum(block.words for block in blocks if block.article and not block.clutter)
    rows[:, 9] = held > 0
    return rows[1:-1]


@dataclass
class Tree:
    """A fitted tree as arrays: a row with a feature above the bound goes to the second child."""

    feature: np.ndarray
    bound: np.ndarray
    children: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        every = np.arange(len(rows))
        for _ in range(self.depth):
            up = rows[every, self.feature[at]] > self.bound[at]
            at = self.children[at, up.astype(np.int64)]
        return self.value[at]


def fit_tree(spark: SparkSession, pages: int = LABELLED_PAGES, seed: int = SEED, depth: int = DEPTH) -> Tree:
    """The decision tree fitted on the blocks of the ``pages`` labelled pages."""
    rows = []
    for html, labels in labelled_pages(pages, seed):
        described = features_of(blocks_of(html))
        rows += [(values.tolist(), float(label)) for values, label in zip(described, labels, strict=True)]
    table = spark.createDataFrame(rows, "features array<double>, label double")
    table = table.withColumn("features", array_to_vector("features")).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=3, seed=seed).fit(table)
    nodes: list[list] = []

    def walk(node) -> int:
        number = len(nodes)
        nodes.append([0, np.inf, number, number, node.prediction()])
        # Leaves lead to themselves.
        if node.subtreeDepth():
            split = node.split()
            nodes[number][:2] = split.featureIndex(), split.threshold()
            nodes[number][2] = walk(node.leftChild())
            nodes[number][3] = walk(node.rightChild())
        return number

    walk(model._java_obj.rootNode())
    columns = list(zip(*nodes, strict=True))
    return Tree(
        np.array(columns[0], np.int64), np.array(columns[1], float), np.array(columns[2:4], np.int64).T.copy(), np.array(columns[4]), model.depth
    )


def main_text(html: str | None, tree: Tree) -> str:
    """The article of a page."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    kept = tree.predict(features_of(blocks)) > 0.5
    return "\n".join(block.text for block, keep in zip(blocks, kept, strict=True) if keep)


def extract(
    pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(``page_id``, ``url``, ``text``) of each page; ``tree`` is fitted if not given."""
    tree = tree or fit_tree(pages.sparkSession)
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "html"):
                texts = pa.array([main_text(html, tree) for html in part.column("html").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], ["page_id", "url", "text"])

    return source.mapInArrow(scan, "page_id long, url string, text string")
