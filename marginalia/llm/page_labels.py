"""A small labelled table of web-page blocks, made from layout rules.

Pages are built in several layouts (semantic elements, plain containers with class names, tables of
bare ``div`` elements, articles with notices, adverts, forms and reader comments inside), each with
texts of different lengths. Every block carries its label, so that a classifier can be fitted
without a labelled corpus. The rows depend on ``seed`` and ``pages`` alone.
"""

from __future__ import annotations

import random
from html import escape

SYLLABLES = "an be co da el fi go hu in jo ka lo mi no or pa qui re so ta un ve wo xi ye zu".split()

# Common class names of parts that are not the article, and of those that are.
CLUTTER = {
    "nav": ["menu", "nav", "navbar", "breadcrumb", "main-menu"],
    "header": ["header", "site-header", "masthead", "banner"],
    "footer": ["footer", "site-footer", "copyright", "page-footer"],
    "aside": ["sidebar", "related", "widget", "side-bar"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "advertisement"],
    "notice": ["cookie-notice", "cookie", "consent", "notice", "alert", "gdpr-banner"],
    "comments": ["comments", "comment", "reader-comments", "comment-list", "replies"],
    "form": ["form", "search", "newsletter", "login", "subscribe"],
}
CONTENT = ["content", "article", "article-body", "post", "entry-content", "story", "main", "post-content"]


class Maker:
    """Writes one page and remembers its blocks' labels."""

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.labels = rng, [], []

    def words(self, least: int, most: int) -> str:
        rng = self.rng
        found = ("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most)))
        return " ".join(found).capitalize()

    def block(self, tag: str, text: str, label: int, raw: bool = False) -> None:
        self.parts.append(f"<{tag}>{text if raw else escape(text)}</{tag.split()[0]}>")
        self.labels.append(label)

    def links(self, tag: str, least: int, most: int, label: int = 0) -> None:
        for _ in range(self.rng.randint(least, most)):
            self.block(tag, f'<a href="/x">{self.words(1, 4)}</a>', label, raw=True)

    def prose(self, length: int, named: bool = False) -> None:
        """Blocks of an article; in a named one whole paragraphs may be links."""
        rng = self.rng
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if named and rng.random() < 0.08:
                self.links("p", 1, 2, 1)
            elif kind < 0.12:
                self.block(rng.choice(["h2", "h3"]), self.words(1, 7), 1)
            elif kind < 0.2:
                for _ in range(rng.randint(1, 4)):
                    self.block("li", self.words(1, 20), 1)
            elif kind < 0.27:
                self.block("blockquote", self.words(2, 40), 1)
            elif kind < 0.4:
                inside = f'{self.words(1, length)} <a href="/y">{self.words(1, 5)}</a> {self.words(1, length)}.'
                self.block("p", inside, 1, raw=True)
            else:
                self.block("p", self.words(1, length) + ".", 1)

    def clutter(self, kind: str, semantic: bool) -> None:
        rng = self.rng
        name = rng.choice(CLUTTER[kind])
        native = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
        if semantic and kind in native:
            opened, closed = f"<{native[kind]}>", f"</{native[kind]}>"
        else:
            tag = "section" if kind == "comments" and rng.random() < 0.5 else "div"
            opened, closed = f'<{tag} {rng.choice(["class", "id"])}="{name}">', f"</{tag}>"
        self.parts.append(opened)
        if kind == "nav":
            self.parts.append("<ul>")
            self.links("li", 2, 8)
            self.parts.append("</ul>")
        elif kind == "aside":
            if rng.random() < 0.6:
                self.block("h3", self.words(1, 3), 0)
            self.links("li", 1, 6)
            if rng.random() < 0.5:
                self.block("p", self.words(5, 40), 0)
        elif kind == "comments":
            for _ in range(rng.randint(1, 5)):
                self.block("p", self.words(1, 60), 0)
        elif kind == "form":
            self.block("label", self.words(1, 4), 0)
            self.block("p", self.words(2, 15), 0)
            self.block("button", self.words(1, 2), 0)
        elif kind == "header":
            self.block("h1", self.words(1, 4), 0)
            self.block("p", self.words(1, 10), 0)
        elif rng.random() < 0.7:
            self.block("p", self.words(1, 40), 0)
        else:
            self.links("p", 1, 3)
        self.parts.append(closed)

    def unnamed(self, least: int, most: int) -> None:
        """Text or links that no name tells from an article."""
        rng = self.rng
        self.parts.append(rng.choice(["<div>", '<div class="box">', '<div id="c4">', "<section>"]))
        tag = self.parts[-1][1:].split()[0].rstrip(">")
        if rng.random() < 0.6:
            self.links(rng.choice(["li", "p", "td"]), 1, 6)
        else:
            self.block(rng.choice(["p", "div"]), self.words(least, most), 0)
        self.parts.append(f"</{tag}>")

    def article(self, layout: str, length: int) -> None:
        rng = self.rng
        if layout == "semantic":
            opened, closed = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>")])
        elif layout == "classes":
            opened, closed = f'<div class="{rng.choice(CONTENT)}">', "</div>"
        else:
            opened, closed = "<div>", "</div>"
        self.parts.append(opened)
        if layout == "semantic" and rng.random() < 0.3:
            self.parts.append("<header>")
            self.block("h1", self.words(2, 10), 1)
            self.parts.append("</header>")
        elif rng.random() < 0.8:
            self.block("h1", self.words(2, 10), 1)
        self.prose(length, layout != "bare")
        if layout != "bare":
            for kind in ("ad", "notice", "form", "aside", "comments", "nav", "footer"):
                if rng.random() < 0.2:
                    self.clutter(kind, layout == "semantic")
                    if kind in ("ad", "notice"):
                        self.prose(length, True)
        self.parts.append(closed)


def labelled_pages(pages: int, seed: int) -> list[tuple[str, list[int]]]:
    """(html, label of each block in page order) of ``pages`` pages."""
    out = []
    for number in range(pages):
        rng = random.Random(seed * 1_000_003 + number)
        maker = Maker(rng)
        layout = rng.choice(["semantic", "semantic", "classes", "classes", "bare"])
        maker.parts.append("<html><head><title>x</title></head><body>")
        for kind in ("notice", "header", "nav", "ad", "aside"):
            if rng.random() < 0.6:
                maker.clutter(kind, layout == "semantic")
        # In bare layouts nothing but words and links tells the blocks: there other text is short.
        longest = 8 if layout == "bare" else 60
        for _ in range(rng.choice([0, 0, 1, 2])):
            maker.unnamed(1, longest)
        maker.article(layout, rng.choice([30, 60, 120]) if layout == "bare" else rng.choice([4, 15, 60, 120]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            maker.unnamed(1, longest)
        for kind in ("comments", "aside", "form", "ad", "footer"):
            if rng.random() < 0.6:
                maker.clutter(kind, layout == "semantic")
        maker.parts.append("</body></html>")
        out.append(("".join(maker.parts), maker.labels))
    return out
