from __future__ import annotations

import numpy as np
import pytest

from marginalia.llm import pages
from marginalia.llm.page_labels import labelled_pages

PAGE = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def tree(spark):
    return pages.fit_tree(spark)


def test_blocks_match_the_labelled_table():
    for html, labels in labelled_pages(60, 3):
        assert len(pages.blocks_of(html)) == len(labels)


def test_held_out_accuracy(tree):
    right = total = 0
    for html, labels in labelled_pages(300, 1234):
        found = tree.predict(pages.features_of(pages.blocks_of(html))) > 0.5
        right, total = right + (found == np.array(labels, bool)).sum(), total + len(labels)
    assert total > 5000 and right / total > 0.99


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        (" \n\t", ""),
        ("<!-- never ends <p>x</p>", ""),
        ("<script>var a = '<p>no</p>'; <p>still a script", ""),
        ("<article>a < b &amp; c&nbsp;&#100;&copy <p>x</p></article>", "a < b & c d©\nx"),
        ("<ARTICLE CLASS=x><P>One <B>t</B>wo<BR>three\n\n four<P>five</ARTICLE>", "One two three four\nfive"),
        ('<article><p title="a > b">in</p><p title=it\'s>out</p></article>', "in\nout"),
        ("<article><h1>T</h1><p>p<section class='comments'><p>said</section><p>q</article><p>after", "T\np\nq"),
        ("<nav><a href=x>Home</a></nav><main><p>Short.</p><div class=ad>Buy this now</div></main><footer>c</footer>", "Short."),
        ("<article><p>kept <a href=y>linked words here</a></p><form><p>Name</p><input></form></article>", "kept linked words here"),
        ("<article><p>a<div id='cookie-notice'>We use cookies</div><p>b</article><aside><p>s</aside>", "a\nb"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ],
)
def test_main_text(tree, html, text):
    assert pages.main_text(html, tree) == text


def test_long_page(tree):
    paragraph = "word " * 200
    html = "<nav><a>x</a></nav><article>" + f"<p>{paragraph}</p>" * 4000 + "</article>"
    assert len(html) > 3 << 20
    assert pages.main_text(html, tree) == "\n".join([paragraph.strip()] * 4000)


def test_links_by_density_without_names(tree):
    long = "This paragraph holds quite a few words and sentences, as an article does, and not a single link to anywhere."
    links = "".join(f"<div><a href={i}>Item {i}</a></div>" for i in range(5))
    assert pages.main_text(f"<div>{links}</div><div><p>{long}</p><p>{long}</p></div>", tree) == f"{long}\n{long}"


def test_table_of_pages(spark, tree):
    rows = [(1, "u", "<article>x</article>"), (1, "u", "<article>x</article>"), (None, None, None), (2, "v", "")]
    out = pages.extract(spark.createDataFrame(rows, PAGE).selectExpr("*", "1 AS text", "2 AS n_chars"), tree)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "u", "x"), (1, "u", "x"), (None, None, ""), (2, "v", "")], key=str)
    assert pages.extract(spark.createDataFrame([], PAGE), tree).count() == 0
