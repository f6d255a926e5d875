"""Tree shape and text on well-formed and broken markup."""

import random

import pyarrow as pa
import pytest

from campusweave.functions.page_tree import PageTree
from campusweave.operators import html as H


def shape(html):
    return [(e[3], e[0], e[1]) for e in PageTree(html).elements]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<div><p>a</p><br>b</div>", [("div", -1, 2), ("p", 0, 1), ("br", 0, 2)]),
        # an open paragraph keeps holding what follows until an ancestor closes
        ("<div><p><b>a<p>c</p></div><i>d</i>", [("div", -1, 3), ("p", 0, 3), ("b", 1, 3), ("p", 2, 3), ("i", -1, 4)]),
        # a stray end tag changes nothing
        ("<div>a</p></span>b</div>", [("div", -1, 0)]),
        # cells that are not closed nest
        ("<tr><td>1<td>2</tr>", [("tr", -1, 2), ("td", 0, 2), ("td", 1, 2)]),
        ("<div/><p>x</p>", [("div", -1, 0), ("p", -1, 1)]),
        ("<br></br><p>x</p>", [("br", -1, 0), ("p", -1, 1)]),
    ],
)
def test_shape(html, expected):
    assert shape(html) == expected


@pytest.mark.parametrize(
    "html, texts",
    [
        ("<p>a &amp; b&nbsp;c &copy; &#8377; &#x41;&#150;</p>", ["a & b\xa0c © ₹ A–"]),
        ("<p>a<!-- x -->b</p>", ["a", "b"]),
        ("<script>var t='</p>';</script><style>p{}</style><p>x</p>", ["x"]),
        ("<template><b>hidden</b></template>x<![CDATA[y]]>", ["x", "y"]),
        ("<p>  \n </p><pre> \n </pre>", ["\n", " \n "]),
        ("a &unknown; b", ["a &unknown b"]),
        ("", []),
    ],
)
def test_texts(html, texts):
    assert PageTree(html).texts == texts


def test_extent_of_text():
    tree = PageTree("<div>a<b>b</b>c</div>d")
    assert [(e[3], e[5], e[6]) for e in tree.elements] == [("div", 0, 3), ("b", 1, 2)]
    assert tree.text_parents == [0, 1, 0, -1]


def test_classes_are_joined_with_one_space():
    assert PageTree("<p class=' a \n b '>x</p>").elements[0][4]["class"] == "a b"


PIECES = [
    "<p>", "</p>", '<div class="a  b">', "</div>", "<br>", "<br/>", "<br />", '<a href="/x" title="q>r<s">', "</a>", "text ", " ", "\n", "&amp;", "&nope;", "&lt", "&#65;", "& ", "<", ">", "<!-- c -->",
    '<script>var a = "<b>";</script>', '<script type="x">{"a":1 & 2}</script>', "<script>", "</script>", "<STYLE>b</STYLE>", "<title>T</title>", "<title></title>", "<title>T &amp; <b>x</title>", "<textarea>",
    "</textarea>", "<template>", "</template>", '<IMG SRC="a">', "</br>", "<img src=a>", "<pre> \n", "</pre>", "<![CDATA[x]]>", '<td A="x" a="y">', "é🙂", "<p é>", "</>", "<rt>",
]


def test_plain_markup_gives_what_the_library_gives(monkeypatch):
    """Markup read by one search for each piece, up to the first piece that is not plain, has the tree of the library's events."""
    rng = random.Random(1)
    pages = ["".join(rng.choices(PIECES, k=rng.randint(1, 12))) for _ in range(5_000)]
    shape = lambda tree: (tree.elements, tree.texts, tree.text_parents)
    found = [shape(PageTree(page)) for page in pages]
    monkeypatch.setattr(PageTree, "_plain", lambda self, markup: 0)
    assert found == [shape(PageTree(page)) for page in pages]


def test_plain_markup_is_not_searched_again(monkeypatch):
    fed = []
    monkeypatch.setattr(PageTree, "feed", lambda self, markup: fed.append(markup))
    tree = PageTree('<title>A</title><script>a < b</script><p class="x">b &amp; c<br/></p>')
    assert [e[3] for e in tree.elements] == ["title", "script", "p", "br"] and tree.texts == ["A", "b & c"] and not fed
    PageTree("<p>a</p><!-- c --><p>")
    assert fed == ["<!-- c --><p>"]


def test_trees_are_handed_on_in_small_batches(page, monkeypatch):
    """A worker holds the trees of some thousand elements, not of a whole batch of pages."""
    steps, html = [], "<p>" * 1_000
    frame = page(html)
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, parse, schema: steps.append(parse))
    H.with_tree(frame)
    batch = pa.RecordBatch.from_pydict({"college_id": ["1"] * 100, "slug": ["a"] * 100, "page_type": ["info"] * 100, "url": ["u"] * 100, "html": [html] * 100})
    sizes = [b.num_rows for b in steps[0](iter([batch]))]
    assert sum(sizes) == 100 and max(sizes) <= 10
