"""Main text of pages: what the driver's pages must yield, block rules, and rows of every kind."""

import time

import pytest

from campusweave.llm import main_text
from campusweave.llm.main_text import BAD, GOOD, MENU, UNSURE, Block

LONG = "This is a paragraph of the article and it has all the words that are common in a text of this kind."
OTHER = "We went to the market with our friends and there was not much that we could have for so little."
PAGES = "page_id long, url string, html string, text string, n_chars int, label string, section string"


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame([(*r, "t", 1, "l", "s") for r in rows], PAGES)


def text(html):
    return "\n".join(b.text for b in main_text.blocks_of(html) if b.label == GOOD)


@pytest.mark.parametrize("noise", [
    "<nav><ul><li><a href=x>Home</a></li></ul></nav>", "<header><p>%s</p></header>", "<footer>&copy; %s</footer>", "<aside><p>%s</p></aside>",
    "<form action=x><label>Name</label><input name=n><button>Send</button><p>%s</p></form>", "<script>var t='</p>%s';</script>", "<style>p{}</style>",
    "<div class='cookie-notice'>%s</div>", "<div class=ad>%s</div>", "<section id='comments'><article class='comment'><p>%s</p></article></section>", "<div role=navigation>%s</div>",
    "<!-- %s -->", "<div class='sideBar right'><p>%s</p></div>", "<div hidden>%s</div>", "<p style='display: none'>%s</p>", "<noscript>%s</noscript>", "<template><p>%s</p></template>",
    "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>", "<iframe>%s</iframe>", "<svg><text>%s</text></svg>", "<select><option>%s</option></select>",
])
@pytest.mark.parametrize("frame", ["<html><body>{}<article><h1>Title</h1><p>%s<p>Short.</article>{}</body></html>" % LONG, "<article><h1>Title</h1>{}<p>%s</p>{}<p>Short.</p></article>" % LONG, "<div>{}<main><h1>Title</h1><div>%s</div><p>Short.{}</main></div>" % LONG])
def test_noise_goes_and_the_article_stays(noise, frame):
    assert text(frame.replace("{}", noise.replace("%s", OTHER))) == f"Title\n{LONG}\nShort."


def test_white_space_references_and_inline_markup():
    html = "<article><p>a&nbsp;&nbsp; b\n\t<b>c</b><i>d</i><br>e &amp; &ampx &lt;p&gt; &#233;&#x1F600; &unknown; AT&T &am</p>tail <a href=x>and link</a> of\r\nthe block</article>"
    assert text(html) == "a b cd e & &x <p> é😀 &unknown; AT&T &am\ntail and link of the block"
    assert text("<article>a < b <![CDATA[kept]]> <p/>x<p/>y") == "a < b kept\nx\ny"


@pytest.mark.parametrize("html", [None, "", " \n", "</p></div>", "<script>x", "<nav>a", "<!-- x -->", "<p> &nbsp; </p>", "<!doctype html><title>x</title>"])
def test_pages_without_text(html):
    assert text(html) == ""


@pytest.mark.parametrize("rest, kept", [("<", "<"), ("<p", ""), ("<!-- x <p>y", ""), ("<a href='x>y", ""), ("&", "&"), ("&am", "&am"), ("&amp", "&"), ("<script>x", ""), ("</p", "")])
def test_pages_that_break_off(rest, kept):
    assert text(f"<article><p>{LONG}{rest}") == LONG + kept


def test_an_article_in_a_form_or_named_box_counts():
    assert text(f"<form><div class='search page'><main><p>{LONG}</p></main></div></form>") == LONG
    assert text(f"<article><header><h1>Title</h1><p>by me</p></header><h2 class=header>Part</h2><p>{LONG}</p></article>") == f"Title\nPart\n{LONG}"
    assert text(f"<body class='has-sidebar'><article><p>{LONG}</p></article></body>") == LONG
    # misnested links and cells
    assert text(f"<article><a href=x><div>one</a></div><p>{LONG}<table><tr><td>1<td>2<tr><td>3</table></article>") == f"one\n{LONG}\n1\n2\n3"


def test_pages_without_sections_go_by_the_rules():
    menu = "<div><a href=a>Products and prices</a> <a href=b>All of the news</a> | <a href=c>Contact</a></div>"
    html = f"<body>{menu}<h1>Title</h1><p>Short.</p><p>{LONG}</p><p>Middling words here</p><p>{OTHER}</p>{menu}<div>Imprint</div>{menu}</body>"
    assert text(html) == f"Title\nShort.\n{LONG}\nMiddling words here\n{OTHER}"
    assert text("<p>Only one short line</p>") == "Only one short line"
    dense = "<p>" + "Lorem ipsum dolor amet consectetur " * 4 + "</p>"
    assert text(f"<div>{dense}</div><p>{LONG}</p>") == LONG


def test_second_pass_against_all_pairs():
    import random

    rng = random.Random(5)
    for _ in range(300):
        rows = [Block(rng.choice(["p", "p", "h2"]), rng.choice([-1, 0, 1]), "x", label=rng.choice([GOOD, BAD, MENU, UNSURE, UNSURE])) for _ in range(rng.randrange(12))]
        want = []
        for i, b in enumerate(rows):
            own = [j for j, c in enumerate(rows) if c.section == b.section]
            near = sorted((abs(own.index(j) - own.index(i)), -rows[j].label) for j in own if rows[j].label in (GOOD, BAD))
            ahead = [(d, l) for d, l in near if b.tag == "h2" and any(rows[j].label == -l and own.index(j) - own.index(i) == d for j in own)]
            near = ahead[:1] or near
            want.append(b.label if b.label != UNSURE else -near[0][1] if near else GOOD)
        main_text.inherited(rows)
        assert [b.label for b in rows] == want


def test_rows_of_every_kind(pages):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (1, "u", f"<article><p>{LONG}</p></article>"), (1, "u", "<p>x</p>"), (None, None, "<p>y</p>"), (2, "u", None), (3, None, "")]
    got = main_text.extracted(pages(*rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "u", LONG, len(LONG))] * 2 + [(1, "u", "x", 1), (None, None, "y", 1), (2, "u", "", 0), (3, None, "", 0)], key=repr)
    assert main_text.extracted(pages(*rows).limit(0)).collect() == [] == main_text.blocks(pages(*rows).limit(0)).collect()
    shown = main_text.blocks(pages(*rows)).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["label"]) for r in shown) == [(0, "y", 1), (1, LONG, 1), (1, LONG, 1), (1, "x", 1)]


def test_long_pages_take_time_in_proportion():
    def seconds(n):
        html = "<div>" + "".join(f"<p class=c{i}>word &amp; {i} <a href=x>l</a>\n" for i in range(n)) + "<div>" * (n // 10)
        start = time.perf_counter()
        assert len(main_text.blocks_of(html)) == n
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(40_000) < 12 * seconds(10_000) + 1
