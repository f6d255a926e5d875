"""Listing pages: cards, ranks, metrics, discovery order."""

import pytest
from pyspark.sql import functions as F

from campusweave.operators import frontier as B
from campusweave.operators import html as H
from campusweave.sources.listing import read_listing
from tests.conftest import rows

BASE = "https://campus.example"


@pytest.fixture
def listing(spark):
    def make(*pages):
        return H.with_tree(spark.createDataFrame(list(enumerate(pages, 1)), "page_no long, html string"))

    return make


def table(trees):
    return [tuple(r) for r in B.listing_from_pages(trees).orderBy("ordinal").select("url", "listing_rank").collect()]


def test_rows_go_before_blocks(listing):
    html = '<table><tr class="Table-Row"><td><a href="/college/1-a">A</a></td></tr></table><div class="card"><a href="/college/2-b">B</a></div>'
    assert rows(B.listing_cards(listing(html), ["page_no"]), "url") == [(f"{BASE}/college/1-a",)]
    assert rows(B.listing_cards(listing(html.replace("Table-Row", "x")), ["page_no"]), "url") == [(f"{BASE}/college/2-b",)]


def test_only_the_first_link_of_a_card_counts(listing):
    html = '<div class="card"><a name="x">n</a><a href="/about">x</a><a href="/college/1-a">A</a></div>'
    assert table(listing(html)) == []


def test_discovery_order_and_first_seen(listing):
    one = '<li class="item"><a href="/college/2-b?x=1">B</a></li><li class="item"><a href="/college/1-a#t">A</a></li>'
    two = '<li class="item"><a href="/college/3-c">C</a></li><li class="item"><a href="/college/2-b">B #9</a></li><li class="item"><a href="/college/4-d/reviews">D</a></li>'
    # the second sighting gives no card, but its loose rank fills the empty one
    assert table(listing(one, two)) == [(f"{BASE}/college/2-b", "#9"), (f"{BASE}/college/1-a", ""), (f"{BASE}/college/3-c", "")]


@pytest.mark.parametrize(
    "text, rank",
    [
        ("A NIRF Ranking: 12th", "#12"), ("A Ranked 7", "#7"), ("#07 A", "#7"), ("A", ""), ("x #5 of 9", "#5"), ("A rank 1234", ""),
    ],
)
def test_rank_of_a_card(listing, text, rank):
    html = f'<div class="card"><b>{text}</b><a href="/college/1-a">A</a></div>'
    got = table(listing(html))
    assert got[0][1] == rank


def test_rank_scope_is_five_levels(listing):
    def nested(depth):
        return "<section>" + "<p>" + "<i>" * (depth - 2) + "#3" + "</i>" * (depth - 2) + "</p>" + '<a href="/college/1-a">A</a></section>'

    # the string's own element is the first level, the section has to be within five
    for depth, found in ((2, True), (5, True), (6, False)):
        assert bool(rows(B.associate_ranks(listing(nested(depth)), ["page_no"]), "url")) is found, depth


def test_rank_of_a_link_is_found_one_level_up(listing):
    html = '<p><a href="/college/1-a">#4</a></p>'
    assert rows(B.associate_ranks(listing(html), ["page_no"]), "rank", "url") == [("#4", f"{BASE}/college/1-a")]


def test_metrics(spark):
    texts = ["₹ 4,50,000 Avg. Package", "Average CTC: 6.5 LPA", "Top Salary ₹ 1.2 Cr; 87.5% placed", "placements up to 90 %", "Highest 5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in B.listing_metrics(F.col("t")).items()]).collect()]
    assert got == [("4,50,000", "", ""), ("6.5 LPA", "", ""), ("", "1.2 Cr", "87.5%"), ("", "", "90 %"), ("", "", "")]


def test_growth_keeps_what_is_known(spark):
    known = spark.createDataFrame([("u1", "#1", 0), ("u2", "", 1)], "url string, listing_rank string, ordinal long")
    found = spark.createDataFrame([("u3", "#3", 1), ("u1", "#9", 0), ("u4", "", 2)], "url string, listing_rank string, ordinal long")
    assert [(r["url"], r["listing_rank"]) for r in B.grow_frontier(known, found, 3).collect()] == [("u1", "#1"), ("u2", ""), ("u3", "#3")]


def test_quoted_listing_fields(spark, tmp_path):
    from campusweave.sources.listing import read_listing, write_listing

    path = tmp_path / "listing.csv"
    path.write_text('url,listing_avg_package\n/a,"say ""hi"", 5"\n/b,"two\nlines"\n')
    found = {r["url"]: r["listing_avg_package"] for r in read_listing(spark, str(path)).collect()}
    assert found == {"/a": 'say "hi", 5', "/b": "two\nlines"}
    write_listing(read_listing(spark, str(path)), str(tmp_path / "back"))
    assert {r["url"]: r["listing_avg_package"] for r in read_listing(spark, str(tmp_path / "back")).collect()} == found


def test_listing_files_are_read_whole_only_where_a_field_is_broken(spark, tmp_path):
    plain = "url,listing_rank\n" + "".join(f'u{i},"a ""{i}"", b"\n' for i in range(2000))
    (tmp_path / "a b.csv").write_text(plain)
    (tmp_path / "b%20.csv").write_text('Listing_Rank,URL,other\n"x\ny",u5,z\n#2,v,\n')
    got = read_listing(spark, str(tmp_path))
    found = {r["url"]: r["listing_rank"] for r in got.collect()}
    # the later file's row wins, with its break
    assert len(found) == 2001 and found["u5"] == "x\ny" and found["v"] == "#2" and found["u7"] == 'a "7", b'
    plan = got._jdf.queryExecution().toString()
    assert plan.count("Relation") >= 2
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("url\n")
    assert read_listing(spark, str(tmp_path / "empty")).collect() == []
