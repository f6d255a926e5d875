"""Page operators on long pages: what they find, and that their time grows with the page and not with its square."""

import time

import pytest
from pyspark.sql import functions as F

from campusweave.operators import frontier as B
from campusweave.operators import html as H
from campusweave.sources import page_files
from campusweave.sources.pages import read_pages
from tests.conftest import rows


def seconds(job):
    job()
    took = []
    for _ in range(2):
        start = time.perf_counter()
        job()
        took.append(time.perf_counter() - start)
    return min(took)


def trees(spark, html):
    # parsed once and kept, so that only the operator is timed
    return H.with_tree(spark.createDataFrame([(1, html)], "page_no int, html string")).cache()


def listing(n):
    """n blocks, each with a loose rank beside a link, deep in the page."""
    return "<div>" + "".join(f"<div><p>#{i + 1}</p><p><a href='/college/{i}-x'>x</a></p></div>" for i in range(n)) + "</div>"


def tables(n):
    return "".join(f"<h2>T{i}</h2><p>x</p><table><tr><td>a{i}</td><td>b</td></tr></table>" for i in range(n))


@pytest.mark.parametrize("make, job, n", [
    (listing, lambda t: B.associate_ranks(t, ["page_no"]), 4000),
    (tables, lambda t: H.html_tables(t, ["page_no"]), 2000),
])
def test_time_grows_with_the_page(spark, make, job, n):
    short, long = trees(spark, make(n)), trees(spark, make(2 * n))
    short.count(), long.count()
    run = lambda t: job(t).write.format("noop").mode("overwrite").save()
    one, two = seconds(lambda: run(short)), seconds(lambda: run(long))
    assert two < 3 * one + 0.3, (one, two)


def test_each_rank_finds_its_own_link(spark):
    found = B.associate_ranks(trees(spark, listing(300)), ["page_no"]).collect()
    assert sorted((r["rank"], r["url"]) for r in found) == sorted((f"#{i + 1}", f"https://campus.example/college/{i}-x") for i in range(300))


def test_scopes_of_a_rank(spark):
    def found(html):
        return [(r["rank"], r["url"].rsplit("/", 1)[-1]) for r in B.associate_ranks(trees(spark, html), ["page_no"]).collect()]

    assert found("<div>#1<a href='/none'>n</a><a href='/college/1-a'>a</a><a href='/college/2-b'>b</a></div>") == [("#1", "1-a")]
    assert found("<a href='/college/1-a'>a</a><p>#1</p>") == [("#1", "1-a")]  # the page itself encloses all
    deep = "<i>" * 6 + "#1" + "</i>" * 6
    assert found(f"<div><a href='/college/1-a'>a</a>{deep}</div>") == []  # beyond five levels
    assert found("<p>#1</p>") == [] and found("") == []


def test_headings_before_tables(spark):
    html = "<table><tr><td>0</td></tr></table><h1> One </h1><h4>TWO<br>x</h4><div><table><tr><td><h2>in</h2></td></tr><tr><td><table><tr><td>n</td></tr></table></td></tr></table></div><h3></h3><table><tr><td>e</td></tr></table>"
    got = {r["table_no"]: r["heading"] for r in H.html_tables(trees(spark, html), ["page_no"]).collect()}
    assert got == {0: "", 1: "twox", 2: "in", 3: ""}


PAGES = "college_id string, slug string, page_type string, url string, html string"


def test_pages_are_saved_under_their_names(spark, tmp_path):
    pages = [("10", "b-c", "info", "u", "<p>é</p>\n<p>2</p>"), ("9", "a", "courses", "u", "x"), ("9", "a", "info", "u", None), ("x", "a", "info", "u", "no"), ("1", "a/b", "info", "u", "no"), (None, "a", "info", "u", "no")]
    path = str(tmp_path / "html")
    page_files.write_pages(spark.createDataFrame(pages, PAGES).repartition(3), path)
    assert sorted(str(f.relative_to(path)) for f in (tmp_path / "html").rglob("*") if f.is_file()) == ["courses/9_a.html", "info/10_b-c.html", "info/9_a.html"]
    page_files.write_pages(spark.createDataFrame([("9", "a", "info", "u", "new")], PAGES), f"file://{path}")
    assert rows(read_pages(spark, path), "college_id", "slug", "page_type", "html") == [("10", "b-c", "info", "<p>é</p>\n<p>2</p>"), ("9", "a", "courses", "x"), ("9", "a", "info", "new")]
    with pytest.raises(Exception, match="another folder"):
        spark.createDataFrame([("9", "a", "info", "x")], "college_id string, slug string, page_type string, html string").write.format(page_files.FORMAT).mode("overwrite").option("path", path).save()
    assert spark.read.text(path, wholetext=True, recursiveFileLookup=True).agg(F.count("value")).first()[0] == 3
