"""Sources, sinks and the incremental run."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from campusweave import schemas as S
from campusweave.operators import audit as A
from campusweave.operators import relational as R
from campusweave.plans import run
from campusweave.session import checkpoint_dir
from campusweave.sources import datasets as D
from campusweave.sources import listing as L
from campusweave.sources import pages as P
from campusweave.streaming.ingest import stream_pages
from tests.conftest import rows


def test_read_pages(spark, tmp_path):
    for name, text in {
        "info/10_b-c.html": "<p>é</p>\n<p>2</p>", "courses/9_a.html": "x", "courses/9_a.txt": "no", "courses/x_a.html": "no", "info/9_a.html": "y",
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    pages = P.read_pages(spark, str(tmp_path))
    assert rows(pages, "college_id", "slug", "page_type", "html") == [
        ("10", "b-c", "info", "<p>é</p>\n<p>2</p>"), ("9", "a", "courses", "x"), ("9", "a", "info", "y"),
    ]
    # ids are ordered as strings
    assert [tuple(r) for r in P.distinct_entities(pages).collect()] == [("10", "b-c"), ("9", "a")]


def test_listing_file(spark, tmp_path):
    (tmp_path / "l.csv").write_text('﻿"URL", Listing_Rank \nu1,#1\n ,#2\nu2,#3\n u1 ,#4\n', encoding="utf-8")
    got = L.read_listing(spark, str(tmp_path / "l.csv"))
    assert rows(got, "url", "listing_rank", "listing_avg_package") == [("u1", "#4", ""), ("u2", "#3", "")]
    L.write_listing(got, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [line.split(",")[0] for line in text.splitlines() if not line.startswith("url")] == ["u2", "u1"]


def test_missing_and_broken_datasets(spark, tmp_path):
    assert D.read_dataset(spark, str(tmp_path / "none"), S.COURSES).count() == 0
    (tmp_path / "bad.json").write_text("[{\"college_id\": ")
    assert D.read_dataset(spark, str(tmp_path / "bad.json"), S.HOSTEL, "json-array").count() == 0
    (tmp_path / "good.json").write_text('[{"college_id": "1", "hostel_fees": "5"}, {"college_id": "2"}]')
    assert rows(D.read_dataset(spark, str(tmp_path / "good.json"), S.HOSTEL, "json-array"), "college_id", "facilities") == [("1", None), ("2", None)]


def test_stored_counts_mark_what_cannot_be_opened(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    audit = A.audit_stored(spark, {"a": lambda: spark.read.parquet(str(tmp_path / "a")), "b": lambda: spark.read.parquet(str(tmp_path / "b"))})
    assert rows(audit, "dataset", "n_rows", "error") == [("a", 3, None), ("b", None, "PATH_NOT_FOUND")]


def test_bundle(spark, tmp_path):
    counts = D.write_bundle({"hostel": spark.createDataFrame([("1", "a", "b")], S.HOSTEL), "faculty": spark.createDataFrame([], S.FACULTY)}, str(tmp_path))
    assert counts == {"hostel": 1, "faculty": 0}
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "faculty_status")).collect()] == [("No Data Available", "Check Logs")]


def test_per_entity_export_skips_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    data = {
        "colleges": spark.createDataFrame([("1", "A"), ("2", "B"), ("", "C")], "college_id string, name string"),
        "reviews": spark.createDataFrame([("1", i) for i in range(50)] + [("9", 0)], "college_id string, n long"),
    }
    for _ in range(2):  # the same run twice is the run once
        assert rows(D.write_per_entity(data, root, "r1", buckets=4), "college_id") == [("1",), ("2",)]
    assert D.read_entity(spark, root, "reviews", "1").count() == 50
    assert D.read_entity(spark, root, "reviews", "9").count() == 0
    more = {**data, "colleges": data["colleges"].union(spark.createDataFrame([("3", "D")], "college_id string, name string"))}
    assert rows(D.write_per_entity(more, root, "r2", buckets=4), "college_id") == [("3",)]
    assert spark.read.parquet(f"{root}/colleges").count() == 3


def test_merge_parts_keeps_the_earliest(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "b")], "id int, v string")
    assert rows(D.merge_parts([a, b], ["id"]), "id", "v") == [(1, "a"), (2, "a"), (3, "b")]
    assert D.merge_parts([a, b]).count() == 4


def test_placeholders(spark):
    some = spark.createDataFrame([("1", 5)], "college_id string, n int")
    both = R.with_placeholder(some, "college_id", spark.createDataFrame([("1",), ("2",)], "college_id string"))
    assert rows(both, "college_id", "n", "status") == [("1", 5, None), ("2", None, "No Data Available")]
    assert rows(R.with_placeholder(some.filter("n > 9"), "college_id"), "college_id", "status") == [("No Data Available", "Check Logs")]


PAGES = [
    ("1", "a", "info", "u", "<title>A College</title>"),
    ("1", "a", "hostel", "u", "<p>gym</p>"),
    ("1", "a", "placements", "u", "<p>Ranked 8 by Outlook. Highest package: INR 9 LPA</p>"),
    ("2", "b", "reviews", "u", '<div class="review-card"><p class="text">ok</p></div>'),
]


@pytest.fixture
def arriving(spark, tmp_path):
    def add(batch, pages):
        spark.createDataFrame(pages, P.PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    return add


def snapshot(spark, root):
    return {name: rows(df, *df.columns) for name, df in run.load_datasets(spark, root).items()}


def test_stream_is_incremental_and_repeatable(spark, tmp_path, arriving):
    source, root, progress = (str(tmp_path / n) for n in ("in", "out", "ck"))
    arriving(0, PAGES)
    assert stream_pages(spark, source, root, progress) == 1
    first = snapshot(spark, root)
    assert first["rankings"] == [("1", "Outlook", "#8", None)] and len(first["reviews"]) == 1 and first["placements"][0][1] == "9 LPA"
    # nothing new: nothing changes
    assert stream_pages(spark, source, root, progress) == 0
    assert snapshot(spark, root) == first
    # a page seen before, under a college that has no info page, adds nothing; a new one does
    arriving(1, [PAGES[3], ("2", "b", "info", "u", "<title>B</title>"), ("1", "a", "faculty", "u", '<div class="member"><b class="x"></b><h3 class="name">F</h3></div>')])
    assert stream_pages(spark, source, root, progress) == 1
    second = snapshot(spark, root)
    assert second["reviews"] == first["reviews"] and len(second["colleges"]) == 2 and len(second["faculty"]) == 1


def test_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "out")
    pages = spark.createDataFrame(PAGES, P.PAGES)
    run.parse_batch(pages, root, "0")
    before = snapshot(spark, root)
    run.parse_batch(pages, root, "0")
    assert snapshot(spark, root) == before
    run.parse_batch(pages, root, "1")
    assert snapshot(spark, root) == before


def test_repartitioning_changes_nothing(spark):
    pages = spark.createDataFrame(PAGES, P.PAGES)
    one = {n: rows(df, *df.columns) for n, df in run.build_datasets(pages.coalesce(1)).items()}
    many = {n: rows(df, *df.columns) for n, df in run.build_datasets(pages.repartition(7)).items()}
    assert one == many


def test_checkpoint_folder_comes_from_the_session(spark):
    class Session:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = conf, SimpleNamespace(master=master)

    assert checkpoint_dir(Session("spark://m", **{"spark.checkpoint.dir": "/shared/x"})) == "/shared/x"
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session("spark://m"))
    assert checkpoint_dir(spark).startswith("/tmp")


def test_widths_and_slices(spark):
    df = spark.createDataFrame([("1", "x" * 20, 0)], "college_id string, name string, zero int")
    assert rows(R.column_widths(df), "column_name", "width") == [("college_id", 13), ("name", 23), ("zero", 12)]
    assert df.select(F.lit(1)).count() == 1


def test_page_store_opens_one_folder(spark, tmp_path):
    P.store_pages(spark.createDataFrame(PAGES, P.PAGES), str(tmp_path / "s"))
    one = P.stored_pages(spark, str(tmp_path / "s")).filter(F.col("page_type") == "info")
    assert "PartitionFilters: [isnotnull(page_type" in one._jdf.queryExecution().executedPlan().toString()
    assert rows(one, "college_id", "page_type", "html") == [("1", "info", "<title>A College</title>")]


def test_any_cut_gives_the_same_datasets(spark, tmp_path):
    """A college's rankings settle when its second page comes, in whichever order."""
    state = '{"props":{"initialProps":{"pageProps":{"data":{"basic_info":{"ranking":[{"agency":"NIRF","rank":"3","year":"2024"}]}}}}}}'
    info = ("1", "a", "info", "u", f'<title>A</title><script id="__NEXT_DATA__">{state}</script>')
    pages = [info, PAGES[2], PAGES[3], ("1", "a", "hostel", "u", "<p>x</p>")]
    pages = [p for p in pages if p[2] in ("info", "placements", "reviews", "hostel")]
    found = []
    for number, cut in enumerate([[pages], [pages[:1], pages[1:]], [pages[1:], pages[:1]], [[p] for p in pages]]):
        root = str(tmp_path / f"cut{number}")
        for batch, rows_ in enumerate(cut):
            run.parse_batch(spark.createDataFrame(rows_, P.PAGES), root, str(batch))
        found.append(snapshot(spark, root))
    assert all(f == found[0] for f in found)


def test_a_page_that_the_parser_rejects(spark, tmp_path):
    root = str(tmp_path / "out")
    kinds = ("info", "placements", "hostel", "admissions", "courses", "faculty")
    run.parse_batch(spark.createDataFrame([("1", "a", k, "u", "<p>a</p><![foo[x]]>") for k in kinds], P.PAGES), root, "0")
    assert all(not found for found in snapshot(spark, root).values())
    assert {r["page_type"] for r in run.load_rejected(spark, root).collect()} == set(kinds)


def test_entities_are_found_whatever_the_bucket_count(spark, tmp_path):
    root = str(tmp_path / "entities")
    data = {"colleges": spark.createDataFrame([("1",), ("2",)], "college_id string")}
    D.write_per_entity(data, root, "r1", buckets=8)
    assert D.read_entity(spark, root, "colleges", "2").count() == 1
    D.write_per_entity({"colleges": spark.createDataFrame([("3",)], "college_id string")}, root, "r2", buckets=5)
    assert D.read_entity(spark, root, "colleges", "3").count() == 1


def test_broken_records_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "broken")
    lines = ['{"college_id": "1", "hostel_fees": "5"}', '{"college_id": "2", ', '{"college_id": "3"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    from campusweave.schemas import DATASETS

    assert sorted(r["college_id"] for r in D.read_dataset(spark, path, DATASETS["hostel"], "json").collect()) == ["1", "3"]
    assert [r["record"] for r in D.rejected_records(spark, path, DATASETS["hostel"]).collect()] == [lines[1]]
