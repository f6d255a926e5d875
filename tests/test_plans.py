"""What the plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from campusweave.operators import audit as A
from campusweave.operators import frontier as B
from campusweave.operators import html as H
from campusweave.operators import relational as R
from campusweave.operators.ordinals import with_position
from campusweave.plans import people


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of all rows under one key."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"), "id", (F.col("id") % 2).cast("int").alias("source")
    )


def test_first_wins_cuts_before_the_shuffle(skewed):
    df = R.first_wins(skewed, ["key"], ["id"])
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert df.count() == 20_001
    assert df.filter("key = 0").collect()[0]["id"] == 0


def test_fallback_on_a_hot_key(skewed):
    df = R.fallback_chain(skewed, ["key"], "source")
    assert "Window" not in plan(df)
    # of the hot key the even ids stay, of every other key its one row
    assert df.count() == 5_000 + 20_000


def test_fallback_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 0, "b"), (1, 1, "c")], "k int, p int, v string")
    assert sorted(r["v"] for r in R.fallback_chain(df, ["k"], "p").collect()) == ["b", "c"]


@pytest.mark.parametrize("keys", ["id", "xxhash64(id)"])
def test_positions_gather_nothing_but_range_sums(spark, keys):
    lines = plan(with_position(spark.range(1000).selectExpr(f"{keys} AS id"), "id", width=50)).splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1 and "HashAggregate(keys=[_chunk" in lines[single[0] + 1]


def test_pages_are_parsed_without_a_shuffle(page):
    assert "Exchange" not in plan(people.build_hostel(page("<p>x</p>", "hostel")))
    assert "Exchange" not in plan(H.main_text(page("<p>x</p>")))


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.createDataFrame([("1", "a", "info", "u", "h")], "college_id string, slug string, page_type string, url string, html string").write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    text = plan(A.audit_completeness(stored))
    assert "html" not in text[text.index("ReadSchema"):]
    text = plan(people.build_hostel(stored.filter(F.col("page_type") == "hostel")))
    assert "EqualTo(page_type,hostel)" in text and "url:string" not in text


def test_no_cross_joins(spark):
    urls = spark.createDataFrame([("/college/1-a", "1")], "url string, id string")
    for df in (B.expand_frontier(urls, "url"), B.page_type_of_url(urls)):
        assert "Join" not in plan(df) and "Cartesian" not in plan(df)


def test_novelty_without_a_global_window(spark):
    found = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "b")], "page_no long, url string")
    df = B.listing_novelty(found)
    assert "Window" not in plan(df)
    assert sorted(tuple(r) for r in df.collect()) == [(1, 1, False), (2, 0, False), (3, 0, False), (4, 0, True), (5, 1, False)]


def test_novelty_counts_pages_that_list_nothing(spark):
    found = spark.createDataFrame([(1, "a")], "page_no long, url string")
    df = B.listing_novelty(found, spark.range(1, 5).withColumnRenamed("id", "page_no"))
    assert sorted(tuple(r) for r in df.collect()) == [(1, 1, False), (2, 0, False), (3, 0, False), (4, 0, True)]
