"""Text and money expressions against plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campusweave.functions import degrees as D
from campusweave.functions import money as M
from campusweave.functions import text as X

several = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@several
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x85\xa0 　aé.", max_size=12), min_size=20, max_size=60))
def test_clean(spark, texts):
    assert apply(spark, texts, X.clean) == [re.sub(r"\s+", " ", t.replace("\xa0", " ").strip()) for t in texts]


@several
@given(st.lists(st.integers(0, 10**9), min_size=20, max_size=60))
def test_fees_of_whole_amounts(spark, amounts):
    expected = [f"{a / 100000:g} Lakhs" if a >= 100000 else f"{a:,}" for a in amounts]
    assert apply(spark, [str(a) for a in amounts], M.fees) == expected


@several
@given(st.lists(st.decimals(1, 99999, places=2), min_size=20, max_size=60))
def test_fees_of_small_fractions(spark, amounts):
    expected = [f"{float(a):,.0f}" if float(a).is_integer() else f"{float(a):,.2f}".rstrip("0").rstrip(".") for a in amounts]
    assert apply(spark, [str(a) for a in amounts], M.fees) == expected


def test_fees_with_units(spark):
    given_ = ["2.5 L", "3 crores", "5K", "1,200 Lakh a year", "soon", " 1,23,456 ", "", None, "1e12"]
    expected = ["2.5 Lakhs", "3 Crores", "5 Thousand", "1200 Lakhs", "soon", "1.23456 Lakhs", None, None, "1e+07 Lakhs"]
    assert apply(spark, given_, M.fees) == expected


def test_packages(spark):
    given_ = ["12000000", "20000000", "1250000", "300000", "99999", "0", "-4", "n/a", "1250000.7", None, ""]
    expected = ["1.20 Cr", "2 Crore", "12.50 LPA", "3 LPA", "99999", None, None, "n/a", "12.50 LPA", None, None]
    assert apply(spark, given_, M.package) == expected


@several
@given(st.lists(st.integers(0, 10**12), min_size=20, max_size=60))
def test_indian_digits(spark, numbers):
    def grouped(n):
        s = str(n)
        if n == 0 or len(s) <= 3:
            return s if n else ""
        head, parts = s[:-3], []
        while head:
            parts.insert(0, head[-2:])
            head = head[:-2]
        return ",".join([*parts, s[-3:]])

    assert apply(spark, [str(n) for n in numbers], M.indian_digits) == [grouped(n) for n in numbers]


@pytest.mark.parametrize(
    "text, tag",
    [
        ("BE", "B.Tech"), ("PGPX", "MBA"), ("Robotics", "Robotics"), ("M.A. English", "MA"), ("BA Hist", "BA"),
        ("fpm", "Ph.D"), ("éma", "éma"), ("Diploma in Nursing", "Diploma in Nursing"), ("D.M. x", "DM"), ("", ""), ("  Law ", "Law"),
    ],
)
def test_degree_tag(spark, text, tag):
    assert apply(spark, [text], D.degree_tag) == [tag]


@pytest.mark.parametrize(
    "degree, name, expected",
    [
        ("robotics", "x", ("4.5 Years", "UG", "Not Specified", "Full Time")),
        ("admission", "x", ("3 Years", "Doctorate", "NEET SS", "Full Time")),
        ("MBA", "Executive MBA", ("2 Years", "PG", "CAT", "Part Time")),
        ("Other", "Executive course", ("1 Year", "PG", "Not Specified", "Part Time")),
        ("Other", "Law", ("3-5 Years", "UG", "CLAT", "Full Time")),
        ("Other", "Arts", ("Not Specified", "UG", "Not Specified", "Full Time")),
    ],
)
def test_details(spark, degree, name, expected):
    got = spark.range(1).select(D.details(F.lit(degree), F.lit(name)).alias("d")).first()["d"]
    assert (got["duration"], got["course_level"], got["entrance_exam"], got["course_type"]) == expected


def test_names(spark):
    assert apply(spark, ["MBA (Fin) ", "(Fin)", "MBA", None], X.without_trailing_parens) == ["MBA", "(Fin)", "MBA", ""]


def test_running_values(spark):
    import itertools
    import random

    from campusweave.functions.text import running

    rng = random.Random(1)
    rows_ = [[rng.randrange(-5, 50) for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 17, 100, 101)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(rows_)], "i int, a array<int>")
    got = df.orderBy("i").select(running(F.col("a"), lambda x, y: x + y, F.lit(0)).alias("s"), running(F.col("a"), lambda x, y: F.greatest(x, y), F.lit(-9)).alias("m")).collect()
    assert [r["s"] for r in got] == [list(itertools.accumulate(a)) for a in rows_]
    assert [r["m"] for r in got] == [list(itertools.accumulate(a, max)) for a in rows_]


def test_main_text_with_nested_noise(spark):
    from campusweave.operators import html as H

    pages = ["<nav>a<p>b</p></nav><main>c<div>d<nav>e<nav>f</nav>g</nav>h</div></main><p>i</p>", "x<nav>y</nav>z", "", "<nav><main>q</main></nav><article>r</article>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    assert [r["main_text"] for r in H.main_text(df).orderBy("i").collect()] == ["c d h", "x z", "", "r"]
