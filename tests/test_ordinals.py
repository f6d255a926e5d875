"""Global order, running totals and carried values against brute force, with tiny chunks."""

import random

import pytest
from pyspark.sql import functions as F

from campusweave.operators.ordinals import _dealt, carry, first_n, split_parts, with_position, with_running_totals, write_parts
from campusweave.operators.relational import top_n


@pytest.mark.parametrize("width", [1, 2, 3, 7, 1000])
def test_positions_and_totals(spark, width):
    rng = random.Random(width)
    keys = sorted(rng.sample(range(-50, 400), 60))
    data = [(k, rng.randrange(5)) for k in keys]
    df = spark.createDataFrame(rng.sample(data, len(data)), "k long, v int")
    got = {r["k"]: r["position"] for r in with_position(df, "k", width=width).collect()}
    assert got == {k: i for i, k in enumerate(keys)}
    sums = with_running_totals(df, "k", {"a": F.col("v"), "b": F.col("v") * 2}, total="total", width=width)
    totals = {r["k"]: (r["a"], r["b"], r["total"]) for r in sums.collect()}
    before = {k: sum(v for j, v in data if j < k) for k in keys}
    assert totals == {k: (before[k], 2 * before[k], sum(v for _, v in data)) for k in keys}


def test_positions_of_huge_ordinals(spark):
    keys = [2**62 + i for i in (0, 1, 5, 70_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert {r["k"]: r["position"] for r in with_position(df, "k").collect()} == {k: i for i, k in enumerate(keys)}


@pytest.mark.parametrize("n, parts", [(10, 3), (10, 4), (9, 3), (2, 5), (1, 1)])
def test_split(spark, n, parts):
    chunk = -(-n // parts)
    got = {r["id"]: r["part"] for r in split_parts(spark.range(n), parts, "id", width=2).collect()}
    assert got == {i: i // chunk + 1 for i in range(n)}


@pytest.mark.parametrize("width", [1, 2, 5, 1000])
@pytest.mark.parametrize("forward", [True, False])
def test_carry(spark, width, forward):
    rng = random.Random(width)
    data = [(k, t, rng.choice([None, None, f"v{t}"])) for k in "ab" for t in rng.sample(range(40), 25)]
    df = spark.createDataFrame(data, "k string, t long, v string")
    got = {(r["k"], r["t"]): r["near"] for r in carry(df, ["k"], "t", F.col("v"), "near", forward, width).collect()}

    def near(k, t):
        side = [(u, v) for j, u, v in data if j == k and v is not None and (u < t if forward else u > t)]
        return (max(side) if forward else min(side))[1] if side else None

    assert got == {(k, t): near(k, t) for k, t, _ in data}


def spread(spark):
    """Orders whose values lie in every way: hashes, one far off, bursts of 1,000 far apart, texts."""
    ids = spark.range(20_000)
    return {
        "hash": ids.select(F.xxhash64("id").alias("k")),
        "far": ids.select(F.when(F.col("id") == 7, 2**62).otherwise(F.col("id")).alias("k")),
        "bursts": ids.select((F.floor(F.col("id") / 1000) * 10**15 + F.col("id") % 1000).alias("k")),
        "texts": ids.select(F.sha2(F.col("id").cast("string"), 256).alias("k")),
    }


@pytest.mark.parametrize("kind", ["hash", "far", "bursts", "texts"])
def test_ranges_are_even_however_the_order_lies(spark, kind):
    dealt, chunks = _dealt(spread(spark)[kind], ["k"], 100)
    sizes = [r["count"] for r in dealt.groupBy("_chunk").count().collect()]
    assert chunks == 200 and max(sizes) <= 250 and len(sizes) >= 190
    ends = sorted((r["_chunk"], r["low"], r["high"]) for r in dealt.groupBy("_chunk").agg(F.min("k").alias("low"), F.max("k").alias("high")).collect())
    assert all(a[2] < b[1] for a, b in zip(ends, ends[1:]))


def test_bursts_at_100_000_rows(spark):
    rows = spark.range(100_000).select((F.floor(F.col("id") / 1000) * 10**12 + F.col("id") % 1000).alias("k"))
    dealt, chunks = _dealt(rows, ["k"], 500)
    assert chunks == 200 and dealt.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 1250


@pytest.mark.parametrize("n", [0, 1, 13, 20, 59, 60, 99])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_first_n(spark, n, width):
    rng = random.Random(n)
    data = [(rng.choice([None, "a", "b", "c"]), i) for i in range(60)]
    df = spark.createDataFrame(rng.sample(data, 60), "g string, i long")
    want = sorted(data, key=lambda r: ([None, "c", "b", "a"].index(r[0]) if r[0] else 9, -r[1]))  # descending, nulls last
    got = [tuple(r) for r in first_n(df, [F.col("g").desc(), F.col("i").desc()], n, width).collect()]
    assert sorted(got, key=repr) == sorted(want[:n], key=repr)


def test_first_n_takes_all_ties_it_may(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(0,)] * 5 + [(2,)] * 5, "v int")
    assert sorted(r["v"] for r in first_n(df, ["v"], 30, 7).collect()) == [0] * 5 + [1] * 25


def test_many_rows_are_not_merged_in_one_task(spark):
    df = spark.range(3000).withColumn("v", F.xxhash64("id"))
    many = first_n(df, ["v"], 1500, 300)
    assert "SinglePartition" not in many._jdf.queryExecution().executedPlan().toString()
    wanted = {r["id"] for r in top_n(df, ["v"], 1500).collect()}
    assert {r["id"] for r in many.collect()} == wanted == {r["id"] for r in top_n(df, ["v"], 1500, merged=100).collect()}


@pytest.mark.parametrize("width", [3, 10, 50])
def test_carry_over_a_key_of_many_ranges_and_null_keys(spark, width):
    data = [("a", t, "start" if t == 0 else None) for t in range(100)] + [("b", t, None) for t in range(9)] + [(None, t, "n" if t == 4 else None) for t in range(12)]
    df = spark.createDataFrame(random.Random(1).sample(data, len(data)), "k string, t long, v string")
    got = {(r["k"], r["t"]): r["near"] for r in carry(df, ["k"], "t", F.col("v"), "near", True, width).collect()}
    assert got == {(k, t): ("start" if k == "a" and t else "n" if k is None and t > 4 else None) for k, t, _ in data}


def test_parts_are_written(spark, tmp_path):
    path = str(tmp_path / "parts")
    write_parts(spark.range(100).selectExpr("id * 1000003 % 1009 AS k", "id"), 4, "k", path)
    parts = {r["part"]: (r["n"], r["low"], r["high"]) for r in spark.read.parquet(path).groupBy("part").agg(F.count("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()}
    assert [parts[i][0] for i in (1, 2, 3, 4)] == [25] * 4 and all(parts[i][2] < parts[i + 1][1] for i in (1, 2, 3))
