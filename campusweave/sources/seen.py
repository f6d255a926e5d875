"""Keys that are done, in hash buckets whose number grows with the table.

``<path>/new=<version>/batch=<name>`` holds the keys of recent batches, ``<path>/base=<version>/bucket=<n>`` all older ones.
After FOLD batches the two are written as the next version, in as many buckets as keep each at about PER_BUCKET keys. A
batch reads the recent keys, of which there are few, and of the older ones the buckets of its own keys: what it reads does not
hang on how many batches went before. A version counts once ``<path>/layout`` names it, so a fold that was cut short
leaves the last one in force; a folded version's predecessor is emptied. One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.operators.relational import without_known
from campusweave.sources.datasets import no_rows, read_dataset

LAYOUT = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("buckets", T.IntegerType())])
FOLD = 8
PER_BUCKET = 50_000
#: Up to so many folders are named one by one; a batch that touches more reads the whole table.
NAMED = 10_000
#: With so many keys for each bucket a batch reads the whole table unasked.
SPREAD = 4


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def layout(spark: SparkSession, path: str) -> Row:
    """Version in force and its number of buckets; version 0 has no older keys."""
    rows = read_dataset(spark, f"{path}/layout", LAYOUT).collect()  # one row a fold
    return max(rows, default=Row(version=0, buckets=0))


def _schema(keys: list[str]) -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType()) for k in (*keys, "batch")])


def recent(spark: SparkSession, path: str, keys: list[str], version: int) -> DataFrame:
    return read_dataset(spark, f"{path}/new={version}", _schema(keys))


def older(spark: SparkSession, path: str, keys: list[str], version: int, buckets: list[int] | None = None) -> DataFrame:
    """Keys of the folded batches, of all buckets or of the given ones."""
    schema, base = _schema(keys), f"{path}/base={version}"
    if version == 0 or buckets == []:
        return no_rows(spark, schema)
    if buckets is None:
        return read_dataset(spark, base, schema)
    reader = spark.read.schema(schema).option("basePath", base)
    try:
        return reader.parquet(*[f"{base}/bucket={b}" for b in buckets]).select(*schema.fieldNames())
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    # some bucket has no key yet: the table's own list of folders tells which
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(base).filter(F.col("bucket").isin(buckets)).select(*schema.fieldNames())


def known_to_others(fresh: DataFrame, path: str, keys: list[str], batch: str, now: Row | None = None, rows: int = 0) -> DataFrame:
    """Seen keys that matter to a batch: those of other batches in the buckets of its own keys.

    ``rows``, if known, is the number of its keys: with SPREAD for each bucket they are in all of them.
    """
    spark = fresh.sparkSession
    now = now or layout(spark, path)
    touched = None
    if now["buckets"] > 1 and rows < SPREAD * now["buckets"]:
        found = fresh.select(_bucket(keys, now["buckets"]).alias("b")).distinct().limit(NAMED + 1).collect()
        touched = sorted(r["b"] for r in found) if len(found) <= NAMED else None
    seen = older(spark, path, keys, now["version"], touched).union(recent(spark, path, keys, now["version"]))
    return seen.filter(F.col("batch") != batch).drop("batch")


def unseen(fresh: DataFrame, path: str, keys: list[str], batch: str, now: Row | None = None, rows: int = 0) -> DataFrame:
    """Distinct keys of a batch that no other batch has. ``now`` is the layout, if it has been read already."""
    fresh = fresh.select(*keys).distinct()
    return without_known(fresh, known_to_others(fresh, path, keys, batch, now, rows), keys)


def add(done: DataFrame, path: str, keys: list[str], batch: str, now: Row | None = None) -> None:
    """Enter a batch's keys, in place of those it entered before, and fold when FOLD batches have come."""
    spark = done.sparkSession
    now = now or layout(spark, path)
    done.select(*keys).write.mode("overwrite").parquet(f"{path}/new={now['version']}/batch={batch}")
    # the names of the files tell the batches: none is opened
    if len({file.rsplit("/", 2)[-2] for file in recent(spark, path, keys, now["version"]).inputFiles()}) >= FOLD:
        fold(spark, path, keys)


def fold(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Write older and recent keys as the next version."""
    now = layout(spark, path)
    version = now["version"]
    every = older(spark, path, keys, version).union(recent(spark, path, keys, version))
    buckets = max(1, -(-every.count() // PER_BUCKET))
    dealt = every.withColumn("bucket", _bucket(keys, buckets)).repartition("bucket").sortWithinPartitions("bucket", *keys)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/base={version + 1}")
    spark.range(0, 1, 1, 1).select(F.lit(version + 1).alias("version"), F.lit(buckets).alias("buckets")).write.mode("append").parquet(f"{path}/layout")
    nothing = no_rows(spark, _schema(keys))
    for old in (f"base={version}", f"new={version}"):
        if old != "base=0":
            nothing.write.mode("overwrite").parquet(f"{path}/{old}")
