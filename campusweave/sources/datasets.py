"""Datasets in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.operators.relational import empty_marker, first_wins

#: Folders that entities share, unless the first export into a place says otherwise.
BUCKETS = 256
REJECT = "_rejected"
LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType())])


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty: joins and unions with it go, and reading it is no job."""
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).filter(F.lit(False))


def read_dataset(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stored dataset; an empty one if it is missing or cannot be read.

    ``fmt`` is parquet, json (one record per line) or json-array (one list per file). JSON records
    that do not fit are no rows here; ``rejected_records`` has them.
    """
    try:
        if fmt.startswith("json"):
            # a field is named beside the reject, as Spark counts no rows by the reject alone
            fits = F.col(REJECT).isNull() & (F.size(F.array(F.col(schema.fieldNames()[0]).isNull())) > 0)
            return _json(spark, path, schema, fmt).filter(fits).select(*schema.fieldNames())
        return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return no_rows(spark, schema)
        raise


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder of that name; nothing in it is read."""
    try:
        spark.read.schema("value string").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _json(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    known = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    reader = spark.read.schema(known).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
    return reader.option("multiLine", fmt == "json-array").json(path)


def rejected_records(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """Records of a JSON dataset that could not be read: the file, the record as it stands, and the fields that could be read."""
    # all fields are asked for, as a record is broken by any of them
    read = _json(spark, path, schema, fmt).select(F.col("_metadata.file_path").alias("file"), F.col(REJECT).alias("record"), F.to_json(F.struct(*schema.fieldNames())).alias("fields"))
    return read.filter(F.col("record").isNotNull())


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


def write_bundle(datasets: Mapping[str, DataFrame], path: str, fmt: str = "parquet", key: str = "college_id") -> dict[str, int]:
    """All datasets under one folder; row counts are taken while writing.

    An empty dataset also gets ``<name>_status`` with one marker row.
    """
    counts = {}
    for name, df in datasets.items():
        seen = Observation(name)
        write_dataset(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{path}/{name}", fmt)
        counts[name] = seen.get["n"]
        if counts[name] == 0:
            write_dataset(empty_marker(df, key), f"{path}/{name}_status", fmt)
    return counts


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, path: str, otherwise: int) -> int:
    """Number of hash buckets of what is stored under a path: set by the first one to write there, then kept."""
    stored = read_dataset(spark, f"{path}/_layout", LAYOUT).first()
    if stored:
        return stored["buckets"]
    spark.range(0, 1, 1, 1).select(F.lit(otherwise).alias("buckets")).write.mode("overwrite").parquet(f"{path}/_layout")
    return otherwise


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, parts: Sequence[str] = (), files: int = 1) -> None:
    """Replace the folders (bucket, then ``parts``) that a table has rows for, and leave the others as they are.

    Rows of a bucket go to up to ``files`` files, spread by key.
    """
    dealt = df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket", F.pmod(F.xxhash64(key), F.lit(buckets * files)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", *parts).parquet(path)


def write_per_entity(
    datasets: Mapping[str, DataFrame], path: str, run_id: str, key: str = "college_id", buckets: int = BUCKETS, entities: str = "colleges", files: int | None = None
) -> DataFrame:
    """Every entity's rows of all datasets, addressable by entity; entities already there are skipped.

    Entities share a fixed number of folders by hash: a folder each would not survive a
    billion entities. The number is stored beside the data and holds for all later runs. Rows of one
    entity spread over up to ``files`` files of its folder, so a hot entity is not one task's work; without
    a number as many as there are shuffle partitions, few of which a small folder uses. A run writes its
    own ``run`` folder and can be repeated. Returns the entities this run exported.
    """
    spark = next(iter(datasets.values())).sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = bucket_count(spark, path, buckets)
    done = read_dataset(spark, f"{path}/_entities", T.StructType([T.StructField(key, T.StringType()), T.StructField("run", T.StringType())]))
    done = done.filter(F.col("run") != run_id)
    found = datasets[entities].select(F.col(key).cast("string").alias(key)).filter(F.col(key) != "").distinct()
    # settled once and stored: every dataset joins with this run's entities
    found.join(done.select(key), key, "left_anti").write.mode("overwrite").parquet(f"{path}/_new/run={run_id}")
    new = spark.read.schema(f"`{key}` string").parquet(f"{path}/_new/run={run_id}")
    for name, df in datasets.items():
        rows = df.withColumn(key, F.col(key).cast("string")).join(new, key, "left_semi").withColumn("bucket", bucket_of(key, buckets))
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
        (
            rows.repartition("bucket", spread)
            .sortWithinPartitions("bucket", key)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{path}/{name}/run={run_id}")
        )
    new.write.mode("overwrite").parquet(f"{path}/_entities/run={run_id}")
    return new


def read_entity(spark: SparkSession, path: str, name: str, entity: str, key: str = "college_id") -> DataFrame:
    """One entity's rows of a dataset: one folder is opened."""
    buckets = spark.read.schema(LAYOUT).parquet(f"{path}/_layout").first()["buckets"]
    wanted = spark.range(1).select(bucket_of(F.lit(entity), buckets).alias("b")).first()["b"]
    return spark.read.parquet(f"{path}/{name}").filter((F.col("bucket") == wanted) & (F.col(key) == entity)).drop("bucket", "run")


def merge_parts(parts: Sequence[DataFrame], keys: Sequence[str] | None = None) -> DataFrame:
    """Same-named datasets of independent runs as one; with keys, the earliest part wins."""
    if keys is None:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    numbered = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    return first_wins(together, list(keys), ["_part"]).drop("_part")
