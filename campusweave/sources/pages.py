"""Saved pages in, as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.functions.text import first_match
from campusweave.operators.relational import sort_entities
from campusweave.rules.vocab import SAVED_PAGE_NAME

PAGES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("college_id", "slug", "page_type", "url", "html")]
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages under ``<path>/<page_type>/<id>_<slug>.html``; other files are left out."""
    name = F.col("_metadata.file_path")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    return files.select(
        first_match(name, SAVED_PAGE_NAME, 2).alias("college_id"),
        first_match(name, SAVED_PAGE_NAME, 3).alias("slug"),
        first_match(name, SAVED_PAGE_NAME, 1).alias("page_type"),
        name.alias("url"),
        F.col("value").alias("html"),
    ).filter(F.col("college_id").isNotNull())


def store_pages(pages: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """Pages as a table in a folder per page type: many small files are opened once only.

    Each task writes what it read, so no page is shuffled; a job on one type then opens the
    folder of that type.
    """
    pages.select(*PAGES.fieldNames()).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("page_type").parquet(path)


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path).select(*PAGES.fieldNames())


def distinct_entities(pages: DataFrame) -> DataFrame:
    """Every (college_id, slug) of any page type, ordered as strings."""
    return sort_entities(pages.select("college_id", "slug").distinct())
