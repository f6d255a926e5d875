"""Parsed pages, written once for all jobs of a batch.

Every job asks something else of a page, and each would parse it anew. A staging table holds the pages of a
batch with their trees, in a folder per page type: markup is parsed in one Python step per batch, and a job then reads the pages of
its type, and of their columns those it asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.operators import html as H
from campusweave.sources.pages import PAGES

STAGED = ", ".join([*(f"{name} string" for name in PAGES.fieldNames()), H.TREE_TYPE])
#: Page types whose jobs also read the markup; that of the others is not stored again.
MARKUP_READ = ("info", "placements", "courses", "reviews")
#: Page work costs far more than reading: pages of a file, and bytes of a row group, the least that a task can read, are kept small, so that pages are dealt out finely.
FILE_PAGES, ROW_GROUP = 2_000, 4 << 20


def stage_pages(pages: DataFrame, path: str, counts: Observation | None = None) -> DataFrame:
    """Parse pages into a staging table, and that table. No page is shuffled: a task writes what it has read.

    ``counts`` gets the pages (``n``) and those that could not be read (``rejected``).
    """
    trees = H.with_tree(pages.select(*PAGES.fieldNames()), keep_html=True)
    trees = trees.withColumn("html", F.when(F.col("page_type").isin(*MARKUP_READ), F.col("html")))
    if counts is not None:
        trees = trees.observe(counts, F.count(F.lit(1)).alias("n"), F.count("parse_error").alias("rejected"))
    fine = trees.write.mode("overwrite").option("maxRecordsPerFile", FILE_PAGES).option("parquet.block.size", ROW_GROUP)
    fine.partitionBy("page_type").parquet(path)
    return staged_pages(pages.sparkSession, path)


def staged_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGED).parquet(path).select(*PAGES.fieldNames(), *H.TREE_COLUMNS)


def clear_staged(spark: SparkSession, path: str) -> None:
    """Empty a staging table whose batch is through."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(STAGED)]
    spark.range(0, 0, 1, 1).select(*nothing).write.mode("overwrite").parquet(path)
