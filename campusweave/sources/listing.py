"""Listing files in and out."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusweave.operators.relational import first_wins
from campusweave.schemas import LISTING_COLUMNS


def normalize_header(df: DataFrame) -> DataFrame:
    """Header names without byte-order mark, quotes, blanks and case."""
    return df.toDF(*[c.replace('"', "").replace("﻿", "").strip().lower() for c in df.columns])


def tidy_listing(rows: DataFrame, order: list[str]) -> DataFrame:
    """Trimmed listing columns; rows without an address dropped; the last row of an address wins."""
    present = [F.coalesce(F.trim(c), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in LISTING_COLUMNS]
    trimmed = rows.select(*present, *order).filter(F.col("url") != "")
    return first_wins(trimmed, ["url"], [F.col(c).desc() for c in order])


#: Up to so many listing files are told apart; with more all of them are read whole.
FILES = 10_000


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Listing CSV with a header. ``ordinal`` keeps the order of the rows.

    Quotes are doubled inside quoted fields, which may hold commas and line breaks. Where a field is broken, its lines
    hold odd numbers of quotes: files without such a line are cut into splits, and only the others are each read whole by one task,
    as a break inside a field cannot be told from the end of a row otherwise.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).alias("odd"))
    files = lines.groupBy("file").agg(F.bool_or("odd").alias("odd")).limit(FILES + 1).collect()
    known = len(files) <= FILES
    groups = [[path]] if not known or not files else [[unquote(f["file"]) for f in files if f["odd"] == odd] for odd in (False, True)]
    parts = [_read_files(spark, group, i == 1 or len(groups) == 1) for i, group in enumerate(groups) if group]
    return tidy_listing(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), ["ordinal"])


def _read_files(spark: SparkSession, paths: list[str], whole: bool) -> DataFrame:
    raw = normalize_header(spark.read.option("header", True).option("escape", '"').option("multiLine", whole).csv(paths))
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    present = [c for c in raw.columns if c in LISTING_COLUMNS]
    return raw.select(*present, F.struct(*[p.alias(f"p{i}") for i, p in enumerate(place)]).alias("ordinal"))


def write_listing(listing: DataFrame, path: str, order: str = "ordinal") -> None:
    """Listing CSV with its fixed columns, blanks for what is missing, in discovery order."""
    cells = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in listing.columns else F.lit("").alias(c) for c in LISTING_COLUMNS]
    listing.orderBy(order).select(*cells).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
