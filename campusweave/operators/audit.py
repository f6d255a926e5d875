"""Counts and checks over what was collected."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusweave.functions.text import first_match
from campusweave.operators.ordinals import with_running_totals
from campusweave.operators.relational import first_wins, top_n
from campusweave.rules import vocab as V
from campusweave.rules.patterns import LOG_LINE
from campusweave.schemas import PAGE_TYPES


def audit_dirty_urls(listing: DataFrame, column: str = "url", pattern: str = V.AUDIT_SUBPAGE_URL) -> DataFrame:
    """How many addresses there are and how many of them are subpages."""
    return listing.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(column).rlike(pattern)).alias("dirty"))


def dirty_url_samples(listing: DataFrame, n: int = 5, column: str = "url", order: str = "ordinal", pattern: str = V.AUDIT_SUBPAGE_URL) -> DataFrame:
    return top_n(listing.filter(F.col(column).rlike(pattern)), [order], n)


def pending_by_id(listing: DataFrame, saved: DataFrame, ident: str = "id", order: str = "ordinal") -> DataFrame:
    """The last address of every id that has no saved page."""
    known = listing.withColumn(ident, first_match(F.col("url"), r"/(\d+)-")).filter(F.col(ident).isNotNull())
    return first_wins(known, [ident], [F.col(order).desc()]).join(saved.select(ident), ident, "left_anti")


def audit_pending(listing: DataFrame, saved: DataFrame, ident: str = "id", order: str = "ordinal") -> DataFrame:
    return pending_by_id(listing, saved, ident, order).agg(F.count(F.lit(1)).alias("pending"))


def pending_samples(listing: DataFrame, saved: DataFrame, n: int = 3, ident: str = "id", order: str = "ordinal") -> DataFrame:
    return top_n(pending_by_id(listing, saved, ident, order), [order], n)


def audit_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per dataset."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows") for name, df in datasets.items()]
    return reduce(DataFrame.union, parts)


def audit_stored(spark: SparkSession, readers: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Rows per stored dataset; one that cannot be opened gets an error instead of a count."""
    schema = "dataset string, n_rows bigint, error string"
    parts = []
    for name, read in readers.items():
        try:
            part = read().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows", F.lit(None).cast("string").alias("error"))
        except PySparkException as problem:
            part = spark.createDataFrame([(name, None, problem.getCondition() or "ERROR")], schema)
        parts.append(part)
    return reduce(DataFrame.union, parts)


def audit_completeness(pages: DataFrame, ident: str = "college_id", page_type: str = "page_type", expected: Sequence[str] = PAGE_TYPES) -> DataFrame:
    """Per entity: how many expected page types are there and which are missing, in fixed order.

    One flag per type, merged before the shuffle; no set is collected.
    """
    flags = [F.bool_or(F.col(page_type) == t).alias(f"_{i}") for i, t in enumerate(expected)]
    have = [F.coalesce(F.col(f"_{i}"), F.lit(False)) for i in range(len(expected))]
    missing = F.concat_ws(", ", *[F.when(~h, F.lit(t)) for h, t in zip(have, expected)])
    present = reduce(lambda a, b: a + b, [h.cast("int") for h in have])
    return pages.groupBy(ident).agg(*flags).select(ident, present.alias("present"), missing.alias("missing"), (present == len(expected)).alias("complete"))


def completeness_totals(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("entities"),
        F.coalesce(F.count_if("complete"), F.lit(0)).alias("complete"),
        F.coalesce(F.count_if(~F.col("complete")), F.lit(0)).alias("partial"),
    )


def incomplete_samples(audit: DataFrame, n: int = 10, ident: str = "college_id") -> DataFrame:
    return top_n(audit.filter(~F.col("complete")), [ident], n)


def batch_progress(fetches: DataFrame, batch: str = "batch", saved: str = "saved") -> DataFrame:
    """Per batch: saved and skipped before it, in it and after it."""
    per = fetches.groupBy(batch).agg(F.count_if(F.col(saved)).alias("new_saved"), F.count_if(~F.col(saved)).alias("new_skipped"))
    per = with_running_totals(per, batch, {"saved_before": F.col("new_saved"), "skipped_before": F.col("new_skipped")})
    return per.withColumns(
        {
            "saved_after": F.col("saved_before") + F.col("new_saved"),
            "skipped_after": F.col("skipped_before") + F.col("new_skipped"),
        }
    )


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Run-log lines to columns, with the kind of event each one reports."""
    part = {name: first_match(F.col(column), LOG_LINE, g) for g, name in enumerate(["logged_at", "level", "source", "line", "message"], 1)}
    parsed = lines.withColumns(part).filter(F.col("logged_at").isNotNull())
    text = F.col("message")
    # fixed values: wording of the fetch log
    kind = (
        F.when(text.rlike(r"HTTP (404|410) NOT FOUND"), "removed")
        .when(text.rlike(r"HTTP (404|410): subpage"), "absent")
        .when(text.contains("Blocked/error HTTP") | text.contains("Block/error page detected"), "blocked")
        .when(text.contains("Successfully saved"), "saved")
        .otherwise("other")
    )
    return parsed.withColumns({"logged_at": F.to_timestamp_ntz("logged_at", F.lit("yyyy-MM-dd HH:mm:ss")), "line": F.col("line").cast("int"), "kind": kind})


def log_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    return parse_logs(lines, column).groupBy("level", "kind").agg(F.count(F.lit(1)).alias("n_lines"))
