"""Relational pieces the dataset jobs are made of.

First-wins and top-n are written as a rank that is compared with a constant: Spark then
keeps only the best rows of a key before the shuffle, so a key that holds a third of the
table sends no more than a few rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from campusweave.functions.text import blank_to_null
from campusweave.operators.ordinals import first_n

#: Rows that one task may merge.
MERGED = 10_000


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key; NULL is a key like any other."""
    return top_n(df, order, 1, per=keys)


def top_n(df: DataFrame, order: Sequence[str | Column], n: int, per: Sequence[str | Column] | None = None, merged: int = MERGED) -> DataFrame:
    """First n rows in order, of the table or of every key.

    For the whole table, up to ``merged`` rows (a report) are merged in one task and come in order; more are
    selected by ranges of the order (``ordinals.first_n``) and come in any.
    """
    if per is None:
        return df.orderBy(*_columns(order)).limit(n) if n <= merged else first_n(df, _columns(order), n)
    window = W.partitionBy(*_columns(per)).orderBy(*_columns(order))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def without_known(df: DataFrame, known: DataFrame, keys: Sequence[str], nulls_match: bool = False) -> DataFrame:
    """Rows whose key is not known yet."""
    if not nulls_match:
        return df.join(known.select(*keys), list(keys), "left_anti")
    right = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return df.join(right, same, "left_anti")


def fallback_chain(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Per key, the rows of the lowest-numbered source that has any.

    The best source per key is pre-aggregated; the rows are then kept by a semi join, whose
    skewed side Spark can split. A window over the key would hold a hot key in one task.
    """
    best = df.groupBy(*keys).agg(F.min(priority).alias(priority))
    return without_nulls_lost(df, best, [*keys, priority])


def without_nulls_lost(df: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Semi join in which NULL keys match each other."""
    right = kept.select(*[F.col(k).alias(f"_kept_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_kept_{k}")) for k in keys])
    return df.join(right, same, "left_semi")


def merge_append(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True)


def explode_nested(df: DataFrame, column: str, position: str = "position", item: str = "item") -> DataFrame:
    """One row per array item, index kept, missing items skipped."""
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.posexplode(column).alias(position, item)).filter(F.col(item).isNotNull())


def apply_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Put the sentinel where a column is NULL or empty."""
    return df.withColumns({c: F.coalesce(blank_to_null(F.col(c)), F.lit(v)) for c, v in defaults.items()})


def truncate_columns(df: DataFrame, caps: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.substring(F.col(c), 1, n) for c, n in caps.items()})


def counts(df: DataFrame, by: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Row count and conditional counts per key."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def entity_slices(datasets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """All datasets as one table (key, dataset, row as JSON): what one entity's export holds.

    Rows stay rows. An array per entity would have to fit into one task.
    """
    parts = [
        df.select(F.col(key).cast("string").alias(key), F.lit(name).alias("dataset"), F.to_json(F.struct("*")).alias("record"))
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.union, parts)


def entity_counts(datasets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows per entity and dataset, counted before the shuffle."""
    parts = [
        df.groupBy(F.col(key).cast("string").alias(key)).agg(F.count(F.lit(1)).alias("n_rows")).select(key, F.lit(name).alias("dataset"), "n_rows")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.union, parts)


def empty_marker(df: DataFrame, key: str, mark: str = "No Data Available", status: str = "Check Logs") -> DataFrame:
    """One marker row if the table has no rows, else none."""
    none = df.limit(1).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0)
    return none.select(F.lit(mark).alias(key), F.lit(status).alias("status"))


def with_placeholder(df: DataFrame, key: str, entities: DataFrame | None = None) -> DataFrame:
    """Add a marker row for an empty table, or for every entity that has no row in it."""
    if entities is None:
        marker = empty_marker(df, key)
    else:
        keys = entities.select(F.col(key).cast("string").alias(key)).distinct()
        have = df.select(F.col(key).cast("string").alias(key)).distinct()
        marker = keys.join(have, key, "left_anti").withColumn("status", F.lit("No Data Available"))
    return df.withColumn(key, F.col(key).cast("string")).unionByName(marker, allowMissingColumns=True)


def column_widths(df: DataFrame) -> DataFrame:
    """Display width per column: longest text, header included, plus 3; at least 12.

    All columns in one aggregation over one scan.
    """
    def longest(name: str) -> Column:
        text = F.col(name).cast("string")
        shown = F.when(text.isin("0", "0.0", "false"), 0).otherwise(F.length(text))
        return F.max(F.coalesce(shown, F.lit(0)))

    row = df.agg(*[longest(c).alias(c) for c in df.columns])
    width = [
        F.struct(F.lit(c).alias("column_name"), F.greatest(F.coalesce(F.greatest(F.col(c), F.lit(len(c))), F.lit(len(c))) + 3, F.lit(12)).alias("width"))
        for c in df.columns
    ]
    return row.select(F.explode(F.array(*width)).alias("w")).select("w.*")


def sort_entities(df: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Order by keys compared as strings."""
    return df.orderBy(*[F.col(k).cast("string") for k in keys])
