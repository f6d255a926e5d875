"""Global order without a global task.

Positions, running totals, the nearest earlier row and the first n of a whole table. Rows are dealt out by ranges of
the order, whose bounds Spark samples from the rows themselves: every task gets about as many, however the order's values lie
(in bursts, sparse, strings or numbers). A task sorts its rows and numbers them; the tasks' counts and sums, a row
for each, are added up and handed back. A plain window without a partition would put the whole table into one task.

The dealt rows are written to the shared folder, since what is counted and what is numbered must be the same deal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from campusweave.session import written

#: Rows of a range.
CHUNK = 65_536
#: Ranges at most: their counts are broadcast. Beyond CHUNK times as many rows, ranges grow instead.
MOST_CHUNKS = 20_000


def _dealt(df: DataFrame, order: Sequence[str | Column], width: int) -> tuple[DataFrame, int]:
    """Rows with the number of their range (``_chunk``, rising with the order) and their place in it (``_at``, from 0); the number of ranges."""
    n = df.count()
    chunks = max(1, min(MOST_CHUNKS, -(-n // width)))
    ranged = df.repartitionByRange(chunks, *order) if chunks > 1 else df.repartition(1)
    # the number holds the task's in its upper 31 bits and the row's in the lower 33
    numbered = ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    numbered = numbered.withColumns({"_chunk": F.shiftright("_id", 33).cast("int"), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id")
    return (written(numbered, "ranges") if chunks > 1 else numbered), chunks


def _with_offsets(dealt: DataFrame, values: Mapping[str, Column], total: str | None) -> DataFrame:
    """Add ``_o_<name>``, the sum of each value over all earlier ranges, and the first value's sum over everything."""
    names = list(values)
    sums = dealt.groupBy("_chunk").agg(*[F.sum(v).alias(f"_s_{n}") for n, v in values.items()])
    everything = W.partitionBy(F.lit(0))
    offsets = sums.select(
        "_chunk",
        *[_earlier(F.col(f"_s_{n}"), everything.orderBy("_chunk")).alias(f"_o_{n}") for n in names],
        *([F.sum(f"_s_{names[0]}").over(everything).alias(total)] if total else []),
    )
    return dealt.join(F.broadcast(offsets), "_chunk")  # MOST_CHUNKS rows at most


def with_running_totals(
    df: DataFrame, order: str, values: Mapping[str, Column], total: str | None = None, width: int = CHUNK
) -> DataFrame:
    """Add, for every named value, its sum over all rows that come earlier in ``order``, a column of unique values.

    ``total`` also adds the sum of the first value over the whole table.
    """
    names = list(values)
    dealt, _ = _dealt(df.withColumns({f"_v_{n}": v.cast("bigint") for n, v in values.items()}), [order], width)
    summed = _with_offsets(dealt, {n: F.col(f"_v_{n}") for n in names}, total)
    within = W.partitionBy("_chunk").orderBy("_at")
    return summed.select(
        *df.columns,
        *[(F.col(f"_o_{n}") + _earlier(F.col(f"_v_{n}"), within)).alias(n) for n in names],
        *([total] if total else []),
    )


def _earlier(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def with_position(
    df: DataFrame, order: str | Sequence[str | Column], name: str = "position", total: str | None = None, width: int = CHUNK
) -> DataFrame:
    """Add each row's position, counted from 0, in the given order; equal rows come in any order."""
    dealt, _ = _dealt(df, [order] if isinstance(order, str) else order, width)
    counted = _with_offsets(dealt, {name: F.lit(1)}, total)
    return counted.select(*df.columns, (F.col(f"_o_{name}") + F.col("_at")).alias(name), *([total] if total else []))


def first_n(df: DataFrame, order: Sequence[str | Column], n: int, width: int = CHUNK) -> DataFrame:
    """The first n rows in order, however many these are, in any order; of rows equal in it any.

    The ranges' counts tell which range the n-th row is in: the ranges before it are taken whole, and of it
    the rows up to that place. No task holds more than a range.
    """
    dealt, chunks = _dealt(df, order, width)
    if chunks == 1:
        return dealt.filter(F.col("_at") < n).select(*df.columns)
    last, before = -1, 0
    for chunk, rows in sorted((r["_chunk"], r["rows"]) for r in dealt.groupBy("_chunk").agg(F.count(F.lit(1)).alias("rows")).collect()):
        if before >= n:
            break
        last, left, before = chunk, n - before, before + rows
    if last < 0:
        return dealt.limit(0).select(*df.columns)
    return dealt.filter((F.col("_chunk") < last) | ((F.col("_chunk") == last) & (F.col("_at") < left))).select(*df.columns)


def split_parts(df: DataFrame, parts: int, order: str, width: int = CHUNK) -> DataFrame:
    """Cut a table into contiguous parts of ceil(total / parts) rows; adds ``part``, from 1."""
    chunk = F.call_function("div", F.col("_n") + (parts - 1), F.lit(parts))
    return (
        with_position(df, order, "_position", "_n", width)
        .withColumn("part", (F.call_function("div", F.col("_position"), chunk) + 1).cast("int"))
        .drop("_position", "_n")
    )


def carry(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, forward: bool = True, width: int = CHUNK
) -> DataFrame:
    """Add the nearest earlier (or, with forward=False, later) non-NULL ``value`` of the same key.

    ``order`` is an integer, unique within a key. Rows are dealt out by key and order, so that a key of any size lies in ranges side by
    side. Inside a range a window finds the value; where it has none yet, the row takes what the ranges before it close with, which only the last
    key of a range can hand on: one row a range.
    """
    place = F.col(order).cast("bigint") * (1 if forward else -1)
    dealt, chunks = _dealt(df.withColumns({"_v": value, "_place": place}), [*keys, "_place"], width)
    inner = W.partitionBy("_chunk", *keys).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    near = dealt.withColumn("_near", F.last("_v", ignorenulls=True).over(inner))
    if chunks == 1:
        return near.select(*df.columns, F.col("_near").alias(name))
    closing = dealt.groupBy("_chunk", *keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_at"))).alias("_close"))
    closing = closing.groupBy("_chunk").agg(F.max_by(F.struct(*keys, "_close"), F.struct(*keys)).alias("_last"))
    closing = closing.select((F.col("_chunk") + 1).alias("_next"), *[F.col(f"_last.{k}").alias(f"_key_{k}") for k in keys], "_last._close")
    up_to = W.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_next").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = closing.withColumn("_carried", F.last("_close", ignorenulls=True).over(up_to)).drop("_close")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.col("_chunk") == F.col("_next"))
    joined = near.join(F.broadcast(carried), same, "left")  # MOST_CHUNKS rows at most
    return joined.select(*df.columns, F.coalesce("_near", "_carried").alias(name))


def write_parts(df: DataFrame, parts: int, order: str, path: str, fmt: str = "parquet") -> None:
    """The parts of ``split_parts`` written to a folder each (``part=1`` and so on), rows in order within a file.

    Rows of a part are dealt out by chunks of the order, so that a part is not one task's work.
    """
    cut = split_parts(df, parts, order)
    cut.repartitionByRange("part", order).sortWithinPartitions("part", order).write.mode("overwrite").partitionBy("part").format(fmt).save(path)
