"""Balanced label propagation: documents in shards of equal counts, linked ones together.

Documents with equal texts are linked. They start in shards dealt by a hash. In each turn a group's members
are counted by shard; the fullest shards become its homes, as many as it needs at the capacity of a shard,
and members elsewhere are to move to a home that has room for them. A flow from one shard to another is
granted in full where unlinked documents of the target can give way, in part where they can't, so that sizes
stay level over the turns; which documents move is decided by a hash. A last step ranks each shard with
unlinked documents at the end and moves what is over the exact quota into what is free, so that counts are at most one apart.

What is gathered at the driver is counts by shard pair. Ranks come from counts of hash ranges, so no
task sorts a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusweave.llm.common import cut

TURNS = 4
#: Rows that one hash range of a ranking should hold.
RANGE_ROWS = 20_000


def uniform(*by) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*by), F.lit(1 << 52)).cast("double") / float(1 << 52)


def ranked(df: DataFrame, rows: int, group: str, order: list[str], name: str) -> DataFrame:
    """`df` with the place of each row among its group's rows, from 0, gapless, by `order`; `order` begins with a number in [0, 2).

    The group is cut into ranges of the number; their counts, a small table, give the offsets.
    """
    ranges = max(1, rows // RANGE_ROWS)
    df = df.withColumn("_range", F.floor(F.col(order[0]) * ranges).cast("long"))
    counts = df.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each group and range
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_range").orderBy(*order)
    out = df.withColumn("_at", F.row_number().over(inside) - 1).join(offsets, [group, "_range"])
    return out.withColumn(name, (F.col("_at") + F.col("_before")).cast("long")).drop("_range", "_at", "_before")


def _grant(flows: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Share of each flow (from, to) that is let through: where more come than go, unlinked documents must make room."""
    share = np.ones_like(flows)
    for _ in range(10):
        moved = flows * share
        over = moved.sum(axis=0) - moved.sum(axis=1)
        tight = over > free
        if not tight.any():
            break
        incoming = moved.sum(axis=0)
        cut_by = np.where(tight, np.maximum(0, 1 - (over - free) / np.maximum(incoming, 1)), 1.0)
        share *= cut_by[None, :]
    return share


def shards(docs: DataFrame, n_shards: int, turns: int = TURNS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 16), text_crc32, linked (another row has the text), shard and slot for every row of
    `docs` (doc_id, text); counts of shards differ by one at most and slots of a shard are gapless from 0.

    Null texts count as empty; empty texts are equal texts and so linked. Rows that repeat a doc_id are rows of their
    own. With fewer rows than shards some shards are empty; an empty table gives an empty result.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("h1"),
        F.xxhash64(body, F.lit(1)).alias("h2"),
    )
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = rows.groupBy("size", "h1", "h2").agg(F.count(F.lit(1)).alias("members"))
    total = rows.count()
    u = uniform("doc_id", "row")
    state = rows.join(groups.where("members > 1"), ["size", "h1", "h2"], "left")
    state = state.select("doc_id", "row", "size", "text_crc32", "h1", "h2", F.coalesce("members", F.lit(1)).alias("members"), F.floor(u * n_shards).cast("int").alias("shard"))
    state = cut(state, "state")
    room = max(1, total // n_shards)
    for turn in range(turns):
        state = cut(_turn(state, n_shards, room, turn), "state")
    return _level(state, total, n_shards)


def _turn(state: DataFrame, n_shards: int, room: int, turn: int) -> DataFrame:
    key = ["size", "h1", "h2"]
    cells = state.where("members > 1").groupBy(*key, "members", "shard").agg(F.count(F.lit(1)).alias("n"))
    # a group has a row for each shard at most
    by_group = Window.partitionBy(*key).orderBy(F.desc("n"), F.xxhash64("h1", "shard"))
    before = F.row_number().over(by_group) - 1
    cells = cells.withColumn("want", F.greatest(F.lit(0), F.least(F.lit(room), F.col("members") - before * room)))
    cells = cells.withColumn("surplus", F.greatest(F.lit(0), F.col("n") - F.col("want"))).withColumn("lack", F.greatest(F.lit(0), F.col("want") - F.col("n")))
    # members that are too many, and free places, both laid end to end along the group
    upto = by_group.rowsBetween(Window.unboundedPreceding, 0)
    cells = cut(cells.withColumn("over_to", F.sum("surplus").over(upto)).withColumn("lack_to", F.sum("lack").over(upto)), "cells")
    out = cells.where("surplus > 0").select(*key, "shard", "n", (F.col("over_to") - F.col("surplus")).alias("o1"), F.col("over_to").alias("o2"))
    into = cells.where("lack > 0").select(*key, F.col("shard").alias("to"), (F.col("lack_to") - F.col("lack")).alias("l1"), F.col("lack_to").alias("l2"))
    amount = F.least("o2", "l2") - F.greatest("o1", "l1")
    # both sides hold a row for each shard of a group at most, and the overlaps are as many as the rows
    flows = cut(out.join(into, key).where(amount > 0).select(*key, "shard", "to", "n", F.col("o1"), F.greatest("o1", "l1").alias("f1"), amount.alias("amount")), "flows")
    matrix, free = np.zeros((n_shards, n_shards)), np.zeros(n_shards)
    for r in flows.groupBy("shard", "to").agg(F.sum("amount").alias("n")).collect():
        matrix[r["shard"], r["to"]] = r["n"]
    for r in state.where("members = 1").groupBy("shard").count().collect():
        free[r["shard"]] = r["count"]
    share = _grant(matrix, free)
    moved = matrix * share
    over = moved.sum(axis=0) - moved.sum(axis=1)
    # unlinked documents leave the shards that gain, for those that lose
    leave = np.clip(np.where(over > 0, over, 0) / np.maximum(free, 1), 0, 1)
    lose = np.where(over < 0, -over, 0)
    upper = np.cumsum(lose) / lose.sum() if lose.sum() else np.zeros(n_shards)
    shares = F.array(*(F.lit(float(x)) for x in share.ravel()))
    # of each group and shard: bounds of the part of its members that go to each target
    to = F.struct(((F.col("f1") - F.col("o1")) / F.col("n")).alias("low"), (F.col("amount") / F.col("n") * F.element_at(shares, F.col("shard") * n_shards + F.col("to") + 1)).alias("width"), "to")
    moves = flows.groupBy(*key, "shard").agg(F.collect_list(to).alias("moves"))
    u = uniform("doc_id", "row", F.lit(turn + 1))
    linked = state.where("members > 1").join(moves, [*key, "shard"], "left").withColumn("u", u)
    goes = F.filter("moves", lambda m: (F.col("u") >= m["low"]) & (F.col("u") < m["low"] + m["width"]))
    linked = linked.withColumn("new", F.coalesce(F.try_element_at(goes, F.lit(1))["to"], F.col("shard")))
    single = state.where("members = 1").withColumn("u", u)
    if lose.sum():
        at = uniform("doc_id", "row", F.lit(-turn - 1))
        target = F.coalesce(*(F.when(at < float(upper[s]), s) for s in range(n_shards) if lose[s]), F.col("shard"))
        leaves = F.element_at(F.array(*(F.lit(float(x)) for x in leave)), F.col("shard") + 1)
        single = single.withColumn("new", F.when(F.col("u") < leaves, target).otherwise(F.col("shard")))
    else:
        single = single.withColumn("new", F.col("shard"))
    names = ["doc_id", "row", "size", "text_crc32", "h1", "h2", "members"]
    return linked.select(*names, F.col("new").cast("int").alias("shard")).unionByName(single.select(*names, F.col("new").cast("int").alias("shard")))


def _level(state: DataFrame, total: int, n_shards: int) -> DataFrame:
    """Exact quotas: a shard's rows beyond its quota, unlinked ones first, take the places that others have left."""
    quota = np.full(n_shards, total // n_shards) + (np.arange(n_shards) < total % n_shards)
    have = np.zeros(n_shards, np.int64)
    for r in state.groupBy("shard").count().collect():
        have[r["shard"]] = r["count"]
    # the first half of the range for linked rows, the second for the others
    last = uniform("doc_id", "row", F.lit(99)) + F.when(F.col("members") > 1, 0.0).otherwise(1.0)
    placed = ranked(state.withColumn("place", last), max(1, 2 * total // n_shards), "shard", ["place", "doc_id", "row"], "slot")
    over = np.maximum(have - quota, 0)
    over_before, lack_before = np.cumsum(over) - over, np.cumsum(np.maximum(quota - have, 0)) - np.maximum(quota - have, 0)
    array = lambda x: F.array(*(F.lit(int(v)) for v in x))
    mine = F.col("shard") + 1
    spare = F.element_at(array(over_before), mine) + F.col("slot") - F.element_at(array(quota), mine)
    # of the free places, laid end to end, the one with the row's number among all spare rows
    lacks = [s for s in range(n_shards) if quota[s] > have[s]]
    to = F.coalesce(*(F.when(F.col("spare") < int(lack_before[s] + quota[s] - have[s]), s) for s in lacks)) if lacks else F.col("shard")
    placed = placed.withColumn("spare", F.when(F.col("slot") >= F.element_at(array(quota), mine), spare)).withColumn("to", F.when(F.col("spare").isNotNull(), to))
    target = F.col("to") + 1
    slot = F.element_at(array(have), target) + F.col("spare") - F.element_at(array(lack_before), target)
    return placed.select(
        "doc_id", "size", "text_crc32", (F.col("members") > 1).alias("linked"),
        F.coalesce("to", "shard").cast("int").alias("shard"), F.when(F.col("to").isNotNull(), slot).otherwise(F.col("slot")).cast("long").alias("slot"),
    )
