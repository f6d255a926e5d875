"""Classes of linked ids, and links found from buckets of a similarity index.

A bucket of n members is never spelt out as n * n pairs. Its members are compared with a pivot; those
found alike are in one class, and two members of one class need not meet. Of the members of different
classes only those go on that can be alike by what is known of them and the pivot; none is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import FILTER, by_step, counts, cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in `edges` (a, b): component is the smallest id reachable.

    Least labels go along edges and then to the label's own label, so that a chain is halved in each turn.
    Each turn is a written table. Empty edges give no rows; null ends and loops are left out.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    both = cut(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        found = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jump = found.join(labels.select(F.col("id").alias("to"), F.col("label").alias("beyond")), "to", "left")
        turn = cut(jump.select("id", "old", F.least("to", F.coalesce("beyond", "to")).alias("label")), "labels")
        labels = turn.select("id", "label")
        if turn.where("label < old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (id, component) with more links (a, b): only the classes that the links bring together are gone through."""
    of = lambda c: classes.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    top = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))).withColumnRenamed("component", "to")
    fresh = links.select("a").union(links.select("b")).distinct().withColumnRenamed("a", "id").join(classes.select("id"), "id", "left_anti")
    known = classes.union(fresh.select("id", F.col("id").alias("component")))
    return cut(known.join(top.withColumnRenamed("id", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component")), "classes")


@dataclass
class Sets:
    """How links are told: `load` gives the contents (id, content) of ids (id), or of more, `read` turns such a column into sets."""

    load: Callable[[DataFrame], DataFrame]
    read: Callable[[pa.Array], list[np.ndarray]]
    percent: int

    def attached(self, pairs: DataFrame, known: DataFrame) -> DataFrame:
        """Pairs (a, b) with both contents. The plan is one of shuffles at any size; one key's many pairs are split by the skew join."""
        left, right = known.select(F.col("id").alias("a"), F.col("content").alias("left")), known.select(F.col("id").alias("b"), F.col("content").alias("right"))
        return cut(pairs, "pairs").join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left", "right")

    def compared(self, pairs: DataFrame, known: DataFrame) -> DataFrame:
        """(a, b, size_a, size_b, same) of pairs (a, b)."""
        read = self.read

        def run(batch):
            left, right = read(batch.column("left")), read(batch.column("right"))
            same = [_common(x, y) for x, y in zip(left, right, strict=True)]
            columns = [pa.array(c, pa.int64()) for c in ([len(x) for x in left], [len(y) for y in right], same)]
            return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], ["a", "b", "size_a", "size_b", "same"])

        return by_step(self.attached(pairs, known), run, "a long, b long, size_a long, size_b long, same long", "right")

    def alike(self) -> Column:
        return (F.col("same") > 0) & ((100 + self.percent) * F.col("same") >= self.percent * (F.col("size_a") + F.col("size_b")))

    def rests(self, pairs: DataFrame, known: DataFrame) -> DataFrame:
        """(id, least, size, same, keys) of pairs (a, b): the items of b that a lacks, as keys of a and item, and of how many of them a partner of b must have its share.

        Two sets that are alike have (100 + p) * common >= p * (sizes); what they do not have in common with a must make up the rest.
        So they share r items (`least`) at least that a lacks. size and same are of b, and of what it shares with a.
        """
        read, p = self.read, self.percent

        def run(batch):
            pivot = words.mix(batch.column("a").to_numpy().view(np.uint64))
            keys, ids, facts = [], [], []
            for seed, b, x, y in zip(pivot, batch.column("b").to_pylist(), read(batch.column("left")), read(batch.column("right")), strict=True):
                rest = np.setdiff1d(y, x, assume_unique=True)
                least = max(1, -(-(p * len(y)) // 100) - (len(y) - len(rest)))
                if len(rest) >= least:
                    keys.append(words.signed(words.mix(words.mix(rest) ^ seed)))
                    ids.append(b)
                    facts.append((least, len(y), len(y) - len(rest)))
            if not keys:
                return None
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int32()) for c in zip(*facts, strict=True)), words.lists(keys, pa.int64())], ["id", "least", "size", "same", "keys"])

        return by_step(self.attached(pairs, known), run, "id long, least int, size int, same int, keys array<long>", "right")


def first_keys(rests: DataFrame) -> DataFrame:
    """(key, id, least, size, same): of n keys the n - least + 1 that come least often, as one of these is shared with a partner.

    Common keys come last, so that few meet in one. The order is that of counts in cells of a table of fixed size, then of the keys;
    any order that is the same for all is right. A key that is alone in its cell is alone, and is left out.
    """
    often = rests.sparkSession.sparkContext.broadcast(counts(rests.select(F.explode("keys").alias("key"))))  # of fixed size

    def run(batch):
        lists = batch.column("keys")
        ends, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
        n = often.value[flat % FILTER]
        row = np.repeat(np.arange(len(lists)), np.diff(ends))
        order = np.lexsort((flat, n, row))
        place = np.arange(len(flat)) - ends[row]  # rows keep their stretches
        taken = order[(place <= (np.diff(ends) - batch.column("least").to_numpy())[row]) & (n[order] > 1)]
        some = pa.array(row[taken])
        return pa.RecordBatch.from_arrays([pa.array(flat[taken]), *(batch.column(c).take(some) for c in ("id", "least", "size", "same"))], ["key", "id", "least", "size", "same"])

    return by_step(rests, run, "key long, id long, least int, size int, same int", "keys")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    merged = np.sort(np.concatenate([x, y]))
    return int((merged[1:] == merged[:-1]).sum())


def linked(buckets: DataFrame, sets: Sets) -> DataFrame:
    """(id, component) of ids that share a bucket with one they are alike to; ids without a link give no row.

    buckets: (key, id), each id once in a key. The classes are those of all alike pairs that share a bucket:

    1. Members of a bucket are compared with its pivot, the member that meets most others in all its buckets.
    2. Members x and y that are in different classes then have common(x, y) <= min(common(x, pivot), common(y, pivot)) + items
       that both have and the pivot lacks. Either there are such items: they are buckets of their own (`first_keys`), treated
       by pivots and, for what is still apart, pair by pair.
    3. Or there are none: then the sizes must be small for what is shared with the pivot, which a join on size ranges finds.
    """
    members = _with_pivots(buckets)
    content = cut(sets.load(members.select("id").distinct()), "contents")
    first = cut(sets.compared(_to_pivot(members), content), "compared")
    links = first.where(sets.alike()).select("a", "b")
    classes = components(links)
    now = _open(members, classes)
    if now.isEmpty():
        return classes
    now = cut(now, "open")
    known = first.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "size_a", F.col("size_b").alias("size"), "same", sets.alike().alias("alike"))
    held = cut(now.join(known, ["pivot", "id"]), "held")
    rests = cut(sets.rests(held.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), content), "rests")
    beyond = cut(first_keys(rests), "beyond")
    inner = _with_pivots(_open(beyond.select("key", "id").distinct(), classes).select("key", "id"))
    by_size = _by_size(held, sets.percent)
    # one comparison for both, as pairs that are met in either way
    more = cut(sets.compared(_pairs(_to_pivot(inner).union(by_size)), content).where(sets.alike()).select("a", "b"), "links")
    classes = joined(classes, more)
    rest = _open(inner, classes).where("id <> pivot")
    if rest.isEmpty():
        return classes
    # A pair meets in the least key that both have, once. Keys are the rarest of the items that the outer pivot lacks: of the member whose
    # last key comes first, all shared items up to there are among the common keys, and least - 1 at most come after it. Only keys that are
    # still open count: two in different classes have no other in common but those of which one is the pivot, and these were compared.
    rest = cut(rest, "rest")
    keys = rest.groupBy("id").agg(F.collect_set("key").alias("keys"))
    facts = beyond.groupBy("key", "id").agg(F.max("least").alias("least"), F.max("size").alias("size"), F.max("same").alias("same"))
    rest = cut(rest.join(facts, ["key", "id"]).join(keys, "id"), "open")
    left = rest.select("key", F.col("class").alias("other"), F.col("id").alias("a"), F.col("keys").alias("own"), F.col("least").alias("least_a"), F.col("size").alias("size_a"), F.col("same").alias("same_a"))
    p = sets.percent
    enough = f"{100 + p} * least(size, size_a, size(array_intersect(own, keys)) + greatest(least, least_a) - 1 + least(same, same_a)) >= {p} * (size + size_a)"
    apart = left.hint("merge").join(rest, "key").where(f"class <> other and a < id and array_min(array_intersect(own, keys)) = key and {enough}")
    apart = apart.select("a", F.col("id").alias("b"))
    return joined(classes, cut(sets.compared(apart, content).where(sets.alike()).select("a", "b"), "links"))


def _with_pivots(buckets: DataFrame) -> DataFrame:
    """(key, id, pivot) of the buckets with more than one member."""
    many = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(buckets.join(many, "key"), "members")
    known = members.join(members.groupBy("id").agg(F.sum("n").alias("met")), "id")
    top = known.groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("least"))).alias("top"))
    return cut(members.select("key", "id").join(top.select("key", (-F.col("top.least")).alias("pivot")), "key"), "members")


def _to_pivot(members: DataFrame) -> DataFrame:
    return members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()


def _by_size(held: DataFrame, p: int) -> DataFrame:
    """Pairs of a bucket, one of them not alike to the pivot, whose sizes allow that all they share is the pivot's."""
    limit = F.floor(((100 + p) * F.col("same") - p * F.col("size")) / p)
    held = held.withColumn("limit", limit).select("key", "id", "class", "size", "limit", "alike")
    step = lambda c: F.floor(16 * F.log2(c)).cast("int")
    low = F.ceil(p * F.col("size") / 100)
    lone = held.where(~F.col("alike")).where(F.col("limit") >= low)
    lone = lone.select("key", F.col("id").alias("a"), F.col("class").alias("other"), F.col("size").alias("own"), F.col("limit").alias("most"), F.explode(F.sequence(step(low), step(F.col("limit")))).alias("step"))
    near = held.where("limit > 0").withColumn("step", step(F.col("size")))
    met = lone.join(near, ["key", "step"]).where("class <> other and a <> id and size <= most and own <= limit")
    return met.select("a", F.col("id").alias("b")).distinct()


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _open(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members, with their class, of the buckets that hold more than one class."""
    known = cut(members.join(classes, "id", "left").select(*members.columns, F.coalesce("component", "id").alias("class")), "known")
    mixed = known.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("key")
    return known.join(mixed, "key", "left_semi")
