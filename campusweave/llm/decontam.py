"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions throughout.

A window is a run of as many words as an item has. A window reaches the least similarity only if it holds
so many shingles of items of its size, wherever they stand in the item; all windows that hold as many are
taken, over whole texts, so that an item whose parts are reordered is met too. Their 64-bit SimHash fingerprints (over
words, weighted by count) are compared with the items' by a multi-index: 64 bits in RADIUS + 1 blocks, so
that two fingerprints within RADIUS agree in a block at least. Pairs within RADIUS are verified by the exact
weighted similarity of their five-word shingles, the sum of least counts over the sum of greatest.

The items' shingles are sent to all tasks if they are few by count (BROADCAST_ROWS), else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.llm.common import cut

SHINGLE, PERCENT = 5, 75
#: A window and an item at the threshold differ in a seventh of their words at most: 10 of 64 bits expected; 20 leaves three deviations.
RADIUS = 20
#: Rows of two numbers that may be broadcast; about 16 MB.
BROADCAST_ROWS = 500_000
SPACES = " \t\n\r\f\x0b"
LANES = 0x0001000100010001


def hashes(text: Column) -> Column:
    """Hashes of a text's lower-cased words in order; empty for null."""
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(plain, r"[ \t\n\r\f\x0b]+"), lambda w: F.xxhash64(w)))


def shingled(words: Column, n: int = SHINGLE) -> Column:
    """Hashes of each n words in order; of fewer words none."""
    size = F.size(words)
    return F.when(size >= n, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))).otherwise(F.array().cast("array<bigint>"))


def own_shingles(words: Column, n: int = SHINGLE) -> Column:
    """Shingles; fewer than n words are one shingle as a whole."""
    short = F.aggregate(words, F.size(words).cast("long"), lambda h, w: F.xxhash64(h, w))
    return F.when(F.size(words) >= n, shingled(words, n)).when(F.size(words) > 0, F.array(short)).otherwise(F.array().cast("array<bigint>"))


def fingerprint(words: Column) -> Column:
    """64-bit SimHash: a bit is set if it is in the hashes of more than half of the words.

    Four counts share a number: bits g, g + 16, g + 32 and g + 48 are counted in its 16-bit lanes (up to 32,767 words).
    """
    out = F.lit(0).cast("long")

    def lanes(g: int) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda total, h: total + F.shiftrightunsigned(h, g).bitwiseAND(F.lit(LANES)))

    for g in range(16):
        count = lanes(g)
        for lane in range(4):
            ones = F.shiftrightunsigned(count, 16 * lane).bitwiseAND(F.lit(0xFFFF))
            out = out.bitwiseOR(F.when(2 * ones > F.size(words), F.shiftleft(F.lit(1).cast("long"), g + 16 * lane)).otherwise(F.lit(0).cast("long")))
    return out


def blocks(fp: Column, radius: int) -> Column:
    """(block, value) of the radius + 1 parts of a fingerprint."""
    n, at, parts = radius + 1, 0, []
    for b in range(n):
        width = 64 // n + (b < 64 % n)
        mask = (1 << width) - 1
        parts.append(F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit(mask)).alias("value")))
        at += width
    return F.array(*parts)


def overlap(a: Column, b: Column) -> Column:
    """Sum over shingles of the lesser count in both."""

    def times(x, of):
        return F.size(F.filter(of, lambda y: y == x))

    plain = F.size(F.array_intersect(a, b))
    single = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda total, x: total + F.least(times(x, a), times(x, b)))
    return F.when(single, plain).otherwise(counted)


def item_table(items: DataFrame) -> DataFrame:
    """item_id, words, size, shingles and fingerprint of items that have words."""
    words = items.select(F.col("item_id").cast("long"), hashes(F.col("text")).alias("words")).where(F.size("words") > 0)
    return words.select("item_id", "words", F.size("words").alias("size"), own_shingles(F.col("words")).alias("shingles"), fingerprint(F.col("words")).alias("fingerprint"))


def bounded(df: DataFrame) -> DataFrame:
    """A written table with a hint to broadcast it, if its count allows that."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def starts(places: Column, length: Column, size: Column, n: int, percent: int) -> Column:
    """Starts of all windows of `size` words that hold enough of the sorted `places` of n-word shingles to be similar.

    Of K and L shingles at least percent * (K + L) / (100 + percent) must be shared. Windows that hold the places i to
    i + need - 1 start in a range; both ends of the ranges rise with i, so each takes what lies after the one before.
    """
    own, last = size - n + 1, F.greatest(F.lit(0), length - size)
    need = F.ceil(percent * (own + F.least(length, size) - n + 1) / F.lit(100 + percent)).cast("int")

    def span(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.get(places, i + need - 1) - own + 1, F.when(i > 0, F.least(F.get(places, i - 1), last) + 1).otherwise(0))
        high = F.least(F.get(places, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(places) >= need, F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - need), span))).otherwise(F.array().cast("array<int>"))


def windows(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text hash, start, size: item-sized windows of `docs` that hold enough shingles of items of that size.

    A text shorter than the item is one window.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), hashes(F.col("text")).alias("words"))
    lengths = [r[0] for r in items.select(F.least("size", F.lit(SHINGLE))).distinct().collect()]  # from 1 to SHINGLE
    out = None
    for n in sorted(lengths):
        of = items.where(F.least("size", F.lit(SHINGLE)) == n).select("size", F.explode(shingled(F.col("words"), n)).alias("shingle"))
        anchors = bounded(cut(of.distinct(), "anchors"))
        here = rows.select("doc_id", "key", F.size("words").alias("length"), F.posexplode(shingled(F.col("words"), n)).alias("place", "shingle"))
        met = here.join(anchors, "shingle").groupBy("doc_id", "key", "length", "size").agg(F.sort_array(F.collect_set("place")).alias("places"))
        found = met.select("doc_id", "key", "size", F.explode(starts(F.col("places"), F.col("length"), F.col("size"), n, percent)).alias("start"))
        out = found if out is None else out.union(found)
    return out if out is not None else rows.select("doc_id", "key", F.lit(0).alias("size"), F.lit(0).alias("start")).where("false")


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """One row for each document and item it holds: doc_id, item_id, start_word, n_words, distance and similarity of the most
    similar window (the first one of equals).

    docs: doc_id, text; items: item_id, text. Null and empty texts and items match nothing. Items of fewer than five words are one
    shingle and must be held whole. Rows that repeat a doc_id count together. Empty tables give an empty result.
    """
    known = cut(item_table(items), "items")
    at = cut(windows(docs, known, percent), "windows")
    held = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text").join(at.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "size")).alias("at")), ["doc_id", "key"])
    held = held.select("doc_id", hashes(F.col("text")).alias("all"), "at").select("doc_id", "all", F.explode("at").alias("w"))
    held = held.select("doc_id", F.col("w.start").alias("start"), F.col("w.size").alias("size"), F.slice("all", F.col("w.start") + 1, F.col("w.size")).alias("words"))
    held = cut(held.select("doc_id", "start", "size", F.size("words").alias("n_words"), own_shingles(F.col("words")).alias("shingles"), fingerprint(F.col("words")).alias("fingerprint")), "held")
    left = held.select("doc_id", "start", "size", "n_words", "fingerprint", "shingles", F.explode(blocks(F.col("fingerprint"), radius)).alias("b"))
    right = known.select("item_id", "size", F.col("fingerprint").alias("other"), F.col("shingles").alias("own"), F.explode(blocks(F.col("fingerprint"), radius)).alias("b"))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")))
    # a pair is taken in the first block in which it agrees
    agree = F.zip_with(blocks(F.col("fingerprint"), radius), blocks(F.col("other"), radius), lambda x, y: x == y)
    near = left.join(bounded(cut(right, "blocks")), ["size", "b"]).where(distance <= radius).where(F.array_position(agree, True) == F.col("b.block") + 1)
    same = overlap(F.col("shingles"), F.col("own"))
    total = F.size("shingles") + F.size("own") - same
    near = near.select("doc_id", "item_id", "start", "n_words", distance.alias("distance"), same.alias("same"), total.alias("total")).where("same > 0").where(100 * F.col("same") >= percent * F.col("total"))
    best = F.min(F.struct((-F.col("same") / F.col("total")).alias("order"), "start", "n_words", "distance")).alias("best")
    return near.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("best.start").alias("start_word"), "best.n_words", "best.distance", (-F.col("best.order")).alias("similarity"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id holds no item."""
    return docs.join(contaminated(docs, items).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
