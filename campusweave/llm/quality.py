"""Quality by importance resampling (Xie et al., 2023).

Two bag models over hashed n-grams, one of target texts and one of all raw texts, give each text the log
ratio of its probabilities. A sample of the k best of log ratio plus Gumbel noise is a sample without
replacement by importance. n-grams are words, pairs of words, word shapes (letters, capitals, digits and
each sign, runs as one) and pairs of shapes, the latter apart where a word repeats the one before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import by_step, cut, steps, texts

BUCKETS = 1 << 16
#: Labelled texts that the target model is counted from, at most; chosen by a hash of doc_id.
TARGET_ROWS = 20_000
SMOOTHING = 1.0
#: A text is passed over only if the raw model explains it a thousand times better than the target model.
MARGIN = math.log(1000)
#: Rows that the driver may read to set the exact cut, and bins of a histogram.
CUT_ROWS, BINS = 10_000, 4096
NOISE = "_gumbel_noise"
U = np.uint64

KIND = np.arange(256, dtype=np.int64)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = 1, 2, 3, 2
KINDS = words.seeds(256, 99)


def shapes(raw: np.ndarray, w: words.Words) -> np.ndarray:
    """Hash of each word's shape: its kinds of characters with runs as one."""
    kind = KIND[raw]
    lead = np.ones(len(raw), bool)
    lead[1:] = kind[1:] != kind[:-1]
    lead[w.start] = True
    place = np.concatenate([[0], np.cumsum(lead)])
    up, down = words.powers(int(place[-1]) + 1)
    total = np.concatenate([[U(0)], np.cumsum(np.where(lead, KINDS[kind] * up[place[:-1]], U(0)), dtype=U)])
    return words.mix((total[w.end] - total[w.start]) * down[place[w.start]])


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, four for each word, and the text number of each."""
    raw, _ = words.buffers(column)
    w = words.split(column, lower=False)
    n = len(w.hash)
    before = np.concatenate([[U(1)], w.hash[:-1]]) if n else w.hash
    form = shapes(raw, w)
    last = np.concatenate([[U(1)], form[:-1]]) if n else form
    first = w.first[:-1][np.diff(w.first) > 0]
    before[first] = last[first] = U(1)
    kinds = [w.hash, words.mix(before) ^ w.hash, form + U(3), words.mix(last) ^ (form + (before == w.hash).astype(U))]
    bucket = np.concatenate([words.mix(k + seed) % U(BUCKETS) for k, seed in zip(kinds, words.seeds(len(kinds), 55), strict=True)]).astype(np.int64)
    return bucket, np.tile(w.doc, len(kinds))


def counted(rows: DataFrame) -> DataFrame:
    """(bucket, n) over whole texts: a task sums what it reads and gives each bucket once."""

    def run(batches):
        count = np.zeros(BUCKETS, np.int64)
        for batch in steps(batches):
            count += np.bincount(grams(batch.column("text"))[0], minlength=BUCKETS)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held])], ["bucket", "n"])

    return rows.mapInArrow(run, "bucket int, n long")


def model(rows: DataFrame) -> np.ndarray:
    """Counts by bucket over whole texts; the driver gets one row for each bucket."""
    out = np.zeros(BUCKETS)
    for r in counted(rows).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Natural log of the target's probability over the raw one's, by bucket; without target texts nothing tells."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    # the target's counts are smoothed towards the raw distribution, with as much mass as there are buckets
    p = (target + SMOOTHING * BUCKETS * q) / (target.sum() + SMOOTHING * BUCKETS)
    return np.log(p) - np.log(q)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratios by bucket: target texts are those labelled quality 1, at most `rows`; raw texts are all of `docs`.

    Labels that are null, disagree for a doc_id or are of unknown documents are not used.
    """
    good = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality = 1")
    sample = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")
    return log_ratio(model(texts(docs).join(F.broadcast(sample), "doc_id")), model(texts(docs)))  # at most `rows` ids


def gumbel() -> Column:
    """Gumbel noise that follows from doc_id and text alone."""
    u = (F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def weighed(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_ratio and gumbel_key for every row of `docs`; log_ratio and key are null for a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # one number for each bucket

    def run(batch):
        bucket, text = grams(batch.column("text"))
        n = np.bincount(text, minlength=batch.num_rows)
        total = np.bincount(text, shared.value[bucket], batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(total, pa.float64(), mask=n == 0), batch.column("noise")], ["doc_id", "n_grams", "log_ratio", "noise"])

    noised = docs.select("doc_id", "text").withColumn("noise", gumbel())
    out = by_step(texts(noised, "noise"), run, "doc_id long, n_grams long, log_ratio double, noise double")
    return out.select("doc_id", "n_grams", "log_ratio", (F.col("log_ratio") + F.col("noise")).alias("gumbel_key"))


def threshold(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column: histograms narrow the range down until few rows are left to read."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return float("inf")
    if k >= n:
        return low
    c = F.col(column)
    above = 0  # rows over `high`
    while n > CUT_ROWS and high > low:
        width = (high - low) / BINS
        if low + width == low:
            return low
        bin_of = F.least(F.floor((c - low) / width), F.lit(BINS - 1))
        bins = rows.where((c >= low) & (c <= high)).groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).collect()
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high, n = r["low"], r["high"], r["n"]
                break
            above += r["n"]
    inside = [r[0] for r in rows.where((c >= low) & (c <= high)).select(c).orderBy(c.desc()).limit(min(k - above, CUT_ROWS)).collect()]
    return inside[-1]


def sampled(docs: DataFrame, ratio: np.ndarray, k: int | None = None) -> DataFrame:
    """`weighed` with kept: whether the row is among the k of greatest gumbel_key, rows that tie with the last one included.

    Without k it is the number of rows with a log_ratio over -MARGIN (all if nothing tells).
    Null and empty texts are never kept; rows that repeat doc_id and text tie. An empty table gives an empty result.
    """
    found = cut(weighed(docs, ratio), "weighed")
    return found.withColumn("kept", F.coalesce(F.col("gumbel_key") >= least_kept(found, k), F.lit(False)))


def least_kept(found: DataFrame, k: int | None = None) -> float:
    """The gumbel_key of the last row that is kept."""
    k = found.where(F.col("log_ratio") > -MARGIN).count() if k is None else k
    return threshold(found.where("n_grams > 0"), "gumbel_key", k)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, each judged by its own doc_id and text, in a scan of its own: no text is shuffled."""
    ratio = learn(docs, labels)
    least = least_kept(cut(weighed(docs, ratio), "weighed"))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # one number for each bucket
    names = docs.columns

    def run(batches):
        for batch in steps(batches):
            bucket, text = grams(pc.fill_null(batch.column("text"), "").cast(pa.large_binary()))
            total = np.bincount(text, shared.value[bucket], batch.num_rows) + batch.column(NOISE).to_numpy(zero_copy_only=False)
            kept = (total >= least) & (np.bincount(text, minlength=batch.num_rows) > 0)
            yield batch.filter(pa.array(kept)).select(names)

    return docs.withColumn(NOISE, gumbel()).mapInArrow(run, docs.schema)
