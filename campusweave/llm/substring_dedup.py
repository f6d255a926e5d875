"""Repeated passages by paragraph MinHash banding.

A paragraph is what lies between two cuts in a text. Cuts are line ends and places that the content sets:
a word starts a paragraph if the hash of it and the word before is the least within REACH words on both
sides. So a passage has the same paragraphs wherever it stands, also in the midst of a long line, and
paragraphs of a line are longer than REACH words. Each paragraph has BANDS bands of one min-hash of its
five-word shingles; paragraphs that collide are compared on their exact sets (Jaccard 0.75 or more) and
clustered by components. Bands are tuned for recall with few rows, as a paragraph has about nine shingles:
at 0.75 a pair meets in a band with probability 1 - 0.25^4 = 0.996, and equal paragraphs always do.

Most keys belong to one paragraph. A first pass counts keys; those that repeat go into a filter of fixed
size, and the second pass keeps the paragraphs it lets through.

The first place of a cluster (smallest doc_id, then place) stays, the others are removals. Neighbouring
repeated paragraphs make up a passage; passages under LEAST_WORDS words, such as licence lines, stay. A
passage is told in a row for each part that stays or goes, with all clusters of its paragraphs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import bitmap, by_step, cut, passes, texts
from campusweave.llm.graph import Sets, linked

REACH = 6
BANDS = 4
PERCENT = 75
LEAST_WORDS = 16
U = np.uint64


def paragraph_starts(w: words.Words) -> np.ndarray:
    """Indexes of the words that start a paragraph, over all texts of a step."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[w.first] = True
    lines = np.concatenate([[0], np.cumsum(w.buffer == 10)])
    begins[1:n] |= lines[w.start[1:]] > lines[w.end[:-1]]
    begins[0] = True
    # the hash of a word and the one before; where a line begins there is none
    key = words.mix(w.hash ^ np.concatenate([[U(0)], words.mix(w.hash[:-1])]))
    high = U(0xFFFFFFFFFFFFFFFF)
    least = np.ones(n, bool)
    line = np.cumsum(begins[:n])
    for d in range(1, REACH + 1):
        if d >= n:
            break
        same = line[d:] == line[:-d]
        # a word nearer than REACH to an end of its line starts nothing: a passage's edges decide no cut
        least[d:] &= same & (key[d:] < np.where(same, key[:-d], high))
        least[:-d] &= same & (key[:-d] < np.where(same, key[d:], high))
    tail = min(REACH, n)
    least[:tail] = least[n - tail :] = False
    return np.flatnonzero(least | begins[:n])


def _paragraphs(column: pa.Array) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word, end word and text number of each paragraph."""
    w = words.split(column)
    start = paragraph_starts(w)
    end = np.append(start[1:], len(w.hash))
    return w, start, end, np.searchsorted(w.first, start, side="right") - 1


def _sets(w: words.Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all paragraphs, and of each its first one's index (one longer)."""
    return words.shingles(words.Words(w.start, w.end, w.hash, np.append(start, len(w.hash)) if len(start) else np.zeros(1, np.int64), w.buffer))


def _contents(found: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each paragraph's shingles in order; equal paragraphs share it."""
    mixed = words.mix(found + np.arange(len(found), dtype=U) - np.repeat(begin[:-1], np.diff(begin)).astype(U) * U(1))
    total = np.concatenate([[U(0)], np.cumsum(words.mix(mixed), dtype=U)])
    return words.mix(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(U))


def _bands(found: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Band keys of each paragraph, a row for each band."""
    return np.stack([words.mix(np.minimum.reduceat(words.mix(found ^ seed), begin[:-1]) ^ seed) for seed in words.seeds(BANDS, 1000)])


def shared_keys(docs: DataFrame) -> DataFrame:
    """Band keys that more than one paragraph has."""

    def run(batch):
        w, start, end, _ = _paragraphs(batch.column("text"))
        if not len(start):
            return None
        key, n = np.unique(_bands(*_sets(w, start, end)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.signed(key)), pa.array(n)], ["key", "n"])

    return by_step(texts(docs), run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


def places(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """doc_id, start and end word, content id and band keys of each paragraph that has a key in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def run(batch):
        w, start, end, text = _paragraphs(batch.column("text"))
        if not len(start):
            return None
        found, begin = _sets(w, start, end)
        keys = _bands(found, begin)
        some = np.flatnonzero(passes(shared.value, words.signed(keys)).any(axis=0))
        first = w.first[text]
        content = _contents(found, begin)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(text[some])), pa.array((start - first).astype(np.int32)[some]), pa.array((end - first).astype(np.int32)[some]), pa.array(words.signed(content)[some]), words.lists(list(words.signed(keys.T[some].copy())), pa.int64())],
            ["doc_id", "start", "end", "content", "keys"],
        )

    return by_step(texts(docs), run, "doc_id long, start int, end int, content long, keys array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, content) for paragraphs with these content ids, and by chance others: their shingles, each id once."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.col("id").alias("key"))))

    def run(batch):
        w, start, end, _ = _paragraphs(batch.column("text"))
        if not len(start):
            return None
        found, begin = _sets(w, start, end)
        content, lead = np.unique(words.signed(_contents(found, begin)), return_index=True)
        some = np.flatnonzero(passes(shared.value, content))
        rows = [words.signed(np.unique(found[begin[j] : begin[j + 1]])) for j in lead[some]]
        return pa.RecordBatch.from_arrays([pa.array(content[some]), words.lists(rows, pa.int64())], ["id", "content"]) if rows else None

    return by_step(texts(docs), run, "id long, content array<long>").dropDuplicates(["id"])


def _read(column: pa.Array) -> list[np.ndarray]:
    """Sets from a column of lists."""
    ends = column.offsets.to_numpy()
    return [x.view(np.uint64) for x in np.split(column.values.to_numpy(), ends)[1:-1]]


def _of_contents(found: DataFrame, shared: DataFrame) -> DataFrame:
    """doc_id, start, end and content of places whose content is in `shared`, and by chance of others: the rest is not shuffled."""
    bits = found.sparkSession.sparkContext.broadcast(bitmap(shared.select(F.col("content").alias("key"))))  # of fixed size

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(passes(bits.value, batch.column("content").to_numpy())))

    return found.select("doc_id", "start", "end", "content").mapInArrow(run, "doc_id long, start int, end int, content long")


def repeated(docs: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row for each part of a repeated passage of `docs` (doc_id, text), whole texts, words counted from 0, end exclusive:
    doc_id, start_word, end_word, n_words, cluster (least content id of its paragraphs' classes), first_doc (smallest
    doc_id that shares a paragraph of it), removed (false where all its paragraphs are the first of their class, true
    where none is) and clusters (all classes of its paragraphs, in order). The least length is that of the whole passage.

    Null and empty texts have no paragraphs; rows that repeat a doc_id count as one text each and hold the same places.
    """
    found = cut(places(docs, bitmap(shared_keys(docs))), "places")
    lead = F.min(F.struct("doc_id", "start")).alias("first")
    holder = cut(found.groupBy("content").agg(lead, F.count(F.lit(1)).alias("n"), *(F.min(F.col("keys")[i]).alias(f"k{i}") for i in range(BANDS))), "holder")
    buckets = holder.select(F.explode(F.array(*(f"k{i}" for i in range(BANDS)))).alias("key"), F.col("content").alias("id"))
    classes = linked(buckets, Sets(lambda ids: shingle_sets(docs, ids), _read, percent))
    # contents without a link are classes of their own; what follows of a class is made from its contents, not from its places
    alone = holder.where("n > 1").join(classes, holder["content"] == classes["id"], "left_anti").select("content", F.col("content").alias("cluster"), "first")
    of = holder.select("content", "first").join(classes.select(F.col("id").alias("content"), F.col("component").alias("cluster")), "content")
    first = of.groupBy("cluster").agg(F.min("first").alias("first"))
    shared = cut(of.drop("first").join(first, "cluster").select("content", "cluster", "first").union(alone), "shared")
    here = _of_contents(found, shared).join(shared, "content").select("doc_id", "start", "end", "cluster", "first")
    # runs of neighbouring paragraphs; a window holds the paragraphs of one document
    by_doc = Window.partitionBy("doc_id").orderBy("start", "end")
    apart = F.col("start") != F.coalesce(F.lag("end").over(by_doc), F.lit(-1))
    turns = F.col("removed") != F.coalesce(F.lag("removed").over(by_doc), F.col("removed"))
    here = here.dropDuplicates(["doc_id", "start", "end"]).withColumn("removed", (F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.start") != F.col("start")))
    here = here.withColumn("run", F.sum(apart.cast("int")).over(by_doc)).withColumn("part", F.sum((apart | turns).cast("int")).over(by_doc))
    whole = Window.partitionBy("doc_id", "run")
    here = here.withColumn("whole", F.max("end").over(whole) - F.min("start").over(whole)).where(F.col("whole") >= least_words)
    passages = here.groupBy("doc_id", "part").agg(
        F.min("start").alias("start_word"),
        F.max("end").alias("end_word"),
        F.min("cluster").alias("cluster"),
        F.min("first.doc_id").alias("first_doc"),
        F.first("removed").alias("removed"),
        F.sort_array(F.collect_set("cluster")).alias("clusters"),
    )
    n = F.col("end_word") - F.col("start_word")
    return passages.select("doc_id", "start_word", "end_word", n.alias("n_words"), "cluster", "first_doc", "removed", "clusters")
