"""Near-duplicate documents by fast similarity sketching (Dahlgaard, Knudsen and Thorup, 2017).

A document's set of five-word shingles fills the T coordinates of a sketch in rounds. In each of the
first T rounds every shingle gets a coordinate and a value by that round's hash; a coordinate keeps
the least value of the first round that reaches it. Rounds T+1 to 2T give all shingles to one
coordinate each, so that every coordinate fills; a set of T ln T shingles or more needs one or two
rounds. The chance that two sketches agree in a coordinate is the sets' Jaccard similarity, and the
number of equal coordinates is concentrated as with T independent hashes.

Equal sets are one class first. Sketches of class representatives are cut into BANDS bands; two that
agree in a band are compared on their full sets. At a similarity of 0.75 a pair shares no band with
probability (1 - 0.75^4)^32 = 5e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import bitmap, by_step, cut, passes, texts
from campusweave.llm.graph import Sets, linked

BANDS, ROWS = 32, 4
#: similarity as a percentage, so that the test is one of whole numbers
PERCENT = 75
U = np.uint64


def sketch(items: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """The coordinates of a set of 64-bit hashes; `size` is a power of 2. An empty set has none filled (all ones)."""
    bits, full = U(size.bit_length() - 1), U(0xFFFFFFFFFFFFFFFF)
    out = np.full(size, full, U)
    if not len(items):
        return out
    keys, done = words.seeds(2 * size, salt), 0
    while done < size and (out == full).any():
        turns = min(size - done, max(1, int(1.5 * size * np.log(size) / len(items))))
        h = words.mix(items[None, :] ^ keys[done : done + turns, None])
        turn = (np.arange(done, done + turns, dtype=U) << U(48))[:, None]
        place, value = (h >> (U(64) - bits)).ravel(), (turn | (h & U((1 << 48) - 1))).ravel()
        # one sort by coordinate, round and value: 7 + 8 + 48 bits for 128 coordinates
        order = np.sort((place << (U(64) - bits)) | (value & ((U(1) << (U(64) - bits)) - U(1))))
        place = order >> (U(64) - bits)
        lead = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        at = place[lead].astype(np.int64)
        free = out[at] == full
        out[at[free]] = order[lead][free]
        done += turns
    for j in np.flatnonzero(out == full):
        out[j] = (U(size + j) << U(48)) | (words.mix(items ^ keys[size + j]).min() & U((1 << 48) - 1))
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = coordinates.reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=U)
    for k in range(rows):
        out = words.mix((out ^ parts[:, k]) * U(0x9E3779B97F4A7C15))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit hash (set_a, set_b) and its band keys; empty sets have no keys."""

    def sign(batch):
        found = words.sets(batch.column("text"))
        some = [words.signed(band_keys(sketch(s, BANDS * ROWS), BANDS, ROWS)) if len(s) else np.zeros(0, np.int64) for s in found]
        a = np.array([words.mix(s).sum(dtype=U) for s in found], U)
        b = np.array([np.bitwise_xor.reduce(words.mix(s + U(0x632BE59BD9B4E019))) if len(s) else U(0) for s in found], U)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), pa.array(words.signed(a)), pa.array(words.signed(b)), words.lists(some, pa.int64())],
            ["doc_id", "n_shingles", "set_a", "set_b", "keys"],
        )

    return by_step(texts(docs), sign, "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>")


def some_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, content) of the documents with these ids, and by chance of others: a filter of fixed size goes to the tasks, no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(F.xxhash64("id").alias("key"))))

    def run(batch):
        found = batch.filter(pa.array(passes(shared.value, batch.column("key").to_numpy())))
        return pa.RecordBatch.from_arrays([found.column("doc_id"), found.column("text")], ["id", "content"])

    return by_step(texts(docs, F.xxhash64(F.col("doc_id").cast("long")).alias("key")), run, "id long, content binary").dropDuplicates(["id"])


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links; a document is kept if that is its own.
    Null and empty texts and texts without words have an empty set, no links, and are kept. Repeated doc_ids
    keep a row each; a row with a null doc_id is kept. An empty table gives an empty result. Other columns are not read.
    """
    signed = cut(signatures(docs), "signatures")
    by = ["n_shingles", "set_a", "set_b"]
    classes = cut(signed.where("n_shingles > 0").groupBy(*by).agg(F.min("doc_id").alias("id"), F.min("keys").alias("keys")), "classes")
    buckets = classes.where("id is not null").select(F.explode("keys").alias("key"), "id")
    found = linked(buckets, Sets(lambda ids: some_texts(docs, ids), words.sets, percent))
    of_class = classes.join(found, "id", "left").select(*by, F.coalesce("component", "id").alias("component"))
    out = signed.drop("keys").join(of_class, by, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that are kept; null doc_ids stay, of rows that repeat a doc_id all stay."""
    drop = near_duplicates(docs.where("doc_id is not null"), percent).where("not kept").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


#: DuckDB SQL of `near_duplicates` on `documents`: all pairs that share a shingle, and all that can be reached.
ORACLE = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
 l AS MATERIALIZED (SELECT x, y FROM c JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
 r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
 SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
 FROM documents AS d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id"""
