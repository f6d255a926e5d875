"""Nearest vectors by a permutation index (Amato and Savino; Chavez, Figueroa and Navarro).

Pivots are a bounded sample of the vectors. A vector's list is its nearest pivots; it is posted in the inverted
file of each pivot of the list. Long vectors are the nearest of many queries: a list is as long as its vector's
squared norm asks for beside the mean one, in powers of 2, about LIST on average. A query goes to the files of
its own nearest pivots, as many as `index_size` says. The truncated footrule puts all vectors that share no pivot
with the query at one distance, the greatest; these are left out. All others are reranked by inner products in
double precision, a file's queries and vectors by one matrix product; what is within its rounding of a query's
k-th is summed again.

Of equal vectors the k + 1 of smallest vec_id are posted, as no other can be among a query's nearest k, so
copies don't fill a file. A file is cut into blocks and its queries into parts by hashes, by the numbers it
has; a task works on one of each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campusweave.llm import words
from campusweave.llm.common import cut

#: Pivots, and files that a query goes to, of 50,000 vectors. The sample that pivots come from is bounded by twice MOST; all vectors are indexed.
PIVOTS, ASKED, MOST = 1024, 32, 16384
LIST = 16
#: Up to so many vectors a query goes to all files.
FEW = 2048
#: Numbers in a block of a file or a part of its queries, and in one matrix product.
BLOCK, STEP = 2_000_000, 4_000_000


def index_size(n: int) -> tuple[int, int]:
    """Pivots, and files that a query goes to, for n vectors: files grow as the root of n, those asked as the root of the pivots."""
    pivots = min(MOST, max(min(PIVOTS, max(256, n // 10)), int(PIVOTS * (n / 50_000) ** 0.5) if n > 50_000 else 0))
    return pivots, pivots if n <= FEW else max(ASKED, int(ASKED * (pivots / PIVOTS) ** 0.5))


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of rows that take part: no nulls, no non-finite components, not all zero."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where("vec_id is not null and embedding is not null").where(~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("vector")
    )


def _matrix(column, width: int) -> np.ndarray:
    """Vectors of one length in double precision, a row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _first(vectors: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the `size` pivots of greatest cosine, for each vector."""
    near = np.round(vectors @ pivots.T / np.linalg.norm(vectors, axis=1, keepdims=True), 9)
    return np.argpartition(-near, size - 1, axis=1)[:, :size].astype(np.int32)


def _sizes(vectors: np.ndarray, mean: float, most: int) -> np.ndarray:
    """Length of each vector's list; mean is that of the squared norms."""
    with np.errstate(all="ignore"):
        turns = np.nan_to_num(np.round(np.log2((vectors * vectors).sum(axis=1) / mean)), nan=0.0, posinf=0.0, neginf=-1.0)
    return np.minimum(most, LIST * 2.0 ** np.clip(turns, -1, 60)).astype(np.int64)


def _best(numbers: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query_id, vec_id and score of each query's k nearest of the vectors but its own."""
    out = []
    keep, step = min(k, len(ids)), max(1, STEP // len(ids))
    longest = np.sqrt((x * x).sum(axis=1).max())
    for i in range(0, len(q), step):
        some, own = q[i : i + step], numbers[i : i + step]
        near = some @ x.T
        near[own[:, None] == ids] = -np.inf
        edge = np.partition(near, len(ids) - keep, axis=1)[:, len(ids) - keep]
        slack = 1e-12 * len(some[0]) * longest * np.sqrt((some * some).sum(axis=1))
        row, at = np.nonzero((near >= (edge - slack)[:, None]) & (near > -np.inf))
        score = np.concatenate([np.zeros(0), *((x[at[j : j + 50_000]] * some[row[j : j + 50_000]]).sum(axis=1) for j in range(0, len(row), 50_000))])
        order = np.lexsort((ids[at], -score, row))
        row, at, score = row[order], at[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((own[row[top]], ids[at[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def nearest(vectors: DataFrame, queries, k: int = 20, pivots: int | None = None, asked_files: int | None = None) -> DataFrame:
    """query_id, rank from 1, vec_id and score of the k nearest found for each query by inner product, ties to the smaller vec_id.

    vectors: vec_id, embedding (array of numbers; those shorter than the longest take no part). queries: a condition on vec_id that picks the queries;
    a query is no candidate of its own. Vectors that are null, all zero or hold null or non-finite components take no part.
    vec_id is taken as unique; of rows that repeat it the one with the least vector counts. With fewer than k others
    all of them are returned; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    # single precision is kept as it is, half the bytes of what is posted
    kind = "float" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    known = valid(vectors).select("vec_id", F.col("vector").cast(f"array<{kind}>").alias("vector"))
    known = cut(known.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    width = known.agg(F.max(F.size("vector"))).first()[0] or 0
    known = known.where(F.size("vector") == width)
    n, square = known.agg(F.count(F.lit(1)), F.avg(F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))).first()
    wanted, files = index_size(n)
    wanted, files = pivots or wanted, asked_files or files
    chosen = known.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(2 * wanted).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = np.array(list(dict.fromkeys(tuple(r["vector"]) for r in chosen))[:wanted], float)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    files = min(files, len(base))
    shared = spark.sparkContext.broadcast(base)  # bounded by MOST

    def post(places=None):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column("vector"), width)
                    sizes = np.full(len(x), places) if places else _sizes(x, square, len(shared.value))
                    order = [np.zeros(0, np.int32)] * len(x)
                    for size in np.unique(sizes):
                        rows = np.flatnonzero(sizes == size)
                        for row, first in zip(rows, _first(x[rows], shared.value, int(size)), strict=True):
                            order[row] = first
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), words.lists(order, pa.int32())], ["vec_id", "vector", "order"])

        return run

    listed = f"vec_id long, vector array<{kind}>, `order` array<int>"
    copies = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("vec_id")
    posted = known.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("vec_id", "vector")
    posted = cut(posted.mapInArrow(post(), listed), "lists").select(F.explode("order").alias("pivot"), "vec_id", "vector")
    asked = cut(known.where(queries).mapInArrow(post(files), listed), "asked").select(F.explode("order").alias("pivot"), "vec_id", "vector")
    # a row for each pivot; files that no query goes to are left out, each query goes to all blocks of its files, each block to all parts
    rows = max(1024, BLOCK // width)
    many = lambda df, name: df.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    deal = F.broadcast(cut(many(posted, "blocks").join(many(asked, "parts"), "pivot"), "deal"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    one = lambda c, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(c)).cast("int")
    asked = asked.join(deal, "pivot").withColumn("part", one("parts", 2)).withColumn("block", every("blocks")).drop("blocks", "parts")
    posted = posted.join(deal, "pivot").withColumn("block", one("blocks", 3)).withColumn("part", every("parts")).drop("blocks", "parts")

    def search(own: pa.Table, file: pa.Table) -> pa.Table:
        found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if own.num_rows and file.num_rows:
            found = _best(own.column("vec_id").to_numpy(), _matrix(own.column("vector"), width), file.column("vec_id").to_numpy(), _matrix(file.column("vector"), width), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found), strict=True)))

    by = ["pivot", "block", "part"]
    found = asked.groupBy(*by).cogroup(posted.groupBy(*by)).applyInArrow(search, "query_id long, vec_id long, score double")
    # a vector that several files of a query hold has one rank
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.dense_rank().over(ranks)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score").distinct()


def exact(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, vec_id, score of every pair: for measuring recall on few queries (vec_id, vector)."""
    q = [(r["vec_id"], np.array(r["vector"])) for r in queries.collect()]

    def score(frames):
        for pdf in frames:
            x = np.stack(pdf["vector"].to_numpy())
            for number, v in q:
                yield pd.DataFrame({"query_id": number, "vec_id": pdf["vec_id"], "score": (x * v).sum(axis=1)}).query("vec_id != query_id")

    return valid(vectors).mapInPandas(score, "query_id long, vec_id long, score double")
