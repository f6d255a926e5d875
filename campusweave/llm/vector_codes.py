"""Codes for vectors, in whole numbers throughout: one small codebook for each part of the vector.

Components become floor(scale * x). A vector is cut into equal consecutive parts; each part position has its own
codebook, moved in rounds of assignment and componentwise floored means, and a vector's code names the nearest entry
of each part.

The nearest entry is found on Walsh-Hadamard coefficients. Parts and entries are padded with zeros to L, the next
power of two, and transformed by additions alone; the squared distance of two transforms is L times that of the
originals. Squared differences are added up in sequency order (the slow patterns, which hold most of the difference,
first). One entry's whole distance is a bound from the start; what has passed it at some coefficient is left out of all
later ones. Partial sums only grow, so nothing nearer can be lost, and no floating point is involved. Where 64 bits
might not hold a sum, the same steps run on Python's whole numbers.

Each round is one pass over the stored vectors. A task sends its sums and counts by entry, once, in 32-bit limbs, so what
is shuffled and read by the driver has the size of the codebooks, whatever the size of the table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusweave.llm.common import cut, steps

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
MOST = 2**63 - 1
#: Up to so many labels their sums are broadcast, beyond it they are joined by a shuffle, in SALTS shares.
LABELS, SALTS = 100_000, 16


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector (array<double>) of the rows without nulls and non-finite numbers in the vector."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull()).where(~bad).select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.cast("array<double>").alias("vector"))


# -- whole numbers and their transform ------------------------------------------------------


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: as 64-bit numbers if all are small, else as Python's."""
    if not x.size or np.abs(x).max() < 2.0**32:
        return np.floor(x * float(scale)).astype(np.int64)  # a power of two only moves the exponent
    return np.array([math.floor(v) * scale + math.floor((v - math.floor(v)) * scale) if abs(v) < 2.0**53 else int(v) * scale for v in x.ravel().tolist()], object).reshape(x.shape)


def sequency(length: int) -> np.ndarray:
    """Of the butterflies' outputs, the places in order of sign changes: bit-reversed Gray code."""
    bits = length.bit_length() - 1
    at = np.arange(length)
    gray = at ^ (at >> 1)
    out = np.zeros(length, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the last axis, zero-padded to a power of two, in sequency order."""
    length = 1 << max(0, x.shape[-1] - 1).bit_length()
    out = np.zeros((*x.shape[:-1], length), x.dtype)
    out[..., : x.shape[-1]] = x
    h = 1
    while h < length:
        pairs = out.reshape(*x.shape[:-1], length // (2 * h), 2, h)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(*x.shape[:-1], length)
        h *= 2
    return out[..., sequency(length)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows and entries given by their coefficients: the nearest entry, ties to the lower, and L times its squared distance."""
    n, length = x.shape
    begun = (x[:, :1] - entries[None, :, 0]) ** 2
    guess = begun.argmin(axis=1)
    bound = ((x - entries[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(begun <= bound[:, None])
    total = begun[row, entry]
    for k in range(1, length):
        total = total + (x[row, k] - entries[entry, k]) ** 2
        alive = (total <= bound[row]).astype(bool)
        row, entry, total = row[alive], entry[alive], total[alive]
    order = np.lexsort((entry, total, row)) if total.dtype != object else np.array(sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i])), np.int64)
    row, entry, total = row[order], entry[order], total[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))  # the guess is never left out, so each row has one
    return entry[first], total[first]


class Books:
    """The codebooks: for each part an array of entries by components, and their transforms."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries
        self.coefficients = [transform(e) for e in entries]
        self.width = entries[0].shape[1]
        self.length = self.coefficients[0].shape[1]
        self.largest = max((int(abs(e).max()) for e in entries if e.size), default=0)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of vectors cut into parts (rows by parts by components): the entries' numbers and squared distances."""
        largest = max(self.largest, int(abs(x).max()) if x.size else 0)
        small = x.dtype != object and 4 * self.length**3 * largest**2 < 2**62
        codes, far = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64 if small else object)
        for p, entries in enumerate(self.coefficients):
            own = transform(x[:, p] if small else x[:, p].astype(object))
            codes[:, p], distance = nearest(own, entries if small else entries.astype(object))
            far[:, p] = distance // self.length
        return codes, far

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for v in e.ravel()).encode()).hexdigest()


def matrix(column: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """Rows by parts by components; a row that is shorter than the others ends in zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    x = np.zeros((len(sizes), parts * width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    x[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return whole(x, scale).reshape(len(sizes), parts, width)


# -- rounds -----------------------------------------------------------------------------------


def _moved(table: DataFrame, books: Books, parts: int, scale: int) -> Books:
    """Codebooks after a round: each entry the floored mean of its parts, unused ones as they were."""

    def sums(batches):
        total = [np.zeros(e.shape, object) for e in books.entries]
        count = [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in steps(batches, "vector"):
            x = matrix(batch.column("vector"), parts, books.width, scale)
            codes, _ = books.assign(x)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, begin, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                total[p][used] += np.add.reduceat(x[order, p], begin, axis=0).astype(object)
                count[p][used] += n
        rows = []
        for p in range(parts):
            for e in np.flatnonzero(count[p]):
                rows.append((p, int(e), -1, 0, int(count[p][e])))
                for at, value in enumerate(total[p][e]):
                    value, limb = int(value), 0
                    while not -(2**31) <= value < 2**31:
                        rows.append((p, int(e), at, limb, value & 0xFFFFFFFF))
                        value, limb = value >> 32, limb + 1
                    rows.append((p, int(e), at, limb, value))
        if rows:
            names = ("part", "entry", "at", "limb", "value")
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "value" else pa.int32()) for k, c in zip(names, zip(*rows))], names)

    found = table.mapInArrow(sums, "part int, entry int, at int, limb int, value long").groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value"))
    total = [np.zeros(e.shape, object) for e in books.entries]
    count = [[0] * len(e) for e in books.entries]
    for part, entry, at, limb, value in found.collect():  # of the size of the codebooks
        if at < 0:
            count[part][entry] = value
        else:
            total[part][entry, at] += value << (32 * limb)
    moved = []
    for p, entries in enumerate(books.entries):
        new = entries.astype(object)
        for e, n in enumerate(count[p]):
            if n:
                new[e] = [t // n for t in total[p][e]]
        moved.append(_narrow(new))
    return Books(moved)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if not x.size or max(abs(int(v)) for v in x.ravel()) < 2**62 else x


def encoded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code (two hex digits a part), error (squared distances summed), label_error (errors summed over equal
    labels, nulls together) and codebooks_sha256 of every vector without nulls and non-finite numbers.

    vectors: vec_id, embedding (array of numbers) and label; other columns are left behind. Codebooks start as the parts of
    the rows of the `entries` smallest vec_ids (null ones do not count unless there are no others; of rows that repeat a vec_id
    the least vector starts an entry); with fewer vec_ids there are fewer entries. All rows are coded, repeated ones and null
    vec_ids too. A vector whose length is not that of the longest, rounded up to a multiple of `parts`, counts as ending in zeros; an
    empty one as zeros. Sums past the range of a long are told as its greatest value. An empty table gives an empty result.
    `entries` is at most 256 and `scale` a power of two.
    """
    schema = "vec_id long, code string, error long"
    table = cut(kept(vectors), "vectors")
    longest = table.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return table.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")], F.lit("").alias("codebooks_sha256"))
    width = max(1, -(-longest // parts))
    ids = table.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    first = table.join(F.broadcast(ids), table["vec_id"].eqNullSafe(ids["vec_id"]), "left_semi").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    start = sorted(first.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"]))  # `entries` rows
    if len(start) > 1:
        start = [r for r in start if r["vec_id"] is not None]
    x = matrix(pa.array([r["vector"] for r in start], pa.list_(pa.float64())), parts, width, scale)
    books = Books([_narrow(x[:, p].astype(object)) for p in range(parts)])
    for _ in range(rounds):
        books = _moved(table, books, parts, scale)

    def code(batches):
        for batch in steps(batches, "vector"):
            codes, far = books.assign(matrix(batch.column("vector"), parts, books.width, scale))
            text = codes.astype(np.uint8).tobytes().hex()
            texts = [text[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(codes))]
            errors = [min(MOST, int(v)) for v in far.astype(object).sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    label = table.schema["label"].dataType.simpleString()
    coded = cut(table.mapInArrow(code, f"vec_id long, label {label}, code string, error long"), "codes")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long").alias("label_error"))
    sums = cut(sums.withColumnRenamed("label", "_label"), "label-errors")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= LABELS:
        joined = coded.join(F.broadcast(sums), same)
    else:
        # rows of a frequent label go to SALTS tasks
        spread = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = coded.withColumn("_share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(spread, same & (F.col("_share") == F.col("_salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


# -- the same in SQL ----------------------------------------------------------------------------


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of `encoded` on `embeddings`: plain distances of all parts and entries, a CTE for each round."""
    finite = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    ctes = [
        f"v AS MATERIALIZED (SELECT vec_id, label, embedding, len(embedding) // {parts} AS w FROM embeddings WHERE {finite})",
        f"""c AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) AS x
 FROM (SELECT vec_id, w, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM v))""",
        f"s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM v ORDER BY vec_id LIMIT {entries}))",
        "b0 AS MATERIALIZED (SELECT part, entry, pos, x AS e FROM c JOIN s USING (vec_id))",
    ]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, entry, far FROM (SELECT vec_id, part, entry, sum((x - e) * (x - e)) AS far FROM c JOIN b{r} USING (part, pos) GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce((t - (((t % n) + n) % n)) // n, e) AS e FROM b{r} LEFT JOIN
 (SELECT part, entry, pos, CAST(sum(x) AS HUGEINT) AS t, CAST(count(*) AS HUGEINT) AS n FROM c JOIN a{r} USING (vec_id, part) GROUP BY ALL) USING (part, entry, pos))""")
    return f"""WITH {", ".join(ctes)},
 f AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
 SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(CAST(e AS STRING), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256 FROM f JOIN v USING (vec_id)"""
