"""Tables between jobs, Arrow helpers and counters shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusweave.session import checkpoint_dir

#: Bytes of text that one step of a Python task holds as arrays; a longer text is a step of its own.
STEP_BYTES = 1_000_000


def cut(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: no lineage, one copy that outlives executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: 64-bit words of a filter of keys: 8 MB, however many keys there are.
FILTER = 1 << 20


def bitmap(keys: DataFrame) -> np.ndarray:
    """A Bloom filter, with two bits in one word, of a column `key` of hashes. With very many keys it lets more through and stays right."""
    bit = lambda x: F.pow(F.lit(2.0), F.pmod(x, F.lit(62))).cast("long")
    both = bit(F.shiftrightunsigned("key", 40)).bitwiseOR(bit(F.shiftrightunsigned("key", 20).bitwiseAND(F.lit((1 << 20) - 1))))
    rows = keys.groupBy(F.pmod("key", F.lit(FILTER)).alias("at")).agg(F.bit_or(both).alias("bits")).toArrow()  # FILTER rows at most
    out = np.zeros(FILTER, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether signed 64-bit keys are in a bitmap, or seem to be."""
    word, u = bits[keys % FILTER], keys.view(np.uint64)
    at = (u >> np.uint64(40)) % np.uint64(62), ((u >> np.uint64(20)) & np.uint64((1 << 20) - 1)) % np.uint64(62)
    return ((word >> at[0].astype(np.int64)) & (word >> at[1].astype(np.int64)) & 1) == 1


def counts(keys: DataFrame) -> np.ndarray:
    """How often the keys of a column `key` of hashes come, in FILTER cells: keys that share a cell are counted together."""
    rows = keys.groupBy(F.pmod("key", F.lit(FILTER)).alias("at")).agg(F.count(F.lit(1)).alias("n")).toArrow()  # FILTER rows at most
    out = np.zeros(FILTER, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return out


def texts(docs: DataFrame, *more) -> DataFrame:
    """doc_id and the text's UTF-8 bytes, null as empty; columns of other names are left behind."""
    return docs.select(F.col("doc_id").cast("long"), *more, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about STEP_BYTES of a column of bytes or of lists of numbers."""
    for batch in batches:
        values = batch.column(column)
        sizes = (pc.multiply(pc.list_value_length(values), 8) if pa.types.is_list(values.type) else pc.binary_length(values)).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + (n or 0) > STEP_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if start < len(sizes):
            yield batch.slice(start)


def by_step(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text") -> DataFrame:
    """`fn` over slices of bounded bytes of a column, in Arrow."""

    def run(batches):
        for piece in steps(batches, column):
            out = fn(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows that are sorted by a column, cut anew so that rows of one value are in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(column).to_numpy()
        at = len(key) - int((key[::-1] != key[-1]).argmax()) if len(key) and key[0] != key[-1] else 0
        if not len(key):
            continue
        if held and (at or held[-1].column(column)[0].as_py() != key[0]):
            yield from pa.Table.from_batches([*held, batch.slice(0, at)]).combine_chunks().to_batches()
            held = []
        elif at:
            yield batch.slice(0, at)
        held.append(batch.slice(at))
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
