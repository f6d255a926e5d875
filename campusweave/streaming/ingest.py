"""Page ingest in bounded batches."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from campusweave.operators.ordinals import with_running_totals
from campusweave.plans.run import PAGE_TYPES, RANKING_BUCKETS, load_progress, parse_batch
from campusweave.site import DEFAULT_SITE, Site
from campusweave.sources.datasets import read_dataset
from campusweave.sources.pages import PAGES

TRIGGERS = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("started_at", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("rows_scanned", "trigger_ms", "batch_ms")],
])
#: How long the end of a stream waits for its last progress event.
LAST_EVENT_SECONDS = 30
#: Splits that each core gets of a batch's files.
SPLITS_PER_CORE = 2


@contextmanager
def dealt_finely(spark: SparkSession) -> Iterator[None]:
    """Session settings for the work on pages, while a stream runs; the stream's source and its batches go by them.

    Page work costs far more than opening a file: the files of a batch are dealt out evenly by their bytes, however small they are.
    Pages of all types that a task parses go to their folders as they come, and are not sorted by type first.
    """
    finely = {
        "spark.sql.files.minPartitionNum": SPLITS_PER_CORE * spark.sparkContext.defaultParallelism,
        "spark.sql.files.openCostInBytes": "64k",
        "spark.sql.maxConcurrentOutputFileWriters": 2 * len(PAGE_TYPES),
    }
    before = {key: spark.conf.get(key, None) for key in finely}
    for key, value in finely.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Triggers(StreamingQueryListener):
    """What the stream itself reports of each trigger: one short row a batch."""

    def __init__(self) -> None:
        super().__init__()
        self._rows: list[tuple[str, tuple]] = []
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        spent = p.durationMs or {}
        if "addBatch" in spent:  # triggers without a batch report too
            self._rows.append((str(p.runId), (str(p.batchId), p.timestamp, p.numInputRows, spent.get("triggerExecution"), spent["addBatch"])))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def rows(self, run: str) -> list[tuple]:
        """Reports of a run that has ended; events come some time after what they tell of."""
        self._end(run).wait(LAST_EVENT_SECONDS)
        return [row for owner, row in self._rows if owner == run]


def stream_pages(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    files_per_batch: int = 50,
    listing: DataFrame | None = None,
    schema: T.StructType = PAGES,
    site: Site = DEFAULT_SITE,
    buckets: int = RANKING_BUCKETS,
) -> int:
    """Parse page files that have arrived since the last call, batch by batch, then stop.

    Which files are done is kept in the stream's checkpoint, what they gave under ``root``.
    A batch that was cut short runs again under the same number and replaces its folders. What the stream
    reports of its triggers is added to ``<root>/_triggers``. Returns the number of batches.
    """
    batches = 0
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def parse(batch: DataFrame, number: int) -> None:
        nonlocal batches
        parse_batch(batch, root, str(number), listing, site, buckets)
        batches += 1

    triggers = Triggers()
    spark.streams.addListener(triggers)
    try:
        with dealt_finely(spark):
            query = pages.writeStream.foreachBatch(parse).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            finally:
                reports = triggers.rows(str(query.runId))
                if reports:
                    spark.createDataFrame(reports, TRIGGERS).coalesce(1).write.mode("append").parquet(f"{root}/_triggers")
    finally:
        spark.streams.removeListener(triggers)
    return batches


def stream_progress(spark: SparkSession, root: str) -> DataFrame:
    """Per batch of a stream: pages that arrived, of these the new ones, those saved and rejected, totals before and
    after it, and what its last trigger took (NULL if the stream could not tell).
    """
    done = load_progress(spark, root).withColumn("batch", F.col("batch").cast("bigint"))
    last = read_dataset(spark, f"{root}/_triggers", TRIGGERS).groupBy(F.col("batch").cast("bigint").alias("batch")).agg(F.max_by(F.struct("trigger_ms", "batch_ms"), "started_at").alias("t"))
    totals = with_running_totals(done, "batch", {f"{c}_before": F.col(c) for c in ("saved", "rejected")})
    after = {f"{c}_after": F.col(f"{c}_before") + F.col(c) for c in ("saved", "rejected")}
    return totals.withColumns(after).join(last, "batch", "left").select(*totals.columns, *after, "t.trigger_ms", "t.batch_ms")
