"""The offline run: new pages to nine datasets, merged into what is there."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.operators import html as H
from campusweave.operators.relational import without_known
from campusweave.plans.colleges import build_colleges
from campusweave.plans.courses import build_courses
from campusweave.plans.people import build_admissions, build_faculty, build_hostel, build_reviews, build_scholarships
from campusweave.plans.placements import build_placements, fill_from_listing
from campusweave.plans.rankings import KEY as RANKING_KEY
from campusweave.plans.rankings import build_rankings, dedup_rankings, ranking_entries, settled
from campusweave.schemas import DATASETS, UNSPECIFIED
from campusweave.site import DEFAULT_SITE, Site
from campusweave.sources import seen
from campusweave.sources.datasets import bucket_count, is_stored, read_dataset, write_buckets
from campusweave.sources.staging import clear_staged, stage_pages

# What the sink writes for a missing value.
SENTINELS = {
    "colleges": {
        "accreditation": UNSPECIFIED, "affiliation": UNSPECIFIED, "rating": "Not Rated", "ranking": "Not Ranked",
        "city": UNSPECIFIED, "state": UNSPECIFIED, "contact_info": UNSPECIFIED,
    },
    **{
        name: {c: UNSPECIFIED for c in DATASETS[name].fieldNames() if c != "college_id"}
        for name in ("courses", "admissions", "placements", "hostel")
    },
    "scholarships": {"amount": UNSPECIFIED},
}

# page type -> job; pages of the other types feed colleges, placements and rankings
PAGE_JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "courses": build_courses,
    "admissions": build_admissions,
    "faculty": build_faculty,
    "scholarships": build_scholarships,
    "hostel": build_hostel,
    "reviews": build_reviews,
}

#: Page types that an output is read from; those not named here are read from the pages of their own name.
READ_FROM = {"colleges": ("info",), "rankings": ("info", "placements")}
PAGE_TYPES = ("info", "placements", *PAGE_JOBS)

PAGE_KEY = ["college_id", "slug", "page_type"]
#: Outputs of a batch that are written side by side.
JOBS = 4
#: Folders that colleges' rankings are dealt to, unless the first batch says otherwise: as many as keep the rankings of one to a task.
RANKING_BUCKETS = 64
SEEN = T.StructType([T.StructField(c, T.StringType()) for c in PAGE_KEY])
ENTRIES = T.StructType([
    T.StructField(c, T.IntegerType() if c in ("kind", "source", "pos", "ranking_year") else T.StringType())
    for c in ("college_id", "slug", "kind", "source", "pos", "ranking_body", "rank", "ranking_year")
])
PROGRESS = T.StructType([T.StructField("batch", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("rows_in", "new", "saved", "rejected")]])
REJECTED = T.StructType([*SEEN.fields, T.StructField("parse_error", T.StringType())])


def finish(name: str, df: DataFrame) -> DataFrame:
    """Declared columns, types and sentinels of a dataset."""
    sentinels = SENTINELS.get(name, {})
    return df.select(*[
        (F.coalesce(F.col(f.name), F.lit(sentinels[f.name])) if f.name in sentinels else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in DATASETS[name].fields
    ])


def dataset_jobs(pages: DataFrame, listing: DataFrame | None = None, site: Site = DEFAULT_SITE) -> dict[str, Callable[[], DataFrame]]:
    """How each dataset but the rankings is built from a set of pages. The page type is filtered before any page is parsed."""

    def of(kind: str) -> DataFrame:
        return pages.filter(F.col("page_type") == kind)

    def placements() -> DataFrame:
        found = build_placements(of("placements"))
        return found if listing is None else fill_from_listing(found, listing, site)

    def job(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: finish(name, build())

    built = {"colleges": lambda: build_colleges(of("info"), listing, site=site), "placements": placements}
    built |= {name: (lambda build=build, name=name: build(of(name))) for name, build in PAGE_JOBS.items()}
    return {name: job(name, build) for name, build in built.items()}


def build_datasets(
    pages: DataFrame, listing: DataFrame | None = None, known_rankings: DataFrame | None = None, site: Site = DEFAULT_SITE
) -> dict[str, DataFrame]:
    """All nine datasets of a set of pages."""
    rankings = build_rankings(pages, site=site)
    if known_rankings is None:
        known_rankings = rankings.select(*RANKING_KEY).limit(0)
    built = {name: job() for name, job in dataset_jobs(pages, listing, site).items()}
    built["rankings"] = finish("rankings", dedup_rankings(known_rankings, rankings))
    return {name: built[name] for name in DATASETS}


def new_pages(pages: DataFrame, seen: DataFrame) -> DataFrame:
    """Pages not parsed yet, by entity and page type."""
    return without_known(pages, seen, PAGE_KEY)


def stored(spark: SparkSession, root: str, name: str, schema: T.StructType, other_than: str | None = None) -> DataFrame:
    """What earlier batches wrote under a root folder, this batch left out."""
    table = read_dataset(spark, f"{root}/{name}", T.StructType([*schema.fields, T.StructField("batch", T.StringType())]))
    return (table.filter(F.col("batch") != other_than) if other_than else table).drop("batch")


def parse_batch(
    pages: DataFrame, root: str, batch: str, listing: DataFrame | None = None, site: Site = DEFAULT_SITE, buckets: int = RANKING_BUCKETS
) -> None:
    """Parse the pages not seen in earlier batches and add their rows under ``root``.

    Markup is parsed once, into a staging table that every job of the batch reads and that is emptied
    when the batch is through. Every table is written to a folder of this batch, whole or not at all: a batch that is
    repeated after a failure replaces its own folders and changes nothing else. Only outputs of page types that the batch
    holds are planned and written, so that many batches of few page types cost little; a batch that has begun before writes all. Pages count
    as seen once their batch is through. Of rankings each page's entries are kept, and those of the colleges'
    buckets that a batch touches are settled anew, since a college's pages may come in different batches. Pages that cannot be read
    are listed in ``_rejected``, and what came of the batch in ``_progress``. Pages without a full key are left out.
    One batch at a time.
    """
    spark = pages.sparkSession
    pages = pages.dropna(subset=PAGE_KEY)
    arrived, fresh, held = Observation(), Observation(), Observation()
    known = seen.layout(spark, f"{root}/_seen")
    keys, found = _fresh_keys(pages.select(*PAGE_KEY), arrived, root, batch, known)
    if found < arrived.get["n"]:  # else every page is new, and none need be looked up
        pages = pages.join(keys, PAGE_KEY, "left_semi")
    folder = f"{root}/_parsed/batch={batch}"
    begun = is_stored(spark, folder)
    staged = stage_pages(pages.observe(held, *[F.count_if(F.col("page_type") == kind).alias(kind) for kind in PAGE_TYPES]), folder, fresh)
    new, rejected = fresh.get["n"], fresh.get["rejected"]
    counts = {"rows_in": arrived.get["n"], "new": new, "saved": new - rejected, "rejected": rejected}
    # a row of literals: one made from Python rows would start a Python worker
    outputs: dict[str, Callable[[], DataFrame]] = {"_progress": lambda: spark.range(0, 1, 1, 1).select(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()])}

    def concerned(name: str) -> bool:
        return new > 0 and (begun or any(held.get[kind] for kind in READ_FROM.get(name, (name,))))

    outputs |= {name: job for name, job in dataset_jobs(staged, listing, site).items() if concerned(name)}
    if rejected or (begun and new):
        outputs["_rejected"] = lambda: H.rejected_pages(staged).select(*REJECTED.fieldNames())

    def write(name: str) -> None:
        outputs[name]().write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")

    # the outputs have nothing to do with each other: they are planned and run side by side
    with ThreadPoolExecutor(JOBS) as pool:
        done = [pool.submit(_upsert_rankings, staged, root, batch, bucket_count(spark, f"{root}/_ranking_entries", buckets), site)] if concerned("rankings") else []
        done += [pool.submit(write, name) for name in outputs]
        for job in done:
            job.result()
        done = [pool.submit(seen.add, keys, f"{root}/_seen", PAGE_KEY, batch, known), pool.submit(clear_staged, spark, folder)]
        for job in done:
            job.result()


def _fresh_keys(pages: DataFrame, arrived: Observation, root: str, batch: str, known: Row) -> tuple[DataFrame, int]:
    """Keys of pages not seen in other batches, stored, and their number: every later step joins with these and not with all there ever were."""
    spark = pages.sparkSession
    folder = f"{root}/_arrived/batch={batch}"
    pages.observe(arrived, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    fresh = seen.unseen(spark.read.schema(SEEN).parquet(folder), f"{root}/_seen", PAGE_KEY, batch, known, arrived.get["n"])
    folder, counted = f"{root}/_fresh/batch={batch}", Observation()
    fresh.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    return spark.read.schema(SEEN).parquet(folder), counted.get["n"]


def _upsert_rankings(staged: DataFrame, root: str, batch: str, buckets: int, site: Site) -> None:
    """Store a batch's entries, and settle the rankings of the buckets it touches anew from all entries of these."""
    spark = staged.sparkSession
    entries = ranking_entries(staged, site=site).select(*[F.col(f.name).cast(f.dataType) for f in ENTRIES.fields])
    write_buckets(entries.withColumn("batch", F.lit(batch)), f"{root}/_ranking_entries/rows", "college_id", buckets, ["batch"])
    schema = T.StructType([*ENTRIES.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.StringType())])
    every = read_dataset(spark, f"{root}/_ranking_entries/rows", schema)
    # the names of the files tell the folders: none is opened
    folders = (re.search(r"/bucket=(\d+)/batch=([^/]*)/", file) for file in every.inputFiles())
    touched = sorted({int(at[1]) for at in folders if at and unquote(unquote(at[2])) == batch})  # `buckets` at most
    if not touched:
        return
    found = settled(every.filter(F.col("bucket").isin(touched)).drop("bucket", "batch"))
    rankings = finish("rankings", dedup_rankings(found.select(*RANKING_KEY).limit(0), found))
    write_buckets(rankings, f"{root}/rankings", "college_id", buckets)


def load_datasets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All nine datasets as stored."""
    return {
        name: read_dataset(spark, f"{root}/rankings", schema) if name == "rankings" else stored(spark, root, name, schema)
        for name, schema in DATASETS.items()
    }


def load_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Pages that no batch could read, with the reason."""
    return stored(spark, root, "_rejected", REJECTED)


def load_progress(spark: SparkSession, root: str) -> DataFrame:
    """What came of each batch: pages that arrived, of these the new ones, and of the new ones those saved and rejected."""
    return read_dataset(spark, f"{root}/_progress", PROGRESS)
