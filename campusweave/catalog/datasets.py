"""Queries over the dataset jobs and over the relational pieces they are made of."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from campusweave.catalog.derived import (
    COURSE_CARDS, COURSE_CONTEXT, COURSE_STATE, COURSE_TABLES, DEGREE, all_pages, listing_pages, profile_pages,
)
from campusweave.catalog.registry import query, table
from campusweave.operators import frontier as B
from campusweave.operators import html as H
from campusweave.operators import relational as R
from campusweave.operators.audit import audit_counts, audit_stored
from campusweave.plans import colleges, courses, people, placements, rankings
from campusweave.plans.run import finish, load_datasets, new_pages, parse_batch
from campusweave.schemas import DATASETS
from campusweave.session import checkpoint_dir
from campusweave.sources import seen
from campusweave.sources.datasets import read_dataset, rejected_records, write_bundle, write_dataset, write_per_entity
from campusweave.sources.listing import read_listing, write_listing
from campusweave.sources.page_files import write_pages
from campusweave.sources.pages import read_pages, store_pages, stored_pages
from campusweave.streaming.ingest import stream_pages, stream_progress

# -- relational pieces ------------------------------------------------------------------------


@query("dedup_first_wins", "SELECT source, lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_first_wins(spark, d):
    short = table(spark, d, "documents").select("source", "lang", "doc_id", F.sha2("text", 256).alias("text"))
    return R.first_wins(short, ["text"], ["doc_id"]).select("source", "lang", "doc_id")


@query("top_per_key", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3")
def top_per_key(spark, d):
    return R.top_n(table(spark, d, "events"), [F.col("value").desc(), "event_id"], 3, per=["user_id"]).select("user_id", "event_id")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_n(spark, d):
    return R.top_n(table(spark, d, "orders"), [F.col("o_totalprice").desc(), "o_orderkey"], 25).select("o_orderkey", "o_totalprice")


PRIORITY = "CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END"


@query(
    "fallback_chain",
    f"SELECT doc_id, source, pri FROM (SELECT *, CAST({PRIORITY} AS INT) AS pri FROM documents) QUALIFY pri = min(pri) OVER (PARTITION BY source)",
)
def fallback_chain(spark, d):
    rows = table(spark, d, "documents").withColumn("pri", F.expr(PRIORITY))
    return R.fallback_chain(rows, ["source"], "pri").select("doc_id", "source", "pri")


@query("anti_new", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_new(spark, d):
    return R.without_known(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"]).select("doc_id", "source")


@query(
    "incremental_merge",
    "SELECT doc_id, quality, NULL AS source FROM labels UNION ALL SELECT doc_id, NULL, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def incremental_merge(spark, d):
    known = table(spark, d, "labels").select("doc_id", "quality")
    new = R.without_known(table(spark, d, "documents").select("doc_id", "source"), known, ["doc_id"])
    return R.merge_append(known, new)


@query("array_explode", "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS position, CAST(unnest(embedding) AS DOUBLE) AS item FROM embeddings")
def array_explode(spark, d):
    return R.explode_nested(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding").withColumn("item", F.col("item").cast("double"))


@query("column_widths", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(greatest(greatest(max(length(CAST({c} AS STRING))), {len(c)}) + 3, 12) AS INT) AS width FROM part"
    for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
))
def column_widths(spark, d):
    return R.column_widths(table(spark, d, "part"))


@query(
    "placeholder",
    """SELECT CAST(o_custkey AS STRING) AS college_id, o_orderkey, NULL AS status FROM orders
 UNION ALL SELECT CAST(c_custkey AS STRING), NULL, 'No Data Available' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def placeholder(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("college_id"), "o_orderkey")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("college_id"))
    return R.with_placeholder(orders, "college_id", customers)


@query("empty_placeholder", "SELECT 'No Data Available' AS college_id, NULL AS o_orderkey, 'Check Logs' AS status FROM (SELECT count(*) AS n FROM orders WHERE o_totalprice < 0) WHERE n = 0")
def empty_placeholder(spark, d):
    none = table(spark, d, "orders").filter("o_totalprice < 0").select(F.col("o_custkey").alias("college_id"), "o_orderkey")
    return R.with_placeholder(none, "college_id")


SLICED = {"customer": "c_custkey", "orders": "o_custkey"}


def _sliced(spark, d):
    return {t: table(spark, d, t).withColumn("college_id", F.col(k)) for t, k in SLICED.items()}


@query("per_entity_groups", " UNION ALL ".join(f"SELECT CAST({k} AS STRING) AS college_id, '{t}' AS dataset, count(*) AS n_rows FROM {t} GROUP BY 1" for t, k in SLICED.items()))
def per_entity_groups(spark, d):
    return R.entity_counts(_sliced(spark, d), "college_id")


@query(
    "entity_slices",
    """SELECT CAST(c_custkey AS STRING) AS college_id, 'customer' AS dataset, '{"c_custkey":' || CAST(c_custkey AS STRING) || ',"c_name":"' || c_name || '"}' AS record FROM customer
 UNION ALL SELECT CAST(o_custkey AS STRING), 'orders', '{"o_custkey":' || CAST(o_custkey AS STRING) || ',"o_orderkey":' || CAST(o_orderkey AS STRING) || '}' FROM orders""",
)
def entity_slices(spark, d):
    rows = {"customer": table(spark, d, "customer").select("c_custkey", "c_name"), "orders": table(spark, d, "orders").select("o_custkey", "o_orderkey")}
    parts = [R.entity_slices({t: df}, SLICED[t]).withColumnRenamed(SLICED[t], "college_id") for t, df in rows.items()]
    return parts[0].union(parts[1])


@query(
    "per_entity_export",
    " UNION ALL ".join(f"SELECT CAST({k} AS STRING) AS college_id, '{t}' AS dataset, count(*) AS n_rows FROM {t} WHERE {k} IN (SELECT c_custkey FROM customer) GROUP BY 1" for t, k in SLICED.items()),
)
def per_entity_export(spark, d):
    """Export by entity, then read back."""
    root = _folder(spark, "export")
    write_per_entity(_sliced(spark, d), root, "first", buckets=8, entities="customer")
    return R.entity_counts({t: spark.read.parquet(f"{root}/{t}") for t in SLICED}, "college_id")


@query(
    "ranking_dedup",
    """WITH e AS (SELECT CAST(user_id AS STRING) AS college_id, event_type AS ranking_body, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(day(ts) AS INT) END AS ranking_year, event_id, event_type FROM events),
 known AS (SELECT DISTINCT college_id, ranking_body, ranking_year FROM e WHERE ranking_body = 'view'),
 fresh AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.college_id = e.college_id AND k.ranking_body = e.ranking_body AND k.ranking_year IS NOT DISTINCT FROM e.ranking_year))
 SELECT college_id, ranking_body, ranking_year, event_id FROM fresh QUALIFY row_number() OVER (PARTITION BY college_id, ranking_body, ranking_year ORDER BY event_id) = 1""",
)
def ranking_dedup(spark, d):
    rows = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("college_id"), F.col("event_type").alias("ranking_body"),
        F.when(F.col("event_id") % 3 != 0, F.dayofmonth("ts")).alias("ranking_year"), "event_id",
    )
    return rankings.dedup_rankings(rows.filter("ranking_body = 'view'"), rows, ["event_id"])


# -- files out and in -------------------------------------------------------------------------


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "listing_file",
    """SELECT 'https://campus.example/' || c_mktsegment || '/' || CAST(c_nationkey AS STRING) AS url, 'say ""' || CAST(max(c_custkey) AS STRING) || '", "x' || chr(10) || 'y", z' AS listing_avg_package, CAST(max(c_custkey) AS STRING) || ' LPA' AS listing_highest_package,
 '' AS listing_placement_percentage, '#' || CAST(max(c_custkey) AS STRING) AS listing_rank FROM customer GROUP BY c_mktsegment, c_nationkey""",
)
def listing_file(spark, d):
    """A listing with repeated addresses, written as CSV and read back: the last row of each stays."""
    rows = table(spark, d, "customer").selectExpr(
        "c_custkey AS ordinal", "'https://campus.example/' || c_mktsegment || '/' || CAST(c_nationkey AS STRING) AS url",
        """'say ""' || CAST(c_custkey AS STRING) || '", "x\n' || 'y", z' AS listing_avg_package""",
        "' ' || CAST(c_custkey AS STRING) || ' LPA ' AS listing_highest_package", "'#' || CAST(c_custkey AS STRING) AS listing_rank",
    )
    path = _folder(spark, "listing")
    write_listing(rows, path)
    return read_listing(spark, path).drop("ordinal")


@query("dataset_file", "SELECT CAST(o_orderkey AS STRING) AS college_id, CAST(o_custkey AS STRING) AS hostel_fees, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS facilities FROM orders")
def dataset_file(spark, d):
    """A dataset written as JSON and read back."""
    rows = table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS college_id", "CAST(o_custkey AS STRING) AS hostel_fees", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS facilities")
    path = _folder(spark, "dataset")
    write_dataset(rows, path, "json")
    return read_dataset(spark, path, DATASETS["hostel"], "json")


@query(
    "bundle",
    "SELECT 'hostel' AS dataset, count(*) AS n_rows, CAST(NULL AS STRING) AS error FROM orders UNION ALL SELECT 'faculty', count(*), NULL FROM supplier UNION ALL SELECT 'reviews', 0, NULL UNION ALL SELECT 'reviews_status', 1, NULL UNION ALL SELECT 'courses', NULL, 'PATH_NOT_FOUND'",
)
def bundle(spark, d):
    """Three datasets written together, one of them empty, and counted where they were put."""
    path = _folder(spark, "bundle")
    rows = {
        "hostel": table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS college_id"),
        "faculty": table(spark, d, "supplier").selectExpr("CAST(s_suppkey AS STRING) AS college_id", "s_name AS faculty_name"),
        "reviews": table(spark, d, "customer").filter("c_custkey < 0").selectExpr("CAST(c_custkey AS STRING) AS college_id"),
    }
    write_bundle(rows, path)

    def reader(name):
        return lambda: spark.read.parquet(f"{path}/{name}")

    return audit_stored(spark, {name: reader(name) for name in (*rows, "reviews_status", "courses")})


@query("page_store", "SELECT 'info' AS page_type, count(*) AS n_pages FROM customer UNION ALL SELECT 'placements', count(*) FROM customer")
def page_store(spark, d):
    """Pages put into a folder per type and read back from one folder at a time."""
    path = _folder(spark, "pages")
    store_pages(profile_pages(spark, d, "info").union(profile_pages(spark, d, "placements")), path)
    kept = [stored_pages(spark, path).filter(F.col("page_type") == kind) for kind in ("info", "placements")]
    return kept[0].union(kept[1]).groupBy("page_type").agg(F.count("html").alias("n_pages"))


@query(
    "page_files",
    """SELECT CAST(s_suppkey AS STRING) AS college_id, lower(replace(s_name, '#', '-')) AS slug, CASE WHEN s_suppkey % 2 = 0 THEN 'info' ELSE 'faculty' END AS page_type,
 '<h1>' || s_name || '</h1>' || chr(10) || '<p>é ' || CAST(s_nationkey AS STRING) || '</p>' AS html FROM supplier""",
)
def page_files(spark, d):
    """Pages saved as a file each, under the names of saved pages, and read from them."""
    path = _folder(spark, "files")
    write_pages(table(spark, d, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS college_id", "lower(replace(s_name, '#', '-')) AS slug", "CASE WHEN s_suppkey % 2 = 0 THEN 'info' ELSE 'faculty' END AS page_type",
        "'<h1>' || s_name || '</h1>\n<p>é ' || CAST(s_nationkey AS STRING) || '</p>' AS html",
    ), path)
    return read_pages(spark, path).drop("url")


# -- listing pages ----------------------------------------------------------------------------

_FIRST = "'https://campus.example/college/' || CAST(s_suppkey AS STRING) || '-a'"
_SHARED = "'https://campus.example/university/' || CAST(s_suppkey % 7 AS STRING) || '-shared'"
_THIRD = "'https://campus.example/colleges/' || CAST(s_suppkey AS STRING) || '-c'"


@query(
    "listing_cards",
    f"""SELECT s_suppkey AS page_no, {_FIRST} AS url, 'A ' || s_name || ' ₹ 4,50,' || CAST(100 + s_nationkey AS STRING) || ' Average Package NIRF Ranking: ' || CAST(s_nationkey + 1 AS STRING) || ' ; Highest Package ₹ 12 LPA 87.5% placed' AS card_text FROM supplier
 UNION ALL SELECT s_suppkey, {_SHARED}, '#' || CAST(s_nationkey + 2 AS STRING) || ' B' FROM supplier""",
)
def listing_cards(spark, d):
    return B.listing_cards(H.with_tree(listing_pages(spark, d)), ["page_no"]).select("page_no", "url", "card_text")


@query(
    "listing_metrics",
    """SELECT s_suppkey AS page_no, '4,50,' || CAST(100 + s_nationkey AS STRING) AS listing_avg_package, '12 LPA' AS listing_highest_package, '87.5%' AS listing_placement_percentage, '#' || CAST(s_nationkey + 1 AS STRING) AS listing_rank FROM supplier
 UNION ALL SELECT s_suppkey, '', '', '', '#' || CAST(s_nationkey + 2 AS STRING) FROM supplier""",
)
def listing_metrics(spark, d):
    cards = B.listing_cards(H.with_tree(listing_pages(spark, d)), ["page_no"])
    rank = B.listing_rank(F.col("card_text"), F.col("strings"))
    return cards.select("page_no", *[c.alias(n) for n, c in B.listing_metrics(F.col("card_text")).items()], rank.alias("listing_rank"))


@query(
    "associate_ranks",
    f"""SELECT s_suppkey AS page_no, '#' || CAST(s_nationkey + 2 AS STRING) AS rank, {_SHARED} AS url FROM supplier
 UNION ALL SELECT s_suppkey, '#' || CAST(s_nationkey + 3 AS STRING), {_THIRD} FROM supplier""",
)
def associate_ranks(spark, d):
    return B.associate_ranks(H.with_tree(listing_pages(spark, d)), ["page_no"]).select("page_no", "rank", "url")


LISTING_SQL = f"""SELECT {_FIRST} AS url, '4,50,' || CAST(100 + s_nationkey AS STRING) AS listing_avg_package, '12 LPA' AS listing_highest_package, '87.5%' AS listing_placement_percentage, '#' || CAST(s_nationkey + 1 AS STRING) AS listing_rank FROM supplier
 UNION ALL SELECT {_SHARED}, '', '', '', '#' || CAST(s_nationkey + 2 AS STRING) FROM supplier QUALIFY row_number() OVER (PARTITION BY s_suppkey % 7 ORDER BY s_suppkey) = 1
 UNION ALL SELECT {_THIRD}, '', '', '', '#' || CAST(s_nationkey + 3 AS STRING) FROM supplier"""


@query("listing_from_pages", LISTING_SQL)
def listing_from_pages(spark, d):
    return B.listing_from_pages(H.with_tree(listing_pages(spark, d))).drop("ordinal")


# -- courses ----------------------------------------------------------------------------------

_DETAIL = {
    "duration": "CASE {d} WHEN 'B.Tech' THEN '4 Years' WHEN 'MBA' THEN '2 Years' WHEN 'M.Sc' THEN '2 Years' WHEN 'BBA' THEN '3 Years' WHEN 'Ph.D' THEN '3-5 Years' WHEN 'B.Des' THEN '4 Years' ELSE 'Not Specified' END",
    "course_level": "CASE {d} WHEN 'MBA' THEN 'PG' WHEN 'M.Sc' THEN 'PG' WHEN 'Ph.D' THEN 'Doctorate' ELSE 'UG' END",
    "entrance_exam": "CASE {d} WHEN 'B.Tech' THEN 'JEE Advanced' WHEN 'MBA' THEN 'CAT' WHEN 'M.Sc' THEN 'IIT JAM' WHEN 'Ph.D' THEN 'GATE / UGC NET' WHEN 'B.Des' THEN 'UCEED' ELSE 'Not Specified' END",
}
_PARTS = f"SELECT CAST(p_partkey AS STRING) AS college_id, p_partkey AS k, {DEGREE} AS d, p_name, p_brand, p_size, CAST(p_size AS STRING) AS size FROM part"
_NS = "'Not Specified'"


def _course(**values: str) -> str:
    row = {
        "college_id": "college_id", "degree_name": "d", "course_name": "p_name", "total_fees": _NS, "duration": _NS, "course_type": "'Full Time'",
        "eligibility": _NS, "entrance_exam": _NS, "application_date": _NS, "intake_seats": _NS, "course_level": "'UG'", **values,
    }
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in row.items()) + " FROM p"


def _detail(field: str) -> str:
    return _DETAIL[field].format(d="d")


_LAKHS = "CASE WHEN p_size >= 10 THEN format('{:g}', p_size / 10.0) || ' Lakhs' ELSE format('{:,}', p_size * 10000) END"
_STATE_LEVEL = "CASE d WHEN 'MBA' THEN 'PG' WHEN 'M.Sc' THEN 'PG' WHEN 'Ph.D' THEN 'Doctorate' ELSE 'UG' END"
_STATE = [
    _course(total_fees=_LAKHS, duration="size || ' Months'", entrance_exam="'E1, E2'", course_level=_STATE_LEVEL),
    _course(course_name="p_brand", total_fees="size || ' Lakhs'", duration="size || ' Months'", entrance_exam="'E1, E2'", course_level=_STATE_LEVEL),
    _course(degree_name="'MCA'", course_name="'General'", total_fees="'on call'", intake_seats="size", course_level="'PG'"),
]
_CARDS = [
    _course(course_name="p_brand", total_fees="'1 L'", duration="'2 Yrs'", course_type="'Part Time'", application_date="'1 May'",
            entrance_exam=_detail("entrance_exam"), course_level=_detail("course_level")),
    _course(degree_name="p_name", course_name="'General'"),
]
_HEADED = "(d IN ('B.Tech', 'M.Sc'))"
_TABLES = [
    _course(degree_name=f"CASE WHEN {_HEADED} THEN '(' || p_name || ')' ELSE d END", course_name=f"CASE WHEN {_HEADED} THEN '(' || p_name || ')' ELSE 'General' END",
            total_fees="size || ' Lakhs'", duration=_detail("duration"), eligibility="'10+2'", entrance_exam=_detail("entrance_exam"), course_level=_detail("course_level")),
    _course(degree_name="'MPP'", course_name="'General'", total_fees="'5,000'", duration="'2 Years'", course_level="'PG'"),
]
# text windows know two levels: a doctorate counts as postgraduate there
_TEXT_LEVEL = "CASE WHEN d IN ('MBA', 'M.Sc', 'Ph.D') THEN 'PG' ELSE 'UG' END"
_CONTEXT = [
    _course(total_fees="size || ' Lakhs'", course_level=_TEXT_LEVEL),
    _course(degree_name="'Y'", course_name="'General'", total_fees="size || ' Lakhs'", course_level=_TEXT_LEVEL),
]


def _union(rows: list[str], where: str = "") -> str:
    return " UNION ALL ".join(r + where for r in rows)


def _courses(spark, d, markup):
    return finish("courses", courses.build_courses(profile_pages(spark, d, "courses", markup)))


@query("courses_from_state", f"WITH p AS ({_PARTS}) " + _union(_STATE))
def courses_from_state(spark, d):
    return _courses(spark, d, COURSE_STATE)


@query("courses_from_cards", f"WITH p AS ({_PARTS}) " + _union(_CARDS))
def courses_from_cards(spark, d):
    return _courses(spark, d, COURSE_CARDS)


@query("courses_from_tables", f"WITH p AS ({_PARTS}) " + _union(_TABLES))
def courses_from_tables(spark, d):
    return _courses(spark, d, COURSE_TABLES)


@query("courses_from_context", f"WITH p AS ({_PARTS}) " + _union(_CONTEXT))
def courses_from_context(spark, d):
    return _courses(spark, d, COURSE_CONTEXT)


# of a page with state and cards, the card row repeats the state's (degree, stream) and goes
_MIXED = (
    _union(_STATE, " WHERE k % 4 = 0") + " UNION ALL " + _CARDS[1] + " WHERE k % 4 = 0 UNION ALL " + _union(_CARDS, " WHERE k % 4 = 1")
    + " UNION ALL " + _union(_TABLES, " WHERE k % 4 = 2") + " UNION ALL " + _union(_CONTEXT, " WHERE k % 4 = 3")
)


@query("datasets_courses", f"WITH p AS ({_PARTS}) " + _MIXED)
def datasets_courses(spark, d):
    return _courses(spark, d, None)


@query(
    "courses_rule_rows",
    """SELECT CAST(p_partkey AS STRING) AS college_id, r.course_name, r.total_fees FROM part, (VALUES ('MBA', 'General', '9 L'), ('MBA', 'Telecommunication Systems Management', '9 L'),
 ('Ph.D', 'Artificial Intelligence', '3.4 Lakhs'), ('Ph.D', 'Information Technology', '3.4 Lakhs'), ('Ph.D', 'Humanities And Social Science', '3.4 Lakhs'), ('Ph.D', 'Public Policy', '3.4 Lakhs')) r(degree, course_name, total_fees)
 WHERE p_partkey % 3 = 0 AND r.degree = CASE p_type WHEN 'PROMO' THEN 'MBA' WHEN 'ECONOMY' THEN 'Ph.D' END""",
)
def courses_rule_rows(spark, d):
    rows = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("college_id"), F.expr(DEGREE).alias("degree_name"), F.lit(0.0).alias("pos"),
        F.when(F.col("p_partkey") % 3 == 0, "Other Courses").otherwise("Unknown").alias("category"), F.lit("9 L").alias("total_fees"),
        *[F.lit("").alias(c) for c in ("course_name", "specialization", "duration", "course_type", "eligibility", "entrance_exam", "application_date", "intake_seats", "course_level")],
    )
    return courses.expanded_rows(rows).select("college_id", "course_name", "total_fees")


# -- colleges, placements, rankings -------------------------------------------------------------

_LISTED = "SELECT 'https://campus.example/' || CASE WHEN c_custkey % 2 = 0 THEN 'university' ELSE 'college' END || '/' || CAST(c_custkey AS STRING) || '-c-' || CAST(c_custkey AS STRING) AS url, '#' || CAST(c_nationkey AS STRING) AS listing_rank, CAST(c_custkey AS STRING) || ' LPA' AS listing_avg_package, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '77 LPA' END AS listing_highest_package, '50%' AS listing_placement_percentage, c_custkey FROM customer WHERE c_nationkey % 3 = 0"


def _listing(spark, d):
    rows = table(spark, d, "customer").filter("c_nationkey % 3 = 0")
    return rows.selectExpr(
        "'https://campus.example/' || CASE WHEN c_custkey % 2 = 0 THEN 'university' ELSE 'college' END || '/' || CAST(c_custkey AS STRING) || '-c-' || CAST(c_custkey AS STRING) AS url",
        "'#' || CAST(c_nationkey AS STRING) AS listing_rank", "CAST(c_custkey AS STRING) || ' LPA' AS listing_avg_package",
        "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '77 LPA' END AS listing_highest_package", "'50%' AS listing_placement_percentage",
    )


@query(
    "datasets_colleges",
    f"""WITH l AS ({_LISTED}) SELECT CAST(c_custkey AS STRING) AS college_id, CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_mktsegment || ' College' END AS name,
 coalesce(l.url, 'https://campus.example/university/' || CAST(c_custkey AS STRING) || '-c-' || CAST(c_custkey AS STRING)) AS url,
 CASE WHEN contains(coalesce(l.url, 'university'), 'university') THEN 'University' ELSE 'College' END AS college_type,
 CASE c_custkey % 3 WHEN 0 THEN 'Public' WHEN 1 THEN 'Private' ELSE '' END AS ownership, CAST(1900 + c_nationkey AS INT) AS established_year, 'UGC, AICTE' AS accreditation, c_mktsegment || ' Board' AS affiliation,
 CASE WHEN c_custkey % 4 = 0 THEN 'Not Rated' ELSE CAST(c_nationkey + 1 AS STRING) || '.5' END AS rating, coalesce('CG Rank ' || l.listing_rank, 'Rank #' || CAST(c_nationkey + 1 AS STRING)) AS ranking,
 CASE WHEN c_custkey % 5 = 0 THEN 'Pune' WHEN c_custkey % 4 = 0 THEN 'Agra' ELSE c_mktsegment END AS city, CASE WHEN c_custkey % 5 = 0 THEN 'Maharashtra' WHEN c_custkey % 4 = 0 THEN 'Bihar' ELSE 'Goa' END AS state,
 'About ' || c_name AS overview_description, CASE WHEN c_custkey % 4 = 0 THEN 'Not Specified' ELSE 'Address: ' || CAST(c_custkey AS STRING) || ' Road, ' || c_mktsegment || ', Goa, India | Tel: ' || CAST(c_custkey AS STRING) END AS contact_info
 FROM customer LEFT JOIN l USING (c_custkey)""",
)
def datasets_colleges(spark, d):
    return finish("colleges", colleges.build_colleges(profile_pages(spark, d, "info"), _listing(spark, d)))


_PAY = "CASE WHEN {v} >= 10000000 AND {v} % 10000000 = 0 THEN CAST({v} // 10000000 AS STRING) || ' Crore' WHEN {v} >= 10000000 THEN format('{{:.2f}}', {v} / 10000000) || ' Cr' WHEN {v} % 100000 = 0 THEN CAST({v} // 100000 AS STRING) || ' LPA' WHEN {v} >= 100000 THEN format('{{:.2f}}', {v} / 100000) || ' LPA' END"
_HIGH = _PAY.format(v="(n * 1000000)")
_MEAN = _PAY.format(v="(n * 100000 + 50000)")
_PLACED = f"""SELECT CAST(c_custkey AS STRING) AS college_id, c_custkey,
 CASE c_custkey % 5 WHEN 0 THEN {_HIGH} WHEN 1 THEN CAST(n AS STRING) || '.5 LPA' WHEN 2 THEN 'INR ' || CAST(n AS STRING) || ' LPA' WHEN 3 THEN CAST(n AS STRING) || ' Lakh' ELSE CAST(n AS STRING) || '.1 Cr' END AS highest_package,
 CASE c_custkey % 5 WHEN 0 THEN {_MEAN} WHEN 1 THEN '6 LPA' END AS average_package, CASE c_custkey % 5 WHEN 1 THEN '5 LPA' WHEN 4 THEN '34 LPA' END AS median_package, '95% placements' AS placement_percentage,
 CASE c_custkey % 5 WHEN 1 THEN 'A & B Ltd' WHEN 2 THEN 'Acme, ' || c_mktsegment WHEN 3 THEN 'Google, TCS' WHEN 4 THEN 'Bain' END AS top_recruiters FROM (SELECT *, c_nationkey + 1 AS n FROM customer)"""


@query("datasets_placements", f"WITH p AS ({_PLACED}) SELECT college_id, " + ", ".join(f"coalesce({c}, 'Not Specified') AS {c}" for c in DATASETS["placements"].fieldNames()[1:]) + " FROM p")
def datasets_placements(spark, d):
    return finish("placements", placements.build_placements(profile_pages(spark, d, "placements")))


@query(
    "fill_from_listing",
    f"""WITH p AS ({_PLACED}), l AS ({_LISTED}) SELECT p.college_id, highest_package, coalesce(average_package, l.listing_avg_package) AS average_package, placement_percentage
 FROM p LEFT JOIN l USING (c_custkey)""",
)
def fill_from_listing(spark, d):
    built = placements.build_placements(profile_pages(spark, d, "placements"))
    return placements.fill_from_listing(built, _listing(spark, d)).select("college_id", "highest_package", "average_package", "placement_percentage")


_STATE_RANKS = """SELECT CAST(c_custkey AS STRING) AS college_id, CASE v WHEN 0 THEN 'NIRF' ELSE 'Campus Guide (MBA)' END AS ranking_body, CASE v WHEN 0 THEN '#' ELSE 'CG Rank #' END || CAST(c_nationkey + 1 AS STRING) AS rank,
 CASE v WHEN 0 THEN CAST(2024 AS INT) END AS ranking_year FROM customer, (VALUES (0), (1)) x(v) WHERE c_custkey % 3 = 1"""
_TEXT_RANKS = """SELECT CAST(c_custkey AS STRING) AS college_id, CASE v WHEN 0 THEN 'NIRF' WHEN 1 THEN 'Outlook' ELSE 'Campus Guide' END AS ranking_body,
 CASE v WHEN 1 THEN '#7' WHEN 0 THEN '#' || CAST(c_nationkey + 1 AS STRING) ELSE 'CG Rank #' || CAST(c_nationkey + 1 AS STRING) END AS rank, CASE v WHEN 0 THEN CAST(2023 AS INT) END AS ranking_year FROM customer, (VALUES (0), (1), (2)) x(v)"""


def _ranked_pages(spark, d):
    return profile_pages(spark, d, "info").union(profile_pages(spark, d, "placements"))


@query("rankings_from_state", _STATE_RANKS)
def rankings_from_state(spark, d):
    return rankings.rankings_from_state(_ranked_pages(spark, d)).select(*DATASETS["rankings"].fieldNames())


@query("rankings_from_text", _TEXT_RANKS)
def rankings_from_text(spark, d):
    texts = H.with_main_text(H.with_tree(_ranked_pages(spark, d).select("college_id", "slug", "page_type", "html")))
    return rankings.rankings_from_text(texts).select(*DATASETS["rankings"].fieldNames())


@query("datasets_rankings", _STATE_RANKS + " UNION ALL " + _TEXT_RANKS + " WHERE c_custkey % 3 <> 1")
def datasets_rankings(spark, d):
    return finish("rankings", rankings.build_rankings(_ranked_pages(spark, d)))


# -- the other datasets -------------------------------------------------------------------------

_FACULTY_SQL = """SELECT CAST(s_suppkey AS STRING) AS college_id, CASE WHEN s_suppkey % 2 = 0 THEN (CASE v WHEN 0 THEN 'Dr ' ELSE 'Mx ' END) ELSE (CASE v WHEN 0 THEN 'Dr. ' ELSE 'Professor ' END) END || s_name AS faculty_name,
 CASE WHEN s_suppkey % 2 = 0 THEN (CASE v WHEN 0 THEN 'Dean' ELSE 'Professor' END) ELSE (CASE v WHEN 0 THEN 'Associate Professor' ELSE 'Professor' END) END AS designation,
 CASE WHEN s_suppkey % 2 = 0 AND v = 1 THEN 'Art' ELSE 'Engineering' END AS department FROM supplier, (VALUES (0), (1)) x(v)"""
_SCHOLARSHIP_SQL = """SELECT CAST(p_partkey AS STRING) AS college_id, p_name || ' Scholarship' AS scholarship_name, 'Top ' || CAST(p_size AS STRING) AS eligibility, 'INR 5,000' AS amount FROM part WHERE p_partkey % 3 = 0
 UNION ALL SELECT CAST(p_partkey AS STRING), 'Merit scholarship', 'All', 'Not Specified' FROM part WHERE p_partkey % 3 = 0
 UNION ALL SELECT CAST(p_partkey AS STRING), p_name || ' scholarship', 'Income / Merit based', 'Tution fee waiver / Cash' FROM part WHERE p_partkey % 3 = 1
 UNION ALL SELECT CAST(p_partkey AS STRING), 'Scholarship', 'Income / Merit based', 'Tution fee waiver / Cash' FROM part WHERE p_partkey % 3 = 1"""
_HOSTEL_SQL = "SELECT CAST(o_orderkey AS STRING) AS college_id, CAST(o_custkey AS STRING) || ',000 per' AS hostel_fees, CASE o_orderkey % 3 WHEN 0 THEN 'Wi-Fi, Gym' WHEN 1 THEN 'Mess, Sports' ELSE 'Not Specified' END AS facilities FROM orders"
_REVIEW_SQL = """SELECT CAST(c_custkey AS STRING) AS college_id, c_name AS reviewer_name, c_nationkey % 5 + 0.5::DOUBLE AS rating, 'Good ' || c_mktsegment AS review_text FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT CAST(c_custkey AS STRING), 'Anonymous Student', 4.0, 'Fine' FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT CAST(c_custkey AS STRING), 'Alumni Reviewer', 4.5, 'Pros: ' || c_mktsegment FROM customer WHERE c_custkey % 3 = 1"""
_ADMISSION_SQL = """SELECT CAST(p_partkey AS STRING) AS college_id, CASE WHEN p_partkey % 2 = 0 THEN 'Merit ' || p_brand ELSE 'by ' || p_name END AS admission_process,
 CASE WHEN p_partkey % 2 = 0 THEN 'Not Specified' ELSE 'JEE Main, GATE' END AS exams_accepted, 'Not Specified' AS eligibility_criteria, CASE WHEN p_partkey % 2 = 0 THEN '1 May' ELSE 'Not Specified' END AS important_dates,
 'Not Specified' AS application_deadlines FROM part"""


def _register(name, sql, job):
    @query(f"datasets_{name}", sql)
    def build(spark, d):
        return finish(name, job(profile_pages(spark, d, name)))


_register("faculty", _FACULTY_SQL, people.build_faculty)
_register("scholarships", _SCHOLARSHIP_SQL, people.build_scholarships)
_register("hostel", _HOSTEL_SQL, people.build_hostel)
_register("reviews", _REVIEW_SQL, people.build_reviews)
_register("admissions", _ADMISSION_SQL, people.build_admissions)


@query("new_pages", "SELECT CAST(c_custkey AS STRING) AS college_id, 'info' AS page_type FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT CAST(c_custkey AS STRING), 'placements' FROM customer")
def unparsed_pages(spark, d):
    seen = table(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS college_id", "'c-' || CAST(o_custkey AS STRING) AS slug", "'info' AS page_type").distinct()
    return new_pages(_ranked_pages(spark, d), seen).select("college_id", "page_type")


_COUNTS = {
    "colleges": "SELECT 1 FROM customer", "courses": f"WITH p AS ({_PARTS}) " + _MIXED, "admissions": _ADMISSION_SQL, "placements": "SELECT 1 FROM customer",
    "rankings": _STATE_RANKS + " UNION ALL " + _TEXT_RANKS + " WHERE c_custkey % 3 <> 1", "faculty": _FACULTY_SQL, "scholarships": _SCHOLARSHIP_SQL, "hostel": _HOSTEL_SQL, "reviews": _REVIEW_SQL,
}


@query("stream_ingest", " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n_rows FROM ({s}) AS t" for n, s in _COUNTS.items()))
def stream_ingest(spark, d):
    """Pages of every type arrive as files and are parsed batch by batch."""
    root = _folder(spark, "stream")
    all_pages(spark, d).write.parquet(f"{root}/in")
    stream_pages(spark, f"{root}/in", f"{root}/out", f"{root}/progress", files_per_batch=20, buckets=8)
    return audit_counts(load_datasets(spark, f"{root}/out"))


_WAVES = 4


@query(
    "stream_progress",
    f"""WITH w AS (SELECT i AS batch, count(*) FILTER (c_custkey % {_WAVES} = i) AS n, count(*) FILTER (i > 0 AND c_custkey % {_WAVES} = i - 1 AND c_custkey % 3 = 0) AS again,
 count(*) FILTER (c_custkey % {_WAVES} = i AND c_custkey % 10 = 0) AS bad FROM customer, range({_WAVES}) r(i) GROUP BY i),
 b AS (SELECT batch, n + again AS rows_in, n AS new, n - bad AS saved, bad AS rejected FROM w),
 t AS (SELECT *, CAST(sum(saved) OVER s - saved AS BIGINT) AS saved_before, CAST(sum(rejected) OVER s - rejected AS BIGINT) AS rejected_before FROM b WINDOW s AS (ORDER BY batch))
 SELECT *, saved_before + saved AS saved_after, rejected_before + rejected AS rejected_after, true AS timed FROM t""",
)
def ingest_progress(spark, d):
    """Pages that arrive in waves, some of them again and some unreadable: what the stream tells of each batch."""
    root = _folder(spark, "progress")
    key = F.col("college_id").cast("bigint")
    pages = profile_pages(spark, d, "reviews")
    pages = pages.withColumn("html", F.when(key % 10 == 0, F.lit("<p>a</p><![foo[x]]>")).otherwise(F.col("html")))
    for i in range(_WAVES):
        again = (key % _WAVES == i - 1) & (key % 3 == 0) & (F.lit(i) > 0)
        # as many files in each wave, one wave a batch: files are taken in the order they were written
        pages.filter((key % _WAVES == i) | again).repartition(2, "college_id").write.mode("append").parquet(f"{root}/in")
    stream_pages(spark, f"{root}/in", f"{root}/out", f"{root}/offsets", files_per_batch=2, buckets=4)
    told = stream_progress(spark, f"{root}/out")
    return told.withColumn("timed", (F.col("trigger_ms") >= F.col("batch_ms")) & (F.col("batch_ms") > 0)).drop("trigger_ms", "batch_ms")


@query("seen_batches", "SELECT b AS batch, count(*) AS n_new FROM (SELECT o_custkey, min(o_orderkey % 9) AS b FROM orders GROUP BY o_custkey) GROUP BY b")
def seen_batches(spark, d):
    """Keys of batches that come one after the other, past a fold: in each the ones that no earlier batch had."""
    root = _folder(spark, "seen")
    orders = table(spark, d, "orders")
    for i in range(9):
        arrived = orders.filter(F.col("o_orderkey") % 9 == i).select(F.col("o_custkey").cast("string").alias("customer"))
        new = seen.unseen(arrived, root, ["customer"], str(i))
        new.write.parquet(f"{root}/found/batch={i}")
        seen.add(spark.read.schema("customer string").parquet(f"{root}/found/batch={i}"), root, ["customer"], str(i))
    return spark.read.parquet(f"{root}/found").groupBy(F.col("batch").cast("bigint").alias("batch")).agg(F.count("customer").alias("n_new"))


def _split_arrival(spark, d, kinds):
    """Rankings of pages of one type that arrive in a later batch than those of the other."""
    root = _folder(spark, "split")
    for i, kind in enumerate(kinds):
        parse_batch(profile_pages(spark, d, kind), f"{root}/out", str(i), buckets=8)
    return load_datasets(spark, f"{root}/out")["rankings"]


@query("stream_ingest_split", _STATE_RANKS + " UNION ALL " + _TEXT_RANKS + " WHERE c_custkey % 3 <> 1")
def stream_ingest_split(spark, d):
    return _split_arrival(spark, d, ["placements", "info"])


@query("stream_ingest_split_back", _STATE_RANKS + " UNION ALL " + _TEXT_RANKS + " WHERE c_custkey % 3 <> 1")
def stream_ingest_split_back(spark, d):
    return _split_arrival(spark, d, ["info", "placements"])


@query("dataset_rejects", "SELECT '{}' AS fields, '{\"college_id\": ' || CAST(o_orderkey AS STRING) AS record FROM orders WHERE o_orderkey % 5 = 0")
def dataset_rejects(spark, d):
    """Lines of a JSON dataset, every fifth cut off: what cannot be read is kept as it stands."""
    path = _folder(spark, "broken")
    table(spark, d, "orders").selectExpr("'{\"college_id\": ' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '}' END AS value").write.text(path)
    return rejected_records(spark, path, DATASETS["hostel"]).select("fields", "record")
