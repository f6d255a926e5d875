"""Queries over addresses, fetches and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusweave.catalog.registry import pages, query, dealt_table, table
from campusweave.operators import audit as A
from campusweave.operators import frontier as B
from campusweave.operators import html as H
from campusweave.operators import relational as R
from campusweave.operators.ordinals import split_parts
from campusweave.rules.vocab import PAGE_SUFFIXES
from campusweave.sources.datasets import merge_parts

# addresses as a crawl would leave them, one per customer; the same text in both dialects
RAW_URL = """
CASE c_custkey % 3 WHEN 0 THEN 'https://campus.example' WHEN 1 THEN '//campus.example' ELSE '' END
|| '/' || CASE c_nationkey % 3 WHEN 0 THEN 'university' WHEN 1 THEN 'college' ELSE 'colleges' END
|| '/' || CAST(c_custkey AS STRING) || '-' || lower(replace(c_name, '#', '-'))
|| CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN '/' WHEN 2 THEN '/courses-fees' WHEN 3 THEN '?utm=1'
   WHEN 4 THEN '#top' WHEN 5 THEN '/reviews/' ELSE '/events' END
"""
SUBPAGES = (
    "(?i)/(courses?-fees?|admission|placement|reviews?|faculty|scholarship|hostel|cutoff|ranking|gallery"
    "|news|contact|about|infrastructure|alumni|events?)/?$"
)
AUDIT_SUBPAGES = "(?i)/(ranking|courses-fees|placement|admission|reviews|faculty|scholarship|hostel|cutoff)/?$"
CLEAN_URL = """trim(regexp_replace(CASE WHEN starts_with({u}, '//') THEN 'https:' || {u}
 WHEN starts_with({u}, '/') THEN 'https://campus.example' || {u} ELSE {u} END, '[?#].*$', ''))"""
FRONTIER_SQL = f"""WITH raw AS (SELECT c_custkey AS ordinal, {RAW_URL} AS raw_url FROM customer),
frontier AS (SELECT ordinal, {CLEAN_URL.format(u='raw_url')} AS url FROM raw),
profiles AS (SELECT * FROM frontier WHERE regexp_matches(url, '/(colleges?|university)/[0-9]+') AND NOT regexp_matches(url, '{SUBPAGES}')),
parsed AS (SELECT *, regexp_extract(url, '/(colleges?|university)/([0-9]+)-([^/?#]+)', 1) AS type,
  regexp_extract(url, '/(colleges?|university)/([0-9]+)-([^/?#]+)', 2) AS id,
  regexp_extract(url, '/(colleges?|university)/([0-9]+)-([^/?#]+)', 3) AS slug FROM profiles)
"""


def raw_frontier(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("ordinal"), F.expr(RAW_URL).alias("url"))


def frontier(spark, d):
    return B.clean_urls(raw_frontier(spark, d))


def profiles(spark, d):
    return B.parse_profile_urls(B.filter_profile_urls(frontier(spark, d)))


@query("clean_url", f"SELECT page_id, {CLEAN_URL.format(u='url')} AS url FROM pages")
def clean_url(spark, d):
    return B.clean_urls(table(spark, d, "pages").select("page_id", "url"))


@query("clean_profile_url", FRONTIER_SQL + "SELECT ordinal, url FROM frontier")
def clean_profile_url(spark, d):
    return frontier(spark, d)


@query("url_suffix_filter", FRONTIER_SQL + "SELECT ordinal, url FROM profiles")
def url_suffix_filter(spark, d):
    return B.filter_profile_urls(frontier(spark, d))


@query("url_parts", FRONTIER_SQL + "SELECT url, type, id, slug, 'https://campus.example/' || type || '/' || id || '-' || slug AS base_url FROM parsed")
def url_parts(spark, d):
    return profiles(spark, d).select("url", "type", "id", "slug", "base_url")


@query(
    "url_page_type",
    FRONTIER_SQL
    + """SELECT ordinal, page_type FROM (SELECT ordinal, url, CAST(ordinal AS STRING) AS id FROM frontier),
 (VALUES """
    + ", ".join(f"('{k}', '{v}')" for k, v in PAGE_SUFFIXES.items())
    + """) m(page_type, suffix)
 WHERE contains(url, id) AND contains(lower(url), suffix)
 AND (page_type <> 'info' OR NOT regexp_matches(lower(url), '/courses-fees|/admission|/placement|/reviews|/faculty|/scholarship|/hostel|/cutoff'))""",
)
def url_page_type(spark, d):
    return B.page_type_of_url(frontier(spark, d).withColumn("id", F.col("ordinal").cast("string"))).select("ordinal", "page_type")


@query(
    "frontier_expand",
    FRONTIER_SQL
    + "SELECT id, page_type, 'https://campus.example/' || type || '/' || id || '-' || slug || suffix AS page_url FROM parsed, (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in PAGE_SUFFIXES.items())
    + ") m(page_type, suffix)",
)
def frontier_expand(spark, d):
    return B.expand_frontier(profiles(spark, d)).select("id", "page_type", "page_url")


@query(
    "entity_slug",
    f"""WITH raw AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN {RAW_URL} ELSE '/none' END AS url FROM customer)
 SELECT c_custkey, CASE WHEN regexp_matches(url, '/(colleges?|university)/[0-9]+-[^/?#]+') THEN regexp_extract(url, '/(colleges?|university)/([0-9]+)-([^/?#]+)', 3)
  ELSE regexp_replace(lower(trim(regexp_replace(c_name || ' é College', '[^a-zA-Z0-9 \\-]', '', 'g'))), '[ \\-]+', '-', 'g') END AS slug FROM raw""",
)
def entity_slug(spark, d):
    url = F.when(F.col("c_custkey") % 2 == 0, F.expr(RAW_URL)).otherwise("/none")
    name = F.concat("c_name", F.lit(" é College"))
    return table(spark, d, "customer").select("c_custkey", B.entity_slug(url, name).alias("slug"))


@query("attempted", "SELECT doc_id AS id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1")
def attempted(spark, d):
    labels = table(spark, d, "labels").withColumnRenamed("doc_id", "id")
    return B.attempted_ids(labels.filter("quality = 1"), labels.filter("toxic = 1"))


@query("pending", "SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending(spark, d):
    listing = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("doc_id").alias("ordinal"))
    return B.pending_urls(listing, table(spark, d, "labels").withColumnRenamed("doc_id", "id")).select("id", "source")


@query(
    "pending_batch",
    "SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 50",
)
def pending_batch(spark, d):
    listing = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("doc_id").alias("ordinal"))
    return B.pending_urls(listing, table(spark, d, "labels").withColumnRenamed("doc_id", "id"), limit=50).select("id", "source")


@query(
    "pending_half",
    "SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT (SELECT count(*) // 2 FROM documents)",
)
def pending_half(spark, d):
    """A batch as large as half the listing: selected by ranges of the order."""
    listing = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("doc_id").alias("ordinal"))
    attempted = table(spark, d, "labels").withColumnRenamed("doc_id", "id")
    return B.pending_urls(listing, attempted, limit=listing.count() // 2, merged=0).select("id", "source")


BLOCKED_SQL = "(length(html) < 2000 OR regexp_matches(lower(html), 'the request could not be satisfied|generated by cloudfront|403 error|access denied|attention required'))"


@query("block_pages", f"SELECT page_id, {BLOCKED_SQL} AS blocked FROM pages")
def block_pages(spark, d):
    return B.flag_block_pages(table(spark, d, "pages")).select("page_id", "blocked")


@query(
    "host_summary",
    f"""SELECT regexp_extract(regexp_replace(url, '[?#].*$', ''), '^https?://([^/]+)', 1) AS host, count(*) AS n_pages,
 CAST(count(*) FILTER ({BLOCKED_SQL}) AS BIGINT) AS n_blocked, CAST(sum(length(html)) AS BIGINT) AS n_chars,
 max(length(regexp_extract(html, '<title>([^<]*)</title>', 1))) AS longest_title FROM pages GROUP BY 1""",
)
def host_summary(spark, d):
    """Pages, blocked pages and text volume per host; JVM only."""
    scan = B.flag_block_pages(B.clean_urls(table(spark, d, "pages")))
    return scan.groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if("blocked").alias("n_blocked"),
        F.sum(F.length("html")).alias("n_chars"),
        F.max(F.length(F.regexp_extract("html", "<title>([^<]*)</title>", 1))).cast("bigint").alias("longest_title"),
    )


STATUS = """CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 404 WHEN 'signup' THEN 410 WHEN 'error' THEN 403 ELSE 500 END"""
KIND = "CASE WHEN user_id % 2 = 0 THEN 'info' ELSE 'hostel' END"


@query(
    "outcome_class",
    f"""WITH f AS (SELECT event_id, {STATUS} AS status, {KIND} AS page_type FROM events),
 o AS (SELECT *, CASE WHEN status < 400 THEN 'ok' WHEN status IN (404, 410) THEN (CASE page_type WHEN 'info' THEN 'removed' ELSE 'absent' END) ELSE 'blocked' END AS outcome FROM f)
 SELECT event_id, status, page_type, outcome, CASE outcome WHEN 'removed' THEN 'WARNING' WHEN 'blocked' THEN 'ERROR' ELSE 'INFO' END AS log_level, outcome = 'blocked' AS pending FROM o""",
)
def outcome_class(spark, d):
    return B.classify_fetches(table(spark, d, "events").select("event_id", F.expr(STATUS).alias("status"), F.expr(KIND).alias("page_type")))


@query("skip_list", "SELECT o_custkey AS id FROM orders GROUP BY 1 HAVING NOT bool_or(o_orderstatus = 'F')")
def skip_list(spark, d):
    return B.skip_list(table(spark, d, "orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderstatus") == "F").alias("saved")))


def page_links(spark, d):
    """Links of the page table in document order."""
    links = F.filter("nodes", lambda n: (n["tag"] == "a") & F.try_element_at(n["attrs"], F.lit("href")).isNotNull())
    hrefs = F.transform(links, lambda n: n["attrs"]["href"])
    return H.with_tree(pages(spark, d)).select("page_id", F.posexplode(hrefs).alias("pos", "href"))


LINKS_SQL = """WITH l AS (SELECT page_id, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">', 1), 1) - 1 AS pos,
 unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages) """


@query("links", LINKS_SQL + "SELECT page_id, pos, href FROM l")
def links(spark, d):
    return page_links(spark, d)


@query("link_first_seen", LINKS_SQL + "SELECT href, page_id, pos FROM l QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, pos) = 1")
def link_first_seen(spark, d):
    return B.first_seen(page_links(spark, d), "href", ["page_id", "pos"]).select("href", "page_id", "pos")


@query(
    "frontier_growth",
    LINKS_SQL
    + """, u AS (SELECT 0 AS batch, page_id AS o, 0 AS pos, url FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)
 UNION ALL SELECT 1, page_id, pos, 'https://campus.example' || href FROM l)
 SELECT batch, url FROM u QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch, o, pos) = 1""",
)
def frontier_growth(spark, d):
    known = B.clean_urls(table(spark, d, "pages").select("url", F.struct(F.col("page_id").alias("page"), F.lit(0).alias("pos")).alias("ordinal")))
    found = page_links(spark, d).select(F.concat(F.lit("https://campus.example"), "href").alias("url"), F.struct(F.col("page_id").alias("page"), "pos").alias("ordinal"))
    return B.grow_frontier(known, found).select("batch", "url")


@query(
    "frontier_capped",
    LINKS_SQL
    + """, u AS (SELECT 0 AS batch, page_id AS o, 0 AS pos, url FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)
 UNION ALL SELECT 1, page_id, pos, 'https://campus.example' || href FROM l),
 k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch, o, pos) = 1)
 SELECT batch, url FROM k ORDER BY batch, o, pos LIMIT 300""",
)
def frontier_capped(spark, d):
    """As above, up to a target size."""
    known = B.clean_urls(table(spark, d, "pages").select("url", F.struct(F.col("page_id").alias("page"), F.lit(0).alias("pos")).alias("ordinal")))
    found = page_links(spark, d).select(F.concat(F.lit("https://campus.example"), "href").alias("url"), F.struct(F.col("page_id").alias("page"), "pos").alias("ordinal"))
    return B.grow_frontier(known, found, cap=300).select("batch", "url")


@query(
    "frontier_half",
    LINKS_SQL
    + """, u AS (SELECT 0 AS batch, page_id AS o, 0 AS pos, url FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)
 UNION ALL SELECT 1, page_id, pos, 'https://campus.example' || href FROM l),
 k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch, o, pos) = 1)
 SELECT batch, url FROM k ORDER BY batch, o, pos LIMIT (SELECT count(*) * 3 // 2 FROM pages)""",
)
def frontier_half(spark, d):
    """As above, the size being half as much again as there are known addresses: selected by ranges of the order."""
    pages = table(spark, d, "pages")
    known = B.clean_urls(pages.select("url", F.struct(F.col("page_id").alias("page"), F.lit(0).alias("pos")).alias("ordinal")))
    found = page_links(spark, d).select(F.concat(F.lit("https://campus.example"), "href").alias("url"), F.struct(F.col("page_id").alias("page"), "pos").alias("ordinal"))
    return B.grow_frontier(known, found, cap=pages.count() * 3 // 2, merged=0).select("batch", "url")


DAY = "CAST(day(ts) AS BIGINT)"


@query(
    "novelty_stagnation",
    f"""WITH f AS (SELECT {DAY} AS page_no, user_id AS url FROM events),
 g AS (SELECT p AS page_no, count(*) AS gained FROM (SELECT url, min(page_no) AS p FROM f GROUP BY 1) GROUP BY 1),
 a AS (SELECT page_no, coalesce(gained, 0) AS gained FROM (SELECT DISTINCT page_no FROM f UNION SELECT CAST(c_nationkey + 35 AS BIGINT) FROM customer UNION SELECT CAST(31 + r_regionkey AS BIGINT) FROM region) LEFT JOIN g USING (page_no))
 SELECT page_no, gained, coalesce(sum(gained) OVER w = 0 AND count(*) OVER w = 3, false) AS stop FROM a WINDOW w AS (ORDER BY page_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def novelty_stagnation(spark, d):
    """Days as listing pages; pages after them list nothing."""
    found = table(spark, d, "events").select(F.expr(DAY).alias("page_no"), F.col("user_id").alias("url"))
    more = table(spark, d, "customer").selectExpr("CAST(c_nationkey + 35 AS BIGINT) AS page_no").union(table(spark, d, "region").selectExpr("CAST(31 + r_regionkey AS BIGINT)"))
    return B.listing_novelty(found, found.select("page_no").union(more))


@query("audit_dirty_urls", FRONTIER_SQL + f"SELECT count(*) AS total, count(*) FILTER (regexp_matches(url, '{AUDIT_SUBPAGES}')) AS dirty FROM frontier")
def audit_dirty_urls(spark, d):
    return A.audit_dirty_urls(frontier(spark, d))


@query("audit_dirty_samples", FRONTIER_SQL + f"SELECT ordinal, url FROM frontier WHERE regexp_matches(url, '{AUDIT_SUBPAGES}') ORDER BY ordinal LIMIT 5")
def audit_dirty_samples(spark, d):
    return A.dirty_url_samples(frontier(spark, d))


AUDIT_SQL = (
    f"WITH l AS (SELECT o_orderkey AS ordinal, '/college/' || CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey AS STRING) AS url FROM orders),"
    " k AS (SELECT ordinal, url, regexp_extract(url, '/([0-9]+)-', 1) AS id FROM l QUALIFY row_number() OVER (PARTITION BY regexp_extract(url, '/([0-9]+)-', 1) ORDER BY ordinal DESC) = 1),"
    " p AS (SELECT * FROM k WHERE id NOT IN (SELECT CAST(doc_id AS STRING) FROM labels)) "
)


def _audited(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ordinal"), F.expr("'/college/' || CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey AS STRING)").alias("url")
    )
    return orders, table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"))


@query("audit_pending", AUDIT_SQL + "SELECT count(*) AS pending FROM p")
def audit_pending(spark, d):
    return A.audit_pending(*_audited(spark, d))


@query("audit_pending_samples", AUDIT_SQL + "SELECT id, url FROM p ORDER BY ordinal LIMIT 3")
def audit_pending_samples(spark, d):
    return A.pending_samples(*_audited(spark, d)).select("id", "url")


COUNTED = ["pages", "documents", "labels", "conversations", "benchmark", "embeddings", "events", "customer", "supplier", "part", "orders", "lineitem", "nation", "region"]


@query("dataset_counts", " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS n_rows FROM {t}" for t in COUNTED))
def dataset_counts(spark, d):
    return A.audit_counts({t: table(spark, d, t) for t in COUNTED})


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
COMPLETE_SQL = (
    "WITH e AS (SELECT o_custkey AS college_id, o_orderpriority AS page_type FROM orders), a AS (SELECT college_id, "
    + " + ".join(f"CAST(bool_or(page_type = '{t}') AS INT)" for t in PRIORITIES)
    + " AS present, concat_ws(', ', "
    + ", ".join(f"CASE WHEN NOT bool_or(page_type = '{t}') THEN '{t}' END" for t in PRIORITIES)
    + ") AS missing FROM e GROUP BY 1) "
)


def _completeness(spark, d):
    found = table(spark, d, "orders").select(F.col("o_custkey").alias("college_id"), F.col("o_orderpriority").alias("page_type"))
    return A.audit_completeness(found, expected=PRIORITIES)


@query("completeness", COMPLETE_SQL + "SELECT college_id, present, missing, present = 5 AS complete FROM a")
def completeness(spark, d):
    return _completeness(spark, d)


@query("completeness_totals", COMPLETE_SQL + "SELECT count(*) AS entities, count(*) FILTER (present = 5) AS complete, count(*) FILTER (present < 5) AS partial FROM a")
def completeness_totals(spark, d):
    return A.completeness_totals(_completeness(spark, d))


@query("incomplete_samples", COMPLETE_SQL + "SELECT college_id, missing FROM a WHERE present < 5 ORDER BY college_id LIMIT 10")
def incomplete_samples(spark, d):
    return A.incomplete_samples(_completeness(spark, d)).select("college_id", "missing")


@query(
    "batch_progress",
    f"""WITH c AS (SELECT {DAY} AS batch, count(*) FILTER (event_type <> 'error') AS new_saved, count(*) FILTER (event_type = 'error') AS new_skipped FROM events GROUP BY 1),
 s AS (SELECT *, CAST(sum(new_saved) OVER (ORDER BY batch) AS BIGINT) AS saved_after, CAST(sum(new_skipped) OVER (ORDER BY batch) AS BIGINT) AS skipped_after FROM c)
 SELECT batch, new_saved, new_skipped, saved_after - new_saved AS saved_before, skipped_after - new_skipped AS skipped_before, saved_after, skipped_after FROM s""",
)
def batch_progress(spark, d):
    return A.batch_progress(table(spark, d, "events").select(F.expr(DAY).alias("batch"), (F.col("event_type") != "error").alias("saved")))


# one log line per event, worded like the run log; the same text in both dialects
LOG_LINE = """'[2024-01-' || CASE WHEN day(ts) < 10 THEN '0' ELSE '' END || CAST(day(ts) AS STRING) || ' 10:00:00] '
 || CASE event_type WHEN 'click' THEN 'WARNING' WHEN 'error' THEN 'ERROR' ELSE 'INFO' END || ' [fetch.py:' || CAST(user_id AS STRING) || '] '
 || CASE event_type WHEN 'click' THEN 'HTTP 404 NOT FOUND for base page x' WHEN 'signup' THEN 'HTTP 404: subpage ''hostel'' does not exist'
    WHEN 'error' THEN 'Blocked/error HTTP 403 for x' WHEN 'view' THEN 'Successfully saved x' ELSE 'Sleeping for 1.0s' END"""


def _log(spark, d):
    return table(spark, d, "events").select("event_id", F.expr(LOG_LINE).alias("value"))


@query(
    "log_lines",
    """SELECT event_id, CAST('2024-01-' || lpad(CAST(day(ts) AS STRING), 2, '0') || ' 10:00:00' AS TIMESTAMP) AS logged_at,
 CASE event_type WHEN 'click' THEN 'WARNING' WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level, CAST(user_id AS INT) AS line,
 CASE event_type WHEN 'click' THEN 'removed' WHEN 'signup' THEN 'absent' WHEN 'error' THEN 'blocked' WHEN 'view' THEN 'saved' ELSE 'other' END AS kind FROM events""",
)
def log_lines(spark, d):
    return A.parse_logs(_log(spark, d)).select("event_id", "logged_at", "level", "line", "kind")


@query(
    "log_counts",
    """SELECT CASE event_type WHEN 'click' THEN 'WARNING' WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
 CASE event_type WHEN 'click' THEN 'removed' WHEN 'signup' THEN 'absent' WHEN 'error' THEN 'blocked' WHEN 'view' THEN 'saved' ELSE 'other' END AS kind,
 count(*) AS n_lines FROM events GROUP BY 1, 2""",
)
def log_counts(spark, d):
    return A.log_counts(_log(spark, d))


SPLIT_SQL = "WITH s AS (SELECT page_id, url, CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / ceil(count(*) OVER () / {n}.0)) + 1 AS INT) AS part FROM pages) "


@query("split_parts", SPLIT_SQL.format(n=6) + "SELECT page_id, part FROM s")
def split_in_parts(spark, d):
    return split_parts(table(spark, d, "pages").select("page_id"), 6, "page_id")


@query("merge_parts", SPLIT_SQL.format(n=3) + "SELECT page_id, url, CASE WHEN part <= 2 THEN 'first' ELSE 'second' END AS origin FROM s")
def merged_parts(spark, d):
    parts = split_parts(table(spark, d, "pages").select("page_id", "url"), 3, "page_id")
    first = parts.filter("part <= 2").drop("part").withColumn("origin", F.lit("first"))
    second = parts.filter("part >= 2").drop("part").withColumn("origin", F.lit("second"))
    return merge_parts([first, second], keys=["page_id"])


@query("distinct_entities", "SELECT DISTINCT CAST(user_id AS STRING) AS college_id, event_type AS slug FROM events ORDER BY 1, 2")
def distinct_entities(spark, d):
    from campusweave.sources.pages import distinct_entities as entities

    return entities(table(spark, d, "events").select(F.col("user_id").cast("string").alias("college_id"), F.col("event_type").alias("slug")))


GROUPED = """CASE WHEN length({s}) <= 3 THEN {s} ELSE ltrim(reverse(regexp_replace(reverse(left({s}, length({s}) - 3)), '([0-9][0-9])', '\\1,', 'g')), ',') || ',' || right({s}, 3) END"""


@query(
    "import_listing",
    f"""WITH o AS (SELECT *, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS STRING) AS a, CAST(CAST(trunc(o_totalprice * 100) AS BIGINT) AS STRING) AS h, o_custkey % 50 - 5 AS r FROM orders WHERE o_orderkey % 11 <> 0)
 SELECT CASE o_orderkey % 3 WHEN 0 THEN 'http://other.example/' || CAST(o_orderkey AS STRING) ELSE 'https://campus.example/' || CAST(o_orderkey AS STRING) END AS url,
 {GROUPED.format(s='a')} AS listing_avg_package, {GROUPED.format(s='h')} AS listing_highest_package, '' AS listing_placement_percentage,
 CASE WHEN r > 0 THEN '#' || CAST(r AS STRING) ELSE '' END AS listing_rank FROM o""",
)
def import_listing(spark, d):
    external = dealt_table(spark, d, "orders", "o_orderkey").selectExpr(
        """CASE WHEN o_orderkey % 11 = 0 THEN 'nan' WHEN o_orderkey % 3 = 0 THEN ' http://other.example/' || CAST(o_orderkey AS STRING)
           WHEN o_orderkey % 3 = 1 THEN '/' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END AS url""",
        "o_totalprice AS avg_salary", "o_totalprice * 100 AS highest_salary", "o_custkey % 50 - 5 AS top_ranking_rank",
    )
    return B.import_listing(external, "url", "avg_salary", "highest_salary", "top_ranking_rank")


@query(
    "join_listing",
    FRONTIER_SQL
    + """, l AS (SELECT id, slug, url, 'rank ' || id AS listing_rank FROM parsed WHERE type <> 'colleges' AND url = 'https://campus.example/' || type || '/' || id || '-' || slug)
 SELECT CAST(c_custkey AS STRING) AS college_id, coalesce(l.url, 'https://campus.example/university/' || CAST(c_custkey AS STRING) || '-' || lower(replace(c_name, '#', '-'))) AS listing_url, l.listing_rank
 FROM customer LEFT JOIN l ON CAST(c_custkey AS STRING) = l.id AND lower(replace(c_name, '#', '-')) = l.slug""",
)
def join_listing(spark, d):
    from campusweave.plans.colleges import join_listing as join

    listing = profiles(spark, d).select("url", F.concat(F.lit("rank "), "id").alias("listing_rank"))
    entities = table(spark, d, "customer").selectExpr("CAST(c_custkey AS STRING) AS college_id", "lower(replace(c_name, '#', '-')) AS slug")
    return join(entities, listing).select("college_id", "listing_url", "listing_rank")


@query("counts_by_type", "SELECT event_type, count(*) AS n_rows, count(*) FILTER (value > 10) AS high FROM events GROUP BY 1")
def counts_by_type(spark, d):
    return R.counts(table(spark, d, "events"), ["event_type"], {"high": F.col("value") > 10})

