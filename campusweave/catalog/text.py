"""Queries over page markup, text fields and their normal forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from campusweave.catalog import rule_sql as RS
from campusweave.catalog.registry import pages, query, dealt_table, table
from campusweave.functions import degrees as D
from campusweave.functions import money as M
from campusweave.functions import text as X
from campusweave.operators import extract as E
from campusweave.operators import html as H
from campusweave.operators import relational as R
from campusweave.operators.ordinals import carry
from campusweave.plans import courses as C
from campusweave.plans import rankings as K
from campusweave.session import checkpoint_dir
from campusweave.sources.staging import stage_pages

# what the page table holds besides text, taken off by pattern
BARE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),
 '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '{gap}', 'g'), '<!DOCTYPE[^>]*>', '', 'g')"""


def decoded(sql: str) -> str:
    # a title cut short may end in an entity without its semicolon
    return f"regexp_replace(replace(replace(replace({sql}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')"


def squeezed(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '\\s+', ' ', 'g'))"


@query("visible_text", "SELECT page_id, " + squeezed(decoded("regexp_replace(" + BARE.format(gap="") + ", '<[^>]*>', '', 'g')")) + " AS visible_text FROM pages")
def visible_text(spark, d):
    return H.visible_text(pages(spark, d)).select("page_id", "visible_text")


@query(
    "article_text",
    "SELECT page_id, " + squeezed(decoded("regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>', ' ', 'g')")) + " AS main_text FROM pages",
)
def article_text(spark, d):
    return H.main_text(pages(spark, d)).select("page_id", "main_text")


@query(
    "page_title",
    "SELECT page_id, " + squeezed(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")) + " AS title, "
    + "trim(string_split(string_split(" + squeezed(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")) + ", 'Admission')[1], 'Courses')[1]) AS name, '' AS description FROM pages",
)
def page_title(spark, d):
    return H.page_metadata(H.with_tree(pages(spark, d)), ["page_id"])


TAGS = r"unnest(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script([^>]*)>.*?</script>', '<script>', 'g'), '(?is)<style([^>]*)>.*?</style>', '<style>', 'g'), '(?s)<!--.*?-->', '', 'g'), '<([a-z][a-z0-9]*)', 1))"


@query("node_counts", f"SELECT page_id, tag, count(*) AS n_nodes FROM (SELECT page_id, {TAGS} AS tag FROM pages) GROUP BY 1, 2")
def node_counts(spark, d):
    nodes = H.html_nodes(pages(spark, d).select("page_id", "html"))
    return nodes.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n_nodes"))


@query("node_paths", f"SELECT tag, count(*) AS n_nodes, count(*) AS n_placed FROM (SELECT {TAGS} AS tag FROM pages) GROUP BY 1")
def node_paths(spark, d):
    """Every element lies within its parent's extent."""
    trees = H.with_tree(pages(spark, d).select("page_id", "html"))
    placed = F.transform(
        "nodes",
        lambda n: F.struct(
            n["tag"].alias("tag"),
            ((n["parent"] == -1) | ((F.get(F.col("nodes"), n["parent"])["pre"] < n["pre"]) & (F.get(F.col("nodes"), n["parent"])["last"] >= n["last"]))).alias("ok"),
        ),
    )
    return trees.select(F.explode(placed).alias("n")).groupBy("n.tag").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if("n.ok").alias("n_placed"))


@query("rejected_pages", "SELECT page_id, 'AssertionError: unknown status keyword ''foo'' in marked section' AS parse_error FROM pages WHERE page_id % 7 = 0")
def rejected_pages(spark, d):
    """Every seventh page gets a marked section that the parser does not know."""
    broken = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit("<![foo[x]]>"))).otherwise(F.col("html"))
    return H.rejected_pages(H.with_tree(pages(spark, d).select("page_id", broken.alias("html")))).select("page_id", "parse_error")


TURNS = """SELECT conv_id, turn, {f}(CASE WHEN role = '{role}' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn {dir} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM conversations"""


@query("preceding_turn", TURNS.format(f="last_value", role="user", dir=""))
def preceding_turn(spark, d):
    turns = table(spark, d, "conversations")
    return carry(turns, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("text")), "near").select("conv_id", "turn", "near")


@query("next_turn", TURNS.format(f="last_value", role="assistant", dir="DESC"))
def next_turn(spark, d):
    turns = table(spark, d, "conversations")
    value = F.when(F.col("role") == "assistant", F.col("text"))
    return carry(turns, ["conv_id"], "turn", value, "near", forward=False).select("conv_id", "turn", "near")


# -- text fields -----------------------------------------------------------------------------

LABEL_RULES = {"token": [r'token = "([^"]+)"', r'token: "([^"]+)"'], "mail": [r"([A-Za-z0-9._]+@[A-Za-z0-9.]+)"], "opening": [r"^([A-Za-z]+) "]}


@query(
    "label_values",
    "SELECT doc_id, "
    + ", ".join("coalesce(" + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '')" for p in ps) + f") AS {n}" for n, ps in LABEL_RULES.items())
    + " FROM documents",
)
def label_values(spark, d):
    return E.label_values(table(spark, d, "documents"), "text", LABEL_RULES).select("doc_id", *LABEL_RULES)


TERMS = ["License", "token", "the", "und", "les", "para", "secret"]


@query("vocabulary_hits", "SELECT doc_id, nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN contains(lower(text), '{t.lower()}') THEN '{t}' END" for t in TERMS) + "), '') AS hits FROM documents")
def vocabulary_hits(spark, d):
    return E.match_vocabulary(table(spark, d, "documents"), "text", TERMS).select("doc_id", "hits")


@query(
    "context_window",
    """WITH p AS (SELECT doc_id, text, string_split_regex(text, 'license') AS parts FROM documents WHERE contains(text, 'license')),
 k AS (SELECT *, unnest(generate_series(1, len(parts) - 1)) AS k FROM p),
 s AS (SELECT doc_id, text, k - 1 AS match_no, CAST(list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * 7 AS BIGINT) AS st FROM k),
 w AS (SELECT doc_id, match_no, substring(text, greatest(st - 40, 0) + 1, st + 7 + 60 - greatest(st - 40, 0)) AS win FROM s)
 SELECT doc_id, match_no, 'license' AS match, nullif(regexp_extract(win, '([A-Za-z]+)', 1), '') AS first_word,
 regexp_extract_all(win, '([A-Za-z]+)', 1)[-1] AS last_word FROM w""",
)
def context_window(spark, d):
    fields = {"first_word": "([A-Za-z]+)", "last_word": "([A-Za-z]+)"}
    docs = table(spark, d, "documents").select("doc_id", "text")
    return E.context_matches(docs, "text", "license", 40, 60, fields, last=["last_word"])


@query(
    "capped_lines",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
 c AS (SELECT doc_id, n, {squeezed('raw')} AS line FROM l WHERE contains(raw, 'the') OR contains(raw, 'und')),
 r AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS line_no FROM c WHERE length(line) < 100)
 SELECT doc_id, line_no, line FROM r WHERE line_no < 15""",
)
def capped_lines(spark, d):
    return E.capped_lines(table(spark, d, "documents").select("doc_id", "text"), "text", ["the", "und"])


@query("block_between", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?is)license.*?(?:code|\\.)') THEN regexp_extract(text, '(?is)license(.*?)(?:code|\\.)', 1) END AS block FROM documents")
def block_between(spark, d):
    return table(spark, d, "documents").select("doc_id", E.block_between(F.col("text"), "license", ["code", r"\."]).alias("block"))


@query("clean_text", f"SELECT doc_id, {squeezed('text')} AS text FROM documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean(F.col("text")).alias("text"))


@query("truncated", "SELECT doc_id, left(text, 250) AS text, left(source, 2) AS source FROM documents")
def truncated(spark, d):
    return R.truncate_columns(table(spark, d, "documents"), {"text": 250, "source": 2}).select("doc_id", "text", "source")


@query(
    "recruiters",
    """WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)
 SELECT doc_id, CASE WHEN t <> '' AND length(t) <= 300 AND NOT regexp_matches(lower(t), 'opengraph|schemajsonld|breadcrumb|"description"|\\{"@context"|u003c|http://schema.org')
 AND NOT regexp_matches(t, '[<>]|\\\\"') THEN t END AS top_recruiters FROM t""",
)
def recruiters(spark, d):
    return table(spark, d, "documents").select("doc_id", E.sanitize_recruiters(F.col("text")).alias("top_recruiters"))


@query("fill_defaults", "SELECT d.doc_id, coalesce(CAST(quality AS STRING), 'Not Specified') AS quality, coalesce(CAST(toxic AS STRING), 'Not Rated') AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def fill_defaults(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    shown = joined.select("doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    return R.apply_defaults(shown, {"quality": "Not Specified", "toxic": "Not Rated"})


# -- names and degrees ------------------------------------------------------------------------

# course names as a page would write them, one per part; the same text in both dialects
_SHAPES = [
    "BE/B.Tech", "M.E", "PGDM (Marketing)", "Post Graduate Programme in Law", "B.Sc. Physics", "MSC", "MBBS", "MCA", "BCA (Hons)", "BBM", "B.Com",
    "MPT Neuro", "robotics bot", "M.Ch Surgery", "D.M. Cardiology", "General Nursing", "BASLP", "B.Optom", "DNB", "BA History", "M.A. English", "FPM",
    "M.Des", "MPP", "M.D. (Paed)", "Executive Diploma", "LLB Law", "Admission", "EMBA Executive", "PGDM Diploma",
]
COURSE_NAME = "CASE p_partkey % 32 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SHAPES)) + " ELSE p_name END || CASE p_size % 4 WHEN 0 THEN ' (' || p_brand || ')' WHEN 1 THEN '  ' ELSE '' END"


NAMED = f"WITH n AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, {COURSE_NAME} AS name FROM part) "
TAGGED = NAMED + f", g AS (SELECT *, {RS.DEGREE_TAG} AS degree FROM (SELECT *, {squeezed('lower(name)')} AS t FROM n)) "


def named_parts(spark, d):
    return table(spark, d, "part").withColumn("name", F.expr(COURSE_NAME))


@query("degree_tags", TAGGED + "SELECT p_partkey, degree FROM g")
def degree_tags(spark, d):
    return named_parts(spark, d).select("p_partkey", D.degree_tag(F.col("name")).alias("degree"))


@query(
    "course_details",
    TAGGED
    + f"""SELECT p_partkey, x[1] AS duration, x[2] AS course_level, x[3] AS entrance_exam, x[4] AS course_type
 FROM (SELECT p_partkey, {RS.COURSE_DETAILS} AS x FROM (SELECT p_partkey, lower(degree) AS d, lower(name) AS n FROM g))""",
)
def course_details(spark, d):
    tagged = named_parts(spark, d).withColumn("degree", D.degree_tag(F.col("name")))
    return tagged.select("p_partkey", D.details(F.col("degree"), F.col("name")).alias("x")).select("p_partkey", "x.*")


LEVEL_TEXT = "CASE p_size % 6 WHEN 0 THEN 'Post Graduation' WHEN 1 THEN 'Graduation' WHEN 2 THEN 'Doctorate' WHEN 3 THEN 'Diploma' WHEN 4 THEN 'UG' ELSE '' END"


@query(
    "course_levels",
    TAGGED
    + f"""SELECT p_partkey, CASE WHEN contains(lv, 'doctor') OR contains(lower(degree), 'ph.d') THEN 'Doctorate' WHEN regexp_matches(lv, 'post|pg|master') THEN 'PG'
 WHEN regexp_matches(lv, 'graduation|undergraduate|ug') THEN 'UG' WHEN regexp_matches(lv, 'certificate|diploma') THEN 'PG'
 WHEN degree IN {RS.PG_DEGREES} THEN 'PG' ELSE 'UG' END AS course_level FROM (SELECT *, lower({LEVEL_TEXT}) AS lv FROM g)""",
)
def course_levels(spark, d):
    tagged = named_parts(spark, d).withColumn("degree", D.degree_tag(F.col("name")))
    return tagged.select("p_partkey", D.level(F.expr(LEVEL_TEXT), F.col("degree")).alias("course_level"))


@query(
    "course_names",
    NAMED
    + """SELECT p_partkey, CASE WHEN trim(regexp_replace(name, '\\s*\\([^)]*\\)\\s*$', '')) = '' THEN name ELSE trim(regexp_replace(name, '\\s*\\([^)]*\\)\\s*$', '')) END AS parent,
 CASE WHEN regexp_matches(name, '\\([^)]+\\)\\s*$') THEN trim(regexp_replace(name, '\\s*\\([^)]*\\)\\s*$', '')) ELSE trim(name) END AS course,
 CASE WHEN regexp_matches(name, '\\([^)]+\\)\\s*$') THEN trim(regexp_extract(name, '\\(([^)]+)\\)\\s*$', 1)) ELSE p_type END AS specialization FROM n""",
)
def course_names(spark, d):
    name, spec = X.name_and_specialization(F.col("name"), F.col("p_type"))
    return named_parts(spark, d).select("p_partkey", X.without_trailing_parens(F.col("name")).alias("parent"), name.alias("course"), spec.alias("specialization"))


FEE_NAME = "CASE p_partkey % 6 WHEN 0 THEN 'Hostel Fee ' || p_name WHEN 1 THEN CAST(p_size AS STRING) || 'th Year' WHEN 2 THEN 'Non-SAARC' WHEN 3 THEN 'Feeder ' || p_name WHEN 4 THEN 'year 2' ELSE p_name END"


@query(
    "valid_rows",
    f"""WITH n AS (SELECT p_partkey, lower({FEE_NAME}) AS name, lower(p_type) AS degree FROM part)
 SELECT p_partkey, NOT (regexp_matches(name, '\\b({RS.FEE_WORDS})\\b') OR regexp_matches(degree, '\\b({RS.FEE_WORDS})\\b')
 OR regexp_matches(name, '^\\s*([0-9]+(st|nd|rd|th)?\\s*year|year\\s*[0-9]+)\\s*$')) AS is_course FROM n""",
)
def valid_rows(spark, d):
    return table(spark, d, "part").select("p_partkey", D.is_course(F.col("p_type"), F.expr(FEE_NAME)).alias("is_course"))


# -- money and numbers ------------------------------------------------------------------------

AMOUNT = "CASE o_orderkey % 6 WHEN 0 THEN CAST(o_totalprice AS STRING) WHEN 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) WHEN 2 THEN CAST(o_custkey AS STRING) || ' L' WHEN 3 THEN '' WHEN 4 THEN 'on request' ELSE CAST(o_custkey AS STRING) || '.5' END"
READY = "CASE WHEN o_orderkey % 7 = 0 THEN ' about  ' || CAST(o_custkey AS STRING) END"


@query(
    "fee_format",
    f"""WITH a AS (SELECT o_orderkey, o_custkey, {AMOUNT} AS amount, {READY} AS ready FROM orders), n AS (SELECT *, TRY_CAST(amount AS DOUBLE) AS v FROM a)
 SELECT o_orderkey, CASE WHEN ready IS NOT NULL THEN 'about ' || CAST(o_custkey AS STRING) WHEN amount = '' THEN NULL
 WHEN v >= 100000 THEN format('{{:g}}', v / 100000.0) || ' Lakhs' WHEN v = floor(v) THEN format('{{:,}}', CAST(v AS BIGINT))
 WHEN v IS NOT NULL THEN rtrim(rtrim(format('{{:,.2f}}', v), '0'), '.') WHEN ends_with(amount, ' L') THEN format('{{:g}}', CAST(o_custkey AS DOUBLE)) || ' Lakhs' ELSE amount END AS total_fees FROM n""",
)
def fee_format(spark, d):
    return dealt_table(spark, d, "orders", "o_orderkey").select("o_orderkey", M.fees(F.expr(AMOUNT), F.expr(READY)).alias("total_fees"))


PAY = "CASE l_linenumber % 3 WHEN 0 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) * 1000 AS STRING) WHEN 1 THEN CAST(l_extendedprice AS STRING) ELSE CAST(l_suppkey * 100000 AS STRING) END"


@query(
    "package_format",
    f"""WITH v AS (SELECT l_orderkey, l_linenumber, CAST(trunc(CAST({PAY} AS DOUBLE)) AS BIGINT) AS v FROM lineitem)
 SELECT l_orderkey, l_linenumber, CASE WHEN v <= 0 THEN NULL WHEN v >= 10000000 AND v % 10000000 = 0 THEN CAST(v // 10000000 AS STRING) || ' Crore'
 WHEN v >= 10000000 THEN format('{{:.2f}}', v / 10000000) || ' Cr' WHEN v >= 100000 AND v % 100000 = 0 THEN CAST(v // 100000 AS STRING) || ' LPA'
 WHEN v >= 100000 THEN format('{{:.2f}}', v / 100000) || ' LPA' ELSE CAST(v AS STRING) END AS pay FROM v""",
)
def package_format(spark, d):
    return dealt_table(spark, d, "lineitem", "l_orderkey").select("l_orderkey", "l_linenumber", M.package(F.expr(PAY)).alias("pay"))


@query(
    "indian_grouping",
    """WITH s AS (SELECT o_orderkey, CAST(CAST(trunc(o_totalprice * (o_custkey % 4)) AS BIGINT) AS STRING) AS s FROM orders)
 SELECT o_orderkey, CASE WHEN s = '0' THEN '' WHEN length(s) <= 3 THEN s
 ELSE ltrim(reverse(regexp_replace(reverse(left(s, length(s) - 3)), '([0-9][0-9])', '\\1,', 'g')), ',') || ',' || right(s, 3) END AS shown FROM s""",
)
def indian_grouping(spark, d):
    return dealt_table(spark, d, "orders", "o_orderkey").select("o_orderkey", M.indian_digits(F.col("o_totalprice") * (F.col("o_custkey") % 4)).alias("shown"))


@query("currency", "SELECT o_orderkey, CAST(o_custkey AS STRING) || ' per year' AS fee FROM orders")
def currency(spark, d):
    fee = F.expr("CASE o_orderkey % 3 WHEN 0 THEN '₹ ' WHEN 1 THEN 'INR ' ELSE '' END || CAST(o_custkey AS STRING) || ' per year'")
    return table(spark, d, "orders").select("o_orderkey", X.without_currency(fee).alias("fee"))


EXAMS = """CASE p_partkey % 4 WHEN 0 THEN '[{"name":"' || p_brand || '"},"' || p_type || '",{"name":"' || p_brand || '"},{"id":1}]'
 WHEN 1 THEN '{"name":" ' || p_type || ' "}' WHEN 2 THEN p_name ELSE NULL END"""


@query("exam_names", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || ', ' || p_type WHEN 1 THEN p_type WHEN 2 THEN p_name END AS entrance_exam FROM part")
def exam_names(spark, d):
    return table(spark, d, "part").select("p_partkey", E.exam_names(F.expr(EXAMS)).alias("entrance_exam"))


RANK_TEXT = "CASE p_partkey % 5 WHEN 0 THEN CAST(p_size - 5 AS STRING) WHEN 1 THEN ' ' || CAST(p_size AS STRING) WHEN 2 THEN 'x' || CAST(p_size AS STRING) WHEN 3 THEN CAST(p_size * 2000 AS STRING) ELSE NULL END"


@query(
    "valid_ranks",
    f"""WITH r AS (SELECT p_partkey, TRY_CAST(trim({RANK_TEXT}) AS INT) AS r, CAST(1990 + p_size AS STRING) || CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE '' END AS y FROM part)
 SELECT p_partkey, CASE WHEN r > 0 AND r <= 50000 THEN r END AS rank, CASE WHEN regexp_matches(y, '^[0-9]+$') THEN TRY_CAST(y AS INT) END AS year FROM r""",
)
def valid_ranks(spark, d):
    year = F.expr("CAST(1990 + p_size AS STRING) || CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE '' END")
    return table(spark, d, "part").select("p_partkey", K.valid_rank(F.expr(RANK_TEXT)).alias("rank"), K.valid_year(year).alias("year"))


@query(
    "rank_tokens",
    "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '#' || CAST(CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INT) AS STRING) ELSE '#' || CAST(p_size AS STRING) END AS listing_rank FROM part",
)
def rank_tokens(spark, d):
    from campusweave.operators.frontier import listing_rank

    own = F.expr("replace(p_brand, 'Brand', '')")
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_name"), F.lit(" "), own)).otherwise(F.concat(F.lit("NIRF Ranking: "), F.col("p_size").cast("string"), F.lit("th")))
    return table(spark, d, "part").select("p_partkey", listing_rank(text, F.array("p_name", own)).alias("listing_rank"))


# -- places and people ------------------------------------------------------------------------


@query(
    "contact_info",
    """SELECT c_custkey, nullif(concat_ws(' | ', CASE WHEN c_custkey % 2 = 0 THEN 'Address: ' || c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN 'Tel: ' || CAST(c_custkey AS STRING) END,
 CASE WHEN c_custkey % 5 = 0 THEN 'Email: ' || c_name END), '') AS contact_info FROM customer""",
)
def contact_info(spark, d):
    some = lambda n, c: F.when(F.col("c_custkey") % n == 0, c)
    info = E.contact_info(some(2, F.col("c_mktsegment")), some(3, F.col("c_custkey").cast("string")), some(5, F.col("c_name")))
    return table(spark, d, "customer").select("c_custkey", info.alias("contact_info"))


SPAN = "CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) || ',  Goa India' END"
ADDRESS = "CASE WHEN c_custkey % 2 = 0 THEN '1 Road, Sector ' || CAST(c_nationkey AS STRING) || ', ' || c_mktsegment || ', India ' WHEN c_custkey % 7 = 0 THEN 'Delhi' END"
PLACE_TEXT = "'The campus is located in ' || c_mktsegment || ', Kerala'"


@query(
    "locations",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 2 = 0 THEN 'Sector ' || CAST(c_nationkey AS STRING) WHEN c_custkey % 7 = 0 THEN 'Delhi' ELSE c_mktsegment END AS city,
 CASE WHEN c_custkey % 3 = 0 THEN 'Goa' WHEN c_custkey % 2 = 0 THEN c_mktsegment WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Kerala' END AS state FROM customer""",
)
def locations(spark, d):
    city, state = E.resolve_location(F.expr(SPAN), F.expr(ADDRESS), F.expr(PLACE_TEXT))
    return table(spark, d, "customer").select("c_custkey", city.alias("city"), state.alias("state"))


@query(
    "entity_class",
    """SELECT page_id, CASE WHEN regexp_matches(html, '(?i)public|government|govt|autonomous') THEN 'Public' WHEN regexp_matches(html, '(?i)private|deemed') THEN 'Private' ELSE '' END AS ownership,
 CASE WHEN contains(lower(url), 'university') THEN 'University' WHEN contains(lower(url), 'college') THEN 'College' ELSE 'Institute' END AS college_type FROM pages""",
)
def entity_class(spark, d):
    return table(spark, d, "pages").select("page_id", E.ownership(F.col("html")).alias("ownership"), E.college_type(F.col("url")).alias("college_type"))


AGENCY = "CASE p_size % 4 WHEN 0 THEN 'Campus  Guide' WHEN 1 THEN 'indiatoday' WHEN 2 THEN ' NIRF ' ELSE 'campus guide.com' END"


@query(
    "ranking_labels",
    """SELECT p_partkey, CASE p_size % 4 WHEN 1 THEN 'India Today' WHEN 2 THEN 'NIRF' ELSE 'Campus Guide' || CASE WHEN p_partkey % 2 = 0 THEN ' (' || p_type || ')' ELSE '' END END AS ranking_body,
 CASE WHEN p_size % 4 IN (1, 2) THEN '#' ELSE 'CG Rank #' END || CAST(p_size AS STRING) AS rank FROM part""",
)
def ranking_labels(spark, d):
    agency = K.canonical_agency(F.expr(AGENCY))
    stream = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.lit(""))
    body, rank = K.ranking_label(agency, F.col("p_size"), stream)
    return table(spark, d, "part").select("p_partkey", body.alias("ranking_body"), rank.alias("rank"))


# -- table rows -------------------------------------------------------------------------------

CELL = "CASE p_partkey % 6 WHEN 0 THEN 'INR ' || p_name WHEN 1 THEN CAST(p_retailprice AS STRING) WHEN 2 THEN '10+2 with 60%' WHEN 3 THEN '5 Lakhs' WHEN 4 THEN 'Lakhsmi' ELSE ' Rs 5' END"


@query(
    "eligibility_cells",
    f"""SELECT p_partkey, CASE WHEN NOT regexp_matches({CELL}, '(?i)INR|\\bRs\\b|\\bLakh\\b|\\bLakhs\\b|^\\s*[0-9\\.,\\-]+\\s*$') THEN {CELL} END AS eligibility FROM part""",
)
def eligibility_cells(spark, d):
    return table(spark, d, "part").select("p_partkey", C.eligibility_cell(F.expr(CELL)).alias("eligibility"))


LEAD = "CASE p_partkey % 7 WHEN 0 THEN ' Course ' WHEN 1 THEN 'M.Tech Specializations' WHEN 2 THEN 'Total Fees' WHEN 3 THEN 'Fees (INR)' WHEN 4 THEN 'Courses offered' ELSE p_name END"


@query(
    "header_rows",
    f"""SELECT p_partkey, lower(trim({LEAD})) IN {RS.HEADER_CELLS} OR regexp_matches(lower({LEAD}), 'total fees|fees \\(inr\\)|specializations') AS is_header FROM part""",
)
def header_rows(spark, d):
    return table(spark, d, "part").select("p_partkey", C.is_header_row(F.array(F.expr(LEAD), F.col("p_type"))).alias("is_header"))


HEADING = "CASE p_partkey % 8 WHEN 0 THEN 'm.tech fees' WHEN 1 THEN 'other b.tech fees' WHEN 2 THEN 'm.sc ' || p_name WHEN 3 THEN 'other courses' WHEN 4 THEN 'cep courses' WHEN 5 THEN 'm.sc fees' WHEN 6 THEN 'placement ' || p_name ELSE p_name END"
HEADS = "CASE p_size % 5 WHEN 0 THEN 'course fee' WHEN 1 THEN 'fee per year' WHEN 2 THEN 'eligibility' WHEN 3 THEN 'stream' ELSE 'particulars' END"
HEADS2 = "CASE p_size % 3 WHEN 0 THEN 'total price' WHEN 1 THEN 'branch' ELSE 'eligibility' END"
_C = "regexp_matches({h}, 'course|specialization|specialisation|degree|program|programme|branch|stream|subject')"
_FEE = "regexp_matches({h}, 'fee|fees|inr|amount|price|cost')"


@query(
    "table_choice",
    f"""SELECT p_partkey, {RS.TABLE_CATEGORY} AS category, regexp_matches(c, '{RS.FEE_TABLE_WORDS}') AS fee_table
 FROM (SELECT p_partkey, {HEADING} AS h, {HEADS} AS c FROM part)""",
)
def table_choice(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", C.table_category(F.expr(HEADING)).alias("category"), C.is_fee_table(F.array(F.expr(HEADS))).alias("fee_table")
    )


@query(
    "column_roles",
    f"""WITH t AS (SELECT p_partkey, {HEADS} AS a, {HEADS2} AS b, {HEADING} AS h FROM part),
 r AS (SELECT *, CASE WHEN {_C.format(h='a')} THEN 0 WHEN {_C.format(h='b')} THEN 1 ELSE -1 END AS c0,
 CASE WHEN {_FEE.format(h='a')} AND NOT {_C.format(h='a')} THEN 0 WHEN {_FEE.format(h='b')} AND NOT {_C.format(h='b')} THEN 1 ELSE -1 END AS f0,
 CASE WHEN contains(a, 'eligibility') THEN 0 WHEN contains(b, 'eligibility') THEN 1 ELSE -1 END AS eligibility FROM t)
 SELECT p_partkey, CASE WHEN (c0 = -1 OR f0 = -1) AND regexp_matches(h, 'fee|course') THEN 0 ELSE c0 END AS course,
 CASE WHEN (c0 = -1 OR f0 = -1) AND regexp_matches(h, 'fee|course') THEN 1 ELSE f0 END AS fee, eligibility FROM r""",
)
def column_roles(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.array(F.expr(HEADS), F.expr(HEADS2)).alias("header"), F.expr(HEADING).alias("heading"))
    return rows.select("p_partkey", C.column_roles(F.col("header"), F.col("heading")).alias("r")).select("p_partkey", "r.*")


@query("renamed_courses", "SELECT CAST(p_partkey AS STRING) AS college_id, p_name AS degree_name, p_brand AS course_name, 'UG' AS course_level FROM part")
def renamed_courses(spark, d):
    rows = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("college_id"), F.col("p_type").alias("degree_name"), F.col("p_name").alias("course_name"),
        F.col("p_brand").alias("specialization"), F.lit("UG").alias("course_level"),
        *[F.lit("").alias(c) for c in ("total_fees", "duration", "course_type", "eligibility", "entrance_exam", "application_date", "intake_seats")],
    )
    return C.rename_course_columns(rows).select("college_id", "degree_name", "course_name", "course_level")


# -- embedded data ----------------------------------------------------------------------------


@query("json_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))


# one page per customer with two JSON-LD blocks, a broken one, and app state
_LD = """'<html><head><script type="application/ld+json">[{"@type":"WebPage","id":' || CAST(c_custkey AS STRING) || '},{"@type":"Org","name":"' || c_name || '"}]</script>'
 || '<script id="x" type=''application/ld+json''>{"@type":"Org","name":"second"}</script><script type="application/ld+json">{broken</script>'
 || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '<script id="__NEXT_DATA__" type="application/json">{"a":{"b":{"seg":"' || c_mktsegment || '","list":[' || CAST(c_nationkey AS STRING) || ',2]}}}</script>' END
 || '</head><body>x</body></html>'"""


def state_pages(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.expr(_LD).alias("html"))


@query(
    "json_ld",
    """SELECT c_custkey, b AS block_no, CASE b WHEN 0 THEN '{"@type":"WebPage","id":' || CAST(c_custkey AS STRING) || '}' WHEN 1 THEN '{"@type":"Org","name":"' || c_name || '"}'
 ELSE '{"@type":"Org","name":"second"}' END AS json FROM customer, (VALUES (0), (1), (2)) v(b)""",
)
def json_ld(spark, d):
    return H.json_ld(state_pages(spark, d), ["c_custkey"])


@query("json_ld_of_type", "SELECT c_custkey, c_name AS name FROM customer")
def json_ld_of_type(spark, d):
    return state_pages(spark, d).select("c_custkey", F.get_json_object(H.json_ld_of_type(F.col("html"), "Org"), "$.name").alias("name"))


@query("app_state", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS seg, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS first_item FROM customer")
def app_state(spark, d):
    state = H.app_state(F.col("html"), "a.b", "struct<seg:string,list:array<bigint>>")
    return state_pages(spark, d).select("c_custkey", state["seg"].alias("seg"), F.get(state["list"], 0).alias("first_item"))


# one page per part with headings, two tables and nested cards
_TABLES = """'<h1>Top</h1><h2>' || p_type || ' <i>Prices</i></h2><div><table><tr><th>Name</th><th>Brand</th></tr><tr><td> ' || p_name || '</td><td>' || p_brand || '<br>x</td></tr></table></div>'
 || '<div class="card big"><h3 class="title">' || p_name || '</h3><div class="card"><span class="title">' || p_brand || '</span><i class="size">' || CAST(p_size AS STRING) || '</i></div></div>'
 || '<h3>Late &amp; last</h3><table><tr><td>' || CAST(p_size AS STRING) || '</td></tr></table>'
 || '<h4 class="section">Admission Process</h4><p>one</p><div class="heading">Important  dates<ul><li>' || p_brand || '</li></ul></div><h2 class="title">Selection Criteria</h2><span>no</span><table><tr><td>' || p_name || '</td></tr></table>'"""


def table_pages(spark, d):
    return dealt_table(spark, d, "part", "p_partkey").select("p_partkey", F.expr(_TABLES).alias("html"))


_CELLS_SQL = """SELECT p_partkey, t AS table_no, r AS row_no, c AS col_no, CASE t WHEN 0 THEN lower(p_type) || ' prices' WHEN 1 THEN 'late & last' ELSE 'selection criteria' END AS heading,
 CASE WHEN t = 0 AND r = 0 THEN (CASE c WHEN 0 THEN 'Name' ELSE 'Brand' END) WHEN t = 0 THEN (CASE c WHEN 0 THEN p_name ELSE p_brand || 'x' END) WHEN t = 1 THEN CAST(p_size AS STRING) ELSE p_name END AS text
 FROM part, (VALUES (0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0), (2, 0, 0)) v(t, r, c)"""


@query("html_tables", _CELLS_SQL)
def html_tables(spark, d):
    return H.html_tables(H.with_tree(table_pages(spark, d)), ["p_partkey"])


@query("stored_tables", _CELLS_SQL)
def stored_tables(spark, d):
    """The same cells from pages that were parsed and stored before: no second parse, no join and no shuffle."""
    named = table_pages(spark, d).select(
        F.col("p_partkey").cast("string").alias("college_id"), F.lit("t").alias("slug"), F.lit("tables").alias("page_type"), F.lit("u").alias("url"), "html"
    )
    staged = stage_pages(named, f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}")
    return H.html_tables(staged, ["college_id"]).withColumn("p_partkey", F.col("college_id").cast("bigint")).drop("college_id")


@query(
    "html_cards",
    """SELECT p_partkey, k AS card_no, CASE k WHEN 0 THEN p_name ELSE p_brand END AS title, CAST(p_size AS STRING) AS size FROM part, (VALUES (0), (1)) v(k)""",
)
def html_cards(spark, d):
    fields = {"title": H.has_class("(?i)title"), "size": H.has_class("size")}
    return H.html_cards(H.with_tree(table_pages(spark, d)), ["p_partkey"], H.tagged_class(["div"], "card"), fields).drop("card_pre")


@query("section_content", "SELECT p_partkey, p_name AS admission_process, p_brand AS important_dates FROM part")
def section_content(spark, d):
    heading = H.tagged_class(["h2", "h3", "h4", "div"], "(?i)heading|title|section")
    fields = [("admission_process", ["admission process", "selection criteria"], 1000), ("important_dates", ["important  dates"], 1000)]
    trees = H.with_tree(table_pages(spark, d))
    return H.with_sections(trees, heading, ["p", "ul", "ol", "table"], fields).select("p_partkey", "admission_process", "important_dates")
