"""Profile pages that Spark writes from the given tables, one page per row.

The page table holds no profile pages, so the dataset jobs read these: what a job must find
on a page then follows from the row the page was made of, and the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusweave.catalog.registry import dealt_table

DEGREE = "CASE p_type WHEN 'STANDARD' THEN 'B.Tech' WHEN 'PROMO' THEN 'MBA' WHEN 'SMALL' THEN 'M.Sc' WHEN 'MEDIUM' THEN 'BBA' WHEN 'ECONOMY' THEN 'Ph.D' ELSE 'B.Des' END"
_SIZE = "CAST(p_size AS STRING)"
_KEY = "CAST(c_custkey AS STRING)"
_NATION = "CAST(c_nationkey + 1 AS STRING)"

COURSE_STATE = f"""'<script id="__NEXT_DATA__" type="application/json">{{"props":{{"initialProps":{{"pageProps":{{"data":{{"course_data":{{"courses":["odd",{{"course_tag":"' || {DEGREE}
|| '","display_name":"' || {DEGREE} || ' (' || p_name || ')","level":"","exams":[{{"name":"E1"}},"E2",{{"name":"E1"}}],"duration":"' || {_SIZE} || ' Months","streams":[{{"name":"' || p_name
|| '","fees_data":{{"amount":' || {_SIZE} || '0000}}}},{{"custom_name":"' || p_brand || '","fees_data":{{"amount":"' || {_SIZE} || ' L"}}}},{{"name":"' || p_name || '","fees_data":{{"amount":' || {_SIZE}
|| '0000}}}}]}},{{"course_tag":"MCA","display_name":"Hostel fee"}},{{"display_name":"MCA","available_seats":' || {_SIZE} || ',"fees_data":{{"amount_formatted":"on  call"}}}}]}}}}}}}}}}}}</script>'"""
COURSE_CARDS = f"""'<div class="course-card"><h3 class="course-title">' || {DEGREE} || ' (' || p_name || ')</h3><span class="course-fee-amount">₹' || {_SIZE} || ',000</span><span class="course-duration">2 Yrs</span>'
|| '<span class="course-duration-text">(Part Time)</span><div class="course-info"><i class="course-info-label">Application Date</i><i class="course-info-value">1 May</i></div>'
|| '<ul><li><span class="stream-text">' || p_brand || '</span><b class="primary-green">₹1 L</b></li><li><span class="stream-text"> </span></li></ul></div><div class="x course-card"><b class="course-title">' || p_name || '</b></div>'"""
COURSE_TABLES = f"""'<h2>' || {DEGREE} || ' programmes and fees</h2><table><tr><th>Course</th><th>Total Fee</th><th>Eligibility</th></tr><tr><td>' || {DEGREE} || ' (' || p_name || ')</td><td>INR ' || {_SIZE}
|| ' Lakhs</td><td>10+2</td></tr><tr><td>Hostel fee</td><td>1</td><td>2</td></tr></table><h3>Other courses</h3><table><tr><td>MPP</td><td>INR 5,000</td><td>5 Lakhs</td></tr></table><table><tr><th>Particulars</th><th>Fee</th></tr><tr><td>MBBS</td><td>1</td></tr></table>'"""
COURSE_CONTEXT = f"""'<p>x</p><script>var d = "course_tag":"B.Com" ... "course_tag":"' || {DEGREE} || '", "course_name":"' || p_name || '","display_course_name":"' || {DEGREE} || ' (x)","fees_data":{{"amount":' || {_SIZE}
|| '00000}} and "course_name":"General","display_course_name":"Y","z":1</script>'"""
COURSE_MIX = f"CASE p_partkey % 4 WHEN 0 THEN {COURSE_STATE} || {COURSE_CARDS} WHEN 1 THEN {COURSE_CARDS} || {COURSE_TABLES} WHEN 2 THEN {COURSE_TABLES} || {COURSE_CONTEXT} ELSE {COURSE_CONTEXT} END"

RANK_STATE = f""""basic_info":{{"ranking":[{{"agency":"NIRF","rank":"' || {_NATION} || '","year":2024}},{{"agency_name":"campus  guide","rank":' || {_NATION} || ',"stream":"MBA"}},{{"agency":"NIRF","rank":"' || {_NATION}
|| '","year":2024}},{{"agency":"Bad","rank":"x"}},{{"agency":"Far","rank":60000}}]}}"""
INFO = f"""'<html><head><title>' || c_name || ' Admission 2025</title><meta name="description" content="About  ' || c_name || '">'
|| CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '<script type="application/ld+json">{{"@type":"CollegeOrUniversity","name":"' || c_mktsegment || ' College","aggregateRating":{{"ratingValue":' || {_NATION}
|| '.5}},"address":{{"streetAddress":"' || {_KEY} || ' Road, ' || c_mktsegment || ', Goa, India"}},"telephone":"' || {_KEY} || '"}}</script>' END
|| CASE WHEN c_custkey % 3 = 1 THEN '<script id="__NEXT_DATA__" type="application/json">{{"props":{{"initialProps":{{"pageProps":{{"data":{{{RANK_STATE}}}}}}}}}}}</script>' ELSE '' END
|| '</head><body><h1>Welcome</h1><p>Estd. Year: ' || CAST(1900 + c_nationkey AS STRING) || ';</p><p>' || CASE c_custkey % 3 WHEN 0 THEN 'Government run' WHEN 1 THEN 'A private place' ELSE 'Open' END
|| '; Approved by: UGC,  AICTE; Affiliated to: ' || c_mktsegment || ' Board; Campus Guide rank #' || {_NATION} || ';</p>' || CASE WHEN c_custkey % 5 = 0 THEN '<span>Pune,  Maharashtra</span>' ELSE '' END
|| '<p>located in Agra, Bihar; end</p></body></html>'"""
PLACEMENT = f"""'<main><p>It was ranked ' || {_NATION} || 'th of all by NIRF 2023. By Outlook rank #7 of 1999. IIRF rank 6000.</p><p>95% placements</p>' || CASE c_custkey % 5
WHEN 0 THEN '<script id="__NEXT_DATA__" type="application/json">{{"props":{{"initialProps":{{"pageProps":{{"data":{{"placements":{{"highest_salary":' || {_NATION} || '000000,"average_salary":"' || {_NATION} || '50000"}}}}}}}}}}}}</script>'
WHEN 1 THEN '<p>The highest package offered INR ' || {_NATION} || '.5 LPA; average package was INR 6 LPA; median package: Rs. 5 LPA</p><p>Top recruiters include: A &amp; B Ltd<br>x</p>'
WHEN 2 THEN '<aside><table><tr><td>Highest Package</td><td>99 LPA</td></tr></table></aside><table><tr><th>Highest Package</th><td>x</td><td>INR ' || {_NATION} || ' LPA</td></tr><tr><td>Top Recruiters</td><td>Acme, ' || c_mktsegment || '</td></tr></table>'
WHEN 3 THEN '<p>Highest Salary for all: ' || {_NATION} || ' Lakh</p><p>Seen: Google and TCS</p>'
ELSE '<!-- IIM Ahmedabad Placement Highlights x MBA Statistics 2025 <td>Highest Package</td><td>INR ' || {_NATION} || '.1 crore per annum</td><td>Median Package</td> INR 34 LPA <td>Top Recruiters <b>Bain</td> IIM Ahmedabad MBA Placement -->' END || '</main>'"""
FACULTY = """CASE s_suppkey % 2 WHEN 0 THEN '<div class="faculty-card"><h3 class="name">Dr ' || s_name || '</h3><p class="designation">Dean</p></div><div class="Member"><span class="title">Mx  ' || s_name || '</span><p class="dept">Art</p></div><div class="member">no name</div>'
ELSE '<p>Intro\nDr. ' || s_name || ', PhD\nProfessor ' || s_name || '</p>\n<p>other</p>' END"""
SCHOLARSHIP = """CASE p_partkey % 3 WHEN 0 THEN '<table><tr><th>Name</th><th>Who</th></tr><tr><td>' || p_name || ' Scholarship</td><td>Top ' || CAST(p_size AS STRING) || '</td><td>INR 5,000</td></tr><tr><td>Merit scholarship</td><td>All</td></tr><tr><td>Loan</td><td>All</td></tr></table>'
WHEN 1 THEN '<ul><li class="award">' || p_name || ' scholarship: half</li><li class="award">Loan</li></ul><div class="merit">Scholarship</div>' ELSE '<p>scholarship</p>' END"""
HOSTEL = """'<p>Hostel Fees is INR ' || CAST(o_custkey AS STRING) || ',000 per year</p>' || CASE o_orderkey % 3 WHEN 0 THEN '<p>wi-fi and GYM</p>' WHEN 1 THEN '<p>Mess, sports</p>' ELSE '' END"""
REVIEW = """CASE c_custkey % 3 WHEN 0 THEN '<div class="review-card"><b class="author">' || c_name || '</b><i class="star">' || CAST(c_nationkey % 5 AS STRING) || '.5 of 5</i><p class="text">Good  ' || c_mktsegment || '</p></div><div class="comment-box"><p class="body">Fine</p></div><div class="review-card"><p class="text"> </p></div>'
WHEN 1 THEN '<script type="application/ld+json">{"@type":"CollegeOrUniversity","positiveNotes":"' || c_mktsegment || '"}</script>' ELSE '<p>none</p>' END"""
ADMISSION = """CASE p_partkey % 2 WHEN 0 THEN '<h2 class="heading">Admission Process</h2><p>Apply ' || p_name || '</p><h3 class="title">Important Dates</h3><ul><li>1 May</li></ul><h2 class="title">Selection criteria</h2><p>Merit  ' || p_brand || '</p>'
ELSE '<p>Admission Process: by ' || p_name || '\nthen GATE or jee main</p>' END"""

# page type -> (table, key, markup)
SOURCES = {
    "info": ("customer", "c_custkey", INFO),
    "placements": ("customer", "c_custkey", PLACEMENT),
    "courses": ("part", "p_partkey", COURSE_MIX),
    "faculty": ("supplier", "s_suppkey", FACULTY),
    "scholarships": ("part", "p_partkey", SCHOLARSHIP),
    "hostel": ("orders", "o_orderkey", HOSTEL),
    "reviews": ("customer", "c_custkey", REVIEW),
    "admissions": ("part", "p_partkey", ADMISSION),
}


def profile_pages(spark: SparkSession, sf_dir: str, kind: str, markup: str | None = None) -> DataFrame:
    """Pages of one type, one per row of the table behind it."""
    name, key, html = SOURCES[kind]
    return dealt_table(spark, sf_dir, name, key).select(
        F.col(key).cast("string").alias("college_id"),
        F.concat(F.lit("c-"), F.col(key).cast("string")).alias("slug"),
        F.lit(kind).alias("page_type"),
        F.concat(F.lit("https://campus.example/university/"), F.col(key).cast("string")).alias("url"),
        F.expr(markup or html).alias("html"),
    )


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of every type as one table."""
    parts = [profile_pages(spark, sf_dir, kind) for kind in SOURCES]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


# listing pages, one per supplier: two cards, a loose rank above a third link
LISTING_PAGE = """'<style>a{}</style><div class="wrap"><div class="college-card"><a href="/college/' || CAST(s_suppkey AS STRING) || '-a?x=1">A ' || s_name || '</a><span>₹ 4,50,' || CAST(100 + s_nationkey AS STRING)
|| ' Average Package</span><b>NIRF Ranking: ' || CAST(s_nationkey + 1 AS STRING) || '</b><i>; Highest Package ₹ 12 LPA</i><u>87.5% placed</u></div>'
|| '<div class="college-card"><em>#' || CAST(s_nationkey + 2 AS STRING) || '</em> <a href="//campus.example/university/' || CAST(s_suppkey % 7 AS STRING) || '-shared">B</a></div>'
|| '<div class="item"><a href="/college/5-x/reviews">sub</a></div></div><table><tr><td><p>#' || CAST(s_nationkey + 3 AS STRING) || '</p></td><td><a href="/none">n</a><a href="/colleges/' || CAST(s_suppkey AS STRING) || '-c">C</a></td></tr></table>'"""


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt_table(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("page_no"), F.expr(LISTING_PAGE).alias("html"))
