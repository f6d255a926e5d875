"""Dataset jobs on small invented pages, one behaviour each."""

import json

import pytest
from pyspark.sql import functions as F

from campusweave.plans import colleges, courses, people, placements, rankings
from campusweave.plans.run import finish
from campusweave.site import Site
from tests.conftest import rows


def state(**data):
    body = {"props": {"initialProps": {"pageProps": {"data": data}}}}
    return f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(body)}</script>'


def built(df, *columns):
    return rows(courses.build_courses(df), *columns)


# -- courses --


def test_streams_and_repeats(page):
    html = state(course_data={"courses": [
        {"course_tag": "BE/B.Tech", "display_name": "B.Tech (Hons)", "streams": [
            {"name": "CSE", "fees_data": {"amount": 250000}}, {"name": "cse", "fees_data": {"amount": 300000}},
            {"custom_name": "ECE", "fees_data": {"amount_formatted": "3 L"}}, {"name": ""}, "x"]},
        {"short_head": "", "display_name": ""}, 5,
    ]})
    # the same stream in other letters is the same stream; the first fee stays
    assert built(page(html, "courses"), "degree_name", "course_name", "total_fees") == [("B.Tech", "CSE", "2.5 Lakhs"), ("B.Tech", "ECE", "3 L")]


def test_unusable_first_row_hides_a_usable_one(page):
    # same degree, stream and fee: the first row's course name makes it a fee line
    streams = [{"name": "CSE", "course_name": "Hostel fee"}, {"name": "CSE", "course_name": "B.Tech"}]
    html = state(course_data={"courses": [{"course_tag": "B.Tech", "streams": streams}]})
    assert built(page(html, "courses"), "course_name") == []


def test_tables_are_read_when_state_gives_nothing_usable(page):
    html = state(course_data={"courses": [{"display_name": "Hostel fee"}]}) + "<h2>Courses</h2><table><tr><th>Course<th></th></th><th>Fees</th></tr></table>"
    html += "<h2>Courses</h2><table><tr><th>Course</th><th>Fees</th></tr><tr><td>BCA</td><td>INR 1 L</td></tr></table>"
    assert built(page(html, "courses"), "degree_name", "total_fees") == [("BCA", "1 L")]


def test_state_goes_before_cards(page):
    html = state(course_data={"courses": [{"course_tag": "MBA", "display_name": "MBA", "streams": [{"name": "Finance", "fees_data": {"amount": 5}}]}]})
    html += '<div class="course-card"><p class="course-title">MBA</p><b class="course-fee-amount">₹9</b><i class="stream-text">Finance</i><i class="stream-text">Law</i></div>'
    assert built(page(html, "courses"), "course_name", "total_fees") == [("Finance", "5"), ("Law", "9")]


def test_card_fee_of_parent_then_grandparent_then_card(page):
    html = """<div class="course-card"><h3 class="course-title">M.Tech</h3><b class="course-fee-amount">₹ 9 L</b>
    <ul><li><i class="stream-text">A</i><u class="primary-green">₹1 L</u></li></ul>
    <section><div><p><i class="stream-text">B</i></p><u class="primary-green">2 L</u></div></section>
    <section><div><p><i class="stream-text">C</i></p></div></section></div>"""
    assert built(page(html, "courses"), "course_name", "total_fees") == [("A", "1 L"), ("B", "2 L"), ("C", "9 L")]


def test_headed_table(page):
    html = """<h3>Fees of M.Tech</h3><table><tr><td>Course</td><td>Total Fees</td></tr>
    <tr><td>M.Tech Robotics</td><td>INR 2 L</td><td>GATE</td></tr><tr><td>Optics</td><td>INR 3 L</td><td>3 Lakh</td></tr></table>"""
    assert built(page(html, "courses"), "course_name", "total_fees", "eligibility", "entrance_exam", "duration") == [
        ("Optics", "3 L", None, "GATE", "2 Years"), ("Robotics", "2 L", "GATE", "GATE", "2 Years"),
    ]


def test_other_courses_and_rule_rows(page):
    html = "<h3>Other courses</h3><table><tr><td>Ph.D</td><td>INR 1 L</td></tr><tr><td>Yoga</td><td>5</td></tr></table>"
    df = page(html, "courses")
    assert built(df, "degree_name", "course_name", "duration") == [("Ph.D", "General", "3-5 Years"), ("Yoga", "General", "")]
    expanded = rows(courses.build_courses(df, expand_rules=True), "course_name", "total_fees")
    assert len(expanded) == 6 and ("Public Policy", "3.4 Lakhs") in expanded


def test_scanned_table_takes_degree_from_heading(page):
    html = """<h2>MBA course list</h2><table><tr><td>Specialization</td><td>Amount</td><td>Eligibility</td></tr>
    <tr><td>Finance</td><td>INR 5 L</td><td>CAT</td></tr><tr><td>specialization</td><td>1</td></tr><tr><td>only one</td></tr></table>"""
    assert built(page(html, "courses"), "degree_name", "course_name", "eligibility") == [("mba course list", "Finance", "CAT")]


@pytest.mark.parametrize("heading", ["Placement courses", "Cutoff course", "FAQ course fees"])
def test_irrelevant_tables(page, heading):
    html = f"<h2>{heading}</h2><table><tr><td>Course</td><td>Fee</td></tr><tr><td>MBA</td><td>1</td></tr></table>"
    assert built(page(html, "courses"), "degree_name") == []


def test_context_takes_last_tag_and_whole_text(page):
    far = "x" * 200_000
    html = far + '"course_tag":"MBA","a":1,"course_tag":"M.Sc" "course_name":"Physics","display_course_name":"M.Sc (P)","fees_data":{"amount":"1,50,000"' + far
    assert built(page(html, "courses"), "degree_name", "course_name", "total_fees", "course_level") == [("M.Sc", "Physics", "1.5 Lakhs", "PG")]


def test_context_window_ends(page):
    tag = '"course_tag":"MBA"'
    name = '"course_name":"A","display_course_name":"B"'
    inside = tag + " " * (900 - len(tag)) + name
    outside = tag + " " * (901 - len(tag)) + name
    assert len(built(page(inside, "courses"), "course_name")) == 1
    assert built(page(outside, "courses"), "course_name") == []


# -- colleges --


def place(df):
    return rows(colleges.build_colleges(df), "city", "state")[0]


def test_location_header_blocks_the_spans(page):
    span = "<span>Pune, Maharashtra</span>"
    assert place(page(span)) == ("Pune", "Maharashtra")
    assert place(page('<span class="header_info">Goa</span>' + span)) == (None, None)


def test_location_from_text_and_india_cut(page):
    assert place(page("<p>Situated in Agra, Uttar Pradesh India.</p>")) == ("Agra", "Uttar Pradesh")
    assert place(page("<span>India, Goa</span><span>Goa, India</span>")) == ("Goa", None)


def test_no_break_spaces_count_as_space(page):
    got = colleges.build_colleges(page("<p>Estd.&nbsp;Year&nbsp;1990;</p><span>Pune,&nbsp;Goa</span><p>Approved&nbsp;by&nbsp;:&nbsp;UGC;</p>")).first()
    assert (got["established_year"], got["city"], got["state"], got["accreditation"]) == (1990, "Pune", "Goa", "UGC")
    html = "<p>Highest package&nbsp;of INR 5 LPA</p>"
    assert paid(page(html, "placements"))[0] == "5 LPA"
    assert rows(people.build_hostel(page("<p>Hostel Fee&nbsp;is&nbsp;INR&nbsp;5,000&nbsp;per</p>", "hostel")), "hostel_fees")[0][0].startswith("5,000")


def test_college_fields_and_sentinels(page):
    df = finish("colleges", colleges.build_colleges(page("<title>Foo Courses 2025</title><p>A republic of letters</p>")))
    got = df.first().asDict()
    assert (got["name"], got["ownership"], got["rating"], got["ranking"], got["established_year"]) == ("Foo", "Public", "Not Rated", "Not Ranked", None)
    assert got["accreditation"] == got["city"] == got["contact_info"] == "Not Specified"


def test_listing_rank_and_candidate_order(spark, page):
    site = Site("https://s.example", "Guide", "G Rank")
    listing = spark.createDataFrame(
        [("https://s.example/college/1-a", "#5"), ("https://s.example/university/1-a", "#4"), ("https://s.example/colleges/2-b", "#9")], "url string, listing_rank string"
    )
    got = colleges.build_colleges(page("<p>Guide rank 7</p>"), listing, site=site).first()
    assert (got["url"], got["ranking"], got["college_type"]) == ("https://s.example/university/1-a", "G Rank #4", "University")
    # the third address form is never looked up
    got = colleges.build_colleges(page("<p>Guide rank 7</p>", college_id="2", slug="b"), listing, site=site).first()
    assert (got["url"], got["ranking"]) == ("https://s.example/university/2-b", "Rank #7")


# -- placements --


def paid(df):
    return rows(placements.build_placements(df), "highest_package", "average_package", "median_package", "top_recruiters")[0]


def test_state_goes_first_and_silences_the_block(page):
    block = "IIM Ahmedabad Placement Highlights MBA Statistics 2025 Median Package</td><td>INR 34 LPA IIM Ahmedabad MBA Placement"
    assert paid(page(block, "placements"))[2] == "34 LPA"
    html = state(placements={"highest_salary": 12000000}) + "<!--" + block + "-->"
    assert paid(page(html, "placements")) == ("1.20 Cr", None, None, None)


def test_broken_first_figure_voids_the_second(page):
    assert paid(page(state(placements={"highest_salary": "x", "average_salary": 500000}), "placements"))[:2] == (None, None)


def test_tables_outside_noise_only(page):
    html = "<aside><table><tr><td>Highest Package</td><td>9 LPA</td></tr></table></aside><table><tr><td>Avg. annual package</td><td>8 LPA</td></tr><tr><td>Top recruiter</td><td>Acme</td></tr></table>"
    assert paid(page(html, "placements")) == (None, "8 LPA", None, "Acme")


def test_recruiters_from_names_and_noise(page):
    assert paid(page("<p>We saw tcs and Google.</p>", "placements"))[3] == "Google, TCS"
    assert paid(page("<p>Top recruiters: " + "a" * 301 + "</p>", "placements"))[3] is None


def test_labelled_value(page):
    assert paid(page("<p>Median CTC of the class: INR 7.5 LPA</p>", "placements"))[2] == "7.5 LPA"


# -- rankings --


def ranked(df):
    return rows(rankings.build_rankings(df), "ranking_body", "rank", "ranking_year")


def test_state_rankings_of_both_pages(page):
    entries = [{"agency": "NIRF", "rank": 3, "year": "2024"}, {"agency": "campus guide.com", "rank": "5", "stream": "MBA"}, {"agency": "X", "rank": "2.5"}, {"agency": "Y", "rank": 0}, {"rank": 4}, "z"]
    info = page(state(basic_info={"ranking": entries}), "info")
    placed = page(state(basic_info={"ranking": [{"agency": "NIRF", "rank": 3, "year": 2024}, {"agency": "IndiaToday", "rank": 9}]}) + "<p>Ranked 8 by Outlook</p>", "placements")
    assert ranked(info.union(placed)) == [("Campus Guide (MBA)", "CG Rank #5", None), ("India Today", "#9", None), ("NIRF", "#3", 2024)]
    # without a placement page rankings are not read
    assert ranked(info) == []


def test_text_rankings(page):
    placed = page("<p>It ranked 12th in engineering by NIRF, 2023. QS World University # 800 in 2031. Outlook: rank 6001</p>", "placements")
    info = page("<p>Ranked 99 by NIRF. The Week #4</p><nav>IIRF rank 1</nav>", "info")
    assert ranked(placed.union(info)) == [("NIRF", "#12", 2023), ("QS World", "#800", None), ("The Week", "#4", None)]


def test_unusable_state_falls_back_to_text(page):
    placed = page(state(basic_info={"ranking": [{"agency": "X", "rank": "first"}]}) + "<p>Ranked 8 by Outlook</p>", "placements")
    assert ranked(placed) == [("Outlook", "#8", None)]


def test_dedup_ignores_rank_and_matches_null_years(spark):
    schema = "college_id string, ranking_body string, rank string, ranking_year int, source int, pos int"
    new = spark.createDataFrame([("1", "A", "#1", None, 0, 0), ("1", "A", "#2", None, 0, 1), ("1", "B", "#3", None, 0, 2), ("1", "A", "#4", 2020, 0, 3)], schema)
    old = spark.createDataFrame([("1", "B", None)], "college_id string, ranking_body string, ranking_year int")
    assert rows(rankings.dedup_rankings(old, new), "ranking_body", "rank") == [("A", "#1"), ("A", "#4")]


# -- the others --


def test_nested_faculty_cards_count_twice(page):
    html = '<div class="faculty-list"><div class="member"><h4 class="name">A</h4><p class="role">Dean</p></div></div>'
    assert rows(people.build_faculty(page(html, "faculty")), "faculty_name", "designation", "department") == [("A", "Dean", "Engineering")] * 2


def test_faculty_lines(page):
    html = "<pre>" + "\n".join(f"Dr. P{i}, x" for i in range(20)) + "\nProfessor " + "z" * 100 + "</pre>"
    got = rows(people.build_faculty(page(html, "faculty")), "faculty_name", "designation")
    assert len(got) == 15 and ("Dr. P14", "Associate Professor") in got


def test_reviews(page):
    html = '<div class="review-card"><b class="author">Z</b><i class="star">4.5.1</i><p class="text">' + "g" * 1200 + "</p></div>"
    assert [(n, r, len(t)) for n, r, t in rows(people.build_reviews(page(html, "reviews")), "reviewer_name", "rating", "review_text")] == [("Z", 4.0, 1000)]
    notes = '<script type="application/ld+json">{"@type":"CollegeOrUniversity","positiveNotes":"p","negativeNotes":"n"}</script>'
    assert rows(people.build_reviews(page(notes, "reviews")), "rating", "review_text") == [(3.8, "Cons: n"), (4.5, "Pros: p")]
    assert rows(people.build_reviews(page("<p>none</p>", "reviews")), "review_text") == []


def test_scholarships(page):
    html = "<table><tr><td>x</td></tr><tr><td>Merit Scholarship</td><td>90%</td></tr></table><li class='award'>Other scholarship: y</li>"
    assert rows(people.build_scholarships(page(html, "scholarships")), "scholarship_name", "eligibility", "amount") == [("Merit Scholarship", "90%", None)]


def test_admissions(page):
    html = """<h2 class="heading">Selection criteria</h2><p>first</p><div class="title">Entrance Exam <ul><li>CAT</li></ul></div>
    <h3 class="title">Admission process</h3><p>second</p><h4>Important dates</h4><p>no class, no section</p>"""
    got = rows(people.build_admissions(page(html, "admissions")), "admission_process", "exams_accepted", "important_dates")
    assert got == [("second", "CAT", None)]
    got = rows(people.build_admissions(page("<p>Admission Process: apply\nnow. gate</p>", "admissions")), "admission_process", "exams_accepted")
    assert got == [("apply", "GATE")]


def test_hostel(page):
    got = rows(people.build_hostel(page("<p>Hostel Fee was INR 45,000 per year; gym, WI-FI</p>", "hostel")), "hostel_fees", "facilities")
    assert got == [("45,000 per", "Wi-Fi, Gym")]


def test_one_bad_page_does_not_stop_the_others(spark, monkeypatch):
    from campusweave.operators import html as H

    pages = spark.createDataFrame([(1, "<p>a</p>"), (2, None), (3, "<p>b</p>")], "id int, html string")
    trees = H.with_tree(pages)
    assert rows(trees.select("id", F.size("nodes").alias("n")), "id", "n") == [(1, 1), (2, 0), (3, 1)]
    failed = trees.withColumn("parse_error", F.when(F.col("id") == 2, "ValueError: x"))
    assert rows(H.rejected_pages(failed), "id", "parse_error") == [(2, "ValueError: x")]
