"""Declared schemas of the nine datasets and of the listing."""

from __future__ import annotations

from pyspark.sql import types as T

UNSPECIFIED = "Not Specified"

PAGE_TYPES = [
    "info", "courses", "admissions", "placements", "reviews",
    "faculty", "scholarships", "hostel", "cutoff",
]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


COLLEGES = T.StructType(
    _strings("college_id", "name", "url", "college_type", "ownership")
    + [T.StructField("established_year", T.IntegerType())]
    + _strings("accreditation", "affiliation", "rating", "ranking", "city", "state",
               "overview_description", "contact_info")
)
COURSES = T.StructType(_strings(
    "college_id", "degree_name", "course_name", "total_fees", "duration", "course_type",
    "eligibility", "entrance_exam", "application_date", "intake_seats", "course_level",
))
ADMISSIONS = T.StructType(_strings(
    "college_id", "admission_process", "exams_accepted", "eligibility_criteria",
    "important_dates", "application_deadlines",
))
PLACEMENTS = T.StructType(_strings(
    "college_id", "highest_package", "average_package", "median_package",
    "placement_percentage", "top_recruiters",
))
RANKINGS = T.StructType(
    _strings("college_id", "ranking_body", "rank") + [T.StructField("ranking_year", T.IntegerType())]
)
FACULTY = T.StructType(_strings("college_id", "faculty_name", "designation", "department"))
SCHOLARSHIPS = T.StructType(_strings("college_id", "scholarship_name", "eligibility", "amount"))
HOSTEL = T.StructType(_strings("college_id", "hostel_fees", "facilities"))
REVIEWS = T.StructType(
    _strings("college_id", "reviewer_name")
    + [T.StructField("rating", T.DoubleType())]
    + _strings("review_text")
)

DATASETS: dict[str, T.StructType] = {
    "colleges": COLLEGES,
    "courses": COURSES,
    "admissions": ADMISSIONS,
    "placements": PLACEMENTS,
    "rankings": RANKINGS,
    "faculty": FACULTY,
    "scholarships": SCHOLARSHIPS,
    "hostel": HOSTEL,
    "reviews": REVIEWS,
}

LISTING_COLUMNS = [
    "url", "listing_avg_package", "listing_highest_package",
    "listing_placement_percentage", "listing_rank",
]
LISTING = T.StructType(_strings(*LISTING_COLUMNS))
