"""Faculty, scholarships, hostel, reviews and admissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions.text import blank_to_null, clean, first_match, keep_longest, let, vocabulary_hits
from campusweave.operators import html as H
from campusweave.operators.extract import lines_with
from campusweave.rules import patterns as P
from campusweave.rules import vocab as V

# What stands in for a missing field.
FACULTY_DEFAULTS = {"designation": "Professor", "department": "Engineering"}
SCHOLARSHIP_DEFAULTS = {"eligibility": "Income / Merit based", "amount": "Tution fee waiver / Cash"}
REVIEWER_DEFAULT, RATING_DEFAULT = "Anonymous Student", 4.0
# Notes of the page's own record, as (path, reviewer, rating, prefix).
REVIEW_NOTES = [
    ("$.positiveNotes", "Alumni Reviewer", 4.5, "Pros: "),
    ("$.negativeNotes", "Student Reviewer", 3.8, "Cons: "),
]


def _trees(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    return H.readable_tree(H.narrowed(pages, *keys, "html"))


def build_faculty(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """People of faculty cards; without any, of lines that name a title."""

    def person(c: Column) -> Column:
        return let(H.inside(c), described)

    def described(within: Column) -> Column:
        values = {n: H.text_at(H.first(F.filter(within, H.tagged_class(tags, cls)))) for n, (tags, cls) in P.FACULTY_FIELDS.items()}
        return F.struct(
            values["faculty_name"].alias("faculty_name"),
            *[F.coalesce(values[n], F.lit(d)).alias(n) for n, d in FACULTY_DEFAULTS.items()],
        )

    def from_line(line: Column) -> Column:
        return F.struct(
            F.trim(F.get(F.split(line, ",", -1), F.lit(0))).alias("faculty_name"),
            F.when(line.contains("Professor"), F.lit("Professor")).otherwise(F.lit("Associate Professor")).alias("designation"),
            F.lit("Engineering").alias("department"),
        )

    cards = F.filter(F.transform(H.nodes_where(H.tagged_class(["div", "tr"], P.FACULTY_CARD_CLASS)), person), lambda p: F.coalesce(p["faculty_name"] != "", F.lit(False)))
    lines = F.slice(lines_with(H.page_text(), ["Professor", "Dr."], V.FACULTY_LINE_CHARS), 1, V.FACULTY_LINES)
    page = _trees(pages, keys).select(*keys, "texts", cards.alias("_cards"))
    people = F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(F.transform(lines, from_line))
    return page.select(*keys, F.posexplode(people).alias("pos", "p")).select(*keys, "pos", "p.*")


def build_scholarships(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Table rows that name a scholarship; without any, short cards that do."""
    aid = F.filter(
        F.transform(
            F.filter(F.flatten(F.col("_tables.rows")), lambda cells: F.size(cells) >= 2),
            lambda cells: F.struct(
                clean(F.get(cells, 0)).alias("scholarship_name"),
                clean(F.get(cells, 1)).alias("eligibility"),
                F.when(F.size(cells) >= 3, clean(F.get(cells, 2))).alias("amount"),
            ),
        ),
        lambda s: F.lower(s["scholarship_name"]).contains("scholarship"),
    )
    texts = F.transform(H.nodes_where(H.tagged_class(["div", "li"], P.SCHOLARSHIP_CARD_CLASS)), lambda c: clean(H.text_of(c)))
    short = F.filter(texts, lambda t: F.lower(t).contains("scholarship") & (F.length(t) < V.SCHOLARSHIP_CARD_CHARS))
    cards = F.transform(
        short,
        lambda t: F.struct(F.trim(F.get(F.split(t, ":", -1), F.lit(0))).alias("scholarship_name"), *[F.lit(v).alias(n) for n, v in SCHOLARSHIP_DEFAULTS.items()]),
    )
    page = H.with_headings(_trees(pages, keys)).withColumn("_tables", H.table_structs()).withColumn("_aid", aid)
    return (
        page.select(*keys, F.posexplode(F.when(F.size("_aid") > 0, F.col("_aid")).otherwise(cards)).alias("pos", "s"))
        .select(*keys, "pos", "s.*")
    )




def build_hostel(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Hostel fee and facilities named on the page."""
    page = _trees(pages, keys).select(*keys, H.page_text().alias("_text"))
    return page.select(
        *keys,
        first_match(F.col("_text"), P.HOSTEL_FEES).alias("hostel_fees"),
        vocabulary_hits(F.col("_text"), V.FACILITIES).alias("facilities"),
    )


def build_reviews(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Review cards with text; without any, the notes of the page's own record. Nothing is made up."""

    def review(c: Column) -> Column:
        return let(H.inside(c), described)

    def described(within: Column) -> Column:
        found = {n: H.first(F.filter(within, H.has_class(cls))) for n, cls in P.REVIEW_FIELDS.items()}
        number = first_match(H.text_at(found["rating"]), P.FIRST_NUMBER)
        return F.struct(
            F.coalesce(H.text_at(found["reviewer"]), F.lit(REVIEWER_DEFAULT)).alias("reviewer_name"),
            F.coalesce(number.try_cast("double"), F.lit(RATING_DEFAULT)).alias("rating"),
            keep_longest(H.text_at(found["body"]), V.REVIEW_CHARS).alias("review_text"),
        )

    cards = F.filter(
        F.transform(H.nodes_where(H.tagged_class(["div"], P.REVIEW_CARD_CLASS)), review),
        lambda r: F.coalesce(r["review_text"] != "", F.lit(False)),
    )
    notes = F.filter(
        F.array(*[
            F.struct(F.lit(who).alias("reviewer_name"), F.lit(rating).alias("rating"), F.concat(F.lit(prefix), blank_to_null(F.get_json_object("_ld", path))).alias("review_text"))
            for path, who, rating, prefix in REVIEW_NOTES
        ]),
        lambda r: r["review_text"].isNotNull(),
    )
    found = H.narrowed(pages, *keys, "html", H.json_ld_of_type(F.col("html"), "CollegeOrUniversity").alias("_ld"))
    page = H.readable_tree(found).select(*keys, "_ld", cards.alias("_cards"))
    return (
        page.select(*keys, F.posexplode(F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(notes)).alias("pos", "r"))
        .select(*keys, "pos", "r.*")
    )


def build_admissions(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Admission fields from headed sections (the last one wins), else from the text."""
    heading = H.tagged_class(["h2", "h3", "h4", "div"], P.SECTION_CLASS)
    names = [name for name, *_ in V.ADMISSION_SECTIONS]
    page = H.with_sections(_trees(pages, keys), heading, ["p", "ul", "ol", "table"], V.ADMISSION_SECTIONS)
    page = page.select(*keys, *names, H.page_text().alias("_text"))
    fields, text = {name: F.col(name) for name in names}, F.col("_text")
    process = F.when(text.rlike(P.ADMISSION_PROCESS), clean(F.regexp_extract(text, P.ADMISSION_PROCESS, 1)))
    fields["admission_process"] = F.coalesce(fields["admission_process"], process)
    fields["exams_accepted"] = F.coalesce(fields["exams_accepted"], vocabulary_hits(text, V.ADMISSION_EXAMS))
    return page.select(*keys, *[c.alias(n) for n, c in fields.items()])
