"""Courses: embedded state and cards, else tables, else text windows.

A page's candidate rows are built inside its own row, and the costlier sources only where
the cheaper ones gave nothing. Only the short extracted rows are shuffled, to drop repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions import degrees as D
from campusweave.functions import money
from campusweave.functions.text import (
    blank_to_null, built_once, clean, contains_any, each, first_match, lacks_money, name_and_specialization,
    let, let_sql, strip, without_trailing_parens,
)
from campusweave.operators import html as H
from campusweave.operators.extract import exam_names, match_windows
from campusweave.operators.relational import first_wins
from campusweave.rules import degrees as R
from campusweave.rules import patterns as P
from campusweave.rules import vocab as V
from campusweave.schemas import COURSES

FIELDS = [
    "degree_name", "course_name", "specialization", "total_fees", "duration", "course_type",
    "eligibility", "entrance_exam", "application_date", "intake_seats", "course_level",
]
STATE_PATH = "props.initialProps.pageProps.data.course_data"
COURSE_ITEM = (
    "course_tag string, display_name string, short_head string, level string, exams string, "
    "duration string, type string, eligibility string, available_seats string, "
    "streams array<string>, fees_data string"
)
STREAM_ITEM = "name string, custom_name string, course_name string, display_course_name string, fees_data string"
FEES_ITEM = "amount string, amount_formatted string"
STATE, CARDS, TABLES, CONTEXT = range(4)


def _none() -> Column:
    return F.lit(None).cast("string")


ROW_TYPE = "array<struct<" + ",".join(f"{f}:string" for f in FIELDS) + ",key:string,category:string>>"


def _row(key: Sequence[str], category: Column | None = None, **values: Column) -> Column:
    fields = F.struct(
        *[values.get(f, _none()).cast("string").alias(f) for f in FIELDS],
        (category if category is not None else _none()).alias("category"),
    )
    copied = ", ".join(f"'{f}', r.{f}" for f in FIELDS)
    parts = ", ".join(f"coalesce(r.{k}, '\u0002')" for k in key)
    joined = f"concat_ws('\u0001', '{len(key)}', {parts})" if key else "cast(null AS STRING)"
    return let_sql(fields, "r", f"named_struct({copied}, 'key', {joined}, 'category', r.category)")


def _none_of() -> Column:
    return F.array().cast(ROW_TYPE)


def _fees(json: Column) -> Column:
    return let(F.from_json(json, FEES_ITEM), lambda data: money.fees(data["amount"], data["amount_formatted"]))


def _general_if_same(name: Column, degree: Column) -> Column:
    return F.when(F.lower(name) == F.lower(degree), F.lit("General")).otherwise(name)


# -- embedded state -------------------------------------------------------------------------


@built_once
def state_rows(html: str) -> Column:
    """Rows of the page's embedded course list: one per stream, or one per course without any."""
    items = H.app_state(F.col(html), STATE_PATH, "struct<courses:array<string>>")["courses"]
    courses = F.transform(items, lambda item: F.from_json(item, COURSE_ITEM))

    def names(c: Column) -> Column:
        tag, display, head = clean(c["course_tag"]), clean(c["display_name"]), clean(c["short_head"])
        best = F.coalesce(blank_to_null(tag), blank_to_null(head), display)
        return F.struct(
            c.alias("c"), D.degree_tag(best).alias("degree"), tag.alias("tag"), display.alias("display"), head.alias("head")
        )

    def course(n: Column) -> Column:
        c = n["c"]
        return F.struct(
            n["degree"].alias("degree"), n["tag"].alias("tag"), n["display"].alias("display"), n["head"].alias("head"),
            D.level(c["level"], n["degree"]).alias("level"),
            exam_names(c["exams"]).alias("exams"),
            blank_to_null(clean(c["duration"])).alias("duration"),
            F.coalesce(blank_to_null(clean(c["type"])), F.lit("Full Time")).alias("kind"),
            blank_to_null(clean(c["eligibility"])).alias("eligibility"),
            let(clean(c["available_seats"]), lambda s: F.when(~F.lower(s).isin("", "none", "not specified"), s)).alias("seats"),
            F.coalesce(c["streams"], F.array().cast("array<string>")).alias("streams"),
            c["fees_data"].alias("fees"),
        )

    def shared(b: Column) -> dict[str, Column]:
        return {
            "degree_name": b["degree"], "duration": b["duration"], "course_type": b["kind"],
            "eligibility": b["eligibility"], "entrance_exam": b["exams"], "course_level": b["level"],
        }

    def of_stream(b: Column, s: Column) -> Column:
        spec = clean(F.coalesce(blank_to_null(s["name"]), blank_to_null(s["custom_name"])))
        name = clean(F.coalesce(blank_to_null(s["course_name"]), blank_to_null(s["display_course_name"]), b["display"]))
        return _row(
            ["degree_name", "specialization", "total_fees"],
            **shared(b), course_name=without_trailing_parens(name), specialization=spec, total_fees=_fees(s["fees_data"]),
        )

    def alone(b: Column) -> Column:
        best = F.coalesce(blank_to_null(b["display"]), blank_to_null(b["tag"]), blank_to_null(b["head"]), b["degree"])
        return let(
            without_trailing_parens(best),
            lambda name: _row(
                ["degree_name", "course_name", "specialization", "total_fees"],
                **shared(b), course_name=name, specialization=_general_if_same(name, b["degree"]),
                total_fees=_fees(b["fees"]), intake_seats=b["seats"],
            ),
        )

    def rows(b: Column) -> Column:
        parsed = F.transform(b["streams"], lambda s: F.from_json(s, STREAM_ITEM))
        streams = F.filter(F.transform(parsed, lambda s: of_stream(b, s)), lambda r: r["specialization"] != "")
        return F.when(F.size(b["streams"]) > 0, streams).otherwise(F.array(alone(b)))

    known = F.transform(F.filter(F.transform(courses, names), lambda n: n["degree"] != ""), course)
    return F.coalesce(F.flatten(F.transform(known, rows)), _none_of())


# -- cards ----------------------------------------------------------------------------------


def _first_text(within: Column, part: str) -> Column:
    return H.text_at(H.first(F.filter(within, H.class_contains(part))))


def _rupees(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "^₹", ""))


@built_once
def card_rows() -> Column:
    """Rows of course cards in the page tree: one per stream, or one per card without any."""
    nodes = F.col("nodes")

    def card(c: Column) -> Column:
        return let(H.inside(c), described)

    def described(within: Column) -> Column:
        name = let(_first_text(within, "course-title"), without_trailing_parens)
        kind = strip(F.translate(_first_text(within, "course-duration-text"), "()", ""))

        def info(block: Column) -> Column:
            label = F.lower(_first_text(H.inside(block), "course-info-label"))
            return F.when(label.contains("application"), _first_text(H.inside(block), "course-info-value"))

        dates = F.filter(F.transform(F.filter(within, H.class_contains("course-info")), info), lambda d: d.isNotNull())
        return F.struct(
            name.alias("name"),
            _rupees(_first_text(within, "course-fee-amount")).alias("fee"),
            _first_text(within, "course-duration").alias("duration"),
            F.coalesce(blank_to_null(kind), F.lit("Full Time")).alias("kind"),
            H.first(dates).alias("applied"),
            F.filter(within, H.class_contains("stream-text")).alias("streams"),
        )

    def enclosing(parent: Column) -> Column:
        return F.when(parent == -1, nodes).otherwise(let(F.get(nodes, parent), H.inside))

    def degree(c: Column) -> Column:
        return c.withField("degree", D.degree_tag(c["name"]))

    def detail(c: Column) -> Column:
        return c.withField("more", D.details(c["degree"], c["name"]))

    def row(c: Column, spec: Column, fee: Column) -> Column:
        more = c["more"]
        part_time = (c["kind"] == "Full Time") & (more["course_type"] == "Part Time")
        return _row(
            ["degree_name", "course_name", "specialization", "total_fees", "duration", "course_type"],
            degree_name=c["degree"], course_name=c["name"], specialization=spec, total_fees=fee,
            duration=F.coalesce(c["duration"], more["duration"]),
            course_type=F.when(part_time, F.lit("Part Time")).otherwise(c["kind"]),
            entrance_exam=more["entrance_exam"], application_date=c["applied"], course_level=more["course_level"],
        )

    def of_stream(c: Column, s: Column) -> Column:
        near = _first_text(enclosing(s["parent"]), "primary-green")
        far = _first_text(enclosing(F.get(nodes, s["parent"])["parent"]), "primary-green")
        return row(c, clean(H.text_of(s)), F.coalesce(_rupees(near), _rupees(far), c["fee"]))

    def rows(c: Column) -> Column:
        streams = F.filter(F.transform(c["streams"], lambda s: of_stream(c, s)), lambda r: r["specialization"] != "")
        return F.when(F.size(c["streams"]) > 0, streams).otherwise(F.array(row(c, _general_if_same(c["name"], c["degree"]), c["fee"])))

    titled = F.filter(F.transform(H.nodes_where(H.class_contains("course-card")), card), lambda c: c["name"] != "")
    cards = F.transform(F.filter(F.transform(titled, degree), lambda c: D.is_course(c["degree"], c["name"])), detail)
    return F.coalesce(F.flatten(F.transform(cards, rows)), _none_of())


# -- tables ---------------------------------------------------------------------------------


def table_category(heading: Column) -> Column:
    """What the heading before a table says its rows are; 'Unknown' if nothing."""
    chain = None
    for word, degree, *_ in R.HEADED_DEGREES:
        here = heading.contains(word) & heading.contains("fees")
        value = F.when(heading.contains("other"), F.lit(f"{degree} Courses")).otherwise(F.lit(f"{degree} Specializations"))
        chain = F.when(here, value) if chain is None else chain.when(here, value)
    return (
        chain.when(heading.contains("other courses"), F.lit("Other Courses"))
        .when(heading.contains("cep courses"), F.lit("CEP Courses"))
        .otherwise(F.lit("Unknown"))
    )


def column_roles(header: Column, heading: Column) -> Column:
    """Positions (from 0, -1 for none) of the course, fee and eligibility columns."""
    is_course = lambda t: contains_any(t, V.COURSE_COLUMN_WORDS)
    is_fee = lambda t: ~is_course(t) & contains_any(t, V.FEE_COLUMN_WORDS)
    is_terms = lambda t: ~is_course(t) & ~is_fee(t) & t.contains("eligibility")

    def where(test) -> Column:
        return (F.array_position(F.transform(header, test), F.lit(True)) - 1).cast("int")

    def settle(r: Column) -> Column:
        guess = ((r["course"] == -1) | (r["fee"] == -1)) & (F.size(header) >= 2) & (heading.contains("fee") | heading.contains("course"))
        return F.struct(
            F.when(guess, F.lit(0)).otherwise(r["course"]).alias("course"),
            F.when(guess, F.lit(1)).otherwise(r["fee"]).alias("fee"),
            r["eligibility"].alias("eligibility"),
        )

    return let(F.struct(where(is_course).alias("course"), where(is_fee).alias("fee"), where(is_terms).alias("eligibility")), settle)


def is_fee_table(header: Column) -> Column:
    return (F.size(header) > 0) & F.coalesce(contains_any(F.get(header, 0), V.FEE_TABLE_WORDS), F.lit(False))


def is_header_row(cells: Column) -> Column:
    lead = F.lower(strip(F.get(cells, 0)))
    return (F.size(cells) == 0) | F.coalesce(lead.isin(*V.HEADER_CELLS) | contains_any(lead, V.HEADER_PHRASES), F.lit(False))


def eligibility_cell(c: Column) -> Column:
    return F.when(lacks_money(c), c)


def scanned_row(cells: Column, roles: Column, heading: Column, of_heading: Column) -> Column:
    """A row of a table whose columns were found by their headers."""
    headed = of_heading.isin(*R.RECOGNIZED_DEGREES)

    def read(raw: Column) -> Column:
        return F.struct(raw.alias("raw"), D.degree_tag(raw).alias("own"))

    def name(r: Column) -> Column:
        recognized = r["own"].isin(*R.RECOGNIZED_DEGREES)
        plain, _ = name_and_specialization(r["raw"], r["raw"])
        return F.struct(
            F.when(~recognized & headed, of_heading).otherwise(r["own"]).alias("degree"),
            F.when(recognized, plain).when(headed, without_trailing_parens(heading)).otherwise(without_trailing_parens(r["raw"])).alias("name"),
            F.when(~recognized & headed, r["raw"]).alias("spec"),
        )

    def row(n: Column) -> Column:
        terms = clean(F.get(cells, roles["eligibility"]))
        return let(
            D.details(n["degree"], n["name"]),
            lambda more: _row(
                [], F.lit("Unknown"),
                degree_name=n["degree"], course_name=n["name"],
                specialization=F.coalesce(n["spec"], _general_if_same(n["name"], n["degree"])),
                total_fees=F.trim(F.replace(clean(F.get(cells, roles["fee"])), F.lit("INR "), F.lit(""))),
                eligibility=F.when((roles["eligibility"] >= 0) & (terms != ""), eligibility_cell(terms)),
                **{f: more[f] for f in R.DETAIL_DEFAULTS},
            ),
        )

    return let(let(let(clean(F.get(cells, roles["course"])), read), name), row)


def _other_course(raw: Column) -> dict[str, Column]:
    lowered = F.lower(raw)
    tests = [contains_any(lowered, words) for words, *_ in R.OTHER_COURSE_RULES]

    def chain(position: int, default: str) -> Column:
        out = None
        for test, rule in zip(tests, R.OTHER_COURSE_RULES):
            out = F.when(test, F.lit(rule[position])) if out is None else out.when(test, F.lit(rule[position]))
        return out.otherwise(F.lit(default))

    hour = F.lit("Full Time")
    for test, (words, *_) in zip(reversed(tests), reversed(R.OTHER_COURSE_RULES)):
        if "mba" in words:
            kind = F.when(contains_any(lowered, ["emba", "executive"]), F.lit("Part Time")).otherwise(F.lit("Full Time"))
        else:
            kind = F.lit("Part Time" if "executive" in words else "Full Time")
        hour = F.when(test, kind).otherwise(hour)
    return {"duration": chain(1, ""), "course_level": chain(2, "UG"), "entrance_exam": chain(3, "Not Specified"), "course_type": hour}


def headed_row(cells: Column, category: Column) -> Column:
    """A row of a table whose heading says what its rows are."""
    return let(strip(F.get(cells, 0)), lambda raw: _headed_row(raw, cells, category))


def _headed_row(raw: Column, cells: Column, category: Column) -> Column:
    fee = strip(F.get(cells, 1))
    other, cep = category == "Other Courses", category == "CEP Courses"
    loose = _other_course(raw)

    def pick(position: int, field: str, on_cep: str) -> Column:
        out = F.when(other, loose[field]).when(cep, F.lit(on_cep))
        for _, degree, *rest in R.HEADED_DEGREES:
            out = out.when(category.startswith(degree), F.lit(rest[position]))
        return out

    degree = F.when(other, raw).when(cep, F.lit("Executive Programme (CEP)"))
    name = F.when(other, F.concat(raw, F.lit(" (General)")))
    for _, tag, *_rest in R.HEADED_DEGREES:
        degree = degree.when(category.startswith(tag), F.lit(tag))
        cut = (category == f"{tag} Specializations") & raw.startswith(tag)
        name = name.when(cut, strip(F.substr(raw, F.lit(len(tag) + 1))))
    third = clean(F.get(cells, 2))
    return let(F.struct(degree.alias("degree"), name.otherwise(raw).alias("name")), lambda n: _row(
        [], category,
        degree_name=n["degree"], course_name=without_trailing_parens(n["name"]),
        specialization=F.when(n["name"] == F.concat(n["degree"], F.lit(" (General)")), F.lit("General")).otherwise(n["name"]),
        total_fees=F.when(~cep, F.trim(F.replace(fee, F.lit("INR "), F.lit("")))),
        eligibility=F.when(F.size(cells) >= 3, eligibility_cell(third)),
        duration=pick(0, "duration", "1 Year"), course_level=pick(1, "course_level", "PG"),
        entrance_exam=pick(2, "entrance_exam", "Not Specified"),
        course_type=F.when(other, loose["course_type"]).when(cep, F.lit("Part Time")).otherwise(F.lit("Full Time")),
    ))


@built_once
def table_rows() -> Column:
    """Rows of a page's tables (see ``html.table_structs``)."""
    tables = H.table_structs()

    def describe(t: Column) -> Column:
        header = F.transform(F.coalesce(F.get(t["rows"], 0), F.array().cast("array<string>")), lambda c: F.lower(clean(c)))
        return F.struct(
            t["heading"].alias("heading"), t["rows"].alias("rows"), header.alias("header"),
            table_category(t["heading"]).alias("category"), D.degree_tag(t["heading"]).alias("degree"),
        )

    def with_roles(t: Column) -> Column:
        return t.withField("roles", let(t["header"], lambda header: column_roles(header, t["heading"])))

    def rows(t: Column) -> Column:
        roles = t["roles"]
        scanned = F.filter(
            F.transform(
                F.filter(
                    F.slice(t["rows"], 2, F.greatest(F.size(t["rows"]) - 1, F.lit(0))),
                    lambda cells: (F.size(cells) > F.greatest(roles["course"], roles["fee"]))
                    & ~F.lower(clean(F.get(cells, roles["course"]))).isin("", *V.SCANNED_HEADER_CELLS),
                ),
                lambda cells: scanned_row(cells, roles, t["heading"], t["degree"]),
            ),
            lambda r: r["degree_name"].isNotNull(),
        )
        headed = F.transform(
            F.filter(t["rows"], lambda cells: ~is_header_row(cells) & (F.size(cells) >= 2)),
            lambda cells: headed_row(cells, t["category"]),
        )
        useless = contains_any(t["heading"], V.IRRELEVANT_HEADINGS) | (roles["course"] == -1) | (roles["fee"] == -1)
        return (
            F.when(t["category"] != "Unknown", headed)
            .when(useless, _none_of())
            .otherwise(scanned)
        )

    described = F.transform(F.filter(tables, lambda t: F.size(t["rows"]) > 0), describe)
    kept = F.filter(described, lambda t: ~is_fee_table(t["header"]))
    return F.coalesce(F.flatten(F.transform(F.transform(kept, with_roles), rows)), _none_of())


def expanded_rows(rows: DataFrame, rules: Sequence[tuple] = R.EXPANDED_ROWS) -> DataFrame:
    """Rows that a rule pack adds under an 'other courses' row of a given degree.

    Column names are those of the exploded course rows; ``pos`` puts them right behind their row.
    """
    pack = F.array(*[
        F.struct(F.lit(i).alias("i"), *[F.lit(v).cast("string").alias(n) for n, v in zip(("degree", "spec", "fee", "duration", "terms", "exam", "level"), rule)])
        for i, rule in enumerate(rules, start=1)
    ])
    hit = rows.filter(F.col("category") == "Other Courses").withColumn("_p", F.explode(pack)).filter(F.col("_p.degree") == F.col("degree_name"))
    return hit.withColumns(
        {
            "pos": F.col("pos") + F.col("_p.i") / 100,
            "course_name": F.col("_p.spec"), "specialization": F.col("_p.spec"),
            "total_fees": F.coalesce("_p.fee", "total_fees"), "duration": F.col("_p.duration"),
            "course_type": F.lit("Full Time"), "eligibility": F.col("_p.terms"),
            "entrance_exam": F.col("_p.exam"), "course_level": F.col("_p.level"),
            "application_date": _none(), "intake_seats": _none(), "category": F.lit("rule"),
        }
    ).drop("_p")


# -- text windows ---------------------------------------------------------------------------


@built_once
def context_rows(html: str) -> Column:
    """Rows from course names in the page source and what stands near them."""

    def read(m: Column) -> Column:
        window = m["window"]
        tag = F.try_element_at(F.regexp_extract_all(window, F.lit(P.CONTEXT_TAG), F.lit(1)), F.lit(-1))
        return F.struct(
            D.degree_tag(F.coalesce(tag, F.lit(""))).alias("degree"),
            clean(F.regexp_extract(m["match"], P.CONTEXT_COURSE, 1)).alias("spec"),
            without_trailing_parens(clean(F.regexp_extract(m["match"], P.CONTEXT_COURSE, 2))).alias("name"),
            F.coalesce(first_match(window, P.CONTEXT_FEE, 1), first_match(window, P.CONTEXT_FEE, 2)).alias("amount"),
            first_match(window, P.CONTEXT_FORMATTED).alias("formatted"),
        )

    def row(m: Column) -> Column:
        general = F.lower(m["spec"]).isin("", "general") | (F.lower(m["spec"]) == F.lower(m["degree"]))
        return _row(
            ["degree_name", "course_name", "specialization", "total_fees"],
            degree_name=m["degree"], course_name=m["name"],
            specialization=F.when(general, F.lit("General")).otherwise(m["spec"]),
            total_fees=money.fees(m["amount"], m["formatted"]),
            course_type=F.lit("Full Time"), course_level=D.level_of_degree(m["degree"]),
        )

    windows = match_windows(F.col(html), P.CONTEXT_COURSE, V.CONTEXT_BEFORE, V.CONTEXT_AFTER)
    return F.coalesce(F.transform(F.filter(F.transform(windows, read), lambda m: m["degree"] != ""), row), _none_of())


# -- the dataset ----------------------------------------------------------------------------


def _valid(r: Column) -> Column:
    return D.is_course(r["degree_name"], r["course_name"])


@built_once
def usable_state() -> Column:
    """Whether the embedded state gives a row.

    A row counts where no earlier one has its key: an unusable first one hides the rest.
    """
    return F.exists(
        F.transform("_state", lambda r, i: F.struct(r.alias("r"), i.alias("i"))),
        lambda s: _valid(s["r"]) & (F.array_position(F.col("_state_keys"), s["r"]["key"]) == s["i"] + 1),
    )


def course_candidates(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """All rows of each page's winning source, repeats included, with source and position."""
    page = H.with_headings(H.readable_tree(H.narrowed(pages, *keys, html), html, keep_html=True)).select(*keys, html, "nodes", "texts", "_heading_at")
    page = page.withColumns({"_state": state_rows(html), "_cards": card_rows()})
    page = page.withColumn("_state_keys", F.col("_state.key"))
    page = page.withColumn("_structured", (F.size("_cards") > 0) | usable_state())
    page = page.withColumn("_tables", F.when(F.col("_structured"), _none_of()).otherwise(table_rows()))
    page = page.withColumn("_tabled", F.exists("_tables", _valid))
    page = page.withColumn(
        "_context", F.when(F.col("_structured") | F.col("_tabled"), _none_of()).otherwise(context_rows(html))
    )

    def numbered(source: int, column: str) -> Column:
        return F.transform(column, lambda r: F.struct(F.lit(source).alias("source"), r.alias("r")))

    chosen = (
        F.when(F.col("_structured"), F.concat(numbered(STATE, "_state"), numbered(CARDS, "_cards")))
        .when(F.col("_tabled"), numbered(TABLES, "_tables"))
        .otherwise(numbered(CONTEXT, "_context"))
    )
    return (
        each(page, keys, chosen, "c", "pos")
        .select(*keys, "c.source", F.col("pos").cast("double").alias("pos"), "c.r.*")
    )


def first_courses(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats: within a source by its own key, then fee lines, then by degree and specialization."""
    same_source = first_wins(candidates, [*keys, "source", F.coalesce("key", F.col("pos").cast("string"))], ["pos"])
    usable = same_source.filter((F.col("source") == CONTEXT) | _valid(F.struct("degree_name", "course_name")))
    by_course = F.when(
        F.col("source") != CONTEXT, F.concat_ws("\u0001", F.lower("degree_name"), F.lower("specialization"))
    ).otherwise(F.col("key"))
    return first_wins(usable, [*keys, by_course], ["source", "pos"])


def rename_course_columns(rows: DataFrame) -> DataFrame:
    """Course rows under the output names: the name becomes the degree, the stream the course."""
    return rows.select(
        "college_id",
        F.col("course_name").alias("degree_name"),
        F.col("specialization").alias("course_name"),
        *[c for c in COURSES.fieldNames() if c not in ("college_id", "degree_name", "course_name")],
    )


def build_courses(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug"), expand_rules: bool = False) -> DataFrame:
    """Course dataset of course pages."""
    candidates = course_candidates(pages, keys)
    if expand_rules:
        candidates = candidates.unionByName(expanded_rows(candidates))
    return rename_course_columns(first_courses(candidates, keys))
