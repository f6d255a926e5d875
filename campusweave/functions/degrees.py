"""Degree rules as generated CASE expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from campusweave.functions.text import clean, let_sql, quoted, strip
from campusweave.rules.degrees import (
    DEGREE_RULES, DETAIL_DEFAULTS, DETAIL_RULES, LEVEL_WORDS, PART_TIME_NAMES, PG_DEGREES,
)
from campusweave.rules.vocab import FEE_WORDS, YEAR_LABEL


def holds(name: str, tests: Mapping[str, Sequence[str]]) -> str | None:
    """SQL condition on a lower-case text; None if there are no tests."""
    parts = [f"contains({name}, {quoted(t)})" for t in tests.get("has", [])]
    parts += [f"startswith({name}, {quoted(t)})" for t in tests.get("starts", [])]
    if tests.get("eq"):
        parts.append(f"{name} IN ({', '.join(quoted(t) for t in tests['eq'])})")
    if tests.get("word"):
        words = "|".join(re.escape(w) for w in tests["word"])
        parts.append(rf"{name} RLIKE r'\b(?:{words})\b'")
    return "(" + " OR ".join(parts) + ")" if parts else None


def degree_tag(c: Column, rules: Sequence[tuple[str, Mapping]] = DEGREE_RULES) -> Column:
    """Canonical tag of the first rule that holds, else the text itself, trimmed."""
    cases = "".join(f" WHEN {holds('t.tag', tests)} THEN {quoted(name)}" for name, tests in rules)
    tag = F.struct(F.lower(clean(c)).alias("tag"), strip(c).alias("raw"))
    return let_sql(tag, "t", f"CASE WHEN t.tag = '' THEN ''{cases} ELSE t.raw END")


def details(degree: Column, name: Column) -> Column:
    """Struct of duration, level, exam and type that follow from degree and course name."""

    def outcome(duration: str, course_level: str, exam: str | None, kind: str) -> str:
        values = (duration, course_level, exam or DETAIL_DEFAULTS["entrance_exam"], kind)
        return "named_struct(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in zip(DETAIL_DEFAULTS, values)) + ")"

    full_time = DETAIL_DEFAULTS["course_type"]
    cases = ""
    for index, (degree_tests, name_tests, *result) in enumerate(DETAIL_RULES):
        condition = " OR ".join(x for x in (holds("d.degree", degree_tests), holds("d.name", name_tests)) if x)
        if index in PART_TIME_NAMES:
            part_time = holds("d.name", {"has": PART_TIME_NAMES[index]})
            cases += f" WHEN ({condition}) AND {part_time} THEN {outcome(*result, 'Part Time')}"
        cases += f" WHEN {condition} THEN {outcome(*result, full_time)}"
    lowered = F.struct(F.lower(degree).alias("degree"), F.lower(name).alias("name"))
    return let_sql(lowered, "d", f"CASE{cases} ELSE {outcome(*DETAIL_DEFAULTS.values())} END")


def level(level_text: Column, degree: Column) -> Column:
    """Course level from level text, else from the degree."""
    cases = "".join(f" WHEN {holds('t.level', {'has': words})} THEN {quoted(name)}" for name, words in LEVEL_WORDS)
    text = F.struct(F.lower(clean(level_text)).alias("level"), F.lower(degree).alias("degree"), level_of_degree(degree).alias("other"))
    return let_sql(text, "t", f"CASE WHEN contains(t.degree, 'ph.d') THEN 'Doctorate'{cases} ELSE t.other END")


def level_of_degree(degree: Column) -> Column:
    return F.when(degree.isin(*PG_DEGREES), F.lit("PG")).otherwise(F.lit("UG"))


def is_course(degree: Column, name: Column, words: Sequence[str] = FEE_WORDS) -> Column:
    """False for fee lines and bare year labels."""
    fee_line = r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"
    bad = F.lit(False)
    for part in (F.lower(degree), F.lower(name)):
        bad = bad | part.rlike(fee_line) | part.rlike(YEAR_LABEL)
    return ~bad
