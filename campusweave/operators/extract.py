"""Field extraction from text columns by rule packs passed in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions.text import (
    WS, blank_to_null, clean, contains_any, first_match, first_of, let, running, strip, vocabulary_hits,
)
from campusweave.rules import vocab as V


def label_values(df: DataFrame, column: str, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column per field; its first pattern that matches gives the value."""
    return df.withColumns({name: first_of(F.col(column), patterns) for name, patterns in rules.items()})


def match_vocabulary(df: DataFrame, column: str, terms: Sequence[str], name: str = "hits") -> DataFrame:
    return df.withColumn(name, vocabulary_hits(F.col(column), terms))


def match_windows(c: Column, pattern: str, before: int, after: int) -> Column:
    """All matches of a text with what surrounds them: array of (match, window).

    Offsets come from the text pieces between the matches, so the whole text is searched.
    """
    def window(hit: Column) -> Column:
        low = F.greatest(hit["start"] - before, F.lit(0))
        return F.struct(hit["match"].alias("match"), F.substring(c, low + 1, hit["end"] + after - low).alias("window"))

    def windows(matches: Column) -> Column:
        gaps = F.slice(F.split(c, pattern, -1), F.lit(1), F.size(matches))
        ends = running(F.zip_with(gaps, matches, lambda g, m: F.length(g) + F.length(m)), lambda a, b: a + b, F.lit(0))
        hits = F.zip_with(matches, ends, lambda m, end: F.struct(m.alias("match"), (end - F.length(m)).alias("start"), end.alias("end")))
        return F.transform(hits, window)

    return let(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), windows)


def context_matches(df: DataFrame, column: str, pattern: str, before: int, after: int, fields: Mapping[str, str], last: Sequence[str] = ()) -> DataFrame:
    """One row per match; each field is the first (or, for ``last``, the last) hit in its window."""
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.posexplode(match_windows(F.col(column), pattern, before, after)).alias("match_no", "m"))

    def value(name: str, p: str) -> Column:
        if name in last:
            return F.try_element_at(F.regexp_extract_all(F.col("m.window"), F.lit(p), F.lit(1)), F.lit(-1))
        return first_match(F.col("m.window"), p)

    return rows.select(*keep, "match_no", F.col("m.match").alias("match"), *[value(n, p).alias(n) for n, p in fields.items()])


def lines_with(c: Column, words: Sequence[str], shorter_than: int) -> Column:
    """Lines that hold one of the words (case matters), cleaned, if short enough once cleaned."""
    kept = F.filter(F.split(c, "\n", -1), lambda line: contains_any(line, words))
    return F.filter(F.transform(kept, clean), lambda line: F.length(line) < shorter_than)


def capped_lines(df: DataFrame, column: str, words: Sequence[str], shorter_than: int = V.FACULTY_LINE_CHARS, n: int = V.FACULTY_LINES) -> DataFrame:
    """First n matching lines of every text; the cap is the feature."""
    keep = [c for c in df.columns if c != column]
    found = F.slice(lines_with(F.col(column), words, shorter_than), 1, n)
    return df.select(*keep, F.posexplode(found).alias("line_no", "line"))


def block_between(c: Column, start: str, ends: Sequence[str]) -> Column:
    """Text between a start phrase and the first of the end phrases, NULL if there is none."""
    return F.when(
        c.rlike(f"(?isU){start}.*?(?:{'|'.join(ends)})"),
        F.regexp_extract(c, f"(?isU){start}(.*?)(?:{'|'.join(ends)})", 1),
    )


def sanitize_recruiters(c: Column) -> Column:
    """NULL for what is page source and not a list of names."""
    return let(clean(c), _plain_names)


def _plain_names(text: Column) -> Column:
    lowered = F.lower(text)
    noisy = contains_any(lowered, [t.lower() for t in V.RECRUITER_NOISE]) | contains_any(text, V.RECRUITER_MARKUP)
    return F.when(~noisy & (F.length(text) <= V.RECRUITER_MAX_CHARS), blank_to_null(text))


def exam_names(exams_json: Column) -> Column:
    """Exam list given as JSON list, object or plain text: unique names in order, NULL if none."""
    return let(F.coalesce(exams_json, F.lit("")), _exam_names)


def _exam_names(text: Column) -> Column:
    def name(item: Column) -> Column:
        return clean(F.when(item.startswith("{"), F.get_json_object(item, "$.name")).otherwise(item))

    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))
    names = F.array_distinct(F.filter(F.transform(items, name), lambda x: x != ""))
    return blank_to_null(F.array_join(names, ", "))


def resolve_location(span: Column, address: Column, text: Column) -> tuple[Column, Column]:
    """City and state: from a 'City, State' text, else the end of the address, else a phrase."""
    from campusweave.rules.patterns import LOCATED_IN

    span_parts = F.split(span, ",")
    tail = strip(F.regexp_replace(address, rf"(?i){WS}*India{WS}*$", ""))
    parts = F.filter(F.transform(F.split(tail, ","), strip), lambda p: p != "")
    n = F.size(parts)
    from_span = F.when(blank_to_null(strip(F.get(span_parts, F.lit(0)))).isNotNull(), F.struct(strip(F.get(span_parts, F.lit(0))).alias("city"), strip(F.get(span_parts, F.lit(1))).alias("state")))
    from_address = (
        F.when((n >= 2), F.struct(F.try_element_at(parts, F.lit(-2)).alias("city"), F.try_element_at(parts, F.lit(-1)).alias("state")))
        .when(n == 1, F.struct(F.get(parts, F.lit(0)).alias("city"), F.lit("").alias("state")))
    )
    from_text = F.struct(first_match(text, LOCATED_IN, 1).alias("city"), first_match(text, LOCATED_IN, 2).alias("state"))
    place = F.coalesce(from_span, from_address, from_text)

    def tidy(c: Column) -> Column:
        return blank_to_null(strip(F.replace(clean(c), F.lit("India"), F.lit(""))))

    return tidy(place["city"]), tidy(place["state"])


def ownership(text: Column) -> Column:
    """Public words are looked for first, anywhere in the text; '' if nothing is said."""
    from campusweave.rules.patterns import PRIVATE, PUBLIC

    return F.when(text.rlike(PUBLIC), "Public").when(text.rlike(PRIVATE), "Private").otherwise("")


def college_type(url: Column) -> Column:
    lowered = F.lower(url)
    return F.when(lowered.contains("university"), "University").when(lowered.contains("college"), "College").otherwise("Institute")


def contact_info(address: Column, tel: Column, email: Column) -> Column:
    """Present parts joined by ' | '; NULL if there is none."""

    def part(label: str, c: Column) -> Column:
        return F.when(blank_to_null(c).isNotNull(), F.concat(F.lit(label), c))

    return blank_to_null(F.concat_ws(" | ", part("Address: ", address), part("Tel: ", tel), part("Email: ", email)))
