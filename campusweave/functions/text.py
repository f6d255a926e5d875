"""Column expressions over text. NULL means "no value" throughout."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space spelled out: Java's \s knows ASCII only.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def built_once(build: Callable) -> Callable:
    """Keep long expressions for the life of their Spark application: building them takes seconds.

    They must follow from the arguments alone (names of columns and the like), which tell them apart.
    """
    kept: dict[tuple, object] = {}

    @wraps(build)
    def expression(*args):
        key = (SparkContext.getOrCreate().applicationId, *args)
        if key not in kept:
            kept[key] = build(*args)
        return kept[key]

    return expression


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_sql(value: Column, name: str, body: str) -> Column:
    """``let`` with the body given as SQL text: long rule chains are one parse, not many calls."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(0))


def items(array: Column, start: Column, end: Column) -> Column:
    """Elements start..end-1 of an array, by position.

    ``slice`` walks the whole array every time; many short ranges of a long array need this.
    """
    places = F.when(end > start, F.sequence(start, end - 1)).when(end <= start, F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.get(array, i))


def quoted(text: str) -> str:
    """SQL literal of a plain text without backslashes."""
    return "'" + text.replace("'", "''") + "'"


def squeeze(c: Column) -> Column:
    """White space runs (no-break spaces included) to one space; ends trimmed; NULL stays."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def clean(c: Column) -> Column:
    """``squeeze`` with NULL turned into ''."""
    return F.coalesce(squeeze(c), F.lit(""))


def strip(c: Column) -> Column:
    """Trim white space of any kind at both ends, keeping what is inside."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group's text at the first match, NULL where there is none."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def first_of(c: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """First pattern that matches wins."""
    return F.coalesce(*[first_match(c, p, group) for p in patterns])


def contains_any(c: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | c.contains(word)
    return found


def vocabulary_hits(c: Column, terms: Sequence[str]) -> Column:
    """Terms found anywhere in the text, case ignored, in vocabulary order; NULL if none."""
    lowered = F.lower(c)
    hits = [F.when(lowered.contains(t.lower()), F.lit(t)) for t in terms]
    return blank_to_null(F.concat_ws(", ", *hits))


def without_trailing_parens(c: Column) -> Column:
    """'MBA (Finance)' to 'MBA'; kept as it is if nothing would be left."""
    cut = strip(F.regexp_replace(c, rf"{WS}*\([^)]*\){WS}*$", ""))
    return F.coalesce(blank_to_null(cut), c, F.lit(""))


def name_and_specialization(c: Column, fallback: Column | None = None) -> tuple[Column, Column]:
    """Split 'MBA (Finance)' into name and specialization.

    Without brackets the specialization is the fallback, or 'General'.
    """
    raw = clean(c)
    inner = first_match(raw, rf"\(([^)]+)\){WS}*$")
    outer = strip(F.regexp_replace(raw, rf"{WS}*\([^)]*\){WS}*$", ""))
    spare = F.lit("General") if fallback is None else F.coalesce(blank_to_null(fallback), F.lit("General"))
    name = F.when(inner.isNotNull(), outer).otherwise(raw)
    specialization = (
        F.when(raw == "", F.lit("")).when(inner.isNotNull(), F.trim(inner)).otherwise(spare)
    )
    return name, specialization


def keep_longest(c: Column, limit: int) -> Column:
    return F.substring(c, 1, limit)


def lacks_money(c: Column) -> Column:
    """Whether a cell reads like a condition and not like an amount."""
    from campusweave.rules.vocab import MONEY_CELL

    return ~c.rlike(MONEY_CELL)


def without_currency(c: Column) -> Column:
    """Drop a leading rupee sign and any 'INR '."""
    return F.trim(F.replace(F.regexp_replace(c, "^₹", ""), F.lit("INR "), F.lit("")))


def each(df: DataFrame, keys: Sequence, found: Column, name: str, number: str | None = None) -> DataFrame:
    """Keys and one row per (non-NULL) item of an array that is dear to make, with its number.

    Below a plain explode Spark puts a filter for empty arrays, which makes the whole array once more, all steps in one
    expression. It puts none below an outer one.
    """
    item = F.explode_outer(found).alias(name) if number is None else F.posexplode_outer(found).alias(number, name)
    return df.select(*keys, item).filter(F.col(name).isNotNull())


def running(values: Column, op: Callable[[Column, Column], Column], start: Column) -> Column:
    """What ``op`` makes of all values of an array up to each one; ``start`` is neutral to it.

    The array goes in blocks of about the root of its length: adding to an array copies it, so one
    pass over all values would cost the square of their number.
    """

    def along(array: Column) -> Column:
        return F.aggregate(array, F.array(start), lambda done, x: F.concat(done, F.array(op(F.element_at(done, -1), x))))

    def blocks_of(v: Column, width: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(v)), width)
        return F.transform(starts, lambda i: F.slice(v, i, width))

    def whole(blocks: Column) -> Column:
        inner = F.transform(blocks, lambda b: F.slice(along(b), F.lit(2), F.size(b)))
        before = along(F.transform(blocks, lambda b: F.aggregate(b, start, lambda x, y: op(x, y))))
        return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(blocks)), lambda b, base: F.transform(b, lambda x: op(base, x))))

    def cut(v: Column) -> Column:
        return let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int")), lambda width: blocks_of(v, width))

    return let(let(values, cut), whole)
