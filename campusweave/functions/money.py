"""Column expressions that format amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from campusweave.functions.text import WS, blank_to_null, clean, let_sql

# A number written out, and an amount with a unit behind it.
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_UNIT_AMOUNT = r"(?i)^([0-9][0-9,\.]*?)\s*(Lakhs|Lakh|L|Crores|Crore|Cr|K)\b"


def parse_number(c: Column, commas: bool = False) -> Column:
    """Text to double, NULL unless all of it is a number (commas are dropped if allowed)."""
    bare = F.regexp_replace(F.replace(c, F.lit(","), F.lit("")) if commas else c, f"^{WS}+|{WS}+$", "")
    return let_sql(bare, "b", f"CASE WHEN b RLIKE r'{_NUMBER}' THEN try_cast(b AS DOUBLE) END")


def _drop_zeros(sql: str) -> str:
    return rf"regexp_replace(regexp_replace({sql}, r'(\.\d*?)0+$', '$1'), r'\.$', '')"


def _plain(sql: str) -> str:
    return f"replace({sql}, ',', '')"


def _significant(v: str) -> str:
    """SQL for six significant digits without trailing zeros."""
    places = "".join(f" WHEN {v} >= 1e{5 - d} THEN {d}" for d in range(7))
    fixed = _drop_zeros(_plain(f"format_number({v}, CASE{places} ELSE 7 END)"))
    exponent = f"cast(floor(log10({v})) AS INT)"
    mantissa = _drop_zeros(f"format_number({v} / pow(10.0D, {exponent}), 5)")
    return f"CASE WHEN {v} = 0 THEN '0' WHEN {v} >= 999999.5 THEN concat({mantissa}, 'e+', lpad(cast({exponent} AS STRING), 2, '0')) ELSE {fixed} END"


def significant(value: Column) -> Column:
    """Shortest text with six significant digits, as '%g' writes it for positive values."""
    return let_sql(value, "v", _significant("v"))


def fees(amount: Column, formatted: Column | None = None) -> Column:
    """Display text of a fee; NULL if there is neither amount nor ready-made text."""
    text = clean(amount)
    parts = F.struct(
        (blank_to_null(formatted) if formatted is not None else F.lit(None).cast("string")).alias("ready"),
        F.coalesce(amount, F.lit("")).alias("amount"),
        parse_number(amount, commas=True).alias("number"),
        text.alias("text"),
    )
    worded = f"""CASE
        WHEN u.units IS NULL THEN u.text
        WHEN u.unit IN ('l', 'lakh', 'lakhs') THEN concat({_significant('u.units')}, ' Lakhs')
        WHEN u.unit IN ('cr', 'crore', 'crores') THEN concat({_significant('u.units')}, ' Crores')
        WHEN u.unit = 'k' THEN concat({_significant('u.units')}, ' Thousand')
        ELSE u.text END"""
    unit_parts = f"""named_struct('text', p.text, 'unit', lower(regexp_extract(p.text, r'{_UNIT_AMOUNT}', 2)),
        'units', try_cast(replace(regexp_extract(p.text, r'{_UNIT_AMOUNT}', 1), ',', '') AS DOUBLE))"""
    squeezed = f"trim(regexp_replace(p.ready, r'{WS}+', ' '))"
    body = f"""CASE
        WHEN p.ready IS NOT NULL THEN {squeezed}
        WHEN p.amount = '' THEN NULL
        WHEN p.number >= 100000 THEN concat({_significant('(p.number / 100000)')}, ' Lakhs')
        WHEN p.number = floor(p.number) THEN format_number(p.number, 0)
        WHEN p.number IS NOT NULL THEN {_drop_zeros('format_number(p.number, 2)')}
        ELSE transform(array({unit_parts}), u -> {worded})[0] END"""
    return let_sql(parts, "p", body)


def package(value: Column) -> Column:
    """Yearly pay: crores from ten million, lakhs per annum from a hundred thousand; NULL if not above 0."""
    number = parse_number(value)
    parts = F.struct(blank_to_null(value).alias("text"), number.cast("bigint").alias("n"))
    body = f"""CASE
        WHEN p.n IS NULL THEN p.text
        WHEN p.n <= 0 THEN NULL
        WHEN p.n >= 10000000 AND p.n % 10000000 = 0 THEN concat(p.n div 10000000, ' Crore')
        WHEN p.n >= 10000000 THEN concat({_plain('format_number(p.n / 10000000, 2)')}, ' Cr')
        WHEN p.n >= 100000 AND p.n % 100000 = 0 THEN concat(p.n div 100000, ' LPA')
        WHEN p.n >= 100000 THEN concat({_plain('format_number(p.n / 100000, 2)')}, ' LPA')
        ELSE cast(p.n AS STRING) END"""
    return let_sql(parts, "p", body)


def indian_digits(value: Column, numeric: bool = False) -> Column:
    """1234567 to '12,34,567'; '' for zero and for what is not a number.

    ``numeric`` says that the column holds numbers and not text.
    """
    whole = (value if numeric else parse_number(value.cast("string"))).cast("bigint")
    grouped = F.regexp_replace(whole.cast("string"), r"(\d)(?=(\d\d)+\d$)", "$1,")
    return F.when(whole != 0, grouped).otherwise(F.lit(""))


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)
