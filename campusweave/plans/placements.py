"""Placements: one row per placement page, each value by a cascade of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions import money
from campusweave.functions.text import blank_to_null, built_once, clean, first_match, vocabulary_hits
from campusweave.operators import html as H
from campusweave.operators.extract import block_between, sanitize_recruiters
from campusweave.rules import patterns as P
from campusweave.rules.vocab import RECRUITERS
from campusweave.schemas import PLACEMENTS
from campusweave.site import DEFAULT_SITE, Site

STATE_PATH = "props.initialProps.pageProps.data.placements"
VALUES = ["highest_package", "average_package", "median_package", "top_recruiters"]


def state_packages(html: Column) -> dict[str, Column]:
    """Overall packages of the embedded state; a broken first figure voids the second."""
    data = H.app_state(html, STATE_PATH, "struct<highest_salary:string,average_salary:string>")
    high, average = blank_to_null(data["highest_salary"]), blank_to_null(data["average_salary"])
    number = money.parse_number(high)
    readable = high.isNull() | number.isNotNull()
    return {
        "highest_package": F.when(number.isNotNull(), money.package(high)),
        "average_package": F.when(readable & money.parse_number(average).isNotNull(), money.package(average)),
    }


def block_values(html: Column) -> dict[str, Column]:
    """Values of the encoded highlights block in the page source."""
    block = block_between(html, P.HIGHLIGHTS_START, P.HIGHLIGHTS_ENDS)
    values = {}
    for name, pattern in P.HIGHLIGHTS_FIELDS.items():
        value = F.when(block.rlike(pattern), clean(F.regexp_extract(block, pattern, 1)))
        if name == "top_recruiters":
            value = F.replace(F.replace(value, F.lit("\\u0026amp;"), F.lit("&")), F.lit("&amp;"), F.lit("&"))
        if name == "highest_package":
            value = F.regexp_replace(F.regexp_replace(value, r"(?iU)\s+per\s+annum$", ""), "crore|Crore", "Cr")
        values[name] = value
    return values


def summary_values(html: Column) -> dict[str, Column]:
    """Values of the summary text in the page source."""
    values = {}
    for name, patterns in P.PACKAGE_SUMMARY.items():
        found = [blank_to_null(clean(F.regexp_extract(html, p, 1))) for p in patterns]
        value = F.coalesce(*found)
        values[name] = F.replace(value, F.lit("&amp;"), F.lit("&")) if name == "top_recruiters" else value
    return values


@built_once
def table_pairs() -> Column:
    """First and last cell text of every table row outside the page's noise."""

    def outside(n: Column) -> Column:
        return H.outside_noise(n["pre"])

    def text(cell: Column) -> Column:
        return clean(F.array_join(H.kept_texts(cell), " "))

    def cells(tr: Column) -> Column:
        return F.filter(H.inside(tr), lambda n: n["tag"].isin("td", "th") & outside(n))

    rows = F.filter(
        F.transform(H.nodes_where(lambda n: (n["tag"] == "tr") & outside(n)), cells), lambda found: F.size(found) >= 2
    )
    return F.transform(
        rows,
        lambda found: F.struct(text(F.get(found, 0)).alias("label"), text(F.try_element_at(found, F.lit(-1))).alias("value")),
    )


def with_table_pairs(trees: DataFrame) -> DataFrame:
    return H.with_noise(trees).withColumn("_pairs", table_pairs()).drop("_reach")


def table_values() -> dict[str, Column]:
    """Values of table rows by the label in their first cell."""

    def labelled(pattern: str) -> Column:
        return H.first(F.filter(F.col("_pairs"), lambda p: p["label"].rlike(pattern)))["value"]

    return {name: labelled(pattern) for name, pattern in P.PACKAGE_TABLE_LABELS.items()}


def labelled_values(text: Column) -> dict[str, Column]:
    """Values that follow a label in running text."""
    return {name: F.trim(first_match(text, "(?iU)" + label + P.LABELLED_PACKAGE)) for name, label in P.PACKAGE_LABELS.items()}


@built_once
def placement_values() -> dict[str, Column]:
    """Values of a placement page by source: embedded state, else block, summary, table rows and labels in text."""
    html, text = F.col("html"), F.col("main_text")
    overall = F.col("_state_highest_package").isNotNull() | F.col("_state_average_package").isNotNull()
    block, summary, table, label = block_values(html), summary_values(html), table_values(), labelled_values(text)

    def cascade(name: str, last: Column) -> Column:
        return F.coalesce(F.when(~overall, block[name]), summary[name], table[name], last)

    return {
        "highest_package": F.coalesce("_state_highest_package", cascade("highest_package", label["highest_package"])),
        "average_package": F.coalesce("_state_average_package", cascade("average_package", label["average_package"])),
        "median_package": cascade("median_package", label["median_package"]),
        "placement_percentage": first_match(text, P.PLACEMENT_PERCENTAGE),
        "top_recruiters": sanitize_recruiters(cascade("top_recruiters", vocabulary_hits(text, RECRUITERS))),
    }


@built_once
def state_columns() -> dict[str, Column]:
    return {f"_state_{n}": c for n, c in state_packages(F.col("html")).items()}


def build_placements(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """Placement dataset of placement pages; NULL where no source has a value."""
    trees = with_table_pairs(H.with_main_text(H.readable_tree(H.narrowed(pages, *keys, "html"), keep_html=True)))
    trees = trees.select(*keys, "html", "main_text", "_pairs", *[c.alias(n) for n, c in state_columns().items()])
    return trees.select(*keys, *[c.alias(n) for n, c in placement_values().items()])


def fill_from_listing(placements: DataFrame, listing: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    """Missing average, highest and percentage from the listing row of the college, if it has one."""
    from campusweave.plans.colleges import join_listing

    joined = join_listing(placements, listing, site)
    fill = {
        "average_package": "listing_avg_package",
        "highest_package": "listing_highest_package",
        "placement_percentage": "listing_placement_percentage",
    }
    return joined.withColumns(
        {c: F.coalesce(blank_to_null(F.col(c)), blank_to_null(F.trim(l))) for c, l in fill.items()}
    ).select(*placements.columns)
