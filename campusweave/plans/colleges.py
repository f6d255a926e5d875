"""Colleges: one row per info page."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions.text import blank_to_null, clean, first_match, items, keep_longest, strip
from campusweave.operators import html as H
from campusweave.operators.extract import college_type, contact_info, ownership, resolve_location
from campusweave.operators.relational import first_wins
from campusweave.rules import patterns as P
from campusweave.rules.vocab import AGENCY_TEXT_CHARS, PROFILE_PARTS
from campusweave.schemas import COLLEGES
from campusweave.site import DEFAULT_SITE, Site

SCHEMA_TYPE = "CollegeOrUniversity"


def join_listing(entities: DataFrame, listing: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    """Listing columns for (college_id, slug); a university address goes before a college one.

    One equi-join on the parsed address instead of a lookup per candidate address.
    """
    kind, ident, slug = (F.regexp_extract("url", PROFILE_PARTS, g) for g in (1, 2, 3))
    base = F.concat(F.lit(site.base_url + "/"), kind, F.lit("/"), ident, F.lit("-"), slug)
    known = (
        listing.filter((F.col("url") == base) & kind.isin("university", "college"))
        .withColumns({"_id": ident, "_slug": slug, "_later": kind != "university", "listing_url": F.col("url")})
        .drop("url")
    )
    known = first_wins(known, ["_id", "_slug"], ["_later"]).drop("_later")
    same = (entities["college_id"] == known["_id"]) & (entities["slug"] == known["_slug"])
    address = F.coalesce("listing_url", F.concat(F.lit(site.base_url + "/university/"), "college_id", F.lit("-"), "slug"))
    return entities.join(known, same, "left").withColumn("listing_url", address).withColumn("listed", F.col("_id").isNotNull()).drop("_id", "_slug")


def header_place() -> Column:
    """'City, State' of the first span that reads like one, unless the page has a location header."""
    header = H.nodes_where(H.tagged_class(["span"], P.HEADER_LOCATION_CLASS))

    def shown(n: Column) -> Column:
        strings = F.transform(items(F.col("texts"), n["t0"], n["t1"]), strip)
        return F.array_join(F.filter(strings, lambda s: s != ""), " ")

    fits = lambda s: s.rlike(P.CITY_STATE) & (F.length(s) < P.CITY_STATE_MAX) & ~F.get(F.split(s, ","), F.lit(0)).contains("India")
    spans = F.filter(F.transform(H.nodes_where(H.tagged("span")), shown), fits)
    return F.when(F.size(header) == 0, H.first(spans))


def build_colleges(
    pages: DataFrame, listing: DataFrame | None = None, keys: Sequence[str] = ("college_id", "slug"), site: Site = DEFAULT_SITE
) -> DataFrame:
    """College dataset of info pages; a listing rank goes before the rank on the page."""
    # the record is read from the markup before the tree is, so that the markup need not come back
    found = H.narrowed(pages, *keys, "html", H.json_ld_of_type(F.col("html"), SCHEMA_TYPE).alias("_ld"))
    facts = H.readable_tree(found).withColumns(
        {
            "_text": H.page_text(),
            "_title": H.first_text("title"),
            "_meta": H.first(H.nodes_where(lambda n: (n["tag"] == "meta") & (F.try_element_at(n["attrs"], F.lit("name")) == "description"))),
            "_span": header_place(),
        }
    )
    ld = lambda path: F.get_json_object("_ld", path)
    address = F.when(ld("$.address").startswith("{"), ld("$.address.streetAddress")).otherwise(ld("$.address"))
    text = F.col("_text")
    facts = facts.select(
        *keys,
        clean(F.coalesce(blank_to_null(ld("$.name")), H.title_name(F.col("_title")))).alias("name"),
        blank_to_null(ld("$.aggregateRating.ratingValue")).alias("rating"),
        address.alias("_address"),
        contact_info(address, ld("$.telephone"), ld("$.email")).alias("contact_info"),
        first_match(text, P.ESTABLISHED).cast("int").alias("established_year"),
        ownership(text).alias("ownership"),
        blank_to_null(keep_longest(clean(first_match(text, P.ACCREDITATION)), AGENCY_TEXT_CHARS)).alias("accreditation"),
        blank_to_null(keep_longest(clean(first_match(text, P.AFFILIATION)), AGENCY_TEXT_CHARS)).alias("affiliation"),
        clean(F.try_element_at(F.col("_meta.attrs"), F.lit("content"))).alias("overview_description"),
        F.concat(F.lit("Rank #"), first_match(text, "(?iU)" + re.escape(site.brand) + P.BRAND_RANK)).alias("ranking"),
        "_span",
        "_text",
    )
    city, state = resolve_location(F.col("_span"), blank_to_null(F.col("_address")), text)
    facts = facts.withColumns({"city": city, "state": state}).drop("_span", "_text", "_address")
    if listing is None:
        facts = facts.withColumn("listing_url", F.concat(F.lit(site.base_url + "/university/"), "college_id", F.lit("-"), "slug"))
    else:
        facts = join_listing(facts, listing, site).withColumn(
            "ranking", F.coalesce(F.concat(F.lit(site.rank_label + " "), blank_to_null(F.col("listing_rank"))), "ranking")
        )
    return facts.withColumns({"url": F.col("listing_url"), "college_type": college_type(F.col("listing_url"))}).select(*COLLEGES.fieldNames())
