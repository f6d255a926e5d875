"""Addresses to visit, what came of visiting them, and what listing pages say."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusweave.functions.money import indian_digits, is_numeric, parse_number
from campusweave.functions.text import blank_to_null, clean, each, first_match, first_of, items, let, running, strip
from campusweave.operators.html import (
    first, inside, nodes_where, spaced_text_of, tagged_class,
)
from campusweave.operators.relational import MERGED, first_wins, top_n
from campusweave.rules import patterns as P
from campusweave.rules import vocab as V
from campusweave.schemas import LISTING_COLUMNS
from campusweave.site import DEFAULT_SITE, Site


CARD, LOOSE = 0, 1


# -- addresses ------------------------------------------------------------------------------


def clean_url(c: Column, base: str) -> Column:
    """Absolute address without query and fragment; '' for NULL."""
    absolute = F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(F.lit(base), c)).otherwise(c)
    return F.coalesce(strip(F.regexp_replace(absolute, r"(?s)[?#].*$", "")), F.lit(""))


def clean_urls(df: DataFrame, column: str = "url", base: str = DEFAULT_SITE.base_url) -> DataFrame:
    return df.withColumn(column, clean_url(F.col(column), base))


def is_profile_url(c: Column, profile: str = V.PROFILE_URL, subpage: str = V.SUBPAGE_URL) -> Column:
    return c.rlike(profile) & ~c.rlike(subpage)


def filter_profile_urls(df: DataFrame, column: str = "url", profile: str = V.PROFILE_URL, subpage: str = V.SUBPAGE_URL) -> DataFrame:
    """Keep addresses of profiles; drop those of their subpages."""
    return df.filter(is_profile_url(F.col(column), profile, subpage))


def parse_profile_urls(df: DataFrame, column: str = "url", site: Site = DEFAULT_SITE) -> DataFrame:
    """Add type, id, slug and base_url; NULL where the address is not a profile's."""
    kind, ident, slug = (first_match(F.col(column), V.PROFILE_PARTS, g) for g in (1, 2, 3))
    return df.withColumns(
        {
            "type": kind,
            "id": ident,
            "slug": slug,
            "base_url": F.concat(F.lit(site.base_url + "/"), kind, F.lit("/"), ident, F.lit("-"), slug),
        }
    )


def _page_types(mapping: Mapping[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("page_type"), F.lit(v).alias("suffix")) for k, v in mapping.items()])


def page_type_of_url(df: DataFrame, url: str = "url", ident: str = "id", mapping: Mapping[str, str] = V.PAGE_SUFFIXES) -> DataFrame:
    """One row per page type an address can stand for, given the id it must hold."""
    lowered = F.lower(F.col(url))
    others = F.lit(False)
    for kind, suffix in mapping.items():
        if kind != "info" and suffix:
            others = others | lowered.contains(suffix.lower())
    fits = (
        F.col(url).contains(F.col(ident))
        & lowered.contains(F.lower("_t.suffix"))
        & ((F.col("_t.page_type") != "info") | ~others)
    )
    return df.withColumn("_t", F.explode(_page_types(mapping))).filter(fits).withColumn("page_type", F.col("_t.page_type")).drop("_t")


def expand_frontier(df: DataFrame, base: str = "base_url", mapping: Mapping[str, str] = V.PAGE_SUFFIXES) -> DataFrame:
    """Every profile address times its subpages; the nine come from a literal, not a join."""
    return (
        df.withColumn("_t", F.explode(_page_types(mapping)))
        .withColumns({"page_type": F.col("_t.page_type"), "page_url": F.concat(F.col(base), F.col("_t.suffix"))})
        .drop("_t")
    )


def entity_slug(url: Column, name: Column) -> Column:
    """Slug from the address, else from the name."""
    ascii_name = F.lower(F.trim(F.regexp_replace(name, r"[^a-zA-Z0-9\s\-]", "")))
    return F.coalesce(first_match(url, V.PROFILE_PARTS, 3), F.regexp_replace(ascii_name, r"[\s\-]+", "-"))


# -- pending work -----------------------------------------------------------------------------


def attempted_ids(saved: DataFrame, skipped: DataFrame, ident: str = "id") -> DataFrame:
    """Ids that have a saved page or are on the skip list."""
    return saved.select(ident).union(skipped.select(ident)).distinct()


def pending_urls(
    listing: DataFrame, attempted: DataFrame, limit: int = 0, ident: str = "id", order: str = "ordinal", merged: int = MERGED
) -> DataFrame:
    """Listing rows that have an id and no attempt yet, in listing order; the first ``limit`` if above 0, a batch of any size (see ``top_n``)."""
    pending = listing.filter(F.col(ident).isNotNull()).join(attempted.select(ident), ident, "left_anti")
    return (top_n(pending, [order], limit, merged=merged) if limit > 0 else pending).orderBy(order)


def flag_block_pages(pages: DataFrame, html: str = "html", markers: Sequence[str] = V.BLOCK_MARKERS, least: int = V.BLOCK_MIN_CHARS) -> DataFrame:
    """Add ``blocked``: too short, or carrying the marks of an error page."""
    lowered = F.lower(F.col(html))
    marked = F.lit(False)
    for marker in markers:
        marked = marked | lowered.contains(marker)
    return pages.withColumn("blocked", (F.length(html) < least) | marked)


def classify_fetches(fetches: DataFrame, status: str = "status", page_type: str = "page_type") -> DataFrame:
    """Add outcome, log level and whether the page stays pending."""
    code, gone = F.col(status), F.col(status).isin(404, 410)
    outcome = (
        F.when(code < 400, "ok")
        .when(gone & (F.col(page_type) == "info"), "removed")
        .when(gone, "absent")
        .otherwise("blocked")
    )
    return fetches.withColumn("outcome", F.when(code.isNull(), "ok").otherwise(outcome)).withColumns(
        {
            "log_level": F.when(F.col("outcome") == "removed", "WARNING").when(F.col("outcome") == "blocked", "ERROR").otherwise("INFO"),
            "pending": F.col("outcome") == "blocked",
        }
    )


def skip_list(fetches: DataFrame, ident: str = "id", saved: str = "saved") -> DataFrame:
    """Ids of which not one page was saved."""
    return fetches.groupBy(ident).agg(F.bool_or(F.col(saved)).alias("_any")).filter(~F.col("_any")).select(ident)


# -- listing pages ----------------------------------------------------------------------------


def _with_cards(trees: DataFrame, base: str) -> DataFrame:
    """Add ``_found_cards``: cards whose first link leads to a profile."""
    rows = nodes_where(tagged_class(["tr"], P.LISTING_ROW_CLASS))
    blocks = nodes_where(tagged_class(["div", "li", "article"], P.LISTING_CARD_CLASS))

    def shape(card: Column, i: Column) -> Column:
        link = first(F.filter(inside(card), _is_link))
        strings = items(F.col("texts"), card["t0"], card["t1"])
        return F.struct(
            i.alias("card_no"),
            let(F.try_element_at(link["attrs"], F.lit("href")), lambda href: clean_url(href, base)).alias("url"),
            spaced_text_of(card).alias("card_text"),
            F.filter(F.transform(strings, strip), lambda s: s != "").alias("strings"),
        )

    cards = F.when(F.size("_rows") > 0, F.col("_rows")).otherwise(blocks)
    found = F.filter(F.transform("_cards", shape), lambda c: is_profile_url(c["url"]))
    return trees.withColumn("_rows", rows).withColumn("_cards", cards).withColumn("_found_cards", found).drop("_rows", "_cards")


def listing_cards(trees: DataFrame, keys: Sequence[str], base: str = DEFAULT_SITE.base_url) -> DataFrame:
    """One row per card that leads to a profile: position, address, text and strings."""
    return each(_with_cards(trees, base), keys, F.col("_found_cards"), "c").select(*keys, "c.*")


def _is_link(n: Column) -> Column:
    return (n["tag"] == "a") & F.try_element_at(n["attrs"], F.lit("href")).isNotNull()


def listing_metrics(text: Column) -> dict[str, Column]:
    """Packages and placement share named in a card; the first pattern that matches wins."""
    flat = clean(text)
    return {name: F.coalesce(F.trim(first_of(flat, ps)), F.lit("")) for name, ps in P.LISTING_METRICS.items()}


def _plain_number(c: Column) -> Column:
    return c.cast("int").cast("string")


def listing_rank(text: Column, strings: Column) -> Column:
    """Rank named in words, else a leading '#N', else the first string that starts with one."""
    in_words = first_match(text, P.EXPLICIT_RANK)
    leading = _plain_number(first_match(text, P.LEADING_RANK))
    own = _plain_number(first_match(first(F.filter(strings, lambda s: s.rlike(P.LEADING_RANK))), P.LEADING_RANK))
    return F.coalesce(F.concat(F.lit("#"), F.coalesce(in_words, leading, own)), F.lit(""))


def _with_loose_ranks(trees: DataFrame, base: str) -> DataFrame:
    """Add ``_loose_ranks``: '#N' strings with the first profile link of the nearest of five enclosing elements.

    Links are counted along the page once; the first one inside an element is then the one numbered by the
    count up to the element's start, and no string looks at any other link.
    """
    profile = lambda n: F.when(_is_link(n), let(clean_url(n["attrs"]["href"], base), lambda url: F.when(is_profile_url(url), url)))
    urls = F.transform("nodes", lambda n: F.struct(n["pre"].alias("pre"), profile(n).alias("url")))
    tokens = F.filter(
        F.transform(
            F.arrays_zip(F.col("texts").alias("text"), F.col("text_parents").alias("parent")),
            lambda s, i: F.struct(i.alias("text_no"), first_match(s["text"], P.ANY_RANK).alias("rank"), s["parent"].alias("parent")),
        ),
        lambda t: t["rank"].isNotNull(),
    )
    nodes = F.col("nodes")

    def nearest(token: Column) -> Column:
        scope, tries = token["parent"], []
        for _ in range(V.RANK_SCOPE_LEVELS):
            # -1 is the page itself, above its outermost elements
            last = F.when(scope == -1, F.size(nodes)).otherwise(F.get(nodes, scope)["last"])
            tries.append(_first_link(scope, last))
            scope = F.get(nodes, scope)["parent"]
        return F.coalesce(*tries)

    def _first_link(scope: Column, last: Column) -> Column:
        number = F.when(scope == -1, F.lit(0)).otherwise(F.get(F.col("_upto"), scope))
        return let(F.get(F.col("_links"), number), lambda link: F.when(link["pre"] <= last, link["url"]))

    found = F.transform(
        F.col("_tokens"),
        lambda t: F.struct(t["text_no"].alias("text_no"), F.concat(F.lit("#"), t["rank"]).alias("rank"), nearest(t).alias("url")),
    )
    upto = running(F.transform("_urls", lambda u: u["url"].isNotNull().cast("int")), lambda a, b: a + b, F.lit(0))
    return (
        trees.withColumns({"_urls": urls, "_tokens": tokens})
        .withColumns({"_links": F.filter("_urls", lambda u: u["url"].isNotNull()), "_upto": F.when(F.size("_tokens") > 0, upto)})
        .withColumn("_loose_ranks", F.filter(found, lambda f: f["url"].isNotNull()))
        .drop("_links", "_tokens", "_upto", "_urls")
    )


def associate_ranks(trees: DataFrame, keys: Sequence[str], base: str = DEFAULT_SITE.base_url) -> DataFrame:
    """One row per '#N' string and the profile it stands next to."""
    return each(_with_loose_ranks(trees, base), keys, F.col("_loose_ranks"), "f").select(*keys, "f.*")


def first_seen(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return first_wins(df, [key], order)


def listing_from_pages(trees: DataFrame, page_no: str = "page_no", base: str = DEFAULT_SITE.base_url) -> DataFrame:
    """Listing table of a run of listing pages, in discovery order.

    An address counts where it is first seen, in a card or next to a loose rank; its card
    gives the metrics, and the first loose rank fills an empty one.
    """
    both = _with_loose_ranks(_with_cards(trees, base), base)
    cards = F.transform(
        "_found_cards",
        lambda c: F.struct(F.lit(CARD).alias("kind"), c["card_no"].alias("pos"), c["url"].alias("url"), c["card_text"].alias("text"), c["strings"].alias("strings"), F.lit(None).cast("string").alias("rank")),
    )
    loose = F.transform(
        "_loose_ranks",
        lambda r: F.struct(F.lit(LOOSE).alias("kind"), r["text_no"].alias("pos"), r["url"].alias("url"), F.lit("").alias("text"), F.array().cast("array<string>").alias("strings"), r["rank"].alias("rank")),
    )
    rows = each(both, [F.col(page_no).cast("bigint").alias("page")], F.concat(cards, loose), "x").select("page", "x.*")
    event = F.struct(
        "page", "kind", "pos",
        *[m.alias(n) for n, m in listing_metrics(F.col("text")).items()],
        F.coalesce("rank", blank_to_null(listing_rank(F.col("text"), F.col("strings")))).alias("listing_rank"),
    )
    seen = rows.select("url", event.alias("event")).groupBy("url").agg(
        F.min("event").alias("e"), F.min(F.when(F.col("event.kind") == LOOSE, F.col("event"))).alias("r")
    )
    return seen.select(
        F.struct("e.page", "e.kind", "e.pos").alias("ordinal"),
        "url",
        *[F.col(f"e.{n}").alias(n) for n in P.LISTING_METRICS],
        F.coalesce("e.listing_rank", "r.listing_rank", F.lit("")).alias("listing_rank"),
    )


def grow_frontier(existing: DataFrame, found: DataFrame, cap: int | None = None, order: str = "ordinal", merged: int = MERGED) -> DataFrame:
    """Existing addresses first, then new ones, each once; the first ``cap`` if given, however many these are."""
    both = existing.withColumn("batch", F.lit(0)).unionByName(found.withColumn("batch", F.lit(1)), allowMissingColumns=True)
    unique = first_wins(both, ["url"], ["batch", order])
    return top_n(unique, ["batch", order], cap, merged=merged) if cap else unique


def listing_novelty(found: DataFrame, pages: DataFrame | None = None, page_no: str = "page_no", url: str = "url", streak: int = V.STAGNANT_PAGES) -> DataFrame:
    """New addresses per listing page, and whether that page ends a streak without any.

    ``pages`` has the number of every listing page, those that list nothing too; without it only pages
    with addresses are known. Pages are numbered without gaps, so a page's streak is the sum over the pages that each
    earlier page is passed on to; no window over all pages is needed.
    """
    gained = found.groupBy(url).agg(F.min(page_no).alias(page_no)).groupBy(page_no).agg(F.count(F.lit(1)).alias("gained"))
    numbers = found.select(page_no) if pages is None else pages.select(page_no)
    pages = numbers.distinct().join(gained, page_no, "left").select(page_no, F.coalesce("gained", F.lit(0)).alias("gained"))
    passed = pages.select(
        F.explode(F.array(*[F.struct((F.col(page_no) + i).alias("to"), F.lit(i).alias("step")) for i in range(streak)])).alias("p"),
        "gained",
    )
    return (
        passed.groupBy(F.col("p.to").alias(page_no))
        .agg(
            F.sum(F.when(F.col("p.step") == 0, F.col("gained"))).alias("gained"),
            F.sum("gained").alias("_sum"),
            F.count(F.lit(1)).alias("_pages"),
        )
        .filter(F.col("gained").isNotNull())
        .withColumn("stop", (F.col("_pages") == streak) & (F.col("_sum") == 0))
        .select(page_no, "gained", "stop")
    )


def import_listing(
    df: DataFrame, url: str, average: str, highest: str, rank: str, site: Site = DEFAULT_SITE
) -> DataFrame:
    """External listing table to listing columns; rows without an address are dropped."""
    address = F.trim(F.col(url).cast("string"))
    place = (F.col(rank) if is_numeric(df, rank) else parse_number(F.col(rank).cast("string"))).cast("int")
    return df.filter((F.coalesce(address, F.lit("")) != "") & (F.lower(address) != "nan")).select(
        F.when(address.rlike("^https?://"), address)
        .when(address.startswith("/"), F.concat(F.lit(site.base_url), address))
        .otherwise(F.concat(F.lit(site.base_url + "/"), address))
        .alias("url"),
        F.coalesce(indian_digits(F.col(average), is_numeric(df, average)), F.lit("")).alias("listing_avg_package"),
        F.coalesce(indian_digits(F.col(highest), is_numeric(df, highest)), F.lit("")).alias("listing_highest_package"),
        F.lit("").alias("listing_placement_percentage"),
        F.when(place > 0, F.concat(F.lit("#"), place.cast("string"))).otherwise(F.lit("")).alias("listing_rank"),
    ).select(*LISTING_COLUMNS)
