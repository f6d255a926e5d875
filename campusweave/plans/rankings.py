"""Rankings: embedded state of info and placement pages, else their text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from campusweave.functions.text import WS, blank_to_null, built_once, clean, each, let
from campusweave.operators import html as H
from campusweave.operators.relational import first_wins, without_known
from campusweave.rules import patterns as P
from campusweave.rules import vocab as V
from campusweave.site import DEFAULT_SITE, Site

STATE_PATH = "props.initialProps.pageProps.data.basic_info"
RANK_ITEM = "agency string, agency_name string, ranking_agency string, rank string, year string, stream string"
KEY = ["college_id", "ranking_body", "ranking_year"]
ENTRY = "struct<pos:int,ranking_body:string,rank:string,ranking_year:int>"
ENTRIES = f"array<{ENTRY}>"
MARK, STATE, TEXT = range(3)


def canonical_agency(agency: Column, site: Site = DEFAULT_SITE) -> Column:
    """Agency under its usual name."""
    text = clean(agency)
    lowered = F.lower(text)
    return F.when(lowered.isin(*site.names()), F.lit(site.brand)).when(lowered.isin("india today", "indiatoday"), F.lit("India Today")).otherwise(text)


def ranking_label(agency: Column, rank: Column, stream: Column, site: Site = DEFAULT_SITE) -> tuple[Column, Column]:
    """Body and rank as shown: the site's own ranking carries its stream and its label."""
    own = agency == site.brand
    body = F.when(own & (stream != ""), F.concat(agency, F.lit(" ("), stream, F.lit(")"))).otherwise(agency)
    shown = F.when(own, F.concat(F.lit(site.rank_label + " #"), rank.cast("string"))).otherwise(F.concat(F.lit("#"), rank.cast("string")))
    return body, shown


def valid_rank(text: Column, most: int = V.RANK_MAX) -> Column:
    """Whole number from 1 to ``most``, else NULL."""
    bare = F.regexp_replace(text, f"^{WS}+|{WS}+$", "")
    number = F.when(bare.rlike(r"^[+-]?\d+$"), bare.try_cast("bigint"))
    return F.when((number > 0) & (number <= most), number.cast("int"))


def valid_year(text: Column) -> Column:
    bare = F.regexp_replace(text, f"^{WS}+|{WS}+$", "")
    return F.when(bare.rlike(r"^\d+$"), bare.try_cast("int"))


def _state_items(html: Column) -> Column:
    items = H.app_state(html, STATE_PATH, "struct<ranking:array<string>>")["ranking"]
    return F.transform(items, lambda i: F.from_json(i, RANK_ITEM))


def _agency_of(r: Column) -> Column:
    return F.coalesce(blank_to_null(r["agency"]), blank_to_null(r["agency_name"]), blank_to_null(r["ranking_agency"]))


@built_once
def state_rankings(html: str, site: Site = DEFAULT_SITE) -> Column:
    """Usable ranking entries of a page's embedded state: array of (pos, ranking_body, rank, ranking_year)."""

    def read(r: Column, i: Column) -> Column:
        return F.struct(
            i.alias("pos"), canonical_agency(_agency_of(r), site).alias("agency"), _agency_of(r).isNotNull().alias("named"),
            valid_rank(r["rank"]).alias("rank"), valid_year(r["year"]).alias("year"), clean(r["stream"]).alias("stream"),
        )

    def shown(r: Column) -> Column:
        body, rank = ranking_label(r["agency"], r["rank"], r["stream"], site)
        return F.struct(r["pos"].alias("pos"), body.alias("ranking_body"), rank.alias("rank"), r["year"].alias("ranking_year"))

    usable = F.filter(F.transform(_state_items(F.col(html)), read), lambda r: r["named"] & r["rank"].isNotNull())
    return F.coalesce(F.transform(usable, shown), F.array().cast(ENTRIES))


@built_once
def text_rankings(text: str, site: Site = DEFAULT_SITE) -> Column:
    """First ranking per body in a text column, in the same form."""
    every = bodies(site)

    def found(told: Column) -> Column:
        return F.array(*[
            F.struct(F.lit(i).alias("pos"), F.lit(body).alias("ranking_body"), ranking_in_mentions(told, aliases).alias("hit"))
            for i, (body, aliases) in enumerate(every)
        ])

    def shown(f: Column) -> Column:
        prefix = F.when(f["ranking_body"] == site.brand, F.lit(site.rank_label + " #")).otherwise(F.lit("#"))
        return F.struct(
            f["pos"].alias("pos"), f["ranking_body"].alias("ranking_body"), F.concat(prefix, f["hit"]["rank"]).alias("rank"),
            f["hit"]["year"].alias("ranking_year"),
        )

    told = mentions(F.col(text), [alias for _, aliases in every for alias in aliases])
    return let(told, lambda m: F.when(F.size(m) > 0, F.transform(F.filter(found(m), lambda f: f["hit"].isNotNull()), shown)).otherwise(F.array().cast(ENTRIES)))


def mentions(text: Column, aliases: Sequence[str]) -> Column:
    """Stretches of a text that name a body, in order: all that the rank patterns can see, found in one search.

    A rank and the body it belongs to have no full stop between them; past one, a pattern only looks for the year, in the next
    digits. A stretch so runs from one full stop to the next, and those digits are put behind it.
    """
    names = "|".join(re.escape(a) for a in sorted(aliases, key=len, reverse=True))
    if any("." in a for a in aliases):  # the stops then do not part the text
        return F.when(text.rlike(f"(?iU){names}"), F.array(text)).otherwise(F.array().cast("array<string>"))
    pattern = F.lit(rf"(?iU)(?<![^.])([^.]*(?:{names})[^.]*)(?=\D*(\d{{0,4}}))")
    return F.when(text.rlike(f"(?iU){names}"), F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2)), lambda stretch, digits: F.concat_ws(". ", stretch, digits)
    )).otherwise(F.array().cast("array<string>"))


def ranking_in_mentions(told: Column, aliases: Sequence[str]) -> Column:
    """(rank, year) of the first alias that is ranked at most 5,000, else NULL; of an alias the first pattern that matches anywhere counts."""

    def read(named: Column, pattern: str) -> Column:
        # the groups are read from the short match
        groups = lambda m: F.struct(F.regexp_extract(m, pattern, 1).alias("rank"), F.regexp_extract(m, pattern, 2).alias("year"))
        hits = F.filter(F.transform(named, lambda t: F.regexp_extract(t, pattern, 0)), lambda m: m != "")
        return let(F.get(hits, 0), lambda m: F.when(m.isNotNull(), groups(m)))

    def usable(hit: Column) -> Column:
        year = hit["year"].try_cast("int")
        found = F.struct(hit["rank"].alias("rank"), F.when(year.between(*V.RANK_YEARS), year).alias("year"))
        return F.when(hit["rank"].try_cast("int") <= V.TEXT_RANK_MAX, found)

    def ranked(alias: str) -> Column:
        patterns = [p.replace("<alias>", re.escape(alias)) for p in P.RANK_PATTERNS]
        named = F.filter(told, lambda t: F.lower(t).contains(alias.lower()))
        return let(named, lambda n: F.when(F.size(n) > 0, let(F.coalesce(*(read(n, p) for p in patterns)), usable)))

    return F.coalesce(*map(ranked, aliases))


def rankings_from_state(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug"), site: Site = DEFAULT_SITE) -> DataFrame:
    """Ranking rows of the embedded state; info pages go before placement pages."""
    rows = pages.select(
        *keys, F.when(F.col("page_type") == "info", 0).otherwise(1).alias("source"), F.explode(state_rankings("html", site)).alias("r")
    ).select(*keys, "source", "r.*")
    return first_wins(rows, [*keys, "ranking_body", "rank", "ranking_year"], ["source", "pos"])


def bodies(site: Site = DEFAULT_SITE) -> list[tuple[str, list[str]]]:
    known = list(P.RANKING_BODIES)
    return [*known[:2], (site.brand, [site.brand]), *known[2:]]


def rankings_from_text(texts: DataFrame, keys: Sequence[str] = ("college_id", "slug"), site: Site = DEFAULT_SITE, text: str = "main_text") -> DataFrame:
    """First ranking per body in page text; placement pages go before info pages."""
    rows = texts.select(
        *keys, F.when(F.col("page_type") == "placements", 0).otherwise(1).alias("source"), F.explode(text_rankings(text, site)).alias("r")
    ).select(*keys, "source", "r.*")
    return first_wins(rows, [*keys, "ranking_body"], ["source"])


def build_rankings(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug"), site: Site = DEFAULT_SITE) -> DataFrame:
    """Ranking rows of colleges that have a placement page: embedded ones, else those in text."""
    return settled(ranking_entries(pages, keys, site), keys)


def ranking_entries(pages: DataFrame, keys: Sequence[str] = ("college_id", "slug"), site: Site = DEFAULT_SITE) -> DataFrame:
    """What each page says of rankings: a few short rows a page, whatever other pages a college has.

    One pass over the pages. Markup is parsed only for pages without usable rankings of their own.
    """
    read = H.narrowed(
        pages.filter(F.col("page_type").isin("info", "placements")),
        *keys, "page_type", "html", state_rankings("html", site).alias("_state"),
    )
    read = read.withColumn("html", F.when(F.size("_state") == 0, F.col("html")))
    trees = H.with_main_text(H.readable_tree(read))

    def entries(kind: int, source: Column, found: Column) -> Column:
        return F.transform(found, lambda r: F.struct(F.lit(kind).alias("kind"), source.alias("source"), r.alias("r")))

    placed = F.col("page_type") == "placements"
    mark = F.when(placed, F.array(F.lit(None).cast(ENTRY))).otherwise(F.array().cast(ENTRIES))
    text = F.when(F.size("_state") == 0, text_rankings("main_text", site)).otherwise(F.array().cast(ENTRIES))
    every = F.concat(
        entries(MARK, F.lit(0), mark),
        entries(STATE, placed.cast("int"), F.col("_state")),
        entries(TEXT, (~placed).cast("int"), text),
    )
    return each(trees, keys, every, "e").select(*keys, "e.kind", "e.source", "e.r.*")


def settled(rows: DataFrame, keys: Sequence[str] = ("college_id", "slug")) -> DataFrame:
    """A college's choice between the two kinds, made on all its distinct entries.

    The window holds one college's distinct entries, which are bounded by the ranking bodies and years.
    """
    exact = lambda c: F.when(F.col("kind") == STATE, F.col(c))
    rows = first_wins(rows, [*keys, "kind", "ranking_body", exact("rank"), exact("ranking_year")], ["source", "pos"])
    college = W.partitionBy(*keys)
    best = rows.withColumns({
        "_placed": F.min("kind").over(college) == MARK,
        "_state": F.max(F.col("kind") == STATE).over(college),
    })
    return best.filter(
        F.col("_placed") & (F.col("kind") != MARK) & ((F.col("kind") == STATE) | ~F.col("_state"))
    ).select(*keys, "source", "pos", "ranking_body", "rank", "ranking_year")


def dedup_rankings(existing: DataFrame, new: DataFrame, order: Sequence[str] = ("slug", "source", "pos")) -> DataFrame:
    """New rows whose (college, body, year) is not there yet; the first of each. NULL years match."""
    fresh = without_known(new, existing, KEY, nulls_match=True)
    return first_wins(fresh, KEY, [c for c in order if c in new.columns])
