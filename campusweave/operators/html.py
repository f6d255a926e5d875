"""Markup to a page-level tree, and questions asked of that tree.

``with_tree`` is the one Python step. It keeps a page's elements as an array in the page's
own row, so that everything asked of a page afterwards is a JVM expression over that row:
no shuffle, no self-join on (page, element), and no second parse.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusweave.functions import page_tree
from campusweave.functions.page_tree import PageTree
from campusweave.functions.text import WS, built_once, clean, contains_any, each, first_match, items, let, running, squeeze
from campusweave.rules.patterns import APP_STATE, JSON_LD
from campusweave.rules.vocab import NOISE_CLASS_PARTS, NOISE_TAGS

# the workers get these two by value: they need not find the package on their path
cloudpickle.register_pickle_by_value(page_tree)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREE_TYPE = (
    "nodes array<struct<pre:int,last:int,parent:int,depth:int,tag:string,cls:string,"
    "attrs:map<string,string>,t0:int,t1:int>>, "
    "texts array<string>, text_parents array<int>, parse_error string"
)
TREE_COLUMNS = ["nodes", "texts", "text_parents", "parse_error"]
# elements handed to the JVM at a time, so that a worker holds few trees however many pages a batch has, and its collector few objects
FLUSH_ELEMENTS = 10_000


def _tree_batch(kept: list[pa.Array], names: list[str], trees: list, errors: list) -> pa.RecordBatch:
    offsets, text_offsets = [0], [0]
    columns: dict[str, list] = {name: [] for name in ("pre", "last", "parent", "depth", "tag", "cls", "t0", "t1")}
    attr_offsets, attr_keys, attr_values = [0], [], []
    texts, parents = [], []
    for tree in trees:
        if tree is not None and tree.elements:
            parent, last, depth, tags, attributes, t0, t1 = zip(*tree.elements)
            found = (range(len(tags)), last, parent, depth, tags, [a.get("class") for a in attributes], t0, t1)
            for column, values in zip(columns.values(), found):
                column.extend(values)
            for attrs in attributes:
                attr_keys.extend(attrs)
                attr_values.extend(attrs.values())
                attr_offsets.append(len(attr_keys))
        if tree is not None:
            texts.extend(tree.texts)
            parents.extend(tree.text_parents)
        offsets.append(len(columns["pre"]))
        text_offsets.append(len(texts))
    int32, string = pa.int32(), pa.string()
    attrs_array = pa.MapArray.from_arrays(
        pa.array(attr_offsets, int32), pa.array(attr_keys, string), pa.array(attr_values, string)
    )
    arrays = {name: pa.array(values, string if name in ("tag", "cls") else int32) for name, values in columns.items()}
    fields = ["pre", "last", "parent", "depth", "tag", "cls", "attrs", "t0", "t1"]
    arrays = [attrs_array if name == "attrs" else arrays[name] for name in fields]
    nodes = pa.ListArray.from_arrays(pa.array(offsets, int32), pa.StructArray.from_arrays(arrays, fields))
    text_index = pa.array(text_offsets, int32)
    return pa.RecordBatch.from_arrays(
        [
            *kept,
            nodes,
            pa.ListArray.from_arrays(text_index, pa.array(texts, string)),
            pa.ListArray.from_arrays(text_index, pa.array(parents, int32)),
            pa.array(errors, string),
        ],
        names=[*names, "nodes", "texts", "text_parents", "parse_error"],
    )


def has_tree(pages: DataFrame) -> bool:
    return set(TREE_COLUMNS) <= set(pages.columns)


def narrowed(pages: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns, and the tree of pages that bring theirs along."""
    return pages.select(*columns, *(TREE_COLUMNS if has_tree(pages) else []))


def with_tree(pages: DataFrame, html: str = "html", keep_html: bool = False) -> DataFrame:
    """Page columns and the page tree. A page that cannot be read gets an empty tree and its error.

    The markup itself is not sent back from Python unless it is read again later on. Pages that bring
    a tree along (see ``sources.staging``) are not parsed again.
    """
    if has_tree(pages):
        return pages if keep_html else pages.drop(html)
    position = pages.columns.index(html)
    kept_fields = [i for i, name in enumerate(pages.columns) if keep_html or name != html]
    names = [pages.columns[i] for i in kept_fields]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, trees, errors = 0, 0, [], []
            for row, markup in enumerate(batch.column(position)):
                try:
                    tree, error = PageTree(markup.as_py() or ""), None
                except Exception as problem:  # one bad page must not stop the run
                    tree, error = None, f"{type(problem).__name__}: {problem}"
                trees.append(tree)
                errors.append(error)
                size += len(tree.elements) if tree else 0
                if size >= FLUSH_ELEMENTS or row == batch.num_rows - 1:
                    kept = [batch.column(i).slice(start, row + 1 - start) for i in kept_fields]
                    ready = _tree_batch(kept, names, trees, errors)
                    # the trees go before the batch is handed on, not when the next one is asked for
                    tree, start, size, trees, errors = None, row + 1, 0, [], []
                    yield ready

    tree_schema = T.StructType.fromDDL(TREE_TYPE)
    fields = [pages.schema.fields[i] for i in kept_fields]
    return pages.mapInArrow(parse, T.StructType([*fields, *tree_schema.fields]))


def html_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per element: page columns, then the element's place, tag, attributes and own text."""
    keep = [c for c in pages.columns if c != html]
    strings = F.arrays_zip(F.col("texts").alias("text"), F.col("text_parents").alias("parent"))

    def own_text(n: Column) -> Column:
        held = items(F.col("_strings"), n["t0"], n["t1"])
        return F.array_join(F.filter(held, lambda s: s["parent"] == n["pre"])["text"], "")

    tree = with_tree(pages, html).withColumn("_strings", strings).select(
        *keep, F.explode(F.transform("nodes", lambda n: n.withField("own_text", own_text(n)))).alias("n")
    )
    return tree.select(*keep, "n.*")


def readable_tree(pages: DataFrame, html: str = "html", keep_html: bool = False) -> DataFrame:
    """As with_tree, without the pages that could not be read: a job makes no row of them."""
    return with_tree(pages, html, keep_html).filter(F.col("parse_error").isNull())


def rejected_pages(trees: DataFrame) -> DataFrame:
    """Pages whose markup could not be read, with the reason."""
    return trees.filter(F.col("parse_error").isNotNull()).drop("nodes", "texts", "text_parents")


# -- expressions over one page's tree -----------------------------------------------------


def nodes_where(test: Callable[[Column], Column], within: Column | None = None) -> Column:
    return F.filter(F.col("nodes") if within is None else within, test)


def inside(n: Column) -> Column:
    """Descendants of an element, in document order."""
    return items(F.col("nodes"), n["pre"] + 1, n["last"] + 1)


def first(found: Column) -> Column:
    return F.get(found, 0)


def has_class(pattern: str) -> Callable[[Column], Column]:
    return lambda n: F.coalesce(n["cls"].rlike(pattern), F.lit(False))


def class_contains(part: str) -> Callable[[Column], Column]:
    return lambda n: F.coalesce(n["cls"].contains(part), F.lit(False))


def tagged(*tags: str) -> Callable[[Column], Column]:
    return lambda n: n["tag"].isin(*tags)


def tagged_class(tags: Sequence[str], pattern: str) -> Callable[[Column], Column]:
    return lambda n: n["tag"].isin(*tags) & F.coalesce(n["cls"].rlike(pattern), F.lit(False))


def _joined(texts: Column, t0: Column, t1: Column, glue: str) -> Column:
    return F.array_join(items(texts, t0, t1), glue)


def text_of(n: Column) -> Column:
    """All visible text of an element, as it stands."""
    return _joined(F.col("texts"), n["t0"], n["t1"], "")


def text_at(found: Column) -> Column:
    """Clean text of an element that may be missing: NULL then. Looks it up once."""
    return let(found, lambda n: squeeze(_joined(F.col("texts"), n["t0"], n["t1"], "")))


def spaced_text_of(n: Column) -> Column:
    """Visible strings of an element, one space between them, white space collapsed."""
    return clean(_joined(F.col("texts"), n["t0"], n["t1"], " "))


def page_text() -> Column:
    """All visible text of the page, as it stands."""
    return F.array_join(F.col("texts"), "")


def first_text(*tags: str) -> Column:
    """Clean text of the first element with one of the tags."""
    return F.coalesce(text_at(first(nodes_where(tagged(*tags)))), F.lit(""))


def is_noise(n: Column) -> Column:
    return n["tag"].isin(*NOISE_TAGS) | F.coalesce(contains_any(n["cls"], NOISE_CLASS_PARTS), F.lit(False))


@built_once
def _noise_reach() -> Column:
    ends = F.transform("nodes", lambda n: F.when(is_noise(n), n["last"]).otherwise(F.lit(-1)))
    return running(ends, F.greatest, F.lit(-1))


def with_noise(trees: DataFrame) -> DataFrame:
    """Add ``_reach``: per element, the last place that noise which has begun by then extends to.

    An element is inside dropped ones if they reach it; a string is if its parent is. One pass over the page.
    """
    return trees.withColumn("_reach", _noise_reach())


def outside_noise(place: Column) -> Column:
    """Whether the element at a place is outside every dropped element."""
    return (place < 0) | (F.get(F.col("_reach"), place) < place)


def kept_texts(n: Column) -> Column:
    """Strings of an element that no dropped element holds."""
    places = F.when(n["t1"] > n["t0"], F.sequence(n["t0"], n["t1"] - 1)).otherwise(F.array().cast("array<int>"))
    outside = F.filter(places, lambda i: outside_noise(F.get(F.col("text_parents"), i)))
    return F.transform(outside, lambda i: F.get(F.col("texts"), i))


@built_once
def _main_text() -> dict[str, Column]:
    page = F.struct(F.lit(0).alias("t0"), F.size("texts").alias("t1"))
    scope = F.struct(F.col("_body.t0").alias("t0"), F.col("_body.t1").alias("t1"))
    bodies = [first(F.filter(nodes_where(tagged(tag)), lambda n: outside_noise(n["pre"]))) for tag in ("main", "article")]
    return {
        "_body": F.coalesce(*bodies),
        "_scope": F.when(F.col("_body").isNotNull(), scope).otherwise(page),
        "": clean(F.array_join(kept_texts(F.col("_scope")), " ")),
    }


def with_main_text(trees: DataFrame, name: str = "main_text") -> DataFrame:
    """Text of <main>, else <article>, else the page, without its noise."""
    found = with_noise(trees)
    for column, value in _main_text().items():
        found = found.withColumn(column or name, value)
    return found.drop("_reach", "_body", "_scope")


def visible_text(pages: DataFrame, html: str = "html", name: str = "visible_text") -> DataFrame:
    """All text of the page without markup, scripts and styles, white space collapsed."""
    trees = with_tree(pages, html)
    return trees.withColumn(name, clean(page_text())).drop("nodes", "texts", "text_parents", "parse_error")


def main_text(pages: DataFrame, html: str = "html", name: str = "main_text") -> DataFrame:
    trees = with_main_text(with_tree(pages, html), name)
    return trees.drop("nodes", "texts", "text_parents", "parse_error")


# -- tables, headings, cards, sections ----------------------------------------------------


def table_structs(within: Column | None = None) -> Column:
    """Tables as structs: nearest earlier heading (lower-case) and rows of cell texts.

    Reads the column ``_heading_at`` that ``with_headings`` adds.
    """
    every = F.col("nodes")

    def row(tr: Column) -> Column:
        return F.transform(F.filter(inside(tr), tagged("td", "th")), text_of)

    def table(t: Column) -> Column:
        before = F.get(F.col("_heading_at"), t["pre"])
        title = let(F.get(F.col("nodes"), before), lambda h: F.lower(F.regexp_replace(text_of(h), f"^{WS}+|{WS}+$", "")))
        return F.struct(
            t["pre"].alias("pre"),
            F.coalesce(title, F.lit("")).alias("heading"),
            F.transform(F.filter(inside(t), tagged("tr")), row).alias("rows"),
        )

    return F.transform(F.filter(every if within is None else within, tagged("table")), table)


def with_headings(trees: DataFrame) -> DataFrame:
    """Add ``_heading_at``: per element, the place of the last heading up to it, -1 before the first. One pass over the page, if it has a table."""
    places = F.transform("nodes", lambda n: F.when(tagged("h1", "h2", "h3", "h4")(n), n["pre"]).otherwise(F.lit(-1)))
    return trees.withColumn("_heading_at", F.when(F.exists("nodes", tagged("table")), running(places, F.greatest, F.lit(-1))))


def html_tables(trees: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per table cell: page keys, table, row, column, heading and text."""
    return (
        each(with_headings(trees), keys, table_structs(), "t", "table_no")
        .select(*keys, "table_no", F.col("t.heading").alias("heading"), F.posexplode("t.rows").alias("row_no", "cells"))
        .select(*keys, "table_no", "heading", "row_no", F.posexplode("cells").alias("col_no", "text"))
        .withColumn("text", clean(F.col("text")))
    )


def html_cards(
    trees: DataFrame,
    keys: Sequence[str],
    card: Callable[[Column], Column],
    fields: dict[str, Callable[[Column], Column]],
) -> DataFrame:
    """One row per card; each field is the clean text of its first matching descendant."""

    def shape(c: Column) -> Column:
        return let(inside(c), lambda within: F.struct(
            c["pre"].alias("card_pre"),
            *[text_at(first(F.filter(within, test))).alias(name) for name, test in fields.items()],
        ))

    return each(trees, keys, F.transform(nodes_where(card), shape), "c", "card_no").select(*keys, "card_no", "c.*")


def with_sections(
    trees: DataFrame,
    heading: Callable[[Column], Column],
    content_tags: Sequence[str],
    fields: Sequence[tuple[str, Sequence[str], int]],
) -> DataFrame:
    """Add one column per field: the text under the last section heading that names it.

    ``fields`` are (column, phrases, longest text kept) in order of precedence: a heading
    belongs to the first field whose phrases it holds. Its text is that of the next content
    element in the document, '' if there is none. Headings are matched first and only the
    last one of a field is followed, so long pages cost no more than one walk per field.
    """
    titles = F.transform(
        nodes_where(heading), lambda n: F.struct(n["pre"].alias("pre"), F.lower(text_of(n)).alias("title"))
    )
    content = F.transform(nodes_where(tagged(*content_tags)), lambda n: n["pre"])
    found = trees.withColumns({"_titles": titles, "_content": content})
    columns, earlier = {}, []
    for name, phrases, limit in fields:
        columns[name] = _section_text(list(phrases), list(earlier), limit)
        earlier += phrases
    return found.withColumns(columns).drop("_titles", "_content")


def _section_text(phrases: list[str], earlier: list[str], limit: int) -> Column:
    last = F.try_element_at(
        F.filter("_titles", lambda s: contains_any(s["title"], phrases) & ~contains_any(s["title"], earlier)), F.lit(-1)
    )
    following = let(last, lambda s: F.get(F.col("nodes"), F.array_min(F.filter("_content", lambda pre: pre > s["pre"]))))
    return F.when(last.isNotNull(), F.substring(F.coalesce(text_at(following), F.lit("")), 1, limit))


# -- embedded data, read from the raw markup -----------------------------------------------


def json_ld_blocks(html: Column) -> Column:
    """All JSON-LD objects of a page, arrays flattened, unreadable blocks left out."""
    blocks = F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1))

    def items(block: Column) -> Column:
        return let(
            F.regexp_replace(block, f"^{WS}+", ""),
            lambda body: F.when(F.try_parse_json(body).isNull(), F.array().cast("array<string>"))
            .when(body.startswith("["), F.from_json(body, T.ArrayType(T.StringType())))
            .otherwise(F.array(body)),
        )

    return F.flatten(F.transform(blocks, items))


def json_ld(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    return pages.select(*keys, F.posexplode(json_ld_blocks(F.col(html))).alias("block_no", "json"))


def json_ld_of_type(html: Column, kind: str) -> Column:
    """First JSON-LD object of a page with the given type."""
    return first(F.filter(json_ld_blocks(html), lambda j: F.get_json_object(j, "$.@type") == kind))


def app_state(html: Column, path: str, schema: str) -> Column:
    """Value at a path of the page's embedded state, NULL where any step is missing."""
    steps = path.split(".")
    ddl = schema
    for step in reversed(steps):
        ddl = f"struct<`{step}`:{ddl}>"
    value = F.from_json(first_match(html, APP_STATE), ddl)
    for step in steps:
        value = value[step]
    return value


def page_metadata(trees: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Title, name taken from the title, and meta description."""
    title = first_text("title")
    meta = first(nodes_where(lambda n: (n["tag"] == "meta") & (F.try_element_at(n["attrs"], F.lit("name")) == "description")))
    return trees.select(
        *keys,
        title.alias("title"),
        title_name(title).alias("name"),
        clean(F.try_element_at(meta["attrs"], F.lit("content"))).alias("description"),
    )


def title_name(title: Column) -> Column:
    """What stands before 'Admission' and 'Courses' in a title."""
    return F.trim(F.get(F.split(F.get(F.split(title, "Admission"), F.lit(0)), "Courses"), F.lit(0)))
