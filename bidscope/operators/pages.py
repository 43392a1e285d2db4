"""Saved pages to typed rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError
from bidscope.functions.dates import DAY, parse_deadline, parse_publication_date
from bidscope.functions.html import (
    clean_text,
    first,
    has_token,
    html_nodes,
    inside,
    joined_text,
    strings,
    subtree,
)
from bidscope.functions.text import clean, strip
from bidscope.schemas import TENDER_FIELDS

# How the platform marks its fields, as ends of element ids and input names.
REFERENCE_CELL = "cons_ref"
TENDER_INPUT, ORGANIZATION_INPUT = "refCons", "orgCons"
PROCEDURE, CATEGORY = "type_procedure", "panelBlocCategorie"
OBJECT, BUYER, LOCATION = "panelBlocObjet", "panelBlocDenomination", "panelBlocLieuxExec"
REFERENCE_CLASS, DEADLINE_CLASS = "ref", "cloture-line"
CURRENT_PAGE, TOTAL_PAGES, TOTAL_RESULTS = "numPageTop", "nombrePageTop", "nombreElement"
# What is stripped around a value once its label is gone.
LABEL_EDGES = r"^[ :\x{a0}]+|[ :\x{a0}]+$"


COUNTERS = ["current_page", "total_pages", "total_results"]


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per tender of each page: its place ``row_no``, the ten fields and the page counters.

    A page without tenders keeps one row without ``row_no``; an empty page has an ``error``. The
    other columns of ``pages`` are kept, the HTML is not. Nothing is shuffled.

    The steps are columns of their own, since Spark computes a shared column once but repeats
    what is nested inside a lambda.
    """
    others = [name for name in pages.columns if name != html]
    empty = F.col(html).isNull() | (F.col(html) == "")
    nodes, row, marked = F.col("nodes"), F.col("row"), F.col("marked")
    cells = F.filter(marked, lambda n: (n["tag"] == "td") & has_token(n["headers"], REFERENCE_CELL))
    table_rows = F.transform(
        F.filter(cells, lambda cell: cell["row"] >= 0),
        lambda cell: subtree(nodes, F.get(nodes, cell["row"])),
    )
    data_rows = F.filter(table_rows, lambda run: ~F.exists(run, lambda n: n["tag"] == "th"))
    exploded = (
        pages.select(
            *others, F.when(empty, "empty page").alias("error"), html_nodes(F.col(html)).alias("nodes")
        )
        .withColumn("marked", _marked(nodes))
        .select(
            *others,
            "error",
            _counter(_by_id(marked, CURRENT_PAGE)["value"]).alias("current_page"),
            _counter(clean_text(nodes, _by_id(marked, TOTAL_PAGES))).alias("total_pages"),
            _counter(clean_text(nodes, _by_id(marked, TOTAL_RESULTS))).alias("total_results"),
            data_rows.alias("rows"),
        )
        .select(*others, "error", *COUNTERS, F.posexplode_outer("rows").alias("row_no", "row"))
        .withColumn("marked", _marked(F.slice(row, 2, F.size(row))))
    )
    found = {
        "cell": first(marked, lambda n: (n["tag"] == "td") & has_token(n["headers"], REFERENCE_CELL)),
        "reference": first(
            marked, lambda n: (n["tag"] == "span") & has_token(n["class"], REFERENCE_CLASS)
        ),
        "closes": first(marked, lambda n: (n["tag"] == "div") & has_token(n["class"], DEADLINE_CLASS)),
        "object": _by_id(marked, OBJECT),
        "buyer": _by_id(marked, BUYER),
        "place": _by_id(marked, LOCATION),
    }
    cell, within = F.col("cell"), F.col("within")
    dates = F.filter(
        F.transform(
            F.filter(within, lambda n: (n["tag"] == "div") & (n["parent"] == cell["at"])),
            lambda div: joined_text(row, div),
        ),
        lambda text: text.rlike(DAY),
    )
    texts = {
        "object_text": clean_text(row, F.col("object")),
        "object_label": _label(row, F.col("object")),
        "buyer_text": clean_text(row, F.col("buyer")),
        "buyer_label": _label(row, F.col("buyer")),
        "published": F.get(dates, F.lit(0)),
        "closing": F.array_join(strings(inside(row, F.col("closes"))), " "),
    }
    fields = {
        "tender_id": _input(marked, TENDER_INPUT),
        "organization_acronym": _input(marked, ORGANIZATION_INPUT),
        "procurement_type": _text_at(within, PROCEDURE),
        "category": _text_at(within, CATEGORY),
        "publication_date": parse_publication_date(F.col("published")),
        "reference_number": clean_text(row, F.col("reference")),
        "tender_object": _unlabelled(F.col("object_text"), F.col("object_label")),
        "public_buyer": _unlabelled(F.col("buyer_text"), F.col("buyer_label")),
        "location": _location(row, F.col("place")),
        "deadline": parse_deadline(F.col("closing")),
    }
    return (
        exploded.withColumns(found)
        .withColumn("within", inside(row, cell))
        .withColumns(texts)
        .select(
            *others,
            "error",
            *COUNTERS,
            "row_no",
            *[fields[name].alias(name) for name in TENDER_FIELDS.fieldNames()],
        )
    )


def _marked(nodes: Column) -> Column:
    """The nodes that fields are found by, so that most are looked at once rather than for every field."""
    return F.filter(nodes, lambda n: F.coalesce(n["id"], n["headers"], n["class"], n["name"]).isNotNull())


def _by_id(nodes: Column, end: str) -> Column:
    return first(nodes, lambda n: n["id"].endswith(end))


def _text_at(nodes: Column, id_end: str) -> Column:
    return clean_text(nodes, _by_id(nodes, id_end))


def _input(nodes: Column, name_end: str) -> Column:
    found = first(nodes, lambda n: (n["tag"] == "input") & n["name"].endswith(name_end))
    return F.nullif(found["value"], F.lit(""))


def _label(nodes: Column, block: Column) -> Column:
    return clean_text(nodes, first(inside(nodes, block), lambda n: n["tag"] == "strong"))


def _unlabelled(full: Column, label: Column) -> Column:
    """Text of a block without the first occurrence of its bold label."""
    before = F.call_function("substring_index", full, label, F.lit(1))
    after = F.substring(full, F.length(before) + F.length(label) + 1, F.length(full))
    # A label that is not in the text leaves all of it before, and nothing after.
    bare = F.regexp_replace(F.concat(before, after), LABEL_EDGES, "")
    return F.nullif(F.when(label.isNull(), full).otherwise(bare), F.lit(""))


def _location(nodes: Column, block: Column) -> Column:
    """The block's first own text; a second one, in a tooltip, only repeats it."""
    own = F.filter(
        inside(nodes, block),
        lambda n: (n["parent"] == block["at"]) & n["tag"].isin("#text", "#comment") & (strip(n["text"]) != ""),
    )
    return F.coalesce(clean(F.get(own, F.lit(0))["text"]), clean_text(nodes, block))


def _counter(text: Column) -> Column:
    return strip(text).try_cast("int")


def strict_pages(parsed: DataFrame) -> DataFrame:
    """The parsed pages, or an error if any of them was empty."""
    if not parsed.filter(F.col("error").isNotNull()).isEmpty():
        raise InvalidRowsError("some pages are empty")
    return parsed


def page_tenders(parsed: DataFrame, page: str = "page_id") -> DataFrame:
    """The tenders of all pages, each with its page and its row on the page."""
    return parsed.filter(F.col("row_no").isNotNull()).select(
        page, "row_no", *TENDER_FIELDS.fieldNames()
    )


def page_counters(parsed: DataFrame) -> DataFrame:
    """One row per page: its counters, or its error."""
    kept = [c for c in parsed.columns if c not in ("row_no", *TENDER_FIELDS.fieldNames())]
    return parsed.filter(F.coalesce("row_no", F.lit(0)) == 0).select(*kept)


def page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, first heading, paragraphs and links of any page."""
    others = [name for name in pages.columns if name != html]
    nodes = F.col("nodes")

    def texts(tag: str) -> Column:
        found = F.filter(nodes, lambda n: n["tag"] == tag)
        return F.filter(F.transform(found, lambda n: joined_text(nodes, n)), lambda text: text != "")

    links = F.filter(nodes, lambda n: (n["tag"] == "a") & n["href"].isNotNull())
    return pages.select(*others, html_nodes(F.col(html)).alias("nodes")).select(
        *others,
        clean_text(nodes, first(nodes, lambda n: n["tag"] == "title")).alias("title"),
        clean_text(nodes, first(nodes, lambda n: n["tag"] == "h1")).alias("h1"),
        texts("p").alias("paragraphs"),
        F.transform(links, lambda n: n["href"]).alias("links"),
    )
