"""Nearest chunks by cosine distance: exact, everywhere or within one tender."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.functions.vectors import distance_to
from bidscope.operators.filters import in_range, same_model, tender_key
from bidscope.schemas import IDENTITY

# Default numbers of hits.
SEARCH_LIMIT = 10
RETRIEVE_LIMIT = 5

CHUNK_KEY = ["dce_file_id", "chunk_index"]


def nearest_first(distance: str = "distance") -> list[Column]:
    """Ties have no order of their own; file and position decide."""
    return [F.col(distance).asc_nulls_last(), *[F.col(name) for name in CHUNK_KEY]]


def nearest(chunks: DataFrame, query: Sequence[float], model: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """The nearest chunks embedded with the same model. Every task keeps ``limit`` rows."""
    in_range("limit", limit, 1)
    columns = [*CHUNK_KEY, "text", "page_numbers", "heading_path"]
    return (
        chunks.filter(same_model(model))
        .select(*columns, distance_to(query, F.col("embedding")).alias("distance"))
        .orderBy(*nearest_first())
        .limit(limit)
    )


def search(
    chunks: DataFrame,
    dce_files: DataFrame,
    tenders: DataFrame,
    query: Sequence[float],
    model: str,
    limit: int = SEARCH_LIMIT,
    tender: tuple[str, str] | None = None,
) -> DataFrame:
    """Search hits with their citations, nearest first; of one tender when it is given.

    The scope is applied before any distance is computed, so a scoped search is exact.
    """
    if tender is not None:
        chunks = in_tender(chunks, dce_files, tender_key(tenders, *tender))
    return cite(nearest(chunks, query, model, limit), dce_files, tenders).orderBy(*nearest_first())


def in_tender(chunks: DataFrame, dce_files: DataFrame, key: int) -> DataFrame:
    """Chunks of one tender, by their own ``tender_record_id`` if they carry one."""
    if "tender_record_id" in chunks.columns:
        return chunks.filter(F.col("tender_record_id") == key)
    owned = dce_files.filter(F.col("tender_record_id") == key)
    return chunks.join(owned.select(F.col("id").alias("dce_file_id")), "dce_file_id", "left_semi")


def cite(hits: DataFrame, dce_files: DataFrame, tenders: DataFrame) -> DataFrame:
    """Look up file and tender of the hits: the limit comes first, the joins after.

    Nothing is broadcast by hint, since a hit's text has no bound: adaptive execution measures the
    hits and decides.
    """
    files = dce_files.select(
        F.col("id").alias("dce_file_id"), "tender_record_id", F.col("path").alias("dce_file_path")
    )
    owners = tenders.select(F.col("id").alias("tender_record_id"), *IDENTITY)
    located = files.join(hits, "dce_file_id")
    return owners.join(located, "tender_record_id").drop("tender_record_id")


def with_rank(hits: DataFrame) -> DataFrame:
    """Number hits from 1. Hits are a top-k report, so one window task is enough."""
    return hits.withColumn("rank", F.row_number().over(W.orderBy(*nearest_first())))


def with_similarity(hits: DataFrame) -> DataFrame:
    return hits.withColumn("similarity", 1 - F.col("distance"))


def hit_text() -> Column:
    """A ranked hit as the text people read."""
    pages = F.array_join(F.col("page_numbers").cast("array<string>"), ", ")
    headings = F.array_join("heading_path", " > ")
    # The layout of a hit.
    dash = F.lit("-")
    return F.format_string(
        "#%d  similarity %.3f\nTender:   %s (%s)\nFile:     %s\nPages:    %s\nHeadings: %s\n\n%s\n",
        F.col("rank"),
        1 - F.col("distance"),
        *[F.col(name) for name in IDENTITY],
        F.col("dce_file_path"),
        F.when(pages == "", dash).otherwise(pages),
        F.when(headings == "", dash).otherwise(headings),
        F.col("text"),
    )
