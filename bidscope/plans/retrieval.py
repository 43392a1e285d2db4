"""A text query to search hits."""

from pyspark.sql import DataFrame

from bidscope.operators.embedding import Embedder, check_dimension
from bidscope.operators.filters import in_range
from bidscope.operators.search import RETRIEVE_LIMIT, search


def embed_query(embedder: Embedder, query: str) -> list[float]:
    """One text needs no job; the model runs where the query is asked."""
    if not query or not query.strip():
        raise ValueError("query must not be blank")
    embedder.load()
    return [float(x) for x in embedder.embed([query])[0]]


def retrieve(
    chunks: DataFrame,
    dce_files: DataFrame,
    tenders: DataFrame,
    query: str,
    embedder: Embedder,
    top_k: int = RETRIEVE_LIMIT,
    tender_id: str | None = None,
    organization: str | None = None,
    dimension: int | None = None,
) -> DataFrame:
    """The nearest chunks to a text, in one tender when both parts of its identity are given.

    With a ``dimension``, a model whose vectors have another size is an error.
    """
    if dimension is not None:
        check_dimension(embedder, dimension)
    in_range("top_k", top_k, 1)
    if (tender_id is None) != (organization is None):
        raise ValueError("a tender needs both its id and its organization")
    tender = None if tender_id is None else (tender_id, organization)
    vector = embed_query(embedder, query)
    return search(chunks, dce_files, tenders, vector, embedder.model_name, top_k, tender)
