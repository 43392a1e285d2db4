"""Vector arithmetic as Columns."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def normalised(vector: Column) -> Column:
    """The vector at length one; null for a vector of zeros, which has no direction."""
    length = F.nullif(norm(vector), F.lit(0.0))
    return F.when(length.isNotNull(), F.transform(vector, lambda x: x.cast("double") / length))


def cosine_distance(left: Column, right: Column) -> Column:
    """Between two vector columns, without leaving the JVM; null if one has no direction."""
    return 1 - dot(left, right) / F.nullif(norm(left) * norm(right), F.lit(0.0))


def distance_to(query: Sequence[float], vector: Column) -> Column:
    """Cosine distance of each vector to one query, a matrix product per Arrow batch.

    Faster by far than interpreting array lambdas element by element; only the vector column
    goes to Python. Rounded to 12 decimals, so that equal vectors tie whatever batch they share.
    """
    target = np.asarray(query, dtype=np.float64)

    @F.arrow_udf("double")
    def distances(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            vectors, present = matrix(batch, len(target))
            yield pa.array(cosine_distances(vectors, target[None, :])[:, 0], mask=~present)

    found = distances(vector)
    return F.when(F.isnan(found), F.lit(None)).otherwise(found)


def matrix(batch: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """A list array as a matrix, and which rows are present. Missing rows become zeros."""
    present = np.asarray(batch.is_valid())
    lengths = batch.value_lengths().drop_null().to_numpy(zero_copy_only=False)
    if (lengths != dimension).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} numbers, not {dimension}")
    rows = np.zeros((len(batch), dimension))
    rows[present] = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return rows, present


def cosine_distances(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """All distances, vectors by queries; not a number where one side has no direction."""
    lengths = np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.round(1 - (vectors @ queries.T) / np.where(lengths > 0, lengths, np.nan), 12)
