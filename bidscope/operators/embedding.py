"""Embedding texts with a pluggable model."""

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError

# Default vector size, and texts per call of a model.
DIMENSION = 1024
BATCH_SIZE = 16
# What separates words.
WORD_BREAK = r"[ \t\n\r]+"


class Embedder(Protocol):
    """A model. It is pickled to the tasks; heavy state belongs into ``load``."""

    model_name: str
    dimension: int

    def load(self) -> None:
        """Called once per task, before the first text."""

    def embed(self, texts: list[str]) -> np.ndarray:
        """One row of ``dimension`` numbers per text, in the same order."""


def text_words(text: str) -> list[str]:
    return [word for word in re.split(WORD_BREAK, text) if word]


class HashEmbedder:
    """Word counts hashed into a fixed number of buckets, at unit length. Needs no model files."""

    def __init__(self, dimension: int = DIMENSION) -> None:
        self.dimension = dimension
        self.model_name = f"word-hash-{dimension}"

    def load(self) -> None:
        self._buckets: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        found = self._buckets.get(word)
        if found is None:
            if len(self._buckets) >= 100_000:  # a bound on memory; the hash is recomputed
                self._buckets.clear()
            found = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dimension
            self._buckets[word] = found
        return found

    def embed(self, texts: list[str]) -> np.ndarray:
        rows = [
            np.bincount([self._bucket(w) for w in text_words(text)], minlength=self.dimension)
            for text in texts
        ]
        return unit(np.asarray(rows, dtype=np.float64))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Each row at length one; a row of zeros stays as it is."""
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def check_dimension(embedder: Embedder, dimension: int) -> None:
    if embedder.dimension != dimension:
        raise InvalidRowsError(
            f"dimension {dimension} is configured but {embedder.model_name} has {embedder.dimension}"
        )


def embed(texts: DataFrame, column: str, embedder: Embedder, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add ``embedding_model``, ``embedding`` and ``error``.

    Only the text goes to Python, in Arrow batches; the other columns stay in the JVM. The model
    is loaded once per task. A text the model fails on gets an error instead of a vector.
    """

    @F.arrow_udf("struct<embedding:array<float>,error:string>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embedder.load()
        for batch in batches:
            yield _embed_batch(embedder, batch.to_pylist(), batch_size)

    return (
        texts.withColumn("_vector", vectors(F.col(column)))
        .withColumn("embedding_model", F.lit(embedder.model_name))
        .withColumns({"embedding": F.col("_vector.embedding"), "error": F.col("_vector.error")})
        .drop("_vector")
    )


def _embed_batch(embedder: Embedder, texts: list[str | None], batch_size: int) -> pa.Array:
    rows, errors = [], []
    for start in range(0, len(texts), batch_size):
        part = [text or "" for text in texts[start : start + batch_size]]
        for vector, error in _embed_part(embedder, part):
            rows.append(vector)
            errors.append(error)
    lengths = [0 if row is None else len(row) for row in rows]
    flat = np.concatenate([row for row in rows if row is not None] or [np.zeros(0)])
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    missing = pa.array([row is None for row in rows], pa.bool_())
    arrays = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.float32)), mask=missing)
    return pa.StructArray.from_arrays([arrays, pa.array(errors, pa.string())], ["embedding", "error"])


def _embed_part(embedder: Embedder, texts: list[str]) -> list[tuple]:
    try:
        vectors = embedder.embed(texts)
        if len(vectors) != len(texts):
            raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
        return [(vector, None) for vector in vectors]
    except Exception as error:
        if len(texts) > 1:  # find the text at fault, so that the others keep their vectors
            return [row for text in texts for row in _embed_part(embedder, [text])]
        return [(None, f"{type(error).__name__}: {error}")]
