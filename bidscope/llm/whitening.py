"""Whitening of embeddings, each distinct vector counted once, or as often as it occurs.

1. Entries become integers, so equal vectors are equal exactly. Rows carry a 128-bit digest of
   their vector; of equal vectors one goes on, with the number of rows that have it.
2. Sums per dimension are exact. Vectors are centred in integers before they are multiplied: each
   task adds up its share of the covariance by matrix products, shares are added by cell.
3. The driver holds one matrix of dimensions by dimensions, whatever the number of rows, and takes
   its eigenvectors. Each distinct vector is projected once; rows join it by digest.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm.registry import query, table
from bidscope.session import staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Scaled entries beyond this are held at it; up to here floor(64 * c) is exact and sums are far from their limit.
LARGEST = 1 << 40
#: Rows of a matrix product.
ROWS = 4096



def _scaled(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are whole, where each whole row's entries begin (and an end), and all their x.

    A null vector or one with a null or non-finite entry is not whole.
    """
    lists = lists.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    entries = values.to_numpy(zero_copy_only=False)  # nulls become NaN
    entries = entries.astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    whole = lists.is_valid().to_numpy(zero_copy_only=False).copy()
    whole[row[~np.isfinite(entries)]] = False
    x = np.clip(np.floor(SCALE * entries[whole[row]]), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    return whole, np.concatenate([[0], np.cumsum(sizes[whole])]), x


def _digests(bounds: np.ndarray, x: np.ndarray) -> pa.Array:
    data = memoryview(x.astype("<i8").tobytes())
    spans = zip((8 * bounds[:-1]).tolist(), (8 * bounds[1:]).tolist())
    return pa.array([hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in spans], type=pa.binary())


def _vectors(batches):
    """Whole vectors as integers."""
    for batch in batches:
        whole, bounds, x = _scaled(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [
                _digests(bounds, x),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x)),
            ],
            names=["digest", "x"],
        )


def _row_digests(batches):
    for batch in batches:
        whole, bounds, x = _scaled(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(whole)), _digests(bounds, x)], names=["vec_id", "digest"]
        )


def _matrix(lists: pa.Array, dimension: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _slices(batches, dimension: int):
    """(weights, x) of at most ROWS rows at once, from columns n_rows and x."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("n_rows").to_numpy(zero_copy_only=False), _matrix(part.column("x"), dimension)


def _sums(dimension: int):
    """A task's weighted sum of each dimension."""

    def run(batches):
        total = np.zeros(dimension, dtype=np.int64)
        for _, weight, x in _slices(batches, dimension):
            total += (weight[:, None] * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(total)], names=["i", "total"])

    return run


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: whole numbers while they fit, else Python's."""
    reach = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if reach < 1 << 62:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def _products(dimension: int, n: int, sums: np.ndarray):
    """A task's share of the sum of w * c c', c being a centred vector; the upper half, by cell."""
    upper = np.triu_indices(dimension)

    def run(batches):
        total = np.zeros((dimension, dimension))
        for _, weight, x in _slices(batches, dimension):
            centred = _deviations(x, n, sums).astype(np.float64) / n
            total += (centred * weight[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["cell", "total"]
        )

    return run


WHITE = "digest binary, n_rows long, deviation long, white array<double>"


def _project(dimension: int, n: int, sums: np.ndarray, axes: np.ndarray):
    """Squared deviation and whitened components of each distinct vector.

    A squared deviation that does not fit a long is null.
    """

    def run(batches):
        for part, _, x in _slices(batches, dimension):
            off = _deviations(x, n, sums)
            reach = int(np.abs(off).max(initial=0))
            if off.dtype == object or dimension * reach * reach >= 1 << 63:
                exact = [sum(int(v) ** 2 for v in row) for row in off]
                square = pa.array([v if v < 1 << 63 else None for v in exact], type=pa.int64())
            else:
                square = pa.array((off * off).sum(axis=1))
            white = (off.astype(np.float64) / n) @ axes
            offsets = pa.array(np.arange(0, white.size + 1, max(1, axes.shape[1]), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("digest"),
                    part.column("n_rows"),
                    square,
                    pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
                ],
                names=["digest", "n_rows", "deviation", "white"],
            )

    return run


def _moments(count: int):
    """A task's sums of the whitened components and of their products, as cells of one matrix."""

    def run(batches):
        total = np.zeros((count + 1, count + 1))
        for batch in batches:
            white = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, count)
            one = np.hstack([white, np.ones((len(white), 1))])
            total += (one * batch.column(0).to_numpy(zero_copy_only=False)[:, None]).T @ one
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "total"]
        )

    return run


def _added(df: DataFrame, key: str) -> np.ndarray:
    """The tasks' totals added up, in order of the key; there are as many keys as the matrix has cells."""
    rows = df.groupBy(key).agg(F.sum("total").alias("total")).toArrow()
    return rows["total"].to_numpy()[np.argsort(rows[key].to_numpy())]


@dataclass
class Whitening:
    """A fitted basis: n vectors of the fit, their sums, axes (columns) and what each explains."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def distinct_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """digest, n_rows and x of each distinct vector of whole entries.

    Vectors of another length than most of the distinct ones (of equals, the longer) are left out.
    """
    rows = embeddings.select(F.col(column)).mapInArrow(_vectors, "digest binary, x array<long>")
    found = rows.groupBy("digest").agg(F.count("*").alias("n_rows"), F.any_value("x").alias("x"))
    found = staged(found, "vectors")
    most = found.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return found.filter(F.size("x") == (most["size"] if most else 0))


def fit(vectors: DataFrame, counted: bool = False, most: int = COMPONENTS) -> Whitening | None:
    """The whitening basis of distinct vectors; with ``counted`` each weighs as many rows as it has.

    Components are numbered by falling eigenvalue; those whose eigenvalue is zero, but for rounding,
    are left out. The largest entry of each axis is positive. None without a vector.
    """
    weight = F.col("n_rows") if counted else F.lit(1).cast("long")
    vectors = vectors.select(weight.alias("n_rows"), "x")
    head = vectors.agg(F.sum("n_rows").alias("n"), F.max(F.size("x")).alias("size")).first()
    if not head["n"] or not head["size"]:
        return None
    n, dimension = head["n"], head["size"]
    sums = _added(vectors.mapInArrow(_sums(dimension), "i long, total long"), "i")
    cells = _added(vectors.mapInArrow(_products(dimension, n, sums), "cell long, total double"), "cell")
    covariance = np.zeros((dimension, dimension))
    covariance[np.triu_indices(dimension)] = cells / n
    covariance += np.triu(covariance, 1).T
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > np.finfo(float).eps * dimension * max(values.max(), 0)]
    axes = axes[:, order]
    if len(order):
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    trace = np.trace(covariance)
    return Whitening(n, sums, axes / np.sqrt(values[order]), values[order] / trace if len(order) else values[order])


def project(vectors: DataFrame, basis: Whitening) -> DataFrame:
    """digest, n_rows, deviation (long) and white (array of components) of each distinct vector."""
    return vectors.mapInArrow(_project(len(basis.sums), basis.n, basis.sums, basis.axes), WHITE)


def identity_error(white: DataFrame, count: int, counted: bool = False) -> float:
    """Largest absolute entry of the covariance of whitened vectors minus the identity."""
    weight = F.col("n_rows") if counted else F.lit(1).cast("long")
    cells = _added(white.select(weight, "white").mapInArrow(_moments(count), "cell long, total double"), "cell")
    total = cells.reshape(count + 1, count + 1)
    n, mean = total[count, count], total[count, :count] / total[count, count]
    return float(np.abs(total[:count, :count] / n - np.outer(mean, mean) - np.eye(count)).max())


def whitened(embeddings: DataFrame, column: str = "embedding", counted: bool = False) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component.

    ``embeddings`` needs vec_id and the vectors. Rows whose vector is null or has a null or
    non-finite entry are left out, and so are vectors of another length than most. Entries c become
    floor(64 * c) + 1000000; those beyond 2 ** 40 are held there. With ``counted`` a vector weighs
    as many rows as have it in n, S and the covariances, else one. A row with equal ones, or without
    an id, gets rows like any other; ids need not be unique. Where the vectors span fewer than
    sixteen dimensions there are as many components, so no rows for one distinct vector or for
    empty ones, and none for an empty table. Other columns are ignored, whatever their names.
    """
    vectors = distinct_vectors(embeddings, column)
    basis = fit(vectors, counted)
    ids = embeddings.select(F.col("vec_id"), F.col(column))
    count = len(basis.explained) if basis else 0
    if not count:
        return ids.limit(0).select(
            "vec_id",
            *(F.lit(0).cast(kind).alias(name) for name, kind in [("component", "int"), ("n", "long"), ("deviation", "long")]),
            *(F.lit(0.0).alias(name) for name in ("whitened", "explained", "identity_error")),
        )
    white = staged(project(vectors, basis), "whitened")
    error = identity_error(white, count, counted)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    rows = ids.mapInArrow(_row_digests, f"vec_id {kind}, digest binary").join(white, "digest")
    rows = rows.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    shares = F.array(*map(F.lit, basis.explained.tolist()))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(basis.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query("op12_whitening")
def whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings"))
