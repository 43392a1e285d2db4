"""Nearest chunks of many queries at once: blocks of vectors joined with blocks of queries.

Vectors and queries are packed into blocks of bounded bytes, a row each. Blocks meet by an ordinary
join on a cell, so the plan and its one scan of the chunks are the same however many queries there
are: few queries are broadcast by Spark's own choice and the chunks stay where they are, many are
shuffled by cell beside them. No pair of a query and a chunk is ever a row.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.functions.vectors import cosine_distances, matrix
from bidscope.operators.filters import in_range, same_model
from bidscope.operators.search import CHUNK_KEY, SEARCH_LIMIT, nearest_first

#: Bytes of the vectors of a block.
BLOCK_BYTES = 4 << 20
#: Queries multiplied at a time, so that a matrix of distances stays small.
QUERY_SLICE = 256
#: Blocks of queries whose best hits a task holds at the same time.
HELD_BLOCKS = 8

CHUNK_BLOCKS = "cell int, dimension int, files binary, positions binary, vectors binary"
QUERY_BLOCKS = "cell int, query_block string, ids array<bigint>, query_dimension int, queries binary"
HITS = "query_id bigint, dce_file_id bigint, chunk_index int, distance double"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one cell (the first column) and vectors (the last) of at most a block's bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column(0).to_numpy(zero_copy_only=False)
        sizes = batch.column(batch.num_columns - 1).value_lengths().drop_null()
        rows = max(1, BLOCK_BYTES // (8 * max(1, (sizes[0].as_py() if len(sizes) else 1))))
        cuts = np.flatnonzero(cells[1:] != cells[:-1]) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
            for at in range(begin, end, rows):
                yield batch.slice(at, min(rows, end - at))


def _vectors(lists: pa.Array) -> np.ndarray:
    """A matrix of doubles; missing vectors are zeros, which have no direction."""
    sizes = lists.value_lengths().drop_null()
    return matrix(lists, sizes[0].as_py() if len(sizes) else 0)[0]


def _chunk_blocks(spread_over: int | None):
    """Rows (cell, file, position, vector) to blocks; without cells, dealt out over that many."""

    def run(batches):
        from pyspark import TaskContext

        n = TaskContext.get().partitionId()
        for part in _runs(batches):
            vectors = _vectors(part.column(3))
            cell = part.column(0)[0].as_py() if spread_over is None else n % spread_over
            n += 1
            values = [
                [cell],
                [vectors.shape[1]],
                [part.column(1).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
                [part.column(2).to_numpy(zero_copy_only=False).astype(np.int32).tobytes()],
                [vectors.astype(np.float64).tobytes()],
            ]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], _names(CHUNK_BLOCKS))

    return run


def _query_blocks(batches):
    """Rows (cell, id, vector) to blocks."""
    from pyspark import TaskContext

    context = TaskContext.get()
    for n, part in enumerate(_runs(batches)):
        vectors = _vectors(part.column(2))
        arrays = [
            part.column(0).slice(0, 1).cast(pa.int32()),
            pa.array([f"{context.partitionId()}-{n}"]),
            pa.array([part.column(1).to_pylist()], pa.list_(pa.int64())),
            pa.array([vectors.shape[1]], pa.int32()),
            pa.array([vectors.astype(np.float64).tobytes()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, _names(QUERY_BLOCKS))


class _Best:
    """The nearest rows of each query of a block seen so far by one task."""

    def __init__(self, queries: int, limit: int) -> None:
        self.limit = limit
        self.reach = np.full(queries, np.inf)
        self.kept = [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]

    def add(self, distances: np.ndarray, files: np.ndarray, positions: np.ndarray) -> None:
        distances = np.where(np.isnan(distances), np.inf, distances)
        reach = self.reach
        if len(distances) > self.limit:
            kth = np.partition(distances, self.limit - 1, axis=0)[self.limit - 1]
            reach = np.minimum(reach, kth)
        # Equal distances stay in: the keys decide among them below.
        row, query = np.nonzero(distances <= reach[None, :])
        new = (query, files[row], positions[row], distances[row, query])
        query, file, position, distance = map(np.concatenate, zip(self.kept, new))
        order = np.lexsort((position, file, distance, query))
        query = query[order]
        starts = np.searchsorted(query, np.arange(len(self.reach)))
        place = np.arange(len(query)) - starts[query]
        top = place < self.limit
        self.kept = [query[top], file[order][top], position[order][top], distance[order][top]]
        last = place[top] == self.limit - 1
        self.reach[self.kept[0][last]] = self.kept[3][last]


def _multiply(limit: int):
    """Pairs of blocks to the nearest rows that the task has met for each query."""

    def hits(ids: list, best: list[_Best]) -> Iterator[pa.RecordBatch]:
        for k, kept in enumerate(best):
            at, files, positions, distances = kept.kept
            asked = pa.array(ids, pa.int64()).take(pa.array(at + k * QUERY_SLICE))
            found = pa.array(distances, mask=~np.isfinite(distances))
            keys = [pa.array(files), pa.array(positions.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([asked, *keys, found], _names(HITS))

    def run(batches):
        held: dict = {}
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                dimension, asked = row["dimension"].as_py(), row["query_dimension"].as_py()
                files = np.frombuffer(row["files"].as_buffer(), dtype=np.int64)
                positions = np.frombuffer(row["positions"].as_buffer(), dtype=np.int32)
                if asked != dimension and dimension and asked:
                    raise ValueError(f"vectors of {dimension} numbers, not {asked}")
                if dimension and asked:
                    vectors = np.frombuffer(row["vectors"].as_buffer()).reshape(-1, dimension)
                    queries = np.frombuffer(row["queries"].as_buffer()).reshape(-1, asked)
                else:  # vectors without any number have no direction
                    vectors, queries = np.zeros((len(files), 1)), np.zeros((len(row["ids"]), 1))
                name = row["query_block"].as_py(), row["cell"].as_py()
                if name not in held:
                    if len(held) >= HELD_BLOCKS:
                        yield from hits(*held.pop(next(iter(held))))
                    slices = range(0, len(queries), QUERY_SLICE)
                    held[name] = row["ids"].as_py(), [_Best(len(queries[s : s + QUERY_SLICE]), limit) for s in slices]
                for s, best in enumerate(held[name][1]):
                    part = queries[s * QUERY_SLICE : (s + 1) * QUERY_SLICE]
                    best.add(cosine_distances(vectors, part), files, positions)
        for ids, best in held.values():
            yield from hits(ids, best)

    return run


def block_hits(chunk_blocks: DataFrame, query_blocks: DataFrame, limit: int) -> DataFrame:
    """Hits (query_id, file, position, distance) of all tasks, from blocks joined by cell."""
    return chunk_blocks.join(query_blocks, "cell").mapInArrow(_multiply(limit), HITS)


def ranked(hits: DataFrame, limit: int) -> DataFrame:
    """The nearest of all tasks' hits: first of each group of tasks, then of the groups."""
    groups = math.isqrt(_parts(hits)) + 1

    def top(rows: DataFrame, *keys) -> DataFrame:
        order = W.partitionBy("query_id", *keys).orderBy(*nearest_first())
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)

    grouped = hits.withColumn("_group", F.spark_partition_id() % groups)
    return top(top(grouped, "_group").drop("_group", "rank"))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_cells(rows: DataFrame) -> DataFrame:
    """Blocks of chunks (cell, dce_file_id, chunk_index, embedding)."""
    return rows.select("cell", *CHUNK_KEY, "embedding").mapInArrow(_chunk_blocks(None), CHUNK_BLOCKS)


def queries_in_cells(queries: DataFrame) -> DataFrame:
    """Blocks of queries (cell, query_id, embedding), each query in all cells that it asks."""
    asked = queries.select("cell", "query_id", "embedding")
    return asked.repartition("cell").sortWithinPartitions("cell").mapInArrow(_query_blocks, QUERY_BLOCKS)


def search_many(chunks: DataFrame, queries: DataFrame, model: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """The nearest chunks of each query (query_id, embedding), ranked from 1.

    Exact. Blocks of chunks are dealt out over as many cells as the session has shuffle partitions;
    every block of queries goes to each. A task hands on ``limit`` rows per query that it met, and
    those meet in two steps, so that no task orders the hits of all tasks. Null ids name a query
    like any other value. Chunks without a direction come last, with a null distance.
    """
    in_range("limit", limit, 1)
    parts = _parts(chunks)
    rows = chunks.filter(same_model(model)).select(F.lit(0).alias("cell"), *CHUNK_KEY, "embedding")
    blocks = rows.mapInArrow(_chunk_blocks(parts), CHUNK_BLOCKS)
    asked = queries.select(F.lit(0).alias("cell"), F.col("query_id").cast("long"), "embedding")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("cell")
    asked = asked.mapInArrow(_query_blocks, QUERY_BLOCKS).select(everywhere, *_names(QUERY_BLOCKS)[1:])
    return ranked(block_hits(blocks, asked, limit), limit)
