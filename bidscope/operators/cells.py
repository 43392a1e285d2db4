"""Search by cells: chunks stored by nearest centre, of which a query reads only a few.

Cells are folders, so the rest of the table is not read at all. Within the cells read, distances
are exact. Each cell knows how far its vectors reach from the centre. On the unit sphere angles obey
the triangle inequality, so no vector of a cell is nearer to a query than its centre less that reach:
a search may go on until this proves that nothing nearer is left. Otherwise it ends after as many
cells as a calibration found to be enough for the recall asked for.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.vectors import cosine_distances, matrix
from bidscope.operators.batch_search import block_hits, in_cells, queries_in_cells, ranked, search_many
from bidscope.operators.filters import in_range, same_model
from bidscope.operators.search import CHUNK_KEY, SEARCH_LIMIT, nearest
from bidscope.session import staged

#: The recall that the calibrated number of cells must reach on the sample.
RECALL = 0.95
#: Stored vectors that are asked for in the calibration, at most.
SAMPLE = 256
#: Angles are computed in doubles; a bound must fail by more than this.
SLACK = 1e-6


def _angle(distances: np.ndarray) -> np.ndarray:
    """Angles of cosine distances; not a number where one side has no direction."""
    return np.arccos(np.clip(1 - distances, -1, 1))


@dataclass
class _Centres:
    """What the driver knows of the cells: as many rows as cells were asked for in ``build``."""

    cells: np.ndarray
    centres: np.ndarray
    rows: np.ndarray
    reach: np.ndarray
    probes: int

    def angles(self, queries: np.ndarray) -> np.ndarray:
        """Queries by cells. A query without a direction is equally far from all."""
        return np.nan_to_num(_angle(cosine_distances(queries, self.centres)), nan=0.0)

    def probed(self, angles: np.ndarray, probes: int, limit: int) -> np.ndarray:
        """Queries by cells: the nearest ones, and further ones until they hold enough chunks."""
        order = np.argsort(angles, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        out = np.zeros(angles.shape, dtype=bool)
        np.put_along_axis(out, order, (np.arange(len(self.cells)) < probes) | (held < limit), axis=1)
        return out

    def within(self, angles: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Queries by cells: those that may hold a chunk as near as ``distance``; all where it is null."""
        farthest = np.nan_to_num(_angle(distance), nan=np.inf)
        return (angles - self.reach <= farthest[:, None] + SLACK) & (self.rows > 0)


def _routed(centres: _Centres, choose, kind: str):
    """Rows (query_id, embedding, …) to one row for each cell that ``choose`` picks."""

    def run(batches):
        for batch in batches:
            vectors, _ = matrix(batch.column(1), centres.centres.shape[1])
            query, cell = np.nonzero(choose(centres.angles(vectors), batch))
            at = pa.array(query)
            arrays = [pa.array(centres.cells[cell].astype(np.int32)), batch.column(0).take(at), batch.column(1).take(at)]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "query_id", "embedding"])

    return run, f"cell int, query_id bigint, embedding {kind}"


class CellIndex:
    """Chunks in folders by cell, with the centres, their reach and the calibrated number of probes."""

    def __init__(self, spark, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, chunks: DataFrame, model: str, cells: int, seed: int = 7, recall: float = RECALL) -> None:
        """Store the chunks by cell. The centres are learnt from all vectors that have a direction.

        The default number of probes is calibrated on at most ``SAMPLE`` stored vectors: the least
        one with which the others nearest to them are found to a share of ``recall``.
        """
        rows = chunks.filter(same_model(model) & F.col("embedding").isNotNull())
        rows = rows.select(*CHUNK_KEY, "text", "page_numbers", "heading_path", "embedding_model", "embedding")
        points = rows.withColumn("point", array_to_vector(F.col("embedding").cast("array<double>")))
        # A vector of zeros has no direction and goes to the first cell.
        has_direction = F.exists("embedding", lambda x: x != 0)
        directed = points.filter(has_direction)
        means = KMeans(
            k=cells, seed=seed, featuresCol="point", predictionCol="cell", distanceMeasure="cosine"
        ).fit(directed.select("point"))
        placed = means.transform(directed).unionByName(
            points.filter(~has_direction).withColumn("cell", F.lit(0))
        )
        # Ranges are of equal size: a crowded cell is written by many tasks.
        ranges = placed.drop("point").repartitionByRange(F.col("cell"), F.xxhash64(*CHUNK_KEY))
        ranges.write.partitionBy("cell").parquet(f"{self.path}/chunks")
        centres = np.array([[float(x) for x in c] for c in means.clusterCenters()])
        measured = self._stored().select("cell", "embedding").mapInArrow(_reach(centres), "cell int, rows long, reach double")
        measured = measured.groupBy("cell").agg(F.sum("rows").alias("rows"), F.max("reach").alias("reach"))
        listed = [(i, c.tolist()) for i, c in enumerate(centres)]
        found = self.spark.createDataFrame(listed, "cell int, centre array<double>").join(measured, "cell", "left")
        found = found.withColumns({"rows": F.coalesce("rows", F.lit(0)), "reach": F.coalesce("reach", F.lit(0.0))})
        found.write.parquet(f"{self.path}/centres")
        probes = self._calibrated(model, recall)
        self.spark.createDataFrame([(probes, recall)], "probes int, recall double").write.parquet(f"{self.path}/calibration")

    def _stored(self, cells: Sequence[int] | None = None) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/chunks")
        return stored if cells is None else stored.filter(F.col("cell").isin([int(c) for c in cells]))

    def _known(self, probes: int = 0) -> _Centres:
        rows = self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").toArrow()
        centres = np.array(rows["centre"].to_pylist())
        return _Centres(rows["cell"].to_numpy(), centres, rows["rows"].to_numpy(), rows["reach"].to_numpy(), probes)

    @cached_property
    def centres(self) -> _Centres:
        return self._known(self.spark.read.parquet(f"{self.path}/calibration").first().probes)

    def _calibrated(self, model: str, recall: float) -> int:
        known = self._known()
        key = F.xxhash64(*CHUNK_KEY)
        some = self._stored().select(*CHUNK_KEY, "embedding").orderBy(key, *CHUNK_KEY).limit(SAMPLE)
        some = staged(some.withColumn("query_id", F.monotonically_increasing_id()), "calibration")
        # A vector always finds itself, so it does not count.
        own = some.select("query_id", *CHUNK_KEY)
        hits = search_many(self._stored(), some, model, SEARCH_LIMIT + 1).drop("distance", "rank")
        hits = hits.join(own, ["query_id", *CHUNK_KEY], "left_anti").join(self._stored().select(*CHUNK_KEY, "cell"), CHUNK_KEY)
        # At most SAMPLE rows, and SEARCH_LIMIT + 1 hits of each.
        asked, found = some.select("query_id", "embedding").toArrow(), hits.select("query_id", "cell").toArrow()
        if not found.num_rows:
            return 1
        ids = asked["query_id"].to_numpy()
        order = np.argsort(known.angles(np.array(asked["embedding"].to_pylist())), axis=1, kind="stable")
        rank = np.argsort(order, axis=1)  # of each cell, for each query
        place = {query: k for k, query in enumerate(ids.tolist())}
        at = [place[query] for query in found["query_id"].to_pylist()]
        needed = np.sort(rank[at, np.searchsorted(known.cells, found["cell"].to_numpy())]) + 1
        return int(needed[max(0, int(np.ceil(recall * len(needed))) - 1)])

    def search(
        self, query: Sequence[float], model: str, limit: int = SEARCH_LIMIT, probes: int | None = None, exact: bool = False
    ) -> DataFrame:
        """The nearest chunks in the ``probes`` cells whose centres are nearest, by default as calibrated.

        Where those hold fewer than ``limit`` chunks, further cells are read until they do, or
        until there are no more. ``exact`` reads on until no cell left can hold a nearer chunk.
        """
        known, vector = self.centres, np.asarray(query, dtype=np.float64)[None, :]
        probes = known.probes if probes is None else probes
        in_range("probes", probes, 1)
        angles = known.angles(vector)
        chosen = known.probed(angles, probes, limit)
        if exact:
            farthest = nearest(self._stored(known.cells[chosen[0]]), query, model, limit)
            last = farthest.agg(F.count("distance").alias("n"), F.max("distance").alias("d")).first()
            chosen |= known.within(angles, np.array([last.d if last.n == limit else np.nan]))
        return nearest(self._stored(known.cells[chosen[0]]), query, model, limit)

    def search_many(
        self, queries: DataFrame, model: str, limit: int = SEARCH_LIMIT, probes: int | None = None, exact: bool = False
    ) -> DataFrame:
        """The nearest chunks of each query (query_id, embedding), ranked from 1; see ``search``.

        Queries are dealt to cells, where blocks of them meet blocks of chunks. An exact search
        deals them a second time: to the cells that may hold something nearer than what was found.
        """
        known = self.centres
        probes = known.probes if probes is None else probes
        in_range("limit", limit, 1)
        in_range("probes", probes, 1)
        asked = queries.select(F.col("query_id").cast("long"), "embedding")
        kind = asked.schema["embedding"].dataType.simpleString()
        first = staged(asked.mapInArrow(*_routed(known, lambda angles, _: known.probed(angles, probes, limit), kind)), "routed")
        hits = self._asked(first, model, limit)
        if not exact:
            return ranked(hits, limit)
        hits = staged(ranked(hits, limit).drop("rank"), "hits")
        last = hits.groupBy("query_id").agg(F.count("distance").alias("_n"), F.max("distance").alias("_d"))
        last = last.select(F.col("query_id").alias("_id"), F.when(F.col("_n") == limit, F.col("_d")).alias("distance"))
        open_queries = asked.join(last, F.col("query_id").eqNullSafe(F.col("_id")), "left")

        def left(angles: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
            distance = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            return known.within(angles, distance) & ~known.probed(angles, probes, limit)

        rest = open_queries.select("query_id", "embedding", "distance").mapInArrow(*_routed(known, left, kind))
        more = self._asked(staged(rest, "routed"), model, limit)
        return ranked(hits.unionByName(more), limit)

    def _asked(self, routed: DataFrame, model: str, limit: int) -> DataFrame:
        cells = [row.cell for row in routed.select("cell").distinct().collect()]  # at most all cells
        stored = self._stored(cells).filter(same_model(model))
        return block_hits(in_cells(stored), queries_in_cells(routed), limit)

    def cells_read(self, queries: DataFrame, limit: int = SEARCH_LIMIT, probes: int | None = None) -> DataFrame:
        """query_id, cells_read and cells_stored of an approximate search."""
        known = self.centres
        probes = known.probes if probes is None else probes
        asked = queries.select(F.col("query_id").cast("long"), "embedding")
        kind = asked.schema["embedding"].dataType.simpleString()
        routed = asked.mapInArrow(*_routed(known, lambda angles, _: known.probed(angles, probes, limit), kind))
        stored = F.lit(int(np.count_nonzero(known.rows))).cast("long").alias("cells_stored")
        return routed.groupBy("query_id").agg(F.count("*").alias("cells_read")).select("query_id", "cells_read", stored)


def _reach(centres: np.ndarray):
    """Each task's rows per cell, and the largest angle between one and its centre."""

    def run(batches):
        rows, reach = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres))
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            vectors, _ = matrix(batch.column(1), centres.shape[1])
            rows += np.bincount(cells, minlength=len(centres))
            for cell in np.unique(cells):
                angles = _angle(cosine_distances(vectors[cells == cell], centres[cell][None, :]))
                reach[cell] = max(reach[cell], np.nanmax(np.append(angles, 0.0)))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(rows[some]), pa.array(reach[some])], ["cell", "rows", "reach"]
        )

    return run


def recall_by_query(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """query_id, exact_hits and found_hits: how many of the exact hits of each query were found."""
    keys = ["query_id", *CHUNK_KEY]
    found = approximate.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = exact.select(*keys).join(found, same, "left")
    return both.groupBy("query_id").agg(F.count("*").alias("exact_hits"), F.count("_chunk_index").alias("found_hits"))


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact hits that the approximate search found."""
    found = exact.select(*CHUNK_KEY).join(
        approximate.select(*CHUNK_KEY, F.lit(1).alias("found")), CHUNK_KEY, "left"
    )
    return found.agg(
        F.count("*").alias("exact_hits"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("found_hits"),
    ).withColumn("recall", F.try_divide("found_hits", "exact_hits"))
