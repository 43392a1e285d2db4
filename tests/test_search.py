import numpy as np
import pytest
from helpers import column, tender_rows
from pyspark.sql import functions as F

from bidscope.errors import NotFoundError
from bidscope.functions import vectors
from bidscope.operators import batch_search, cells, search
from bidscope.schemas import CHUNKS, DCE_FILES

SIZE = 80


def axis(n, weight=1.0):
    vector = np.zeros(SIZE)
    vector[n] = weight
    return vector


def unit(vector):
    return (vector / np.linalg.norm(vector)).tolist()


def chunk_rows(spark, rows):
    """(file, index, vector[, model])"""
    full = [
        (i, r[0], r[1], f"text {r[0]}/{r[1]}", [r[1] + 1], ["Article 1", f"Section {r[1]}"], r[3] if len(r) > 3 else "m", r[2], None)
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, CHUNKS).repartition(5)


@pytest.fixture(scope="module")
def scoped(spark):
    """Sixty decoys of another tender lie nearer to the query than the four targets."""
    targets = [(1, i, unit(axis(0) + axis(1 + i, i + 1))) for i in range(4)]
    decoys = [(2, i, unit(axis(0) + axis(10 + i, 0.01 * (i + 1)))) for i in range(60)]
    others = [(2, 90, axis(0).tolist(), "another model"), (2, 91, None), (2, 92, [0.0] * SIZE)]
    chunks = chunk_rows(spark, targets + decoys + others)
    files = spark.createDataFrame([(n, n, f"f{n}.pdf", "pdf", "chunked", None, None) for n in (1, 2)], DCE_FILES)
    return chunks, files, tender_rows(spark, [{}, {}, {}])


def test_round_trip(spark, scoped):
    chunks = chunk_rows(spark, [(1, n, axis(n).tolist()) for n in range(3)])
    hits = search.search(chunks, *scoped[1:], axis(1).tolist(), "m").collect()
    assert (hits[0].chunk_index, hits[0].distance, hits[0].page_numbers, hits[0].heading_path) == (1, 0, [2], ["Article 1", "Section 1"])
    assert [h.chunk_index for h in hits] == [1, 0, 2]


def test_scoped_search_is_exact(scoped):
    hits = search.search(*scoped, axis(0).tolist(), "m", 3, tender=("T1", "ORG"))
    assert [(h.tender_id, h.chunk_index) for h in hits.collect()] == [("T1", 0), ("T1", 1), ("T1", 2)]
    everywhere = search.search(*scoped, axis(0).tolist(), "m", 3)
    assert [(h.tender_id, h.dce_file_path, h.chunk_index) for h in everywhere.collect()] == [("T2", "f2.pdf", n) for n in range(3)]


def test_scope_edges(scoped):
    assert search.search(*scoped, axis(0).tolist(), "m", tender=("T3", "ORG")).isEmpty()
    with pytest.raises(NotFoundError):
        search.search(*scoped, axis(0).tolist(), "m", tender=("T9", "ORG"))
    assert search.search(*scoped, axis(0).tolist(), "nothing").isEmpty()
    with pytest.raises(ValueError):
        search.search(*scoped, axis(0).tolist(), "m", 0)


def test_vectors_without_direction_come_last(scoped):
    hits = search.nearest(scoped[0], axis(0).tolist(), "m", 100).collect()
    assert len(hits) == 66
    assert [h.distance for h in hits[-2:]] == [None, None]
    assert all(a.distance <= b.distance for a, b in zip(hits[:63], hits[1:64]))


def test_wrong_size_is_an_error(scoped):
    with pytest.raises(Exception, match="not 3"):
        search.nearest(scoped[0], [1.0, 0.0, 0.0], "m").collect()


def test_jvm_distance_agrees(spark, scoped):
    query = unit(np.arange(1, SIZE + 1, dtype=float))
    literal = F.array(*[F.lit(x) for x in query])
    both = scoped[0].select(
        vectors.distance_to(query, F.col("embedding")).alias("a"),
        vectors.cosine_distance(F.col("embedding"), literal).alias("b"),
    )
    for row in both.collect():
        assert (row.a is None and row.b is None) or abs(row.a - row.b) < 1e-9


def test_hits_as_text(scoped):
    hits = search.with_similarity(search.with_rank(search.search(*scoped, axis(0).tolist(), "m", 2, tender=("T1", "ORG"))))
    rows = hits.select("rank", "similarity", search.hit_text().alias("shown")).orderBy("rank").collect()
    assert [r.rank for r in rows] == [1, 2]
    assert rows[0].shown == (
        "#1  similarity 0.707\nTender:   T1 (ORG)\nFile:     f1.pdf\nPages:    1\nHeadings: Article 1 > Section 0\n\ntext 1/0\n"
    )
    bare = hits.withColumn("page_numbers", F.array().cast("array<int>")).withColumn("heading_path", F.array().cast("array<string>"))
    assert "Pages:    -\nHeadings: -\n" in bare.select(search.hit_text().alias("s")).first().s


def brute(rows, queries, k):
    out = {}
    for name, query in queries:
        ranked = []
        for file, index, vector in rows:
            norm = np.linalg.norm(vector) * np.linalg.norm(query)
            ranked.append((round(1 - np.dot(vector, query) / norm, 12) if norm else np.inf, file, index))
        out[name] = [(f, i) for _, f, i in sorted(ranked)[:k]]
    return out


@pytest.mark.parametrize("block", [4 << 20, 400])
def test_many_queries(spark, monkeypatch, block):
    """A third of all vectors are copies of one another; in one block of queries, and in several."""
    rng = np.random.default_rng(5)
    copy = rng.normal(size=8).tolist()
    rows = [(n % 7, n, copy if n % 3 == 0 else rng.normal(size=8).astype(np.float32).tolist()) for n in range(300)]
    rows.append((9, 999, [0.0] * 8))
    queries = [(n, rng.normal(size=8).astype(np.float32).tolist()) for n in range(20)] + [(77, np.float32(copy).tolist())]
    rows = [(f, i, np.float32(v).tolist()) for f, i, v in rows]
    monkeypatch.setattr(batch_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(batch_search, "QUERY_SLICE", 7)
    asked = spark.createDataFrame(queries, "query_id long, embedding array<float>")
    hits = batch_search.search_many(chunk_rows(spark, rows), asked, "m", 12).orderBy("query_id", "rank").collect()
    found = {}
    for hit in hits:
        found.setdefault(hit.query_id, []).append((hit.dce_file_id, hit.chunk_index))
    assert found == brute(rows, queries, 12)
    everything = batch_search.search_many(chunk_rows(spark, rows), asked.limit(1), "m", 1000)
    assert everything.count() == 301 and everything.filter("distance IS NULL").count() == 1


def test_no_queries(spark, scoped):
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert batch_search.search_many(scoped[0], none, "m", 3).isEmpty()


def test_cells(spark, tmp_path):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 16)) * 4
    rows = [(n % 3, n, (centres[n % 6] + rng.normal(size=16)).tolist()) for n in range(600)]
    chunks = chunk_rows(spark, [*rows, (5, 1000, [0.0] * 16)])
    index = cells.CellIndex(spark, str(tmp_path / "cells"))
    index.build(chunks, "m", cells=6)
    query = (centres[2] + rng.normal(size=16)).tolist()
    exact = search.nearest(chunks, query, "m")
    assert cells.recall(index.search(query, "m", probes=2), exact).first().recall >= 0.8
    # Probing every cell is the exact search.
    everything = index.search(query, "m", probes=6)
    assert column(everything, "chunk_index") == column(exact, "chunk_index")
    assert cells.recall(everything, exact).first().asDict() == {"exact_hits": 10, "found_hits": 10, "recall": 1.0}
    plan = index.search(query, "m", probes=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    with pytest.raises(ValueError):
        index.search(query, "m", probes=0)


def test_a_search_by_cells_goes_on_until_it_has_enough(spark, tmp_path):
    """Cells of one vector each: one probe alone would give one hit."""
    chunks = chunk_rows(spark, [(1, n, np.eye(8)[n].tolist()) for n in range(8)])
    index = cells.CellIndex(spark, str(tmp_path / "cells"))
    index.build(chunks, "m", cells=8)
    query = [1.0, 0.5, 0.2, 0.1, 0.0, 0.0, 0.0, 0.0]
    assert column(index.search(query, "m", limit=3, probes=1), "chunk_index") == [0, 1, 2]
    assert index.search(query, "m", limit=50, probes=1).count() == 8


def test_hits_of_many_tasks_meet_in_two_steps(spark):
    chunks = chunk_rows(spark, [(n % 5, n, [1.0, float(n)]) for n in range(400)]).repartition(100)
    none = spark.createDataFrame([], "query_id long, embedding array<double>")
    hits = batch_search.search_many(chunks, none, "m", 3)
    text = hits._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window ") >= 2 and "_group" in text
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (None, [0.0, 1.0])], "query_id long, embedding array<double>")
    found = batch_search.search_many(chunks, asked, "m", 3).orderBy("query_id", "rank").collect()
    assert [r.chunk_index for r in found] == [399, 398, 397, 0, 1, 2]


def directions(rng, n, size, groups):
    """Vectors around a few directions, with copies of one of them and one without direction."""
    centres = rng.normal(size=(groups, size)) * 2
    rows = [(k % 4, k, np.float32(centres[k % groups] + rng.normal(size=size)).tolist()) for k in range(n)]
    return rows + [(8, n + k, rows[0][2]) for k in range(n // 3)] + [(9, 5 * n, [0.0] * size)]


def found_by(hits):
    out = {}
    for hit in hits.orderBy("query_id", "rank").collect():
        out.setdefault(hit.query_id, []).append((hit.dce_file_id, hit.chunk_index))
    return out


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    rows = directions(rng, 600, 12, 20)
    index = cells.CellIndex(spark, str(tmp_path_factory.mktemp("cells")))
    index.build(chunk_rows(spark, rows), "m", cells=24)
    queries = [(k, rows[7 * k][2]) for k in range(30)] + [(None, rng.normal(size=12).tolist())]
    return index, rows, queries, spark.createDataFrame(queries, "query_id long, embedding array<double>")


def test_exact_search_by_cells_is_proved(spark, indexed):
    index, rows, queries, asked = indexed
    for limit in (1, 10):
        want = {i: v for i, v in brute(rows, queries, limit).items()}
        assert found_by(index.search_many(asked, "m", limit, probes=1, exact=True)) == want
        one = index.search(queries[3][1], "m", limit, probes=1, exact=True)
        assert column(one, "chunk_index") == [i for _, i in want[3]]
    # More than there are with a direction: every cell must be read.
    everything = index.search_many(asked.limit(1), "m", 2000, exact=True)
    assert everything.count() == len(rows)


def test_reach_leaves_out_cells(indexed):
    index, rows, _, _ = indexed
    known, vectors = index.centres, np.array([v for _, _, v in rows[:50]])
    angles = known.angles(vectors)
    chosen = known.within(angles, np.zeros(50))  # only what is as near as a copy
    assert chosen.any(axis=1).all() and chosen.mean() < 0.5
    assert (known.within(angles, np.full(50, np.nan)) == (known.rows > 0)).all()


def test_calibrated_recall(indexed):
    index, rows, queries, asked = indexed
    assert 1 <= index.centres.probes < 24
    exact = batch_search.search_many(chunk_rows(asked.sparkSession, rows), asked, "m")
    found = cells.recall_by_query(index.search_many(asked, "m"), exact).toPandas()
    assert found.found_hits.sum() >= 0.9 * found.exact_hits.sum() and set(found.exact_hits) == {10}
    read = index.cells_read(asked).toPandas()
    assert len(read) == len(queries) and (read.cells_read < read.cells_stored).any()
    with pytest.raises(ValueError):
        index.search_many(asked, "m", probes=0)


def test_one_scan_however_many_queries(spark, indexed):
    _, rows, _, asked = indexed
    chunks = chunk_rows(spark, rows[:50])
    texts = []
    for queries in (asked.limit(1), asked, asked.union(asked).union(asked)):
        hits = batch_search.search_many(chunks, queries, "m", 3)
        texts.append(hits._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
    assert len(set(texts)) == 1
