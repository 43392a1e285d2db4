"""Vector search over the supplied vectors, taken as chunks of ten files of ten tenders."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.catalog.base import WITH_TENDERS, query, table, tenders
from bidscope.functions import vectors
from bidscope.operators import cells, search
from bidscope.operators.batch_search import search_many
from bidscope.session import scratch_path, staged

MODEL = "given-64"
_CHUNKS = """SELECT CAST(label AS BIGINT) AS dce_file_id, CAST(vec_id AS INT) AS chunk_index,
    'text ' || CAST(vec_id AS {text}) AS text, embedding,
    CASE WHEN vec_id % 7 = 6 THEN 'other' ELSE 'given-64' END AS embedding_model
  FROM {embeddings}"""
_FILES = """SELECT DISTINCT CAST(label AS BIGINT) AS id, CAST(label AS BIGINT) AS tender_record_id,
    'file_' || CAST(label AS {text}) || '.pdf' AS path FROM {embeddings}"""
_QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"
_WITH = f"""{WITH_TENDERS},
    chunks AS ({_CHUNKS.format(text="VARCHAR", embeddings="embeddings")}),
    dce_files AS ({_FILES.format(text="VARCHAR", embeddings="embeddings")}),
    measured AS (SELECT *, round(1 - list_dot_product(CAST(embedding AS DOUBLE[]),
        CAST({_QUERY} AS DOUBLE[]))
      / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))
        * list_dot_product(CAST({_QUERY} AS DOUBLE[]), CAST({_QUERY} AS DOUBLE[]))), 12)
      AS distance FROM chunks)"""
_HIT = """t.tender_id, t.organization_acronym, f.path AS dce_file_path, h.chunk_index, h.text,
  round(h.distance, 6) + 0 AS distance"""
_CITED = "hits h JOIN dce_files f ON f.id = h.dce_file_id JOIN tenders t ON t.id = f.tender_record_id"


def chunks(spark, sf_dir):
    rows = spark.sql(_CHUNKS.replace("{text}", "STRING"), embeddings=table(spark, sf_dir, "embeddings"))
    return rows.withColumns(
        {
            "page_numbers": F.array((F.col("chunk_index") % 9 + 1).cast("int"), F.lit(10)),
            "heading_path": F.array(F.lit("Article 1"), F.concat(F.lit("Section "), "dce_file_id")),
        }
    )


def files(spark, sf_dir):
    return spark.sql(_FILES.replace("{text}", "STRING"), embeddings=table(spark, sf_dir, "embeddings"))


def query_vector(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding").first()[0]


def _hits(spark, sf_dir, **options):
    return search.search(
        chunks(spark, sf_dir),
        files(spark, sf_dir),
        tenders(spark, sf_dir),
        query_vector(spark, sf_dir),
        MODEL,
        **options,
    )


def _rounded(hits):
    return hits.select(
        "tender_id",
        "organization_acronym",
        "dce_file_path",
        "chunk_index",
        "text",
        (F.round("distance", 6) + 0).alias("distance"),
    )


@query(
    "knn_exact",
    f"""{_WITH}, hits AS (SELECT * FROM measured WHERE embedding_model = '{MODEL}'
      ORDER BY distance, dce_file_id, chunk_index LIMIT 10) SELECT {_HIT} FROM {_CITED}""",
)
def knn_exact(spark, sf_dir):
    return _rounded(_hits(spark, sf_dir))


@query(
    "knn_scoped",
    f"""{_WITH}, hits AS (SELECT * FROM measured WHERE embedding_model = '{MODEL}'
        AND dce_file_id IN (SELECT id FROM dce_files WHERE tender_record_id = 3)
      ORDER BY distance, dce_file_id, chunk_index LIMIT 10) SELECT {_HIT} FROM {_CITED}""",
)
def knn_scoped(spark, sf_dir):
    key = tenders(spark, sf_dir).filter("id = 3").select("tender_id", "organization_acronym").first()
    return _rounded(_hits(spark, sf_dir, tender=tuple(key)))


@query(
    "cosine_distances",
    f"""{_WITH} SELECT chunk_index, round(distance, 6) + 0 AS distance FROM measured""",
)
def cosine_distances(spark, sf_dir):
    """All distances to one vector, computed in the JVM."""
    target = F.lit(query_vector(spark, sf_dir)).cast(T.ArrayType(T.DoubleType()))
    distance = vectors.cosine_distance(F.col("embedding"), target)
    return chunks(spark, sf_dir).select(
        "chunk_index", (F.round(F.round(distance, 12), 6) + 0).alias("distance")
    )


_MEANS = """means AS (SELECT label AS query_id, list(m ORDER BY k) AS qe FROM (
      SELECT label, k, avg(CAST(x AS DOUBLE)) AS m FROM (SELECT label, unnest(embedding) AS x,
        generate_subscripts(embedding, 1) AS k FROM embeddings) GROUP BY ALL) GROUP BY ALL)"""


@query(
    "knn_batch",
    f"""{_WITH}, {_MEANS}, v AS (SELECT query_id, dce_file_id, chunk_index, CAST(c.embedding AS DOUBLE[]) AS e, qe
      FROM chunks c CROSS JOIN means WHERE embedding_model = '{MODEL}'),
    d AS (SELECT query_id, dce_file_id, chunk_index, round(1 - list_dot_product(e, qe)
        / sqrt(list_dot_product(e, e) * list_dot_product(qe, qe)), 12) AS distance FROM v),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY distance, dce_file_id, chunk_index) AS rank FROM d)
    SELECT query_id, dce_file_id, chunk_index, rank, round(distance, 6) + 0 AS distance
    FROM r WHERE rank <= 5""",
)
def knn_batch(spark, sf_dir):
    """The five chunks nearest to the mean vector of each label."""
    values = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("k", "x"))
    means = values.groupBy("label", "k").agg(F.avg(F.col("x").cast("double")).alias("m"))
    queries = means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "m"))), lambda x: x["m"]).alias("embedding")
    )
    hits = search_many(chunks(spark, sf_dir), queries, MODEL, limit=5)
    return hits.withColumn("distance", F.round("distance", 6) + 0)


@query(
    "hit_format",
    f"""{_WITH}, hits AS (SELECT *, row_number() OVER (ORDER BY distance, dce_file_id, chunk_index)
        AS rank FROM measured WHERE embedding_model = '{MODEL}'
      ORDER BY distance, dce_file_id, chunk_index LIMIT 10)
    SELECT rank, round(1 - h.distance, 6) AS similarity, printf('#%d  similarity %.3f\nTender:   %s (%s)\nFile:     %s\nPages:    %s\nHeadings: %s\n\n%s\n',
        rank, 1 - h.distance, t.tender_id, t.organization_acronym, f.path,
        (chunk_index % 9 + 1) || ', 10', 'Article 1 > Section ' || dce_file_id, h.text) AS shown
    FROM {_CITED}""",
)
def hit_format(spark, sf_dir):
    ranked = search.with_similarity(search.with_rank(_hits(spark, sf_dir)))
    return ranked.select(
        "rank", F.round("similarity", 6).alias("similarity"), search.hit_text().alias("shown")
    )


@query(
    "unit_vectors",
    """WITH scaled AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (vec_id % 5))
        AS v FROM embeddings),
    normed AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM scaled)
    SELECT vec_id, round(n, 6) AS length, CASE WHEN n > 0 THEN array_to_string(list_transform(v,
      lambda x: CAST(round(x / n * 1000000) AS BIGINT)), ',') END AS units FROM normed""",
)
def unit_vectors(spark, sf_dir):
    """The vectors at other lengths, zero included, brought back to length one."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 5)).alias("v"),
    )
    units = F.transform(
        vectors.normalised(F.col("v")), lambda x: F.round(x * 1000000).cast("bigint")
    )
    return rows.select(
        "vec_id",
        F.round(vectors.norm(F.col("v")), 6).alias("length"),
        F.array_join(units.cast("array<string>"), ",").alias("units"),
    )


_ASKED = "(SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS qe FROM embeddings WHERE vec_id % 100 = 0)"
_CELLS = 32


def _index(spark, sf_dir):
    index = cells.CellIndex(spark, scratch_path(spark, "cells"))
    index.build(chunks(spark, sf_dir), MODEL, cells=_CELLS)
    return index


def _asked(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").filter("vec_id % 100 = 0")
    return rows.select(F.col("vec_id").alias("query_id"), "embedding")


@query(
    "knn_approximate",
    f"""{_WITH} SELECT dce_file_id, chunk_index, round(distance, 6) + 0 AS distance FROM measured
      WHERE embedding_model = '{MODEL}' ORDER BY distance, dce_file_id, chunk_index LIMIT 10""",
)
def knn_approximate(spark, sf_dir):
    """The search by cells, going on until it is proved to be the exact one."""
    hits = _index(spark, sf_dir).search(query_vector(spark, sf_dir), MODEL, exact=True)
    return hits.select("dce_file_id", "chunk_index", (F.round("distance", 6) + 0).alias("distance"))


@query(
    "knn_cells",
    f"""{_WITH}, v AS (SELECT query_id, dce_file_id, chunk_index, CAST(c.embedding AS DOUBLE[]) AS e, qe
      FROM chunks c CROSS JOIN {_ASKED} WHERE embedding_model = '{MODEL}'),
    d AS (SELECT query_id, dce_file_id, chunk_index, round(1 - list_dot_product(e, qe)
        / sqrt(list_dot_product(e, e) * list_dot_product(qe, qe)), 12) AS distance FROM v),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY distance, dce_file_id, chunk_index) AS rank FROM d)
    SELECT query_id, dce_file_id, chunk_index, rank, round(distance, 6) + 0 AS distance
    FROM r WHERE rank <= 10""",
)
def knn_cells(spark, sf_dir):
    """The ten chunks nearest to every vector whose id is divisible by 100, by cells and proved."""
    hits = _index(spark, sf_dir).search_many(_asked(spark, sf_dir), MODEL, exact=True)
    return hits.withColumn("distance", F.round("distance", 6) + 0)


@query(
    "knn_recall",
    f"""{_WITH} SELECT query_id, (SELECT least(count(*), 10) FROM chunks WHERE embedding_model = '{MODEL}')
      AS exact_hits, true AS enough_found, true AS cells_left_out FROM {_ASKED}""",
)
def knn_recall(spark, sf_dir):
    """Recall of the calibrated search, of all those queries against all rows."""
    index, asked = _index(spark, sf_dir), _asked(spark, sf_dir)
    exact = search_many(chunks(spark, sf_dir), asked, MODEL)
    found = staged(cells.recall_by_query(index.search_many(asked, MODEL), exact), "recall")
    read = index.cells_read(asked).agg((F.sum("cells_read") < F.sum("cells_stored")).alias("cells_left_out"))
    share = found.agg((F.sum("found_hits") >= 0.9 * F.sum("exact_hits")).alias("enough_found"))
    return found.select("query_id", "exact_hits", share.scalar().alias("enough_found"), read.scalar().alias("cells_left_out"))
