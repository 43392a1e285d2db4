"""Chunking, embedding, storing and retrieving the supplied documents."""

from pyspark.sql import functions as F

from bidscope.catalog.base import WITH_TENDERS, query, spread_table, table, tenders
from bidscope.operators import chunking
from bidscope.operators.embedding import HashEmbedder, embed
from bidscope.operators.writes import remove_files
from bidscope.plans.retrieval import retrieve
from bidscope.session import scratch_path, staged
from bidscope.sources.store import FileStore, without_repeats

DIMENSION = 64
_WORDS = r"list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> '')"
_CHUNKED = f"""words AS (SELECT doc_id, source, {_WORDS} AS w FROM documents),
    starts AS (SELECT doc_id, source, w, unnest(range(0, len(w), {{size}})) AS s FROM words),
    chunks AS (SELECT doc_id, source, CAST(s / {{size}} AS BIGINT) AS chunk_index,
      array_to_string(w[s + 1 : s + {{size}}], ' ') AS text,
      CAST(len(w[s + 1 : s + {{size}}]) AS BIGINT) AS n_words FROM starts)"""
_CHUNKS = _CHUNKED.format(size=512)


@query(
    "chunk_documents",
    f"WITH {_CHUNKS} SELECT doc_id, chunk_index, text, n_words FROM chunks",
)
def chunk_documents(spark, sf_dir):
    return chunking.chunk_texts(spread_table(spark, sf_dir, "documents").select("doc_id", "text"))


# Conversations as documents: a section per three turns, a page per two.
_BLOCKS = """SELECT conv_id AS doc_id, CAST(floor(turn / 3) AS INT) AS section_no,
    array('Conversation', CAST(CAST(floor(turn / 3) AS INT) AS STRING)) AS headings,
    CAST(floor(turn / 2) + 1 AS INT) AS page, CAST(turn AS INT) AS position, text
  FROM {conversations}"""


def _blocks_sql(section: str, headings: str) -> str:
    """Chunks of 24 words of conversations whose turns lie in ``section`` under ``headings``."""
    return f"""WITH blocks AS (SELECT conv_id AS doc_id, {section} AS section_no,
        CAST(floor(turn / 2) + 1 AS BIGINT) AS page, turn, {_WORDS} AS w FROM conversations),
    tokens AS (SELECT doc_id, section_no, page, turn, unnest(w) AS word,
      generate_subscripts(w, 1) AS k FROM blocks),
    placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY turn, k) - 1
      AS nth FROM tokens),
    parts AS (SELECT doc_id, section_no, CAST(floor(nth / 24) AS BIGINT) AS part,
        string_agg(word, ' ' ORDER BY nth)
        AS text, string_agg(DISTINCT page, ',' ORDER BY page) AS pages
      FROM placed GROUP BY ALL)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY section_no NULLS FIRST, part) - 1
        AS chunk_index, text, pages, {headings} AS headings,
      CASE WHEN section_no IS NULL THEN text
        ELSE 'Conversation' || chr(10) || section_no || chr(10) || text END AS embedding_text
    FROM parts"""


def _chunked_blocks(blocks, max_tokens=24, counter=None):
    return chunking.chunk_blocks(blocks, max_tokens, counter).select(
        "doc_id",
        "chunk_index",
        "text",
        F.array_join(F.col("page_numbers").cast("array<string>"), ",").alias("pages"),
        F.array_join("heading_path", " > ").alias("headings"),
        "embedding_text",
    )


@query("chunk_blocks", _blocks_sql("CAST(floor(turn / 3) AS BIGINT)", "'Conversation > ' || section_no"))
def chunk_blocks(spark, sf_dir):
    return _chunked_blocks(spark.sql(_BLOCKS, conversations=table(spark, sf_dir, "conversations")))


@query(
    "chunk_blocks_unplaced",
    _blocks_sql(
        "CASE WHEN conv_id % 3 > 0 AND turn >= 3 THEN CAST(floor(turn / 3) AS BIGINT) END",
        "CASE WHEN section_no IS NULL THEN '' ELSE 'Conversation > ' || section_no END",
    ),
)
def chunk_blocks_unplaced(spark, sf_dir):
    """Some blocks come without a section and without headings."""
    blocks = spark.sql(_BLOCKS, conversations=table(spark, sf_dir, "conversations"))
    placed = (F.col("doc_id") % 3 > 0) & (F.col("position") >= 3)
    return _chunked_blocks(
        blocks.withColumns(
            {"section_no": F.when(placed, F.col("section_no")), "headings": F.when(placed, F.col("headings"))}
        )
    )


# Budget 64: long words become pieces of 4 letters; the headings "Conversation" and a section's
# number of up to four digits have 4 tokens, which leaves cells of 64 - 4 - 16.
@query(
    "chunk_blocks_by_tokens",
    rf"""WITH blocks AS (SELECT conv_id AS doc_id, CAST(floor(turn / 3) AS BIGINT) AS section_no,
        CAST(floor(turn / 2) + 1 AS BIGINT) AS page, turn, {_WORDS} AS w FROM conversations),
    found AS (SELECT * EXCLUDE (w), unnest(w) AS word, generate_subscripts(w, 1) AS k FROM blocks),
    cut AS (SELECT * EXCLUDE (word), CASE WHEN strlen(word) = len(word) AND len(word) <= 16
          OR len(word) <= 8 AND NOT regexp_matches(word, '[\x{{800}}-\x{{10FFFF}}]') THEN [word]
        ELSE list_transform(range(1, len(word) + 1, 4), lambda i: substr(word, i, 4)) END AS p FROM found),
    tokens AS (SELECT * EXCLUDE (p), unnest(p) AS word, generate_subscripts(p, 1) AS j FROM cut),
    weighed AS (SELECT *, CAST(ceil(strlen(word) / 4) AS BIGINT) AS weight FROM tokens),
    placed AS (SELECT *, sum(weight) OVER (PARTITION BY doc_id, section_no ORDER BY turn, k, j) - weight
      AS begun FROM weighed),
    parts AS (SELECT doc_id, section_no, CAST(floor(begun / 44) AS BIGINT) AS part,
        string_agg(word, ' ' ORDER BY begun) AS text, CAST(sum(weight) AS BIGINT) AS n_tokens,
        string_agg(DISTINCT page, ',' ORDER BY page) AS pages
      FROM placed GROUP BY ALL)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY section_no, part) - 1 AS chunk_index,
      text, pages, 'Conversation > ' || section_no AS headings, n_tokens,
      'Conversation' || chr(10) || section_no || chr(10) || text AS embedding_text
    FROM parts""",
)
def chunk_blocks_by_tokens(spark, sf_dir):
    blocks = spark.sql(_BLOCKS, conversations=table(spark, sf_dir, "conversations"))
    chunks = _chunked_blocks(blocks, 64, chunking.byte_tokens)
    weights = chunking.byte_tokens(chunking.words(F.col("text")))
    total = F.aggregate(weights, F.lit(0).cast("bigint"), lambda sum_, n: sum_ + n)
    return chunks.withColumn("n_tokens", total)


@query(
    "chunk_document_lines",
    f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
    tokens AS (SELECT doc_id, line, CAST(floor(line / 4) AS BIGINT) + 1 AS page, unnest({_WORDS}) AS word,
      generate_subscripts({_WORDS}, 1) AS k FROM lines),
    placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line, k) - 1 AS nth
      FROM tokens)
    SELECT doc_id, CAST(floor(nth / 512) AS BIGINT) AS chunk_index,
      string_agg(word, ' ' ORDER BY nth) AS text, string_agg(DISTINCT page, ',' ORDER BY page) AS pages
    FROM placed GROUP BY ALL""",
)
def chunk_document_lines(spark, sf_dir):
    """Documents as one block per line, four lines to a page."""
    documents = spread_table(spark, sf_dir, "documents")
    blocks = chunking.text_blocks(documents, "doc_id", "text", 4, F.array(F.lit("Text")))
    pages = F.array_join(F.col("page_numbers").cast("array<string>"), ",")
    return chunking.chunk_blocks(blocks).select("doc_id", "chunk_index", "text", pages.alias("pages"))


# DuckDB: hash buckets of a text's words, and their counts at unit length as 32-bit numbers.
_BUCKET = f"CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {DIMENSION}"
_EMBEDDED = f"""{_CHUNKS}, tokens AS (SELECT doc_id, chunk_index, unnest(string_split(text, ' ')) AS word
      FROM chunks),
    counts AS (SELECT doc_id, chunk_index, {_BUCKET} AS bucket, count(*) AS n FROM tokens
      GROUP BY ALL),
    vectors AS (SELECT doc_id, chunk_index, map_from_entries(list((bucket, n))) AS m,
      sqrt(CAST(sum(n * n) AS DOUBLE)) AS length FROM counts GROUP BY ALL),
    embedded AS (SELECT doc_id, chunk_index, list_transform(range({DIMENSION}), lambda i:
      CAST(coalesce(m[i], 0) / length AS FLOAT)) AS embedding FROM vectors)"""


def _embedded(spark, sf_dir):
    return embed(chunk_documents(spark, sf_dir), "text", HashEmbedder(DIMENSION))


@query(
    "hash_embed",
    f"""WITH {_EMBEDDED} SELECT doc_id, chunk_index, 'word-hash-{DIMENSION}' AS embedding_model,
      array_to_string(list_transform(embedding, lambda x:
        CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS millionths FROM embedded""",
)
def hash_embed(spark, sf_dir):
    millionths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000).cast("bigint"))
    return _embedded(spark, sf_dir).select(
        "doc_id",
        "chunk_index",
        "embedding_model",
        F.array_join(millionths.cast("array<string>"), ",").alias("millionths"),
    )


QUESTION = "thereof are anent the reanin of the inand"


@query(
    "retrieve_text",
    f"""{WITH_TENDERS}, {_EMBEDDED}, question AS (SELECT {_BUCKET} AS bucket, count(*) AS n
      FROM (SELECT unnest(string_split('{QUESTION}', ' ')) AS word) GROUP BY ALL),
    counted AS (SELECT map_from_entries(list((bucket, n))) AS m,
      sqrt(CAST(sum(n * n) AS DOUBLE)) AS length FROM question),
    asked AS (SELECT list_transform(range({DIMENSION}), lambda i:
      CAST(coalesce(m[i], 0) / length AS FLOAT)) AS q FROM counted),
    measured AS (SELECT doc_id, chunk_index, round(1 - list_dot_product(CAST(embedding AS DOUBLE[]),
        CAST(q AS DOUBLE[])) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]),
        CAST(embedding AS DOUBLE[])) * list_dot_product(CAST(q AS DOUBLE[]), CAST(q AS DOUBLE[]))),
        12) AS distance FROM embedded, asked),
    hits AS (SELECT * FROM measured ORDER BY distance, doc_id, chunk_index LIMIT 5)
    SELECT tender_id, organization_acronym, 'doc_' || doc_id || '.txt' AS dce_file_path,
      chunk_index, text, round(distance, 6) AS distance
    FROM hits JOIN chunks USING (doc_id, chunk_index) JOIN tenders ON id = doc_id""",
)
def retrieve_text(spark, sf_dir):
    chunks = (
        _embedded(spark, sf_dir)
        .withColumnRenamed("doc_id", "dce_file_id")
        .withColumns(
            {"page_numbers": F.array(F.lit(1)), "heading_path": F.array().cast("array<string>")}
        )
    )
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("tender_record_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
    )
    hits = retrieve(chunks, files, tenders(spark, sf_dir), QUESTION, HashEmbedder(DIMENSION))
    return hits.select(
        "tender_id",
        "organization_acronym",
        "dce_file_path",
        "chunk_index",
        "text",
        F.round("distance", 6).alias("distance"),
    )


def document_files(documents, position, path):
    """Documents as files with chunks, in the shape the file store takes."""
    section = F.struct(
        F.array(F.col("source")).alias("headings"),
        F.array(F.struct(F.lit(1).alias("page"), F.col("text").alias("text"))).alias("pieces"),
    )
    return documents.select(
        F.col("doc_id").alias("tender_record_id"),
        F.lit(position).alias("position"),
        F.concat(F.lit(path), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.lit("txt").alias("file_type"),
        F.lit("chunked").alias("status"),
        F.lit(None).cast("string").alias("reason"),
        chunking.chunk_sections(F.array(section)).alias("chunks"),
    )


def replaced_store(spark, sf_dir):
    """Every document stored, then those of two sources replaced: one anew, one by nothing."""
    documents = spread_table(spark, sf_dir, "documents")
    store = FileStore(spark, scratch_path(spark, "files"))
    owners = documents.select(F.col("doc_id").alias("tender_record_id"), "source")
    embedder = HashEmbedder(DIMENSION)
    first = document_files(documents, 0, "v1/").unionByName(
        document_files(documents.withColumn("text", F.translate("text", "e", "E")), 1, "v1/copy_")
    )
    store.replace(owners, staged(without_repeats(first), "first-files"), embedder)
    second = document_files(documents.filter("source = 'src4'"), 0, "v2/")
    replaced = owners.filter("source IN ('src4', 'src9')")
    store.replace(replaced, staged(without_repeats(second), "second-files"), embedder)
    return store


_STORED = f"""{_CHUNKS}, v AS (SELECT * FROM (VALUES ('v1/'), ('v1/copy_'), ('v2/')) AS x(p)),
    stored AS (SELECT doc_id, source, p || doc_id || '.txt' AS path, p FROM documents, v WHERE
      CASE source WHEN 'src4' THEN p = 'v2/' WHEN 'src9' THEN false ELSE p <> 'v2/' END)"""


@query(
    "replace_files",
    f"WITH {_STORED} SELECT doc_id AS tender_record_id, path, 'chunked' AS status FROM stored",
)
def replace_files(spark, sf_dir):
    return replaced_store(spark, sf_dir).files().select("tender_record_id", "path", "status")


@query(
    "replace_chunks",
    f"""WITH {_STORED} SELECT s.doc_id AS tender_record_id, s.path, c.chunk_index,
      CASE p WHEN 'v1/copy_' THEN replace(c.text, 'e', 'E') ELSE c.text END AS text, s.source AS headings,
      {DIMENSION} AS dimension FROM stored s JOIN chunks c USING (doc_id)""",
)
def replace_chunks(spark, sf_dir):
    store = replaced_store(spark, sf_dir)
    paths = store.files().select(F.col("id").alias("dce_file_id"), "path")
    return store.chunks().join(paths, "dce_file_id").select(
        "tender_record_id",
        "path",
        "chunk_index",
        "text",
        F.array_join("heading_path", " > ").alias("headings"),
        F.size("embedding").alias("dimension"),
    )


@query(
    "replace_ids",
    f"""WITH {_STORED}, n AS (SELECT count(*) AS files FROM stored),
    c AS (SELECT count(*) AS chunks FROM stored JOIN chunks USING (doc_id))
    SELECT files, files AS file_ids, chunks, chunks AS chunk_ids,
      (SELECT count(*) * 2 FROM documents) + (SELECT count(*) FROM documents WHERE source = 'src4')
        AS last_file_id FROM n, c""",
)
def replace_ids(spark, sf_dir):
    """Ids stay unique over replacements and are never used again."""
    store = replaced_store(spark, sf_dir)
    files = store.files().agg(
        F.count("*").alias("files"),
        F.count_distinct("id").alias("file_ids"),
        F.max("id").alias("highest"),
    )
    chunks = store.chunks().agg(
        F.count("*").alias("chunks"), F.count_distinct("id").alias("chunk_ids")
    )
    last = spark.read.parquet(f"{store.root}/commits").agg(F.max("last_file_id"))
    return files.select(
        "files",
        "file_ids",
        chunks.select("chunks").scalar().alias("chunks"),
        chunks.select("chunk_ids").scalar().alias("chunk_ids"),
        last.scalar().alias("last_file_id"),
    )


@query(
    "remove_files",
    f"""WITH {_CHUNKS} SELECT doc_id AS dce_file_id, chunk_index FROM chunks
    WHERE source NOT IN ('src4', 'src9')""",
)
def remove_files_query(spark, sf_dir):
    """The table form of a replacement: what is left of the old rows."""
    documents = table(spark, sf_dir, "documents")
    files = documents.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("tender_record_id")
    )
    chunks = chunk_documents(spark, sf_dir).withColumnRenamed("doc_id", "dce_file_id")
    replaced = documents.filter("source IN ('src4', 'src9')")
    _, kept = remove_files(files, chunks, replaced.select(F.col("doc_id").alias("tender_record_id")))
    return kept.select("dce_file_id", "chunk_index")
