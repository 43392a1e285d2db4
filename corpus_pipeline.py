"""The corpus pipeline: raw documents in, a cleaned, mixed and sharded corpus out.

Every stage works on all that its predecessor kept, which is written as Parquet and read again
between two stages. All but the last return the columns they were given.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm import decontaminate, mixing, near_dedup, quality, sharding
from bidscope.llm.registry import query
from bidscope.session import staged

#: Documents of this similarity in per cent or more are near duplicates.
SIMILAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, and documents that the rules reject go as a whole.

    ``n_chars``, where there is one, follows the text. Null and empty texts are rejected; repeated
    rows stay or go together. Other columns pass unchanged.
    """
    return quality.clean(docs)


def near_deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    A document is its id and text; of equal rows one stays. Where an id has several texts, one of
    them goes by the id. The others, and documents without an id, count as having ids above all
    others that depend on id and text.
    """
    own = F.xxhash64("text")
    late = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    several = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(own).alias("_lo"), F.max(own).alias("_hi"))
    several = several.filter("_lo < _hi").select(F.col("doc_id").alias("_several"), "_lo")
    known = docs.select("doc_id", own.alias("_own"), late.alias("_late"), F.struct(*docs.columns).alias("_row"))
    known = known.join(several, F.col("doc_id") == F.col("_several"), "left")
    known = known.select(
        F.when(F.col("_own") != F.col("_lo"), F.col("_late")).otherwise(F.coalesce("doc_id", "_late")).alias("_id"), "_row"
    )
    found = near_dedup.near_duplicates(known.select(F.col("_id").alias("doc_id"), "_row.text"), SIMILAR)
    first = found.filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    kept = known.join(first, F.col("_id") == F.col("_kept"), "left_semi")
    one = kept.groupBy("_id").agg(F.min_by("_row", F.struct("_row.text")).alias("_row"))
    return one.select("_row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; other columns pass unchanged.

    Equal rows stay or go together; null and empty texts, and rows without an id, are judged like others.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is there at least once; those of small sources are repeated.

    Rows without a source are a source of their own, and rows without an id are shown too. Equal
    rows are repeated each. Other columns pass unchanged.
    """
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard, and its place in the shard's order.

    Null ids and texts are placed like others, equal rows in one shard but in places of their own.
    Columns named like an added one are replaced; others pass unchanged.
    """
    return sharding.assign(docs, keep=docs.columns)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_deduplicate),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: Near-duplicate components and tilings are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
