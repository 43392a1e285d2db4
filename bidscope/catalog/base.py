"""Registry of checked queries, and the tender view they share.

The supplied tables hold no tenders, so a view over orders, customers and line items plays their
part. Its SQL is one text for both engines; only types and one date sum are spelled differently.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.session import prepare, spread
from bidscope.sources.tables import as_instants

NOW = datetime(2000, 6, 15, 12, tzinfo=timezone.utc)
NOW_SQL = "TIMESTAMP '2000-06-15 12:00:00'"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL that must return the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Instants without zone and counts as bigint, the types the SQL side returns."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            casts[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(casts) if casts else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return as_instants(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to work on, dealt out evenly."""
    return spread(table(spark, sf_dir, name))


_VIEW = """
  SELECT o_orderkey AS id, CAST(o_orderkey AS {text}) AS tender_id,
    'ORG' || CAST(c_nationkey AS {text}) AS organization_acronym,
    CASE o_orderstatus WHEN 'O' THEN 'Open call' WHEN 'F' THEN 'Restricted call' ELSE 'Direct' END
      AS procurement_type,
    CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN lower(o_orderpriority)
      WHEN 2 THEN '  ' || o_orderpriority || ' ' ELSE replace(o_orderpriority, 'T SP', 'T   SP')
      END AS category,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END
      AS publication_date,
    CAST(o_orderkey AS {text}) || '/' || o_orderstatus || '/' || CAST(o_custkey AS {text})
      AS reference_number,
    CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
      WHEN 2 THEN repeat(lower(c_mktsegment) || ' supplies ', 9)
      WHEN 3 THEN repeat(c_name || ' works, ', 5)
      ELSE 'Works for ' || c_name END AS tender_object,
    CASE WHEN o_orderkey % 5 = 0 THEN lower(c_name) ELSE c_name END AS public_buyer,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '   '
      WHEN o_orderkey % 3 = 0 THEN upper(n_name) WHEN o_orderkey % 3 = 1 THEN ' ' || n_name
      ELSE n_name END AS location,
    {deadline} AS deadline,
    CASE o_orderkey % 8 WHEN 0 THEN 'DISCOVERED' WHEN 1 THEN 'DOWNLOADING' WHEN 2 THEN 'UPLOADED'
      WHEN 3 THEN 'CHUNKING' WHEN 4 THEN 'CHUNKED' WHEN 5 THEN 'EMBEDDING' WHEN 6 THEN 'INDEXED'
      ELSE 'FAILED' END AS status,
    CASE WHEN o_orderkey % 8 = 7 THEN CASE o_orderkey % 5 WHEN 0 THEN NULL
      WHEN 1 THEN 'DOWNLOADING' WHEN 2 THEN 'UPLOADED' WHEN 3 THEN 'CHUNKED'
      ELSE 'EMBEDDING' END END AS last_status,
    CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS TIMESTAMP) AS updated_at
  FROM {orders} LEFT JOIN (
      SELECT l_orderkey, CAST(max(l_quantity) AS INT) AS w FROM {lineitem} GROUP BY l_orderkey
    ) AS d ON l_orderkey = o_orderkey
  JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
"""

#: DuckDB: the view as a WITH clause, to put before a query over ``tenders``.
WITH_TENDERS = "WITH tenders AS ({})".format(
    _VIEW.format(
        text="VARCHAR",
        deadline="o_orderdate + to_days(w) + to_hours(CAST(o_orderkey % 24 AS INT))",
        orders="orders",
        lineitem="lineitem",
        customer="customer",
        nation="nation",
    )
)


def tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "customer", "nation")
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}
    text = _VIEW.format(
        text="STRING",
        deadline="CAST(timestampadd(HOUR, CAST(w * 24 + o_orderkey % 24 AS INT), o_orderdate)"
        " AS TIMESTAMP)",
        **{name: f"{{{name}}}" for name in names},
    )
    return spark.sql(text, **frames)


#: DuckDB: spelling and group key of a column.
def spelling_sql(column: str) -> str:
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


def key_sql(column: str) -> str:
    return f"lower({spelling_sql(column)})"


#: DuckDB: the deadline's Moroccan date, and the response window in days.
LOCAL_DEADLINE = "((deadline AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Casablanca')"
WINDOW_SQL = f"CAST(CAST({LOCAL_DEADLINE} AS DATE) - publication_date AS BIGINT)"


def period_sql(period: str, open_only: bool = False) -> str:
    days = {"7d": 7, "30d": 30, "90d": 90}.get(period)
    test = "publication_date IS NOT NULL"
    if days:
        test = (
            f"publication_date > DATE '2000-06-15' - {days}"
            " AND publication_date <= DATE '2000-06-15'"
        )
    return f"{test} AND deadline > {NOW_SQL}" if open_only else test


ARCHIVED_SQL = "('UPLOADED', 'CHUNKING', 'CHUNKED', 'EMBEDDING', 'INDEXED')"
READY_SQL = f"(status = 'UPLOADED' OR (status = 'FAILED' AND last_status IN {ARCHIVED_SQL}))"
HAS_ARCHIVE_SQL = (
    f"coalesce(status IN {ARCHIVED_SQL} OR (status = 'FAILED' AND last_status IN {ARCHIVED_SQL}),"
    " false)"
)
