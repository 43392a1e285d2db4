"""The corpus queries by name, with SQL where it can say the same."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bidscope.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the supplied tables and, where there is one, its SQL."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
