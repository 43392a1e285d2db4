"""Checks that a table keeps its promises."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError
from bidscope.operators.filters import has_identity
from bidscope.operators.writes import status_rule
from bidscope.schemas import IDENTITY, STATUSES, TENDERS

#: Every tender column but ``last_status``, which older tables may lack.
REQUIRED = [name for name in TENDERS.fieldNames() if name != "last_status"]


def missing_columns(tenders: DataFrame) -> list[str]:
    return sorted(set(REQUIRED) - set(tenders.columns))


def repeated_identities(tenders: DataFrame) -> DataFrame:
    return (
        tenders.filter(has_identity())
        .groupBy(*IDENTITY)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def contract_report(tenders: DataFrame) -> DataFrame:
    """One row counting the breaches of each rule.

    Identity counts come from one shuffle of partial counts; the other rules are summed along.
    """
    breaches = {
        "without_identity": ~has_identity(),
        "unknown_status": F.coalesce(~F.col("status").isin(*STATUSES), F.lit(True)),
        "last_status_rule": F.col("status").isin(*STATUSES) & ~status_rule(),
    }
    per_identity = tenders.groupBy(*IDENTITY).agg(
        F.count("*").alias("n"), *[F.count_if(test).alias(name) for name, test in breaches.items()]
    )
    repeated = has_identity() & (F.col("n") > 1)
    return per_identity.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(repeated).alias("repeated_identities"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in breaches],
    )


def verify(tenders: DataFrame) -> bool:
    """True when all columns are present and every identity is unique; else an error."""
    missing = missing_columns(tenders)
    if missing:
        raise InvalidRowsError(f"missing columns: {', '.join(missing)}")
    if not repeated_identities(tenders).isEmpty():
        raise InvalidRowsError("some identities are repeated")
    return True
