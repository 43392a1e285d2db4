"""Running totals and dense numbers that no single task has to compute alone."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.session import staged


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of all keys in which null equals null; ``right`` has them with a dash before."""
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[f"-{k}"]) for k in keys])


def join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys that may be null; columns of the left side, then the right one's rest."""
    renamed = right.withColumnsRenamed({k: f"-{k}" for k in keys})
    return left.join(renamed, same_keys(left, renamed, keys)).drop(*[f"-{k}" for k in keys])


def running_totals(
    df: DataFrame, keys: list[str], bucket: Column, order: list[str], **values: Column
) -> DataFrame:
    """Add one column per value: its sum over the rows before this one, within ``keys``.

    Rows are taken in the order of ``bucket``, then ``order``; a bucket should cover a bounded
    number of rows. Totals per bucket are combined map-side; only those totals are scanned in
    order across a whole group, and rows are ordered only inside their bucket. So a group that
    holds a third of the table is spread over as many tasks as it has buckets. Null keys are a
    group, and null buckets the first one of their group.
    """
    rows = df.withColumns({"_bucket": bucket, **{f"_{name}": v for name, v in values.items()}})
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in values])
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(f"_{name}").over(window), F.lit(0).cast("bigint"))

    starts = totals.select(*keys, "_bucket", *[before(n, earlier).alias(f"_start_{n}") for n in values])
    inner = rows.withColumns({f"_in_{n}": before(n, inside) for n in values})
    return join_on(inner, starts, [*keys, "_bucket"]).select(
        *df.columns, *[(F.col(f"_start_{n}") + F.col(f"_in_{n}")).alias(n) for n in values]
    )


def totals_before(df: DataFrame, order: list[str], **values: Column) -> DataFrame:
    """Add ``rows_before`` and one column per value: sums over all rows before, in ``order``.

    Rows are dealt into ranges of equal size and written down in order, so that each range knows
    its rows and its totals; one row per *range* is then scanned in order, and rows are summed
    only within their range. The order columns may be of any type and null, null first; they
    should tell rows apart, or many equal ones share a range.
    """
    ranges = (
        df.withColumns({f"_{name}": value for name, value in values.items()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_range": F.spark_partition_id(),
                # The lower 33 bits count the rows of a partition.
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    rows = staged(ranges, "ranges")
    sums = rows.groupBy("_range").agg(
        F.count("*").alias("_rows"), *[F.sum(f"_{n}").alias(f"_total_{n}") for n in values]
    )
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("_range").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0).cast("bigint"))

    starts = sums.select(
        "_range",
        before("_rows", earlier).alias("_start"),
        *[before(f"_total_{n}", earlier).alias(f"_start_{n}") for n in values],
    )
    inner = rows.withColumns({f"_in_{n}": before(f"_{n}", inside) for n in values})
    return inner.join(starts, "_range").select(
        *df.columns,
        (F.col("_start") + F.col("_row")).alias("rows_before"),
        *[(F.col(f"_start_{n}") + F.col(f"_in_{n}")).alias(n) for n in values],
    )


def dense_ids(df: DataFrame, order: list[str], start: Column, name: str = "id") -> DataFrame:
    """Number the rows ``start + 1, start + 2, …`` in ``order``."""
    numbered = totals_before(df, order)
    return numbered.withColumn(name, start + F.col("rows_before") + 1).drop("rows_before")
