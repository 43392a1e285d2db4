"""Connected components of a large graph by alternating large and small stars.

Each round hangs nodes under the smallest node they can see; the number of rounds grows with the
logarithm of the longest path. Edges and labels stay in tables, only a count and a checksum of the
edges come to the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.session import staged


def _least(both: DataFrame) -> DataFrame:
    """Every directed edge with the smallest node among its tail and the tail's neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from a node to a smaller one here."""
    hung = _least(edges)
    others = hung.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(hung.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 30))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every node of ``links`` (two bigint columns): its component's smallest id.

    Links may repeat, point either way or from a node to itself.
    """
    a, b = links.columns
    edges = staged(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_small_star(_large_star(edges).distinct()), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).union(
        edges.select("v", "v").distinct()
    )
