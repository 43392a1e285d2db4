"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources
alike) and 1 (as they are). The exponent is bisected until the weights meet a target: an entropy
in bits, or a bound on how often the most repeated source is shown. The weights are then realised
with whole documents: each source is cut into blocks, each epoch takes the blocks in an order of
its own, and the last epoch stops where the token budget ends.

Sources are never collected: every bisection step is one aggregation over the table of sources. A
source of n documents has about sqrt(n) blocks of sqrt(n) documents, so neither the order of
blocks nor that of documents within one is ever a large group, whatever share a source has.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.llm.quality import word_list
from bidscope.llm.registry import query, table
from bidscope.session import staged

#: Bisection steps taken per pass over the sources: one pass tries 2 ** STEPS - 1 exponents.
STEPS = 4
PASSES = 12
#: The most repeated source may be shown this many times as often as the least repeated one.
REPEAT_LIMIT = 2.0
SEED = "mix"


def source_key(source: Column) -> Column:
    """The source as a text that is never null, so that joins keep documents without one."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def draw(*parts: Column) -> Column:
    """A pseudo-random text of 32 characters that depends on its parts alone."""
    return F.md5(F.concat_ws("|", F.lit(SEED), *[p.cast("string") for p in parts]).cast("binary"))


def _number(text: Column) -> Column:
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def unit_table(docs: DataFrame) -> DataFrame:
    """One row per source and id: its rows and tokens. Rows of one id move together."""
    rows = docs.select(
        source_key(F.col("source")).alias("source_key"),
        "doc_id",
        F.size(word_list(F.coalesce(F.col("text"), F.lit("")))).cast("long").alias("tokens"),
    )
    return rows.groupBy("source_key", "doc_id").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )


def source_table(units: DataFrame) -> DataFrame:
    """Documents and tokens per source. A source without any token weighs as one token."""
    return units.groupBy("source_key").agg(
        F.count("*").alias("docs"), F.greatest(F.sum("tokens"), F.lit(1)).alias("tokens")
    )


def _entropy(exponent: float, total: int) -> Column:
    """Bits, from the sums of w and w log w over sources of unnormalised weight w."""
    w = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent))
    return F.log2(F.sum(w)) - F.sum(w * F.log2(w)) / F.sum(w)


def _repetition(exponent: float, total: int) -> Column:
    """How many times as often the most repeated source is shown as the least repeated one."""
    w = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent - 1.0))
    return F.max(w) / F.min(w)


def find_exponent(
    sources: DataFrame, entropy: float | None = None, repeat_limit: float | None = None
) -> float:
    """The smallest exponent in [0, 1] that keeps ``repeat_limit``, or the largest that reaches
    ``entropy``; 1 where even that is out of reach, or there are no sources."""
    if (entropy is None) == (repeat_limit is None):
        raise ValueError("give either an entropy or a repetition limit")
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    measure = _entropy if repeat_limit is None else _repetition

    def meets(value: float) -> bool:
        """Both measures fall as the exponent rises."""
        return value >= entropy if repeat_limit is None else value > repeat_limit

    def values(exponents: list[float]) -> list[bool]:
        row = sources.agg(*[measure(e, total).alias(f"e{i}") for i, e in enumerate(exponents)]).first()
        return [meets(v) for v in row]

    low, high = 0.0, 1.0  # meets() holds below the answer and fails above it
    at_low, at_high = values([low, high])
    if not at_low:
        return 0.0
    if at_high:
        return 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * i / 2**STEPS for i in range(1, 2**STEPS)]
        passed = sum(values(grid))  # the measures fall, so those that hold come first
        edges = [low, *grid, high]
        low, high = edges[passed], edges[passed + 1]
    return low if repeat_limit is None else high


def weights(sources: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """weight, target_tokens, full_epochs and rest_tokens per source.

    Without a budget, it is the smallest one that shows every document at least once.
    """
    total = sources.agg(F.sum(F.pow("tokens", F.lit(exponent))), F.max(F.pow("tokens", F.lit(1.0 - exponent)))).first()
    norm = total[0] or 1.0
    weight = F.pow("tokens", F.lit(exponent)) / F.lit(norm)
    # The last digits of a product must not cost a source its last token.
    wanted = F.floor(weight * F.lit((float(budget) if budget is not None else norm * (total[1] or 1.0)) * (1 + 1e-9)))
    wanted = F.greatest(wanted, F.col("tokens")) if budget is None else wanted
    full = F.floor(wanted / F.col("tokens"))
    return sources.select(
        "*",
        weight.alias("weight"),
        wanted.cast("long").alias("target_tokens"),
        full.cast("long").alias("full_epochs"),
        (wanted - full * F.col("tokens")).cast("long").alias("rest_tokens"),
    )


def realise(units: DataFrame, weighted: DataFrame) -> DataFrame:
    """One row for each time a document is shown.

    source_key, doc_id, tokens, rows, epoch (from 0), block, block_place and place. An epoch of a
    source is read by block_place, then place. Whole epochs show every document; the last one
    takes documents in that order while they fit into the tokens that remain.
    """
    plan = weighted.select(
        "source_key",
        "full_epochs",
        "rest_tokens",
        F.greatest(F.ceil(F.sqrt("docs")), F.lit(1)).cast("long").alias("blocks"),
    )
    epochs = F.sequence(F.lit(0).cast("long"), F.col("full_epochs") - F.when(F.col("rest_tokens") > 0, 0).otherwise(1))
    some = (F.col("full_epochs") > 0) | (F.col("rest_tokens") > 0)
    shown = (
        units.join(plan.filter(some), "source_key")
        .withColumn("block", F.pmod(_number(draw(F.lit("block"), F.col("doc_id"))), "blocks"))
        .withColumn("epoch", F.explode(epochs))
        .withColumn("_turn", draw(F.col("epoch"), F.col("doc_id")))
    )
    inside = W.partitionBy("source_key", "epoch", "block").orderBy("_turn", "doc_id")
    shown = shown.withColumn("place", F.row_number().over(inside).cast("long")).withColumn(
        "_inside", F.sum("tokens").over(inside.rowsBetween(W.unboundedPreceding, 0))
    )
    blocks = shown.groupBy("source_key", "epoch", "block").agg(F.sum("tokens").alias("_tokens"))
    across = W.partitionBy("source_key", "epoch").orderBy(
        draw(F.lit("turn"), F.col("source_key"), F.col("epoch"), F.col("block")), "block"
    )
    blocks = blocks.select(
        "source_key",
        "epoch",
        "block",
        F.row_number().over(across).cast("long").alias("block_place"),
        (F.sum("_tokens").over(across.rowsBetween(W.unboundedPreceding, 0)) - F.col("_tokens")).alias("_before"),
    )
    fits = (F.col("epoch") < F.col("full_epochs")) | (F.col("_before") + F.col("_inside") <= F.col("rest_tokens"))
    return shown.join(blocks, ["source_key", "epoch", "block"]).filter(fits).select(
        "source_key", "doc_id", "tokens", "rows", "epoch", "block", "block_place", "place"
    )


def mix(
    docs: DataFrame,
    repeat_limit: float | None = REPEAT_LIMIT,
    entropy: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """Which documents to show, how often and in which order; columns as ``realise``.

    ``docs`` needs doc_id, source and text; further columns are ignored. Documents without a
    source are a source of their own; null and empty texts count no tokens and are shown like
    others. Rows of one source and id are one document: they are shown together, ``rows`` says
    how many they are. Ties have no effect, since order is drawn from ids. An empty table gives
    an empty mixture.
    """
    units = staged(unit_table(docs), "mix-units")
    sources = staged(source_table(units), "mix-sources")
    exponent = find_exponent(sources, entropy=entropy, repeat_limit=None if entropy is not None else repeat_limit)
    return realise(units, weights(sources, exponent, budget))


def mixed_documents(docs: DataFrame, **target) -> DataFrame:
    """The rows of ``docs``, each as many times as the mixture shows it, with all their columns.

    Rows without a source are a source of their own, rows without an id one document of it; null and
    empty texts are shown like others. Rows of one source and id are shown equally often, and equal
    rows each. There are no ties to break. Columns may have any name. An empty table gives an empty
    one.
    """
    rows = docs.select("doc_id", "source", "text")
    times = mix(rows, **target).groupBy("source_key", "doc_id").agg(F.count("*").alias("_times"))
    times = times.select(F.col("source_key").alias("_t_key"), F.col("doc_id").alias("_t_id"), "_times")
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), source_key(F.col("source")).alias("_key")
    )
    same = (F.col("_key") == F.col("_t_key")) & F.col("_id").eqNullSafe(F.col("_t_id"))
    return keyed.join(times, same).select(F.inline(F.array_repeat("row", F.col("_times").cast("int"))))


_DRAW = "md5('mix|' || {})"
_SQL = f"""
WITH units AS (
  SELECT coalesce('=' || source, '') AS source_key, doc_id,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS tokens
  FROM documents
), sources AS (
  SELECT source_key, count(*) AS docs, greatest(sum(tokens), 1) AS tokens FROM units GROUP BY source_key
), found AS (
  SELECT CASE WHEN max(tokens) / min(tokens) <= {REPEAT_LIMIT} THEN 0
    ELSE 1 - ln({REPEAT_LIMIT}) / ln(max(tokens) / min(tokens)) END AS e FROM sources
), normed AS (
  SELECT e, sum(pow(tokens, e)) AS norm, max(pow(tokens, 1 - e)) AS top FROM sources, found GROUP BY e
), wanted AS (
  SELECT source_key, docs, tokens, greatest(floor(pow(tokens, e) / norm * (norm * top * (1 + 1e-9))), tokens) AS target
  FROM sources, normed
), planned AS (
  SELECT source_key, CAST(ceil(sqrt(docs)) AS BIGINT) AS blocks, CAST(floor(target / tokens) AS BIGINT) AS full_epochs,
    CAST(target - floor(target / tokens) * tokens AS BIGINT) AS rest FROM wanted
), shown AS (
  SELECT source_key, doc_id, tokens, full_epochs, rest,
    CAST('0x' || substr({_DRAW.format("'block|' || doc_id")}, 1, 8) AS BIGINT) % blocks AS block,
    unnest(range(full_epochs + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch
  FROM units JOIN planned USING (source_key)
), placed AS (
  SELECT *, row_number() OVER w AS place, sum(tokens) OVER w AS inside FROM shown
  WINDOW w AS (PARTITION BY source_key, epoch, block
    ORDER BY {_DRAW.format("epoch || '|' || doc_id")} ROWS UNBOUNDED PRECEDING)
), blocks AS (
  SELECT source_key, epoch, block, row_number() OVER w AS block_place, sum(t) OVER w - t AS before
  FROM (SELECT source_key, epoch, block, sum(tokens) AS t FROM shown GROUP BY ALL)
  WINDOW w AS (PARTITION BY source_key, epoch
    ORDER BY {_DRAW.format("'turn|' || source_key || '|' || epoch || '|' || block")} ROWS UNBOUNDED PRECEDING)
)
SELECT doc_id, source_key, CAST(tokens AS BIGINT) AS tokens, epoch, block, block_place, place
FROM placed JOIN blocks USING (source_key, epoch, block)
WHERE epoch < full_epochs OR before + inside <= rest
"""


@query("op1_mixing", _SQL)
def mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source_key", "tokens", "epoch", "block", "block_place", "place")
