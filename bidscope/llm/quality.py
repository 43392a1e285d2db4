"""Line-first cleaning: judge every line, drop the failing ones, then judge what is left.

All of it is one narrow projection over the documents: nothing is shuffled, and a text is worked
on as an array of its words or lines, in time that grows with its length times its logarithm.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.registry import query, table

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A line holds a sentence if one of these, closing quotes and brackets aside, ends it or a part.
ENDS = r"""[.!?;:…。！？]["'”’»)\]]*([\x20\x09-\x0D]|$)"""
#: Fixed phrases of licences, notices and site furniture.
BOILERPLATE = (
    r"(?i)(licensed under|released under|all rights reserved|copyright \(c\)|©|terms of (use|service)"
    r"|privacy policy|cookie (policy|settings)|uses? cookies|enable javascript|lorem ipsum"
    r"|sign up for our newsletter|subscribe now|click here to)"
)
#: A line of this many words or fewer may do without an end mark (headings, list items).
SHORT_LINE = 4
MAX_SYMBOL_SHARE = 0.1
MAX_SHOUTS = 0.5
MAX_LOST = 0.6


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def line_passes(line: Column) -> Column:
    """Whether a line survives: punctuation, navigation and boilerplate rules."""
    n_words = F.size(word_list(line))
    ends = line.rlike(ENDS) | (n_words <= SHORT_LINE)
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) <= F.length(line) * MAX_SYMBOL_SHARE
    shouts = F.regexp_count(line, F.lit("[!?]{2}")) <= n_words * MAX_SHOUTS
    bars = F.regexp_count(line, F.lit(r"[|»>]")) < F.greatest(F.lit(2.0), n_words * 0.2)
    return ends & symbols & shouts & bars & ~line.rlike(BOILERPLATE)


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, WORD_BREAK, "")).cast("long")


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures, ``cleaned`` (the text without the lines that fail) and ``kept`` to each row.

    Base measures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; ``base_failed``
    where there are under 10 words or over a fifth of them repeat. ``lost`` is the share of word
    characters in lines that fail. A document is kept if it did not fail the base and lost at most
    ``MAX_LOST``. Null and empty texts have no words and are rejected; repeated rows are judged each for
    itself. Columns of the input named like an added one are replaced. Repeated five-word windows
    are found by 64-bit hashes within one text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    row = F.struct(*[F.col(c) for c in docs.columns])
    df = docs.select(row.alias("_row"), whole.alias("_text"))
    df = df.select("*", word_list(F.col("_text")).alias("_words"), F.split("_text", "\n").alias("_all_lines"))
    df = df.select(
        "_row",
        "_text",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        "_all_lines",
        F.filter("_all_lines", _has_word).alias("_lines"),
    )

    def window(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 5),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)]),
        )

    none = F.array().cast("array<bigint>")
    hashes = F.col("_hashes")
    df = df.select(
        "_row",
        "_text",
        "n_words",
        "word_chars",
        "_lines",
        F.when(F.col("n_words") >= 5, window(hashes)).otherwise(none).alias("_windows"),
        F.size("_all_lines").alias("_n_lines"),
        F.filter("_all_lines", lambda line: ~_has_word(line) | line_passes(line)).alias("_good"),
    )
    windows = F.col("_windows")
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.select("*", F.when(repeats, pairs).alias("_pairs"))
    pairs = F.col("_pairs")

    def again(pair: Column, k: Column) -> Column:
        return (pair["h"] == F.get(pairs, k - 1)["h"]) | (pair["h"] == F.get(pairs, k + 1)["h"])

    twice = F.filter(pairs, lambda pair, k: F.coalesce(again(pair, k), F.lit(False)))
    df = df.select("*", F.sort_array(F.transform(twice, lambda pair: pair["i"])).alias("_places"))
    places = F.col("_places")
    covered = F.aggregate(
        F.transform(places, lambda at, k: F.least(F.lit(5), F.coalesce(F.get(places, k + 1) - at, F.lit(5)))),
        F.lit(0).cast("long"),
        lambda total, step: total + step,
    )
    df = df.select(
        "_row",
        "n_words",
        "word_chars",
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.col("_n_lines") - F.size("_good")).cast("long").alias("n_lines_dropped"),
        F.array_join("_good", "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = _word_chars(F.col("cleaned"))
    df = df.withColumns(
        {
            "base_failed": failed,
            "lost": F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(1.0)),
        }
    ).withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST))
    added = [c for c in df.columns if c != "_row"]
    return df.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in added], *added)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their cleaned text, and ``n_chars`` where there is one.

    The rows leave through a generator: a filter would be moved below the projections, and every
    measure would be worked out again inside it.
    """
    text = F.col("cleaned")
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    judged = judge(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    row = F.struct(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
    return judged.select(F.inline(F.when(F.col("kept"), F.array(row))))


_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), lined AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs
), base AS (
  SELECT doc_id, t, words, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM lined
), grams AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM base WHERE n_words >= 5
), named AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM grams
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM named) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(following - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM twice) GROUP BY doc_id
), judged AS (
  SELECT doc_id, l, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
  FROM (SELECT doc_id, unnest(lines) AS l FROM base)
), good AS (
  SELECT doc_id, sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) AS left_chars, count(*) AS n_good
  FROM judged WHERE (n <= 4 OR regexp_matches(l, '[.!?;:…。！？]["''”’»)\]]*([\x20\x09-\x0D]|$)'))
    AND len(regexp_extract_all(l, '[#*$%&|<>]')) <= length(l) * 0.1
    AND len(regexp_extract_all(l, '[!?]{2}')) <= n * 0.5
    AND len(regexp_extract_all(l, '[|»>]')) < greatest(2.0, n * 0.2)
    AND NOT regexp_matches(l, '(?i)(licensed under|released under|all rights reserved|copyright \(c\)|©|terms of (use|service)|privacy policy|cookie (policy|settings)|uses? cookies|enable javascript|lorem ipsum|sign up for our newsletter|subscribe now|click here to)')
  GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) - coalesce(n_good, 0) AS BIGINT) AS n_lines_dropped,
    CASE WHEN word_chars > 0 THEN 1 - coalesce(left_chars, 0) / word_chars ELSE 1 END AS lost
  FROM base LEFT JOIN covered USING (doc_id) LEFT JOIN good USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_dropped,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost <= 0.6 AS kept
FROM measured
"""


@query("op4_quality_rules", _SQL)
def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines_dropped",
        "base_failed",
        "kept",
    )
