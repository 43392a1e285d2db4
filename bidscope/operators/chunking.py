"""Cutting text into chunks of at most ``max_tokens`` words, each citable by page and headings.

Blocks can also be cut by the tokens of a model: a counter supplied by the caller weighs each word.
"""

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.operators.embedding import WORD_BREAK
from bidscope.operators.filters import in_range
from bidscope.operators.numbering import join_on, running_totals
from bidscope.session import staged

# Most words in a chunk.
MAX_TOKENS = 512
#: Blocks of one section are totalled in runs of this many positions, one task per run.
BLOCK_RUN = 10_000


#: A letter of a word, by what WORD_BREAK leaves.
WORD = r"[^ \t\n\r]"

#: From an array of words to an array of their numbers of tokens.
Counter = Callable[[Column], Column]


def byte_tokens(found: Column) -> Column:
    """A counter that needs no model: four UTF-8 bytes a token, rounded up."""
    return F.transform(found, lambda word: F.ceil(F.octet_length(word) / 4).cast("int"))


def model_tokens(load: Callable[[], Callable[[list[str]], list[int]]]) -> Counter:
    """A counter by a tokenizer. ``load`` is called once per task, and what it returns gives the
    numbers of tokens of some words. A word that is repeated within a batch is counted once."""

    loaded = []

    def weigh(lists: pa.Array) -> pa.Array:
        if not loaded:
            loaded.append(load())
        coded = lists.flatten().dictionary_encode()
        sizes = pa.array(loaded[0](coded.dictionary.to_pylist()), type=pa.int32()).take(coded.indices)
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0)).cast(pa.int32())
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], type=pa.int32()), ends]), sizes)

    return F.arrow_udf(weigh, "array<int>")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def embedding_text(headings: Column, text: Column) -> Column:
    """What is embedded: the headings, then the text, each on its own line."""
    return F.array_join(F.concat(headings, F.array(text)), "\n")


def chunk_texts(df: DataFrame, text: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per chunk of each text, numbered from 0. Local to the row: nothing is shuffled."""
    in_range("max_tokens", max_tokens, 1)
    others = [name for name in df.columns if name != text]
    split = df.select(*others, words(F.col(text)).alias("_words")).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.size("_words") - 1, F.lit(max_tokens))
    # Cut first, then exploded: a row of the result never carries the words of the whole text.
    pieces = F.transform(starts, lambda start: F.slice(F.col("_words"), start + 1, max_tokens))
    cut = split.select(*others, F.posexplode(pieces).alias("chunk_index", "_piece"))
    return cut.select(
        *others,
        "chunk_index",
        F.array_join("_piece", " ").alias(text),
        F.size("_piece").alias("n_words"),
    )


def text_blocks(df: DataFrame, key: str, text: str, page_lines: int, headings: Column) -> DataFrame:
    """A block per line of each text, ``page_lines`` lines to a page, all in one section."""
    lines = df.select(
        F.col(key).alias("doc_id"),
        headings.alias("headings"),
        F.posexplode(F.split(text, "\n")).alias("position", "text"),
    )
    page = (F.floor(F.col("position") / page_lines) + 1).cast("int")
    return lines.select(
        "doc_id", F.lit(0).alias("section_no"), "headings", page.alias("page"), "position", "text"
    )


def chunk_blocks(blocks: DataFrame, max_tokens: int = MAX_TOKENS, counter: Counter | None = None) -> DataFrame:
    """Chunks of documents whose blocks are rows of their own, however many a document has.

    Blocks are laid end to end in each section (``section_no``, then ``position``) and cut every
    ``max_tokens`` words. Where a block begins is a running total of words, so no document is
    ever gathered: blocks meet by runs of positions, and then by the chunk they belong to. One
    pass over the text counts words per run; the counts are written down, and a second pass cuts.

    With a ``counter`` a word counts as many tokens as that says, one at least, and no chunk with its
    headings has more than ``max_tokens`` (64 or more). Cuts lie on a grid of running totals: a word
    belongs to the cell it begins in, and cells are smaller than the budget by the heaviest word. So
    that this is little, long words are taken apart, see ``short_words``; a counter may give a word
    one token more than it has bytes, and fails beyond. Headings that leave less than a quarter of
    the budget, or less than 33, are not made room for.

    Null counts as before all others in section and position, and as no headings. Blocks without
    words leave no trace.
    """
    in_range("max_tokens", max_tokens, 64 if counter else 1)
    run = ["doc_id", "section_no", "run"]
    letters = max(64, max_tokens // 2) // 16
    found = short_words if counter else lambda text, _: words(text)
    split = blocks.select(
        "doc_id",
        "section_no",
        "position",
        "page",
        F.coalesce("headings", F.array().cast("array<string>")).alias("headings"),
        found(F.col("text"), letters).alias("words"),
    ).filter(F.size("words") > 0)
    split = split.withColumn("run", F.floor(F.col("position") / BLOCK_RUN))
    if counter:
        split = _weighed(split, counter, letters)
        room = F.greatest(max_tokens - F.max("heading_tokens"), F.lit(max(max_tokens // 4, 8 * letters + 1)))
        size, last_word, cell = F.col("tokens"), F.element_at("weights", -1), room - 4 * letters
    else:
        # As one text words take a third of the room in a shuffle.
        split = split.withColumns({"size": F.size("words").cast("bigint"), "words": F.array_join("words", " ")})
        size, last_word, cell = F.col("size"), F.lit(1), F.lit(max_tokens)
    counted = split.groupBy(*run).agg(
        F.sum(size).alias("total"),
        F.max(F.struct("position", last_word.alias("weight"))).alias("last"),
        cell.cast("bigint").alias("cell"),
    )
    starts = _run_starts(staged(counted, "words-per-run"))
    # Where a run starts is a row before its blocks, not a join: the text moves once for both.
    met = split.withColumn("_block", F.lit(True)).unionByName(starts.withColumn("_block", F.lit(False)), allowMissingColumns=True)
    inside = W.partitionBy(*run).orderBy("_block", "position").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(inside), F.lit(0))
    placed = met.withColumns({"_before": before, **{c: F.first(c).over(inside) for c in ("run_begin", "first_part", "cell")}})
    placed = placed.filter("_block").withColumn("begin", F.col("run_begin") + F.col("_before"))
    # The words of a block that fall into a part are cut out before rows are made, so that a long
    # block is not copied for each of its parts.
    if counter:
        placed = placed.withColumn("cuts", _cuts())
        shares = F.transform("cuts", _share_of_cut)
    else:
        end = F.col("begin") + size
        first, last = F.floor(F.col("begin") / max_tokens), F.floor((end - 1) / max_tokens)

        # A part starts ``offset`` words in.
        def share(found: Column, part: Column) -> Column:
            offset = part * max_tokens - F.col("begin")
            skip = F.greatest(offset, F.lit(0))
            cut = F.slice(found, (skip + 1).cast("int"), (offset + max_tokens - skip).cast("int"))
            return F.struct(part.alias("part"), F.array_join(cut, " ").alias("cut"))

        # The words are the variable of a lambda: named there, they would be split for each part.
        split_words = F.array(F.split("words", " "))
        shares = F.transform(split_words, lambda found: F.transform(F.sequence(first, last), lambda part: share(found, part)))[0]
    others = ["doc_id", "section_no", "first_part", "position", "page", "headings"]
    pieces = placed.select(*others, F.explode(shares).alias("share")).select(*others, "share.*")
    text = F.array_join(F.flatten("taken.words") if counter else F.col("taken.words"), " ")
    return (
        pieces.groupBy("doc_id", "section_no", "first_part", "part")
        .agg(
            F.sort_array(F.collect_list(F.struct("position", F.col("cut").alias("words")))).alias("taken"),
            F.array_sort(F.collect_set("page")).alias("page_numbers"),
            F.first("headings").alias("heading_path"),
        )
        .select(
            "doc_id",
            (F.col("first_part") + F.col("part")).cast("int").alias("chunk_index"),
            text.alias("text"),
            embedding_text(F.col("heading_path"), text).alias("embedding_text"),
            "page_numbers",
            "heading_path",
        )
    )


def short_words(text: Column, letters: int) -> Column:
    """Words of at most 4 * ``letters`` bytes. A word stays whole if it has at most ``letters`` letters,
    or twice as many below U+0800, or four times as many of ASCII; others are cut every ``letters``."""
    kinds = [r"\u0800-\x{10FFFF}", r"\x{80}-\x{10FFFF}"]
    whole = [f"(?<!{WORD}){WORD[:-1]}{kind}]{{1,{2 * (n + 1) * letters}}}(?!{WORD})" for n, kind in enumerate(kinds)]
    # No lambda: Spark does not run a Python function over what has one.
    return F.regexp_extract_all(text, F.lit("|".join([*whole, f"{WORD}{{1,{letters}}}"])), F.lit(0))


def _weighed(split: DataFrame, counter: Counter, letters: int) -> DataFrame:
    """With ``weights`` of words, their sum ``tokens``, and ``heading_tokens``."""
    heaviest = 4 * letters + 1
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda sum_, n: sum_ + n)
    at_least_one = lambda c: F.transform(c, lambda n: F.greatest(n, F.lit(1)))
    heading_words = short_words(F.array_join("headings", "\n"), letters)
    split = split.withColumns({"_words": counter(F.col("words")), "_headings": counter(heading_words)})
    most = F.array_max("_words")
    too_heavy = F.raise_error(F.concat(F.lit("too many tokens for a short word: "), most.cast("string")))
    weights = F.when(most > heaviest, too_heavy).otherwise(at_least_one(F.col("_words")))
    split = split.withColumn("weights", weights)
    return split.withColumns({"tokens": total("weights"), "heading_tokens": total(at_least_one(F.col("_headings")))})


def _cuts() -> Column:
    """Where a block's words enter another cell: struct(from, part), from 0."""
    cuts = "array<struct<from:int,part:bigint>>"

    def step(s: Column, weight: Column) -> Column:
        part = F.floor(s["at"] / F.col("cell"))
        entered = F.array(F.struct(s["k"].alias("from"), part.alias("part")))
        return F.struct(
            (s["at"] + weight).alias("at"),
            (s["k"] + 1).alias("k"),
            part.alias("part"),
            F.when(part == s["part"], s["cuts"]).otherwise(F.concat(s["cuts"], entered)).alias("cuts"),
        )

    state = F.struct(
        F.col("begin").alias("at"),
        F.lit(0).alias("k"),
        F.lit(-1).cast("bigint").alias("part"),
        F.array().cast(cuts).alias("cuts"),
    )
    return F.aggregate("weights", state, step, lambda s: s["cuts"])


def _share_of_cut(cut: Column, nth: Column) -> Column:
    end = F.coalesce(F.get(F.col("cuts"), nth + 1)["from"], F.size("words"))
    return F.struct(cut["part"].alias("part"), F.slice("words", cut["from"] + 1, end - cut["from"]).alias("cut"))


def _run_starts(counts: DataFrame) -> DataFrame:
    """Per run: what its section holds before it, the parts of all sections before that, and the
    section's ``cell``. The last part of a section is the one its last word begins in."""
    section = ["doc_id", "section_no"]
    sections = counts.groupBy(*section).agg(
        F.sum("total").alias("total"),
        F.max(F.struct("run", "last.weight"))["weight"].alias("last_word"),
        F.min("cell").alias("cell"),
    )
    parts = F.floor((F.col("total") - F.col("last_word")) / F.col("cell")) + 1
    numbered = running_totals(
        sections, ["doc_id"], F.floor(F.col("section_no") / BLOCK_RUN), ["section_no"], first_part=parts
    )
    earlier = W.partitionBy(*section).orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    begun = counts.drop("cell").withColumn("run_begin", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    placed = join_on(begun, numbered.select(*section, "first_part", "cell"), section)
    return placed.select(*section, "run", "run_begin", "first_part", "cell")


def chunk_sections(sections: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Chunks of one converted file, as an array; local to the row.

    ``sections`` is an array of struct(headings, pieces array of struct(page, text)). Every step
    is a transform of its own: what a lambda names twice, Spark would compute twice.
    """

    def paged(section: Column) -> Column:
        pieces = F.transform(
            section["pieces"],
            lambda piece: F.struct(words(piece["text"]).alias("words"), piece["page"].alias("page")),
        )
        return F.struct(section["headings"].alias("headings"), pieces.alias("pieces"))

    # Two arrays, not one of pairs: no object for each word.
    def tokens(section: Column) -> Column:
        pages = F.transform(section["pieces"], lambda piece: F.array_repeat(piece["page"], F.size(piece["words"])))
        return F.struct(
            section["headings"].alias("headings"),
            F.flatten(section["pieces"]["words"]).alias("words"),
            F.flatten(pages).alias("pages"),
        )

    def cut(section: Column) -> Column:
        size = F.size(section["words"])
        starts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(max_tokens)))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda start: F.struct(
                section["headings"].alias("headings"),
                F.slice(section["words"], start, max_tokens).alias("words"),
                F.slice(section["pages"], start, max_tokens).alias("pages"),
            ),
        )

    def join(chunk: Column) -> Column:
        return F.struct(
            F.array_join(chunk["words"], " ").alias("text"),
            F.array_sort(F.array_distinct(chunk["pages"])).alias("page_numbers"),
            chunk["headings"].alias("headings"),
        )

    def finish(chunk: Column, index: Column) -> Column:
        return F.struct(
            index.alias("chunk_index"),
            chunk["text"].alias("text"),
            embedding_text(chunk["headings"], chunk["text"]).alias("embedding_text"),
            chunk["page_numbers"].alias("page_numbers"),
            chunk["headings"].alias("heading_path"),
        )

    cuts = F.flatten(F.transform(F.transform(F.transform(sections, paged), tokens), cut))
    return F.transform(F.transform(cuts, join), finish)
