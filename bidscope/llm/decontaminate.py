"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a benchmark item when tiles, runs of words that both share, cover
enough of the item. Tiles are marked longest first and never overlap, so the order of passages in
the document does not matter.

1. Every ``MIN_TILE`` words in a row of an item are a seed. A bitmap of fixed size holds all seeds.
2. Each document keeps only the stretches of words whose seeds are in the bitmap, as one row per
   stretch: what is shuffled follows the overlap with the benchmark, not the size of the corpus.
3. Stretches meet items by equality of seeds. A tile of n words holds n - 4 of the item's seed
   places, at least a fifth of n, so a leak shares a known least number k of them: of an item's m
   places, only the m - k + 1 rarest create pairs. A phrase that very many documents and items
   share creates none.
4. Tiles lie within the words that shared seed places cover. Pairs in which these are too few are
   dropped before any text is joined; the others are tiled.

Words are compared in lower case and without ASCII punctuation around them, by 64-bit hash.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm import bitmap
from bidscope.llm.registry import query, table
from bidscope.llm.words import constants, each, powers, windows
from bidscope.session import staged

#: Words of a seed, and of the shortest tile.
MIN_TILE = 5
#: Tile length that the first search asks for; later searches halve it.
FIRST_TILE = 40
#: Share of an item's words that tiles must cover.
COVERAGE = 0.6

_LONGS = T.ArrayType(T.LongType())
STRETCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("words", _LONGS),
        T.StructField("seeds", _LONGS),
    ]
)
ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("words", _LONGS), T.StructField("seeds", _LONGS)]
)
_BASE = int(constants(1, 21)[0])


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _seeds(w) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of MIN_TILE words of one text, and the window's first word."""
    h = windows(w.hash, MIN_TILE, 22)
    first = np.flatnonzero(w.doc[: len(h)] == w.doc[MIN_TILE - 1 :]) if len(h) else np.zeros(0, dtype=int)
    return h[first], first


def _items(batches):
    for batch in batches:
        for lo, _, w in each(batch.column(1), trim=True):
            h, first = _seeds(w)
            at = np.searchsorted(first, w.first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, w.texts),
                    _lists([w.hash[w.first[k] : w.first[k + 1]] for k in range(w.texts)]),
                    _lists([h[at[k] : at[k + 1]] for k in range(w.texts)]),
                ],
                names=ITEMS.names,
            )


def _stretches(held: np.ndarray):
    def run(batches):
        for batch in batches:
            for lo, _, w in each(batch.column(2), trim=True):
                h, first = _seeds(w)
                hit = bitmap.holds(held, h.view(np.int64))
                h, first = h[hit], first[hit]
                if not len(h):
                    continue
                new = np.ones(len(h), dtype=bool)
                new[1:] = (first[1:] > first[:-1] + MIN_TILE) | (w.doc[first[1:]] != w.doc[first[:-1]])
                begin = np.flatnonzero(new)
                bounds = np.append(begin, len(h))
                heads, tails = first[begin], first[bounds[1:] - 1] + MIN_TILE
                rows = pa.array(w.doc[heads] + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(heads - w.first[w.doc[heads]], type=pa.int64()),
                        _lists([w.hash[a:b] for a, b in zip(heads, tails)]),
                        _lists([h[a:b] for a, b in zip(bounds[:-1], bounds[1:])]),
                    ],
                    names=STRETCHES.names,
                )

    return run


def _rolling(sums: np.ndarray, inverse: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` words, from running sums."""
    return (sums[size:] - sums[:-size]) * inverse[: len(sums) - size]


def _sums(words: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(_BASE, len(words)), out=sums[1:])
    return sums


def tile(text: np.ndarray, item: np.ndarray, shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (place in text, in item, length).

    Each search takes a length, hashes all unmarked windows of that length in a running way, and
    marks matches that do not overlap, longest first. A match over twice as long as asked for
    begins the search again at its own length; otherwise the length is halved down to the least.
    """
    with np.errstate(over="ignore"):
        sums_t, sums_i = _sums(text), _sums(item)
        inverse = powers(pow(_BASE, -1, 1 << 64), max(len(text), len(item)) + 1)
        free_t, free_i = np.ones(len(text), dtype=bool), np.ones(len(item), dtype=bool)
        tiles, size = [], max(shortest, min(FIRST_TILE, len(item), len(text)))
        while size >= shortest:
            longest = 0
            queues = defaultdict(list)
            if len(text) >= size and len(item) >= size:
                used_t = np.concatenate([[0], np.cumsum(~free_t)])
                used_i = np.concatenate([[0], np.cumsum(~free_i)])
                open_t = np.flatnonzero(used_t[size:] == used_t[:-size])
                open_i = np.flatnonzero(used_i[size:] == used_i[:-size])
                table = defaultdict(list)
                for place, value in zip(open_t.tolist(), _rolling(sums_t, inverse, size)[open_t].tolist()):
                    table[value].append(place)
                hashes = _rolling(sums_i, inverse, size)[open_i].tolist()
                for p, value in zip(open_i.tolist(), hashes):
                    for t in table.get(value, ()):
                        if p and t and free_i[p - 1] and free_t[t - 1] and item[p - 1] == text[t - 1]:
                            continue  # part of the match that begins one word earlier
                        if not np.array_equal(item[p : p + size], text[t : t + size]):
                            continue
                        n = size
                        while (
                            p + n < len(item)
                            and t + n < len(text)
                            and free_i[p + n]
                            and free_t[t + n]
                            and item[p + n] == text[t + n]
                        ):
                            n += 1
                        queues[n].append((t, p))
                        longest = max(longest, n)
            if longest > 2 * size:
                size = longest
                continue
            while queues:
                n = max(queues)
                for t, p in queues.pop(n):
                    if free_t[t : t + n].all() and free_i[p : p + n].all():
                        free_t[t : t + n] = free_i[p : p + n] = False
                        tiles.append((t, p, n))
                        continue
                    # What an earlier tile left of the match is a shorter match.
                    both = np.concatenate([[False], free_t[t : t + n] & free_i[p : p + n], [False]])
                    edges = np.flatnonzero(both[1:] != both[:-1])
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        if b - a >= size:
                            queues[b - a].append((t + a, p + a))
            size = size // 2 if size > 2 * shortest else shortest if size > shortest else 0
    return tiles


def _tile_pairs(batches):
    """Rows (…, stretches, item words): how much of the item the tiles cover."""
    for batch in batches:
        stretches, items = batch.column("stretches"), batch.column("words")
        covered, tiles = np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
        for k in range(len(items)):
            parts = []
            for x in sorted(stretches[k].as_py(), key=lambda x: x["at"]):
                # A break of its own after each stretch: no item has a word with this hash.
                parts += [np.array(x["words"], dtype=np.int64), np.zeros(1, dtype=np.int64)]
            item = items[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            found = tile(np.concatenate(parts).view(np.uint64), item)
            covered[k], tiles[k] = sum(n for _, _, n in found), len(found)
        keys = [batch.column(c) for c in ("doc_id", "text_hash", "item_id", "item_words")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(covered), pa.array(tiles)],
            names=["doc_id", "text_hash", "item_id", "item_words", "covered_words", "n_tiles"],
        )


def possible_pairs(seeds: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """doc_id, text_hash and _item of pairs whose shared seeds cover enough words of the item.

    ``seeds`` has the distinct seeds of documents that items hold too. Nothing that tiling would
    find is left out.
    """
    size = F.size("words")
    # Of W words a leak covers ceil(coverage * W), each tile of n words with at least n / 5 places.
    least = F.greatest(F.ceil(F.ceil(F.lit(coverage) * size) / MIN_TILE), F.lit(1))
    places = items.select("_item", least.alias("k"), size.alias("n_words"), F.posexplode("seeds").alias("place", "seed"))
    places = staged(places.distinct(), "places")  # equal items are one
    often = seeds.groupBy("seed").agg(F.count("*").alias("n_docs"))
    ranked = places.join(often, "seed", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    rarest = W.partitionBy("_item").orderBy("n_docs", "seed", "place")
    ranked = ranked.withColumns({"rank": F.row_number().over(rarest), "m": F.count("*").over(W.partitionBy("_item"))})
    first = ranked.filter((F.col("rank") <= F.col("m") - F.col("k") + 1) & (F.col("n_docs") > 0))
    pairs = seeds.join(first.select("seed", "_item").distinct(), "seed").select("doc_id", "text_hash", "_item").distinct()
    held = seeds.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "seed": "_seed"})
    wanted = pairs.join(places, "_item")
    same = (F.col("seed") == F.col("_seed")) & (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    shared = wanted.join(held, same, "left_semi").groupBy("doc_id", "text_hash", "_item")
    shared = shared.agg(F.sort_array(F.collect_list("place")).alias("at"), F.max("n_words").alias("n_words"))
    steps = F.transform("at", lambda p, i: F.least(F.lit(MIN_TILE), F.coalesce(F.get("at", i + 1) - p, F.lit(MIN_TILE))))
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    return shared.filter(covered >= F.lit(coverage) * F.col("n_words")).select("doc_id", "text_hash", "_item")


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, text_hash, item_id, item_words, covered_words and n_tiles of contaminated documents.

    One row for each pair of a document and an item of which tiles of at least ``MIN_TILE`` words
    cover ``coverage`` or more. ``docs`` needs doc_id and text, ``benchmark`` item_id and text;
    other columns are ignored. A document is its id and its text: equal rows are one document, rows
    of one id with other texts are others, a null id is a value like any other. Items with the same
    id are items of their own. Null and empty texts, and items of fewer than ``MIN_TILE`` words,
    match nothing. Ties between equally long matches go to the first in the item. An empty table on
    either side gives an empty result.
    """
    items = benchmark.select("item_id", F.lower("text").alias("text")).mapInArrow(_items, ITEMS)
    items = staged(items, "items").withColumn("_item", F.xxhash64("item_id", "words"))
    seeds = items.select("_item", F.explode("seeds").alias("seed")).distinct()
    held = bitmap.build(seeds.select("seed"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lower("text").alias("text"))
    stretches = staged(keyed.mapInArrow(_stretches(held), STRETCHES).distinct(), "stretches")
    key = ["doc_id", "text_hash"]
    pairs = possible_pairs(stretches.select(*key, F.explode("seeds").alias("seed")).distinct(), items, coverage)
    found = stretches.groupBy(*key).agg(F.collect_list(F.struct("at", "words")).alias("stretches"))
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    meet = (pairs["text_hash"] == F.col("_hash")) & pairs["doc_id"].eqNullSafe(F.col("_id"))
    full = pairs.join(found, meet).join(items, "_item").withColumn("item_words", F.size("words").cast("long"))
    schema = "doc_id long, text_hash long, item_id long, item_words long, covered_words long, n_tiles long"
    tiled = full.select(*key, "item_id", "item_words", "stretches", "words").mapInArrow(_tile_pairs, schema)
    return tiled.filter(F.col("covered_words") >= F.lit(coverage) * F.col("item_words"))


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns.

    Rows are told by id and text, as in ``contamination``: equal rows stay or go together, rows of
    one id with different texts are judged each for itself, a null id is a value like any other.
    Null and empty texts stay. Columns may have any name. An empty table gives an empty one.
    """
    found = contamination(docs.select("doc_id", "text"), benchmark, coverage).select("doc_id", "text_hash").distinct()
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_doc_id"), F.xxhash64("text").alias("_text_hash")
    )
    same = (F.col("_text_hash") == F.col("_hash")) & F.col("_doc_id").eqNullSafe(F.col("_id"))
    return rows.join(found, same, "left_anti").select("row.*")


@query("op2_decontamination")
def decontamination(spark, sf_dir):
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return contamination(docs, benchmark).select(
        "doc_id", "item_id", "item_words", "covered_words", "n_tiles", F.lit(True).alias("contaminated")
    )
