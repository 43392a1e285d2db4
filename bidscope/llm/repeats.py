"""Removal of long byte strings that occur more than once, by expansion of suffix-array intervals.

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes. Strings never
cross documents, and all are judged on the input.

Equal strings must meet in one task, and no task may hold an unbounded group:

1. A string's anchor is the least of the hashes of its substrings of half its length. Equal
   strings have equal anchors at the same place in them, and neighbouring starts mostly share one.
   A window is an anchor with all starts that have it. Windows of unique anchors are done with.
2. Equal windows are counted, not collected: all starts of a window that occurs twice repeat.
3. Different windows of one anchor are cut into pieces of ``PIECE`` starts. The bytes common to all
   strings of a piece are its core; pieces of unique cores are done with, and equal pieces counted.
4. Different pieces of one core are near the end of a repeat. Bundles of them are sorted as one
   text, and interval expansion on its Burrows-Wheeler transform finds the starts that repeat.
5. A core of more than ``HOT`` pieces (a passage that many documents share, each time followed by
   something else) is cut further into single starts, which need only be counted.

Anchors, cores and counts use two independent 64-bit hashes.

Passages of words are found in the same way: a text's words become a string of two bytes each, from
their hashes, and a passage of more than ``PASSAGE`` words that occurs again is a repeated string of
that. They are reported, not removed: a passage may be shorter than ``LENGTH`` bytes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import bitmap
from bidscope.llm.registry import query, table
from bidscope.llm.words import constants, each, mix, powers, raw, slices
from bidscope.session import scratch_path, staged

LENGTH = 400
#: Passages of more than this many words that occur again are reported.
PASSAGE = 50
#: Bytes of the code of a word, and words whose least hash is the anchor of a passage.
CODE = 2
CODE_WORDS = 8
PIECE = 16
HOT = 512
#: Parts that the rows of a crowded key are dealt into.
SALTS = 64
#: Bytes sorted together in step 4, rounded up to whole cores.
BLOCK_BYTES = 1 << 18
#: Bits of the bitmaps that thin out rows before shuffles.
BITS = 26

_TABLES = [constants(256, 41), constants(256, 42)]
_BASES = [int(b) for b in constants(2, 43)]

ANCHORS = "doc_id long, text_hash long, key long, win long, start int, offset int, starts int"
PIECES = "doc_id long, text_hash long, key long, win long, start int, starts int, weight long"
WINDOWS = "doc_id long, text_hash long, key long, start int, starts int, weight long, bytes binary"
SPANS = "doc_id long, text_hash long, begin long, end long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


class Hashes:
    """Hashes of any substrings of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            self.sums = [np.zeros(n + 1, dtype=np.uint64) for _ in _BASES]
            for sums, numbers, base in zip(self.sums, _TABLES, _BASES):
                np.cumsum(numbers[data] * powers(base, n), out=sums[1:])
        self.inverse = [powers(pow(base, -1, 1 << 64), n + 1) for base in _BASES]

    def of(self, lane: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[lane]
        with np.errstate(over="ignore"):
            return mix((sums[end] - sums[begin]) * self.inverse[lane][begin] + (end - begin).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, from least values before and after block ends."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _anchors(length: int, part: int):
    width = length - part + 1

    def run(batches):
        for batch in batches:
            data, offsets = raw(batch.column(2))
            for lo, hi in slices(offsets):
                bounds = offsets[lo : hi + 1] - offsets[lo]
                text = data[offsets[lo] : offsets[hi]]
                if len(text) < length:
                    continue
                hashes = Hashes(text)
                begin = np.arange(len(text) - part + 1)
                grams = hashes.of(0, begin, begin + part)
                # Of equal hashes the first one counts, as it does in every equal string.
                ranked = (grams >> np.uint64(32) << np.uint64(32)) | begin.astype(np.uint64)
                anchor = (_least(ranked, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
                valid = np.arange(len(anchor)) + length <= bounds[doc + 1]
                new = valid.copy()
                new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                last = valid.copy()
                last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                first, last = np.flatnonzero(new), np.flatnonzero(last)
                if not len(first):
                    continue
                at, home = anchor[first], doc[first]
                rows = pa.array(home + lo)
                with np.errstate(over="ignore"):
                    whole = mix(hashes.of(1, first, last + length) + (at - first).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(grams[at].view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array((first - bounds[home]).astype(np.int32)),
                        pa.array((at - first).astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                    ],
                    names=_names(ANCHORS),
                )

    return run


def _listed(batch, column: str) -> tuple[np.ndarray, dict]:
    """Row numbers and fields of the structs in a column of lists."""
    lists = batch.column(column)
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return rows, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def _per_slice(batch):
    """(hashes, bytes, first listed row, last, rows, fields moved to the slice) of every slice."""
    data, offsets = raw(batch.column("text"))
    rows, fields = _listed(batch, "rows")
    for lo, hi in slices(offsets):
        a, b = np.searchsorted(rows, [lo, hi])
        if a < b:
            text = data[offsets[lo] : offsets[hi]]
            part = {name: values[a:b] for name, values in fields.items()}
            yield text, rows[a:b], (offsets[:-1][rows[a:b]] - offsets[lo]), part


def _pieces(length: int):
    """Windows to pieces: starts whose distance to the anchor falls into one step of PIECE."""

    def run(batches):
        for batch in batches:
            for text, rows, base, f in _per_slice(batch):
                hashes = Hashes(text)
                nearest = f["offset"].astype(np.int64) - f["starts"] + 1  # distance of the last start
                low, high = nearest // PIECE, f["offset"] // PIECE
                times = (high - low + 1).astype(np.int64)
                row = np.repeat(np.arange(len(low)), times)
                step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + low[row]
                anchor = base[row] + f["start"][row] + f["offset"][row]
                far = np.minimum(step * PIECE + PIECE - 1, f["offset"][row])
                near = np.maximum(step * PIECE, nearest[row])
                first, last = anchor - far, anchor - near
                with np.errstate(over="ignore"):
                    core = hashes.of(0, anchor - step * PIECE, anchor - step * PIECE - PIECE + 1 + length)
                    core = mix(core + step.astype(np.uint64))
                    whole = mix(hashes.of(1, first, last + length) + (anchor - first).astype(np.uint64))
                home = pa.array(rows[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(home),
                        batch.column("text_hash").take(home),
                        pa.array(core.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array((first - base[row]).astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array(f["weight"][row].astype(np.int64)),
                    ],
                    names=_names(PIECES),
                )

    return run


def _single(length: int):
    """Pieces to single starts, each with the hashes of its whole string."""

    def run(batches):
        for batch in batches:
            for text, rows, base, f in _per_slice(batch):
                hashes = Hashes(text)
                times = f["starts"].astype(np.int64)
                row = np.repeat(np.arange(len(times)), times)
                begin = base[row] + f["start"][row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                home = pa.array(rows[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(home),
                        batch.column("text_hash").take(home),
                        pa.array(hashes.of(0, begin, begin + length).view(np.int64)),
                        pa.array(hashes.of(1, begin, begin + length).view(np.int64)),
                        pa.array((begin - base[row]).astype(np.int32)),
                        pa.array(np.ones(len(row), dtype=np.int32)),
                        pa.array(f["weight"][row].astype(np.int64)),
                    ],
                    names=_names(PIECES),
                )

    return run


def _windows(length: int):
    """Pieces with their bytes."""

    def run(batches):
        for batch in batches:
            for text, rows, base, f in _per_slice(batch):
                begin = base + f["start"]
                end = begin + f["starts"] + length - 1
                home = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(home),
                        batch.column("text_hash").take(home),
                        pa.array(f["key"]),
                        pa.array(f["start"]),
                        pa.array(f["starts"]),
                        pa.array(f["weight"]),
                        pa.array([text[a:b].tobytes() for a, b in zip(begin, end)], type=pa.binary()),
                    ],
                    names=_names(WINDOWS),
                )

    return run


def suffix_array(symbols: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``length`` symbols, by doubled prefixes.

    The first prefixes are as many symbols as fit into one number.
    """
    n, bits = len(symbols), max(1, int(symbols.max()).bit_length())
    size = min(62 // bits, length)
    key = np.zeros(n, dtype=np.int64)
    for k in range(size):
        key <<= bits
        key[: max(n - k, 0)] |= symbols[k:]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.zeros(n, dtype=np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if size >= length or rank[order[-1]] == n - 1 or size >= n:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[: n - size] = rank[size:] + 1
        key = rank * (int(rank.max()) + 2) + after
        size *= 2


def repeated_suffixes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Which positions share their first ``length`` symbols with another position.

    The last symbol must occur once and be less than all others.

    The interval of all suffixes that begin with a string w is extended to the left by every symbol
    before one of them: breadth first, so the intervals of strings of one length come together, and
    common prefixes of neighbouring suffixes are found in increasing order. An end of an interval
    that is met for the first time at strings of n + 1 symbols has a common prefix of n. Expansion
    stops at ``length``: ends not met by then join suffixes with that much in common.
    """
    n = len(symbols)
    order = suffix_array(symbols, length)
    before = symbols[order - 1]  # the transform; the first position is preceded by the last one
    by_symbol = np.argsort(before, kind="stable")
    to = np.empty(n, dtype=np.int64)  # where the suffix that is longer by one symbol stands
    to[by_symbol] = np.arange(n)
    following = np.full(n, n, dtype=np.int64)  # the next place in the transform with the same symbol
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    earlier = np.full(n, -1, dtype=np.int64)
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    met = np.zeros(n + 1, dtype=bool)
    met[n] = True
    begin, end = np.zeros(1, dtype=np.int64), np.full(1, n, dtype=np.int64)
    for _ in range(length):
        if not len(begin):
            break
        sizes = end - begin
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
        # The first and the last place of each symbol in an interval are the ends of the longer one.
        leads = earlier[place] < np.repeat(begin, sizes)
        firsts, lasts = place[leads], place[following[place] >= np.repeat(end, sizes)]
        counts = np.add.reduceat(leads.astype(np.int64), np.cumsum(sizes) - sizes)
        group = np.repeat(np.arange(len(sizes)), counts)
        firsts = firsts[np.lexsort((before[firsts], group))]
        lasts = lasts[np.lexsort((before[lasts], group))]
        begin, end = to[firsts], to[lasts] + 1
        fresh = ~met[end]
        met[end] = True
        begin, end = begin[fresh], end[fresh]
    joined = ~met[1:n]  # between neighbours in the order
    out = np.zeros(n, dtype=bool)
    out[order[1:][joined]] = True
    out[order[:-1][joined]] = True
    return out


def _expand(length: int):
    """Windows ordered by core to spans of repeated strings, in bundles of whole cores."""

    def spans(rows):
        texts = [r["bytes"] for r in rows]
        symbols = np.ones(sum(map(len, texts)) + len(texts), dtype=np.int64)  # a one ends each window
        symbols[-1] = 0
        places, at = [], 0
        for text in texts:
            symbols[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 2
            places.append(at)
            at += len(text) + 1
        repeated = repeated_suffixes(symbols, length)
        out = []
        for row, place in zip(rows, places):
            hits = np.flatnonzero(repeated[place : place + row["starts"]])
            for run in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1) if len(hits) else ():
                begin = row["start"] + int(run[0])
                out.append((row["doc_id"], row["text_hash"], begin, row["start"] + int(run[-1]) + length))
        columns = list(zip(*out)) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=_names(SPANS))

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and size >= BLOCK_BYTES and row["key"] != waiting[-1]["key"]:
                    yield spans(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row["bytes"])
        if waiting:
            yield spans(waiting)

    return run


class _Scratch:
    """Staged tables of one search; they go once its spans are written, so disk does not add up."""

    def __init__(self, spark) -> None:
        self.spark, self.paths = spark, []

    def staged(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, purpose))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def drop(self) -> None:
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _same_text(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["_id"]) & (left["text_hash"] == right["_hash"])


def _with_rows(texts: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    """The texts that rows are about, each with its rows as a list."""
    listed = rows.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    listed = listed.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return texts.join(listed, _same_text(texts, listed)).select("doc_id", "text_hash", "text", "rows")


def _met_again(rows: DataFrame, weight, staged) -> DataFrame:
    """Rows whose key occurs again, with ``differ`` (not all of the key are equal) and ``n``."""
    keys = rows.groupBy("key").agg(
        F.sum(weight).alias("_all"), F.min("win").alias("_lo"), F.max("win").alias("_hi"), F.count("*").alias("n")
    )
    keys = keys.filter(F.col("_all") > 1).select("key", "n", (F.col("_lo") != F.col("_hi")).alias("differ"))
    keys = staged(keys, "keys")
    held = bitmap.build(keys.select("key"), BITS)
    return staged(rows.filter(bitmap.may_hold(held, F.col("key"))).join(keys, "key"), "again")


def _classes(rows: DataFrame, weight, *fields: str) -> DataFrame:
    """Equal rows as one: how many they are, and one of them."""
    one = F.min(F.struct("doc_id", "text_hash", *fields)).alias("one")
    return rows.groupBy("key", "win").agg(
        F.sum(weight).alias("weight"), F.any_value("differ").alias("differ"), F.max("n").alias("n"), one
    )


def _counted_spans(rows: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Spans of the rows that have an equal one.

    Rows of a key that very many share are dealt into ``SALTS`` parts, and their class to each. So
    the classes are many times what Spark takes them for; unhinted, it would broadcast them through
    the driver, and parts serve a shuffle only.
    """
    hot = F.col("n") > HOT
    salt = F.when(hot, F.pmod(F.xxhash64("text_hash", "start"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    twice = classes.filter(F.col("weight") > 1)
    twice = twice.select("key", "win", F.explode(salts.cast("array<bigint>")).alias("salt")).hint("merge")
    begin = F.col("start").cast("long")
    return rows.withColumn("salt", salt).join(twice, ["key", "win", "salt"], "left_semi").select(
        "doc_id", "text_hash", begin.alias("begin"), (begin + F.col("starts") - 1 + length).alias("end")
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text_hash, begin and end of byte spans that repeated strings cover; they may overlap.

    ``docs`` needs doc_id and text; text_hash is xxhash64 of the text.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return _spans(keyed, length, length // 2, _Scratch(docs.sparkSession))


def _word_codes(shortest: int):
    """Texts of at least so many words to the codes of their words."""

    def run(batches):
        for batch in batches:
            for lo, _, w in each(batch.column(2)):
                rows = np.flatnonzero(np.diff(w.first) >= shortest)
                codes = (w.hash >> np.uint64(64 - 8 * CODE)).astype(f"<u{CODE}")
                at = pa.array(rows + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array([codes[w.first[k] : w.first[k + 1]].tobytes() for k in rows], type=pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "text"],
                )

    return run


def repeated_passages(docs: DataFrame, words: int = PASSAGE) -> DataFrame:
    """doc_id, text_hash, begin and end, in bytes of word codes, of passages of more than ``words`` words.

    Words are lower-cased and told apart by 16 bits of their hash: a word that differs inside a
    passage is overlooked once in 65,536 times.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    scratch = _Scratch(docs.sparkSession)
    codes = keyed.mapInArrow(_word_codes(words + 1), "doc_id long, text_hash long, text binary")
    return _spans(scratch.staged(codes, "word-codes"), CODE * (words + 1), CODE * min(CODE_WORDS, words), scratch)


def _spans(keyed: DataFrame, length: int, part: int, scratch: _Scratch) -> DataFrame:
    """Spans of the texts of ``keyed``, written down; anchors are the least of strings of ``part`` bytes."""
    spans = staged(_searched(keyed, length, part, scratch.staged), "spans")
    scratch.drop()
    return spans


def _searched(keyed: DataFrame, length: int, part: int, staged) -> DataFrame:
    one = F.lit(1).cast("long")
    anchors = staged(keyed.mapInArrow(_anchors(length, part), ANCHORS), "anchors")
    again = _met_again(anchors, one, staged)
    classes = staged(_classes(again, one, "start", "offset", "starts"), "windows")
    whole = _counted_spans(again, classes, length)

    several = classes.filter("differ").select("one.*", "weight")
    held = bitmap.build(several.select("text_hash"), BITS)
    wanted = several.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    some = keyed.filter(bitmap.may_hold(held, F.col("text_hash")))
    texts = staged(some.join(wanted, _same_text(some, wanted), "left_semi").distinct(), "texts")

    pieces = _with_rows(texts, several, "start", "offset", "starts", "weight")
    pieces = staged(pieces.mapInArrow(_pieces(length), PIECES), "pieces")
    again = _met_again(pieces, F.col("weight"), staged)
    classes = staged(_classes(again, F.col("weight"), "start", "starts"), "cores")
    parts = _counted_spans(again, classes, length)

    ends = classes.filter("differ").select("key", "n", "one.*", "weight")
    few = _with_rows(texts, ends.filter(F.col("n") <= HOT), "key", "start", "starts", "weight")
    # Few bytes, much work: as many tasks as the session asks for, not as their bytes suggest.
    parts_wanted = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = few.mapInArrow(_windows(length), WINDOWS).repartition(parts_wanted, "key").sortWithinPartitions("key")
    found = few.mapInArrow(_expand(length), SPANS)

    many = _with_rows(texts, ends.filter(F.col("n") > HOT), "start", "starts", "weight")
    many = staged(many.mapInArrow(_single(length), PIECES), "starts")
    many = many.withColumn("n", F.lit(HOT + 1))  # all of them come from crowded cores
    counts = many.groupBy("key", "win").agg(F.sum("weight").alias("weight"), F.max("n").alias("n"))
    return whole.union(parts).union(found).union(_counted_spans(many, counts, length))


RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
    " n_passage_words long, spans array<struct<begin:long,end:long>>"
)
_SPAN_LIST = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _whole_words(codes) -> int:
    """Words whose code lies within spans of codes."""
    return sum(end // CODE - -(-begin // CODE) for begin, end in _merged(codes))


def _cut(batches):
    for batch in batches:
        rows = []
        for text, spans, codes in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            kept, at, runs = hashlib.sha256(), 0, _merged(spans)
            for begin, end in runs:
                kept.update(data[at:begin])
                at = end
            kept.update(data[at:])
            rows.append((len(data), sum(e - b for b, e in runs), len(runs), kept.hexdigest(), _whole_words(codes), runs))
        sizes, removed, counts, digests, words, runs = zip(*rows) if rows else [()] * 6
        spans = [[{"begin": b, "end": e} for b, e in r] for r in runs]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, type=pa.int64()),
                pa.array(removed, type=pa.int64()),
                pa.array(counts, type=pa.int64()),
                pa.array(digests, type=pa.string()),
                pa.array(words, type=pa.int64()),
                pa.array(spans, type=_SPAN_LIST),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "spans"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, passage: int | None = PASSAGE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words and the removed spans.

    All occurrences of a repeated string go, the first one too. Texts are taken as UTF-8 bytes, so
    a cut may fall inside a character. ``n_passage_words`` counts the words of passages of more than
    ``passage`` words that occur again in any text, the same one included (0 where None is given).
    Null texts count as empty; texts shorter than ``length`` keep all their bytes. Equal rows are
    documents of their own, so what they share repeats. A null id is a value like any other. An
    empty table gives an empty result. Other columns are ignored.
    """
    span = F.struct("begin", "end")
    spans = repeated_spans(docs, length).withColumn("words", F.lit(False))
    if passage is not None:
        spans = spans.union(repeated_passages(docs, passage).withColumn("words", F.lit(True)))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    held = bitmap.build(spans.select("text_hash"), BITS)
    hit = bitmap.may_hold(held, F.col("text_hash"))
    listed = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set(F.when(~F.col("words"), span)).alias("spans"), F.collect_set(F.when(F.col("words"), span)).alias("codes")
    )
    touched = keyed.filter(hit)
    touched = touched.join(listed, _same_text(touched, listed), "left").select("doc_id", "text", "spans", "codes")
    none = F.lit(None).cast("array<struct<begin:bigint,end:bigint>>")
    rest = keyed.filter(~hit).select("doc_id", "text", none.alias("spans"), none.alias("codes"))
    return touched.union(rest).mapInArrow(_cut, RESULT)


@query("op5_suffix_dedup")
def suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
