"""A bigram language model by deleted interpolation, learnt and applied with Spark.

The probability of a word after another mixes three maximum-likelihood estimates: that of the pair,
of the word alone, and the same for every word. How much each one counts depends on how often the
context was seen: contexts fall into buckets by the logarithm of their count, and the weights of
each bucket are learnt by expectation maximisation on the training documents, each of them under
the counts of all others ("deleted" counts). Held-out documents are scored and nothing else.

1. Documents are packed into chunks of bounded bytes. A chunk sends each of its distinct n-grams
   once, with its count, to the part of the hash space that owns it: hot words and pairs are
   summed before the shuffle, and no group is larger than its share of distinct n-grams.
2. Each part adds up its n-grams and sends every chunk the totals it asked for, in the same order.
3. A chunk then has all counts for its own n-grams beside its own text, and needs no table of the
   vocabulary. Training chunks give the histograms that the weights are learnt from; all chunks
   are scored with them.

N-grams are told apart by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.registry import query, table
from bidscope.llm.words import constants, each, mix
from bidscope.session import staged

#: Text bytes of a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 3 << 20
#: Documents whose checksum leaves this remainder are held out of the counts.
FOLDS, HELD_OUT = 7, 2
#: Context counts from 2 ** (CONTEXTS - 2) on share the last bucket; bucket 0 is for unseen ones.
CONTEXTS = 24
#: Training tokens are summed by their own deleted count, and by the ratio of the estimates of pair
#: and token, both in steps of STEP octaves: tables of fixed size, whatever the corpus.
SINGLES, RATIOS, STEP = 320, 512, 1 / 8
EM_STEPS = 100

_END = np.uint64(0x5DEECE66D1CE4E5B)
_PAIR = constants(2, 31)

CHUNKS = "chunk string, held_out boolean, ids binary, known_ids binary, sizes binary, texts binary"
ASKED = "chunk string, held_out boolean, part int, asked binary, counts binary"
ANSWERS = "chunk string, part int, totals binary, train_tokens long, distinct_tokens long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id, as text, has the held-out remainder. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _rows(batch):
    """The rows of a batch one by one, since each may hold a whole chunk."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _packed(values) -> bytes:
    """The length, then the bytes compressed."""
    data = values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _unpacked(data: bytes, dtype=None):
    size = int.from_bytes(data[:8], "little")
    raw = pa.Codec("zstd").decompress(data[8:], size, asbytes=True) if size else b""
    return raw if dtype is None else np.frombuffer(raw, dtype=dtype)


def _planes(values: np.ndarray) -> bytes:
    """64-bit integers with their bytes grouped by place, since high bytes are mostly zero."""
    return _packed(values.view(np.uint8).reshape(-1, 8).T)


def _from_planes(data: bytes, dtype) -> np.ndarray:
    planes = _unpacked(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each text's words then an end; and each text's first."""
    parts, counts = [], []
    for _, _, w in each(texts):
        n = np.diff(w.first)
        parts.append(np.insert(w.hash, w.first[1:], _END))
        counts.append(n + 1)
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    if parts:
        np.cumsum(np.concatenate(counts), out=first[1:])
        return np.concatenate(parts), first
    return np.zeros(0, dtype=np.uint64), first


def _ngrams(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of single tokens and of pairs. A text's first token follows an end.

    The lowest bit tells the two kinds apart; it is not used to choose a part.
    """
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _END
    one = np.uint64(1)
    with np.errstate(over="ignore"):
        pairs = mix(before * _PAIR[0] + tokens * _PAIR[1])
    return tokens & ~one, pairs | one


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts follow the order of keys, so sorted keys fall into parts one after the other."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _asked(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys of a chunk with their counts, and each token's two places in them."""
    tokens, first = _tokens(texts)
    singles, pairs = _ngrams(tokens, first)
    keys, place, counts = np.unique(np.concatenate([singles, pairs]), return_inverse=True, return_counts=True)
    return keys, counts, place[: len(tokens)], place[len(tokens) :], first


def _pack(batches):
    """Rows (id, held_out, text) to chunks of texts that are all held out or all not."""
    from pyspark import TaskContext

    context = TaskContext.get()
    name, n = f"{context.partitionId()}-{context.taskAttemptId()}", 0

    def emit(held, ids, texts):
        row = {
            "chunk": f"{name}-{n}",
            "held_out": held,
            "ids": _packed(np.array([i or 0 for i in ids], dtype=np.int64)),
            "known_ids": _packed(np.array([i is not None for i in ids])),
            "sizes": _packed(np.array([len(t) for t in texts], dtype=np.int64)),
            "texts": _packed(b"".join(texts)),
        }
        types = {"chunk": pa.string(), "held_out": pa.bool_()}
        columns = [pa.array([row[c]], type=types.get(c, pa.binary())) for c in _names(CHUNKS)]
        return pa.RecordBatch.from_arrays(columns, names=_names(CHUNKS))

    waiting = {held: ([], [], [0]) for held in (False, True)}
    for batch in batches:
        for doc, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_buffer().to_pybytes() if text.is_valid else b""
            ids, texts, size = waiting[held]
            if ids and size[0] + len(text) > CHUNK_BYTES:
                yield emit(held, ids, texts)
                n += 1
                ids, texts, size = waiting[held] = ([], [], [0])
            ids.append(doc)
            texts.append(text)
            size[0] += len(text)
    for held, (ids, texts, _) in waiting.items():
        if ids:
            yield emit(held, ids, texts)
            n += 1


def _texts(row: dict) -> pa.Array:
    sizes = _unpacked(row["sizes"], np.int64)
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(_unpacked(row["texts"]))]
    )


def _ask(parts: int):
    """Chunks to what each asks: one row for each part that owns some of its n-grams."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                keys, counts, _, _, _ = _asked(_texts(row))
                bounds = np.searchsorted(_part_of(keys, parts), np.arange(parts + 1))
                some = [(p, bounds[p], bounds[p + 1]) for p in range(parts) if bounds[p] < bounds[p + 1]]
                steps = [np.diff(keys[a:b], prepend=np.uint64(0)) for _, a, b in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["chunk"]] * len(some)),
                        pa.array([row["held_out"]] * len(some)),
                        pa.array([p for p, _, _ in some], type=pa.int32()),
                        pa.array([_planes(x) for x in steps], type=pa.binary()),
                        pa.array([_packed(counts[a:b].astype(np.int32)) for _, a, b in some], type=pa.binary()),
                    ],
                    names=_names(ASKED),
                )

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """All rows of one part: the training count of every key, sent back to each chunk that asked.

    Each training token and each distinct one is counted in one part; its first answer says so.
    """
    with np.errstate(over="ignore"):
        keys = [np.cumsum(_from_planes(x.as_py(), np.uint64), dtype=np.uint64) for x in asked["asked"]]
    everything = np.unique(np.concatenate(keys))
    places = [np.searchsorted(everything, k) for k in keys]
    totals = np.zeros(len(everything), dtype=np.int64)
    for place, counts, held in zip(places, asked["counts"], asked["held_out"].to_pylist()):
        if not held:
            totals[place] += _unpacked(counts.as_py(), np.int32)
    single = totals[(everything & np.uint64(1)) == 0]
    rest = [0] * (len(keys) - 1)
    return pa.table(
        {
            "chunk": asked["chunk"],
            "part": asked["part"],
            "totals": pa.array([_planes(totals[p]) for p in places], type=pa.binary()),
            "train_tokens": pa.array([int(single.sum()), *rest], type=pa.int64()),
            "distinct_tokens": pa.array([int(np.count_nonzero(single)), *rest], type=pa.int64()),
        }
    )


def _within(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How often each token's key occurs in its own document."""
    width = int(place.max(initial=0)) + 1
    _, at, counts = np.unique(doc * width + place, return_inverse=True, return_counts=True)
    return counts[at]


def _contexts(single: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The count of the token before; the one before a text is an end, and there is one per text."""
    out = np.empty_like(single)
    out[1:] = single[:-1]
    out[first[:-1]] = single[first[1:] - 1]
    return out


class Estimates:
    """Bucket of the context, and estimates by pair and by token, from training counts."""

    def __init__(self, single: np.ndarray, pair: np.ndarray, context: np.ndarray, total):
        self.bucket = np.where(
            context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, CONTEXTS - 1), 0
        )
        with np.errstate(divide="ignore", invalid="ignore"):
            self.p_pair = np.where(context > 0, pair / context, 0.0)
        self.p_single = single / np.maximum(total, 1)


class Counted:
    """A chunk's texts with the training counts of every token, its pair and its context."""

    def __init__(self, row: dict, total: int):
        self.ids = _unpacked(row["ids"], np.int64)
        self.known_ids = _unpacked(row["known_ids"], bool)
        self.held_out = row["held_out"]
        self.total = total
        texts = _texts(row)
        _, _, self._one, self._two, self.first = _asked(texts)
        answers = sorted(row["answers"], key=lambda a: a["part"])
        counts = np.concatenate([_from_planes(a["totals"], np.int64) for a in answers])
        self.single, self.pair = counts[self._one], counts[self._two]
        self.context = _contexts(self.single, self.first)

    def estimates(self) -> Estimates:
        return Estimates(self.single, self.pair, self.context, self.total)

    def deleted(self) -> Estimates:
        """The estimates of a training document by all others: its own tokens leave every count."""
        sizes = np.diff(self.first)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        single, pair = _within(doc, self._one), _within(doc, self._two)
        context = self.context - _contexts(single, self.first)
        return Estimates(self.single - single, self.pair - pair, context, self.total - np.repeat(sizes, sizes))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text; every text has a token, its end."""
        return np.add.reduceat(values, self.first[:-1])


def _histogram(total: int):
    """Training tokens by bucket of the context, class of the token's count, and ratio class.

    Counts are deleted ones, brought to the size of the whole, and classes are the nearest steps.
    Class 0 is for tokens unseen in other documents, ratio class 0 for unseen pairs.
    """

    def run(batches):
        counts = np.zeros((CONTEXTS, SINGLES, RATIOS), dtype=np.int64)
        for batch in batches:
            for row in _rows(batch):
                e = Counted(row, total).deleted()
                single = np.round(np.log2(np.maximum(e.p_single * total, 1)) / STEP).astype(np.int64) + 1
                single = np.where(e.p_single > 0, np.minimum(single, SINGLES - 1), 0)
                seen = (e.p_pair > 0) & (e.p_single > 0)
                ratio = np.log2(np.where(seen, e.p_pair, 1.0) / np.where(seen, e.p_single, 1.0))
                place = np.clip(np.round(ratio / STEP) + RATIOS // 2, 1, RATIOS - 1).astype(np.int64)
                np.add.at(counts, (e.bucket, single, np.where(seen, place, 0)), 1)
        at = np.argwhere(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, k]) for k in range(3)] + [pa.array(counts[tuple(at.T)])],
            names=["bucket", "single", "ratio", "n"],
        )

    return run


def learn_weights(histogram: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """CONTEXTS x 3 weights of pair, token and uniform estimate, by expectation maximisation.

    ``histogram`` counts tokens as ``_histogram`` does. A bucket without any learns from
    those of all buckets. One more unseen token in each keeps every token possible.
    """
    single = 2.0 ** ((np.arange(SINGLES) - 1) * STEP) / max(total, 1)
    ratio = 2.0 ** ((np.arange(RATIOS) - RATIOS // 2) * STEP)
    single[0] = ratio[0] = 0.0
    everywhere = histogram.sum(axis=0)
    out = np.zeros((CONTEXTS, 3))
    for b in range(CONTEXTS):
        cells = histogram[b] if histogram[b].any() else everywhere
        cells = cells.copy()
        cells[0, 0] += 1
        x, y = np.nonzero(cells)
        n = cells[x, y]
        estimates = np.stack([single[x] * ratio[y], single[x], np.full(len(x), 1.0 / (distinct + 1))])
        w = np.array([0.0, 0.5, 0.5]) if b == 0 else np.array([0.4, 0.4, 0.2])
        for _ in range(EM_STEPS):
            parts = w[:, None] * estimates
            shares = (parts / np.maximum(parts.sum(axis=0), 1e-300) * n).sum(axis=1)
            w = shares / shares.sum()
        out[b] = w
    return out


def _scored(weights: np.ndarray, total: int, distinct: int):
    uniform = 1.0 / (distinct + 1)

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                c = Counted(row, total)
                e = c.estimates()
                w = weights[e.bucket]
                mixed = w[:, 0] * e.p_pair + w[:, 1] * e.p_single + w[:, 2] * uniform
                base = np.log10((c.single + 1) / (total + distinct + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c.ids, mask=~c.known_ids),
                        pa.array(np.full(len(c.ids), c.held_out)),
                        pa.array(np.diff(c.first)),
                        pa.array(c.per_text((c.single > 0).astype(np.int64))),
                        pa.array(c.per_text(base)),
                        pa.array(c.per_text(np.log10(mixed))),
                    ],
                    names=_names(SCORES),
                )

    return run


def score(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every row, and train_tokens.

    Scores are log10 probabilities of the whole text: of its words, A to Z lowered, and one end.
    ``score`` is the model's, ``base_score`` that of single tokens with one added to each count.
    ``n_known`` counts tokens seen in training. Null and empty texts have one token, the end. Rows
    without an id are learnt from. Equal rows are scored, and counted, each. With nothing to learn
    from, all tokens are alike. An empty table gives an empty result. Other columns are ignored.

    ``parts`` is the number of parts of the hash space, by default the session's number of shuffle
    partitions.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    chunks = staged(rows.mapInArrow(_pack, CHUNKS), "chunks")
    asked = chunks.mapInArrow(_ask(parts), ASKED)
    answers = staged(asked.groupBy("part").applyInArrow(_answer, ANSWERS), "answers")
    known = answers.agg(F.sum("train_tokens"), F.sum("distinct_tokens")).first()
    total, distinct = known[0] or 0, known[1] or 0
    answered = answers.groupBy("chunk").agg(F.collect_list(F.struct("part", "totals")).alias("answers"))
    counted = chunks.join(answered, "chunk")
    cells = counted.filter("not held_out").mapInArrow(_histogram(total), "bucket long, single long, ratio long, n long")
    cells = cells.groupBy("bucket", "single", "ratio").agg(F.sum("n").alias("n")).toArrow()
    histogram = np.zeros((CONTEXTS, SINGLES, RATIOS), dtype=np.int64)
    histogram[tuple(cells[c].to_numpy() for c in ("bucket", "single", "ratio"))] = cells["n"].to_numpy()
    weights = learn_weights(histogram, total, distinct)
    return counted.mapInArrow(_scored(weights, total, distinct), SCORES).withColumn(
        "train_tokens", F.lit(total).cast("long")
    )


@query("op10_lm_scoring")
def lm_scoring(spark, sf_dir):
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
