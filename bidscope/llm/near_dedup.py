"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

1. One hash per shingle fills all bins of a signature at once; empty bins borrow from filled ones
   by optimal densification. Documents with equal shingle sets become one class here.
2. Signatures are cut into bands; classes that agree in a band share a bucket. Two documents at
   the threshold miss every bucket with a chance below 1e-10.
3. A bucket of n classes gives n - 1 candidates: its smallest class with each other one. Each is
   confirmed on the full sets, and the confirmed links are joined into components.
4. A star can miss a link between two of its points. So the classes of buckets that still hold
   several components are joined exactly: of two sets that similar, the rarest shingles of one must
   meet the rarest of the other, within bounds that follow from sizes and places. Only pairs
   across components are confirmed. In a large group of copies the rare shingles are the edits, so
   copies that differ too much never meet.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm import bitmap
from bidscope.llm.components import components
from bidscope.llm.registry import query, table
from bidscope.llm.words import constants, each, mix, windows
from bidscope.session import staged

SHINGLE = 5
BINS = 128
BAND = 4
BANDS = BINS // BAND
#: A link, unless told otherwise: 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
#: Counters of the sketch that orders shingles by rarity; its size is fixed.
SKETCH = 1 << 20
#: Ratio of the largest to the smallest set of a size class.
SIZE_STEP = 1.03

_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
_BAND = constants(BAND, 11)


def sets(texts: pa.Array):
    """Slices of a column: first row, rows, row of each distinct shingle hash, and the hashes.

    Sorted by row, then hash. A text of fewer than five words has one shingle, all its words.
    """
    for lo, _, w in each(texts):
        h = windows(w.hash, SHINGLE, 7)
        whole = w.doc[: len(h)] == w.doc[SHINGLE - 1 :] if len(h) else np.zeros(0, dtype=bool)
        counts = np.diff(w.first)
        few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        short = np.zeros(len(few), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i, factor in enumerate(constants(SHINGLE - 1, 8)):
                has = counts[few] > i
                short[has] += w.hash[w.first[few[has]] + i] * factor
            short = mix(short + counts[few].astype(np.uint64))
        doc = np.concatenate([w.doc[: len(h)][whole], few])
        value = np.concatenate([h[whole], short])
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        yield lo, w.texts, doc[new], value[new]


def _attempt(t: int) -> np.ndarray:
    """The bin that each empty bin asks for a value in its t-th attempt, the same for all texts."""
    return (mix(np.arange(BINS, dtype=np.uint64) + np.uint64((t + 1) << 20)) % np.uint64(BINS)).astype(np.int64)


def signatures(rows: int, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """rows x BINS: the smallest hash per bin, empty bins filled. Rows without a shingle are 0."""
    at = (value >> _SHIFT).astype(np.int64)
    lead = np.ones(len(doc), dtype=bool)
    lead[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
    out = np.zeros((rows, BINS), dtype=np.uint64)
    full = np.zeros((rows, BINS), dtype=bool)
    out[doc[lead], at[lead]] = value[lead]
    full[doc[lead], at[lead]] = True
    todo = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    empty, filled, values, t = ~full[todo], full[todo], out[todo], 0
    while len(todo):
        source = _attempt(t)
        take = empty & filled[:, source]
        values[take] = values[:, source][take]
        empty &= ~take
        t += 1
        if t % 16 == 0 or not empty.any():
            done = ~empty.any(axis=1)
            out[todo[done]] = values[done]
            todo, empty, filled, values = todo[~done], empty[~done], filled[~done], values[~done]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, BAND)
    with np.errstate(over="ignore"):
        keys = (parts * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        return mix(keys).view(np.int64)


def _sign(batches):
    for batch in batches:
        texts = batch.column(1)
        for lo, rows, doc, value in sets(texts):
            bounds = np.searchsorted(doc, np.arange(rows + 1))
            keys = band_keys(signatures(rows, doc, value))
            digests = [
                hashlib.blake2b(value[bounds[k] : bounds[k + 1]].tobytes(), digest_size=16).digest()
                for k in range(rows)
            ]
            offsets = pa.array(np.arange(0, (rows + 1) * BANDS, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, rows),
                    pa.array(np.diff(bounds), type=pa.int64()),
                    pa.array(digests, type=pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )


def _confirm(threshold: int):
    """Rows (a, b, text of a, text of b) whose sets are similar enough: (a, b)."""

    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            ids = a.to_numpy(zero_copy_only=False)
            left, news = batch.column(2), np.ones(len(ids), dtype=bool)
            same = pc.equal(left.slice(1), left.slice(0, max(len(ids) - 1, 0)))
            news[1:] = (ids[1:] != ids[:-1]) | ~same.to_numpy(zero_copy_only=False)
            left = _by_row(left.filter(pa.array(news)))
            right, which = _by_row(batch.column(3)), np.cumsum(news) - 1
            good = np.zeros(len(ids), dtype=bool)
            for k in range(len(ids)):
                x, y = left[which[k]], right[k]
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < threshold * len(y) or not len(x):
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int(np.count_nonzero(y[at] == x))
                good[k] = 100 * common >= threshold * (len(x) + len(y) - common)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return run


def _by_row(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for _, rows, doc, value in sets(texts):
        bounds = np.searchsorted(doc, np.arange(rows + 1))
        out += [value[bounds[k] : bounds[k + 1]] for k in range(rows)]
    return out


def _distinct_pairs(x: DataFrame) -> DataFrame:
    return x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that are links, confirmed on the sets of their full texts."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").sortWithinPartitions("a")
    schema = T.StructType([f for f in pairs.schema.fields])
    return staged(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(threshold), schema), "links")


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label) of the classes that share a bucket with another component."""
    known = buckets.join(labels, F.col("class_id") == F.col("id"), "left").drop("id")
    known = known.select("bucket", F.col("class_id").alias("id"), F.coalesce("label", "class_id").alias("label"))
    sizes = known.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    return known.join(sizes.filter(F.col("_lo") < F.col("_hi")), "bucket").select("id", "label").distinct()


def _slots(value: np.ndarray) -> np.ndarray:
    return (mix(value) % np.uint64(SKETCH)).astype(np.int64)


def _count(batches):
    """Counts of shingles by slot, one row for each slot that a task has met."""
    counts = np.zeros(SKETCH, dtype=np.int64)
    for batch in batches:
        for _, _, _, value in sets(batch.column(0)):
            np.add.at(counts, _slots(value), 1)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["slot", "n"])


def _sketch(texts: DataFrame) -> np.ndarray:
    """An upper bound of every shingle's documents, in a table of fixed size."""
    rows = texts.select("text").mapInArrow(_count, "slot long, n long")
    rows = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCH, dtype=np.uint16)
    counts[rows["slot"].to_numpy()] = np.minimum(rows["n"].to_numpy(), 65535)
    return counts


PREFIX = "shingle long, size_class int, probe boolean, id long, label long, size long, rest long"


def _size_class(size):
    return np.floor(np.log(size) / np.log(SIZE_STEP)).astype(np.int32)


def _prefixes(counts: np.ndarray, threshold: int):
    """The rarest shingles of each set, rarest first, as far as a link could begin with them.

    ``rest`` counts a set's shingles from this one on. At a threshold of 85, a link needs 85/185 of
    both sizes in common, so the first common shingle must leave that much in both. A set looks for smaller or equal ones
    (``probe``) in the size classes that its rest allows. A shingle of one document is left out.
    """
    need, both = threshold, 100 + threshold

    def run(batches):
        for batch in batches:
            for lo, rows, doc, value in sets(batch.column(2)):
                seen = counts[_slots(value)]
                order = np.lexsort((value, seen, doc))
                value, seen = value[order], seen[order]
                bounds = np.searchsorted(doc, np.arange(rows + 1))
                size = np.diff(bounds)[doc]
                rest = size - (np.arange(len(doc)) - bounds[doc])
                least = -(-need * size // 100)
                most = np.minimum(size, both * rest // need - size)
                probes = np.flatnonzero((seen > 1) & (most >= least))
                first, last = _size_class(least[probes]), _size_class(most[probes])
                times = last - first + 1
                probed = np.repeat(probes, times)
                classes = np.arange(len(probed)) - np.repeat(np.cumsum(times) - times, times)
                held = np.flatnonzero((seen > 1) & (both * rest >= 2 * need * size))
                at = np.concatenate([probed, held])
                row = pa.array(doc[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[at].view(np.int64)),
                        pa.array(np.concatenate([np.repeat(first, times) + classes, _size_class(size[held])]).astype(np.int32)),
                        pa.array(np.arange(len(at)) < len(probed)),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(size[at]),
                        pa.array(rest[at]),
                    ],
                    names=[f.split()[0] for f in PREFIX.split(", ")],
                )

    return run


def _across(texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of texts (id, label, text) that may be links between different labels."""
    rows = texts.select("id", "label", "text").mapInArrow(_prefixes(_sketch(texts), threshold), PREFIX)
    rows = staged(rows, "prefixes")
    x = rows.filter("probe").drop("probe").withColumnsRenamed({"id": "a", "label": "_la", "size": "_sa", "rest": "_ra"})
    y = rows.filter("not probe").drop("probe").withColumnsRenamed(
        {"id": "b", "label": "_lb", "size": "_sb", "rest": "_rb"}
    )
    keys = (x["shingle"] == y["shingle"]) & (x["size_class"] == y["size_class"]) & (F.col("_la") != F.col("_lb"))
    enough = (100 + threshold) * F.least("_ra", "_rb") >= threshold * (F.col("_sa") + F.col("_sb"))
    return x.join(y, keys & (F.col("_sb") <= F.col("_sa")) & enough).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Two texts are linked when 100 * intersection >= threshold * union of their shingle sets.
    component_id is the smallest doc_id that links can reach; ``kept`` marks the documents that
    are their component's smallest. A text without a word is linked with nothing, not even with
    another such text. Rows with the same id are one node. A null id has no place in the order: it
    takes the component of documents equal to it, or null, and is kept only in the latter case.
    An empty table gives an empty result. Other columns are ignored.
    """
    signed = docs.select("doc_id", "text").mapInArrow(
        _sign,
        T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("n_shingles", T.LongType()),
                T.StructField("set_key", T.BinaryType()),
                T.StructField("bands", T.ArrayType(T.LongType())),
            ]
        ),
    )
    signed = staged(signed, "signatures")
    classes = staged(
        signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("class_id"), F.any_value("bands").alias("bands")),
        "classes",
    )
    entries = classes.select("class_id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("class_id").alias("center"), F.max("class_id").alias("_last"))
    buckets = staged(
        entries.join(shared.filter(F.col("center") < F.col("_last")).drop("_last"), "bucket"), "buckets"
    )
    texts = _texts(docs, buckets.select("class_id").distinct())
    stars = buckets.filter(F.col("class_id") != F.col("center")).select(
        F.col("center").alias("a"), F.col("class_id").alias("b")
    )
    links = _links(stars.distinct(), texts, threshold)
    # Rows of one id with different texts are one node as well.
    identified = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    several = identified.groupBy("doc_id").agg(F.min("set_key").alias("_lo"), F.max("set_key").alias("_hi"))
    several = several.filter(F.col("_lo") != F.col("_hi")).select("doc_id")
    same = identified.join(several, "doc_id").select("doc_id", "set_key").join(classes, "set_key")
    same = same.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    labels = staged(components(links), "labels")
    mixed = _mixed(buckets, labels)
    others = texts.join(mixed, F.col("doc_id") == F.col("id")).select("id", "label", "text")
    more = _links(_distinct_pairs(_across(staged(others, "others"), threshold)), texts, threshold)
    labels = staged(components(links.union(more).union(same)), "labels")
    named = classes.join(labels, F.col("class_id") == F.col("id"), "left").select(
        "set_key", F.coalesce("label", "class_id").alias("component_id")
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        signed.join(named, "set_key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the ids. Most other documents are left out before any shuffle."""
    held = bitmap.build(ids)
    wanted = ids.withColumnRenamed("class_id", "_id")
    some = docs.select("doc_id", "text").filter(bitmap.may_hold(held, F.col("doc_id")))
    found = some.join(wanted, F.col("doc_id") == F.col("_id"), "left_semi")
    return staged(found.distinct(), "texts")


# Shared shingles of all pairs of different sets, then what links reach.
_SQL = r"""WITH RECURSIVE found AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  tokens AS (SELECT doc_id, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM found),
  windows AS (SELECT doc_id, m, k, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
      lead(word, 4) OVER o) AS shingle FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
  held AS (SELECT doc_id, list_sort(list(DISTINCT shingle)) AS s FROM windows WHERE k <= greatest(m - 4, 1) GROUP BY doc_id),
  sets AS (SELECT doc_id, coalesce(s, []) AS s FROM documents LEFT JOIN held USING (doc_id)),
  signed AS (SELECT doc_id, len(s) AS n, sha256(array_to_string(s, chr(10))) AS k, s FROM sets),
  classes AS (SELECT k, min(doc_id) AS id, any_value(n) AS n, any_value(s) AS s FROM signed WHERE n > 0 GROUP BY k),
  entries AS (SELECT id, n, unnest(s) AS shingle FROM classes),
  links AS (SELECT a.id AS a, b.id AS b FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.id <> b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
  reach AS (SELECT id, id AS other FROM classes UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
  components AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
SELECT doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
  doc_id = coalesce(component, doc_id) AS kept
FROM signed d LEFT JOIN (SELECT k, id FROM classes) c ON c.k = d.k AND d.n > 0 LEFT JOIN components USING (id)"""


@query("op8_near_dedup", _SQL)
def near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
