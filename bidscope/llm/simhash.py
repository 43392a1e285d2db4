"""SimHash near-duplicates: an index of fingerprints in Gray order, searched group against group.

1. A text's fingerprint is the majority, bit by bit, of the hashes of its shingles. Equal
   fingerprints become one row here.
2. Bits are cut into blocks. Two fingerprints with at most ``FAR`` differing bits agree in all
   blocks but FAR, so for each choice of that many agreeing blocks (a route) these bits are moved
   to the front and the rows are sorted by Gray rank. Rows with equal front bits are a cell. The
   number of blocks follows from the number of fingerprints, so cells stay small.
3. Rows that follow each other in Gray order differ in few bits. A run of them is a leaf: the bits
   that all its rows set, and the bits that any of them sets. Upper nodes do the same for their
   children, so the bits that a whole group shares stand once, above it. The index is searched
   against itself from the top: two nodes whose shared bits already differ in more than FAR places
   are left out with all that is below them, and so are nodes that are one component already.
4. A task hands on a forest of its links, never all pairs. A cell that several tasks or blocks of
   rows hold (a large group of near copies, mostly) is met again: there, only rows outside its
   largest component so far are compared with the others, tile by tile.
"""

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm.components import components
from bidscope.llm.registry import query, table
from bidscope.session import staged

SHINGLE = 4
SEED = 42
#: Fingerprints with this many differing bits or fewer are linked.
FAR = 4
#: Rows of a leaf, and children of an upper node.
LEAF = 16
FAN = 8
#: Rows that are searched together.
BLOCK = 1 << 16
#: Rows of each side of a tile of a cell that is met again.
TILE = 1 << 14
#: Pairs of nodes that are taken from the stack at once.
PAIRS = 1 << 13
#: Comparisons that cost as much as a row of another route.
ROUTE_COST = 200
#: Shingles hashed at once, so memory does not follow the longest text.
SLICE = 1 << 16

_LANES = np.uint64(0x0101010101010101)
_ONE = np.uint64(1)


def _counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each of the 64 bits, the lowest first.

    Eight byte-wide counters share a number, so at most 255 hashes are added at once.
    """
    starts = np.arange(0, len(hashes), 255)
    out = np.zeros((8, 8), dtype=np.int64)  # byte, bit of the byte
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        out[:, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def fingerprint(text: bytes) -> int:
    """The SimHash of a text's shingles, repeats included; zero without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes) - 1
    first = (ends - sizes + 1)[: max(1, len(words) - SHINGLE + 1)]
    last = ends[min(SHINGLE, len(words)) - 1 :]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), SLICE):
        spans = zip(first[at : at + SLICE].tolist(), last[at : at + SLICE].tolist())
        total += _counts(np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64))
    return sum(1 << bit for bit in np.flatnonzero(2 * total > len(first)).tolist())


def _sign(batches):
    for batch in batches:
        texts = batch.column(1)
        found = [fingerprint(memoryview(t.as_buffer()).tobytes()) if t.is_valid else 0 for t in texts]
        prints = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "print"])


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the order in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> np.uint64(shift))
    return values


def blocks_for(rows: int) -> int:
    """The number of blocks with which rows sent and comparisons within cells cost least."""

    def cost(blocks: int) -> float:
        lead = 64 * (blocks - FAR) / blocks
        return comb(blocks, FAR) * (rows * ROUTE_COST + rows * rows / 2**lead / 2)

    return min(range(FAR + 1, 2 * FAR + 1), key=cost)


def routes(blocks: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each choice of agreeing blocks: the number of front bits, and (shift, width) in order."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    out = []
    for lead in combinations(range(blocks), blocks - FAR):
        rest = [k for k in range(blocks) if k not in lead]
        out.append((sum(parts[k][1] for k in lead), [parts[k] for k in [*lead, *rest]]))
    return out


def _moved(values: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    def put(out, part):
        shift, width = part
        piece = (values >> np.uint64(shift)) & ((_ONE << np.uint64(width)) - _ONE)
        return (out << np.uint64(width)) | piece

    return reduce(put, order, np.zeros(len(values), dtype=np.uint64))


ROWS = "route int, cell long, rank long, print long"


def _routed(blocks: int):
    """Fingerprints to one row per route. Ranks are shifted so that they sort as signed numbers."""

    def run(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for route, (lead, order) in enumerate(routes(blocks)):
                rank = gray_rank(_moved(values, order))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rank), route, dtype=np.int32)),
                        pa.array((rank >> np.uint64(64 - lead)).view(np.int64)),
                        pa.array((rank ^ (_ONE << np.uint64(63))).view(np.int64)),
                        batch.column(0),
                    ],
                    names=["route", "cell", "rank", "print"],
                )

    return run


def _runs(cell: np.ndarray, size: int) -> np.ndarray:
    """Where runs of at most ``size`` neighbours of one cell begin."""
    new = np.ones(len(cell), dtype=bool)
    new[1:] = cell[1:] != cell[:-1]
    begins = np.flatnonzero(new)
    at = np.arange(len(cell)) - np.repeat(begins, np.diff(np.append(begins, len(cell))))
    return np.flatnonzero(at % size == 0)


class Index:
    """Nodes over rows that are sorted by cell and Gray rank, level by level, leaves first."""

    def __init__(self, cell: np.ndarray, prints: np.ndarray):
        self.prints = prints
        self.starts, self.ends, self.every, self.some = [], [], [], []
        every, some, size = prints, prints, LEAF
        while True:
            starts = _runs(cell, size)
            self.starts.append(starts)
            self.ends.append(np.append(starts[1:], len(cell)))
            every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            self.every.append(every)
            self.some.append(some)
            if len(starts) > 1 and bool((cell[starts][1:] == cell[starts][:-1]).any()):
                cell, size = cell[starts], FAN
            else:
                break

    def differ(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in which all rows below one node differ from all rows below the other."""
        every, some = self.every[level], self.some[level]
        return np.bitwise_count((every[a] & ~some[b]) | (every[b] & ~some[a]))

    def below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of children of pairs of nodes, each once; children of leaves are rows."""
        width = np.arange(FAN if level else LEAF)
        x = self.starts[level][a][:, None, None] + width[:, None]
        y = self.starts[level][b][:, None, None] + width
        valid = (x < self.ends[level][a][:, None, None]) & (y < self.ends[level][b][:, None, None])
        valid &= (x < y) if not level else (x <= y)
        shape = valid.shape
        return np.broadcast_to(x, shape)[valid], np.broadcast_to(y, shape)[valid]


def _unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (the first row of each component) after linking rows x and y."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return label
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            after = label[label]
            if np.array_equal(after, label):
                break
            label = after


def linked(cell: np.ndarray, prints: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels of rows sorted by cell and Gray rank, after linking what lies within FAR in a cell.

    ``label`` says what is linked already: each row's first row.
    """
    index = Index(cell, prints)
    label, top = label.copy(), len(index.starts) - 1
    # Rows of one leaf first: what they link need not be compared again higher up.
    leaves, roots = np.arange(len(index.starts[0])), np.arange(len(index.starts[top]))
    stack = [(top, roots, roots)]
    stack += [(0, leaves[k : k + PAIRS], leaves[k : k + PAIRS]) for k in range(0, len(leaves), PAIRS)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS:
            stack.append((level, a[PAIRS:], b[PAIRS:]))
            a, b = a[:PAIRS], b[:PAIRS]
        low, high = label, label
        for starts in index.starts[: level + 1]:
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
        joined = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        x, y = index.below(level, a[~joined], b[~joined])
        if level:
            near = index.differ(level - 1, x, y) <= FAR
            if near.any():
                stack.append((level - 1, x[near], y[near]))
        else:
            near = np.bitwise_count(prints[x] ^ prints[y]) <= FAR
            label = _unite(label, x[near], y[near])
    return label


FOUND = "route int, a long, b long"


def _found(route, a, b):
    arrays = [pa.array(route, type=pa.int32()), pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["route", "a", "b"])


def _forest(rows: pa.Table):
    """Links (route -1) of a block of rows, and its first and last cell, which others may share."""
    route, cell, prints = (rows[name].to_numpy() for name in ("route", "cell", "print"))
    both = (route.astype(np.int64) << 56) | cell  # cells have at most 32 bits
    label = linked(both, prints.view(np.uint64), np.arange(len(both)))
    hung = np.flatnonzero(label != np.arange(len(label)))
    yield _found(np.full(len(hung), -1), prints[hung], prints[label[hung]])
    edge = np.unique([0, len(both) - 1] if both[0] != both[-1] else [0])
    yield _found(route[edge], cell[edge], cell[edge])


def _blocks(batches):
    waiting, size = [], 0
    for batch in batches:
        while batch.num_rows:
            take = min(batch.num_rows, BLOCK - size)
            waiting.append(batch.slice(0, take))
            batch, size = batch.slice(take), size + take
            if size == BLOCK:
                yield from _forest(pa.Table.from_batches(waiting))
                waiting, size = [], 0
    if size:
        yield from _forest(pa.Table.from_batches(waiting))


def _tile(rows: pa.Table) -> pa.Table:
    """Links between the components (their labels) of one tile."""
    prints, first = np.unique(rows["print"].to_numpy().view(np.uint64), return_index=True)
    names = rows["label"].to_numpy()[first]
    order = np.argsort(rows["rank"].to_numpy()[first], kind="stable")
    prints, names = prints[order], names[order]
    _, where, which = np.unique(names, return_index=True, return_inverse=True)
    before = where[which]
    after = linked(np.zeros(len(prints), dtype=np.int64), prints, before)
    heads = np.unique(before[after != before])
    return pa.table({"a": pa.array(names[heads]), "b": pa.array(names[after[heads]])})


def _met_again(rows: DataFrame, found: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between labels, from cells that several blocks of rows hold a part of."""
    cut = found.filter("route >= 0").groupBy("route", F.col("a").alias("cell")).count().filter("count > 1").drop("count")
    held = rows.join(cut, ["route", "cell"]).join(labels, F.col("print") == F.col("id"), "left")
    held = staged(held.select("route", "cell", "rank", "print", F.coalesce("label", "print").alias("label")), "cut")
    main = held.groupBy("route", "cell", "label").count()
    main = main.groupBy("route", "cell").agg(
        F.max_by("label", F.struct("count", "label")).alias("_main"),
        F.sum("count").alias("_rows"),
        (F.sum("count") - F.max("count")).alias("_others"),
    )
    parts = lambda n: F.ceil(F.col(n) / TILE)
    main = main.filter("_others > 0").select("route", "cell", "_main", parts("_rows").alias("_p"), parts("_others").alias("_o"))
    held = held.join(main, ["route", "cell"])
    dealt = lambda n: F.pmod(F.xxhash64("print"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    fields = ["route", "cell", "rank", "print", "label"]
    all_rows = held.select(*fields, dealt("_p").alias("p"), upto("_o").alias("o"))
    others = held.filter(F.col("label") != F.col("_main")).select(*fields, upto("_p").alias("p"), dealt("_o").alias("o"))
    tiles = all_rows.union(others).groupBy("route", "cell", "p", "o")
    return tiles.applyInArrow(_tile, "a long, b long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and print (bigint) of every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_sign, "doc_id long, print long")


def near_components(prints: DataFrame) -> DataFrame:
    """print and label of the fingerprints (one bigint column, distinct) that are linked with others.

    The label is the least fingerprint, as a signed number, that links can reach.
    """
    blocks = blocks_for(prints.count())
    rows = prints.mapInArrow(_routed(blocks), ROWS)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "route", "rank").sortWithinPartitions("route", "rank")
    found = staged(ordered.mapInArrow(_blocks, FOUND), "forest")
    labels = staged(components(found.filter("route < 0").select("a", "b")), "labels")
    more = staged(components(staged(_met_again(rows, found, labels), "more")), "labels")
    more = more.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
    alone = more.join(labels, F.col("_id") == F.col("id"), "left_anti").select("_id", "_label")
    known = labels.join(more, F.col("label") == F.col("_id"), "left")
    return known.select(F.col("id").alias("print"), F.coalesce("_label", "label").alias("label")).union(alone)


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row of ``docs``.

    ``docs`` needs doc_id (bigint) and text. component_id is the smallest doc_id that links can
    reach, itself included. Texts that are null or hold no word have the fingerprint zero and are
    linked with each other, and with what lies near zero. Rows with the same id are documents of
    their own; repeated rows stay. A row without an id takes the component of what it is linked
    with, null if nothing there has an id. An empty table gives an empty result. Other columns are
    ignored, whatever their names.
    """
    signed = staged(fingerprints(docs), "prints")
    distinct = staged(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    labels = staged(near_components(distinct.select("print")), "labels")
    known = labels.join(distinct, "print")
    least = known.groupBy("label").agg(F.min("least").alias("_least"))
    named = known.join(least, "label").select(F.col("print").alias("_print"), "_least")
    named = distinct.join(named, F.col("print") == F.col("_print"), "left")
    named = named.select("print", F.coalesce("_least", "least").alias("component_id"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return signed.join(named, "print").select("doc_id", digits, "component_id")


@query("op13_simhash")
def simhash(spark, sf_dir):
    return simhash_duplicates(table(spark, sf_dir, "documents"))
