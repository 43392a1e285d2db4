"""Spelling variants: words one edit apart, found by K-d trees over letter counts.

1. Words and their numbers are counted per task first, so a frequent word crosses the shuffle as
   one row per batch of texts.
2. An inserted or deleted letter changes the letter counts by one, a replaced one by one up and one
   down: a distance of at most two. Counts are kept as a unary code in 64 bits, so letters that one
   word has beyond another are one ``and not`` and a count of bits.
3. For each length, words are the points of a K-d tree; words of that length and of the next one
   search it. A tree's nodes hold the least and the most of each letter below them, and whatever
   lies outside the box by more than the edit allows is left out as a whole. Large trees are cut
   into cells by the top splits, fitted on a bounded sample: every point lies in one cell, and a
   search goes to each cell it may reach. Points and searches of a cell are dealt into parts of
   bounded size.
4. What the trees leave is verified letter by letter. Tasks hand on one row per word, not pairs.
"""

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm.registry import query, table
from bidscope.session import staged

#: Words have at least this many code points and occur at least this often.
LETTERS = 6
OCCURRENCES = 5
#: A form occurs at least this many times as often as the word.
RATIO = 5
#: Every such multiple of a run's checksum loses a letter.
DAMAGE = 199
#: Rows of a leaf.
LEAF = 32
#: Points of one length that a cell holds, about; the sample that fits the cells is at most SAMPLE words.
CELL = 1 << 16
SAMPLE = 1 << 16
#: Points and searches that one task's group holds at most.
POINTS = 1 << 15
SEARCHES = 1 << 14
#: Pairs of a search and a node that are looked at together.
PAIRS = 1 << 16
#: Different words that a task counts before it hands them on.
HELD = 1 << 17

# Bits 0-25: one letter a to z or more; 26-51: two or more; 52-63: any of the other letters, folded.
_FOLDED = 12


def _tokens(letters: int, damage: int):
    """Words of texts as the task counts them."""
    run_of_letters = re.compile("[A-Za-zÀ-ÿ]{%d,}" % letters)

    def rows(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"]
        )

    def run(batches):
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                lowered = memoryview(text.as_buffer()).tobytes().lower().decode("utf-8", "replace")
                found = run_of_letters.findall(lowered)
                counts.update(found)
                for word in found:
                    h = crc32(word.encode(), seed)
                    if not h % damage:
                        at = h % len(word)
                        counts[word] -= 1
                        if len(word) > letters:
                            counts[word[:at] + word[at + 1 :]] += 1
                if len(counts) > HELD:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return run


def words(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, damage: int = DAMAGE) -> DataFrame:
    """word and n of every word that occurs often enough in ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("binary"))
    counted = texts.mapInArrow(_tokens(letters, damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def code_points(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points (at most 255 each) of an array of words, and where each word begins."""
    words = values.to_pylist()
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def letter_counts(letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each word's letter counts as a unary code: a word's bits are among those of any word with all its letters."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    plain = (letters >= 97) & (letters <= 122)
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    one = np.uint64(1)
    np.bitwise_or.at(out, row[~plain], one << (52 + letters[~plain] % _FOLDED).astype(np.uint64))
    counts = np.bincount(row[plain] * 26 + (letters[plain] - 97), minlength=26 * len(out)).reshape(-1, 26)
    bits = one << np.arange(52, dtype=np.uint64)
    out |= np.where(counts >= 1, bits[:26], np.uint64(0)).sum(axis=1, dtype=np.uint64)
    out |= np.where(counts >= 2, bits[26:], np.uint64(0)).sum(axis=1, dtype=np.uint64)
    return out


class Tree:
    """A K-d tree over letter counts: boxes of the nodes, two children each, leaves of few points."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.least, self.most, self.child, self.begin, self.end = [], [], [], [], []
        self.bits = []
        self._node(points, 0, len(points))
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = self.begin[node], self.end[node]
            if b - a <= leaf:
                continue
            held = points[self.order[a:b]]
            ones = _ones(held)
            bit = int(np.abs(2 * ones - (b - a)).argmin())
            if ones[bit] in (0, b - a):  # all points are equal
                continue
            has = (held >> np.uint64(bit)) & np.uint64(1) == 1
            part = self.order[a:b]
            self.order[a:b] = np.concatenate([part[~has], part[has]])
            middle = a + int(np.count_nonzero(~has))
            self.bits[node] = bit
            self.child[node] = len(self.least)
            self._node(points, a, middle)
            self._node(points, middle, b)
            todo += [self.child[node], self.child[node] + 1]
        self.least, self.most = np.array(self.least, dtype=np.uint64), np.array(self.most, dtype=np.uint64)
        self.child, self.bits = np.array(self.child), np.array(self.bits)
        self.begin, self.end = np.array(self.begin), np.array(self.end)

    def _node(self, points: np.ndarray, a: int, b: int):
        held = points[self.order[a:b]]
        self.least.append(np.bitwise_and.reduce(held) if b > a else 0)
        self.most.append(np.bitwise_or.reduce(held) if b > a else 0)
        self.child.append(-1)
        self.bits.append(-1)
        self.begin.append(a)
        self.end.append(b)


def _ones(values: np.ndarray) -> np.ndarray:
    """How many of the values set each bit."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _reach(tree, searches: np.ndarray, more: int):
    """(search, leaf) pairs, a part at a time: leaves whose boxes a search may reach.

    A point may have ``more`` letters that the search lacks, and lack one that the search has.
    """
    who = np.arange(len(searches))
    stack = [(who[k : k + PAIRS], np.zeros(min(PAIRS, len(who) - k), dtype=np.int64)) for k in range(0, len(who), PAIRS)]
    while stack:
        who, node = stack.pop()
        if len(who) > PAIRS:
            stack.append((who[PAIRS:], node[PAIRS:]))
            who, node = who[:PAIRS], node[:PAIRS]
        at = searches[who]
        near = np.bitwise_count(tree.least[node] & ~at) <= more
        near &= np.bitwise_count(at & ~tree.most[node]) <= 1
        who, node = who[near], node[near]
        last = tree.child[node] < 0
        if last.any():
            yield who[last], node[last]
        who, down = who[~last], tree.child[node[~last]]
        if len(who):
            stack.append((np.concatenate([who, who]), np.concatenate([down, down + 1])))


def _one_edit(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter, or by one that ``longer`` has more."""
    size = shorter.shape[1]
    same = longer[:, :size] == shorter
    if longer.shape[1] == size:
        return np.count_nonzero(~same, axis=1) == 1
    head = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= size


class Cells:
    """The top splits of the tree of one length: a cell for each leaf."""

    def __init__(self, tree: Tree):
        self.child, self.bits = tree.child, tree.bits
        # Boxes of whole half-spaces, for words that the sample lacks.
        self.least = np.zeros(len(tree.child), dtype=np.uint64)
        self.most = np.full(len(tree.child), np.iinfo(np.uint64).max)
        for node in range(len(tree.child)):
            if tree.child[node] >= 0:
                bit = np.uint64(1) << np.uint64(tree.bits[node])
                low, high = tree.child[node], tree.child[node] + 1
                self.least[[low, high]] = self.least[node], self.least[node] | bit
                self.most[[low, high]] = self.most[node] & ~bit, self.most[node]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.child[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = self.child[at] + ((points[inner] >> self.bits[at].astype(np.uint64)) & np.uint64(1)).astype(np.int64)


def _cells(vocabulary: DataFrame) -> dict[int, Cells]:
    """Top splits of each length with more than CELL words, from a sample of at most SAMPLE words."""
    sizes = vocabulary.groupBy("size").count().filter(F.col("count") > CELL).toArrow()
    sizes = dict(zip(sizes["size"].to_pylist(), sizes["count"].to_pylist()))
    if not sizes:
        return {}
    large = vocabulary.filter(F.col("size").isin(list(sizes)))
    rows = large.orderBy(F.xxhash64("word"), "word").select("word", "size").limit(SAMPLE).toArrow().combine_chunks()
    out = {}
    for size, n in sizes.items():
        some = rows.filter(pc.equal(rows["size"], size))["word"].combine_chunks()
        points = letter_counts(*code_points(some))
        if len(points):
            out[size] = Cells(Tree(points, max(8, -(-len(points) * CELL // n))))
    return out


ROUTED = "size int, cell int, search boolean, word string, n long"


def _routed(cells: dict[int, Cells]):
    """A word as a point of its own cell, and as a search in each cell that it may reach."""

    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = letter_counts(*code_points(batch.column(0)))
            parts = []
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                points = vectors[rows]
                own = cells[size].of(points) if size in cells else np.zeros(len(rows), dtype=np.int64)
                parts.append((rows, size, own, False))
                for other, more in ((size, 1), (size - 1, 0)):
                    if other not in cells:
                        parts.append((rows, other, np.zeros(len(rows), dtype=np.int64), True))
                        continue
                    for who, cell in _reach(cells[other], points, more):
                        parts.append((rows[who], other, cell, True))
            for rows, size, cell, search in parts:
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), size, dtype=np.int32)),
                        pa.array(cell.astype(np.int32)),
                        pa.array(np.full(len(rows), search)),
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                    ],
                    names=["size", "cell", "search", "word", "n"],
                )

    return run


NEAR = "word string, n_near long, form_n long, form string"


def _better(n: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A number that is larger for the word to prefer: more often, then first in order."""
    _, place = np.unique(n, return_inverse=True)
    return place * (len(n) + 1) + (len(n) - rank)


def _search(rows: pa.Table) -> pa.Table:
    """Near words of one part of a cell's points and of its searches: number and best one per word."""
    search = rows["search"].to_numpy()
    words, n = rows["word"].combine_chunks(), rows["n"].to_numpy()
    size = rows["size"][0].as_py()
    letters, bounds = code_points(words)
    lengths = np.diff(bounds)
    vectors = letter_counts(letters, bounds)
    points = np.flatnonzero(~search)
    order = np.empty(len(words), dtype=np.int64)
    by_word = pc.array_sort_indices(words.cast(pa.binary())).to_numpy()
    order[by_word] = np.arange(len(words))
    value = _better(n, order)
    n_near = np.zeros(len(words), dtype=np.int64)
    best = np.full(len(words), -1, dtype=np.int64)
    by_value = np.argsort(value)
    rank = np.empty(len(words), dtype=np.int64)
    rank[by_value] = np.arange(len(words))
    if len(points):
        tree = Tree(vectors[points], LEAF)
        ranked = points[tree.order]
        width = np.arange(int((tree.end - tree.begin)[tree.child < 0].max()))
        for length, more in ((size, 1), (size + 1, 0)):
            asked = np.flatnonzero(search & (lengths == length))
            for who, leaf in _reach(tree, vectors[asked], more):
                step = max(1, (1 << 20) // len(width))
                for k in range(0, len(who), step):
                    places = tree.begin[leaf[k : k + step], None] + width
                    valid = places < tree.end[leaf[k : k + step], None]
                    x = np.broadcast_to(asked[who[k : k + step], None], valid.shape)[valid]
                    y = ranked[places[valid]]
                    a, b = vectors[x], vectors[y]
                    near = (np.bitwise_count(b & ~a) <= more) & (np.bitwise_count(a & ~b) <= 1)
                    x, y = x[near], y[near]
                    good = np.zeros(len(x), dtype=bool)
                    for j in range(0, len(x), max(1, (1 << 22) // (size + 1))):
                        part = slice(j, j + max(1, (1 << 22) // (size + 1)))
                        longer = letters[bounds[x[part], None] + np.arange(length)]
                        shorter = letters[bounds[y[part], None] + np.arange(size)]
                        good[part] = _one_edit(longer, shorter)
                    x, y = x[good], y[good]
                    n_near += np.bincount(x, minlength=len(words))
                    np.maximum.at(best, x, rank[y])
                    if length > size:
                        n_near += np.bincount(y, minlength=len(words))
                        np.maximum.at(best, y, rank[x])
    found = np.flatnonzero(n_near)
    form = by_value[best[found]]
    return pa.table(
        {
            "word": words.take(pa.array(found)),
            "n_near": pa.array(n_near[found]),
            "form_n": pa.array(n[form]),
            "form": words.take(pa.array(form)),
        }
    )


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n_near, form_n and form (the near word of largest n) of words that have a near word.

    ``vocabulary`` has distinct words of the letters that ``words`` takes, and n. It is read often.
    """
    sized = vocabulary.select("word", "n", F.length("word").alias("size"))
    rows = staged(sized.mapInArrow(_routed(_cells(sized)), ROUTED), "routed")
    held = rows.groupBy("size", "cell").agg(
        F.ceil(F.count_if(~F.col("search")) / POINTS).alias("_p"), F.ceil(F.count_if("search") / SEARCHES).alias("_s")
    )
    held = held.filter("_p > 0 and _s > 0")
    dealt = lambda n: F.array(F.pmod(F.xxhash64("word"), F.col(n)))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    parts = rows.join(held, ["size", "cell"]).select(
        "size", "cell", "search", "word", "n",
        F.when(F.col("search"), upto("_p")).otherwise(dealt("_p")).alias("_p"),
        F.when(F.col("search"), dealt("_s")).otherwise(upto("_s")).alias("_s"),
    )
    parts = parts.withColumn("p", F.explode("_p")).withColumn("s", F.explode("_s")).drop("_p", "_s")
    keys = ["size", "cell", "p", "s"]
    # Few bytes, much work: as many tasks as the session asks for, not as their bytes suggest.
    parts = parts.repartition(int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    found = parts.groupBy(*keys).applyInArrow(_search, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("_best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("_best.less")).alias("form_n"), F.col("_best.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of words that have a form: each round doubles the way along forms.

    n grows fivefold with each form, so ways have fewer than 28 steps and five rounds are enough.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = staged(
            roots.join(ahead, F.col("root") == F.col("_word"), "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            ),
            "roots",
        )
        if further.filter("moved").isEmpty():
            return further.drop("moved")
        roots = further.drop("moved")


def spelling_variants(docs: DataFrame, ratio: int = RATIO, **which) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text).

    Words are longest runs of letters (A to Z lower-cased), some damaged by a rule that depends on
    the id and the run; see ``words`` for ``which``. Near words differ by exactly one inserted,
    deleted or replaced code point. The form is the near word of largest n, the first in code-point
    order of equals, if that is at least ``ratio`` times the word's n; the root ends the way along
    forms. Null and empty texts have no words; a null id counts as an empty one. Repeated rows count
    as often as they stand there. Words of any length take part whole. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    vocabulary = staged(words(docs, **which), "words")
    near = near_words(vocabulary).withColumnsRenamed({"word": "_word", "form": "_form"})
    known = vocabulary.join(near, F.col("word") == F.col("_word"), "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    known = staged(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("_form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.filter(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    out = known.join(roots, F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The checksum byte by byte; near words by what is left when a letter goes.
_SQL = """WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
  counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS label, run, count(*) AS n FROM runs
    GROUP BY doc_id, run),
  spelled AS (SELECT run, n, hex(encode(label)) AS h FROM counted),
  checked AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) AS h FROM spelled),
  damaged AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
      ELSE run END AS word, n FROM checked),
  vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word
    HAVING sum(n) >= 5),
  places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
  shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
  less AS (SELECT DISTINCT s.word AS a, s.n AS na, v.word AS b, v.n AS nb FROM shorter s JOIN vocabulary v ON v.word = s.rest),
  near AS (SELECT a AS word, b AS other, nb AS other_n FROM less UNION ALL SELECT b, a, na FROM less
    UNION ALL SELECT x.word, y.word, y.n FROM shorter x JOIN shorter y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
  best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
    FROM near GROUP BY word),
  forms AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
      CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
  ways AS (SELECT word, word AS root FROM forms WHERE form IS NULL
    UNION ALL SELECT f.word, w.root FROM forms f JOIN ways w ON f.form = w.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ways USING (word)"""


@query("op11_spelling", _SQL)
def spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
