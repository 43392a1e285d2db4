from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bidscope.llm import simhash as S


def expected_print(text, words):
    w = words(text)
    n = max(1, len(w) - 3) if w else 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(prints):
    """Component of each fingerprint, by looking at all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def partition(labels):
    groups = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, []).append(i)
    return sorted(groups.values())


@pytest.fixture(scope="module")
def prints():
    """Random fingerprints, clusters, chains of small steps, and neighbours at exactly four and five bits."""
    rng = np.random.default_rng(5)
    out = [int(x) for x in rng.integers(0, 1 << 63, 200, dtype=np.uint64) * 2 + rng.integers(0, 2, 200, dtype=np.uint64)]
    flip = lambda x, n: x ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False))
    center = out[0]
    out += [flip(center, int(rng.integers(1, 4))) for _ in range(300)]
    step = out[1]
    for _ in range(30):
        step = flip(step, 4)
        out.append(step)
    out += [flip(x, 4) for x in out[2:30]] + [flip(x, 5) for x in out[30:60]] + [0, (1 << 64) - 1]
    return sorted(set(out))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block, tile, blocks", [(1 << 16, 1 << 14, 5), (64, 32, 5), (50, 1 << 14, 6), (128, 20, 8)])
def test_all_links_are_found(spark, prints, monkeypatch, block, tile, blocks):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "TILE", tile)
    monkeypatch.setattr(S, "blocks_for", lambda rows: blocks)
    df = spark.createDataFrame([(signed(x),) for x in prints], "print long")
    got = {r.print: r.label for r in S.near_components(df).collect()}
    labels = [got.get(signed(x), signed(x)) for x in prints]
    assert partition(labels) == partition(components(prints))
    for x, label in got.items():
        assert label == min(y for y, other in got.items() if other == label)


def test_index_links_and_prunes(prints, monkeypatch):
    monkeypatch.setattr(S, "PAIRS", 7)
    values = np.array(prints, dtype=np.uint64)
    values = values[np.argsort(S.gray_rank(values))]
    cell = np.sort(np.arange(len(values)) * 3 // len(values))
    for cells in (np.zeros(len(values), dtype=np.int64), cell):
        label = S.linked(cells, values, np.arange(len(values)))
        for c in np.unique(cells):
            held = np.flatnonzero(cells == c)
            assert partition(label[held].tolist()) == partition(components([int(x) for x in values[held]]))


def test_gray_rank_and_routes():
    ranks = S.gray_rank(np.arange(256, dtype=np.uint64))
    order = np.argsort(ranks)
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()
    for blocks in (5, 6, 7, 8):
        for lead, parts in S.routes(blocks):
            assert sum(w for _, w in parts) == 64 and 0 < lead <= 32
            bits = sorted(b for shift, w in parts for b in range(shift, shift + w))
            assert bits == list(range(64))
    assert [S.blocks_for(n) for n in (0, 10**5, 10**8, 10**10, 10**12)] == [5, 5, 6, 7, 8]


def test_documents(documents, prose, words):
    base = prose(400, 1)
    texts = [" ".join(base), " ".join(base).upper(), "\n ".join(base), None, "", " \t", "one", "one two three", "one  TWO three"]
    for k in range(40):
        edited = list(base)
        edited[k * 9] = f"e{k}"
        texts.append(" ".join(edited))
    texts += [" ".join(prose(80, 50 + k)) for k in range(20)] + ["é ü " * 9, "a b c d " * 300, " ".join(prose(70000, 9))]
    rows = [(1000 - i, t, "s") for i, t in enumerate(texts)] + [(5, texts[0], "s"), (5, texts[70 % len(texts)], "s")]
    df = documents(rows, print=F.lit("x"), label=F.lit(1), least=F.lit(None).cast("long"))
    got = sorted(tuple(r) for r in S.simhash_duplicates(df).collect())
    prints = [expected_print(t, words) for _, t, _ in rows]
    labels = components(prints)
    least = {}
    for (i, _, _), label in zip(rows, labels):
        least[label] = min(i, least.get(label, i))
    assert got == sorted((i, f"{p:016x}", least[label]) for (i, _, _), p, label in zip(rows, prints, labels))


def test_missing_ids_and_empty_tables(documents, prose):
    text, other = " ".join(prose(50, 1)), " ".join(prose(50, 2))
    df = documents([(None, text, "s"), (9, text, "s"), (None, other, "s"), (None, other, "s"), (3, None, "s"), (4, "", "s")])
    got = sorted((str(r.doc_id), str(r.component_id)) for r in S.simhash_duplicates(df).collect())
    assert got == [("3", "3"), ("4", "3"), ("9", "9"), ("None", "9"), ("None", "None"), ("None", "None")]
    empty = S.simhash_duplicates(df.limit(0))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.collect() == []
