from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import near_dedup as N
from bidscope.llm.components import components


def shingles(text, words):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def expected(rows, words, threshold=85):
    sets = [shingles(t, words) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(zip([i for i, _ in rows], sets), 2):
        if a and b and 100 * len(a & b) >= threshold * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)}


def found(documents, rows, **kw):
    df = documents([(i, t, "s") for i, t in rows])
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df, **kw).collect()}


def edited(base, places, tag):
    out = list(base)
    for p in places:
        out[p] = f"{tag}{p}"
    return " ".join(out)


@pytest.fixture(scope="module")
def family(prose):
    """Copies of a text with more and more edits, chains of edits, and texts that share a passage."""
    base, rng = prose(300, 1), np.random.default_rng(3)
    rows = [(100, " ".join(base)), (101, " ".join(base).upper()), (7, " \n".join(base))]
    for k in range(60):
        places = rng.choice(300, size=int(rng.integers(1, 14)), replace=False)
        rows.append((200 + k, edited(base, places, f"e{k}x")))
    text = prose(300, 2)
    for k in range(12):  # each one close to the one before, the ends far apart
        text = list(text)
        text[10 + 20 * k] = f"c{k}"
        text[15 + 20 * k] = f"d{k}"
        rows.append((400 + k, " ".join(text)))
    passage = prose(120, 3)
    rows += [(500 + k, " ".join(passage + prose(150, 50 + k))) for k in range(40)]
    rows += [(600 + k, " ".join(prose(k, 90 + k))) for k in range(1, 12)]
    rows += [(700, "one two three four"), (701, "ONE two\tthree four"), (702, "one two three"), (703, ""), (704, None), (705, " ")]
    rows += [(710, " ".join(prose(11, 5))), (711, " ".join(prose(12, 5)))]
    return rows


@pytest.mark.parametrize("threshold", [85, 80])
def test_equals_all_pairs(documents, words, family, threshold):
    assert found(documents, family, threshold=threshold) == expected(family, words, threshold)


def test_odd_ids(documents, prose):
    a, b = " ".join(prose(40, 1)), " ".join(prose(40, 2))
    rows = [(5, a), (5, a), (9, a), (9, b), (12, b), (None, a), (None, "x y"), (20, None), (21, "")]
    df = documents([(i, t, "s") for i, t in rows], component_id=F.lit("x"), bands=F.lit(1))
    got = [tuple(r) for r in N.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (5, 36, 5, True),
            (5, 36, 5, True),
            (9, 36, 5, False),
            (9, 36, 5, False),
            (12, 36, 5, False),
            (None, 36, 5, False),
            (None, 1, None, True),
            (20, 0, 20, True),
            (21, 0, 21, True),
        ],
        key=str,
    )
    assert N.near_duplicates(df.limit(0)).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    for size, shared in ((400, 300), (20, 15), (6, 5)):
        agree = []
        for _ in range(60):
            x = rng.permutation(pool)[: 2 * size - shared]
            both = [np.sort(x[:size]), np.sort(x[size - shared :])]
            doc = np.repeat([0, 1], size)
            s = N.signatures(2, doc, np.concatenate(both))
            agree.append((s[0] == s[1]).mean())
        assert np.mean(agree) == pytest.approx(shared / (2 * size - shared), abs=0.05)
    assert (N.signatures(3, np.array([1]), np.array([77], dtype=np.uint64))[1] == 77).all()


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90 - k) for k in range(20)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 71 for i in [*range(71, 91), 100]}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_group_of_copies_gives_a_star(documents, prose, monkeypatch):
    """Candidates of near copies stay in proportion to their number."""
    base, seen = prose(200, 8), {}
    rows = [(k, edited(base, [k % 200], f"z{k}")) for k in range(300)]
    links = N._links

    def counted(pairs, texts, threshold):
        seen[len(seen)] = pairs.count()
        return links(pairs, texts, threshold)

    monkeypatch.setattr(N, "_links", counted)
    got = found(documents, rows)
    assert {c for _, c, _ in got.values()} == {0}
    assert seen[0] < 12 * len(rows) and seen[1] < 12 * len(rows)


def test_every_link_shares_a_bucket():
    """The chance that two documents at the threshold share no band."""
    assert (1 - 0.85**N.BAND) ** N.BANDS < 1e-10 and (1 - 0.8**N.BAND) ** N.BANDS < 1e-7
    groups = defaultdict(int)
    for t in range(2000):
        groups[tuple(N._attempt(t)[:1])] += 1
    assert len(groups) == N.BINS
