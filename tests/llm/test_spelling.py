import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bidscope.llm import spelling as P

LETTERS = "abcdefghijklmnopqrstuvwxyzàéÿ"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(rows, occurrences=5, damage=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= occurrences}
    by_size = defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    near = {w: [v for s in (len(w) - 1, len(w), len(w) + 1) for v in by_size[s] if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def found(df, **which):
    got = [tuple(r) for r in P.spelling_variants(df, **which).collect()]
    return sorted(got, key=lambda r: r[0])


@pytest.fixture(scope="module")
def rows():
    """Families of words around frequent ones: typos, chains of rarer typos, ties, anagrams, long words."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list(LETTERS[:9] + "éÿ"), n))
    texts, n = [], 0
    for _ in range(60):
        base, times = word(int(rng.integers(5, 11))), int(rng.integers(30, 200))
        forms = [(base, times)]
        for _ in range(6):
            at, kind = int(rng.integers(len(base))), int(rng.integers(3))
            new = base[:at] + (word(1) if kind else "") + base[at + (kind < 2) :]
            forms.append((new, int(rng.integers(3, 40))))
            forms.append((new[::-1], 6))
            forms.append((new[:2] + word(1) + new[2:], 5))
        for w, k in forms:
            texts.append(" ".join([w, w.upper() if w.isascii() else w] * k))
    texts += ["x" * 300 + " " + "x" * 299 + " " + "x" * 150 + "y" + "x" * 149] * 6
    texts += ["Grün-GRÜN ÀÉÎÕÜß àéîõüß müsste? musste; ×÷×÷×÷×÷", None, "", "short", "  "] * 6
    return list(enumerate(texts))


def frame(documents, rows, **extra):
    return documents([(i, t, "s") for i, t in rows], **extra)


@pytest.mark.parametrize("sizes", [{}, {"CELL": 20, "SAMPLE": 100, "POINTS": 7, "SEARCHES": 5, "LEAF": 3, "PAIRS": 50}, {"CELL": 8, "HELD": 9}])
def test_equals_all_pairs(documents, rows, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(P, name, value)
    extra = {"word": F.lit("x"), "n": F.lit(0), "size": F.lit(1), "_word": F.lit(2)} if sizes else {}
    got = found(frame(documents, rows, **extra))
    assert got == sorted(expected(rows)) and len(got) > 300
    assert any(r[1] and r[2] != r[1] for r in got)  # a root beyond the form


def test_other_limits_and_damage(documents, rows):
    assert found(frame(documents, rows), occurrences=2, damage=3) == expected(rows, 2, 3)


def test_missing_ids_repeated_rows_and_empty_tables(documents):
    text = "letters letterz letters lettters " * 3
    rows = [(None, text), (1, text), (1, text), (2, None)]
    assert found(frame(documents, rows)) == expected(rows)
    assert found(frame(documents, rows).limit(0)) == []


def test_trees_leave_out_nothing():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdé"), 6)) for _ in range(500)]
    vectors = P.letter_counts(*P.code_points(pa.array(words)))
    tree = P.Tree(vectors, 5)
    places = defaultdict(list)
    for who, leaf in P._reach(tree, vectors, 1):
        for w, at in zip(who.tolist(), leaf.tolist()):
            places[w] += tree.order[tree.begin[at] : tree.end[at]].tolist()
    for i, a in enumerate(words):
        assert len(places[i]) == len(set(places[i]))
        assert {j for j, b in enumerate(words) if one_edit(a, b)} <= set(places[i])
