import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import decontaminate as D


def brute(text, item, shortest):
    """Greedy string tiling as it is defined: the longest common unmarked run, again and again."""
    used_t, used_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (
                    p + n < len(item)
                    and t + n < len(text)
                    and item[p + n] == text[t + n]
                    and p + n not in used_i
                    and t + n not in used_t
                ):
                    n += 1
                best = max(best, (n, -p, -t))
        n, p, t = best[0], -best[1], -best[2]
        if n < shortest:
            return total
        used_i |= set(range(p, p + n))
        used_t |= set(range(t, t + n))
        total += n


def test_tiling_equals_its_definition():
    rng = np.random.default_rng(4)
    for k in range(120):
        kinds = int(rng.integers(2, 12))
        item = rng.integers(1, kinds + 1, int(rng.integers(1, 30))).astype(np.uint64)
        text = rng.integers(1, kinds + 1, int(rng.integers(1, 60))).astype(np.uint64)
        if k % 2:
            cut = len(item) // 2
            text = np.concatenate([text, item[cut:], text[:5], item[:cut]])
        tiles = D.tile(text, item, 3)
        places_t = [t + x for t, _, n in tiles for x in range(n)]
        places_i = [p + x for _, p, n in tiles for x in range(n)]
        assert len(set(places_t)) == len(places_t) == len(set(places_i)) == len(places_i)
        assert all((text[t : t + n] == item[p : p + n]).all() and n >= 3 for t, p, n in tiles)
        # Ties may be marked in another order, which can leave a little more or less.
        assert abs(sum(n for *_, n in tiles) - brute(text.tolist(), item.tolist(), 3)) <= 6


@pytest.fixture(scope="module")
def items(prose):
    return {1: prose(40, 1), 2: prose(25, 2), 3: prose(4, 3), 4: prose(60, 4)}


@pytest.fixture(scope="module")
def benchmark(spark, items):
    rows = [(i, " ".join(w)) for i, w in items.items()] + [(5, None), (6, ""), (None, " ".join(items[2]))]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("words", F.lit("x"))


def found(df, benchmark, **kw):
    return {(r.doc_id, r.item_id): (r.covered_words, r.item_words) for r in D.contamination(df, benchmark, **kw).collect()}


def test_passages_are_found_however_they_are_placed(documents, benchmark, items, prose):
    one, four = items[1], items[4]
    fill = prose(200, 9)
    texts = {
        10: " ".join(fill[:50] + one + fill[50:]),
        11: " ".join(fill[:9] + one[20:] + fill[9:60] + one[:20] + fill[60:]),  # halves swapped
        12: " ".join(fill + [w.upper() + "," for w in one]),
        13: " ".join(fill + one[:20]),  # half of it
        14: " ".join(fill),
        15: " ".join(items[3] * 5),  # too short an item
        16: " ".join(four[40:] + fill[:7] + four[20:40] + fill[7:14] + four[:20] + one),
        17: " ".join(w for x in zip(one, fill) for w in x),  # never five words in a row
        18: None,
        19: "",
        20: "(" + ") (".join(one) + ")",
    }
    got = found(documents([(i, t, "s") for i, t in texts.items()]), benchmark)
    assert {k: v for k, v in got.items() if k[1] in (1, 4)} == {
        (10, 1): (40, 40), (11, 1): (40, 40), (12, 1): (40, 40), (16, 1): (40, 40), (16, 4): (60, 60), (20, 1): (40, 40)
    }
    assert found(documents([(13, texts[13], "s")]), benchmark, coverage=0.5) == {(13, 1): (20, 40)}


def test_rows_ids_and_empty_tables(spark, documents, benchmark, items, prose):
    leak, fine = " ".join(prose(9, 7) + items[2]), " ".join(prose(30, 8))
    rows = [(1, leak, "s"), (1, leak, "s"), (1, fine, "s"), (None, leak, "s"), (None, fine, "s"), (2, fine, "s"), (3, None, "s")]
    df = documents(rows, text_hash=F.lit("x"), stretches=F.lit(1))
    got = D.contamination(df, benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 2), (1, None), (None, 2), (None, None)}
    assert got.count() == 4
    clean = D.clean(df, benchmark)
    assert clean.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(
        [(1, fine), (None, fine), (2, fine), (3, None)], key=str
    )
    assert D.contamination(df.limit(0), benchmark).collect() == []
    assert D.contamination(df, benchmark.limit(0)).collect() == [] and D.clean(df, benchmark.limit(0)).count() == 7


def test_a_passage_in_very_many_texts_and_a_very_long_text(documents, benchmark, items, prose):
    rows = [(k, " ".join(prose(20, 100 + k) + items[1]), "s") for k in range(300)]
    rows.append((999, " ".join(prose(200_000, 5) + items[4] + prose(1000, 6)), "s"))
    rows.append((998, " ".join(items[2] * 3000), "s"))
    got = found(documents(rows), benchmark)
    assert {k for k in got if k[1] is not None} == {(k, 1) for k in range(300)} | {(999, 4), (998, 2)}


def test_a_phrase_of_very_many_texts_and_items_creates_no_pairs(spark, documents, prose, monkeypatch):
    """Every item and document share a question's stem; some documents hold items. All pairs tiled tell the same."""
    stem = ["which", "of", "the", "following", "is"]
    items = {k: prose(4, 1) + stem + prose(8 + k % 30, 1000 + k) for k in range(60)}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    rows = [(k, " ".join(prose(20, 5000 + k) + prose(4, 1) + stem + prose(20, 9000 + k)), "s") for k in range(200)]
    for k in range(40):  # items whole, in part and cut up
        w = items[k]
        cut = len(w) * (k % 5 + 3) // 8
        rows.append((500 + k, " ".join(prose(9, k) + w[cut:] + prose(3, k + 1) + w[: cut * (k % 3) // 2]), "s"))
    df, tiled = documents(rows), []
    run = D.possible_pairs
    monkeypatch.setattr(D, "possible_pairs", lambda *a: tiled.append(run(*a)) or tiled[-1])
    got = found(df, benchmark)
    assert tiled[0].count() < 100  # of 14,400
    every = lambda seeds, items, _: seeds.select("doc_id", "text_hash").distinct().join(items.select("_item").distinct(), F.lit(True))
    monkeypatch.setattr(D, "possible_pairs", every)
    assert got == found(df, benchmark) and len(got) > 15
    assert found(df, benchmark, coverage=0.3) and all(k[0] >= 500 for k in got)


def test_clashing_columns_pass_through(documents, benchmark, items, prose):
    names = ["_key", "_id", "_hash", "_row", "_time", "row", "_doc_id", "_text_hash", "seed", "words"]
    rows = [(1, " ".join(items[1]), "s"), (2, " ".join(prose(30, 8)), "s"), (None, None, "s")]
    df = documents(rows, **{n: F.lit(f"own {n}") for n in names})
    got = D.clean(df, benchmark).collect()
    assert sorted(str(r.doc_id) for r in got) == ["2", "None"]
    assert all(r[n] == f"own {n}" for r in got for n in names) and got[0].__fields__ == df.columns
