import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import repeats as R


def expected(texts, length):
    """Removed bytes by counting every string, and where it starts."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df, length):
    got = R.remove_repeats(df, length, passage=None).collect()
    return [tuple(r)[1:5] for r in sorted(got, key=lambda r: r.doc_id)]


@pytest.fixture(scope="module")
def texts(prose):
    base = " ".join(prose(120, 1))
    passage = " ".join(prose(20, 2))
    out = [base, base, base[:300] + "EDIT" + base[300:], base[100:], "é" + base[:400] + "😀", None, "", "short", "a" * 900]
    out += [base[:200] + " ".join(prose(30, 3)) + base[200:], "ab" * 300 + "c", "x" + "ab" * 300]
    out += [" ".join(prose(9, 20 + k)) + " " + passage + " " + " ".join(prose(9, 60 + k)) for k in range(30)]
    out += [" ".join(prose(60, 7)) * 2, base[:80] + "|" + base[:80] + "|" + base[:79], "é" * 200, "é" * 200 + "e"]
    return out


@pytest.mark.parametrize("length, hot", [(80, 512), (80, 3), (33, 512), (150, 1)])
def test_equals_counting_every_string(documents, texts, monkeypatch, length, hot):
    monkeypatch.setattr(R, "HOT", hot)
    df = documents([(i, t, "s") for i, t in enumerate(texts)], spans=F.lit("x"), key=F.lit(1))
    assert found(df, length) == expected(texts, length)


def test_small_slices_and_blocks(documents, texts, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 100)
    assert found(documents([(i, t, "s") for i, t in enumerate(texts)]), 50) == expected(texts, 50)


def test_expansion_equals_counting():
    rng = np.random.default_rng(1)
    for k in range(80):
        length = int(rng.integers(1, 9))
        x = np.append(rng.integers(1, 3 if k % 2 else 6, int(rng.integers(1, 300))), 0)
        seen = Counter(x[i : i + length].tobytes() for i in range(len(x) - length + 1))
        want = [i + length <= len(x) and seen[x[i : i + length].tobytes()] > 1 for i in range(len(x))]
        assert R.repeated_suffixes(x, length).tolist() == want


def test_ids_and_empty_tables(documents, prose):
    text = " ".join(prose(60, 1))
    df = documents([(1, text, "s"), (1, text, "s"), (None, text[:300], "s"), (None, "", "s"), (2, None, "s")])
    got = R.remove_repeats(df, 50, passage=None).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in got) == sorted(
        [("1", len(text), len(text))] * 2 + [("None", 300, 300), ("None", 0, 0), ("2", 0, 0)]
    )
    assert R.remove_repeats(df.limit(0), 50).collect() == []
    shared = sum(a == b for a, b in zip(text[:300].split(), text.split()))  # the last word may be cut
    assert {r.n_passage_words for r in R.remove_repeats(df, 50, 6).collect()} == {0, shared, 60}


def passage_words(texts, words, more_than):
    """Words in passages of more than so many words that occur again, by counting all of them."""
    split, size = [words(t) for t in texts], more_than + 1
    seen = Counter(tuple(w[k : k + size]) for w in split for k in range(len(w) - size + 1))
    out = []
    for w in split:
        held = set()
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                held |= set(range(k, k + size))
        out.append(len(held))
    return out


def test_passages_shorter_than_removed_strings_are_reported(documents, prose, words):
    passage, other = prose(51, 1), prose(50, 2)
    texts = [" ".join(prose(30, 10 + k) + passage + prose(20, 50 + k)) for k in range(12)]
    texts += [" ".join(prose(9, 90 + k) + other + prose(9, 95 + k)) for k in range(3)]  # too short a passage
    texts += [" ".join(passage[:40] + ["edit"] + passage[40:]), " ".join(w.upper() for w in passage), None, "", " "]
    texts += [" ".join(prose(60, 7)), " ".join(prose(60, 7) + prose(200, 8)), " ".join(prose(55, 9) * 3), " ".join(prose(400, 11))]
    got = R.remove_repeats(documents([(i, t, "s") for i, t in enumerate(texts)]), 10_000).orderBy("doc_id").collect()
    assert [r.n_passage_words for r in got] == passage_words(texts, words, 50)
    assert got[0].n_passage_words == 51 and got[0].n_removed == 0 and got[12].n_passage_words == 0


def test_classes_of_crowded_keys_are_not_broadcast(spark):
    """Each is dealt to 64 parts, after Spark has measured them."""
    fields = ["id AS doc_id", "xxhash64(id) AS text_hash", "id % 501 AS key", "1L AS win", "0 AS start", "2 AS starts"]
    rows = spark.range(1000).selectExpr(*fields).withColumn("n", F.lit(R.HOT + 1))
    classes = rows.groupBy("key", "win").agg(F.count("*").alias("weight"), F.max("n").alias("n"))
    spans = R._counted_spans(rows, classes, 80)
    assert sorted((r.doc_id, r.begin, r.end) for r in spans.collect()) == [(k, 0, 81) for k in range(1000) if k % 501 < 499]
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
