import numpy as np
import pyarrow as pa

from bidscope.llm import bitmap
from bidscope.llm import words as W

TEXTS = ["One two\tTHREE", "", None, "  \n ", "é\u00a0x y", "one", "a" * 3000, "\u3000 ok \x0b\x0cz"]


def test_words_are_found_whatever_the_slices(words, monkeypatch):
    for limit in (1, 10, 1 << 20):
        monkeypatch.setattr(W, "SLICE_BYTES", limit)
        counts, seen = [], {}
        data, offsets = W.raw(pa.array(TEXTS))
        for lo, hi in W.slices(offsets, limit):
            w = W.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            counts += np.diff(w.first).tolist()
            for doc, h in zip(w.doc + lo, w.hash):
                seen.setdefault(int(h), set()).add(int(doc))
        assert counts == [len(words(t)) for t in TEXTS]
        # Only "one" is in two texts.
        assert sorted(map(tuple, map(sorted, seen.values())))[:1] == [(0,)]
        assert [s for s in seen.values() if len(s) > 1] == [{0, 5}]


def test_punctuation_around_words_can_be_dropped():
    def hashes(text):
        return [h for _, _, w in W.each(pa.array([text]), trim=True) for h in w.hash.tolist()]

    assert hashes('"Well," (said) - he... it\'s!') == hashes("well said he it's")
    assert hashes("--- !!") == []


def test_windows_of_words():
    (_, _, w), = W.each(pa.array(["a b c a b c a"]))
    h = W.windows(w.hash, 3, 1)
    assert len(h) == 5 and h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 3
    assert len(W.windows(w.hash, 8, 1)) == 0


def test_bitmap_holds_its_members(spark):
    held = bitmap.build(spark.range(0, 5000, 5).select("id"), bits=16)
    values = np.arange(5000, dtype=np.int64)
    inside = bitmap.holds(held, values)
    assert inside[::5].all() and inside.sum() < 1200
    rows = spark.range(20).selectExpr("nullif(id, 3) as v")
    kept = {r.v for r in rows.filter(bitmap.may_hold(held, rows["v"])).collect()}
    assert {0, 5, 10, 15} <= kept and None not in kept
    assert not bitmap.holds(bitmap.build(spark.range(0).select("id"), bits=16), values).any()
