import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bidscope.llm import mixing


def corpus(prose, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(prose(3 + i % 5, i)), source))
            i += 1
    return rows


def shown(documents, rows, **kw):
    return mixing.mix(documents(rows), **kw).collect()


def test_everything_is_shown_and_repeats_stay_in_bounds(documents, prose):
    rows = corpus(prose, {"a": 120, "b": 30, "c": 7, None: 5})
    got = shown(documents, rows, repeat_limit=3.0)
    times = Counter(r.doc_id for r in got)
    assert set(times) == {r[0] for r in rows}
    tokens = Counter()
    for i, text, source in rows:
        tokens[source] += len(text.split())
    epochs = {s: sum(r.tokens for r in got if r.source_key == ("" if s is None else f"={s}")) / tokens[s] for s in tokens}
    assert epochs["a"] == 1.0
    assert max(epochs.values()) <= 3.0 and epochs[None] > 2.4
    # Flattening goes as far as the limit allows: smaller sources are repeated more often.
    assert epochs["a"] < epochs["b"] < epochs["c"] <= epochs[None]


def test_each_epoch_is_a_permutation_of_its_own(documents, prose):
    got = shown(documents, corpus(prose, {"a": 200, "b": 40}), repeat_limit=2.0)
    orders = {}
    for r in got:
        orders.setdefault((r.source_key, r.epoch), []).append((r.block_place, r.place, r.doc_id))
    for (source, epoch), places in orders.items():
        assert len({p[:2] for p in places}) == len(places) == len({p[2] for p in places})
    whole = [p for (s, e), p in orders.items() if s == "=b" and len(p) == 40]
    assert whole and all([d for *_, d in sorted(p)] != sorted(d for *_, d in p) for p in whole)
    blocks = Counter(r.block for r in got if r.source_key == "=a")
    assert len(blocks) <= math.ceil(math.sqrt(200))


def test_exponent_meets_its_target(documents, prose):
    units = mixing.unit_table(documents(corpus(prose, {"a": 100, "b": 20, "c": 4})))
    sources = mixing.source_table(units)
    tokens = [r.tokens for r in sources.collect()]

    def entropy(e):
        w = [t**e for t in tokens]
        return -sum(x / sum(w) * math.log2(x / sum(w)) for x in w)

    e = mixing.find_exponent(sources, entropy=1.3)
    assert 0 < e < 1 and entropy(e) == pytest.approx(1.3, abs=1e-9)
    e = mixing.find_exponent(sources, repeat_limit=4.0)
    assert (max(tokens) / min(tokens)) ** (1 - e) == pytest.approx(4.0, rel=1e-9)
    assert mixing.find_exponent(sources, entropy=9.0) == 0.0
    assert mixing.find_exponent(sources, entropy=0.1) == 1.0
    assert mixing.find_exponent(sources, repeat_limit=1e9) == 0.0
    with pytest.raises(ValueError):
        mixing.find_exponent(sources)


def test_budget_is_kept(documents, prose):
    rows = corpus(prose, {"a": 100, "b": 20})
    total = sum(len(t.split()) for _, t, _ in rows)
    got = shown(documents, rows, budget=total // 2, entropy=0.9)
    spent = sum(r.tokens for r in got)
    assert total // 2 - 20 <= spent <= total // 2


def test_odd_rows(documents):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, None, "s"), (None, "", None), (3, "c", "t")]
    got = shown(documents, rows)
    assert {(r.source_key, r.doc_id) for r in got} == {("=s", 1), ("=s", 2), ("", None), ("=t", 3)}
    assert {r.rows for r in got if r.doc_id == 1} == {2}
    df = documents(rows, tokens=F.lit(1), block=F.lit(2), source_key=F.lit("x"))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert times[1] % 2 == 0 and set(times) == {1, 2, None, 3}
    assert mixing.mixed_documents(df.limit(0)).collect() == [] == mixing.mix(df.limit(0)).collect()


def test_plan_is_native(documents, prose):
    plan = mixing.mix(documents(corpus(prose, {"a": 5})))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_clashing_columns_pass_through(documents, prose):
    names = ["_key", "_id", "_hash", "_row", "_time", "row", "_t_key", "_t_id", "_times", "tokens", "rows"]
    rows = [*corpus(prose, {"a": 40, "b": 3, None: 2}), (None, None, None), (1, "twice", "a")]
    df = documents(rows).withColumns({n: F.lit(f"own {n}") for n in names})
    got = mixing.mixed_documents(df).collect()
    assert all(r[n] == f"own {n}" for r in got for n in names) and got[0].__fields__ == df.columns
    shown = Counter((r.doc_id, r.text, r.source) for r in got)
    assert set(shown) == {(i, t, s) for i, t, s in rows} and max(shown.values()) > 1
    assert mixing.mixed_documents(df.limit(0)).collect() == []
