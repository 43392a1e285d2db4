import math
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from test_near_dedup import shingles

import corpus_pipeline as P
from bidscope.llm import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, documents, prose, tmp_path_factory):
    """Documents of every kind the stages decide about, and a benchmark."""
    item = prose(30, 1)

    def text(n, seed):
        w = prose(n, seed)
        return "\n".join(" ".join(w[k : k + 12]).capitalize() + "." for k in range(0, n, 12))

    rows = [(k, text(60 + k, 10 + k), "big") for k in range(40)]
    rows += [(100 + k, text(70, 200 + k), "small") for k in range(8)]
    rows += [(200, rows[3][1], "big"), (201, rows[3][1].upper(), "small")]  # copies of 3
    rows += [(202, rows[5][1] + " One more.", "big"), (4, rows[4][1], "big")]  # near 5; row 4 twice
    rows += [(300, text(40, 77) + "\n" + " ".join(item) + ".", "small")]  # holds a benchmark item
    rows += [(400, " | ".join(prose(60, 5)), "big"), (401, None, "big"), (402, "", "small"), (403, "too short.", "big")]
    rows += [(500, text(50, 88) + "\nAll rights reserved.", None), (None, text(50, 99), "small"), (None, text(50, 99), "small")]
    path = tmp_path_factory.mktemp("corpus")
    documents(rows).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The input of every stage, and the last result."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        out.append(docs)
        path = f"{folder}/out-{len(out)}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != P.STAGES[-1][0]:
            assert docs.dtypes == out[-1].dtypes
    return [*out, docs]


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_the_named_ones():
    names = [name for name, _ in P.STAGES]
    assert names == ["quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {q.split("_")[0] + "_" * q.startswith("op") for q in QUERIES}
    assert set(ORACLES) <= set(QUERIES) and P.ORACLE_SQL is None


def test_quality(stages):
    before, after = ids(stages[0]), ids(stages[1])
    assert before - after == Counter({400: 1, 401: 1, 402: 1, 403: 1})
    row = stages[1].filter("doc_id = 500").first()
    assert "rights" not in row.text and row.n_chars == len(row.text)
    texts = {r.doc_id: r.text for r in stages[0].collect()}
    assert all(r.text == texts[r.doc_id] for r in stages[1].filter("doc_id < 300").collect())


def test_near_duplicates(stages, words):
    """One row stays of each group that similarity of 0.8 or more joins."""
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    kept = [(r.doc_id, r.text) for r in stages[2].collect()]
    sets = [shingles(t, words) for _, t in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) or (
                rows[i][0] is not None and rows[i][0] == rows[j][0]
            ):
                groups = [groups[j] if g == groups[i] else g for g in groups]
    by_group = defaultdict(list)
    for g, row in zip(groups, rows):
        by_group[g].append(row)
    expected = [min(v, key=lambda r: math.inf if r[0] is None else r[0]) for v in by_group.values()]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    assert ids(stages[1]) - ids(stages[2]) == Counter({200: 1, 201: 1, 202: 1, 4: 1, None: 1})


def test_texts_that_share_an_id_are_documents_of_their_own(spark, documents, prose):
    """Only rows whose texts are linked go, whatever their ids."""
    shared = [" ".join(prose(50, 600 + k)) for k in range(12)]
    near = [t + " more" for t in shared[:6]]
    rows = [(7, t, "s") for t in shared] + [(7, shared[0], "s")]
    rows += [(20 + k, t, "s") for k, t in enumerate(near)] + [(90, " ".join(prose(50, 700)), "s")]
    kept = [r.text for r in P.near_deduplicate(spark, documents(rows), "").collect()]
    assert len(kept) == 13
    assert sorted(t.removesuffix(" more") for t in kept) == sorted([*shared, rows[-1][1]])


def test_decontamination(stages):
    assert ids(stages[2]) - ids(stages[3]) == Counter({300: 1})


def test_mixing(stages):
    times = ids(stages[4])
    assert set(times) == set(ids(stages[3]))
    assert all(n == 1 for i, n in times.items() if i is not None and i < 100)
    assert any(n > 1 for i, n in times.items() if i is None or i >= 100)
    assert stages[4].distinct().count() == stages[3].count()


def test_sharding(stages):
    rows = stages[5].collect()
    assert ids(stages[5]) == ids(stages[4])
    assert {r.shard for r in rows} <= set(range(16))
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert all(r.size == len(r.text.encode()) + 1 for r in rows)


def test_run_does_all_stages(spark, folder, stages):
    got = QUERIES["pipeline"](spark, folder)
    assert got.columns == stages[5].columns
    key = ("doc_id", "text", "shard")
    assert Counter(tuple(r[c] for c in key) for r in got.collect()) == Counter(
        tuple(r[c] for c in key) for r in stages[5].collect()
    )


def test_empty_table(spark, stages, folder):
    docs = stages[0].limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query_equals_its_sql(spark, name):
    import duckdb

    from tools.compare import TABLES, multiset

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, result = QUERIES[name](spark, FOLDER), db.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(names, result.fetchall())
