import io
import random
import sys
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from helpers import at, column, tender_rows, updates
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError, NotFoundError
from bidscope.operators import chunking
from bidscope.operators.archives import TextConverter, attach_archives, expand_archives, missing_archives
from bidscope.operators.embedding import HashEmbedder, check_dimension, embed, unit
from bidscope.plans.indexing import run_indexing
from bidscope.plans.retrieval import retrieve
from bidscope.schemas import ARCHIVES, BLOCKS
from bidscope.sources.archives import archive_files, load_archive
from bidscope.session import SETTINGS, prepare, staged
from bidscope.sources.store import FileStore, TenderStore, _chunk_rows, _numbered, without_repeats
from bidscope.streaming.status import TRACKED_TENDERS, stream_status

# The embedder below is sent to tasks, which cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOW = at(2026, 2, 1)
CONVERTER = TextConverter(("pdf", "txt"))
TWO_PAGES = b"# Part 1: scope\nthe bridge\n\f# Part 2: fees\nthe fee"


def packed_items(items):
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as archive:
        for name, content in items:
            archive.writestr(name, content)
    return target.getvalue()


def flipped(data, marker):
    """The archive with one byte of a stored member changed."""
    at_byte = data.index(marker)
    return data[:at_byte] + bytes([data[at_byte] ^ 0xFF]) + data[at_byte + 1 :]


def expanded(spark, content, **options):
    archive = spark.createDataFrame([(1, content)], "id long, content binary")
    return expand_archives(archive, "id", **options).orderBy("position").collect()


def test_nested_archives_in_order(spark):
    deep = packed_items([("prices.pdf", b"c")])
    inner = packed_items([("rules.pdf", b"b"), ("lots/", b""), ("lots/deep.zip", deep)])
    rows = expanded(spark, packed_items([("terms.pdf", b"a"), ("extra.ZIP", inner), ("last.txt", b"d")]))
    assert [(r.position, r.path, bytes(r.content)) for r in rows] == [
        (0, "terms.pdf", b"a"),
        (1, "extra.ZIP/rules.pdf", b"b"),
        (2, "extra.ZIP/lots/deep.zip/prices.pdf", b"c"),
        (3, "last.txt", b"d"),
    ]
    assert [r.file_type for r in rows] == ["pdf", "pdf", "pdf", "txt"]


def test_unreadable_members_stop_nothing(spark):
    inner = flipped(packed_items([("bad.pdf", b"payload-in"), ("ok.pdf", b"x")]), b"payload-in")
    data = packed_items([("extra.zip", b"not a zip"), ("broken.pdf", b"payload-top"), ("n.zip", inner), ("z.pdf", b"y")])
    rows = expanded(spark, flipped(data, b"payload-top"))
    assert [(r.path, r.file_type, r.error is not None) for r in rows] == [
        ("extra.zip", "zip", True),
        ("broken.pdf", "pdf", True),
        ("n.zip/bad.pdf", "pdf", True),
        ("n.zip/ok.pdf", "pdf", False),
        ("z.pdf", "pdf", False),
    ]
    assert rows[0].error.startswith("unreadable member: BadZipFile")


@pytest.mark.parametrize("content", [b"not a zip", None])
def test_archive_that_cannot_be_opened(spark, content):
    rows = expanded(spark, content)
    assert len(rows) == 1 and rows[0].position is None and rows[0].error


def test_storage(spark, tmp_path):
    (tmp_path / "T1_ORG.zip").write_bytes(packed_items([("a.txt", b"a")]))
    (tmp_path / "other.txt").write_text("x")
    archives = archive_files(spark, str(tmp_path))
    assert archives.count() == 1
    found = load_archive(spark, str(tmp_path), "T1_ORG.zip").first()
    assert bytes(found.content).startswith(b"PK")
    assert load_archive(spark, str(tmp_path), "T2_ORG.zip").isEmpty()
    tenders = tender_rows(spark, [{}, {}]).select("id", "tender_id", "organization_acronym")
    assert column(missing_archives(tenders, archives), "archive_name") == ["T2_ORG.zip"]
    attached = {r.id: r.path for r in attach_archives(tenders, archives).collect()}
    assert attached[1].endswith("/T1_ORG.zip") and attached[2] is None


def test_only_the_asked_archives_are_opened(spark, tmp_path):
    """An archive too large to read, of a tender that is not asked for, does not matter."""
    (tmp_path / "T1_ORG.zip").write_bytes(packed_items([("a.txt", b"# H\nbody")]))
    (tmp_path / "T2_ORG.zip").write_bytes(b"x" * 5000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        assert load_archive(spark, str(tmp_path), "T1_ORG.zip").count() == 1
        tenders = tender_rows(spark, [{}, {}]).select("id", "tender_id", "organization_acronym")
        archives = archive_files(spark, str(tmp_path))
        one = attach_archives(tenders.filter("id = 1"), archives)
        assert [r.path for r in expand_archives(one, "id").collect()] == ["a.txt"]
        both = expand_archives(attach_archives(tenders, archives), "id", TextConverter()).collect()
        assert {(r.id, r.path, r.error is None) for r in both} == {(1, "a.txt", True), (2, None, False)}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_one_object_counts_for_each_name(spark, tmp_path):
    for folder, text in (("b", b"second"), ("a", b"first")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "T1_ORG.zip").write_bytes(packed_items([("x.txt", text), ("y.txt", text)]))
    tenders = tender_rows(spark, [{}]).select("id", "tender_id", "organization_acronym")
    rows = expand_archives(attach_archives(tenders, archive_files(spark, str(tmp_path))), "id").collect()
    assert sorted((r.position, bytes(r.content)) for r in rows) == [(0, b"first"), (1, b"first")]
    with_content = spark.createDataFrame([(f"{k}/T1_ORG.zip", k.encode()) for k in "ba"], ARCHIVES)
    assert [bytes(r.content) for r in attach_archives(tenders, with_content).collect()] == [b"a"]


def test_a_member_too_large_is_reported():
    from bidscope.operators import archives as ops

    rows = list(ops._files(packed_items([("big.txt", b"1234"), ("ok.txt", b"123")]), 3))
    assert [("error" in r, r["path"]) for r in rows] == [(True, "big.txt"), (False, "ok.txt")]


def cut(spark, sections, size):
    kind = "array<struct<headings:array<string>,pieces:array<struct<page:int,text:string>>>>"
    df = spark.createDataFrame([(sections,)], f"s {kind}")
    return df.select(chunking.chunk_sections(F.col("s"), size).alias("c")).first().c


def test_chunks_of_a_two_page_document(spark):
    chunks = cut(spark, CONVERTER("a.pdf", TWO_PAGES), 512)
    assert [(c.chunk_index, c.text, c.page_numbers, c.heading_path) for c in chunks] == [
        (0, "the bridge", [1], ["Part 1: scope"]),
        (1, "the fee", [2], ["Part 2: fees"]),
    ]
    assert chunks[1].embedding_text == "Part 2: fees\nthe fee"


def test_headings_nest():
    sections = CONVERTER("a.txt", b"top\n# A\n## B\nx\n### C\n## D\n# E\n####### no")
    assert [s["headings"] for s in sections] == [[], ["A"], ["A", "B"], ["A", "B", "C"], ["A", "D"], ["E"]]


def test_chunk_size_and_pages(spark):
    pieces = [{"page": 3, "text": "a b c"}, {"page": 2, "text": " \n"}, {"page": 4, "text": "d e"}]
    chunks = cut(spark, [{"headings": [], "pieces": pieces}], 2)
    assert [(c.text, c.page_numbers) for c in chunks] == [("a b", [3]), ("c d", [3, 4]), ("e", [4])]
    assert cut(spark, [{"headings": ["h"], "pieces": []}], 2) == []


def test_blocks_give_the_same_chunks_as_whole_texts(spark):
    """One document holds most blocks; how its blocks are spread must not matter."""
    rng = random.Random(3)
    rows, expected = [], {}
    for doc in range(5):
        index = 0
        for section in range(3):
            tokens, pages = [], []
            for position in range(25_000 // 100 if doc == 0 else rng.randint(0, 6)):
                words = [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 9))]
                rows.append((doc, section, [f"s{section}"], position // 3 + 1, position * 100, " ".join(words)))
                tokens += words
                pages += [position // 3 + 1] * len(words)
            for start in range(0, len(tokens), 7):
                expected[(doc, index)] = (" ".join(tokens[start : start + 7]), sorted(set(pages[start : start + 7])), [f"s{section}"])
                index += 1
    rng.shuffle(rows)
    chunks = chunking.chunk_blocks(spark.createDataFrame(rows, BLOCKS), 7).collect()
    assert {(c.doc_id, c.chunk_index): (c.text, c.page_numbers, c.heading_path) for c in chunks} == expected


def test_the_text_of_blocks_moves_twice(spark):
    """To its run, and to its chunk."""
    blocks = spark.createDataFrame([(7, 0, ["h"], 1, n, "a  b\tc") for n in range(3)], BLOCKS)
    chunks = chunking.chunk_blocks(blocks, 4)
    above = chunks._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert above.count("Exchange ") == 2
    assert [r.text for r in chunks.orderBy("chunk_index").collect()] == ["a b c a", "b c a b", "c"]


def test_blocks_without_section_or_headings_keep_their_text(spark):
    rows = [
        (1, None, None, 1, 0, "a b"),
        (1, None, None, 1, None, "z"),
        (1, 2, ["h"], 1, 0, "c"),
        (None, None, None, None, 0, "d e"),
        (2, 0, None, 1, 0, None),
    ]
    found = chunking.chunk_blocks(spark.createDataFrame(rows, BLOCKS), 10).collect()
    assert sorted(((c.doc_id, c.chunk_index, c.text, c.embedding_text, c.heading_path) for c in found), key=str) == sorted(
        [(1, 0, "z a b", "z a b", []), (1, 1, "c", "h\nc", ["h"]), (None, 0, "d e", "d e", [])], key=str
    )


def test_one_very_long_block(spark):
    """Its words are cut before rows are made of it, so they are not copied for every chunk."""
    n = 300_000
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.lit("w")), " ")
    headings = F.array().cast("array<string>")
    block = spark.range(1).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("section_no"), headings.alias("headings"),
        F.lit(1).alias("page"), F.lit(0).alias("position"), text.alias("text"),
    )
    chunks = chunking.chunk_blocks(block)
    assert chunks.agg(F.count("*"), F.sum(F.length("text"))).first()[:] == (-(-n // 512), 2 * n - -(-n // 512))
    assert chunking.chunk_texts(block.select("doc_id", "text")).agg(F.sum("n_words")).first()[0] == n


BYTE_PAIRS = Path("/opt/tokenizers/byte_bpe_50k.json")


def load_byte_pairs():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(BYTE_PAIRS))
    return lambda words: [len(t.ids) for t in tokenizer.encode_batch(words, add_special_tokens=False)]


def load_letters():
    return lambda words: [len(word) for word in words]


def expected_by_tokens(rows, budget, count):
    """Chunks by hand: one section after the other, word by word."""
    letters = budget // 16
    size = lambda word: max(count([word])[0], 1)
    sections = {}
    for doc, section, headings, page, position, text in rows:
        sections.setdefault((doc, section), []).append((position, page, headings, text))
    out, indexes = {}, {}
    for doc, section in sorted(sections):
        blocks = sorted(sections[doc, section])
        heads = max(sum(size(w) for h in b[2] for w in h.split()) for b in blocks if b[3].split())
        cell = max(budget - heads, budget // 4, 8 * letters + 1) - 4 * letters
        at, cells = 0, {}
        for _, page, headings, text in blocks:
            for word in text.split():
                most = 4 if word.isascii() else 2 if max(word) < "\u0800" else 1
                step = len(word) if len(word) <= most * letters else letters
                for piece in (word[i : i + step] for i in range(0, len(word), step)):
                    words, pages = cells.setdefault(at // cell, ([], set()))
                    words.append(piece)
                    pages.add(page)
                    at += size(piece)
        for part in sorted(cells):
            index = indexes[doc] = indexes.get(doc, -1) + 1
            out[doc, index] = (" ".join(cells[part][0]), sorted(cells[part][1]), blocks[0][2])
    return out


@pytest.mark.parametrize("load", [load_letters, load_byte_pairs])
def test_chunks_by_tokens_equal_chunks_by_hand_and_keep_to_the_budget(spark, load):
    if load is load_byte_pairs and not BYTE_PAIRS.exists():
        pytest.skip("no tokenizer files")
    rng, budget = random.Random(5), 64
    letters = ["road", "works", "é", "Straßenbau", "Straßenbauarbeiten", "x" * 90, "道路工事" * 2, "1997/2021-00", "a", "procurement", "öffentlich"]
    rows = []
    for doc in range(4):
        for section in range(3):
            # Some headings leave hardly any room, and runs of positions are many.
            headings = [f"s{section}"] if section < 2 else ["A very long heading of many words"] * 3
            for position in range(rng.randint(1, 60)):
                found = " ".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
                rows.append((doc, section, headings, position // 3 + 1, position * 1500, found))
    count = load()
    rng.shuffle(rows)
    chunks = chunking.chunk_blocks(spark.createDataFrame(rows, BLOCKS), budget, chunking.model_tokens(load)).collect()
    assert len(chunks) > 40
    assert {(c.doc_id, c.chunk_index): (c.text, c.page_numbers, c.heading_path) for c in chunks} == expected_by_tokens(
        rows, budget, count
    )
    for c in chunks:
        text = sum(count(c.text.split()))
        assert text <= budget
        if c.heading_path == ["s0"]:
            assert sum(count(c.embedding_text.split())) <= budget


def test_chunks_by_tokens_of_odd_blocks(spark):
    rows = [
        (1, None, None, 1, 0, "a b"),
        (1, None, None, 1, None, "z"),
        (1, 2, ["h"], 1, 0, "c " * 100_000),
        (None, None, None, None, 0, "d e"),
        (2, 0, None, 1, 0, None),
        (3, 0, [], 1, 0, " "),
        (4, 0, [], 1, 0, "w" * 50_000),
    ]
    blocks = spark.createDataFrame(rows, BLOCKS)
    found = {(c.doc_id, c.chunk_index): c.text for c in chunking.chunk_blocks(blocks, 64, chunking.byte_tokens).collect()}
    assert found[1, 0] == "z a b" and found[None, 0] == "d e"
    assert {doc for doc, _ in found} == {1, None, 4}
    # Words of a token each: 64 less one for the heading less 16 for what the last word may weigh beyond one.
    assert [found[1, i] for i in (1, 2)] == [" ".join("c" * 47)] * 2
    assert sum(len(t.split()) for (doc, i), t in found.items() if doc == 1 and i) == 100_000
    assert "".join(found[4, i].replace(" ", "") for i in range(len(found)) if (4, i) in found) == "w" * 50_000
    assert chunking.chunk_blocks(blocks.limit(0), 64, chunking.byte_tokens).collect() == []
    with pytest.raises(ValueError):
        chunking.chunk_blocks(blocks, 63, chunking.byte_tokens)


def test_chunk_texts_skips_empty_texts(spark):
    df = spark.createDataFrame([(1, "a  b\nc"), (2, " \n"), (3, None)], "id int, text string")
    rows = chunking.chunk_texts(df, max_tokens=2).collect()
    assert [(r.id, r.chunk_index, r.text, r.n_words) for r in rows] == [(1, 0, "a b", 2), (1, 1, "c", 1)]
    with pytest.raises(ValueError):
        chunking.chunk_texts(df, max_tokens=0)


class Broken(HashEmbedder):
    """Fails on one word, and gives vectors of the wrong size for another."""

    def embed(self, texts):
        if any("poison" in text for text in texts):
            raise RuntimeError("model crashed")
        vectors = super().embed(texts)
        return [v[:-1] if "short" in t else v for t, v in zip(texts, vectors)]


def test_embedding_keeps_order_and_unit_length(spark):
    texts = [f"word{n} word{n % 3}" for n in range(40)] + ["", "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = embed(df, "text", HashEmbedder(16), batch_size=4).orderBy("id").collect()
    model = HashEmbedder(16)
    model.load()
    for row, vector in zip(rows, model.embed(texts)):
        assert np.allclose(row.embedding, vector, atol=1e-6) and row.error is None
    lengths = [np.linalg.norm(r.embedding) for r in rows]
    assert np.allclose(lengths[:40], 1, atol=1e-6) and lengths[40:] == [0, 0]
    assert {r.embedding_model for r in rows} == {"word-hash-16"}


def test_a_text_the_model_fails_on_harms_no_other(spark):
    df = spark.createDataFrame([(n, "poison" if n == 5 else f"t{n}") for n in range(20)], "id int, text string")
    rows = embed(df.coalesce(1), "text", Broken(8)).collect()
    assert [r.id for r in rows if r.error] == [5]
    assert all(len(r.embedding) == 8 for r in rows if not r.error)


def test_dimension_is_checked():
    check_dimension(HashEmbedder(8), 8)
    with pytest.raises(InvalidRowsError):
        check_dimension(HashEmbedder(8), 1024)
    assert unit(np.array([[3.0, 4.0], [0.0, 0.0]])).tolist() == [[0.6, 0.8], [0.0, 0.0]]


FILE = (
    "tender_record_id long, position int, path string, file_type string, status string, reason string,"
    " chunks array<struct<chunk_index:int,text:string,embedding_text:string,page_numbers:array<int>,heading_path:array<string>>>"
)


def files(spark, *rows):
    """(tender, position, path, [texts])"""
    return spark.createDataFrame(
        [(t, p, path, "pdf", "chunked", None, [(i, x, x, [1], []) for i, x in enumerate(texts)]) for t, p, path, texts in rows],
        FILE,
    )


def owners(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "tender_record_id long")


def contents(store):
    paths = store.files().select(F.col("id").alias("dce_file_id"), "path")
    rows = store.chunks().join(paths, "dce_file_id").collect()
    return sorted((r.tender_record_id, r.path, r.chunk_index, r.text) for r in rows)


def test_replacing_files(spark, tmp_path):
    store, model = FileStore(spark, str(tmp_path)), HashEmbedder(8)
    assert store.files().isEmpty() and store.chunks().isEmpty()
    first = files(spark, (1, 0, "terms.pdf", ["a", "b"]), (1, 1, "rules.pdf", ["c", "d", "e"]), (2, 0, "x.pdf", ["f"]))
    store.replace(owners(spark, 1, 2), first, model)
    before = contents(store)
    assert len(before) == 6
    # The same set again: the same rows, under new ids.
    store.replace(owners(spark, 1, 2), first, model)
    assert contents(store) == before
    assert sorted(column(store.files(), "id")) == [4, 5, 6]
    assert sorted(column(store.chunks(), "id")) == list(range(7, 13))
    # A wrong vector anywhere: nothing changes for anyone.
    bad = files(spark, (1, 0, "new.pdf", ["ok", "short"]), (2, 0, "new.pdf", ["ok"]))
    with pytest.raises(InvalidRowsError):
        store.replace(owners(spark, 1, 2), bad, Broken(8))
    assert contents(store) == before and store.version() == 2
    # Not strict: only the tender at fault keeps what it had.
    outcome = store.replace(owners(spark, 1, 2), bad, Broken(8), strict=False)
    assert {r.tender_record_id: r.error for r in outcome.collect()} == {1: "vector of size 7", 2: None}
    assert contents(store) == [row for row in before if row[0] == 1] + [(2, "new.pdf", 0, "ok")]
    # A failure before any success leaves the tender without rows.
    store.replace(owners(spark, 3), files(spark, (3, 0, "p.pdf", ["poison"])), Broken(8), strict=False)
    assert store.files().filter("tender_record_id = 3").isEmpty()
    # An empty new set removes what was stored.
    store.replace(owners(spark, 1), files(spark).limit(0), model)
    assert contents(store) == [(2, "new.pdf", 0, "ok")]
    assert column(store.files(), "path") == ["new.pdf"]


def test_an_embedding_text_that_repeats_is_left_out(spark):
    kinds = "array<struct<chunk_index:int,text:string,embedding_text:string,page_numbers:array<int>,heading_path:array<string>>>"
    chunks = [(0, "a b", "H\na b", [1], ["H"]), (1, "c", "other", [1], ["H"]), (2, "d", "d", [1], [])]
    files = spark.createDataFrame([(1, 0, chunks)], f"tender_record_id long, position int, chunks {kinds}")
    kept = without_repeats(files).first().chunks
    assert [c.embedding_text for c in kept] == [None, "other", None] and [c.text for c in kept] == ["a b", "c", "d"]


def test_chunks_meet_their_numbers_in_one_shuffle(spark):
    kinds = "array<struct<chunk_index:int,text:string,embedding_text:string,page_numbers:array<int>,heading_path:array<string>>>"
    files = [(t, p, [(k, f"w{k}", None, [1], [f"t{t}"]) for k in range(p + t)]) for t in (1, 2) for p in (0, 1)]
    files = spark.createDataFrame(files, f"tender_record_id long, position int, chunks {kinds}")
    rows = _chunk_rows(files, _numbered(files, 10, 100), HashEmbedder(8))
    above = rows._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert above.count("Exchange ") == 1
    found = [(r.id, r.dce_file_id, r.chunk_index) for r in rows.orderBy("id").collect()]
    places = [(11, 0), (12, 0), (12, 1), (13, 0), (13, 1), (14, 0), (14, 1), (14, 2)]
    assert found == [(101 + n, *place) for n, place in enumerate(places)]


def test_replacing_refuses_files_out_of_place(spark, tmp_path):
    store, model = FileStore(spark, str(tmp_path), dimension=8), HashEmbedder(8)
    for wrong in (
        files(spark, (1, 0, "a", ["x"]), (1, 0, "b", ["y"])),
        files(spark, (2, 0, "a", ["x"])),
        files(spark, (None, 0, "a", ["x"])),
        files(spark, (1, None, "a", ["x"])),
    ):
        with pytest.raises(InvalidRowsError):
            store.replace(owners(spark, 1), wrong, model)
    good = files(spark, (1, 0, "a", ["x"]))
    with pytest.raises(InvalidRowsError, match="dimension"):
        store.replace(owners(spark, 1), good, HashEmbedder(16))
    with pytest.raises(NotFoundError):
        store.replace(owners(spark, 1), good, model, tenders=tender_rows(spark, []))
    assert store.version() == 0
    store.replace(owners(spark, 1), good, model, tenders=tender_rows(spark, [{}]))
    assert contents(store) == [(1, "a", 0, "x")]


ARCHIVE = {
    "A": packed_items([("terms.pdf", TWO_PAGES), ("draw/sketch.dwg", b"\0"), ("stamp.png", b"\0")]),
    "B": packed_items([("clauses.pdf", b"\xff\xfe broken"), ("extra.zip", b"not a zip"), ("rules.pdf", b"good")]),
    "C": b"not a zip",
    "E": packed_items([("x.pdf", b"poison"), ("y.pdf", b"fine")]),
    "F": packed_items([]),
    "G": packed_items([("g.pdf", b"not selected")]),
}


@pytest.fixture
def stores(spark, tmp_path):
    rows = [
        {"tender_id": "A", "status": "UPLOADED"},
        {"tender_id": "B", "status": "FAILED", "last_status": "CHUNKED"},
        {"tender_id": "C", "status": "UPLOADED"},
        {"tender_id": "D", "status": "UPLOADED"},
        {"tender_id": "E", "status": "UPLOADED"},
        {"tender_id": "F", "status": "UPLOADED"},
        {"tender_id": "G", "status": "CHUNKING"},
    ]
    tenders = TenderStore(spark, str(tmp_path / "tenders"))
    tenders.write(tender_rows(spark, rows))
    archives = spark.createDataFrame([(f"file:/store/{k}_ORG.zip", v) for k, v in ARCHIVE.items()], ARCHIVES)
    return tenders, FileStore(spark, str(tmp_path / "files")), archives


def statuses(tenders):
    return {r.tender_id: (r.status, r.last_status) for r in tenders.read().collect()}


INDEXED = {
    "A": ("INDEXED", None),
    "B": ("INDEXED", None),
    "C": ("FAILED", "UPLOADED"),
    "D": ("FAILED", "UPLOADED"),
    "E": ("FAILED", "CHUNKED"),
    "F": ("INDEXED", None),
    "G": ("CHUNKING", None),
}


def test_indexing_run(spark, stores):
    tenders, store, archives = stores
    report = run_indexing(tenders, store, archives, CONVERTER, Broken(8), NOW)
    assert report.count() == 6
    assert statuses(tenders) == INDEXED
    rows = store.files().orderBy("id").collect()
    assert [(r.tender_record_id, r.path, r.status, r.reason is None) for r in rows] == [
        (1, "terms.pdf", "chunked", True),
        (1, "draw/sketch.dwg", "skipped", False),
        (1, "stamp.png", "skipped", False),
        (2, "clauses.pdf", "failed", False),
        (2, "extra.zip", "failed", False),
        (2, "rules.pdf", "chunked", True),
    ]
    assert contents(store) == [(1, "terms.pdf", 0, "the bridge"), (1, "terms.pdf", 1, "the fee"), (2, "rules.pdf", 0, "good")]


def test_indexing_again_retries_what_failed(spark, stores):
    tenders, store, archives = stores
    run_indexing(tenders, store, archives, CONVERTER, Broken(8), NOW)
    before = contents(store)
    report = run_indexing(tenders, store, archives, CONVERTER, HashEmbedder(8), NOW)
    assert sorted(column(report, "tender_id")) == ["C", "D", "E"]
    assert statuses(tenders) == {**INDEXED, "E": ("INDEXED", None)}
    assert contents(store) == before + [(5, "x.pdf", 0, "poison"), (5, "y.pdf", 0, "fine")]


def test_indexing_limit_takes_the_oldest(spark, stores):
    tenders, store, archives = stores
    report = run_indexing(tenders, store, archives, CONVERTER, HashEmbedder(8), NOW, limit=2)
    assert sorted(column(report, "tender_id")) == ["A", "B"]


def test_retrieving_what_was_indexed(spark, stores):
    tenders, store, archives = stores
    model = HashEmbedder(64)
    run_indexing(tenders, store, archives, CONVERTER, model, NOW)
    found = (store.chunks(), store.files(), tenders.read())
    hits = retrieve(*found, "Part 2: fees : the fee", model, top_k=2).collect()
    assert (hits[0].tender_id, hits[0].dce_file_path, hits[0].page_numbers) == ("A", "terms.pdf", [2])
    scoped = retrieve(*found, "the fee", model, tender_id="B", organization="ORG").collect()
    assert [h.text for h in scoped] == ["good"]
    assert retrieve(*found, "the fee", model, tender_id="F", organization="ORG").isEmpty()
    with pytest.raises(InvalidRowsError):
        retrieve(*found, "the fee", model, dimension=1024)
    for bad in ({"query": " "}, {"query": "x", "top_k": 0}, {"query": "x", "tender_id": "A"}):
        with pytest.raises(ValueError):
            retrieve(*found, embedder=model, **bad)


def test_status_stream_in_any_order(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"), TRACKED_TENDERS)
    rows = tender_rows(spark, [{"status": "DISCOVERED"}, {"status": "DISCOVERED"}])
    store.write(rows.withColumn("status_seq", F.lit(None).cast("bigint")))
    folder, checkpoint = str(tmp_path / "updates"), str(tmp_path / "checkpoint")

    def send(*events):
        updates(spark, *events).coalesce(1).write.mode("append").parquet(folder)
        stream_status(spark, folder, store, checkpoint, lambda: NOW).awaitTermination()
        return [(r.status, r.last_status) for r in store.read().orderBy("id").collect()]

    assert send((5, "T1", "ORG", "UPLOADED", None), (2, "T9", "ORG", "UPLOADED", None)) == [("UPLOADED", None), ("DISCOVERED", None)]
    # Late and unsound updates change nothing; the other tender moves.
    late = [(4, "T1", "ORG", "DOWNLOADING", None), (6, "T1", "ORG", "FAILED", None), (3, "T2", "ORG", "DOWNLOADING", None)]
    assert send(*late) == [("UPLOADED", None), ("DOWNLOADING", None)]
    assert send((7, "T1", "ORG", "FAILED", "UPLOADED")) == [("FAILED", "UPLOADED"), ("DOWNLOADING", None)]
    version = store.version()
    stream_status(spark, folder, store, checkpoint, lambda: NOW).awaitTermination()
    assert store.version() == version


def test_members_of_one_archive_are_dealt_to_many_tasks(spark, tmp_path):
    """Nested archives, broken ones and empty files among them; as bytes and by path the same."""
    inner = packed_items([("deep/x.txt", b"x" * 90), ("more.zip", packed_items([("y.txt", b"yy"), ("z.txt", b"")])), ("bad.zip", b"no")])
    items = [(f"n{k:04}.txt", b"t%d" % k) for k in range(900)]
    items[100:100] = [("one.zip", inner), ("broken.zip", b"not a zip"), ("folder/", b""), ("big.txt", b"b" * 400)]
    items.append(("last.ZIP", inner))
    (tmp_path / "a.zip").write_bytes(packed_items(items))
    (tmp_path / "empty.zip").write_bytes(packed_items([]))
    (tmp_path / "none.zip").write_bytes(b"no archive")
    stored = archive_files(spark, str(tmp_path)).withColumn("id", F.ascii(F.element_at(F.split("path", "/"), -1)).cast("long"))
    loaded = spark.read.format("binaryFile").load(str(tmp_path)).withColumn("id", F.ascii(F.element_at(F.split("path", "/"), -1)).cast("long"))
    want = expand_archives(loaded.select("id", "content"), "id", member_bytes=300).orderBy("id", "position").collect()
    columns = ["id", "position", "path", "file_type", "content"]
    for bounds in ({}, {"piece_bytes": 50}, {"piece_bytes": 700}):
        got = expand_archives(stored, "id", member_bytes=300, **bounds).withColumn("task", F.spark_partition_id())
        rows = got.orderBy("id", "position").collect()
        assert [[r[c] for c in columns] for r in rows] == [[r[c] for c in columns] for r in want]
        assert [r.error is None for r in rows] == [r.error is None for r in want]
        assert len({r.task for r in rows if r.id == ord("a")}) > 1
    assert [r.position for r in want if r.id == ord("a")] == list(range(900 + 2 * 4 + 2))
    assert [r.path for r in want if r.error and r.id == ord("a")] == ["one.zip/bad.zip", "broken.zip", "big.txt", "last.ZIP/bad.zip"]
    # The nested archives are larger than a file may be: taken apart as streams.
    small = expand_archives(stored, "id", member_bytes=95).filter("error IS NULL").select("path").collect()
    assert {"one.zip/deep/x.txt", "last.ZIP/more.zip/y.txt"} <= {r.path for r in small} and len(inner) > 95


def test_a_batch_for_python_is_bounded_by_bytes(spark):
    """Twenty texts of 1 MB: a worker never holds more than a few."""

    @F.arrow_udf("long")
    def size(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts))

    rows = spark.range(0, 20, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1 << 17).alias("text"))
    assert rows.select(size("text").alias("n")).agg(F.max("n")).first()[0] < 8 << 20
    assert int(SETTINGS["spark.sql.execution.arrow.maxBytesPerBatch"]) <= 4 << 20


def test_tasks_list_the_archives(spark, tmp_path):
    """The driver holds no archive's name; what is found is what Spark's own listing finds."""
    names = ["T1_ORG.zip", "a/T2_ORG.zip", "a/b c/T3_ORG.zip", "a/b c/é.zip", "x.zip/T4.zip", "month=1/T5.zip", "_k=1/T6.zip"]
    for name in [*names, "T7.ZIP", ".h.zip", "_h.zip", "_h/T8.zip", ".h/T9.zip", "T10.zip._COPYING_", "a/other.txt"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "empty").mkdir()
    found = archive_files(spark, f"{tmp_path}/")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    want = reader.load(str(tmp_path)).select("path", "modificationTime", "length")
    assert found.schema == want.schema and sorted(found.collect()) == sorted(want.collect()) and want.count() == len(names)
    assert not [path for path in found.inputFiles() if path.endswith(".zip")]
    one, some, none = (archive_files(spark, f"{tmp_path}/{path}") for path in ("T1_ORG.zip", "a/b*", "empty"))
    assert [one.count(), some.count(), none.count()] == [1, 2, 0]
    with pytest.raises(AnalysisException):
        archive_files(spark, f"{tmp_path}/missing")


def test_ids_are_not_broadcast_by_the_size_of_their_file(spark):
    """Ids of a stored table that also has texts weigh little by estimate, however many they are."""
    texts = [F.lit(None).cast("string").alias(f"text{k}") for k in range(6)]
    stored = staged(spark.range(400_000).select(F.xxhash64("id").alias("id"), *texts), "wide")
    left = spark.range(1 << 40).select(F.xxhash64("id").alias("id")).join(stored.select("id"), "id", "left_anti")
    plan = left._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("allowed, estimated, measured", [("10m", "262144", "10485760"), ("1000", "1000", None), ("-1", "-1", None)])
def test_what_a_session_lets_be_broadcast_holds_for_measured_sizes(spark, allowed, estimated, measured):
    session = spark.newSession()
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    session.conf.set(names[0], allowed)
    session.conf.unset(names[1])
    for _ in range(2):
        prepare(session)
        assert [session.conf.get(name, None) for name in names] == [estimated, measured]
