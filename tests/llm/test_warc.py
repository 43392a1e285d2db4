import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bidscope.llm import warc as W

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def rows():
    same = "<p>same é</p>"
    out = [(k, f"http://h/{k}?q=ü b%20", same) for k in range(0, 40, 4)]
    out += [(k, f"http://h/{k}", f"<p>own {k}</p>" + "x" * (k * 50)) for k in range(1, 40, 4)]
    return out + [
        (100, "bad\r\nWARC-Type: x", ""),
        (101, None, None),
        (102, "", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
        (None, "no id", same),
        (200, "twice", "one"),
        (200, "twice", "one"),
        (7, "twice", "one"),
        (300, "😀", "🙂" * 300_000),
    ]


def expected(rows):
    data = [(i, u, (h or "").encode()) for i, u, h in rows]
    largest = {}
    for i, _, payload in data:
        if i is not None:
            largest[payload] = max(largest.get(payload, i), i)
    out = []
    for i, u, payload in data:
        keeper = largest.get(payload)
        refers = keeper if i is not None and i < keeper else None
        kind = "response" if refers is None else "revisit"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, u, kind, refers, len(payload), digest, payload if kind == "response" else None))
    return sorted(out, key=str)


def test_round_trip(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES).withColumns({"keeper": F.lit("x"), "sha1": F.lit(1)}).repartition(3)
    index = W.write_archives(pages, str(tmp_path))
    read = W.read_records(index, str(tmp_path)).collect()
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in read]
    assert sorted(got, key=str) == expected(rows)
    # Any tool can read the archives: members of gzip, records one after the other.
    for path in Path(tmp_path).glob("*.warc.gz"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert index.agg(F.sum("length")).first()[0] == sum(p.stat().st_size for p in Path(tmp_path).glob("*.warc.gz"))


def test_selected_records_are_read_by_range(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 2000)
    index = W.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path))
    assert index.select("archive").distinct().count() > 3
    chosen = index.filter("page_id % 5 = 1 or record_type = 'revisit'")
    read = W.read_records(chosen, str(tmp_path))
    assert sorted(r.page_id for r in read.collect()) == sorted(r.page_id for r in chosen.collect())


def test_ranges_are_coalesced():
    ranges = [(0, 10), (10, 5), (40, 10), (45, 2), (1000, 10), (1010, 500), (1510, 10)]
    assert W.coalesce_ranges(ranges, gap=30, most=520) == [[0, 1, 2, 3], [4, 5, 6]]
    assert W.coalesce_ranges(ranges, gap=24, most=515) == [[0, 1], [2, 3], [4, 5], [6]]
    assert W.coalesce_ranges([]) == []
    assert W.coalesce_ranges([(5, 10_000)], most=10) == [[0]]


def test_empty_table(spark, tmp_path):
    index = W.write_archives(spark.createDataFrame([], PAGES), str(tmp_path))
    assert index.collect() == [] == W.read_records(index, str(tmp_path)).collect()
