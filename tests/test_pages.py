from datetime import date, datetime
from html.parser import HTMLParser

import pytest
from helpers import at, column
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bidscope.catalog import pages as catalog_pages
from bidscope.errors import InvalidRowsError
from bidscope.functions import html
from bidscope.operators.pages import page_counters, page_tenders, page_text, parse_pages, strict_pages
from bidscope.plans.discovery import discover
from bidscope.schemas import RESULT_PAGES
from bidscope.session import scratch_path
from bidscope.sources.store import TenderStore
from bidscope.sources.tables import result_page_files
from bidscope.streaming.discovery import stream_discovery

NOW = at(2031, 5, 2)


# The names, ids and headers of the site's markup.
def row(tender, org, reference, category, published, place, closes):
    return f"""<tr class="odd"><td headers="check"><input type="hidden" name="r$1$refCons" value="{tender}">
      <input type="hidden" name="r$1$orgCons" value="{org}"/></td>
      <td headers="cons_ref"><div class="line"><span id="r1_type_procedure">Open  call
        above threshold</span></div><div id="r1_panelBlocCategorie">{category}</div>
        <div>{published}</div><div>09/09/1999</div></td>
      <td headers="cons_obj"><span class="wide ref">{reference}</span>
        <div id="r1_panelBlocObjet"><strong>Objet :</strong> Bridge &amp; <b>pier</b>
          <span class="tip">Objet : all of it</span></div>
        <div id="r1_panelBlocDenomination"><strong>Acheteur public</strong> :&nbsp;Harbour  of
          Larache </div></td>
      <td headers="cons_lieu"><div id="r1_panelBlocLieuxExec">{place}</div></td>
      <td headers="cons_dateEnd"><div class="cloture-line">{closes}</div>
        <div class="cloture-line" style="display:none">08/08/1998 00:00</div></td></tr>
      <tr><td colspan="5">more</td></tr>"""


SAMPLE = (
    """<html><body><input id="v_numPageTop" value="8"><span id="v_nombrePageTop">77</span>
    <span id="v_nombreElement">766</span><table><tr><th id="cons_ref">R</th>
    <td headers="cons_ref">not a tender</td></tr>"""
    + row("880001", "ha1", "3/L/31", "Supplies", "28/04/2031", "LARACHE", "30/06/2031<br>10:30")
    + row("880007", "ha2", "X-77", "Works", "27/04/2031", "\n TETOUAN<br>LARACHE<div class=tip>TETOUAN, LARACHE</div>", "15/07/2031 <br/> 16:00")
    + row("880003", "ha1", "4/L/31", "Works", "01/03/2031", "<span>ASILAH</span>", "16/07/2031 08:15")
    + "</table></body></html>"
)


def pages(spark, *html):
    return spark.createDataFrame([(n, f"u{n}", text) for n, text in enumerate(html)], RESULT_PAGES)


def test_sample_page(spark):
    rows = page_tenders(parse_pages(pages(spark, SAMPLE))).orderBy("row_no").collect()
    names = ("tender_id", "organization_acronym", "reference_number", "category", "publication_date", "location", "deadline")
    assert [tuple(r[n] for n in names) for r in rows] == [
        ("880001", "ha1", "3/L/31", "Supplies", date(2031, 4, 28), "LARACHE", datetime(2031, 6, 30, 9, 30)),
        ("880007", "ha2", "X-77", "Works", date(2031, 4, 27), "TETOUAN", datetime(2031, 7, 15, 15)),
        ("880003", "ha1", "4/L/31", "Works", date(2031, 3, 1), "ASILAH", datetime(2031, 7, 16, 7, 15)),
    ]
    assert {r.procurement_type for r in rows} == {"Open call above threshold"}
    # Stripped pieces are joined without a separator; only the first label is removed.
    assert {r.tender_object for r in rows} == {"Bridge &pierObjet : all of it"}
    assert {r.public_buyer for r in rows} == {"Harbour of Larache"}


def test_counters(spark):
    broken = '<input id="numPageTop" value="x"><b id="nombrePageTop"> 12 </b>'
    parsed = page_counters(parse_pages(pages(spark, SAMPLE, "<p>none</p>", broken))).orderBy("page_id")
    shown = [(r.current_page, r.total_pages, r.total_results) for r in parsed.collect()]
    assert shown == [(8, 77, 766), (None, None, None), (None, 12, None)]


def test_page_without_table_has_no_rows(spark):
    parsed = parse_pages(pages(spark, "<html><body><p>No table here</p></body></html>"))
    assert page_tenders(parsed).isEmpty() and page_counters(parsed).first().error is None


def test_empty_page_is_an_error(spark):
    parsed = parse_pages(pages(spark, "", None, SAMPLE))
    assert sorted(r.page_id for r in parsed.filter("error IS NOT NULL").collect()) == [0, 1]
    with pytest.raises(InvalidRowsError):
        strict_pages(parsed)


@pytest.mark.parametrize(
    ("published", "closes", "expected"),
    [
        ("03/12/2030", "19/12/2030", (date(2030, 12, 3), datetime(2030, 12, 19, 22, 59))),
        ("30/02/2030", "later", (None, None)),
        ("03/12/2030", "31/11/2030 10:00", (date(2030, 12, 3), None)),
    ],
)
def test_dates_of_a_row(spark, published, closes, expected):
    html = f"""<table><tr><td headers="cons_ref"><div>{published}</div></td>
      <td><div class="cloture-line">{closes}</div></td></tr></table>"""
    found = page_tenders(parse_pages(pages(spark, html))).first()
    assert (found.publication_date, found.deadline) == expected
    assert (found.tender_id, found.tender_object, found.location, found.reference_number) == (None,) * 4


def test_markup_oddities(spark):
    html = """<!-- c --><table><tr><td headers="a cons_ref b" headers="cons_ref"><p><div>01/01/2020</div></p>
      <div>02/01/2020<br></div><input name="refCons" value=""><input name="zorgCons" value="o"></td>
      <td id=panelBlocObjet>no label : </td><td id="q_panelBlocLieuxExec"><script>var a = "x"</script>
      <!-- hidden --><i>y</i></td></tr><td headers="cons_ref">outside a row</td></table>"""
    found = page_tenders(parse_pages(pages(spark, html))).collect()
    assert len(found) == 1
    assert found[0].publication_date == date(2020, 1, 2)
    assert (found[0].tender_id, found[0].organization_acronym) == (None, "o")
    assert (found[0].tender_object, found[0].location) == ("no label :", "hidden")


def test_page_text(spark):
    html = """<title>T &copy;</title><h1> a<b>b </b>c</h1><p>one<p>two</p></p><p> </p>
      <a href="/x">x</a><a>y</a><style>p{}</style>"""
    found = page_text(pages(spark, html)).first()
    assert (found.title, found.h1, found.paragraphs, found.links) == ("T ©", "abc", ["onetwo", "two"], ["/x"])


def test_discover_saves_all_pages_in_order(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    again = SAMPLE.replace("X-77", "renamed").replace("pier", "quay")
    found = discover(pages(spark, SAMPLE, again), store, NOW)
    assert found.count() == 6
    saved = store.read().orderBy("id").collect()
    assert [(r.id, r.tender_id) for r in saved] == [(1, "880001"), (2, "880007"), (3, "880003")]
    assert saved[1].tender_object.startswith("Bridge &quay") and saved[1].reference_number == "renamed"


def test_discover_from_page_files(spark, tmp_path):
    """The names of the files order the pages."""
    folder = tmp_path / "saved"
    folder.mkdir()
    for name, first in (("run1-002.html", "91"), ("run1-010.html", "92"), ("run1-001.html", "90")):
        (folder / name).write_text(SAMPLE.replace("880001", first))
    store = TenderStore(spark, str(tmp_path / "tenders"))
    discover(result_page_files(spark, str(folder)), store, NOW, page="url")
    saved = [(r.id, r.tender_id) for r in store.read().orderBy("id").collect()]
    assert saved == [(1, "90"), (2, "880007"), (3, "880003"), (4, "91"), (5, "92")]


def test_discover_refuses_bad_batches(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    nameless = SAMPLE.replace('value="ha2"', 'value=""')
    for bad in ("", nameless):
        with pytest.raises(InvalidRowsError):
            discover(pages(spark, SAMPLE, bad), store, NOW)
    assert store.version() == 0
    discover(pages(spark, "<p>no rows</p>"), store, NOW)
    assert store.version() == 0
    discover(pages(spark, nameless, ""), store, NOW, strict=False)
    assert sorted(column(store.read(), "tender_id")) == ["880001", "880003"]


def test_stream_takes_each_file_once(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"))
    folder, checkpoint = str(tmp_path / "pages"), str(tmp_path / "checkpoint")

    def run():
        stream_discovery(spark, folder, store, checkpoint, lambda: NOW).awaitTermination()

    pages(spark, SAMPLE).coalesce(1).write.parquet(folder)
    run()
    run()
    assert store.version() == 1 and store.read().count() == 3
    other = SAMPLE.replace("880001", "99").replace("pier", "quay")
    pages(spark, other).coalesce(1).write.mode("append").parquet(folder)
    run()
    rows = store.read().orderBy("id")
    assert column(rows, "id") == [1, 2, 3, 4]
    shown = rows.select(F.col("tender_object").contains("quay").alias("p"))
    assert column(shown, "p") == [False, True, True, True]


def test_two_streams_and_a_new_checkpoint_lose_nothing(spark, tmp_path):
    """Every stream counts its batches from 0."""
    store = TenderStore(spark, str(tmp_path / "tenders"))
    for name, first in (("a", "71"), ("b", "72")):
        folder = str(tmp_path / name)
        pages(spark, SAMPLE.replace("880001", first)).coalesce(1).write.parquet(folder)
        stream_discovery(spark, folder, store, str(tmp_path / f"checkpoint-{name}"), lambda: NOW).awaitTermination()
    assert sorted(column(store.read(), "tender_id")) == ["71", "72", "880003", "880007"]
    pages(spark, SAMPLE.replace("880001", "73")).coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    stream_discovery(spark, str(tmp_path / "a"), store, str(tmp_path / "fresh"), lambda: NOW).awaitTermination()
    assert sorted(column(store.read(), "tender_id")) == ["71", "72", "73", "880003", "880007"]


PIECES = [
    "<div>", "</div>", '<td headers="a b">', "</td >", "<tr>", "</tr>", '<a href="x>y">', '<a href="x', '">', "<br/>", "<br>",
    "<script>", "</script>", "<style>", "</style>", "<b/>", "<i a='1\">", "'>", "&amp;", "text ", "<title>", "</title>",
    "<!-- c -->", "<!", "</", "<", ">", '"', '<input value="1" value="2" disabled>', '<p class="é">', "</P>", '<DIV ID="q">',
    "<textarea>", "</textarea>", "<plaintext>", '<div id="a"/>', "&#65", "<?x>", "</1>", "<template>", '<a\n href="k" >',
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=4))
def test_remembered_tags_read_as_if_taken_apart(pages):
    """Broken markup too: a tag is known by its characters only where nothing after it matters."""

    class Plain(html._Reader):
        parse_starttag, parse_endtag = HTMLParser.parse_starttag, HTMLParser.parse_endtag

    readers = html._Reader(), Plain()
    for reader in readers:
        for page in [*pages, *pages]:
            reader.read(page)
    quick, plain = ((r.parents, r.lasts, r.rows, r.texts) for r in readers)
    assert quick == plain


def test_remembered_tags_are_bounded():
    reader = html._Reader()
    reader.read("".join(f'<input value="{n}">' for n in range(3 * html._REMEMBERED)))
    assert len(reader.starts) <= html._REMEMBERED and len(reader.texts) == 3 * html._REMEMBERED


MARKUP = [*PIECES, "<script>var a = '<b>';</script>", "<STYLE >p{}</style>", "<script/>", "<script>x</style>", "<!---->", "<!-->",
          "<!--->", "<!-- <b> -->", "<!DOCTYPE html>", "<rt>", "</rt>", "&nbsp;", " ", "<i b='c' d>", "</div>", "</i>"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKUP), max_size=25).map("".join), max_size=4))
def test_plain_pages_read_as_by_the_parser(pages):
    """The pattern that cuts plain pages finds what the parser finds, or leaves the page to it."""

    class Parsed(html._Reader):
        def _read_plain(self, page):
            return False

    readers = html._Reader(), Parsed()
    for reader in readers:
        for page in [*pages, *pages]:
            reader.read(page)
    quick, parsed = ((r.parents, r.lasts, r.rows, r.texts) for r in readers)
    assert quick == parsed


def test_a_plain_page_is_not_left_to_the_parser():
    reader = html._Reader()
    reader.feed = None  # would be called
    assert reader.read(SAMPLE) > 100


def test_pages_are_read_in_slices(monkeypatch):
    """What is held at once follows the slice, not the batch; no page is lost or moved."""
    pages = html.pa.array(["<p>" + "x" * n for n in range(200)] + [None, "", "<i>last"])
    monkeypatch.setattr(html, "SLICE_BYTES", 1000)
    slices = list(html._slices(pages))
    assert max(sum(len(page or "") for page in part.to_pylist()) for part in slices) < 1500 and len(slices) > 15
    assert [page for part in slices for page in part.to_pylist()] == pages.to_pylist()
    read = html._read_pages(slices[0].to_pylist()).to_pylist()
    assert [nodes[-1]["text"] for nodes in read[1:]] == ["x" * n for n in range(1, len(read))]
    assert list(html._slices(pages.slice(0, 0)))[0].to_pylist() == []


def test_more_pages_are_more_files_of_the_stream(spark, monkeypatch):
    """A quarter is not one task's work, and a batch still holds two whole quarters."""
    work = []
    monkeypatch.setattr(catalog_pages, "PAGES_PER_FILE", 12)
    monkeypatch.setattr(catalog_pages, "scratch_path", lambda *of: work.append(scratch_path(*of)) or work[-1])
    rows = catalog_pages.stream_discovery_query(spark, "/root/testdata/sf0.001")
    files = spark.read.parquet(f"{work[-1]}/pages").inputFiles()
    assert len(files) > 4
    added = rows.filter("status = 'DISCOVERED' AND created_at = updated_at").orderBy("id")
    ids = [(r.id, int(r.tender_id)) for r in added.collect() if r.created_at.year == 2000 and r.created_at.month == 6]
    assert len(ids) > 10 and [tender for _, tender in ids] == sorted(tender for _, tender in ids)
