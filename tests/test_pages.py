import html

import pytest

from spinmart.plans.admin_units import admin_units, export_admin_units
from spinmart.sources.pages import html_rows, html_rows_nested
from spinmart.sources.schemas import PAGES

FLAT = """<html><!-- <tr><td>comment</td></tr> --><table id="t"><tr><th>head only</th></tr>
<TR class="r"><td> 00001 </td><td>Ward &amp; Co</td><td></td><td>x</td><td>001</td><td>District
  One</td><td>01</td><td><b>Province</b> <i>A</i></td></TR>
<tr><td>a</td><td>b</td><td>c</td><td>d</td></tr></table></html>"""


def pages(spark, *texts):
    return spark.createDataFrame([(n, f"http://x/{n}", text) for n, text in enumerate(texts)], PAGES)


@pytest.mark.parametrize("read", [html_rows, html_rows_nested])
def test_rows_with_cells_in_page_order(spark, read):
    got = read(pages(spark, FLAT, "<p>no table</p>", "", None, FLAT)).orderBy("page_id", "pos").collect()
    full = ["00001", "Ward & Co", "", "x", "001", "District One", "01", "Province A"]
    assert [(r.page_id, r.cells) for r in got] == [
        (0, full), (0, ["a", "b", "c", "d"]), (4, full), (4, ["a", "b", "c", "d"])]


def test_nested_rows(spark):
    nested = "<table><tr><td>out<table><tr><td>in1</td><td>in2</td></tr></table></td><td>last &eacute;</td></tr></table>"
    got = html_rows_nested(pages(spark, nested)).orderBy("pos").collect()
    assert [r.cells for r in got] == [["outin1in2", "in1", "in2", "last é"], ["in1", "in2"]]


def test_end_tags_may_be_left_out(spark):
    loose = "<table><tr><td>a<td>b<table><tr><td>in</table> after<tr><td>c</table>"
    got = html_rows_nested(pages(spark, loose)).orderBy("pos").collect()
    assert [r.cells for r in got] == [["a", "bin after", "in"], ["in"], ["c"]]


@pytest.mark.parametrize("read", [html_rows, html_rows_nested])
def test_line_breaks_and_spaces(spark, read):
    page = "<tr><td> a  <b>b</b> <BR/> c\u00a0\n d<br></td><td>&nbsp;</td></tr>"
    assert [r.cells for r in read(pages(spark, page)).collect()] == [["a b\nc d", ""]]


@pytest.mark.parametrize("read", [html_rows, html_rows_nested])
def test_script_text_is_no_cell_text(spark, read):
    got = read(pages(spark, "<table><tr><td>a<script>var x = '<td>';</script><STYLE>td{}</STYLE></td></tr></table>"))
    assert [r.cells for r in got.collect()] == [["a"]]


def test_end_tags_left_out_by_expressions(spark):
    loose = "<table><tr><td>a<td class=x>b<tr><td>c</tr><tr><td>d</table> after"
    got = html_rows(pages(spark, loose)).orderBy("pos").collect()
    assert [r.cells for r in got] == [["a", "b"], ["c"], ["d"]]


REFERENCES = ["H&#224; N&#7897;i", "&#xE9;&#XE9;&eacute;&eacute", "&#128512;&#x1F600;", "a &amp;lt; b", "&lt;td&gt;", "R&D &unknown; & &",
              "&#0;&#xD800;&#1114112;", "&#147;x&#148;&#129;", "&NotEqualTilde;&fjlig;", "&amp&copy", "&#65;&#066;&#x043;", "&#;&#x;"]


@pytest.mark.parametrize("text", REFERENCES)
def test_character_references(spark, text):
    """As the standard library reads them, white space aside."""
    (row,) = html_rows(pages(spark, f"<tr><td>{text}</td></tr>")).collect()
    assert row.cells == [html.unescape(text)]


def test_admin_units_reorder_cells_and_pad_short_rows(spark):
    got = admin_units(pages(spark, FLAT)).orderBy("pos").collect()
    assert tuple(got[0])[2:] == ("01", "Province A", "001", "District One", "00001", "Ward & Co")
    assert tuple(got[1])[2:] == (None, None, None, None, "a", "b")


def test_export_keeps_the_order_of_the_crawl(spark, tmp_path):
    path = str(tmp_path / "units")
    many = pages(spark, *(FLAT.replace("00001", f"{n:05d}") for n in range(30))).repartition(7)
    export_admin_units(many, path)
    export_admin_units(many, path)
    lines = [line for part in sorted((tmp_path / "units").glob("part-*")) for line in part.read_text().splitlines()]
    header = "province_code,province,district_code,district,ward_code,ward"
    wards = [line.split(",")[4] for line in lines if line != header]
    assert header in lines and wards == [w for n in range(30) for w in (f"{n:05d}", "a")]
