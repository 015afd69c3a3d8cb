"""Page structure against hand-made pages and the standard library."""
import html as stdlib

import pytest

from plenum.operators import markup as K


def one(spark, page, col):
    return spark.createDataFrame([(page,)], "h string").select(col).first()[0]


@pytest.mark.parametrize("text", ["a &amp; b", "&lt;&gt;&quot;&apos;", "&#65;&#x42;&#X43;", "&#65 &#x42;", "&nope; & &amp;amp;", "&eacute;&Eacute;&nbsp;x",
                                  "&#128;&#150;&#0;&#xD800;&#x110000;", "&#128512;", "no reference", "&", "&&amp;&", "&;&#;&#x;"])
def test_references_are_decoded_as_the_library_does(spark, text):
    assert one(spark, text, K.decode_entities("h")) == stdlib.unescape(text)


def test_named_references_need_their_semicolon(spark):
    assert one(spark, "&amp &copyright;", K.decode_entities("h")) == "&amp &copyright;"


def links(spark, page, **how):
    return [tuple(x) for x in one(spark, page, K.anchors("h", **how))]


def test_anchor_spellings(spark):
    page = """<A HREF='x.htm'>One <b>two</b></A><a data-href="no">n</a><a
    title="a > b" href = "y&amp;z" >  T&eacute;xt
    </a><a href=plain>p<a href="">empty</a><a name=q>none</a><!-- <a href="c">c</a> --><a href="last"""
    assert links(spark, page) == [("x.htm", "One two"), ("y&z", "Téxt"), ("plain", "p"), ("", "empty")]


@pytest.mark.parametrize("page, want", [
    ('<a href="o">o</a><div id="ctl00_content_Screen"><div><a href="i">i</a></div><a href="j">j</a></div><a href="p">p</a>', ["i", "j"]),
    ("<div class=x id=ctl00_content_Screen><DIV></DIV><a href=i>i</a>", ["i"]),                     # never closed
    ('<a href="o">o</a><div id="ctl00_content_Screen2"><a href="i">i</a></div>', ["o", "i"]),       # another id
    ('<span id="ctl00_content_Screen"></span><a href="o">o</a>', []),                               # an empty element
    ('<td id="ctl00_content_Screen"><a href="i">i</a><div></td><a href="o">o</a>', ["i"]),
    ('<p title="<div id=ctl00_content_Screen>"><a href="o">o</a>', ["o"]),
])
def test_container(spark, page, want):
    assert [h for h, _ in links(spark, page)] == want


def test_links_of_the_whole_page(spark):
    assert links(spark, '<a href="o">o</a><div id="ctl00_content_Screen"></div>', container_id=None) == [("o", "o")]


def test_texts(spark):
    page = "<p>One &amp; two<p class='a>b'> <b>x</b> y </p>outside<P>\n</P><p>a < b and 1<2</p><script>if (a<b) '<p>no'</script><p/>end"
    assert one(spark, page, K.paragraphs("h")) == ["One & two", "x y", "a < b and 1<2", "end"]
    assert one(spark, page, K.paragraphs("h", strip_nodes=True)) == ["One & two", "xy", "a < b and 1<2", "end"]
    assert one(spark, "<b>x</b> <i>y</i>z<!-- c -->w", K.page_text("h")) == "x\n \ny\nz\nw"
    assert one(spark, "", K.page_text("h")) == "" and one(spark, None, K.page_text("h")) == "" and one(spark, None, K.paragraphs("h")) == []
    assert one(spark, "<style>p{}", K.page_text("h")) == ""


def rows(spark, *pages, **how):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    return sorted((r.page_id, r.table_pos, r.row_pos, r.cells) for r in K.extract_tables(df, **how).collect())


def test_tables(spark):
    first = "<table class='a wikitable b'><tr><td>1<td> 2\n3 </tr><tr><th>&amp;</th></tr></table><table><tr><td>no</td></tr></table>"
    nested = ("</table><table class=wikitable><tr><td>out<table class='wikitable'><tr><td>in</td></tr></table></td><td>more</td></tr>"
              "<tr></tr><td>loose</td></table><table class=wikitable><td>before any row</td><tr><td>open")
    assert rows(spark, first, "no table", nested, None) == [
        (0, 1, 1, ["1", "2 3"]), (0, 1, 2, ["&"]),
        (2, 1, 1, ["out", "more"]), (2, 1, 2, ["loose"]), (2, 2, 1, ["in"]), (2, 3, 1, ["open"])]
    assert rows(spark, first, table_class=None) == [(0, 1, 1, ["1", "2 3"]), (0, 1, 2, ["&"]), (0, 2, 1, ["no"])]


def test_tables_are_read_page_by_page(spark, capsys):
    deep = "<table class=wikitable><tr><td>a" * 3 + "</table><td>b</table><TD title='>'>c&#x26;d &nbsp; e<i>f</i><tr><th>g</table></table><td>h"
    split = "<table class='no' title='<td class=wikitable>'><tr><td>x</table><table CLASS = wikitable><tr/><tr ><td\n>y<td1>z<table1><tr><th>t"
    df = spark.createDataFrame([(1, deep), (1, deep), (None, split), (2, "<td>no table<tr><td>q")], "page_id long, html string")
    capsys.readouterr()
    out = K.extract_tables(df)
    out.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Window" not in plan
    got = sorted(((r.page_id or 0, r.table_pos, r.row_pos, r.cells) for r in out.collect()))
    one_deep = [(1, 1, 1, ["a", "c&d ef"]), (1, 1, 2, ["g"]), (1, 2, 1, ["a", "b"]), (1, 3, 1, ["a"])]
    assert got == [(0, 1, 1, []), (0, 1, 2, ["yz"]), (0, 1, 3, ["t"]), *sorted(one_deep * 2)]


def test_long_pages_do_not_overflow(spark):
    page = "<div id=ctl00_content_Screen>" + "<div><p>text &amp; more</p><a href='x'>y</a></div>" * 20000 + "</div><table class=wikitable>" + "<tr><td>c" * 5000
    assert one(spark, page, K.anchors("h").alias("a"))[-1].href == "x"
    assert len(one(spark, page, K.paragraphs("h"))) == 20000
    assert len(rows(spark, page)) == 5000
    assert one(spark, "<p>" + "a < b " * 50000 + "x" * 10**6, K.paragraph_text("h")).endswith("xx")
