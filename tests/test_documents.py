"""Text operators checked against plain-Python brute force on small
fixtures (invented minutes, no copied text)."""
import re

from pyspark.sql import functions as F

from plenum.functions import patterns as P
from plenum.operators import documents as D

CASE_RE = re.compile(r"(?m)^[ \t]*(?:\d{2}|\d{4})\.\d{3,}(?:[A-Z0-9/]+)?(?:\s*[–-]\s*|\s*:\s*|\s+)")
ITEM_RE = re.compile(r"^\s*\d+\.\s", re.M)


def brute_blocks(text):
    def spans(rx):
        starts = [m.start() for m in rx.finditer(text)]
        if not starts:
            return None
        starts.append(len(text))
        return [s for s in (text[a:b].strip() for a, b in zip(starts, starts[1:])) if s]

    case = spans(CASE_RE) or []
    if len(case) >= 2:
        return case
    items = spans(ITEM_RE)
    if items is not None:
        return items
    return [text.strip()]


TEXTS = [
    "Preamble line\n98.226D – 100 MAIN STREET\nAction: ok\n\n1999.668B: second\nmore\n98.290D/DD  third\n",
    "Header\n98.226D – only one case\n\n\n1. first item\n2. second item\n  3. third\n",
    "Intro\n\n  \n1. a\n\n2. b\n",
    "no boundaries at all\n  just text  ",
    "Header\n1999.668B – alone\nno items here",
    "x\n1.\tTab item\n",
]


def test_split_blocks_matches_brute_force(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = [r[0] for r in df.select(D.split_blocks("text")).collect()]
    assert got == [brute_blocks(t) for t in TEXTS]
    modes = [r[0] for r in df.select(D.block_mode("text")).collect()]
    assert modes == ["case", "item", "item", "whole", "whole", "item"]


def test_tag_untag_roundtrip(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    df = df.select(D.split_blocks("text").alias("b"))
    r = df.select(F.col("b"), D.untag_blocks(D.tag_blocks("b")).alias("u"), D.tag_blocks("b").alias("t")).collect()
    for row in r:
        assert row.u == row.b
        assert row.t.startswith(P.PROJECT_START + "\n")
        assert row.t.count(P.PROJECT_END) == len(row.b)


def test_meeting_header_fields(spark):
    text = ("Some page furniture\nThursday, October 14, 2004\nREGULAR MEETING\nSpecial Meeting\n"
            "CITY HALL, ROOM 400\nPRESENT:  Commissioners Ash, Oak  and Elm\n"
            "ABSENT: Birch\nSTAFF IN ATTENDANCE: Lee, Kim\n")
    h = spark.createDataFrame([(text,)], "text string").select(D.meeting_header("text").alias("h")).first().h
    assert h.date == "October 14, 2004"
    assert h.day_of_week == "Thursday"
    assert h.meeting_type == "REGULAR"
    assert h.location == "CITY HALL, ROOM 400"
    assert h.present == "Commissioners Ash, Oak and Elm"
    assert h.absent == "Birch"
    assert h.staff == "Lee, Kim"
    weekend = spark.createDataFrame([("Saturday, May 1, 2004",)], "text string") \
        .select(D.meeting_header("text").alias("h")).first().h
    assert weekend.day_of_week == "" and weekend.date == "May 1, 2004"


def test_case_codes(spark):
    rows = [("98.226D – x",), ("see 1999.668 BX here",), ("2000.271E: y",), ("nothing",), ("98.290D/DD z",)]
    df = spark.createDataFrame(rows, "b string")
    r = df.select(D.case_code("b"), D.case_code("b", lenient=True)).collect()
    assert [tuple(x) for x in r] == [("98.226D", "98.226D"), ("1999.668", "1999.668BX"), ("2000.271E", "2000.271E"),
                                     ("", ""), ("98.290D/DD", "98.290D/DD")]


def test_split_meetings(spark):
    html = ('<p>pre</p><a name="1_08_98"></a><p>first</p><a name="1_22_98"></a><p>second</p>')
    rows = [(html,), ("<p>no anchors</p>",)]
    r = spark.createDataFrame(rows, "h string").select(D.split_meetings("h").alias("m")).collect()
    assert [(m.anchor, m.html) for m in r[0].m] == [("1_08_98", "<p>first</p>"), ("1_22_98", "<p>second</p>")]
    assert [(m.anchor, m.html) for m in r[1].m] == [("single", "<p>no anchors</p>")]


def test_extract_dates(spark):
    t = "On October 14, 2004 and March 3, 2005; again October 14, 2004."
    r = spark.createDataFrame([(t,)], "t string").select(D.extract_dates("t")).first()[0]
    assert r == ["October 14, 2004", "March 3, 2005"]


ITEMS = """Commission header
1. 2025-000444PCA (A. LEE: 555-0100)
SOME ORDINANCE TITLE
100 MAIN STREET amendment text
SPEAKERS:
+ Pat Doe - for the project
= Sam Roe
ACTION:
Approved with Conditions
AYES: Ash, Oak, Elm
NAYS: None
MOTION: 21345
11a. 2025-001050CUA (B. KIM)
Second title
SPEAKERS: None
ACTION: Continued
RESOLUTION: 777
"""


def test_parse_items(spark):
    r = spark.createDataFrame([(ITEMS,)], "t string").select(D.parse_items("t").alias("i")).first().i
    assert len(r) == 2
    a, b = r
    assert (a.item_num, a.code, a.staff, a.title) == ("1", "2025-000444PCA", "A. LEE: 555-0100", "SOME ORDINANCE TITLE")
    assert a.address == "100 Main Street"
    assert (a.action, a.aye_votes, a.nay_votes, a.motion_or_resolution) == (
        "Approved with Conditions", "Ash, Oak, Elm", "None", "21345")
    sec = re.search(r"SPEAKERS:(.*?)(?:ACTION:|AYES:|NAYS:|RESOLUTION:|MOTION:|$)", ITEMS, re.S).group(1).strip()
    expect = [x.strip() for x in re.findall(r"[+=-]\s*.*?(?=\n|$)", sec)]
    assert a.speakers_count == len(expect) == 2
    assert a.speakers_raw == "; ".join(expect)
    assert (b.item_num, b.code, b.staff, b.motion_or_resolution) == ("11", "2025-001050CUA", "B. KIM", "777")
    assert b.speakers_count == 0 and b.nay_votes is None


def test_items_without_staff_are_left_out(spark):
    text = "1. 2025-000444PCA (A. LEE)\nTitle\n2. 2025-000445PCA\n(B. KIM)\nNo staff on the first line\n3. 2025-000446PCA ()\nEmpty\n4. 2025-000447PCA"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, t string")
    got = D.item_rows(df, ["id"], "t").orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.code, r.staff, r.title) for r in got] == [
        (1, 1, "2025-000444PCA", "A. LEE", "Title"), (1, 3, "2025-000446PCA", "", "Empty")]
    assert [x.code for x in df.select(D.parse_items("t").alias("i")).first().i] == ["2025-000444PCA", "2025-000446PCA"]


def test_speaker_names_on_the_next_line(spark):
    section = "+\nAnn Lee\n-  \n\n Bob\n= Cy\n+"
    r = spark.createDataFrame([(section,)], "t string").select(D.speakers("t").alias("s")).first().s
    assert [(x.name, x.stance) for x in r] == [("Ann Lee", "for"), ("Bob", "against"), ("Cy", "neutral"), ("", "for")]
    found = [x.strip() for x in re.findall(r"[+=-]\s*.*?(?=\n|$)", section)]
    assert [x[1:].strip() for x in found] == [x.name for x in r]


def test_speakers_stance(spark):
    r = spark.createDataFrame([("+ Ann\n- Bob\n= Cy",)], "t string").select(D.speakers("t").alias("s")).first().s
    assert [(x.name, x.stance) for x in r] == [("Ann", "for"), ("Bob", "against"), ("Cy", "neutral")]


PAGE = """<html><head><style>p{x:1}</style><script>var a="<p>no</p>";</script></head><body>
<div id="nav"><a href="/outside.html">Out</a></div>
<div id="ctl00_content_Screen"><p>Para &amp; one</p><p>
</p><p>Unclosed <b>two</b>
<a href="minutes/1998.htm"> Jan </a><a href="Agenda.html">Agenda</a><!-- a comment -->
<a name="x">anchor only</a></div>
<table class="wikitable"><tr><th>Year</th><th>Gov</th></tr><tr><td>1999</td><td> D </td></tr></table>
</body></html>"""


def test_html_links_texts_tables(spark):
    pages = spark.createDataFrame([(1, "http://h.example/idx/index.html", PAGE)], "page_id bigint, url string, html string")
    links = D.extract_links(pages).orderBy("pos").collect()
    assert [(x.href, x.text) for x in links] == [("minutes/1998.htm", "Jan"), ("Agenda.html", "Agenda")]
    t = D.page_texts(pages).first()
    assert t.paragraph_text.split("\n")[0] == "Para & one"
    assert "Unclosed two" in t.paragraph_text
    assert "no</p>" not in t.page_text and "a comment" not in t.page_text and "p{x:1}" not in t.page_text
    assert t.n_tables == 1
    rows = D.extract_tables(pages).orderBy("row_pos").collect()
    assert [r.cells for r in rows] == [["Year", "Gov"], ["1999", "D"]]
    fast = spark.createDataFrame([(PAGE,)], "h string").select(D.href_links("h")).first()[0]
    assert fast == ["/outside.html", "minutes/1998.htm", "Agenda.html"]


def test_block_rows_fast_path_equals_array_path(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    fast = sorted(tuple(r) for r in D.explode_block_rows(df, ["id"]).collect())
    slow = D.explode_blocks(D.with_blocks(df).drop("text"), "blocks")
    slow = sorted(tuple(r) for r in slow.select("id", "mode", "pos", "block").collect())
    assert fast == slow


def test_item_rows_equal_parse_items(spark):
    df = spark.createDataFrame([(1, ITEMS)], "id int, t string")
    arr = df.select(D.parse_items("t").alias("i")).first().i
    rows = D.item_rows(df, ["id"], "t").orderBy("pos").collect()
    assert [r.pos for r in rows] == [1, 2]
    assert [tuple(r)[2:] for r in rows] == [tuple(x) for x in arr]
