"""Pages to meetings, their files and metadata, with literal expected values."""
from plenum.operators import documents as D
from plenum.sources import readers as S
from plenum.sources import sinks as K

SCHEMA = "page int, year string, slug string, url string, html string, date string, anchor string, note string"
TWO = ('<html><p>Preamble</p><a name="1_08_98"></a><p>Regular Meeting</p><p>ROOM 4 &amp; HALL</p><p>98.1111A – one</p>'
       "<p>98.2222B – two</p><A NAME='1_15_98'>Thursday, January 15, 1998<br>Joint Meeting<br>PRESENT: Alder, Birch</html>")


def pages(spark):
    rows = [(1, "1998", "jan", "u1", TWO), (2, "1998", "feb", "u2", "<p>no date at all</p>"), (3, "1999", "none", "u3", None),
            (4, "1998", "again", "u4", "<p>January 15, 1998</p>")]
    return spark.createDataFrame([(*r, "clash", "clash", "x") for r in rows], SCHEMA)


def test_meetings_of_pages(spark):
    got = {(r.page, r.meeting_pos): r for r in D.meetings_of_pages(pages(spark), ["page"]).collect()}
    assert len(got) == 5
    first, second = got[1, 1], got[1, 2]
    assert (first.anchor, first.date, first.file_key) == ("1_08_98", "01/08/1998", "01-08-1998")  # the anchor's date
    assert (first.meeting_type, first.location, first.source_url) == ("Regular", "ROOM 4 & HALL", "u1")
    assert first.tagged == ("<<Project Start>>\n98.1111A – one\n<<Project End>>\n"
                            "<<Project Start>>\n98.2222B – two\n<<Project End>>")
    assert (second.anchor, second.date, second.day_of_week, second.present) == ("1_15_98", "January 15, 1998", "Thursday", "Alder, Birch")
    assert second.file_key == "January_15_1998"
    assert (got[2, 1].anchor, got[2, 1].date, got[2, 1].file_key) == ("single", "", "1998_feb_1")
    assert (got[3, 1].date, got[3, 1].file_key, got[3, 1].tagged) == ("", "1999_none_1", "<<Project Start>>\n\n<<Project End>>")
    assert D.meetings_of_pages(pages(spark).where("false"), ["page"]).count() == 0


def test_meeting_files_and_metadata(spark, tmp_path):
    path = str(tmp_path / "out")
    K.write_meetings(D.meetings_of_pages(pages(spark), ["page"]), path, ["page"])
    K.write_meetings(D.meetings_of_pages(pages(spark).where("page = 3"), ["page"]), path, ["page"])
    files = {(str(r.year), r.file_key): r.text for r in S.read_text_files(spark, f"{path}/tagged").collect()}
    assert sorted(files) == [("1998", "01-08-1998"), ("1998", "1998_feb_1"), ("1998", "January_15_1998"), ("1999", "1999_none_1")]
    assert "January 15, 1998" in files["1998", "January_15_1998"] and "Joint" not in files["1998", "January_15_1998"]  # the last page's
    meta = spark.read.option("header", "true").csv(f"{path}/metadata")
    assert meta.columns == ["date", "day_of_week", "meeting_type", "location", "present", "absent", "staff", "source_url"]
    assert [r.source_url for r in meta.collect()] == ["u3"]
