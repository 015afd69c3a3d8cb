import itertools
import math
from urllib.parse import urljoin

from pyspark.sql import functions as F

from plenum.functions import scalar as X


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_control_ladder_truth_table(spark):
    codes = list(itertools.product("DRI", "DRS", "DRS"))
    rows = [(g, s, h, False) for g, s, h in codes] + [("D", "D", "D", True)]
    got = _one(spark, X.control("g", "s", "h", "u"), rows, "g string, s string, h string, u boolean")

    def expect(g, s, h, uni):
        if uni:
            return "-"
        if s == "S" or h == "S":
            return "Split"
        if g == s == h == "D":
            return "D"
        if g == s == h == "R":
            return "R"
        if g in "DRI" and s in "DR" and h in "DR":
            return "Split"
        return None

    assert got == [expect(*r) for r in rows]
    assert len(rows) == 28


def test_expand_year_and_first_char(spark):
    got = _one(spark, X.expand_year("y"), [(51,), (49,), (50,), (0,)], "y int")
    assert got == ["1951", "2049", None, "2000"]
    got = _one(spark, X.first_char("c"), [("D[a]",), ("R",), ("",)], "c string")
    assert got == ["D", "R", ""]


def test_monthly_payment_matches_formula(spark):
    v, r = 300000.0, 6.5
    got = _one(spark, X.monthly_payment("v", "r", rate_scale=100.0), [(v, r)], "v double, r double")[0]
    m = r / 100 / 12
    assert math.isclose(got, 0.8 * v * m / (1 - 1 / (1 + m) ** 360), rel_tol=1e-12)
    lit = _one(spark, X.monthly_payment("v", "r"), [(v, r)], "v double, r double")[0]
    m = r / 12
    assert math.isclose(lit, 0.8 * v * m / (1 - 1 / (1 + m) ** 360), rel_tol=1e-12)


def test_share_and_residual_null_safe(spark):
    df = spark.createDataFrame([(10.0, 0.0, 3.0, 4.0)], "v double, t double, a double, b double")
    r = df.select(X.share("v", "t"), X.residual("v", "a", "b"), X.residual("v", "a", "b", True)).first()
    assert r[0] is None and r[1] == 11.0 and r[2] == 3.0


URL_CASES = [
    ("http://a.example/b/c/d;p?q", "g"), ("http://a.example/b/c/d;p?q", "./g"),
    ("http://a.example/b/c/d;p?q", "g/"), ("http://a.example/b/c/d;p?q", "/g"),
    ("http://a.example/b/c/d;p?q", "//g"), ("http://a.example/b/c/d;p?q", "?y"),
    ("http://a.example/b/c/d;p?q", "g?y"), ("http://a.example/b/c/d;p?q", "#s"),
    ("http://a.example/b/c/d;p?q", "../g"), ("http://a.example/b/c/d;p?q", "../../g"),
    ("http://a.example/b/c/d;p?q", "https://x.example/z"), ("https://h.example/dir/page.html", "other.html"),
    ("https://h.example/dir/page.html", "../up.html"), ("https://h.example", "x"),
    ("http://h.example/a/b", " spaced.htm "),
]


def test_resolve_url_matches_urljoin(spark):
    got = _one(spark, X.resolve_url("b", "h"), URL_CASES, "b string, h string")
    assert got == [urljoin(b, h.strip()) for b, h in URL_CASES]


def test_url_parts(spark):
    rows = [("https://x.example/files/2019/Minutes%20Jan.pdf?x=1",), ("https://x.example/",)]
    df = spark.createDataFrame(rows, "u string")
    r = df.select(X.url_basename("u"), X.url_stem("u"), X.safe_name("u"), X.url_year("u"),
                  X.url_year("u", mode="path")).collect()
    assert tuple(r[0]) == ("Minutes%20Jan.pdf", "Minutes%20Jan", "Minutes Jan.pdf", "2019", "2019")
    assert tuple(r[1]) == ("", "", "", "unknown", "unknown")


def test_dates_and_keys(spark):
    rows = [("Thursday, October 14, 2004 Regular",), ("Thursday October 14 2004",), ("no date",)]
    got = _one(spark, X.parse_weekday_date("t").cast("string"), rows, "t string")
    assert got == ["2004-10-14", None, None]
    got = _one(spark, X.anchor_date("a"), [("1_08_98",), ("single",)], "a string")
    assert got == ["01/08/1998", ""]
    got = _one(spark, X.file_key("d", "y", "s", "i"), [("October 14, 2004", "2004", "x", 1), ("", "1998", "slug", 3)],
               "d string, y string, s string, i int")
    assert got == ["October_14_2004", "1998_slug_3"]
    got = _one(spark, X.date_slug(F.to_date(F.lit("2004-10-04"))), [(1,)], "x int")
    assert got == ["october-04-2004"]


def test_padding_and_tract_keys(spark):
    got = _one(spark, X.zfill("c", 5), [("123",), ("1234567",)], "c string")
    assert got == ["00123", "1234567"]
    got = _one(spark, X.strip_zeros("c"), [("00120",), ("0",)], "c string")
    assert got == ["120", ""]
    got = _one(spark, X.tract_key("c", "t"), [(1, 4001.02)], "c int, t double")
    assert got == [str(int(1 * 1_000_000 + 4001.02 * 100))]
    got = _one(spark, X.key_to_string("c"), [("12.0",), ("x",)], "c string")
    assert got == ["12", None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a  b\tc  ",)], "t string")
    r = df.select(X.strip("t"), X.squash("t"), X.rstrip("t")).first()
    assert tuple(r) == ("a  b\tc", "a b c", "  a  b\tc")
    got = _one(spark, X.split_names("t"), [("Ash, Oak ,Elm,",)], "t string")
    assert got == [["Ash", "Oak", "Elm"]]
    got = _one(spark, X.clean_block_no("t"), [(" 3602/12",), ("abc ",)], "t string")
    assert got == ["3602", "abc"]
    got = _one(spark, X.normalise_case("t"), [("98.226 d",), (None,)], "t string")
    assert got == ["98.226D", ""]
    got = _one(spark, X.before_token("t"), [('{"a": 1} <extra_id_0> tail',)], "t string")
    assert got == ['{"a": 1} ']
    got = _one(spark, X.harvest_urls("t"), [("see {http://a.example/x} and <https://b.example/y>",)], "t string")
    assert got == [["http://a.example/x", "https://b.example/y"]]


def test_location_line(spark):
    text = "\n".join(["Header", "City Hall Room 400", "CITY HALL, ROOM 400", "x"])
    assert _one(spark, X.location_line("t"), [(text,)], "t string") == ["CITY HALL, ROOM 400"]
    far = "\n".join(["l"] * 25 + ["CITY HALL"])
    assert _one(spark, X.location_line("t"), [(far,)], "t string") == [""]


def test_link_predicates(spark):
    rows = [("/a/b.HTM", ""), ("/agenda.html", ""), ("/x/minutes_1.pdf", ""), ("/x/sample.pdf", "Minutes"),
            ("/x/a.pdf", "Meeting Minutes")]
    df = spark.createDataFrame(rows, "h string, t string")
    r = df.select(X.is_page_link("h"), X.is_minutes_doc("h", "t")).collect()
    assert [tuple(x) for x in r] == [(True, False), (False, False), (False, True), (False, False), (False, True)]


def test_map_values(spark):
    df = spark.createDataFrame([("AL",), ("zz",), (" ak ",)], "s string")
    r = df.select(X.map_values("s", {"AL": "alabama"}),
                  X.map_values("s", {"AL": "alabama", "AK": "alaska"}, default=None, normalise=True)).collect()
    assert [tuple(x) for x in r] == [("alabama", "alabama"), ("zz", None), (" ak ", "alaska")]


def test_sub_first_crosses_lines(spark):
    df = spark.createDataFrame([("a\nb-c-d",), ("x-y",), (None,)], "s string")
    assert [r[0] for r in df.select(X.sub_first("s", "-", "+")).collect()] == ["a\nb+c-d", "x+y", None]
