"""Hard cases of the minutes text with literal expected values, and the plan of
the derived minutes."""
import datetime as dt

from pyspark.sql import functions as F

from plenum.functions import scalar as X
from plenum.operators import documents as D
from plenum.plans import elections, minutes

from .conftest import SF_SMALL


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("r")).first().r


def test_no_break_spaces(spark):
    text = "intro\n98.1111A – one\n98.2222B – two\nOctober 14, 2004"
    assert one(spark, text, D.split_blocks("t")) == ["98.1111A – one", "98.2222B – two\nOctober 14, 2004"]
    assert one(spark, text, D.extract_dates("t")) == ["October 14, 2004"]


def test_control_characters_are_no_boundary(spark):
    assert one(spark, "98.1111A – one \x01 mid\n98.2222B – two", D.split_blocks("t")) == ["98.1111A – one  mid", "98.2222B – two"]


def test_weekday_date_needs_its_comma(spark):
    day = dt.date(2004, 10, 14)
    for text, want in (("Thursday, October 14, 2004", day), ("Thursday October 14, 2004", None),
                       ("Thursday, October  14, 2004", day), ("Thursday, October 14, 2004", day), ("none", None)):
        assert one(spark, text, X.parse_weekday_date("t")) == want


def test_named_anchors_in_any_form(spark):
    html = ("pre<a name=\"1_08_98\"></a>A<A NAME='1_15_98'>B</A><a class=\"z\" name=\"1_22_98\">C"
            '<a href="x.htm" name="1_29_98">D</a><a name="top">E</a>')
    assert [m.anchor for m in one(spark, html, D.split_meetings("t"))] == ["1_08_98", "1_15_98", "1_22_98"]
    assert [m.anchor for m in one(spark, "<p>no anchor</p>", D.split_meetings("t"))] == ["single"]


def test_unlisted_party_counts_as_other(spark):
    rows = spark.createDataFrame([(1, "1-URGENT", 2.0), (1, "5-LOW", 3.0), (1, "6-NEW", 7.0), (1, None, 1.0)],
                                 "unit int, party string, votes double")
    r = elections.unit_panel(rows, ["unit"], "party", "votes", elections.PRIORITIES, elections.PARTY_NAMES,
                             ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "other_qty", "most").first()
    assert (r.urgent_qty, r.high_qty, r.other_qty, r.most) == (2.0, 0.0, 11.0, 7.0)


def test_minutes_need_no_shuffle(spark):
    m = minutes.minutes(spark, SF_SMALL)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "collect_list" not in plan
    assert m.agg(F.count_distinct(F.size(D.split_blocks("text")))).first()[0] > 2
