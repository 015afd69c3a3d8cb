"""Zero shares by year and the control panel, with literal expected values."""
from plenum.operators import aggregate as A
from plenum.operators import merge as M


def test_zero_share_by_year(spark):
    rows = [("a", 2020, 0), ("a", 2021, 4), ("b", 0, 0), ("c", 2020, 3), ("c", 2020, None), ("d", 2022, 0), (None, 2020, 0)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "u string, y int, v int, period string")
    got = {r.period: (r.n_rows, r.share) for r in A.zero_share_by_year(df, "u", "y", "v", [2020, 2021, 2023]).collect()}
    assert got == {"2020": (4, 0.5), "2021": (2, 0.5), "2023": (1, 1.0), "mean": (4, 0.5)}
    got = {r.period: (r.n_rows, r.share) for r in A.zero_share_by_year(df.where("false"), "u", "y", "v", [2020]).collect()}
    assert got == {"2020": (0, None), "mean": (0, None)}


def test_control_panel(spark):
    sheet = [("New_South_Land", 1, {"X92": "D[a]", "X04": "R", "X50": "D", "note": "D"}), ("New_South_Land", 2, {"X92": "D", "X04": "R", "X50": "D"}),
             ("New_South_Land", 3, {"X92": "D*", "X04": None, "X50": "D"}), ("New_South_Land", 4, {"X92": "R", "X77": "R"}),
             ("Ohio", 1, {"X92": "I"}), ("Ohio", 2, {"X92": "D"}), ("Ohio", 3, {"X92": "R"}), ("Ohio", 3, {"X92": "R"}), ("Empty", 1, None)]
    df = spark.createDataFrame([(*r, "clash") for r in sheet], "state string, row int, cells map<string,string>, governor string")
    got = {(r.state, r.year): r for r in A.control_panel(df).where("year IS NOT NULL").collect()}
    assert sorted(got) == [("New South_Land", "1977"), ("New South_Land", "1992"), ("New South_Land", "2004"), ("Ohio", "1992")]
    dem = got["New South_Land", "1992"]
    assert (dem.stateyear, dem.governor, dem.senate, dem.house, dem.total_gov) == ("New South_Land1992", "D", "D", "D", "D")
    assert (got["New South_Land", "2004"].house, got["New South_Land", "2004"].total_gov) == (None, None)
    assert got["Ohio", "1992"].total_gov == "Split" and got["New South_Land", "1977"].governor is None
    assert A.control_panel(df.where("false")).count() == 0


def test_append_year(spark):
    history = spark.createDataFrame([(2020, "ohio", "adams", 5.0, 3.0, 1.0, 9.0, "old")],
                                    "year long, state string, county string, dem double, rep double, oth double, tot double, note string")
    new = spark.createDataFrame([("TX", "Bexar", 4.0, 6.0, 11.0, "County", 7), ("Utah", "Cache", None, 1.0, 2.0, None, 7)],
                                "state string, county string, blue double, red double, `total vote` double, kind string, year int")
    names = {"total vote": "tot", "blue": "dem", "red": "rep"}
    got = M.append_year(history, new, 2024, names, "oth", states={"tx": "texas"})
    assert got.columns == history.columns
    assert sorted(map(tuple, got.collect()), key=str) == [
        (2020, "ohio", "adams", 5.0, 3.0, 1.0, 9.0, "old"), (2024, "texas", "bexar", 4.0, 6.0, 13.0, 11.0, None),
        (2024, "utah", "cache", None, 1.0, None, 2.0, None)]
    right = M.append_year(history, new, 2024, names, "oth", corrected=True)
    assert right.where("state = 'tx'").first().oth == 1.0
    assert M.append_year(history.where("false"), new.where("false"), 2024, names, "oth").count() == 0
