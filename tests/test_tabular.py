"""Cleaning, merges, aggregation and statistics on invented fixtures with
hand-computed expectations (pandas/R null semantics in FIXTURES-style rows)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenum.operators import aggregate as A
from plenum.operators import clean as C
from plenum.operators import merge as M
from plenum.operators import stats as S


def rows(df, order=None):
    d = df.orderBy(*order) if order else df
    return [tuple(r) for r in d.collect()]


def test_lower_and_stringify(spark):
    df = spark.createDataFrame([("Ala", "CO", 1.0, None), (None, "X", 2.5, 3)], "State string, County string, v double, n int")
    assert C.lower_columns(df).columns == ["state", "county", "v", "n"]
    assert rows(C.lower_strings(df)) == [("ala", "co", 1.0, None), (None, "x", 2.5, 3)]
    assert rows(C.stringify_lower(df)) == [("ala", "co", "1.0", "nan"), ("nan", "x", "2.5", "3")]


def test_fill_drop_order_flatten(spark):
    df = spark.createDataFrame([(None, None, "a"), (1, 2.0, None)], "a int, b double, s string")
    assert rows(C.fill_nulls(df)) == [(0, 0.0, "a"), (1, 2.0, "0")]
    assert rows(C.drop_incomplete(df, ["a"])) == [(1, 2.0, None)]
    assert rows(C.drop_incomplete(df, ["a", "b"], how="all")) == [(1, 2.0, None)]
    assert C.order_columns(df, ["s", "zz", "a"]).columns == ["s", "a", "b"]
    nested = spark.createDataFrame([(1, ("x", ["p", "q"]))], "id int, extracted struct<action:string, ayes:array<string>>")
    flat = C.join_lists(C.flatten_struct(nested, "extracted"), ["ayes", "noes"])
    assert rows(flat) == [(1, "x", "p, q")]
    ens = C.ensure_fields(flat, ["action", "noes", "vote"], ["noes"])
    assert rows(ens.select("action", "noes", "vote")) == [("x", [], "")]


def test_filters_keep_pandas_semantics(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    assert len(rows(C.keep_eq(df, "c", "a", negate=True))) == 2  # NULL kept, like pandas !=
    assert rows(C.drop_containing(df, "c", "a")) == [(None,), ("b",)]
    assert rows(C.to_number(spark.createDataFrame([("1.5",), ("x",)], "v string"), ["v"])) == [(1.5,), (None,)]


def test_dedupe_first_and_distinct_sorted(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, "b")], "k string, pos int, v string")
    assert rows(C.dedupe_first(df, ["k"], "pos"), ["k"]) == [("j", 2, "b"), ("k", 1, "a")]
    assert rows(C.distinct_sorted(df, ["k"])) == [("j",), ("k",)]


def test_outer_merges(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (None, 99), (3, 30)], "k int, b int")
    plain = rows(M.outer_merge(a, b, "k"), ["k", "a"])
    assert len(plain) == 5  # NULL keys never match
    safe = rows(M.outer_merge(a, b, "k", null_safe=True), ["k", "a"])
    assert (None, "n", 99) in safe and len(safe) == 4
    ind = {r.k: r._merge for r in M.merge_indicator(a.dropna(), b.dropna(), "k").collect()}
    assert ind == {1: "both", 2: "left_only", 3: "right_only"}
    assert rows(M.missing_keys(a.dropna(), b, "k")) == [(2, "y")]
    assert rows(M.matching_keys(a, b, "k")) == [(1, "x")]


def test_fan_out_guard_and_unions(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        M.assert_unique(dim, ["k"])
    u = M.union_outer(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string"))
    assert rows(u, ["a"]) == [(1, None), (2, "x")]
    r = M.replace_slice(spark.createDataFrame([(2020, 1), (2016, 2)], "y int, v int"), F.col("y") == 2020,
                        spark.createDataFrame([(2020, 9)], "y int, v int"))
    assert rows(r, ["y"]) == [(2016, 2), (2020, 9)]
    t = M.expand_templates(spark.createDataFrame([(1,)], "a int"), ["x", "y"])
    assert rows(t, ["template"]) == [(1, "x"), (1, "y")]


def test_group_sum_zero_and_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5.0), ("b", 1.0)], "k string, v double")
    assert rows(A.group_sum(df, "k", "v"), ["k"]) == [("a", 0.0), ("b", 1.0)]


def test_weighted_mean_uses_all_weights(spark):
    df = spark.createDataFrame([("m", 0.5, 2.0, None), ("m", 0.5, 4.0, 1.0)], "k string, w double, x double, y double")
    r = A.weighted_mean(df, "k", "w", ["x", "y"]).first()
    assert r.x == pytest.approx(3.0) and r.y == pytest.approx(0.5)


def test_group_share_sums_to_one(spark):
    df = spark.createDataFrame([("m", 1.0), ("m", 3.0), ("n", 2.0), ("z", 0.0)], "k string, v double")
    got = {(r.k, r.v): r.w for r in A.group_share(df, "k", "v", "w").collect()}
    assert got[("m", 1.0)] == 0.25 and got[("n", 2.0)] == 1.0 and got[("z", 0.0)] is None


def test_pivot_fold_and_unique(spark):
    df = spark.createDataFrame([(2000, "c1", "democrat", 5), (2000, "c1", "green", 1), (2000, "c1", "libertarian", 2),
                                (2000, "c2", "republican", 7)], "year int, c string, party string, v bigint")
    parties = ["democrat", "republican", "green", "libertarian", "other"]
    w = A.pivot_sum(df, ["year", "c"], "party", "v", parties)
    w = A.fold_other(w, ["green", "libertarian", "other"], "other")
    assert rows(w, ["c"]) == [(2000, "c1", 5, 0, 3), (2000, "c2", 0, 7, 0)]
    u = A.pivot_unique(df, "c", "party", "v", ["democrat", "republican"])
    assert rows(u, ["c"]) == [("c1", 5, None), ("c2", None, 7)]
    dup = df.unionByName(df)
    with pytest.raises(Exception):
        A.pivot_unique(dup, "c", "party", "v", ["democrat"]).collect()


def test_mean_then_sum_and_units_missing(spark):
    df = spark.createDataFrame([("u1", "early", 10.0), ("u1", "early", 20.0), ("u1", "mail", 5.0), ("u2", "total", 9.0)],
                               "u string, mode string, t double")
    assert rows(A.mean_then_sum(df, "u", "mode", "t"), ["u"]) == [("u1", 20.0), ("u2", 9.0)]
    assert rows(A.units_missing(df, "u", F.col("mode") == "total")) == [("u1",)]


def test_transpose_and_longest(spark):
    wide = spark.createDataFrame([("Governor", "D", "R"), ("Senate", "R", "R")], "office string, y1999 string, y2001 string")
    t = A.transpose_table(wide.select("office", F.lit(1.0).alias("y1999"), F.lit(2.0).alias("y2001")), "office",
                          ["Governor", "Senate"], "year")
    assert rows(t, ["year"]) == [("y1999", 1.0, 1.0), ("y2001", 2.0, 2.0)]
    docs = spark.createDataFrame([("k", 1, "abc"), ("k", 2, "xyz"), ("k", 3, "ab")], "k string, pos int, b string")
    assert rows(A.longest_per_key(docs, "k", "b", "pos")) == [("k", 1, "abc")]


def test_collapse_units_fills_unmatched(spark):
    df = spark.createDataFrame([("c1", 2020, 10.0), ("c1", 2021, 20.0), (None, None, 4.0)], "cbsa string, year int, units double")
    got = dict(rows(A.collapse_units(df, "cbsa", "year", "units")))
    assert got == {"c1": 15.0, "0": 4.0}


def test_share_where_null_is_false(spark):
    df = spark.createDataFrame([("m", 0), ("m", None), ("m", 3)], "k string, u int")
    assert rows(A.share_where(df, "k", F.col("u") == 0)) == [("m", pytest.approx(1 / 3))]


def test_zscore_and_fit(spark):
    vals = [1.0, 2.0, 4.0, 8.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    z = [r.x_z for r in S.zscore(df, ["x"]).orderBy("i").collect() if r.x_z is not None]
    arr = np.array(vals[:4])
    assert np.allclose(z, (arr - arr.mean()) / arr.std(ddof=1))
    pts = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(10)] + [(None, 5.0)], "x double, y double")
    f = S.fit_line(pts, "x", "y").first()
    assert f.slope == pytest.approx(2.0) and f.intercept == pytest.approx(1.0) and f.n == 10
    fitted = S.add_fit(pts.dropna(), "x", "y").orderBy("x").first().fitted
    assert fitted == pytest.approx(1.0)


def test_kde_matches_numpy_and_integrates(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 200), rng.normal(2, 0.5, 50)
    data = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(data, "g string, x double")
    n = 200
    out = {(r.g, r.grid_index): (r.grid_x, r.density) for r in S.kde(df, "x", "g", n).collect()}
    lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
    grid = np.linspace(lo, hi, n)
    for name, xs in (("a", a), ("b", b)):
        h = xs.std(ddof=1) * len(xs) ** (-0.2)
        dens = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / h) ** 2).sum(1) / (len(xs) * h * math.sqrt(2 * math.pi))
        got = np.array([out[(name, i)][1] for i in range(n)])
        assert np.allclose(got, dens, rtol=1e-9, atol=1e-12)
        assert np.trapezoid(got, grid) == pytest.approx(1.0, abs=0.03)
    cells = {(r.g, r.grid_index): (r.grid_x, r.density) for r in S.kde_cells(df, "x", "g", n).collect()}
    assert cells.keys() == out.keys()
    assert max(abs(cells[k][1] - out[k][1]) for k in out) < 1e-11
    assert max(abs(cells[k][0] - out[k][0]) for k in out) < 1e-12


def test_indicator_with_null_keys(spark):
    a = spark.createDataFrame([(1, "x", 10), (None, "x", 20), (None, None, 30), (2, None, 40)], "k int, s string, a int")
    b = spark.createDataFrame([(None, "x", 1), (None, None, 2), (2, "y", 3)], "k int, s string, b int")
    got = sorted(rows(M.merge_indicator(a, b, ["k", "s"], null_safe=True)), key=str)
    assert got == sorted([(1, "x", 10, None, "left_only"), (None, "x", 20, 1, "both"), (None, None, 30, 2, "both"),
                          (2, None, 40, None, "left_only"), (2, "y", None, 3, "right_only")], key=str)
    plain = {r._merge for r in M.merge_indicator(a, b, ["k", "s"]).collect()}
    assert plain == {"left_only", "right_only"}


def test_kde_cells_far_values_and_groups_without_spread(spark):
    """A long tail (many empty cells), a tight group far away, one row, equal values, nulls."""
    rng = np.random.default_rng(5)
    data = [("tail", float(x)) for x in np.exp(rng.normal(0, 2, 400))] + [("far", 900 + float(x)) for x in rng.normal(0, 0.1, 60)]
    odd = [("one", 3.0), ("same", 2.0), ("same", 2.0), ("tail", None), (None, 1.0)]
    n = 300
    df = spark.createDataFrame(data, "g string, x double")
    want = {(r.g, r.grid_index): r.density for r in S.kde(df, "x", "g", n).collect()}
    got = {(r.g, r.grid_index): r.density for r in S.kde_cells(spark.createDataFrame(data + odd, "g string, x double"), "x", "g", n).collect()}
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert {k[0] for k in got} == {"tail", "far", "one", "same"}
    assert all(v is None for k, v in got.items() if k[0] in ("one", "same"))
    assert S.kde_cells(spark.createDataFrame([], "g string, x double"), "x", "g", n).count() == 0


def test_map_columns_row_key_and_batches(spark):
    from plenum.functions import scalar as X
    from plenum.operators import records as R

    df = spark.createDataFrame([("A b", "C")], "x string, y string")
    assert rows(C.map_columns(df, F.lower)) == [("a b", "c")]
    assert rows(C.map_columns(df, F.lower, ["y"])) == [("A b", "c")]
    assert df.select(C.row_key("x", "y").alias("k")).first().k.asDict() == {"x": "A b", "y": "C"}
    out = R.map_batches(df, lambda p: p.assign(n=p["x"].str.len()), "x string, y string, n long")
    assert rows(out) == [("A b", "C", 3)]
    t = spark.createDataFrame([("l1\nl2\nl3",)], "t string")
    assert t.select(X.head_lines("t", 2)).first()[0] == ["l1", "l2"]
    assert t.select(X.first_match("t", r"l(\d)", 1)).first()[0] == "1"


def test_rebuilt_year_keeps_total_rows_and_drops_no_year(spark):
    from plenum.plans.elections import repair_totals

    df = spark.createDataFrame(
        [("a", 2000, "F", "x", 5.0, 10.0), ("a", 2000, "O", "x", 7.0, 20.0),
         ("b", 2000, "O", "x", 1.0, 2.0), ("b", 2000, "O", "y", 2.0, 4.0), ("b", 2000, "P", "x", 3.0, 8.0),
         ("b", 2001, "O", "x", 9.0, 9.0), ("c", None, "F", "x", 1.0, 1.0)],
        "unit string, year long, mode string, party string, votes double, total double")
    got = repair_totals(df, "unit", "year", "mode", "party", "votes", "total", 2000, "F")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("a", 2000, "F", "x", 5.0, 10.0), ("b", 2000, None, "x", 4.0, 11.0), ("b", 2000, None, "y", 2.0, 11.0),
        ("b", 2001, "O", "x", 9.0, 9.0), ("c", None, "F", "x", 1.0, 1.0)], key=str)


def test_null_keys_and_sums_in_groups(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, 1, 2.0), ("b", 1, 3.0)], "k string, y long, v double")
    assert sorted(map(tuple, A.rollup_level(df, ["k", "y"], ["v"]).collect())) == [("a", 1, 0.0), ("b", 1, 3.0)]
    assert sorted(map(tuple, A.share_where(df, "k", F.col("v") > 2).collect())) == [("a", 0.0), ("b", 1.0)]


def test_office_panel_in_one_pass(spark):
    from plenum.plans.elections import office_panel

    df = spark.createDataFrame([("a", "house", "democrat", 3.0), ("a", "house", "other", 1.0), ("b", "senate", "republican", 2.0),
                                (None, "house", "democrat", 1.0), ("c", "mayor", "democrat", 1.0)],
                               "unit string, office string, party string, votes double")
    got = {r.unit: r.asDict() for r in office_panel(df, ["house", "senate"], "unit", "office", "party", "votes").collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["dem_pct_house"] == 0.75 and got["a"]["rep_pct_house"] is None and got["a"]["senate_total"] is None
    assert got["b"]["senate_rep"] == 2.0 and got["b"]["house_total"] is None
