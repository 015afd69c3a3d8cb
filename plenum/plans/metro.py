"""Family B — metro panels (weights, weighted indices, merge indicator,
z-scores, KDE, OLS, shares, collapses, keys, affordability, wide changes,
star master) on the driver tables.

Role mapping (README): place = part / supplier / customer rows, metro =
brand / nation, population = quantity, index values = discount/tax/price,
mortgage rate = yearly mean discount in percent points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import merge as M
from ..operators import stats as S
from ..sources.readers import table
from .registry import query


def _r(df: DataFrame, cols, d: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c in cols})


@query("group_weight", sql="""
WITH q AS (SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey),
p AS (SELECT p.p_partkey, p.p_brand, q.qty FROM part p LEFT JOIN q ON p.p_partkey = q.l_partkey),
t AS (SELECT p_brand, sum(qty) AS brand_qty FROM p GROUP BY p_brand)
SELECT p.p_partkey, p.p_brand, round(p.qty, 2) AS qty, round(p.qty / nullif(t.brand_qty, 0), 6) AS weight
FROM p LEFT JOIN t ON p.p_brand = t.p_brand
""")
def group_weight(spark: SparkSession, sf: str) -> DataFrame:
    """J2 + A7: each part's share of its brand's quantity (population weight
    of a place within its metro)."""
    qty = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("qty"))
    places = M.enrich(table(spark, sf, "part").select("p_partkey", "p_brand"), qty, "p_partkey")
    w = A.group_share(places, "p_brand", "qty", "weight")
    return w.select("p_partkey", "p_brand", F.round("qty", 2).alias("qty"), F.round("weight", 6).alias("weight"))


INDEX_COLS = ["l_discount", "l_tax", "l_extendedprice"]


@query("weighted_index", sql="""
WITH d AS (SELECT l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem
           WHERE l_suppkey IS NOT NULL AND l_quantity IS NOT NULL
             AND NOT (l_discount IS NULL AND l_tax IS NULL AND l_extendedprice IS NULL))
SELECT l_suppkey,
  round(coalesce(sum(l_discount * l_quantity), 0) / nullif(sum(l_quantity), 0), 6) AS l_discount,
  round(coalesce(sum(l_tax * l_quantity), 0) / nullif(sum(l_quantity), 0), 6) AS l_tax,
  round(coalesce(sum(l_extendedprice * l_quantity), 0) / nullif(sum(l_quantity), 0), 4) AS l_extendedprice
FROM d GROUP BY l_suppkey
""")
def weighted_index(spark: SparkSession, sf: str) -> DataFrame:
    """P18 + P19 + A8: quantity-weighted mean of three measures per supplier."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", *INDEX_COLS)
    d = C.drop_incomplete(li, ["l_suppkey", "l_quantity"])
    d = C.drop_incomplete(d, INDEX_COLS, how="all")
    out = A.weighted_mean(d, "l_suppkey", "l_quantity", INDEX_COLS)
    return _r(_r(out, ["l_discount", "l_tax"]), ["l_extendedprice"], 4)


def _two_registers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two sides that cover each other in part: all customers, and the totals of all orders under a register that numbers
    customers by twos (some units are on one side only)."""
    a = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    b = table(spark, sf, "orders").groupBy((2 * F.col("o_custkey")).alias("c_custkey")).agg(F.sum("o_totalprice").alias("order_total"))
    return a, b


@query("merge_indicator", sql="""
WITH a AS (SELECT c_custkey, c_acctbal FROM customer),
b AS (SELECT 2 * o_custkey AS c_custkey, sum(o_totalprice) AS order_total FROM orders GROUP BY 2 * o_custkey)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_acctbal, round(b.order_total, 2) AS order_total,
  CASE WHEN a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL THEN 'both'
       WHEN a.c_custkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM a FULL JOIN b ON a.c_custkey = b.c_custkey
""")
def merge_indicator(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer merge with a both/left_only/right_only indicator."""
    a, b = _two_registers(spark, sf)
    m = M.merge_indicator(a, b, "c_custkey")
    return m.select("c_custkey", "c_acctbal", F.round("order_total", 2).alias("order_total"), "_merge")


@query("merge_side_counts", sql="""
WITH a AS (SELECT c_custkey FROM customer),
b AS (SELECT DISTINCT 2 * o_custkey AS c_custkey FROM orders),
m AS (SELECT CASE WHEN a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL THEN 'both'
                  WHEN a.c_custkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
      FROM a FULL JOIN b ON a.c_custkey = b.c_custkey)
SELECT _merge, count(*) AS n FROM m GROUP BY _merge
""")
def merge_side_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per side of the merge indicator (one aggregate over the merge)."""
    return A.count_by(merge_indicator(spark, sf), "_merge", "n")


@query("merge_both_zscore", sql="""
WITH a AS (SELECT c_custkey, c_acctbal FROM customer),
b AS (SELECT 2 * o_custkey AS c_custkey, sum(o_totalprice) AS order_total FROM orders GROUP BY 2 * o_custkey),
both_sides AS (SELECT a.c_custkey, a.c_acctbal, b.order_total FROM a JOIN b ON a.c_custkey = b.c_custkey)
SELECT c_custkey,
  round((c_acctbal - (SELECT avg(c_acctbal) FROM both_sides)) / (SELECT stddev_samp(c_acctbal) FROM both_sides), 6) AS acctbal_z,
  round((order_total - (SELECT avg(order_total) FROM both_sides)) / (SELECT stddev_samp(order_total) FROM both_sides), 6) AS order_total_z
FROM both_sides
""")
def merge_both_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """F9 + A9: rows present on both sides of the merge, z-scored on both
    measures (the step before the index-vs-index line fit)."""
    a, b = _two_registers(spark, sf)
    both = M.keep_side(M.merge_indicator(a, b, "c_custkey"), "both")
    z = S.zscore(both, ["c_acctbal", "order_total"])
    return z.select("c_custkey", F.round("c_acctbal_z", 6).alias("acctbal_z"),
                    F.round("order_total_z", 6).alias("order_total_z"))


@query("zscore_global", sql="""
SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
                        / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS c_acctbal_z
FROM customer
""")
def zscore_global(spark: SparkSession, sf: str) -> DataFrame:
    """Global z-score (ddof=1) via scalar subqueries, no cross join."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return _r(S.zscore(c, ["c_acctbal"]).select("c_custkey", "c_acctbal_z"), ["c_acctbal_z"])


KDE_POINTS = 500


def _between(ts: str, start: str, end: str) -> Column:
    """A half-open range on the column itself, so that it reaches the scan."""
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))


@query("coverage_kde", sql=f"""
WITH z AS (SELECT c_mktsegment AS grp,
             (c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_samp(c_acctbal) FROM customer) AS x
           FROM customer),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM z),
s AS (SELECT grp, count(*) AS m, stddev_samp(x) * pow(count(*), -0.2) AS h FROM z GROUP BY grp),
g AS (SELECT range AS i, lo + range * ((hi - lo) / {KDE_POINTS - 1}) AS gx FROM b, range({KDE_POINTS}))
SELECT z.grp AS c_mktsegment, CAST(g.i AS BIGINT) AS grid_index, round(g.gx, 6) AS grid_x,
  round(sum(exp(-0.5 * pow((g.gx - z.x) / s.h, 2))) / (s.m * s.h * sqrt(2 * pi())), 6) AS density
FROM z JOIN s ON z.grp = s.grp, g
GROUP BY z.grp, g.i, g.gx, s.m, s.h
""")
def coverage_kde(spark: SparkSession, sf: str) -> DataFrame:
    """A17 + A18: Gaussian KDE (Scott bandwidth) of the account-balance
    z-score per market segment on a common 500-point grid."""
    c = S.zscore(table(spark, sf, "customer").select("c_mktsegment", "c_acctbal"), ["c_acctbal"])
    k = S.kde(c, "c_acctbal_z", "c_mktsegment", KDE_POINTS)
    return _r(k, ["grid_x", "density"])


@query("price_density", sql=f"""
WITH d AS (SELECT l_returnflag AS grp, l_extendedprice / 1000.0 AS x FROM lineitem),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
s AS (SELECT grp, count(*) AS m, stddev_samp(x) * pow(count(*), -0.2) AS h FROM d GROUP BY grp),
g AS (SELECT range AS i, lo + range * ((hi - lo) / {KDE_POINTS - 1}) AS gx FROM b, range({KDE_POINTS}))
SELECT d.grp AS l_returnflag, CAST(g.i AS BIGINT) AS grid_index, round(g.gx, 6) AS grid_x,
  round(sum(exp(-0.5 * pow((g.gx - d.x) / s.h, 2))) / (s.m * s.h * sqrt(2 * pi())), 6) AS density
FROM d JOIN s ON d.grp = s.grp, g
GROUP BY d.grp, g.i, g.gx, s.m, s.h
""")
def price_density(spark: SparkSession, sf: str) -> DataFrame:
    """A17 + A18 over few groups of many distinct values: line prices (thousands) per return flag, from moments of cells."""
    li = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 1000.0).alias("price"))
    return _r(S.kde_cells(li, "price", "l_returnflag", KDE_POINTS), ["grid_x", "density"])


def _lines_per_order(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"))
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey")


@query("ols_fit", sql="""
WITH x AS (SELECT o.o_orderkey, CAST(l.n AS DOUBLE) AS n_lines, o.o_totalprice
           FROM orders o JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey)
SELECT round(regr_slope(o_totalprice, n_lines), 4) AS slope, round(regr_intercept(o_totalprice, n_lines), 4) AS intercept,
       CAST(regr_count(o_totalprice, n_lines) AS BIGINT) AS n
FROM x
""")
def ols_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Least-squares line of order price on its number of lines."""
    f = S.fit_line(_lines_per_order(spark, sf), "n_lines", "o_totalprice")
    return f.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.col("n").cast("bigint").alias("n"))


@query("ols_fitted", sql="""
WITH x AS (SELECT o.o_orderkey, CAST(l.n AS DOUBLE) AS n_lines, o.o_totalprice
           FROM orders o JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey),
f AS (SELECT regr_slope(o_totalprice, n_lines) AS m, regr_intercept(o_totalprice, n_lines) AS b FROM x)
SELECT o_orderkey, n_lines, round((SELECT m FROM f) * n_lines + (SELECT b FROM f), 2) AS fitted FROM x
""")
def ols_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted values on the global line."""
    x = _lines_per_order(spark, sf)
    return S.add_fit(x, "n_lines", "o_totalprice").select("o_orderkey", "n_lines", F.round("fitted", 2).alias("fitted"))


@query("zero_share", sql="""
WITH o AS (SELECT o_custkey, count(*) AS n FROM orders WHERE year(o_orderdate) = 1998 GROUP BY o_custkey)
SELECT c.c_nationkey, round(avg(CASE WHEN coalesce(o.n, 0) = 0 THEN 1.0 ELSE 0.0 END), 6) AS share
FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey GROUP BY c.c_nationkey
""")
def zero_share(spark: SparkSession, sf: str) -> DataFrame:
    """Share of customers per nation with no order in 1998."""
    o = (table(spark, sf, "orders").filter(_between("o_orderdate", "1998-01-01", "1999-01-01"))
         .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n")))
    c = M.enrich(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), o, "c_custkey")
    return _r(A.share_where(c, "c_nationkey", F.coalesce(F.col("n"), F.lit(0)) == 0), ["share"])


@query("zero_share_by_year", sql="""
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS units
           FROM orders GROUP BY o_custkey, year(o_orderdate)),
j AS (SELECT coalesce(c.c_custkey, o.o_custkey) AS unit, coalesce(o.year, 0) AS year, coalesce(o.units, 0) AS units
      FROM o FULL JOIN customer c ON o.o_custkey = c.c_custkey),
m AS (SELECT unit, avg(units) AS mean FROM j GROUP BY unit),
y AS (SELECT unnest([1996, 1997, 1998]) AS y)
SELECT CAST(y.y AS VARCHAR) AS period, CAST(count(*) AS BIGINT) AS n_rows, round(avg(CASE WHEN j.units = 0 THEN 1.0 ELSE 0.0 END), 6) AS share
FROM j JOIN y ON j.year = y.y OR j.year = 0 GROUP BY y.y
UNION ALL SELECT 'mean', CAST(count(*) AS BIGINT), round(avg(CASE WHEN mean = 0 THEN 1.0 ELSE 0.0 END), 6) FROM m
""")
def zero_share_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + P17 + A1 + A14: urgent orders per (customer, year) merged with all customers, what is missing filled with 0
    (year 0), and the share of zeros of three years and of the customers' means."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("unit"), F.year("o_orderdate").cast("bigint").alias("year"),
                                          (F.col("o_orderpriority") == "1-URGENT").cast("bigint").alias("units"))
    every = M.outer_merge(A.group_sum(o, ["unit", "year"], ["units"]), table(spark, sf, "customer").select(F.col("c_custkey").alias("unit")), "unit")
    return _r(A.zero_share_by_year(C.fill_nulls(every, 0), "unit", "year", "units", [1996, 1997, 1998]), ["share"])


@query("collapse_units", sql="""
WITH l AS (SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS year, sum(l_quantity) AS qty
           FROM lineitem GROUP BY l_suppkey, year(l_shipdate)),
x AS (SELECT s.s_suppkey, s.s_nationkey, n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
j AS (SELECT coalesce(x.s_nationkey, 0) AS s_nationkey, coalesce(x.n_name, '0') AS n_name,
             coalesce(l.year, 0) AS year, coalesce(l.qty, 0) AS qty
      FROM l FULL JOIN x ON l.l_suppkey = x.s_suppkey),
y AS (SELECT s_nationkey, n_name, year, sum(qty) AS qty FROM j GROUP BY s_nationkey, n_name, year)
SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, n_name, round(avg(qty), 6) AS mean_qty FROM y GROUP BY s_nationkey, n_name
""")
def collapse_units(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + P17 + A27: units per (supplier, year), outer-joined to the
    supplier -> nation crosswalk, unmatched filled with 0 (B11), summed per
    (nation, year) then averaged over years."""
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"),
                                              F.year("l_shipdate").cast("bigint").alias("year")) \
        .agg(F.sum("l_quantity").alias("qty"))
    xw = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").join(
        M.bounded_broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")),
        "s_nationkey")
    j = M.outer_merge(li, xw, "s_suppkey").withColumn("qty", F.coalesce("qty", F.lit(0.0)))
    out = A.collapse_units(j, ["s_nationkey", "n_name"], "year", "qty", "mean_qty", fill_unmatched=True)
    return out.select(F.col("s_nationkey").cast("bigint").alias("s_nationkey"), "n_name",
                      F.round("mean_qty", 6).alias("mean_qty"))


@query("tract_key", sql="""
SELECT c_custkey,
  CAST(CAST(trunc(c_nationkey * 1000000.0 + (c_custkey / 100.0) * 100) AS BIGINT) AS VARCHAR) AS tract_key,
  CAST(CAST(round(c_nationkey * 1000000.0 + (c_custkey / 100.0) * 100) AS BIGINT) AS VARCHAR) AS tract_key_rounded,
  CASE WHEN length(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR)) < 5
       THEN lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR), 5, '0')
       ELSE CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) END AS fips5,
  ltrim(CASE WHEN length(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR)) < 5
       THEN lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR), 5, '0')
       ELSE CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) END, '0') AS fips_stripped,
  CAST(CAST(CAST(c_custkey AS DOUBLE) AS BIGINT) AS VARCHAR) AS key_text
FROM customer
""")
def tract_key(spark: SparkSession, sf: str) -> DataFrame:
    """P13 + P14 + P16: composite tract key (truncated and rounded), a
    zero-padded 5-character code and its zero-stripped form, and an
    integer-valued double key as text."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    code = (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string")
    return c.select("c_custkey",
                    X.tract_key("c_nationkey", F.col("c_custkey") / 100.0).alias("tract_key"),
                    X.tract_key("c_nationkey", F.col("c_custkey") / 100.0, truncate=False).alias("tract_key_rounded"),
                    X.zfill(code, 5).alias("fips5"),
                    X.strip_zeros(X.zfill(code, 5)).alias("fips_stripped"),
                    X.key_to_string(F.col("c_custkey").cast("double")).alias("key_text"))


def _yearly_rate(spark: SparkSession, sf: str) -> DataFrame:
    """X8 + A2: the rate series collapsed to yearly means (percent points)."""
    li = table(spark, sf, "lineitem").select(X.to_year("l_shipdate").alias("year"),
                                             (F.col("l_discount") * 100).alias("rate"))
    return A.group_mean(li, "year", "rate")


@query("yearly_rate", sql="""
WITH r AS (SELECT year(l_shipdate) AS year, avg(l_discount * 100) AS rate FROM lineitem GROUP BY year(l_shipdate))
SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS BIGINT) AS year, round(r.rate, 6) AS rate
FROM orders o LEFT JOIN r ON year(o.o_orderdate) = r.year
""")
def yearly_rate(spark: SparkSession, sf: str) -> DataFrame:
    """X8 + A2 + J2: yearly mean rate joined back onto each order."""
    o = table(spark, sf, "orders").select("o_orderkey", X.to_year("o_orderdate").alias("year"))
    j = M.enrich(o, _yearly_rate(spark, sf), "year")
    return j.select("o_orderkey", F.col("year").cast("bigint").alias("year"), F.round("rate", 6).alias("rate"))


@query("affordability", sql="""
WITH r AS (SELECT year(l_shipdate) AS year, avg(l_discount * 100) AS rate FROM lineitem GROUP BY year(l_shipdate)),
c AS (SELECT p.p_brand, year(l.l_shipdate) AS year, avg(p.p_retailprice) * 100 AS home_value,
             avg(l.l_extendedprice) AS income
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand, year(l.l_shipdate)),
m AS (SELECT c.*, r.rate,
        0.8 * c.home_value * ((r.rate / 1.0 / 12.0) / (1.0 - 1.0 / pow(1.0 + r.rate / 1.0 / 12.0, 360))) AS payment
      FROM c LEFT JOIN r ON c.year = r.year)
SELECT p_brand, CAST(year AS BIGINT) AS year, round(payment, 4) AS monthly_payment,
  round(payment * 12 / income * 100, 6) AS necessary_income,
  round(payment * 4.0 * 12.0, 4) AS qualifying_income,
  round(income / (payment * 4.0 * 12.0) * 100, 6) AS affordability_index
FROM m
""")
def affordability(spark: SparkSession, sf: str) -> DataFrame:
    """Mortgage payment, burden, qualifying income and affordability
    index per (brand, year); the rate is used as read (literal, rate_scale=1)."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    c = (li.join(p, "l_partkey").groupBy("p_brand", X.to_year("l_shipdate").alias("year"))
         .agg((F.avg("p_retailprice") * 100).alias("home_value"), F.avg("l_extendedprice").alias("income")))
    m = M.enrich(c, _yearly_rate(spark, sf), "year").withColumn(
        "payment", X.monthly_payment("home_value", "rate", rate_scale=1.0))
    return m.select("p_brand", F.col("year").cast("bigint").alias("year"),
                    F.round("payment", 4).alias("monthly_payment"),
                    F.round(X.payment_burden("payment", "income"), 6).alias("necessary_income"),
                    F.round(X.qualifying_income("payment"), 4).alias("qualifying_income"),
                    F.round(X.affordability_index("income", "payment"), 6).alias("affordability_index"))


@query("pivot_years_change", sql="""
WITH s AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS t FROM orders
           WHERE year(o_orderdate) IN (1996, 1997) GROUP BY o_custkey, year(o_orderdate)),
w AS (SELECT o_custkey, max(t) FILTER (WHERE y = 1996) AS a, max(t) FILTER (WHERE y = 1997) AS b FROM s GROUP BY o_custkey)
SELECT o_custkey, round(a, 2) AS y1996, round(b, 2) AS y1997, round((b - a) / nullif(a, 0), 6) AS pct_change,
       round(b - a, 2) AS gap
FROM w
""")
def pivot_years_change(spark: SparkSession, sf: str) -> DataFrame:
    """A11 + X6 + X7: yearly totals pivoted to one column per year (one value
    per cell, duplicates raise), percent change and gap."""
    o = table(spark, sf, "orders").filter(_between("o_orderdate", "1996-01-01", "1998-01-01"))
    s = o.select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice").groupBy("o_custkey", "y").agg(F.sum("o_totalprice").alias("t"))
    w = A.pivot_unique(s, "o_custkey", "y", "t", [1996, 1997], {1996: "y1996", 1997: "y1997"})
    return w.select("o_custkey", F.round("y1996", 2).alias("y1996"), F.round("y1997", 2).alias("y1997"),
                    F.round(X.pct_change("y1996", "y1997"), 6).alias("pct_change"),
                    F.round(X.gap("y1997", "y1996"), 2).alias("gap"))


@query("star_master", sql="""
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_price FROM orders GROUP BY o_custkey),
q AS (SELECT o.o_custkey AS c_custkey, sum(l.l_quantity) AS total_qty
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey)
SELECT c.c_custkey, n.n_name, o.n_orders, round(o.total_price, 2) AS total_price, round(q.total_qty, 2) AS total_qty
FROM customer c LEFT JOIN o ON c.c_custkey = o.c_custkey LEFT JOIN q ON c.c_custkey = q.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def star_master(spark: SparkSession, sf: str) -> DataFrame:
    """Chained left merges of per-customer aggregates and a dimension
    onto the customer table. The line quantities are summed per order before
    the order join (pre-aggregation ahead of the shuffle). J12: each joined
    frame is checked for repeated keys in the same plan."""
    o_raw = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    o = o_raw.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price"))
    per_order = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("q"))
    q = per_order.join(o_raw, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("q").alias("total_qty"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    base = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    m = M.build_master(base, [(o, ["c_custkey"], "left"), (q, ["c_custkey"], "left"),
                              (n, ["c_nationkey"], "left")], check_unique=True)
    return m.select("c_custkey", "n_name", "n_orders", F.round("total_price", 2).alias("total_price"),
                    F.round("total_qty", 2).alias("total_qty"))
