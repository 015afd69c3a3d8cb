"""Family A — unit x year panels (pivot, fold, roll-up, repair, shares,
outer merges, value maps, control ladder, transpose) on the driver tables.

Role mapping (documented in the README):
  unit_year_panel: county = nation, state = region, year = order year,
  party = order priority, votes = line quantity pre-summed per order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import merge as M
from ..sources.readers import header_rows, table
from .registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PARTY_NAMES = {"1-URGENT": "urgent_qty", "2-HIGH": "high_qty", "3-MEDIUM": "medium_qty",
               "4-NOT SPECIFIED": "unspecified_qty", "5-LOW": "low_qty"}
PANEL_MEASURES = ["urgent_qty", "high_qty", "other_qty", "max_order_qty"]


def _ballots(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: (year, region, nation, party, votes). Line
    quantities are summed per order *before* the joins: the aggregate's output
    is already hash-partitioned on the order key, so the join with orders
    shuffles only the orders side, and every later join sees 4x fewer rows.
    Nation and region are fixed-size (25 and 5 rows) and broadcast."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("votes"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                                          "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = (li.join(o, "l_orderkey").join(c, "o_custkey")
            .join(M.bounded_broadcast(n), "c_nationkey").join(M.bounded_broadcast(r), "n_regionkey"))
    rows = rows.select(F.year("o_orderdate").cast("bigint").alias("year"), F.col("r_name").alias("region"),
                       F.col("n_name").alias("nation"), F.col("o_orderpriority").alias("party"), "votes")
    # P2 on the unit names only: party codes keep their case for the pivot values.
    return rows.withColumns({"region": F.lower("region"), "nation": F.lower("nation")})


def unit_panel(ballots: DataFrame, keys, party: str, votes: str, parties, names, fold, fold_into: str,
               total_out: str) -> DataFrame:
    """Pivot party votes with sum and zero fill (A10), fold minor parties into
    one column (A12), with every party that is not listed, and attach the
    per-unit maximum (A3) — one aggregation, one shuffle."""
    unlisted = F.when(~F.coalesce(F.col(party).isin(*parties), F.lit(False)), F.col(votes))
    wide = A.pivot_sum(ballots, keys, party, votes, parties, names,
                       extra=[F.max(votes).alias(total_out), F.coalesce(F.sum(unlisted), F.lit(0.0)).alias("__unlisted")])
    return A.fold_other(wide, [*[names[p] for p in fold], "__unlisted"], fold_into)


def county_panel(spark: SparkSession, sf: str) -> DataFrame:
    b = _ballots(spark, sf)
    return unit_panel(b, ["year", "region", "nation"], "party", "votes", PRIORITIES, PARTY_NAMES,
                      ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "other_qty", "max_order_qty")


def _round(df: DataFrame, cols, d: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c in cols})


@query("unit_year_panel", sql="""
WITH per_order AS (SELECT l_orderkey, sum(l_quantity) AS votes FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, lower(r.r_name) AS region, lower(n.n_name) AS nation,
         o.o_orderpriority AS party, p.votes
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT year, region, nation,
  round(coalesce(sum(votes) FILTER (WHERE party = '1-URGENT'), 0), 2) AS urgent_qty,
  round(coalesce(sum(votes) FILTER (WHERE party = '2-HIGH'), 0), 2) AS high_qty,
  round(coalesce(sum(votes) FILTER (WHERE party = '3-MEDIUM'), 0)
      + coalesce(sum(votes) FILTER (WHERE party = '4-NOT SPECIFIED'), 0)
      + coalesce(sum(votes) FILTER (WHERE party NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') OR party IS NULL), 0), 2) AS other_qty,
  round(max(votes), 2) AS max_order_qty
FROM b GROUP BY year, region, nation
""")
def unit_year_panel(spark: SparkSession, sf: str) -> DataFrame:
    return _round(county_panel(spark, sf), PANEL_MEASURES)


@query("panel_rollup", sql="""
WITH per_order AS (SELECT l_orderkey, sum(l_quantity) AS votes FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, lower(r.r_name) AS region, lower(n.n_name) AS nation,
         o.o_orderpriority AS party, p.votes
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
panel AS (
  SELECT year, region, nation,
    coalesce(sum(votes) FILTER (WHERE party = '1-URGENT'), 0) AS urgent_qty,
    coalesce(sum(votes) FILTER (WHERE party = '2-HIGH'), 0) AS high_qty,
    coalesce(sum(votes) FILTER (WHERE party = '3-MEDIUM'), 0)
      + coalesce(sum(votes) FILTER (WHERE party = '4-NOT SPECIFIED'), 0)
      + coalesce(sum(votes) FILTER (WHERE party NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') OR party IS NULL), 0) AS other_qty,
    max(votes) AS max_order_qty
  FROM b GROUP BY year, region, nation)
SELECT year, region, round(sum(urgent_qty), 2) AS urgent_qty, round(sum(high_qty), 2) AS high_qty,
       round(sum(other_qty), 2) AS other_qty, round(sum(max_order_qty), 2) AS max_order_qty
FROM panel GROUP BY year, region
""")
def panel_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The county panel summed to the state (region) level."""
    panel = county_panel(spark, sf).drop("nation")
    return _round(A.rollup_level(panel, ["year", "region"], PANEL_MEASURES), PANEL_MEASURES)


# ---------------------------------------------------------------- repair
REPAIR_YEAR = 2000


def repair_totals(rows: DataFrame, unit: str, year: str, mode: str, party: str, votes: str, total: str,
                  target_year: int, total_mode: str, in_year: Column | None = None) -> DataFrame:
    """Rebuild one year. Units that have a row with the total
    mode keep those rows; for the others the total is the mean per mode summed
    over modes and the votes are summed per party; every other year passes
    through unchanged. ``in_year`` may say the year in terms of another column
    (a date range that reaches the scan).

    The rows that stay (other years, and the year's total rows) are one filter.
    The year is reduced once to a cell per (unit, mode, party); whether a unit
    has a total row (``any_total``), its total and its votes come from the cells."""
    in_year = F.col(year) == target_year if in_year is None else in_year
    is_total = F.coalesce(F.col(mode) == total_mode, F.lit(False))
    cells = rows.filter(in_year & F.col(unit).isNotNull()).groupBy(unit, mode, party).agg(
        F.sum(votes).alias("__votes"), F.sum(total).alias("__sum"), F.count(total).alias("__n"))
    per_mode = cells.groupBy(unit, mode).agg(F.try_divide(F.sum("__sum"), F.sum("__n")).alias("__mean"))
    tot = per_mode.groupBy(unit).agg(F.sum("__mean").alias(total), F.bool_or(is_total).alias("__any_total"))
    tot = tot.filter(~F.col("__any_total")).drop("__any_total")
    cand = cells.groupBy(unit, party).agg(F.sum("__votes").alias(votes))
    repaired = tot.join(cand, unit).withColumn(year, F.lit(target_year).cast(rows.schema[year].dataType))
    return M.replace_slice(rows, in_year & ~is_total, repaired)


@query("repair_totals", sql=f"""
WITH r AS (
  SELECT l_partkey AS unit, CAST(year(l_shipdate) AS BIGINT) AS year, l_linestatus AS mode,
         l_returnflag AS party, l_quantity AS votes, l_extendedprice AS total
  FROM lineitem),
y AS (SELECT * FROM r WHERE year = {REPAIR_YEAR}),
existing AS (SELECT * FROM y WHERE mode = 'F'),
manual AS (SELECT * FROM y WHERE unit NOT IN (SELECT unit FROM existing)),
tot AS (SELECT unit, sum(m) AS total FROM (SELECT unit, mode, avg(total) AS m FROM manual GROUP BY unit, mode) GROUP BY unit),
cand AS (SELECT unit, party, sum(votes) AS votes FROM manual GROUP BY unit, party),
repaired AS (SELECT coalesce(t.unit, c.unit) AS unit, {REPAIR_YEAR} AS year, NULL AS mode, c.party, c.votes, t.total
             FROM tot t FULL JOIN cand c ON t.unit = c.unit)
SELECT unit, year, mode, party, round(votes, 2) AS votes, round(total, 6) AS total FROM (
  SELECT * FROM r WHERE year <> {REPAIR_YEAR}
  UNION ALL SELECT * FROM existing
  UNION ALL SELECT unit, year, mode, party, votes, total FROM repaired)
""")
def repair_totals_q(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_partkey").alias("unit"), F.year("l_shipdate").cast("bigint").alias("year"),
                     F.col("l_linestatus").alias("mode"), F.col("l_returnflag").alias("party"),
                     F.col("l_quantity").alias("votes"), F.col("l_extendedprice").alias("total"), "l_shipdate")
    bound = lambda y: F.lit(f"{y}-01-01").cast("timestamp_ntz")
    in_year = (F.col("l_shipdate") >= bound(REPAIR_YEAR)) & (F.col("l_shipdate") < bound(REPAIR_YEAR + 1))
    out = repair_totals(rows, "unit", "year", "mode", "party", "votes", "total", REPAIR_YEAR, "F", in_year)
    out = _round(out.select("unit", "year", "mode", "party", "votes", "total"), ["votes"])
    return _round(out, ["total"], 6)


@query("units_missing_category", sql="""
SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year
FROM orders GROUP BY o_custkey, year(o_orderdate)
HAVING NOT bool_or(coalesce(o_orderstatus = 'F', false))
""")
def units_missing_category(spark: SparkSession, sf: str) -> DataFrame:
    """(customer, year) groups with no fulfilled order."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year"),
                                          "o_orderstatus")
    return A.units_missing(o, ["o_custkey", "year"], F.col("o_orderstatus") == "F")


# ---------------------------------------------------------------- shares
def office_panel(rows: DataFrame, offices: Sequence[str], unit: str, office: str, party: str, votes: str) -> DataFrame:
    """Per unit and office the total votes, democrat and republican
    counts (NULL when the office or party has no rows) and their shares. All
    offices, totals and party sums share one aggregation; units that are NULL
    are dropped and units without any of the offices are absent, as in a full
    merge of the offices' panels."""
    aggs = []
    for o in offices:
        here = F.col(office) == o
        aggs += [F.sum(F.when(here, F.col(votes))).alias(f"{o}_total"),
                 F.sum(F.when(here & (F.col(party) == "democrat"), F.col(votes))).alias(f"{o}_dem"),
                 F.sum(F.when(here & (F.col(party) == "republican"), F.col(votes))).alias(f"{o}_rep")]
    agg = rows.filter(F.col(unit).isNotNull() & F.col(office).isin(*offices)).groupBy(unit).agg(*aggs)
    return agg.withColumns({f"{p}_pct_{o}": X.share(f"{o}_{p}", f"{o}_total") for o in offices for p in ("dem", "rep")})


def _office_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "ts", "event_type", "value")
    e = C.stringify_lower(e.withColumnRenamed("user_id", "county"), "nan", ["county"])
    return e.select("county", F.when(F.dayofmonth("ts") <= 15, F.lit("house")).otherwise(F.lit("senate")).alias("office"),
                    X.map_values("event_type", {"click": "democrat", "purchase": "republican"}, default="other").alias("party"),
                    F.col("value").alias("votes"))


_SHARE_COLS = ["house_total", "house_dem", "house_rep", "dem_pct_house", "rep_pct_house",
               "senate_total", "senate_dem", "senate_rep", "dem_pct_senate", "rep_pct_senate"]


@query("downballot_shares", sql="""
WITH e AS (
  SELECT lower(CAST(user_id AS VARCHAR)) AS county,
         CASE WHEN day(ts) <= 15 THEN 'house' ELSE 'senate' END AS office,
         CASE event_type WHEN 'click' THEN 'democrat' WHEN 'purchase' THEN 'republican' ELSE 'other' END AS party,
         value AS votes FROM events),
h AS (SELECT county, sum(votes) AS house_total, sum(votes) FILTER (WHERE party = 'democrat') AS house_dem,
             sum(votes) FILTER (WHERE party = 'republican') AS house_rep FROM e WHERE office = 'house' GROUP BY county),
s AS (SELECT county, sum(votes) AS senate_total, sum(votes) FILTER (WHERE party = 'democrat') AS senate_dem,
             sum(votes) FILTER (WHERE party = 'republican') AS senate_rep FROM e WHERE office = 'senate' GROUP BY county)
SELECT coalesce(h.county, s.county) AS county,
  round(house_total, 4) AS house_total, round(house_dem, 4) AS house_dem, round(house_rep, 4) AS house_rep,
  round(house_dem / nullif(house_total, 0), 6) AS dem_pct_house, round(house_rep / nullif(house_total, 0), 6) AS rep_pct_house,
  round(senate_total, 4) AS senate_total, round(senate_dem, 4) AS senate_dem, round(senate_rep, 4) AS senate_rep,
  round(senate_dem / nullif(senate_total, 0), 6) AS dem_pct_senate, round(senate_rep / nullif(senate_total, 0), 6) AS rep_pct_senate
FROM h FULL JOIN s ON h.county = s.county
""")
def downballot_shares(spark: SparkSession, sf: str) -> DataFrame:
    rows = _office_rows(spark, sf)
    out = office_panel(rows, ["house", "senate"], "county", "office", "party", "votes")
    return out.select("county", *_SHARE_COLS).withColumns({c: F.round(c, 6 if "pct" in c else 4) for c in _SHARE_COLS})


@query("two_wave_outer", sql="""
WITH e AS (SELECT user_id, date_trunc('hour', ts) AS unit_hour, event_type, value FROM events),
w1 AS (SELECT user_id, unit_hour, sum(value) AS first_value FROM e WHERE event_type IN ('error', 'view') GROUP BY user_id, unit_hour),
w2 AS (SELECT user_id, unit_hour, count(*) AS second_events FROM e WHERE event_type NOT IN ('error', 'view', 'signup') GROUP BY user_id, unit_hour),
u AS (SELECT coalesce(w1.user_id, w2.user_id) AS user_id, coalesce(w1.unit_hour, w2.unit_hour) AS unit_hour,
             w1.first_value, w2.second_events, 'merged' AS source
      FROM w1 FULL JOIN w2 ON w1.user_id = w2.user_id AND w1.unit_hour = w2.unit_hour)
SELECT user_id, CAST(unit_hour AS VARCHAR) AS unit_hour, round(first_value, 4) AS first_value, second_events, source FROM u
UNION ALL
SELECT user_id, CAST(unit_hour AS VARCHAR), NULL, NULL, 'signup_only'
FROM (SELECT DISTINCT user_id, unit_hour FROM e WHERE event_type = 'signup' EXCEPT SELECT user_id, unit_hour FROM u)
""")
def two_wave_outer(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + U1: two waves (kinds of events) merged on the unit, a user in an hour, with a full outer join, then an outer
    union with a frame of another schema (units seen only at signup). Every event is in one of the three."""
    keys = ["user_id", "unit_hour"]
    e = table(spark, sf, "events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("unit_hour"), "event_type", "value")
    first, signup = F.col("event_type").isin("error", "view"), F.col("event_type") == "signup"
    w1 = e.filter(first).groupBy(*keys).agg(F.sum("value").alias("first_value"))
    w2 = e.filter(~first & ~signup).groupBy(*keys).agg(F.count(F.lit(1)).alias("second_events"))
    merged = M.outer_merge(w1, w2, keys).withColumn("source", F.lit("merged"))
    signup_only = M.missing_keys(e.filter(signup).select(*keys).distinct(), merged, keys).withColumn("source", F.lit("signup_only"))
    out = M.union_outer(merged, signup_only)
    return out.select("user_id", F.col("unit_hour").cast("string").alias("unit_hour"), F.round("first_value", 4).alias("first_value"),
                      "second_events", "source")


@query("merge_null_keys", sql="""
WITH o AS (SELECT o_custkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS office, nullif(year(o_orderdate), 1995) AS year, o_orderstatus, o_totalprice FROM orders),
a AS (SELECT o_custkey, office, year, round(sum(o_totalprice), 2) AS settled FROM o WHERE o_orderstatus = 'F' GROUP BY ALL),
b AS (SELECT o_custkey, office, year, count(*) AS pending FROM o WHERE o_orderstatus <> 'F' GROUP BY ALL)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.office, b.office) AS office,
  CAST(coalesce(a.year, b.year) AS BIGINT) AS year, a.settled, b.pending,
  CASE WHEN a.o_custkey IS NULL THEN 'right_only' WHEN b.o_custkey IS NULL THEN 'left_only' ELSE 'both' END AS _merge
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.office IS NOT DISTINCT FROM b.office AND a.year IS NOT DISTINCT FROM b.year
""")
def merge_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + J4 on several keys that may be null: two office panels of a unit meet on (unit, office, year), and a null
    office or year meets a null one."""
    o = table(spark, sf, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("office"),
        F.nullif(F.year("o_orderdate"), F.lit(1995)).cast("bigint").alias("year"), "o_orderstatus", "o_totalprice")
    keys = ["o_custkey", "office", "year"]
    settled = C.keep_eq(o, "o_orderstatus", "F").groupBy(*keys).agg(F.round(F.sum("o_totalprice"), 2).alias("settled"))
    pending = C.keep_eq(o, "o_orderstatus", "F", negate=True).groupBy(*keys).agg(F.count(F.lit(1)).alias("pending"))
    return M.merge_indicator(settled, pending, keys, null_safe=True)


@query("unit_lookup", sql="""
SELECT c.c_custkey, n.n_nationkey, lower(c.c_name) AS unit, lower(n.n_name) AS state,
  regexp_replace(lower(c.c_name), '#', ' no. ') AS label, CAST(c.c_nationkey AS VARCHAR) || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS key,
  CAST(trunc(c.c_acctbal) AS BIGINT) AS balance
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE (c.c_mktsegment = 'BUILDING' OR c.c_acctbal > 5000 OR c.c_nationkey IN (1, 2)) AND NOT contains(lower(c.c_name), '7')
   OR contains(lower(c.c_name), '77') AND c.c_acctbal BETWEEN 0 AND 9000
""")
def unit_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """P1 + P2 + F4-F6 + J5 + X23 + X24: units with lower-cased names and text, kept by a disjunction, without those whose name
    holds a 7 (but with a range of those that hold 77), looked up under a key of another name, labelled and keyed."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("C_CustKey"), F.col("c_name").alias("Unit"), F.col("c_nationkey").alias("C_NationKey"),
                                            F.col("c_acctbal").alias("C_AcctBal"), F.col("c_mktsegment").alias("Segment"))
    c = C.lower_strings(C.lower_columns(c))
    wanted = C.drop_containing(C.keep_any(c, F.col("segment") == "building", F.col("c_acctbal") > 5000, F.col("c_nationkey").isin(1, 2)), "unit", "7")
    others = C.keep_range(C.keep_any(c, F.col("unit").contains("77")), "c_acctbal", 0, 9000)
    nation = C.lower_strings(table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("state")))
    out = M.join_on(M.union_strict(wanted, others), M.bounded_broadcast(nation), "c_nationkey", "n_nationkey")
    return out.select("c_custkey", "n_nationkey", "unit", "state", X.sub_first("unit", "#", " no. ").alias("label"),
                      X.concat_key("c_nationkey", X.zfill(F.col("c_custkey").cast("string"), 9)).alias("key"),
                      F.col("c_acctbal").cast("bigint").alias("balance"))


@query("incomplete_units", sql="""
WITH u AS (SELECT o_custkey, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS pending,
             max(o_orderpriority) FILTER (WHERE o_orderstatus = 'P' AND year(o_orderdate) = 1998) AS late
           FROM orders GROUP BY o_custkey)
SELECT 'any' AS rule, o_custkey, pending, late FROM u WHERE pending IS NOT NULL AND late IS NOT NULL
UNION ALL
SELECT 'all', o_custkey, coalesce(pending, 0), coalesce(late, '0') FROM u WHERE pending IS NOT NULL OR late IS NOT NULL
""")
def incomplete_units(spark: SparkSession, sf: str) -> DataFrame:
    """P18 + P19 + P17 + U2 on measures with gaps (pending value, last priority of one year): rows without any gap, and rows
    with something in them, whose gaps become 0."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    u = o.groupBy("o_custkey").agg(
        F.round(F.sum(F.when(pending, F.col("o_totalprice"))), 2).alias("pending"),
        F.max(F.when(pending & (F.year("o_orderdate") == 1998), F.col("o_orderpriority"))).alias("late"))
    measures = ["pending", "late"]
    whole = C.drop_incomplete(u, measures).withColumn("rule", F.lit("any"))
    filled = C.fill_nulls(C.drop_incomplete(u, measures, how="all")).withColumn("rule", F.lit("all"))
    return M.union_strict(whole, filled).select("rule", "o_custkey", *measures)


# ---------------------------------------------------------------- value maps
# FIXED VALUES: the point fixes and name map used by the residual query.
SEGMENT_FIXES = {"BUILDING": "construction", "AUTOMOBILE": "automotive"}
NATION_STATES = {"nation_0": "alabama", "nation_1": "alaska", "nation_2": "arizona",
                 "nation_3": "arkansas", "nation_4": "california"}


@query("residual_votes", sql="""
WITH per AS (
  SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS rep,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS dem, count(*) AS total
  FROM orders GROUP BY o_custkey),
c AS (
  SELECT c.c_custkey, lower(c.c_name) AS county,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'automotive' ELSE c.c_mktsegment END AS segment,
         lower(n.n_name) AS nation_l
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY'))
SELECT c.c_custkey, c.county, c.segment,
  coalesce(CASE c.nation_l WHEN 'nation_0' THEN 'alabama' WHEN 'nation_1' THEN 'alaska' WHEN 'nation_2' THEN 'arizona'
           WHEN 'nation_3' THEN 'arkansas' WHEN 'nation_4' THEN 'california' END, lower(c.nation_l)) AS state,
  CAST(2024 AS BIGINT) AS year, p.rep, p.dem, p.total,
  p.total - (p.rep - p.dem) AS residual_literal, p.total - p.rep - p.dem AS residual_corrected
FROM c JOIN per p ON c.c_custkey = p.o_custkey
""")
def residual_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer, fulfilled (rep) and open (dem) order
    counts and the residual, literal and corrected."""
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("rep"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("dem"),
        F.count(F.lit(1)).alias("total"))
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    cust = C.keep_in(cust, "c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"])
    cust = C.replace_values(cust, "c_mktsegment", SEGMENT_FIXES)
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("nation_l"))
    c = cust.join(M.bounded_broadcast(n), "c_nationkey")
    c = C.map_column(c, "nation_l", NATION_STATES, out="state")
    j = c.join(per.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")
    return j.select("c_custkey", F.lower("c_name").alias("county"), F.col("c_mktsegment").alias("segment"), "state",
                    F.lit(2024).cast("bigint").alias("year"), "rep", "dem", "total",
                    X.residual("total", "rep", "dem").alias("residual_literal"),
                    X.residual("total", "rep", "dem", corrected=True).alias("residual_corrected"))


# FIXED VALUES: upper-case lookup for the strict map (misses give NULL).
STRICT_NATIONS = {"NATION_1": "alaska", "NATION_3": "arkansas", "NATION_5": "colorado",
                  "NATION_7": "delaware", "NATION_9": "georgia"}


@query("map_states", sql="""
SELECT n_nationkey,
  coalesce(CASE n_name WHEN 'nation_0' THEN 'alabama' WHEN 'nation_1' THEN 'alaska' WHEN 'nation_2' THEN 'arizona'
           WHEN 'nation_3' THEN 'arkansas' WHEN 'nation_4' THEN 'california' END, lower(n_name)) AS state_fallback,
  CASE upper(trim(n_name)) WHEN 'NATION_1' THEN 'alaska' WHEN 'NATION_3' THEN 'arkansas' WHEN 'NATION_5' THEN 'colorado'
       WHEN 'NATION_7' THEN 'delaware' WHEN 'NATION_9' THEN 'georgia' END AS state_strict
FROM nation
""")
def map_states(spark: SparkSession, sf: str) -> DataFrame:
    """P9 (fallback to the lower-cased input) and P10 (strip + upper, NULL on
    a miss) on the nation names."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return n.select("n_nationkey",
                    X.map_values("n_name", NATION_STATES, default="self").alias("state_fallback"),
                    X.map_values("n_name", STRICT_NATIONS, default=None, normalise=True).alias("state_strict"))


@query("control_ladder", sql="""
WITH codes AS (
  SELECT c_custkey,
    ['D','R','I'][c_custkey % 3 + 1] || CASE WHEN c_custkey % 7 = 0 THEN '[a]' ELSE '' END AS gov_raw,
    ['D','R','S'][(c_custkey // 3) % 3 + 1] AS senate_raw,
    ['D','R','S'][(c_custkey // 9) % 3 + 1] || CASE WHEN c_custkey % 11 = 0 THEN '*' ELSE '' END AS house_raw,
    c_custkey % 100 AS yy, c_nationkey = 0 AS unicameral
  FROM customer),
t AS (SELECT c_custkey, yy, unicameral,
        CASE WHEN length(gov_raw) > 1 THEN substr(gov_raw, 1, 1) ELSE gov_raw END AS gov,
        CASE WHEN length(senate_raw) > 1 THEN substr(senate_raw, 1, 1) ELSE senate_raw END AS senate,
        CASE WHEN length(house_raw) > 1 THEN substr(house_raw, 1, 1) ELSE house_raw END AS house FROM codes)
SELECT c_custkey, gov, senate, house,
  CASE WHEN unicameral THEN '-'
       WHEN senate = 'S' OR house = 'S' THEN 'Split'
       WHEN gov = 'D' AND senate = 'D' AND house = 'D' THEN 'D'
       WHEN gov = 'R' AND senate = 'R' AND house = 'R' THEN 'R'
       WHEN gov IN ('D','R','I') AND senate IN ('D','R') AND house IN ('D','R') THEN 'Split' END AS control,
  CASE WHEN yy > 50 THEN '19' || lpad(CAST(yy AS VARCHAR), 2, '0') WHEN yy < 50 THEN '20' || lpad(CAST(yy AS VARCHAR), 2, '0') END AS year
FROM t
""")
def control_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """Chamber codes (derived deterministically from the key,
    some with footnote marks), first character kept, the control ladder and
    the two-digit year expansion."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    codes = c.select(
        "c_custkey",
        F.concat(F.element_at(F.array(*map(F.lit, "DRI")), (k % 3 + 1).cast("int")),
                 F.when(k % 7 == 0, F.lit("[a]")).otherwise(F.lit(""))).alias("gov_raw"),
        F.element_at(F.array(*map(F.lit, "DRS")), (F.floor(k / 3) % 3 + 1).cast("int")).alias("senate_raw"),
        F.concat(F.element_at(F.array(*map(F.lit, "DRS")), (F.floor(k / 9) % 3 + 1).cast("int")),
                 F.when(k % 11 == 0, F.lit("*")).otherwise(F.lit(""))).alias("house_raw"),
        (k % 100).alias("yy"), (F.col("c_nationkey") == 0).alias("unicameral"))
    t = codes.select("c_custkey", "yy", "unicameral", X.first_char("gov_raw").alias("gov"),
                     X.first_char("senate_raw").alias("senate"), X.first_char("house_raw").alias("house"))
    return t.select("c_custkey", "gov", "senate", "house",
                    X.control("gov", "senate", "house", "unicameral").alias("control"),
                    X.expand_year("yy").alias("year"))


# FIXED VALUES: TPC-H region names (the transpose output columns).
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _control_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """(state, row, label, cells): a sheet per customer, three rows, a column per year of its orders."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.substring("o_orderpriority", 1, 1).cast("int").alias("p"))
    per = o.groupBy("o_custkey", "y").agg(F.max("p").alias("hi"), F.min("p").alias("lo"), F.count(F.lit(1)).cast("int").alias("n"))
    pick = lambda letters, i: F.element_at(F.array(*map(F.lit, letters)), (i % len(letters) + 1).cast("int"))
    mark = F.when(F.col("n") % 2 == 0, F.lit("[a]")).otherwise(F.lit(""))
    codes = [F.concat(pick("DRI", F.col("hi")), mark), pick("DRS", F.col("lo")), F.concat(pick("DR", F.col("n")), mark)]
    cells = per.select("o_custkey", F.concat(F.lit("X"), F.lpad((F.col("y") % 100).cast("string"), 2, "0")).alias("label"),
                       F.explode(F.array(*[F.struct(F.lit(i).alias("row"), c.alias("code")) for i, c in enumerate(codes, 1)])).alias("e"))
    wide = A.rows_to_maps(cells.select("o_custkey", "e.row", "label", "e.code"), ["o_custkey", "row"], "label", "code")
    return wide.select(F.concat(F.lit("State_"), F.col("o_custkey").cast("string"), F.lit("_x")).alias("state"), "row", "cells")


@query("control_panel", sql="""
WITH p AS (SELECT o_custkey, year(o_orderdate) AS y, max(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS hi,
             min(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS lo, count(*) AS n FROM orders GROUP BY o_custkey, year(o_orderdate)),
t AS (SELECT 'State ' || CAST(o_custkey AS VARCHAR) || '_x' AS state, CAST(y AS VARCHAR) AS year, ['D','R','I'][hi % 3 + 1] AS governor,
        ['D','R','S'][lo % 3 + 1] AS senate, ['D','R'][n % 2 + 1] AS house FROM p)
SELECT state, year, state || year AS stateyear, governor, senate, house,
  CASE WHEN senate = 'S' THEN 'Split' WHEN governor = senate AND senate = house THEN governor ELSE 'Split' END AS total_gov
FROM t
""")
def control_panel(spark: SparkSession, sf: str) -> DataFrame:
    """A13 + X23 + X11 + X24 + X22 + X25: sheets of three chambers by year labels, transposed, named, and summed up as the
    control of each state and year."""
    return A.control_panel(_control_sheets(spark, sf))


NEW_YEAR = 1998
VOTES = ["democratic_votes", "republican_votes", "other_votes", "total_votes"]


@query("history_and_new_year", sql=f"""
WITH p AS (SELECT c.c_nationkey AS k, CAST(o.o_custkey AS VARCHAR) AS county_name, CAST(year(o.o_orderdate) AS BIGINT) AS year,
    sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS d,
    sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice ELSE 0 END) AS r, sum(o_totalprice) AS t
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE year(o.o_orderdate) <= {NEW_YEAR} GROUP BY ALL),
m AS (SELECT year, 'state ' || CAST(k AS VARCHAR) AS state, county_name, d, r, t,
        CASE WHEN year = {NEW_YEAR} THEN t - (d - r) ELSE t - d - r END AS o FROM p)
SELECT CAST(0 AS INTEGER) AS level, year, state, county_name, round(d, 2) AS democratic_votes, round(r, 2) AS republican_votes,
  round(o, 2) AS other_votes, round(t, 2) AS total_votes FROM m
UNION ALL
SELECT 1, year, state, NULL, round(sum(d), 2), round(sum(r), 2), round(sum(o), 2), round(sum(t), 2) FROM m GROUP BY year, state
""")
def history_and_new_year(spark: SparkSession, sf: str) -> DataFrame:
    """P2 + P9 + P8 + X2 + P4 + P6 + U1 + A26: a history of years and the new year's table, which has its own column
    names and state codes, in one panel, and its roll-up to states, both from one aggregate."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderpriority", "o_totalprice")
    o = o.where(F.col("o_orderdate") < F.lit(f"{NEW_YEAR + 1}-01-01").cast("timestamp"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    votes = lambda p: F.sum(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")).otherwise(0))
    per = o.groupBy("c_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(
        votes("1-URGENT").alias("d"), votes("2-HIGH").alias("r"), F.sum("o_totalprice").alias("t")).join(c, "c_custkey")
    county, k = F.col("c_custkey").cast("string").alias("county_name"), F.col("c_nationkey").cast("string")
    history = per.where(F.col("year") < NEW_YEAR).select(
        "year", F.concat(F.lit("state "), k).alias("state"), county, F.col("d").alias(VOTES[0]), F.col("r").alias(VOTES[1]),
        X.residual("t", "d", "r", corrected=True).alias(VOTES[2]), F.col("t").alias(VOTES[3]))
    code = F.when(F.col("c_nationkey") < 20, F.concat(F.lit("N"), k)).otherwise(F.concat(F.lit("STATE "), k))
    new = per.where(F.col("year") == NEW_YEAR).select(code.alias("state"), county, F.col("d").alias("smith"), F.col("r").alias("jones"),
                                                      F.col("t").alias("total vote"), F.lit("County").alias("lsad_trans"))
    master = M.append_year(history, new, NEW_YEAR, {"total vote": VOTES[3], "smith": VOTES[0], "jones": VOTES[1]}, VOTES[2],
                           states={f"n{i}": f"state {i}" for i in range(20)})
    return _round(A.rollup_levels(master, [["year", "state", "county_name"], ["year", "state"]], VOTES), VOTES)


@query("transpose_years", sql="""
WITH s AS (
  SELECT r.r_name, CAST(year(o.o_orderdate) AS BIGINT) AS year, sum(o.o_totalprice) AS total
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name, year(o.o_orderdate))
SELECT CAST(year AS VARCHAR) AS field,
  round(max(total) FILTER (WHERE r_name = 'AFRICA'), 2) AS "AFRICA",
  round(max(total) FILTER (WHERE r_name = 'AMERICA'), 2) AS "AMERICA",
  round(max(total) FILTER (WHERE r_name = 'ASIA'), 2) AS "ASIA",
  round(max(total) FILTER (WHERE r_name = 'EUROPE'), 2) AS "EUROPE",
  round(max(total) FILTER (WHERE r_name = 'MIDDLE EAST'), 2) AS "MIDDLE EAST"
FROM s GROUP BY year
""")
def transpose_years(spark: SparkSession, sf: str) -> DataFrame:
    """A region x year table of order totals (regions as rows, years as
    columns) transposed to years as rows and regions as columns."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year"), "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    per = (o.join(c, "o_custkey").join(M.bounded_broadcast(n), "c_nationkey").join(M.bounded_broadcast(r), "n_regionkey")
           .groupBy("r_name", "year").agg(F.sum("o_totalprice").alias("total")))
    wide = A.rows_to_maps(per, "r_name", "year", "total")  # a map per region: no pivot, no list of years
    t = A.transpose_maps(wide, "r_name")
    return t.select("field", *[F.round(F.try_element_at("cells", F.lit(r)), 2).alias(r) for r in REGIONS])


@query("transpose_wide", sql="""
WITH t AS (SELECT l_suppkey % 100 AS lot, l_partkey, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL)
SELECT CAST(l_partkey AS VARCHAR) AS field, CAST(count(*) AS BIGINT) AS n_cells, md5(string_agg(lot || '=' || round(price * 100)::BIGINT, ',' ORDER BY CAST(lot AS VARCHAR))) AS cells_md5
FROM t GROUP BY l_partkey
""")
def transpose_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A13 for a wide table: a hundred rows with a column per part become a row per part."""
    li = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 100).alias("lot"), "l_partkey", "l_extendedprice")
    t = A.transpose_maps(A.rows_to_maps(li, "lot", "l_partkey", "l_extendedprice"), "lot")
    cells = F.transform(F.array_sort(F.map_entries("cells")),
                        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("bigint").cast("string")))
    return t.select("field", F.size("cells").cast("bigint").alias("n_cells"), F.md5(F.array_join(cells, ",")).alias("cells_md5"))


@query("panel_levels", sql="""
WITH per_order AS (SELECT l_orderkey, sum(l_quantity) AS votes FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, lower(r.r_name) AS region, lower(n.n_name) AS nation, o.o_orderpriority AS party, p.votes
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
panel AS (
  SELECT year, region, nation, coalesce(sum(votes) FILTER (WHERE party = '1-URGENT'), 0) AS urgent_qty,
    coalesce(sum(votes) FILTER (WHERE party = '2-HIGH'), 0) AS high_qty,
    coalesce(sum(votes) FILTER (WHERE party IS NULL OR party NOT IN ('1-URGENT', '2-HIGH')), 0) AS other_qty, max(votes) AS max_order_qty
  FROM b GROUP BY year, region, nation)
SELECT 0 AS level, year, region, nation, round(urgent_qty, 2) AS urgent_qty, round(high_qty, 2) AS high_qty, round(other_qty, 2) AS other_qty,
       round(max_order_qty, 2) AS max_order_qty FROM panel
UNION ALL SELECT 1, year, region, NULL, round(sum(urgent_qty), 2), round(sum(high_qty), 2), round(sum(other_qty), 2), round(sum(max_order_qty), 2)
FROM panel GROUP BY year, region
UNION ALL SELECT 2, year, NULL, NULL, round(sum(urgent_qty), 2), round(sum(high_qty), 2), round(sum(other_qty), 2), round(sum(max_order_qty), 2)
FROM panel GROUP BY year
""")
def panel_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The panel at county, state and year level from one aggregate over grouping sets."""
    levels = [["year", "region", "nation"], ["year", "region"], ["year"]]
    return _round(A.rollup_levels(county_panel(spark, sf), levels, PANEL_MEASURES), PANEL_MEASURES)


@query("parse_cascade", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS value,
  ['iso', 'us', 'long', 'compact', 'rejected'][o_orderkey % 5 + 1] AS status, CAST(o_orderkey % 5 AS INTEGER) AS n_failed,
  array_to_string(['iso', 'us', 'long', 'compact'][1:o_orderkey % 5], ',') AS failed
FROM orders
""")
def parse_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """order dates written in four ways and a fifth that no parser reads; parsers are tried in turn and every row stays."""
    d, n = F.col("o_orderdate"), F.col("o_orderkey") % 5
    written = F.when(n == 0, F.date_format(d, "yyyy-MM-dd")).when(n == 1, F.date_format(d, "M/d/yyyy")).when(n == 2, F.date_format(d, "MMMM d, yyyy")) \
        .when(n == 3, F.date_format(d, "yyyyMMdd")).otherwise(F.concat(F.lit("on "), F.date_format(d, "EEEE")))
    rows = table(spark, sf, "orders").select("o_orderkey", written.alias("t"))
    read = {k: F.try_to_timestamp("t", F.lit(f)).cast("date") for k, f in
            (("iso", "yyyy-MM-dd"), ("us", "M/d/yyyy"), ("long", "MMMM d, yyyy"), ("compact", "yyyyMMdd"))}
    out = C.try_in_turn(rows, read)
    return out.select("o_orderkey", F.col("value").cast("string").alias("value"), "status", F.size("failed").alias("n_failed"), F.array_join("failed", ",").alias("failed"))


@query("header_table", sql="""
SELECT c_custkey, c_name AS name, round(c_acctbal, 2) AS balance, c_mktsegment AS col3 FROM customer
""")
def header_table(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet of text cells (a title, a blank row, the header, then customers); the header names the cells."""
    c = table(spark, sf, "customer")
    sheet = c.select((F.col("c_custkey") + 3).alias("row"), F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"),
                     F.col("c_acctbal").cast("string").alias("c"), F.col("c_mktsegment").alias("col3"))
    head = spark.sql("SELECT * FROM VALUES (0L, 'Customers', NULL, NULL, NULL), (1L, NULL, NULL, NULL, NULL), (2L, ' Cust Key', 'Name ', 'BALANCE', NULL) t(row, a, b, c, col3)")
    rows = header_rows(sheet.unionByName(head), "row", 2, ["a", "b", "c", "col3"])
    return rows.select(F.col("cells.cust key").cast("bigint").alias("c_custkey"), F.col("cells.name").alias("name"),
                       F.round(F.col("cells.balance").cast("double"), 2).alias("balance"), F.col("cells.col3").alias("col3"))
