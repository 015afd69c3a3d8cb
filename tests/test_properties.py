"""Semantics rows of the survey (null handling, Unicode whitespace, zero
denominators) and properties that must hold on the driver tables."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from plenum.functions import scalar as X
from plenum.operators import documents as D

from .conftest import SF_SMALL


def test_unicode_whitespace_is_stripped_like_python(spark):
    nbsp = "\u00a0"
    t = f"{nbsp} 98.226D{nbsp}\u2003"
    r = spark.createDataFrame([(t,)], "t string").select(X.strip("t"), X.squash(F.lit(f"a{nbsp} b"))).first()
    assert r[0] == t.strip() == "98.226D"
    assert r[1] == "a b"
    text = f"x\n98.1111A – one {nbsp}\n 98.2222B – two{nbsp}"
    blocks = spark.createDataFrame([(text,)], "t string").select(D.split_blocks("t")).first()[0]
    assert blocks == ["98.1111A – one", "98.2222B – two"]


def test_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    r = df.select(X.share("a", "b"), X.pct_change("b", "a"), X.payment_burden("a", "b")).first()
    assert tuple(r) == (None, None, None)


def test_rollup_equals_direct_sum(spark):
    q = E.queries()
    county = q["unit_year_panel"](spark, SF_SMALL)
    state = q["panel_rollup"](spark, SF_SMALL)
    direct = county.groupBy("year", "region").agg(*[F.round(F.sum(c), 2).alias(c) for c in
                                                    ["urgent_qty", "high_qty", "other_qty"]])
    a = {(r.year, r.region): (r.urgent_qty, r.high_qty, r.other_qty) for r in direct.collect()}
    b = {(r.year, r.region): (r.urgent_qty, r.high_qty, r.other_qty) for r in state.collect()}
    assert a == b


def test_pivot_keeps_totals(spark):
    q = E.queries()
    panel = q["unit_year_panel"](spark, SF_SMALL)
    total = panel.agg(F.sum(F.col("urgent_qty") + F.col("high_qty") + F.col("other_qty"))).first()[0]
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"))
    direct = li.join(o, "l_orderkey").join(c, "o_custkey").agg(F.sum("l_quantity")).first()[0]
    assert abs(total - direct) < 1e-6


def test_paired_plus_unpaired_is_labels(spark):
    stats = E.queries()["pairing_stats"](spark, SF_SMALL).collect()
    for r in stats:
        assert r.paired + r.labels_without_block == r.labels
    total = [r for r in stats if r.year is None][0]
    per_year = [r for r in stats if r.year is not None]
    assert total.labels == sum(r.labels for r in per_year)


def test_shares_are_within_unit_interval(spark):
    w = E.queries()["group_weight"](spark, SF_SMALL)
    sums = w.groupBy("p_brand").agg(F.sum("weight").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-4 for r in sums if r.s is not None)
