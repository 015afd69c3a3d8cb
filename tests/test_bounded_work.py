"""Work per row and per task that must not grow: each text is cut once, tasks hold a bounded number of rows."""

from pyspark.sql import functions as F

from plenum.functions import scalar as X
from plenum.operators import documents as D
from plenum.operators import labels as L
from plenum.operators import markup as MK
from plenum.operators import records as R
from plenum.plans import minutes as M
from plenum.sources.readers import spread


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain(True)
    return capsys.readouterr().out.split("== Physical Plan ==")[1]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_tasks_hold_a_bounded_number_of_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 40 * cores * 10, 1, cores)
    dealt = spread(many, rows=10)
    assert dealt.rdd.getNumPartitions() == 40 * cores
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 20
    assert spread(many, rows=400).rdd.getNumPartitions() == cores
    assert dealt.agg(F.sum("id")).first() == many.agg(F.sum("id")).first()


def test_a_page_is_cut_once(spark, capsys):
    pages = texts(spark, "<p>a &amp; b</p><!-- c --><p>&lt;d&#33; &amp;amp; &unknown; &amp</p>", "plain", None)
    assert plan(pages.select(MK.page_text("t").alias("x")), capsys).count("(?is)") == 1
    assert [r[0] for r in pages.select(MK.page_text("t")).collect()] == ["a & b\n<d! &amp; &unknown; &amp", "plain", ""]
    split = pages.select(D.split_meetings("t").alias("x"))
    assert plan(split, capsys).count("regexp_replace") == 1


def test_validity_marks_a_text_once(spark, capsys):
    df = texts(spark, '{"a": ["\\n", 1]}', '{"a": [,1]}', "", None)
    assert plan(df.select(R.is_valid_json("t").alias("x")), capsys).count("bfnrt") == 1
    assert [r[0] for r in df.select(R.is_valid_json("t")).collect()] == [True, False, False, False]


def test_salvage_reads_the_text_for_all_keys_at_once(spark, capsys):
    df = texts(spark, '{"VOTE": " 2-1 ", "vote": ["x", "y"], "ayes": [,"z"], "noes": ["a", 1], "absent": [], "action": "say "ayes": ["q"]', "", None)
    f = R.salvage_fields("t")
    assert plan(df.select(f.alias("x")), capsys).count("regexp_extract") == 2
    one, empty, null = [r.f for r in df.select(f.alias("f")).collect()]
    assert (one.vote, one.ayes, one.noes, one.absent, one.action, one.lot_number) == ("x, y", "", "a, 1", "", "say", "")
    assert set(empty) == {""} and set(null) == {None}


def test_strip_looks_at_the_ends_only(spark, capsys):
    df = texts(spark, "  a   b\x85\n", "　", None)
    assert "regexp" not in plan(df.select(X.strip("t"), X.rstrip("t")), capsys)
    assert [tuple(r) for r in df.select(X.strip("t"), X.rstrip("t")).collect()] == [("a   b", "  a   b"), ("", ""), (None, None)]


def test_header_pattern_runs_once(spark, capsys):
    df = texts(spark, "on Friday, October 15, 2004", "Friday October 15, 2004", None)
    assert plan(df.select(X.parse_weekday_date("t").alias("x")), capsys).count("September") == 1
    assert [str(r[0]) for r in df.select(X.parse_weekday_date("t")).collect()] == ["2004-10-15", "None", "None"]


def test_minutes_are_one_expression_for_all_blocks(spark, capsys):
    import datetime

    day = datetime.datetime(2004, 10, 14)
    orders = spark.createDataFrame([(2, 7, day, "1-URGENT", "F"), (3, -2, day, "2-HIGH", "O"), (4, None, day, "5-LOW", "P")],
                                   "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_orderstatus string")
    m = M.minutes(spark, "", orders)
    assert plan(m, capsys).count("ACTION: ") == 1
    blocks = [r.text.split("\n\n")[1].count("PROJECT") for r in m.orderBy("o_orderkey").collect()]
    assert blocks == [4, 0, 0]


def test_labels_are_spread_over_the_cores(spark, tmp_path):
    spark.sql("SELECT id AS o_orderkey, id % 4 AS o_custkey, timestamp'2004-10-14' AS o_orderdate FROM range(0, 40, 1, 1)") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    labels = M._labels(spark, str(tmp_path))
    assert labels.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert labels.count() == 40


def test_names_of_keys_are_looked_up_once_a_label(spark, capsys):
    rows = [(["actoin", "b", "acton"], ["x", "y", "z"]), (["actoin", "action"], ["x", "y"]), (None, None)]
    df = spark.createDataFrame(rows, "k array<string>, v array<string>").select(F.map_from_arrays("k", "v").alias("m"))
    mended = df.select(L.mend_keys("m", {"actoin": "action", "acton": "action"}).alias("m"))
    capsys.readouterr()
    mended.explain("extended")
    assert capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical")[0].count("actoin") == 1
    assert [None if r[0] is None else list(r[0].items()) for r in mended.collect()] == [[("action", "x"), ("b", "y")], [("action", "y")], None]


def test_what_is_paired_is_told_without_texts(spark, capsys):
    labels = spark.createDataFrame([("2004", "04.1 23A"), ("2004", ""), (None, "04.123A"), ("2005", "04.123A")], "year string, case_number string")
    blocks = spark.createDataFrame([("2004", 1, "04.123A x"), ("2004", 2, "04.123A longer"), (None, 1, "04.123A x"), ("2004", 3, "04.999 y"), ("2004", 4, "none")],
                                   "year string, pos int, block string")
    pairs = R.training_pairs(labels, blocks, ["case_number"])
    told = pairs.select("year", "code", "paired")
    assert "max_by" not in plan(told, capsys)
    want = [(None, "04.123A", False), ("2004", "", False), ("2004", "04.123A", True), ("2005", "04.123A", False)]
    assert sorted(map(tuple, told.collect()), key=str) == sorted(want, key=str)
    assert {(r.year, r.code): r.prompt for r in pairs.collect()}["2004", "04.123A"] == "04.123A longer\n\n"
    codes = R.code_summary(blocks).select("year", "code", "n_blocks")
    alone = R.training_pairs(labels, None, ["case_number"], summary=codes)
    assert sorted(map(tuple, alone.select("year", "code", "paired", "prompt").collect()), key=str) == sorted([(*w, None) for w in want], key=str)
    diag = [tuple(r) for r in R.pairing_diagnostics(alone, None, summary=codes).collect()]
    assert diag == [tuple(r) for r in R.pairing_diagnostics(pairs, blocks).collect()]
    assert diag[0] == (None, "missing_label_case_numbers", "04.123A") and diag[1] == (None, "unmatched_block_case_numbers", "04.123A")
    assert diag[-1] == ("2005", "missing_label_case_numbers", "04.123A") and ("2004", "unmatched_block_case_numbers", "04.999") in diag


def test_minutes_are_made_in_tasks_of_a_bounded_number_of_orders(spark, tmp_path, capsys, monkeypatch):
    spark.sql("SELECT id AS o_orderkey, id % 4 AS o_custkey, timestamp'2004-10-14' AS o_orderdate, '1-URGENT' AS o_orderpriority, 'F' AS o_orderstatus "
              "FROM range(0, 60, 1, 1)").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(M, "spread", lambda df: spread(df, rows=1))
    for query in (M.speaker_stances, M.project_history, M.tag_untag, M.meeting_header):
        p = plan(query(spark, str(tmp_path)), capsys)
        assert p.count("RoundRobinPartitioning(60)") == 1, query.__name__
        assert "PRESENT: " in p.split("RoundRobinPartitioning(60)")[0] and "PRESENT: " not in p.split("RoundRobinPartitioning(60)")[1]
