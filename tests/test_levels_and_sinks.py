"""Two levels in one aggregate, checks inside the plan, cascades, headers, wide transposes, sinks that keep other years."""
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plenum.operators import aggregate as A
from plenum.operators import clean as C
from plenum.operators import merge as M
from plenum.operators import records as R
from plenum.sources import readers as S
from plenum.sources import sinks as K


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_levels_matches_single_roll_ups(spark):
    df = spark.createDataFrame([(1, "a", "x", 1.0, 2), (1, "a", "y", None, 3), (1, "b", "x", 4.0, None), (2, None, "x", 5.0, 1), (None, "a", "x", 6.0, 1),
                                (2, "a", None, 7.0, 2)], "y int, r string, n string, v double, w int")
    levels = [["y", "r", "n"], ["y", "r"], ["y"], []]
    got = A.rollup_levels(df, levels, ["v", "w"])
    for i, level in enumerate(levels):
        mine = sorted(map(tuple, got.where(F.col("level") == i).select(*level, "v", "w").collect()), key=str)
        if level:
            want = sorted(map(tuple, A.rollup_level(df, level, ["v", "w"]).collect()), key=str)
        else:
            want = [(23.0, 9)]
        assert mine == want
    assert plan(got).count("Scan") == 1


def test_pairing_stats_by_hand(spark):
    labels = spark.createDataFrame([("1", "A"), ("1", "A"), ("1", "B"), ("1", ""), ("2", "C")], "year string, code string")
    blocks = spark.createDataFrame([("1", "A"), ("1", "A"), ("1", "X"), ("1", ""), ("3", "A")], "year string, code string")
    got = {r.year: tuple(r)[1:] for r in A.pairing_stats(labels, blocks).collect()}
    assert got == {"1": (4, 4, 2, 2, 1), "2": (1, 0, 0, 1, 0), "3": (0, 1, 0, 0, 1), None: (5, 5, 2, 3, 2)}
    assert A.pairing_stats(labels.where("false"), blocks.where("false")).where("year IS NOT NULL").count() == 0


def test_unique_keys_are_checked_in_the_plan(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    good = spark.createDataFrame([(1, "x"), (3, "y"), (None, "n"), (None, "m")], "k int, w string")
    out = M.build_master(base, [(good, ["k"], "left")], check_unique=True)
    assert sorted(map(tuple, out.select("k", "w").collect())) == [(1, "x"), (2, None)]
    bad = M.build_master(base, [(good.union(good.where("k = 1")), ["k"], "left")], check_unique=True)  # nothing runs yet
    with pytest.raises(Exception, match="not unique, e.g. 1"):
        bad.collect()
    with pytest.raises(Exception, match="not unique"):
        bad.select("v").count()  # no column of the joined frame is asked for


def test_observed_counts_need_no_job_of_their_own(spark):
    df, seen = M.observed(spark.range(10), "seen", odd=F.sum((F.col("id") % 2).cast("long")))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "odd": 5}


def test_parsers_in_turn(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,)], "t string")
    got = C.try_in_turn(df, {"int": F.expr("try_cast(t AS int)").cast("double"), "double": F.expr("try_cast(t AS double)")})
    assert [tuple(r) for r in got.collect()] == [("1", 1.0, "int", []), ("2.5", 2.5, "double", ["int"]), ("x", None, "rejected", ["int", "double"]),
                                                (None, None, "rejected", ["int", "double"])]


def test_one_write_by_status_reads_the_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = C.try_in_turn(spark.range(20).selectExpr("if(id % 4 = 0, 'x', string(id)) AS t").mapInArrow(count, "t string"), {"int": F.expr("try_cast(t AS int)")})
    K.write_by_status(df, str(tmp_path / "out"))
    assert seen.value == 20
    assert spark.read.parquet(str(tmp_path / "out/status=rejected")).count() == 5 and spark.read.parquet(str(tmp_path / "out/status=int")).count() == 15


def test_header_rows(spark):
    df = spark.createDataFrame([(0, "Report", None, None, None), (1, " CBSA ", "Name ", "", "name"), (2, "10180", "Abilene ", "z", "dup"), (3, None, "B", None, None)],
                               "row int, c0 string, c1 string, c2 string, c3 string")
    out = S.header_rows(df, "row", 1, ["c0", "c1", "c2", "c3"])
    assert [(r.row, r.cells) for r in out.orderBy("row").collect()] == [(2, {"cbsa": "10180", "name": "Abilene ", "c2": "z"}), (3, {"cbsa": None, "name": "B", "c2": None})]
    assert [r.cells for r in S.header_rows(df.where("row != 1"), "row", 1, ["c0", "c1"]).collect()] == [{}, {}]
    assert S.header_rows(df.where("false"), "row", 1, ["c0"]).count() == 0


def test_transpose_of_many_columns(spark):
    long = spark.range(60000).selectExpr("cast(id % 3 as string) AS office", "id div 3 AS year", "id AS v")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("wide", "wide")
    t = A.transpose_maps(A.rows_to_maps(long, "office", "year", "v"), "office", name="year")
    assert not jobs.getJobIdsForGroup("wide")  # none while the query is built
    rows = {r.year: r.cells for r in t.collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 20000 and rows["7"] == {"0": 21, "1": 22, "2": 23}


GOOD = ["plain", "é☃😀", "", "a\x00b", "\r\n"]
BAD = [b"\xff", b"a\xc3", b"\xc3\xc3\xa9", b"\xe2\x82", b"\xe2\x82A", b"\xed\xa0\x80x", b"\xc0\x80", b"\xf0\x90\x80", b"\xf4\x90\x80\x80", b"\xf8\x88\x80\x80\x80", b"\x80\xbf"]


def decoded(spark, blobs):
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "i int, b binary")
    return [r.t for r in df.select("i", S.lenient_utf8("b").alias("t")).orderBy("i").collect()]


def test_stray_bytes_are_dropped(spark):
    blobs = [g.encode() for g in GOOD] + BAD + [b"x" * 200000 + b"\xff" + "é".encode() * 200000]
    assert decoded(spark, blobs) == [b.decode("utf-8", "ignore") for b in blobs]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([b"a", b"\xc3", b"\xa9", b"\xe2", b"\x98", b"\x83", b"\xf0", b"\x9f", b"\xed", b"\xa0", b"\xff", b"\x80", b"\xf4", b"\x90"]),
                         max_size=12), min_size=100, max_size=200))
def test_any_bytes_decode_as_the_library_does(spark, made):
    blobs = [b"".join(m) for m in made]
    assert decoded(spark, blobs) == [b.decode("utf-8", "ignore") for b in blobs]


def test_documents_with_bad_bytes(spark, tmp_path):
    (tmp_path / "2004_sample1.txt").write_bytes(b"caf\xe9 \xc3\xa9\r\nb")
    assert [(r.text, r.year) for r in S.read_documents(spark, str(tmp_path), r"^(\d{4})_").collect()] == [("caf é\nb", "2004")]


def test_text_files_of_other_years_stay(spark, tmp_path):
    path, schema = str(tmp_path / "txt"), "year string, day string, text string, ord int"
    K.write_text_files(spark.createDataFrame([("2004", "July_21", "old", 1), ("2004", "July_21", "one\ntwo", 2), ("2004", "May_1", None, 1), ("2005", "May_1", "kept\n", 1)],
                                             schema), path, ["year"], "day", "text", order="ord")
    K.write_text_files(spark.createDataFrame([("2004", "July_21", "again", 1), ("2006", "June 3/4", "new", 1)], schema), path, ["year"], "day", "text", order="ord")
    got = sorted((str(r.year), r.day, r.text) for r in S.read_text_files(spark, path).collect())
    assert got == [("2004", "July_21", "again"), ("2004", "May_1", ""), ("2005", "May_1", "kept\n"), ("2006", "June 3/4", "new")]
    assert (tmp_path / "txt/year=2004/day=July_21").is_dir()


def test_diagnostics_and_summary(spark, tmp_path):
    labels = spark.createDataFrame([("1999", "A"), ("2000", "B")], "year string, code string")
    blocks = spark.createDataFrame([("1999", "A")], "year string, code string")
    details = spark.createDataFrame([("2000", "missing_label_case_numbers", "B")], "year string, kind string, code string")
    for _ in range(2):
        K.write_diagnostics(details, str(tmp_path), stats=A.pairing_stats(labels, blocks))
    K.write_diagnostics(details.withColumn("year", F.lit("2001")), str(tmp_path), stats=A.pairing_stats(labels.where("false"), blocks.where("false")))
    assert sorted(p.name for p in (tmp_path / "stats").iterdir() if p.is_dir()) == ["year=1999", "year=2000", "year=summary"]
    assert sorted(p.name for p in (tmp_path / "details").iterdir() if p.is_dir()) == ["year=2000", "year=2001"]


def test_predictor_reads_the_prompt_and_is_loaded_by_the_task(spark):
    def load():
        loaded = []

        def predict(prompts: pd.Series) -> pd.Series:
            loaded.append(1)
            return prompts.str.upper() + f" {len(loaded)}"

        return predict

    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"p{i}") for i in range(30)], "i int, p string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = [r.pred for r in R.infer_with(df, "p", load).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got[0] is None and got[1] == "P1 1" and got[11] == "P11 2" and got[29] == "P29 3"  # one loading, three batches


def test_small_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t"))
    wide = S.spread(one)
    assert wide.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1 and wide.count() == 100
    many = one.repartition(64)
    assert S.spread(many) is many
