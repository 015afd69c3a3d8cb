import json
import os

import pytest
from pyspark.sql import functions as F

from plenum.sources import readers as S
from plenum.sources import sinks as K


def _w(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_read_labels_open_keys_and_root_check(spark, tmpdir_path):
    _w(f"{tmpdir_path}/lab/1999_labeled.json",
       json.dumps([{"case_number": "99.1A", "asessor_block": "12"}, {"Speakers": "x"}]))
    df = S.read_labels(spark, f"{tmpdir_path}/lab/*_labeled.json")
    got = sorted((r.year, r.pos, tuple(sorted(r.label.items()))) for r in df.collect())
    assert got == [(1999, 0, (("asessor_block", "12"), ("case_number", "99.1A"))), (1999, 1, (("Speakers", "x"),))]
    _w(f"{tmpdir_path}/bad/2000_labeled.json", json.dumps({"not": "an array"}))
    with pytest.raises(Exception):
        S.read_labels(spark, f"{tmpdir_path}/bad/*_labeled.json").collect()


def test_read_documents_and_concat_parts(spark, tmpdir_path):
    _w(f"{tmpdir_path}/t/2004_sample2.txt", "b1\r\nb2\r")
    _w(f"{tmpdir_path}/t/2004_sample1.txt", "a1\na2")
    _w(f"{tmpdir_path}/t/2005_sample1.txt", "c")
    docs = S.read_documents(spark, f"{tmpdir_path}/t/*.txt", r"^(\d{4})_sample")
    joined = {r.year: r.text for r in S.concat_parts(docs, "year").collect()}
    assert joined == {"2004": "a1\na2\n\nb1\nb2\n", "2005": "c"}


def test_matrix_json_and_numbers(spark):
    payload = json.dumps([["B01003_001E", "cbsa"], ["1000", "10180"], [None, "10420"], ["n/a", "10500"]])
    df = spark.createDataFrame([(2010, payload)], "year int, p string")
    t = S.matrix_json_to_rows(df, "p", ["year"]).select("year", F.col("row")["B01003_001E"].alias("pop"),
                                                          F.col("row")["cbsa"].alias("cbsa"))
    from plenum.operators.clean import to_number

    got = sorted((tuple(r) for r in to_number(t, ["pop"]).collect()), key=lambda r: r[2])
    assert got == [(2010, 1000.0, "10180"), (2010, None, "10420"), (2010, None, "10500")]


def test_promote_header_and_by_filename(spark, tmpdir_path):
    df = spark.createDataFrame([(0, "Report", None), (1, " CBSA ", "Name "), (2, "10180", "Abilene ")],
                               "row int, c0 string, c1 string")
    out = S.promote_header(df, "row", 1, ["c0", "c1"])
    assert out.columns == ["cbsa", "name"] and [tuple(r) for r in out.collect()] == [("10180", "Abilene ")]
    for st in ("al", "ak"):
        _w(f"{tmpdir_path}/p/2020-{st}-precinct-general.csv", "county_name,votes\nx,1\ny,abc\n")
    p = S.read_by_filename(spark, f"{tmpdir_path}/p/*.csv", r"2020-([a-z]{2})-precinct", "state",
                           schema="county_name string, votes string")
    assert sorted({r.state for r in p.collect()}) == ["ak", "al"]


def test_sinks_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("2004", "a", "t1", 1), ("2004", "a", "t2", 2), ("2005", "b", "t3", 1)],
                               "year string, key string, text string, ord int")
    K.write_text_by(df, f"{tmpdir_path}/txt", ["year"], "key", "text", order="ord")
    back = sorted((str(r.year), r.key, r.text) for r in spark.read.parquet(f"{tmpdir_path}/txt").collect())
    assert back == [("2004", "a", "t2"), ("2005", "b", "t3")]
    K.write_jsonl(df.limit(1), f"{tmpdir_path}/j")
    K.write_jsonl(df.limit(1), f"{tmpdir_path}/j", mode="append")
    assert spark.read.json(f"{tmpdir_path}/j").count() == 2
    good, bad = K.split_rejects(df, F.col("ord") == 1)
    assert good.count() == 2 and bad.count() == 1
    landed = spark.createDataFrame([("a",)], "key string")
    assert [r.key for r in K.skip_landed(df, landed, "key").collect()] == ["b"]
    K.write_table(df, f"{tmpdir_path}/csv", fmt="csv")
    assert S.read_table(spark, f"{tmpdir_path}/csv", "year string, key string, text string, ord int", "csv").count() == 3
