import os

from plenum.streaming import run_once


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(text)


MINUTES_A = ("Thursday, October 14, 2004\r\nRegular Meeting\r\n\r\n"
             "04.0123A – 100 MAIN STREET\r\nACTION: Approved\r\nAYES: Ash, Oak\r\n"
             "04.0456B: 200 ELM AVENUE\r\nACTION: Continued\r\nAYES: Ash\r\n")
MINUTES_B = "Monday, May 2, 2005\n1. First item\n2. Second item\n"


def test_incremental_run_skips_landed_files(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    sink = os.path.join(tmpdir_path, "sink")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    os.makedirs(landing)
    _write(landing, "a.txt", MINUTES_A)
    run_once(spark, landing, sink, checkpoint=ckpt)
    first = spark.read.parquet(sink)
    assert first.count() == 2
    assert sorted(r.case_number for r in first.collect()) == ["04.0123A", "04.0456B"]
    assert {r.meeting_date for r in first.collect()} == {"2004-10-14"}

    _write(landing, "b.txt", MINUTES_B)
    run_once(spark, landing, sink, checkpoint=ckpt)
    second = spark.read.parquet(sink)
    # only the new file was processed: 2 old + 2 new rows, nothing repeated
    assert second.count() == 4
    assert second.filter("source_file = 'a.txt'").count() == 2
