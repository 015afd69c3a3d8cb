import json
import re

from pyspark.sql import functions as F

from plenum.functions import patterns as P
from plenum.operators import records as R

KEYS = ["case_number", "ayes", "noes", "vote", "action"]


def brute_salvage(pred):
    out = {}
    for k in KEYS:
        m = re.search(rf'"{k}"\s*:\s*(\[[^\]]*?\])', pred, re.I)
        if m:
            try:
                out[k] = ", ".join(str(x) for x in json.loads(m.group(1)))
            except json.JSONDecodeError:
                out[k] = ""
            continue
        m = re.search(rf'"{k}"\s*:\s*"([^"]*?)"', pred, re.I)
        out[k] = m.group(1).strip() if m else ""
    return out


PREDS = [
    '{"case_number": "98.226D", "ayes": ["Ash", "Oak"], "noes": [], "vote": "2-0", "action": "Approved"}',
    '{"case_number": " 98.1 ", "AYES": ["Ash", "Oak"', '{"Case_Number": "x", "noes": [,"Bad"], "vote": ""}',
    "", "not json at all", '{"ayes": "Ash, Oak", "action": "Cont}',
]


def test_salvage_matches_brute_force(spark):
    df = spark.createDataFrame([(p,) for p in PREDS], "p string")
    got = [r.f.asDict() for r in df.select(R.salvage_fields("p", KEYS).alias("f")).collect()]
    assert got == [brute_salvage(p) for p in PREDS]


def test_is_valid_json_is_python_semantics(spark):
    vals = ['{"a": 1}', '{"a": 1} trailing', "NaN", '{"a": 1, "a": 2}', "[1, 2", None, '"s"']
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(R.is_valid_json("v")).collect()]

    def ok(v):
        try:
            json.loads(v)
            return True
        except Exception:
            return False

    assert got == [ok(v) if v is not None else False for v in vals]


def test_dump_json_matches_python(spark):
    df = spark.createDataFrame([("98.1", 'say "hi"\nnow', ["a", "b"], 3)],
                               "case_number string, action string, ayes array<string>, n bigint")
    got = df.select(R.dump_json(df, ["case_number", "action", "ayes", "n"])).first()[0]
    assert got == json.dumps({"case_number": "98.1", "action": 'say "hi"\nnow', "ayes": ["a", "b"], "n": 3},
                             ensure_ascii=False)


def test_training_pairs_and_diagnostics(spark):
    blocks = spark.createDataFrame([
        ("1998", 1, "98.226D – short"), ("1998", 2, "98.226D – a much longer block"),
        ("1998", 3, "98.300A – unmatched"), ("1998", 4, "no code here"), ("1999", 1, "99.100B: other year")],
        "year string, pos int, block string")
    labels = spark.createDataFrame([
        ("1998", "98.226d", "Approved"), ("1998", "", "x"), ("1999", "99.100 B", None), ("1999", "99.999Z", "y")],
        "year string, case_number string, action string")
    pairs = R.training_pairs(labels, blocks, ["case_number", "action"]).orderBy("year", "code").collect()
    by_code = {(p.year, p.code): p for p in pairs}
    p = by_code[("1998", "98.226D")]
    assert p.paired and p.prompt == "98.226D – a much longer block\n\n"
    comp = json.loads(p.completion.rsplit(" ", 1)[0])
    assert comp["case_number"] == "98.226d" and comp["ayes"] == [] and comp["lot_number"] == ""
    assert p.completion.endswith(" " + P.TERMINATOR)
    assert by_code[("1999", "99.100B")].paired
    assert not by_code[("1998", "")].paired and not by_code[("1999", "99.999Z")].paired
    pairs_df = R.training_pairs(labels, blocks, ["case_number", "action"])
    diag = [tuple(r) for r in R.pairing_diagnostics(pairs_df, blocks).collect()]
    assert ("1998", "missing_label_case_numbers", P.MISSING_CASE) in diag
    assert ("1999", "missing_label_case_numbers", "99.999Z") in diag
    assert ("1998", "unmatched_block_case_numbers", "98.300A") in diag
    assert len(diag) == 3


def test_split_is_deterministic_and_near_ten_percent(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    a = R.split_train_test(df, "doc_id").filter("split = 'test'")
    b = R.split_train_test(df.repartition(7), "doc_id").filter("split = 'test'")
    assert a.count() == b.count()
    assert sorted(r[0] for r in a.select("doc_id").collect()) == sorted(r[0] for r in b.select("doc_id").collect())
    assert 1700 < a.count() < 2300


def test_canonical_keys(spark):
    df = spark.createDataFrame([({"asessor_block": "12", "Speakers": "x", "case_number": "1"},),
                                ({"asessor_block": "9", "assessor_block": "10"},)], "m map<string,string>")
    got = [r[0] for r in df.select(R.canonical_keys("m", {"asessor_block": "assessor_block",
                                                           "Speakers": "speakers"})).collect()]
    assert got[0] == {"assessor_block": "12", "speakers": "x", "case_number": "1"}
    assert got[1] == {"assessor_block": "10"}


def test_explode_votes_and_history(spark):
    rec = spark.createDataFrame([("98.1", "1998-01-08", "Ash, Oak", "Elm", "", "Approved"),
                                 ("98.1", "1998-02-08", "Ash", "", "Oak", "Continued")],
                                "case_number string, meeting_date string, ayes string, noes string, absent string, action string")
    votes = sorted(tuple(r) for r in R.explode_votes(rec).collect())
    assert len(votes) == 5 and ("98.1", "1998-02-08", "Oak", "absent") in votes
    h = R.project_history(rec).first()
    assert (h.first_meeting, h.last_meeting, h.appearances, h.last_action) == ("1998-01-08", "1998-02-08", 2, "Continued")


def test_rule_predictor_is_valid_json(spark):
    blk = "98.226D – 100 MAIN STREET\nACTION: Approved\nAYES: Ash, Oak\nNAYS: None"
    pred = spark.createDataFrame([(blk,)], "b string").select(R.rule_predictor("b")).first()[0]
    obj = json.loads(pred.replace(P.TERMINATOR, ""))
    assert obj["case_number"] == "98.226D" and obj["ayes"] == ["Ash", "Oak"] and obj["action"] == "Approved"


def test_assembled_records_become_a_flat_table(spark):
    pred = ('{"case_number": "98.226D", "assessor_block": "0123 and others", "speakers": ["+ Ann", "- Bob"], "ayes": ["Elm", "Fir"], '
            '"noes": [,], "action": " Approved "} <extra_id_0> "vote": "9-9"')
    df = spark.createDataFrame([("a.txt", "1998-01-08", 1, "98.226D – X\nmore", pred), ("b.txt", None, 2, "", None)],
                               "file string, day string, pos long, block string, pred string")
    records = R.assemble_records(df, "file", "day", "block", "pred")
    assert [r.extracted.assessor_block for r in records.orderBy("block").collect()] == ["0123", None]
    flat = R.flat_records(records)
    assert flat.columns[:3] == ["source_file", "meeting_date", "case_number"] and set(flat.columns[-2:]) == {"block", "speakers"}
    a = flat.where("block = 1").first()
    assert (a.source_file, a.meeting_date, a.block_header, a.case_number, a.assessor_block) == ("a.txt", "1998-01-08", "98.226D – X", "98.226D", "0123")
    assert (a.speakers, a.ayes, a.noes, a.action, a.vote) == ("+ Ann, - Bob", "Elm, Fir", "", "Approved", "")
    assert flat.where("block = 2").count() == 1
