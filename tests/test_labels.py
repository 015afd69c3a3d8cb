"""Label files against the steps written in plain Python."""
import json

import pytest

from plenum.functions import patterns as P
from plenum.operators import labels as L

ALIASES = {"asessor_block": "assessor_block", "Speakers": "speakers", "speaker": "speakers"}
FILES = {
    "1999_labeled.json": json.dumps([
        {"case_number": "99.101a", "asessor_block": "0012", "ayes": ["Ann", "Bo \"B\""], "lot_number": 7, "nested": {"z": 1, "a": [1, "2", {"k": None}]}},
        {"Speakers": "x: y, z", "speaker": "second", "vote": 2.5, "flag": True, "none": None, "action": ""},
        {"asessor_block": "old", "assessor_block": "kept", "case_number": None, "speakers": ["p", "q"]},
        {}, {"é \n\t": "ü\\", "big": 12345678901234567890, "case_number": "99.202"}], ensure_ascii=False, indent=1),
    "2000_labeled.json": " [] ",
    "2001_LABELED.JSON": '[{"case_number":"1.1","noes":[]}]',
    "notes.json": "not looked at",
}
BLOCKS = [("1999", "99.101A", "block one"), ("1999", "99.202", "block two"), ("1999", "", "no code")]


def brute(labels):
    out = []
    for lab in labels:
        mended = {}
        for k in lab:
            right = ALIASES.get(k, k)
            if k == right or (right not in lab and right not in mended):
                mended[right] = lab[k]
        code = (mended.get("case_number") or "").replace(" ", "").upper()
        for k in P.REQUIRED_KEYS:
            mended.setdefault(k, [] if k in P.LIST_KEYS else "")
        out.append((code, json.dumps(mended, ensure_ascii=False) + " " + P.TERMINATOR))
    return out


def files(spark, texts):
    return spark.createDataFrame(list(texts.items()), "file_name string, value string")


def test_labels_become_pairs(spark):
    rows = L.pair_labels(L.parse_labels(files(spark, FILES)), spark.createDataFrame(BLOCKS, "year string, code string, block string").where("code <> ''"), ALIASES).collect()
    got = {(r.year, r.pos): (r.code, r.completion) for r in rows}
    want = {(y, i): x for y, f in (("1999", "1999_labeled.json"), ("2001", "2001_LABELED.JSON")) for i, x in enumerate(brute(json.loads(FILES[f])))}
    assert got == want
    assert {(r.code, r.prompt) for r in rows if r.paired} == {("99.101A", "block one\n\n"), ("99.202", "block two\n\n")}


def test_types_survive(spark):
    rows = {r.pos: r for r in L.parse_labels(files(spark, FILES)).where("year = '1999'").selectExpr(
        "pos", "schema_of_variant(label['ayes']) AS ayes", "schema_of_variant(label['lot_number']) AS lot", "schema_of_variant(label['flag']) AS flag",
        "variant_get(label['nested'], '$.a[2].k', 'string') AS k", "variant_get(label['nested'], '$.a[1]', 'int') AS two").collect()}
    assert (rows[0].ayes, rows[0].lot, rows[0].k, rows[0].two) == ("ARRAY<STRING>", "BIGINT", None, 2) and rows[1].flag == "BOOLEAN"


def test_root_must_be_an_array(spark):
    with pytest.raises(Exception, match="must be a JSON array"):
        L.parse_labels(files(spark, {"2002_labeled.json": '{"a": 1}'})).collect()


def test_files_on_disk(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    assert L.read_typed_labels(spark, str(tmp_path)).count() == 6


def test_spaced_json(spark):
    texts = ['[1,2,{"a:,b":"c,d:e\\"","x":[]}]', "1", '"a,b"', "", "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(L.spaced_json("t")).collect()] == [json.dumps(json.loads(t)) if t else "" for t in texts]


def test_mended_keys_without_aliases(spark):
    df = spark.createDataFrame([({"a": "1"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(L.mend_keys("m", {})).collect()] == [{"a": "1"}, None]
    assert [r[0] for r in df.select(L.mend_keys("m", {"a": "b"})).collect()] == [{"b": "1"}, None]
