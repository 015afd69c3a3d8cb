"""The JSON acceptor against the standard library."""
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plenum.operators import records as R

CASES = ["", " ", "1", "-0", "01", "-", "1.", ".5", "1.5e+3", "1e", "1 2", "- 1", "true", "tr ue", "truefalse", "nul", '"a"', '"a', "'a'", '"a\\"b"', '"\\x"',
         '"\\u12g4"', '"\\u1234"', '"\t"', '"é "', "[]", "[1,]", "[,1]", "[1,2]", "[1 2]", "[1][2]", "{}", '{"a":1}', '{"a":1,}', '{"a" 1}', "{a:1}", "{1:2}",
         '{"a":{"b":[1,{"c":null}]}}', '{"a":1,"a":2}', '{"a":1} x', "NaN", "-Infinity", "[NaN]", "]", "[", "[}", '"["', '{"[":"]"}', " [ 1 , 2 ]\n", "﻿1",
         "", "", "", '""', "[]", "\\n", '"a" "b"', "[" * 50 + "]" * 50, "[" * 50 + "]" * 49, '"\x7f"', "1 ", None]


def loads(text, **how):
    try:
        json.loads(text, **how)
        return True
    except Exception:
        return False


def refuse(_):
    raise ValueError


def accepted(spark, texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", R.is_valid_json("t", **how)).collect())]


def test_acceptor_is_strict(spark):
    assert accepted(spark, CASES, allow_nan=False) == [loads(t, parse_constant=refuse) for t in CASES]


def test_acceptor_with_nan_is_loads(spark):
    assert accepted(spark, CASES) == [loads(t) for t in CASES]


def test_long_texts(spark):
    texts = [json.dumps({"k": list(range(100000)), "s": "x\\\"" * 50000}), json.dumps([{"a": str(i)} for i in range(20000)]), "[" + "1," * 100000 + "]"]
    assert accepted(spark, texts) == [True, True, False]


values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(),
                      lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(values, st.integers(0, 200), st.sampled_from(['"', ",", ":", "]", "{", "\\", " ", "1", "\n"])), min_size=30, max_size=60))
def test_damaged_documents(spark, made):
    texts = []
    for value, at, ch in made:
        t = json.dumps(value, ensure_ascii=at % 2 == 0)
        texts += [t, t[:at % (len(t) + 1)] + ch + t[at % (len(t) + 1):], t[:at % (len(t) + 1)]]
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    assert accepted(spark, texts, allow_nan=False) == [loads(t, parse_constant=refuse) for t in texts]


@pytest.mark.parametrize("name", ["salvage_json", "valid_json_ratio", "link_parse", "page_text", "page_tables"])
def test_queries_run_without_python_workers(spark, name):
    from plenum.plans import QUERIES
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
