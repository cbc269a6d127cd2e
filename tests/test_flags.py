"""JSON answer extraction, code flags and one-hot flags (edge goldens)."""

import pytest

from daybook.functions.flags import code_flag, json_answers, one_hot

JSON_CASES = [
    ('{"answer":["19","20"]}', '["19","20"]', 1),
    ('{"answer": [ "19" , "20" ]}', '["19","20"]', 1),
    ('{"answer":"19"}', "19", 0),
    ('{"answer":[19,20]}', "[19,20]", 0),
    ('{"answer":null}', None, 0),
    ("{}", None, 0),
    ("not json", None, 0),
    (None, None, 0),
    ('{"answer":{"x":"21"}}', '{"x":"21"}', 0),
    ('{"answer":["191"]}', '["191"]', 0),
    ('{"answer":"[\\"19\\"]"}', '["19"]', 1),
]


def test_json_answer_and_code_19(spark):
    df = spark.createDataFrame([(i, j) for i, (j, _, _) in enumerate(JSON_CASES)], "i int, j string")
    ans = json_answers("j")
    rows = {r.i: (r.a, r.f) for r in df.select("i", ans.alias("a"), code_flag(ans, "19").alias("f")).collect()}
    for i, (_, want_text, want_flag) in enumerate(JSON_CASES):
        assert rows[i] == (want_text, want_flag), JSON_CASES[i]


def test_code_flag_is_never_null(spark):
    df = spark.createDataFrame([(None,)], "j string")
    assert df.select(code_flag(json_answers("j"), "21").alias("f")).first().f == 0


@pytest.mark.parametrize("value,expected", [("good", 1), ("Good", 0), ("other", 0), (None, 0), ("bad", 0)])
def test_one_hot_good(spark, value, expected):
    df = spark.createDataFrame([(value,)], "o string")
    assert df.select(one_hot("o", "good").alias("x")).first().x == expected
