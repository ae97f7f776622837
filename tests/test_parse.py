import pytest
from pyspark.sql import functions as F

from gleanframe.operators.parse import parse_object, slice_text, validate_schema
from gleanframe.spec import JOB_POSTING
from tests.jobs import preds_frame

# text, valid, JSON of the parsed object
CASES = [
    ('{"a":1}', True, '{"a":1}'),
    ("{}", True, "{}"),
    ('Sure, here:\n```json\n{"a":1}\n```', True, '{"a":1}'),
    ('  {"a":\n 1}\t', True, '{"a":1}'),
    ('{"a":1,"a":2}', True, '{"a":2}'),
    ('{"a":null}', True, '{"a":null}'),
    ('{"b":1}', True, '{"b":1}'),
    ('{"a":{"b":[1,{"c":"}"}]}}', True, '{"a":{"b":[1,{"c":"}"}]}}'),
    ('{"a":"{"}', True, '{"a":"{"}'),
    ('{"a":1} foo {"b":2}', False, None),
    ('{"a":1}{"b":2}', False, None),
    ('{"a":1},{"b":2}', False, None),
    ('{"a":1}] x {"b":2}', False, None),
    ('{"a":1}} x {"b":2}', False, None),
    ('{"a":1},0] x {"b":2}', False, None),
    ('{"a":1},"y":{"b":2}', False, None),
    ('{"a":1}}', False, None),
    ('{"a":1,"a":{}', False, None),
    ("}{", False, None),
    ("none", False, None),
    ("", False, None),
    (None, False, None),
    ("{'a':1}", False, None),
    ('{"a":1,}', False, None),
    ('{"a":01}', False, None),
    ('{"a":1 /* c */}', False, None),
    ('{a:1}', False, None),
]


def test_parse_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "i int, raw_text string")
    out = {r.i: r for r in parse_object(df).select("i", "json_valid",
                                                   F.to_json("object").alias("o")).collect()}
    for i, (text, valid, value) in enumerate(CASES):
        assert (out[i].json_valid, out[i].o) == (valid, value), text


def test_nan_is_rejected(spark):
    """A known difference: some JSON readers take NaN."""
    df = spark.createDataFrame([('{"a":NaN}',)], "raw_text string")
    assert parse_object(df).first().json_valid is False


@pytest.mark.parametrize("text,piece", [
    ("a {b} c } d", "{b} c }"), ("} {", ""), ("{", None), ("}", None), ("", None), (None, None),
    ("é{ü}ß", "{ü}"), ("{\n}", "{\n}"),
])
def test_slice(spark, text, piece):
    df = spark.createDataFrame([(text,)], "raw_text string")
    assert slice_text(df).first().json_text == piece


def test_slice_is_linear_on_hostile_text(spark):
    df = spark.createDataFrame([(1,)], "n int").select(
        F.concat(F.lit("}"), F.repeat(F.lit("{"), F.lit(2_000_000))).alias("raw_text"))
    assert slice_text(df).first().json_text == ""


def test_long_object_parses_whole(spark):
    df = spark.createDataFrame([(1,)], "n int").select(
        F.concat(F.lit('x {"a":"'), F.repeat(F.lit("é"), F.lit(3_000_000)), F.lit('","b":7} y')).alias("raw_text"))
    row = parse_object(df).select("json_valid", F.try_variant_get("object", "$.b", "int").alias("b"),
                                  F.length(F.try_variant_get("object", "$.a", "string")).alias("n")).first()
    assert (row.json_valid, row.b, row.n) == (True, 7, 3_000_000)


def test_schema_breaches(spark):
    full = ('"company":null,"location":null,"seniority":null,"salary_max":null,'
            '"salary_currency":null,"salary_period":null,"preferred_skills":[],'
            '"min_years_experience":null,"education":null')
    preds = preds_frame(spark, [
        ("a", "1", '{"title":null,"workplace_type":"moon","employment_type":3,"salary_min":"9",'
                   '"required_skills":["x",1],"why":1,' + full + '}'),
        ("a", "2", "{}"),
        ("a", "3", "no"),
        ("a", "4", '{"title":"T","workplace_type":"remote","employment_type":null,"salary_min":true,'
                   '"required_skills":["x"],' + full + '}'),
    ])
    got = {}
    for r in validate_schema(preds, JOB_POSTING).collect():
        got.setdefault(r.row_id, set()).add((r.field, r.violation))
    assert got["1"] == {("title", "null"), ("workplace_type", "enum"), ("employment_type", "type"),
                        ("salary_min", "type"), ("required_skills", "type"), ("why", "extra")}
    assert got["2"] == {(f.name, "missing") for f in JOB_POSTING.fields}
    assert got["3"] == {("", "not_json")}
    assert got["4"] == {("salary_min", "type")}
