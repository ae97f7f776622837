"""D4 on raw lines: every line is a record or in quarantine, by the rules that plain Python applies."""

import json

import pytest

from gleanframe.operators import parse
from gleanframe.sources import records
from gleanframe.spec import JOB_POSTING, LIST, NUMBER
from tests.jobs import CLERK, NURSE

GOOD = json.dumps({"posting": "Clerk   typist", "labels": CLERK})
NAMES = [f.name for f in JOB_POSTING.fields]


def _with(**changes):
    return json.dumps({"posting": "x", "labels": {**CLERK, **changes}})


LINES = {
    "good": (GOOD, []),
    "blanks around": ("  " + GOOD + " \t\r", []),
    "keys in any order": (json.dumps({"labels": dict(reversed(CLERK.items())), "posting": "x"}), []),
    "repeated key": ('{"posting": 1, ' + GOOD[1:], []),
    "trailing": (GOOD + " and more", [("", "not_json")]),
    "two objects": (GOOD + GOOD, [("", "not_json")]),
    "trailing comma": (GOOD[:-1] + ",}", [("", "not_json")]),
    "single quotes": (GOOD.replace('"', "'"), [("", "not_json")]),
    "comment": (GOOD + " // x", [("", "not_json")]),
    "cut": (GOOD[:-1], [("", "not_json")]),
    "array": ("[" + GOOD + "]", [("", "not_json")]),
    "array break-out": ("{}, {}", [("", "not_json")]),
    "closing bracket": (GOOD + "]", [("", "not_json")]),
    "number": ("5", [("", "not_json")]),
    "text": ("plain words", [("", "not_json")]),
    "nothing in it": ("{}", [("labels", "missing"), ("posting", "missing")]),
    "no posting": (json.dumps({"labels": CLERK}), [("posting", "missing")]),
    "null posting": (json.dumps({"posting": None, "labels": CLERK}), [("posting", "null")]),
    "posting a number": (json.dumps({"posting": 3, "labels": CLERK}), [("posting", "type")]),
    "no labels": ('{"posting": "x"}', [("labels", "missing")]),
    "null labels": ('{"posting": "x", "labels": null}', [("labels", "null")]),
    "labels a list": ('{"posting": "x", "labels": []}', [("labels", "type")]),
    "labels as text": ('{"posting": "x", "labels": "{}"}', [("labels", "type")]),
    "empty labels": ('{"posting": "x", "labels": {}}', [(n, "missing") for n in NAMES]),
    "unknown member": ('{"id": 7, ' + GOOD[1:], [("id", "extra")]),
    "unknown label": (_with(salary=1), [("salary", "extra")]),
    "wrong value": (_with(seniority="boss"), [("seniority", "enum")]),
    "wrong type": (_with(salary_min="10"), [("salary_min", "type")]),
    "no title": (_with(title=None), [("title", "null")]),
}


def _checked(spark, lines):
    return parse.checked_lines(spark.createDataFrame(lines, "row_id string, value string"), JOB_POSTING)


def test_hand_cases(spark):
    rows = [(k, v) for k, (v, _) in LINES.items()] + [("blank", " \t "), ("empty", ""), ("null", None)]
    got = {r.row_id: sorted((b.field, b.violation) for b in r.breaches) for r in _checked(spark, rows).collect()}
    assert got == {k: sorted(v) for k, (_, v) in LINES.items()}


def test_records_and_breaches_share_out_the_lines(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _) in LINES.items()], "row_id string, value string")
    good = {r.row_id for r in parse.records_of_lines(df, JOB_POSTING).collect()}
    bad = {r.row_id for r in parse.validate_lines(df, JOB_POSTING).collect()}
    assert good | bad == set(LINES) and not good & bad
    assert good == {k for k, (_, v) in LINES.items() if not v}


def test_records_are_those_of_the_reader(spark, tmp_path):
    """Files with bad lines: the clean ones come out typed as the strict reader gives them; the others raise there
    or would be read without a word."""
    clean = [json.dumps({"posting": "Nurse é", "labels": NURSE}, ensure_ascii=False), GOOD, _with(min_years_experience=2)]
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "a.jsonl").write_text("\n".join([clean[0], GOOD + " tail", "", clean[1]]) + "\n", encoding="utf-8")
    (tmp_path / "mixed" / "b.jsonl").write_text("\n".join([clean[2], "{'posting': 1}"]), encoding="utf-8")
    (tmp_path / "clean.jsonl").write_text("\n".join(clean), encoding="utf-8")
    checked = parse.checked_lines(records.read_lines(spark, str(tmp_path / "mixed")), JOB_POSTING)
    records.split_lines(checked, str(tmp_path / "good"), str(tmp_path / "bad"))
    good, bad = spark.read.parquet(str(tmp_path / "good")), spark.read.parquet(str(tmp_path / "bad"))
    want = records.read_records(spark, str(tmp_path / "clean.jsonl"), JOB_POSTING)
    assert sorted(map(str, good.select("posting", "labels").collect())) == sorted(map(str, want.collect()))
    assert sorted(r.value for r in bad.collect()) == sorted([GOOD + " tail", "{'posting': 1}"])
    assert good.select("row_id").union(bad.select("row_id")).distinct().count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_random_damage_is_found_as_python_finds_it(spark, seed):
    import random

    rng = random.Random(seed)
    texts = []
    for i in range(300):
        line = rng.choice([GOOD, json.dumps({"posting": "Night", "labels": NURSE}), _with(required_skills=["a", "b"])])
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(line))
            line = rng.choice([line[:at] + line[at + 1:], line[:at] + rng.choice('{}[]",: x1') + line[at:], line[:at] + line[at + 3:]])
        texts.append((str(i), line))

    def refuse(_):
        raise ValueError

    def reason(line):
        try:
            record = json.loads(line.strip(" \t\r\n"), parse_constant=refuse)
        except ValueError:
            return {("", "not_json")}
        if not isinstance(record, dict):
            return {("", "not_json")}
        found = {(k, "extra") for k in record if k not in ("posting", "labels")}
        for k, kind in (("posting", str), ("labels", dict)):
            if k not in record:
                found.add((k, "missing"))
            elif record[k] is None:
                found.add((k, "null"))
            elif not isinstance(record[k], kind):
                found.add((k, "type"))
        inner = record.get("labels")
        if isinstance(inner, dict):
            found |= {(k, "extra") for k in inner if k not in NAMES}
            for f in JOB_POSTING.fields:
                v = inner.get(f.name)
                number = isinstance(v, (int, float)) and not isinstance(v, bool)
                fits = (isinstance(v, list) and all(isinstance(x, str) for x in v) if f.kind == LIST
                        else number if f.kind == NUMBER else isinstance(v, str))
                if f.name not in inner:
                    found.add((f.name, "missing"))
                elif v is None:
                    found |= set() if f.nullable else {(f.name, "null")}
                elif not fits:
                    found.add((f.name, "type"))
                elif f.domain and v not in f.domain:
                    found.add((f.name, "enum"))
        return found

    got = {r.row_id: {(b.field, b.violation) for b in r.breaches} for r in _checked(spark, texts).collect()}
    assert got == {k: reason(v) for k, v in texts}
    assert {bool(v) for v in got.values()} == {True, False}


def test_each_line_is_parsed_once(spark):
    lines = spark.range(3).selectExpr("cast(id AS string) AS row_id", "concat('{\"posting\": ', id, '}') AS value")
    plan = parse.checked_lines(lines, JOB_POSTING)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
