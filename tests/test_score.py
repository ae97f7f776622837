import json
import random

import pytest

from gleanframe.functions.json_text import labels_json
from gleanframe.operators.score import compare_fields, failures, score_rows
from gleanframe.plans import reports
from gleanframe.spec import JOB_POSTING, LIST, NUMBER
from tests.jobs import EMPTY, NURSE, gold_frame, labels, preds_frame, runs_frame

SCALARS = [f.name for f in JOB_POSTING.scalars]
LISTS = [f.name for f in JOB_POSTING.lists]

# field, predicted JSON (None = left out), gold, right
SCALAR_CASES = [
    ("title", None, None, True), ("title", "null", None, True),
    ("title", None, "x", False), ("title", "null", "x", False),
    ("title", '"X"', "x", False), ("title", '"x"', "x", True),
    ("title", '"\\u00e9"', "é", True), ("title", '""', "", True), ("title", '""', None, False),
    ("salary_min", "160000", 160000.0, True), ("salary_min", "160000.0", 160000.0, True),
    ("salary_min", "1.6e5", 160000.0, True), ("salary_min", '"160000"', 160000.0, False),
    ("salary_min", '"160000"', None, False), ("salary_min", "160001", 160000.0, False),
    ("title", "5", "5", False), ("title", "true", "true", False),
    ("salary_min", "true", 1.0, True), ("salary_min", "false", 0.0, True),
    ("salary_min", "true", None, False),
    ("title", "[1]", None, False), ("title", '{"z":1}', None, False),
    ("title", "[1]", "[1]", False), ("salary_min", "[]", 0.0, False),
    ("salary_min", "0", None, False), ("salary_min", "-0", 0.0, True),
    ("salary_min", "123456789012345678901234567890", None, False),
]

LIST_CASES = [
    ("[]", [], 1.0), ("null", [], 1.0), (None, [], 1.0),
    ('["Go"]', [], 0.0), ("[]", ["Go"], 0.0), (None, ["Go"], 0.0),
    ('["go","GO"]', ["Go"], 1.0), ('["Go","SQL"]', ["Go"], 2 / 3), ('["a","b"]', ["c"], 0.0),
    ('"Go"', ["Go"], 0.0), ('"Go"', [], 1.0), ('["Go",null,1]', ["Go", "1"], 1.0), ("7", [], 1.0),
    ('["ÉTÉ"]', ["été"], 1.0), ('[[1],{"a":2}]', ["[1]", '{"a":2}'], 1.0),
]


def one_field(field, text):
    return "{" + (f'"{field}": {text}' if text is not None else "") + "}"


def test_scalar_cases(spark):
    gold = gold_frame(spark, [(str(i), "", labels(**{f: g}))
                              for i, (f, _, g, _) in enumerate(SCALAR_CASES)])
    preds = preds_frame(spark, [("a", str(i), one_field(f, t))
                                for i, (f, t, _, _) in enumerate(SCALAR_CASES)])
    got = {r.row_id: r for r in compare_fields(gold, preds, JOB_POSTING).collect()}
    for i, (field, text, value, right) in enumerate(SCALAR_CASES):
        assert got[str(i)][f"ok_{field}"] is right, (field, text, value)


def test_list_cases(spark):
    name = LISTS[0]
    gold = gold_frame(spark, [(str(i), "", labels(**{name: g})) for i, (_, g, _) in enumerate(LIST_CASES)])
    preds = preds_frame(spark, [("a", str(i), one_field(name, t)) for i, (t, _, _) in enumerate(LIST_CASES)])
    got = {r.row_id: r for r in compare_fields(gold, preds, JOB_POSTING).collect()}
    for i, (text, want, f1) in enumerate(LIST_CASES):
        assert got[str(i)][f"f1_{name}"] == pytest.approx(f1), (text, want)


def five(r):
    return r.json_valid, r.scalar_correct, r.scalar_total, r.list_f1_sum, r.list_count


def test_row_cases(spark):
    nine_nulls = labels(title="A", workplace_type="remote", employment_type="contract",
                        required_skills=["x", "y"])
    gold = gold_frame(spark, [("n", "", nine_nulls), ("full", "", NURSE)])
    self_text = gold.where("row_id = 'full'").selectExpr(f"{labels_json(JOB_POSTING)} AS t").first().t
    preds = preds_frame(spark, [
        ("empty", "n", "{}"), ("bad", "n", "sorry"), ("self", "full", self_text),
        ("stray", "nobody", "{}"), ("unlisted", "n", "{}")])
    runs = runs_frame(spark, "empty", "bad", "self", "stray")
    got = {(r.run, r.row_id): five(r) for r in score_rows(gold, preds, runs, JOB_POSTING).collect()}
    assert len(got) == 8
    assert got["empty", "n"] == (1, 9, 12, 1.0, 2)
    assert got["self", "full"] == (1, 12, 12, 2.0, 2)
    for key in [("bad", "n"), ("bad", "full"), ("stray", "n"), ("empty", "full"), ("self", "n")]:
        assert got[key] == (0, 0, 12, 0.0, 2), key


def test_run_without_rows_gives_nulls(spark):
    gold = gold_frame(spark, []).limit(0)
    preds = preds_frame(spark, [("a", "x", "{}")])
    row, = reports.run_metrics(gold, preds, runs_frame(spark, "a"), JOB_POSTING).collect()
    assert (row.n_rows, row.json_valid, row.field_acc, row.skills_f1) == (0, None, None, None)


def test_run_without_answers_scores_zero(spark):
    preds = preds_frame(spark, [("a", "r1", "{}"), ("a", "r2", "{}")])
    got = {r.run: r for r in reports.run_metrics(gold_frame(spark), preds, runs_frame(spark, "a", "b"),
                                                 JOB_POSTING).collect()}
    assert (got["b"].json_valid, got["b"].field_acc, got["b"].skills_f1) == (0.0, 0.0, 0.0)
    assert got["a"].json_valid == 1.0 and got["a"].field_acc == 14 / 24 and got["a"].skills_f1 == 0.25


# --- differential check against a plain-Python reading of the rules ---------------------------

def python_object(text):
    if text is None or "{" not in text or "}" not in text:
        return None
    try:
        return json.loads(text[text.index("{"):text.rindex("}") + 1],
                          parse_constant=lambda c: json.loads("broken"))
    except ValueError:
        return None


def python_items(value):
    if not isinstance(value, list):
        return frozenset()
    texts = [v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
             for v in value if v is not None]
    return frozenset(t.lower() for t in texts)


def python_score(text, gold):
    answer = python_object(text)
    if answer is None:
        return 0, 0, len(SCALARS), 0.0, len(LISTS)
    hits = [answer.get(n) == gold[n] for n in SCALARS]
    f1 = 0.0
    for n in LISTS:
        a, b = python_items(answer.get(n)), python_items(gold[n])
        f1 += 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
    return 1, sum(hits), len(SCALARS), f1, len(LISTS)


def random_value(rng, field, truth):
    word = lambda: rng.choice(["Go", "go", "SQL", "é", "É", "a\"b", "x{y}", "", "1", " ", "[q]"])
    if rng.random() < 0.5:
        return truth
    if field.kind == LIST:
        return rng.choice([[word() for _ in range(rng.randrange(4))], None, [1, None, word()],
                           [[1], {"k": "v"}], word(), True, 3, {}])
    if field.kind == NUMBER:
        return rng.choice([None, 1, 1.0, 0, True, False, "1", 2.5, [], {}, 10**25, -3])
    return rng.choice([None, word(), word(), 5, True, ["x"], {"a": None}, 1.5])


def random_text(rng, gold):
    obj = {}
    for f in JOB_POSTING.fields:
        if rng.random() < 0.85:
            obj[f.name] = random_value(rng, f, gold[f.name])
    if rng.random() < 0.1:
        obj["extra"] = {"deep": [1, {"x": "}"}]}
    body = json.dumps(obj, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
    shape = rng.randrange(12)
    return [body, body, body, f"```json\n{body}\n```", f"Here you go: {body} hope it helps",
            body[:rng.randrange(len(body))], body + ' {"a": 1}', body + "]" + body, body + "}",
            body.replace('"', "'"), "I cannot do that.", body.replace(": ", ":,", 1)][shape]


def random_gold(rng):
    out = {}
    for f in JOB_POSTING.fields:
        if f.kind == LIST:
            out[f.name] = [rng.choice(["Go", "SQL", "é", "1"]) for _ in range(rng.randrange(3))]
        elif f.kind == NUMBER:
            out[f.name] = rng.choice([None, 1.0, 0.0, 2.5, 160000.0])
        else:
            out[f.name] = rng.choice([None, "Go", "é", "1", ""])
    return out


def test_random_answers_agree_with_python(spark):
    rng = random.Random(3)
    golds = [(str(i), "", random_gold(rng)) for i in range(400)]
    rows = [(run, i, random_text(rng, g)) for i, _, g in golds for run in ("a", "b", "c")]
    preds = preds_frame(spark, rows)
    runs = runs_frame(spark, "a", "b", "c")
    truth = {i: g for i, _, g in golds}
    got = {(r.run, r.row_id): five(r)
           for r in score_rows(gold_frame(spark, golds), preds, runs, JOB_POSTING).collect()}
    assert len(got) == len(rows)
    n_valid = 0
    for run, i, text in rows:
        want = python_score(text, truth[i])
        n_valid += want[0]
        mine = got[run, i]
        assert mine[:3] == want[:3] and mine[4] == want[4], (text, truth[i])
        assert mine[3] == pytest.approx(want[3]), (text, truth[i])
    assert 300 < n_valid < 1000


def test_metrics_are_sums_of_row_scores(spark):
    rng = random.Random(4)
    golds = [(str(i), "", random_gold(rng)) for i in range(60)]
    rows = [("a", i, random_text(rng, g)) for i, _, g in golds[:45]]
    gold, preds, runs = gold_frame(spark, golds), preds_frame(spark, rows), runs_frame(spark, "a")
    scores = [five(r) for r in score_rows(gold, preds, runs, JOB_POSTING).collect()]
    m, = reports.run_metrics(gold, preds, runs, JOB_POSTING).collect()
    assert len(scores) == 60
    assert m.json_valid == sum(s[0] for s in scores) / 60
    assert m.field_acc == sum(s[1] for s in scores) / sum(s[2] for s in scores)
    assert m.skills_f1 == pytest.approx(sum(s[3] for s in scores) / sum(s[4] for s in scores))


def test_hot_run_and_stray_answers_lose_nothing(spark):
    """Most answers belong to one run, and a third of them to an id that gold lacks."""
    gold = gold_frame(spark, [(str(i), "", labels(title="A")) for i in range(50)])
    hot = spark.range(50_000).selectExpr("'hot' AS run", "'nobody' AS row_id", "'{}' AS raw_text")
    kept = preds_frame(spark, [("hot", str(i), '{"title": "A"}') for i in range(50)]
                       + [("cold", "7", '{"title": "B"}')])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        runs = runs_frame(spark, "hot", "cold")
        rows = score_rows(gold, kept.unionByName(hot), runs, JOB_POSTING).collect()
        m = {r.run: r for r in reports.run_metrics(gold, kept.unionByName(hot), runs, JOB_POSTING).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(rows) == 100 and sum(r.json_valid for r in rows) == 51
    assert (m["hot"].field_acc, m["hot"].n_rows) == (1.0, 50)
    assert (m["cold"].valid_rows, m["cold"].scalar_correct) == (1, 11)


def test_failures_name_field_and_values(spark):
    gold = gold_frame(spark)
    preds = preds_frame(spark, [
        ("a", "r1", '{"title": "Night Nurse", "salary_min": "31.5"}'), ("a", "r2", "no")])
    got = {(r.row_id, r.field): (r.predicted, r.gold) for r in failures(gold, preds, JOB_POSTING).collect()}
    assert got["r2", ""] == (None, None)
    assert got["r1", "salary_min"] == ('"31.5"', "31.5")
    assert got["r1", "company"] == (None, '"Ward Seven"')
    assert got["r1", "required_skills"] == (None, '["Triage", "CPR"]')
    wrong = {f for (i, f) in got if i == "r1"}
    right = {f.name for f in JOB_POSTING.fields if NURSE[f.name] == EMPTY[f.name]} | {"title"}
    assert wrong == {f.name for f in JOB_POSTING.fields} - right


def test_top_failures_keeps_k_per_group_under_skew(spark):
    gold = gold_frame(spark, [(f"{i:05d}", "", labels(title="A")) for i in range(900)])
    rows = [("big", f"{i:05d}", '{"title": "B"}') for i in range(900)]
    rows += [("small", f"{i:05d}", '{"title": "B"}') for i in range(2)]
    top = reports.top_failures(gold, preds_frame(spark, rows), JOB_POSTING, 3)
    got = sorted((r.run, r.field, r.place, r.row_id) for r in top.collect())
    assert got == [("big", "title", i + 1, f"{i:05d}") for i in range(3)] + \
                  [("small", "title", i + 1, f"{i:05d}") for i in range(2)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
