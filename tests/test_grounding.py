"""both halves, by whole words, against plain Python."""

import random
import re

import pytest

from gleanframe.operators import synth
from gleanframe.spec import JOB_POSTING, LIST
from tests.jobs import gold_frame, labels


def tokens(text):
    found = re.findall(r"[0-9]+(?:[.,][0-9]+)+|[^\W_]+(?:[+#]|[^\W_])*|[+#](?:[+#]|[^\W_])*", (text or "").lower())
    found = [t.replace(",", "") if re.fullmatch(r"[0-9]{1,3}(,[0-9]{3})+([.][0-9]+)?", t) else t for t in found]
    return [re.sub(r"[.]?0+$", "", t) if re.fullmatch(r"[0-9]+[.][0-9]+", t) else t for t in found]


def stands(value, words):
    v = tokens(value)
    return bool(v) and any(words[i:i + len(v)] == v for i in range(len(words)))


def found_in(spark, text, known=None, **stated):
    rows = synth.grounding(gold_frame(spark, [("1", text, labels(**stated))]), known=known).collect()
    return {r.field: (r.n_stated, r.n_found, r.n_mentioned) for r in rows}


CASES = [
    ("We use Google tools", {"required_skills": ["Go"]}, "required_skills", (1, 0, 0)),
    ("We use Go, tools", {"required_skills": ["Go"]}, "required_skills", (1, 1, 0)),
    ("15 people", {"min_years_experience": 5.0}, "min_years_experience", (1, 0, 0)),
    ("5+ years", {"min_years_experience": 5.0}, "min_years_experience", (1, 0, 0)),
    ("5 years", {"min_years_experience": 5.0}, "min_years_experience", (1, 1, 0)),
    ("pays $160,000.00 a year", {"salary_max": 160000.0}, "salary_max", (1, 1, 0)),
    ("pays 1160,000", {"salary_max": 160000.0}, "salary_max", (1, 0, 0)),
    ("31.50/h", {"salary_min": 31.5}, "salary_min", (1, 1, 0)),
    ("C++ and C# or CI / CD", {"required_skills": ["C", "C++", "c#", "CI/CD"]}, "required_skills", (4, 3, 0)),
    ("a FULL-TIME role", {"employment_type": "full_time"}, "employment_type", (1, 1, 0)),
    ("a full moon, time", {"employment_type": "full_time"}, "employment_type", (1, 0, 0)),
    ("twice the same", {"required_skills": ["Same", "same", None, "..."]}, "required_skills", (2, 1, 0)),
    ("one two three four five six seven eight", {"education": "two three four five six seven eight"}, "education", (1, 1, 0)),
    ("one two three four five six seven eights", {"education": "two three four five six seven eight"}, "education", (1, 0, 0)),
    ("work Remote or hybrid, not remotely", {}, "workplace_type", (0, 0, 2)),
    ("day by day, yearly", {}, "salary_period", (0, 0, 1)),
    (None, {}, "seniority", (0, 0, 0)),
]


@pytest.mark.parametrize("text, stated, field, want", CASES)
def test_by_hand(spark, text, stated, field, want):
    assert found_in(spark, text, **stated)[field] == want


def test_open_fields_need_values_to_look_for(spark):
    assert "company" not in found_in(spark, "Acme Cloud hires")
    known = {"company": ["Acme Cloud", "Cloud hire", "Quill"], "preferred_skills": ["Go", "SQL"], "min_years_experience": ["5", "7"]}
    got = found_in(spark, "Acme Cloud hires: 7 years of SQL", known)
    assert (got["company"], got["preferred_skills"], got["min_years_experience"]) == ((0, 0, 1), (0, 0, 1), (0, 0, 1))


def test_random_texts_against_plain_python(spark):
    rng = random.Random(4)
    words = ["Go", "Google", "full-time", "full", "time", "remote", "10,000", "10.50", "10.5", "5", "15", "é", "C++", "year", "/", "day.", "Acme"]
    known = {"company": ["Acme", "Go time"], "preferred_skills": ["C++", "full time remote"]}
    records = []
    for i in range(150):
        pick = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 3)))       # noqa: E731
        stated = {"title": pick(), "company": rng.choice([None, pick()]), "salary_min": rng.choice([None, 5.0, 10.5, 10000.0]),
                  "salary_period": rng.choice([None, "year", "day"]), "required_skills": [pick() for _ in range(rng.randrange(3))],
                  "preferred_skills": [pick() for _ in range(rng.randrange(2))]}
        records.append((str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(30))), labels(**stated)))
    want = {}
    for i, text, stated in records:
        line = tokens(text)
        for f in JOB_POSTING.fields:
            v = stated[f.name]
            items = (v or []) if f.kind == LIST else [] if v is None else [str(int(v)) if isinstance(v, float) and v == int(v) else str(v)]
            phrases = {" ".join(tokens(x)) for x in items}
            asked = list(f.domain) or known.get(f.name, [])
            if phrases:
                want[i, f.name] = (len(phrases), sum(stands(p, line) for p in phrases), 0)
            elif asked:
                want[i, f.name] = (0, 0, sum(stands(x, line) for x in asked))
    frame = gold_frame(spark, records)
    got = {(r.row_id, r.field): (r.n_stated, r.n_found, r.n_mentioned) for r in synth.grounding(frame, known=known, longest=2).collect()}
    assert got == want
    audit = {r.field: r for r in synth.grounding_audit(frame, known=known).collect()}
    for field, r in audit.items():
        mine = [v for (_, f), v in want.items() if f == field]
        assert r.n_rows == sum(v[0] > 0 for v in mine) and r.n_found == sum(v[1] for v in mine)
        assert r.n_null == sum(v[0] == 0 for v in mine) and r.n_null_mentioned == sum(v[2] > 0 for v in mine)


def test_the_text_is_cut_once(spark):
    plan = synth.grounding(gold_frame(spark))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lower(coalesce(posting") == 1


def test_phrases_of_a_text_are_made_for_long_lists_only(spark):
    """few values are searched in the line; the two ways find the same, and nothing is found in no text."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    line = [rng.choice(words[:150]) for _ in range(200)]
    for n in (synth._SEARCHED - 20, synth._SEARCHED + 80):
        items = words[:n] + ["...", f"{line[3]} {line[4]}", " ".join(line[20:29]), "w1 w1 w1 w1"]
        want = sum(stands(v, line) for v in items)
        assert found_in(spark, " ".join(line), required_skills=items)["required_skills"] == (n + 4, want, 0)
        assert found_in(spark, "", required_skills=items)["required_skills"] == (n + 4, 0, 0)
    plan = synth.grounding(gold_frame(spark))._jdf.queryExecution().analyzed().toString()
    assert "> 64" in plan and plan.count("regexp_extract_all") == 1 + len(JOB_POSTING.fields)
