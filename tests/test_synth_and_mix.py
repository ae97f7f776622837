from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanframe.functions import draws as D
from gleanframe.operators import mix, synth
from gleanframe.operators.parse import validate_schema
from gleanframe.functions.json_text import labels_json
from gleanframe.spec import JOB_POSTING
from tests.jobs import gold_frame, labels

P = synth.JOB_POOLS
N = 20_000


@pytest.fixture(scope="module")
def rows(spark):
    return [r.labels for r in synth.sample_label_rows(spark, N, 7).collect()]


def share(rows, test):
    return sum(map(bool, map(test, rows))) / len(rows)


def near(value, want):
    """Within five standard deviations of a binomial share."""
    return abs(value - want) < 5 * (want * (1 - want) / N) ** 0.5 + 1e-9


def test_draws_are_uniform_and_stable(spark):
    df = spark.range(100_000)
    drawn = df.select("id", F.expr(D.uniform(1, "id", "x")).alias("u"))
    bins = Counter(r.b for r in drawn.select(F.floor(F.col("u") * 10).alias("b")).collect())
    assert set(bins) == set(range(10)) and all(9500 < n < 10500 for n in bins.values())
    moved = df.repartition(7).select("id", F.expr(D.uniform(1, "id", "x")).alias("u"))
    assert drawn.exceptAll(moved).count() == 0


def test_draws_of_one_row_differ(spark):
    names = [f"n{i}" for i in range(9)]
    row = D.with_draws(spark.range(1), 1, "id", names).first()
    assert len({row[f"u_{n}"] for n in names}) == 9


def test_default_is_a_hundred_records(spark):
    assert synth.sample_label_rows(spark).count() == 100


def test_same_records_on_any_partitioning(spark):
    a = synth.sample_labels(spark.range(500).coalesce(1), "id", 1)
    b = synth.sample_labels(spark.range(500).repartition(9), "id", 1)
    assert a.exceptAll(b).count() == 0 and a.count() == 500


def test_weights(rows):
    weights = P.seniority_weights
    for s, w in weights.items():
        assert near(share(rows, lambda r: r.seniority == s), w / sum(weights.values())), s
    for v, w in P.workplace_weights:
        assert near(share(rows, lambda r: r.workplace_type == v), w / 10), v
    adults = [r for r in rows if r.seniority != "intern"]
    assert near(share(adults, lambda r: r.employment_type == "full_time"), 8 / 12)
    assert {r.employment_type for r in adults} == {"full_time", "part_time", "contract", "temporary"}
    assert near(share(rows, lambda r: r.education is None), 3 / 7)
    assert {r.company for r in rows} == set(P.companies)


def test_titles_years_and_interns(rows):
    for r in rows:
        assert r.min_years_experience in P.years[r.seniority]
        if r.seniority == "intern":
            assert r.employment_type == "internship"
        if r.seniority in P.titles_without_role:
            assert r.title == P.seniority_titles[r.seniority]
        else:
            role = r.title.removeprefix(P.seniority_titles[r.seniority]).strip()
            assert role in P.roles and (r.seniority != "mid" or r.title == role)


def test_null_masks(rows):
    hidden = [r for r in rows if r.workplace_type is None]
    assert all(r.location for r in rows if r.workplace_type is not None)
    assert near(share(hidden, lambda r: r.location is None) , 0.4) or len(hidden) < N / 2
    assert abs(share(hidden, lambda r: r.location is None) - 0.4) < 0.06
    paid = [r for r in rows if r.salary_currency]
    assert near(len(paid) / N, 0.7)
    assert all(r.salary_min is r.salary_max is r.salary_period is None for r in rows if not r.salary_currency)
    assert abs(share(paid, lambda r: r.salary_max is None) - 0.15) < 0.02
    assert abs(share(paid, lambda r: r.salary_min is None) - 0.10) < 0.02


@pytest.mark.parametrize("period,lows,gaps,weight", [
    ("year", range(60, 180, 5), range(15, 60, 5), 6),
    ("month", range(4, 14), range(1, 4), 1),
    ("hour", range(25, 80, 5), range(10, 40, 5), 2),
])
def test_number_grids(rows, period, lows, gaps, weight):
    unit = 1 if period == "hour" else 1000
    paid = [r for r in rows if r.salary_period == period]
    assert {r.salary_min for r in paid if r.salary_min is not None} == {v * unit for v in lows}
    both = [r for r in paid if r.salary_min is not None and r.salary_max is not None]
    assert {r.salary_max - r.salary_min for r in both} == {v * unit for v in gaps}
    assert abs(len(paid) / sum(r.salary_period is not None for r in rows) - weight / 9) < 0.02


def test_skills_are_a_shuffled_prefix(rows):
    sizes = Counter()
    firsts = Counter()
    for r in rows:
        both = r.required_skills + r.preferred_skills
        assert len(set(both)) == len(both) and 2 <= len(r.required_skills) <= 5
        assert any(set(both) <= set(pool) for pool in P.roles.values())
        sizes[len(r.preferred_skills)] += 1
        if r.title.endswith("Backend Engineer"):
            firsts[r.required_skills[0]] += 1
    assert set(sizes) == {0, 1, 2, 3}
    assert set(firsts) == set(P.roles["Backend Engineer"])
    assert max(firsts.values()) < 1.6 * min(firsts.values())


def test_sampled_records_fit_the_schema(spark):
    text = synth.sample_label_rows(spark, 500).selectExpr(
        "'s' AS run", "row_id", f"{labels_json(JOB_POSTING)} AS raw_text")
    assert validate_schema(text, JOB_POSTING).count() == 0


def test_teacher_tables(spark):
    sampled = synth.sample_label_rows(spark, 4)
    req = {r.row_id: r.messages for r in synth.teacher_requests(sampled, "Write it.").collect()}
    assert [m.role for m in req[0]] == ["system", "user"] and req[0][0].content == "Write it."
    replies = spark.createDataFrame([(0, "\n Come work. \t"), (2, "Join")], "row_id long, raw_text string")
    got = {r.row_id: r for r in synth.attach_postings(sampled, replies).collect()}
    assert {k: (v.posting, v.status) for k, v in got.items()} == {
        0: ("Come work.", "ok"), 1: (None, "missing"), 2: ("Join", "ok"), 3: (None, "missing")}
    more = replies.unionByName(spark.createDataFrame(
        [(1, "\u00a0\u3000Nimm\u2028"), (2, "Again"), (3, None)], "row_id long, raw_text string"))
    got = {r.row_id: (r.posting, r.status) for r in synth.attach_postings(sampled, more).collect()}
    assert got == {0: ("Come work.", "ok"), 1: ("Nimm", "ok"), 2: (None, "several"), 3: (None, "missing")}
    assert all((chr(c).isspace()) == (chr(c) in synth.BLANKS) for c in range(0x11000))


def test_mix(spark):
    hand = spark.range(3).withColumnRenamed("id", "row_id")
    made = spark.range(10, 15).withColumnRenamed("id", "row_id")
    assert mix.mix(hand, made, "hand").count() == 3
    assert mix.mix(hand, hand, "mixed").count() == 6
    counts = {r["mode"]: r.train_rows for r in mix.mix_counts(mix.mix_table(hand, made)).collect()}
    assert counts == {"hand": 3, "synthetic": 5, "mixed": 8}
    with pytest.raises(ValueError):
        mix.mix(hand, made, "both")


def test_synthetic_rows_stay_out_of_evaluation(spark):
    hand = spark.createDataFrame([(1, "test", "One  text"), (2, "val", "Two"), (3, "train", "Three")],
                                 "row_id long, split string, text string")
    made = spark.createDataFrame([(10, "four"), (11, "five"), (12, None)], "row_id long, text string")
    rows = mix.experiment_rows(hand, made)
    assert mix.eval_purity(rows).count() == 0
    copied = spark.createDataFrame([(13, "train", "one text ", "synthetic"), (14, "train", "THREE", "synthetic"),
                                    (15, "val", "new", "synthetic")], rows.schema)
    assert {r.row_id for r in mix.eval_purity(rows.unionByName(copied)).collect()} == {13, 15}


def test_coverage_shows_what_never_occurs(spark, rows):
    sampled = synth.sample_label_rows(spark, 2000, 7)
    got = {(r.field, r.value): r.n_rows for r in synth.coverage_audit(sampled).collect()}
    assert got["salary_period", "week"] == got["salary_period", "day"] == 0 < got["salary_period", None]
    assert sum(n for (f, _), n in got.items() if f == "seniority") == 2000


def test_grounding_is_literal(spark):
    facts = gold_frame(spark, [("1", "NIGHT nurse at 31.5 an hour, knows cpr", labels(
        title="Night Nurse", salary_min=31.5, salary_max=40.0, required_skills=["CPR", "Triage", None])), ("2", None, labels())])
    got = {(r.row_id, r.field): (r.n_stated, r.n_found) for r in synth.grounding(facts).collect()}
    stated = {k: v for k, v in got.items() if v[0]}
    assert stated == {("1", "title"): (1, 1), ("1", "salary_min"): (1, 1), ("1", "salary_max"): (1, 0),
                      ("1", "required_skills"): (2, 1)}
    # Closed fields that are null are searched for; open ones only with values to look for.
    closed = {f.name for f in JOB_POSTING.fields if f.domain}
    assert set(got) - set(stated) == {(i, f) for i in "12" for f in closed}


def test_draws_of_other_names_are_independent(spark):
    one = D.with_draws(spark.range(5000), 42, "id", ["a", "b"])
    two = D.with_draws(spark.range(5000), 42, "id", ["b", "c"]).withColumnRenamed("u_b", "v_b")
    r = one.join(two, "id").agg(F.corr("u_a", "u_b"), F.corr("u_a", "u_c"), F.corr("u_b", "v_b")).first()
    assert abs(r[0]) < 0.06 and abs(r[1]) < 0.06 and r[2] > 0.999
