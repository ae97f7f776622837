import pytest
from pyspark.sql import functions as F

from gleanframe.operators.score import answer_check
from gleanframe.plans import reports
from gleanframe.spec import JOB_POSTING
from tests.jobs import gold_frame, labels, preds_frame, runs_frame

COLUMNS = ("run string, n_rows long, valid_rows long, scalar_correct long, list_f1_sum double, "
           "scalar_total long, list_count long, json_valid double, field_acc double, skills_f1 double")
RUNS = ("run string, comparison string, model string, prompt string, train_rows long, source string, "
        "epochs int")


def metrics_frame(spark, **correct):
    """Three gold rows of 12 fields and 2 lists; `correct` right fields per run."""
    rows = [(run, 3, 3, c, 3.0, 36, 6, 1.0, c / 36, 0.5) for run, c in correct.items()]
    return spark.createDataFrame(rows, COLUMNS)


def runs(spark, *rows):
    return spark.createDataFrame(rows, RUNS)


def test_report_rounds_to_whole_percents(spark):
    row, = reports.metrics_report(metrics_frame(spark, a=31)).collect()
    assert (row.json_valid_rows, row.n_rows, row.json_valid_pct) == (3, 3, 100)
    assert (row.fields_correct, row.fields_total, row.field_acc_pct, row.skills_f1) == (31, 36, 86, 0.5)


def test_grid_and_win_condition(spark):
    m = metrics_frame(spark, bz=10, bf=20, tz=20, tf=18)
    cfg = runs(spark, ("bz", "prompting", "base", "zero", 0, None, 0),
               ("bf", "prompting", "base", "few", 0, None, 0),
               ("tz", "prompting", "tuned", "zero", 14, "hand", 5),
               ("tf", "prompting", "tuned", "few", 14, "hand", 5))
    grid = {r.prompt: r for r in reports.compare_runs(m, cfg).collect()}
    assert grid["zero"].base_field_acc == 10 / 36 and grid["few"].tuned_field_acc == 0.5
    won = {r.metric: r for r in reports.win_condition(m, "tz", "bf").collect()}
    assert won["field_acc"].met and won["field_acc"].delta == 0 and won["skills_f1"].met
    lost = {r.metric: r for r in reports.win_condition(m, "tf", "bf").collect()}
    assert not lost["field_acc"].met and lost["field_acc"].delta == pytest.approx(-2 / 36)


def test_ablation_gain_follows_size(spark):
    m = metrics_frame(spark, n14=30, n5=18, n10=27)
    cfg = runs(spark, *[(f"n{n}", "size", "tuned", "zero", n, "hand", 5) for n in (10, 14, 5)])
    got = sorted((r.train_rows, r.field_acc, r.field_acc_gain)
                 for r in reports.ablation_table(m, cfg).collect())
    assert got[0] == (5, 0.5, None)
    assert [round(g[2], 9) for g in got[1:]] == [0.25, round(3 / 36, 9)]


def test_source_table_counts_rows(spark):
    m = metrics_frame(spark, h=30, s=27, x=31)
    cfg = runs(spark, ("h", "source", "tuned", "zero", 14, "hand", 3),
               ("s", "source", "tuned", "zero", 100, "synthetic", 3),
               ("x", "source", "tuned", "zero", 114, "mixed", 3))
    counts = spark.createDataFrame([("hand", 14), ("synthetic", 100), ("mixed", 114)],
                                   "mode string, train_rows long")
    got = {r.source: (r.train_rows, r.field_acc) for r in reports.source_table(m, cfg, counts).collect()}
    assert got == {"hand": (14, 30 / 36), "synthetic": (100, 0.75), "mixed": (114, 31 / 36)}


def test_one_field_is_below_noise(spark):
    m = metrics_frame(spark, a=32, b=31, c=30)
    cfg = runs(spark, *[(r, "prompting", r, "zero", 0, None, 0) for r in "abc"])
    got = {r.run: r for r in reports.resolution(m, cfg).collect()}
    assert got["a"].field_step == 1 / 36 and got["a"].slot_step == 1 / 6
    assert [(got[r].fields_behind, got[r].below_noise) for r in "abc"] == [
        (0, None), (1, True), (2, False)]


def test_slots_count_as_noise_too(spark):
    m = metrics_frame(spark, a=32, b=32).withColumn(
        "list_f1_sum", F.expr("CASE run WHEN 'a' THEN 6D ELSE 4.5D END"))
    cfg = runs(spark, *[(r, "prompting", r, "zero", 0, None, 0) for r in "ab"])
    got = {r.run: (r.fields_behind, r.slots_behind, r.below_noise) for r in reports.resolution(m, cfg).collect()}
    assert got == {"a": (0, 0.0, None), "b": (0, 1.5, False)}


def test_f1_ties_follow_the_binary_value(spark):
    values = [k / 40 for k in range(41)] + [1 / 3, 0.0, 0.995, 0.125, 0.375, 2 / 3, 1e-9]
    frame = spark.createDataFrame([(v,) for v in values], "x double").select("x", reports._two_digits("x").alias("y"))
    assert all(r.y == float(f"{r.x:.2f}") for r in frame.collect())


def test_repeated_and_stray_answers_show(spark):
    gold = gold_frame(spark, [("1", "", labels(title="A")), ("2", "", labels(title="B"))])
    preds = preds_frame(spark, [("a", "1", "{}"), ("a", "1", "{}"), ("a", "9", "{}"), ("b", "2", "{}"), ("c", "1", "{}")])
    got = {r.run: r[1:] for r in answer_check(gold, preds, runs_frame(spark, "a", "b", "d")).collect()}
    assert got == {"a": (3, 1, 1), "b": (1, 0, 0), "d": (0, 0, 0)}


def test_confounds(spark):
    m = metrics_frame(spark, a=10, b=20, c=10, d=20, e=1, f=2)
    cfg = runs(spark, ("a", "clean", "tuned", "zero", 5, "hand", 5), ("b", "clean", "tuned", "zero", 10, "hand", 5),
               ("c", "muddy", "tuned", "zero", 5, "hand", 5), ("d", "muddy", "tuned", "zero", 10, "hand", 3),
               ("e", "null", "base", "zero", 0, None, 0), ("f", "null", "tuned", "zero", 0, "hand", 0))
    got = {r.comparison: (r.differing_knobs, r.confounded, round(r.field_acc_spread, 6))
           for r in reports.confound_check(m, cfg, ("model", "prompt", "train_rows", "source", "epochs")).collect()}
    assert got == {"clean": ("train_rows", False, round(10 / 36, 6)),
                   "muddy": ("train_rows,epochs", True, round(10 / 36, 6)),
                   "null": ("model,source", True, round(1 / 36, 6))}


def test_confounds_by_pairs(spark):
    """Three epochs against five, in two comparisons: the pair tells which runs are muddied, and by what."""
    m = metrics_frame(spark, a=10, b=20, c=10, d=21)
    cfg = runs(spark, ("a", "size", "tuned", "zero", 14, "hand", 5), ("b", "source", "tuned", "zero", 14, "hand", 3),
               ("c", "source", "tuned", "zero", 100, "synthetic", 3), ("d", "prompting", "tuned", "zero", 14, "hand", 3),
               ("e", "prompting", "base", "zero", 0, None, 0))
    knobs = ("model", "prompt", "train_rows", "source", "epochs")
    got = {(r.run_a, r.run_b): (r.comparisons, r.differing_knobs, r.n_differing, round(r.field_acc_delta, 6), r.confounded)
           for r in reports.confound_pairs(m, cfg, knobs).collect()}
    assert got == {("a", "b"): ("size,source", "epochs", 1, round(10 / 36, 6), False),
                   ("a", "c"): ("size,source", "train_rows,source,epochs", 3, 0.0, True),
                   ("a", "d"): ("prompting,size", "epochs", 1, round(11 / 36, 6), False),
                   ("b", "c"): ("source", "train_rows,source", 2, -round(10 / 36, 6), True),
                   ("b", "d"): ("prompting,source", "", 0, round(1 / 36, 6), False),
                   ("c", "d"): ("prompting,source", "train_rows,source", 2, round(11 / 36, 6), True)}
    assert reports.confound_pairs(m, cfg.where("false"), knobs).count() == 0


def test_field_accuracy(spark):
    gold = gold_frame(spark, [("1", "", labels(title="A")), ("2", "", labels(title="B"))])
    preds = preds_frame(spark, [("a", "1", '{"title": "A"}'), ("a", "2", '{"title": "A"}')])
    got = {(r.run, r.field): r.accuracy for r in reports.field_accuracy(
        gold, preds, runs_frame(spark, "a", "b"), JOB_POSTING).collect()}
    assert got["a", "title"] == 0.5 and got["a", "company"] == 1.0 and got["a", "required_skills"] == 1.0
    assert got["b", "title"] == 0.0 and len(got) == 28


def test_answering_nothing_has_a_floor(spark):
    """The empty object is right wherever the gold is silent."""
    gold = gold_frame(spark)
    preds = preds_frame(spark, [("a", "r1", "{}"), ("a", "r2", "{}")])
    m, = reports.run_metrics(gold, preds, runs_frame(spark, "a"), JOB_POSTING).collect()
    silent = gold.selectExpr("cast(isnull(labels.title) AS int) + " + " + ".join(
        f"cast(isnull(labels.{f.name}) AS int)" for f in JOB_POSTING.scalars if f.name != "title")
        + " AS n").groupBy().sum("n").first()[0]
    assert m.scalar_correct == silent and m.json_valid == 1.0
