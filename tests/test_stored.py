"""E3 and E4 over tables bucketed by row: the same results, no shuffle by row; one a side without buckets."""

import re

import pytest

from checks import testbed as B
from gleanframe.operators import score
from gleanframe.plans import reports
from gleanframe.sources import stored


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """(gold, answers, runs) plain and bucketed; one gold row has no answer at all, one run none."""
    path = tmp_path_factory.mktemp("stored")
    gold = B.doc_gold(spark, sf_dir).select("row_id", "labels")
    least = gold.agg({"row_id": "min"}).first()[0]
    preds = B.doc_preds(gold).where(f"run <> 'size_5' AND row_id <> {least}")
    gold.write.parquet(str(path / "gold"))
    preds.write.parquet(str(path / "preds"))
    gold, preds = spark.read.parquet(str(path / "gold")), spark.read.parquet(str(path / "preds"))
    buckets = [stored.store_gold(gold, "test_gold", 4, str(path / "bg")), stored.store_answers(preds, "test_answers", 4, str(path / "bp"))]
    runs = B.run_config(spark)
    yield (gold, preds, runs), (*buckets, runs)
    spark.sql("DROP TABLE test_gold")
    spark.sql("DROP TABLE test_answers")


def by_row(df):
    return len(re.findall(r"Exchange hashpartitioning\(row_id", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_scores_are_the_same(spark, tables):
    plain, bucketed = ([tuple(r) for r in score.score_rows(*t, B.DOC_SPEC).orderBy("run", "row_id").collect()] for t in tables)
    gold, _, runs = tables[0]
    assert plain == bucketed and len(plain) == gold.count() * runs.count()
    assert len({r[:2] for r in plain}) == len(plain)
    assert all(r[2:5] == (0, 0, len(B.DOC_SPEC.scalars)) for r in plain if r[0] == "size_5")


def test_metrics_are_the_sums_of_row_scores(spark, tables):
    rows = score.score_rows(*tables[1], B.DOC_SPEC).groupBy("run").sum("json_valid", "scalar_correct", "scalar_total").collect()
    for t in tables:
        got = {(r.run, r.valid_rows, r.scalar_correct, r.scalar_total) for r in reports.run_metrics(*t, B.DOC_SPEC).collect()}
        assert got == {tuple(r) for r in rows}


def test_no_shuffle_by_row_over_buckets(spark, tables, no_broadcast):
    plain, bucketed = tables
    assert by_row(score.score_rows(*plain, B.DOC_SPEC)) == 2          # answers once, gold once
    assert by_row(score.score_rows(*bucketed, B.DOC_SPEC)) == 0
    assert by_row(reports.run_metrics(*plain, B.DOC_SPEC)) == 2
    assert by_row(reports.run_metrics(*bucketed, B.DOC_SPEC)) == 0
    for df in (score.score_rows(*plain, B.DOC_SPEC), score.score_rows(*bucketed, B.DOC_SPEC)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for below in re.findall(r"Exchange hashpartitioning\(row_id.*\n(.*)", plan):
            assert "raw_text" not in below and " AS object" not in below


def test_runs_that_are_not_asked_for_are_not_read(spark, tables):
    gold, preds, runs = tables[1]
    df = score.score_rows(gold, preds, runs.where("run = 'tuned_zero'"), B.DOC_SPEC)
    assert "PartitionFilters" in df._jdf.queryExecution().executedPlan().toString()
    assert {r.run for r in df.select("run").distinct().collect()} == {"tuned_zero"}


def test_repeated_answers_stay(spark):
    gold = spark.createDataFrame([(1, ("en", "s", 1.0, None, None, None, [], []))], "row_id long, labels " + B.DOC_SPEC.labels_type().simpleString())
    preds = spark.createDataFrame([("a", 1, '{"lang": "en"}'), ("a", 1, None), ("b", 9, "{}")], "run string, row_id long, raw_text string")
    runs = spark.createDataFrame([("a",), ("b",)], "run string")
    rows = sorted(tuple(r)[:3] for r in score.score_rows(gold, preds, runs, B.DOC_SPEC).collect())
    assert rows == [("a", 1, 0), ("a", 1, 1), ("b", 1, 0)]
