"""The physical plans are the ones meant for large tables."""

import re

import pytest

from checks import testbed as B
from checks.queries import QUERIES
from gleanframe.operators import score, split, synth
from gleanframe.plans import reports


def plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("a")])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups"):
        assert bad not in text, bad


def test_each_answer_is_parsed_once(spark, sf_dir):
    gold, preds = B.doc_gold(spark, sf_dir), B.doc_preds(B.doc_gold(spark, sf_dir))
    for df in (score.compare_fields(gold, preds, B.DOC_SPEC),
               score.failures(gold, preds, B.DOC_SPEC),
               reports.run_metrics(gold, preds, B.run_config(spark), B.DOC_SPEC)):
        assert plan(df, "optimizedPlan").count("parseJson") == 1


def test_scoring_stored_tables_shuffles_compact_columns(spark, sf_dir, tmp_path):
    B.doc_gold(spark, sf_dir).write.parquet(str(tmp_path / "gold"))
    B.doc_preds(B.doc_gold(spark, sf_dir)).write.parquet(str(tmp_path / "preds"))
    gold, preds = (spark.read.parquet(str(tmp_path / n)) for n in ("gold", "preds"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reports.run_metrics(gold, preds, B.run_config(spark), B.DOC_SPEC)
        text = plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(row_id") == 2
    assert text.count("SortMergeJoin [row_id") == 1
    # Scans read what scoring needs: no posting text from gold.
    assert "posting" not in text
    # Partial aggregation before the shuffle by run.
    assert re.search(r"Exchange hashpartitioning\(run.*\n.*partial_sum", text)
    # What lies right under the shuffles of the join are the typed columns.
    for below in re.findall(r"Exchange hashpartitioning\(row_id.*\n(.*)", text):
        columns = re.search(r"Project \[([^\n]*)\]", below).group(1)
        assert " AS p_lang" in columns or " AS g_lang" in columns
        assert "raw_text" not in columns and " AS object" not in columns


def test_split_moves_no_whole_rows(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents")
    df = split.split_exact(docs, "doc_id", 1, 10, 10)
    text = plan(df)
    main = [line for line in text.splitlines() if not re.match(r"\s*:", line)]
    assert any("FileScan" in line for line in main)
    assert not [line for line in main if "Exchange" in line or "Join" in line]
    assert text.count("Subquery subquery") == 2      # its use and its plan: found once
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert schemas.count("struct<doc_id:bigint>") >= 2
    assert sum("text" in s for s in schemas) == 1


def test_only_small_windows_are_global(spark, sf_dir):
    """A window without partition keys runs over the 65,536 prefix counts or ranked demos only."""
    docs = B.table(spark, sf_dir, "documents")
    text = plan(split.split_exact(docs, "doc_id", 1, 10, 10), "optimizedPlan")
    for line in text.splitlines():
        if "Window [" in line and "ROWS" not in line and "RowFrame" not in line:
            pytest.fail(line)


def test_sampling_is_one_narrow_stage(spark):
    text = plan(synth.sample_labels(spark.range(10), "id", 1))
    assert "Exchange" not in text and "Join" not in text


def test_demos_use_a_top_k(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents")
    assert "TakeOrderedAndProject" in plan(split.demos(docs, "doc_id", 1, 3))


def test_keys_stay_spread(spark, sf_dir):
    """adaptive execution does not merge the few bytes of many keys into one task."""
    keys = B.ids(spark, sf_dir, "orders", "o_orderkey")
    assert "REPARTITION_BY_NUM" in plan(keys)
    assert keys.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
