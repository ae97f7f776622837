import json

import pytest
from pyspark.sql import types as T

from gleanframe.operators.chat import demo_block, loss_targets, prompts, to_chat
from gleanframe.operators.split import split_exact
from gleanframe.session import shared_path
from gleanframe.sources.predictions import read_predictions
from gleanframe.sources.records import export_chat, read_records, write_records, write_splits
from gleanframe.spec import JOB_POSTING
from tests.jobs import CLERK, NURSE, RECORDS, gold_frame, labels, preds_frame


def plain(lab):
    """Labels as a JSON reader would give them: whole numbers as ints."""
    return {k: int(v) if isinstance(v, float) and v.is_integer() else v for k, v in lab.items()}


def test_prompt_lists_every_field_and_domain():
    text = JOB_POSTING.system_prompt()
    lines = text.splitlines()
    assert len(lines) == 19 and lines[2] == "{" and lines[17] == "}"
    assert lines[3] == '  "title": string,'
    assert lines[6] == '  "workplace_type": "remote"|"hybrid"|"onsite"|null,'
    assert lines[9] == '  "salary_min": number|null,'
    assert lines[13] == '  "required_skills": string[],'
    assert lines[16] == '  "education": string|null'


def test_chat_row_bytes(spark):
    rows = {r.row_id: r.messages for r in to_chat(gold_frame(spark), JOB_POSTING).collect()}
    for row_id, text, lab in RECORDS:
        system, user, assistant = rows[row_id]
        assert (system.role, system.content) == ("system", JOB_POSTING.system_prompt())
        assert (user.role, user.content) == ("user", text)
        assert assistant.role == "assistant"
        assert assistant.content == json.dumps(plain(lab), ensure_ascii=False)


@pytest.mark.parametrize("value", ['quote " and \\ slash /', "tab\tline\nend\r", "[x]", "]", "[", "", "é – 漢 😀",
                                   '","', "a\\", " padded "])
def test_strings_survive_in_fields_and_lists(spark, value):
    lab = labels(title=value, required_skills=[value, "x", value])
    row, = to_chat(gold_frame(spark, [("1", value, lab)]), JOB_POSTING).collect()
    assert row.messages[2].content == json.dumps(lab, ensure_ascii=False)


@pytest.mark.parametrize("number,text", [(160000.0, "160000"), (2.5, "2.5"), (0.0, "0"), (-3.0, "-3"),
                                         (12345678.0, "12345678"), (0.1, "0.1")])
def test_number_text(spark, number, text):
    row, = to_chat(gold_frame(spark, [("1", "", labels(salary_min=number))]), JOB_POSTING).collect()
    assert f'"salary_min": {text},' in row.messages[2].content


def test_demo_block_order_and_prompt(spark):
    ranked = gold_frame(spark).selectExpr("*", "CASE row_id WHEN 'r1' THEN 2 ELSE 1 END AS rank")
    block = demo_block(ranked, JOB_POSTING)
    row, = block.collect()
    assert [(m.role, m.content) for m in row.messages] == [
        ("user", RECORDS[1][1]), ("assistant", json.dumps(plain(CLERK), ensure_ascii=False)),
        ("user", RECORDS[0][1]), ("assistant", json.dumps(plain(NURSE), ensure_ascii=False))]
    asked = prompts(spark.createDataFrame([("q",)], "posting string"), JOB_POSTING, block).first().messages
    assert [m.role for m in asked] == ["system", "user", "assistant", "user", "assistant", "user"]
    assert asked[-1].content == "q" and asked[1].content == RECORDS[1][1]


def test_no_demos(spark):
    none = gold_frame(spark).selectExpr("*", "1 AS rank").limit(0)
    block = demo_block(none, JOB_POSTING)
    assert block.collect()[0].messages == []
    q = spark.createDataFrame([("q",)], "posting string")
    few = prompts(q, JOB_POSTING, block).first().messages
    zero = prompts(q, JOB_POSTING).first().messages
    assert few == zero and [m.role for m in zero] == ["system", "user"]


def test_only_assistant_turns_are_targets(spark):
    turns = loss_targets(to_chat(gold_frame(spark), JOB_POSTING).select("row_id", "messages")).collect()
    assert {(r.turn, r.role, r.is_target) for r in turns} == {
        (0, "system", False), (1, "user", False), (2, "assistant", True)}


def test_records_round_trip(spark):
    path = shared_path(spark, "records")
    gold = gold_frame(spark)
    write_records(gold, path, JOB_POSTING)
    back = read_records(spark, path, JOB_POSTING)
    assert sorted(back.collect()) == sorted(gold.select("posting", "labels").collect())
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert all(set(x) == {"posting", "labels"} and len(x["labels"]) == 14 for x in lines)


def test_reader_skips_blank_lines_and_stops_at_bad_ones(spark, tmp_path):
    good = json.dumps({"posting": "a b\u0085c", "labels": plain(NURSE)}, ensure_ascii=False)
    (tmp_path / "good.jsonl").write_text(f"{good}\n\n   \n{good}\n", encoding="utf-8")
    rows = read_records(spark, str(tmp_path / "good.jsonl"), JOB_POSTING).collect()
    assert [r.posting for r in rows] == ["a b\u0085c"] * 2
    assert rows[0].labels.salary_min == 31.5 and rows[0].labels.education is None
    (tmp_path / "bad.jsonl").write_text(good + '\n{"posting": "x", "labels"\n', encoding="utf-8")
    with pytest.raises(Exception):
        read_records(spark, str(tmp_path / "bad.jsonl"), JOB_POSTING).collect()


def test_split_folders_and_pruning(spark):
    path = shared_path(spark, "splits")
    many = gold_frame(spark, [(f"r{i}", f"text {i}", labels(title=str(i))) for i in range(20)])
    write_splits(split_exact(many, "row_id", 42, 3, 3), path, JOB_POSTING)
    back = read_records(spark, path, JOB_POSTING)
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == {
        "train": 14, "val": 3, "test": 3}
    plan = back.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_too_few_rows_write_nothing(spark, tmp_path):
    few = gold_frame(spark)
    with pytest.raises(Exception, match="fewer than 6 rows"):
        write_splits(split_exact(few, "row_id", 42, 3, 3), str(tmp_path / "s"), JOB_POSTING)
    assert not list((tmp_path).glob("s/split=*"))


def test_chat_export_both_formats(spark):
    chat = to_chat(gold_frame(spark), JOB_POSTING).selectExpr("messages", "'train' AS split")
    for fmt in ("parquet", "json"):
        path = shared_path(spark, "chat")
        export_chat(chat, path, fmt, shards=2)
        if fmt == "json":
            back = [json.loads(r.value)["messages"] for r in spark.read.text(path).collect()]
        else:
            back = [[m.asDict() for m in r.messages] for r in spark.read.parquet(path).collect()]
        want = [[m.asDict() for m in r.messages] for r in chat.collect()]
        assert sorted(map(str, back)) == sorted(map(str, want))
    with pytest.raises(ValueError):
        export_chat(chat, shared_path(spark, "chat"), "csv")


def test_predictions_from_parquet_and_json(spark):
    rows = [("a", "1", "{}"), ("b", "2", None), ("a", "3", "x\ny")]
    preds = preds_frame(spark, rows)
    for fmt in ("parquet", "json"):
        path = shared_path(spark, "preds")
        preds.write.format(fmt).save(path)
        assert sorted(map(str, read_predictions(spark, path, fmt).collect())) == sorted(map(str, preds.collect()))
    path = shared_path(spark, "preds")
    spark.createDataFrame([("a", 1, "{}")], "run string, row_id long, raw_text string").write.partitionBy("run").parquet(path)
    assert read_predictions(spark, path, row_id=T.LongType()).select("run", "row_id").collect() == [("a", 1)]
