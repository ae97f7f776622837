"""The whole course on a small set: read, split, train rows, prompts, answers, comparison."""

import json

from pyspark.sql import functions as F, types as T

from gleanframe.functions.json_text import labels_json
from gleanframe.operators import chat, mix, split, synth
from gleanframe.plans import reports
from gleanframe.session import shared_path
from gleanframe.sources import predictions, records
from gleanframe.spec import JOB_POSTING


def test_from_files_to_comparison(spark, tmp_path):
    # Twenty sampled records as a JSON lines file.
    sampled = synth.sample_label_rows(spark, 20, 5)
    text = sampled.select("row_id", F.concat(F.lit(" Job no. "), F.col("row_id"), F.lit("\n")).alias("raw_text"))
    source = shared_path(spark, "source")
    records.write_records(synth.attach_postings(sampled, text), source, JOB_POSTING)

    # Ids once, then a split by files.
    gold_path = shared_path(spark, "gold")
    records.with_row_ids(records.read_records(spark, source, JOB_POSTING)).write.parquet(gold_path)
    gold = spark.read.parquet(gold_path)
    assert gold.select("row_id").distinct().count() == 20
    parts = split.split_exact(gold, "row_id", 42, 3, 3)
    sizes = {r.split: r["count"] for r in parts.groupBy("split").count().collect()}
    assert sizes == {"test": 3, "val": 3, "train": 14}
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")

    # Training rows for three sizes, prompts with three demos from train.
    sets = split.prefix_subsets(train.drop("split", "split_key"), "row_id", 42, [5, 10, 14])
    assert {r.train_size: r["count"] for r in sets.groupBy("train_size").count().collect()} == {
        5: 5, 10: 10, 14: 14}
    block = chat.demo_block(split.demos(train, "row_id", 42, 3), JOB_POSTING)
    asked = chat.prompts(test, JOB_POSTING, block).select("row_id", "messages").collect()
    assert len(asked) == 3 and all(len(r.messages) == 8 for r in asked)
    own = {r.row_id: r.posting for r in test.collect()}
    for r in asked:
        assert r.messages[-1].content == own[r.row_id]
        assert own[r.row_id] not in [m.content for m in r.messages[:-1]]

    # Answers: one run is perfect, one leaves out a field, one fails.
    good = test.selectExpr("row_id", f"{labels_json(JOB_POSTING)} AS t").collect()
    rows = [("tuned_zero", r.row_id, f"```json\n{r.t}\n```") for r in good]
    rows += [("base_few", r.row_id, json.dumps({**json.loads(r.t), "title": "Other"})) for r in good]
    rows += [("base_zero", r.row_id, "I see a job.") for r in good]
    path = shared_path(spark, "answers")
    spark.createDataFrame(rows, predictions.predictions_type(T.LongType())).write.partitionBy("run").parquet(path)
    answers = predictions.read_predictions(spark, path, row_id=T.LongType())

    runs = spark.createDataFrame([("base_zero",), ("base_few",), ("tuned_zero",)], "run string")
    metrics = reports.run_metrics(test, answers, runs, JOB_POSTING)
    got = {r.run: (r.json_valid_pct, r.fields_correct, r.fields_total, r.skills_f1)
           for r in reports.metrics_report(metrics).collect()}
    assert got == {"tuned_zero": (100, 36, 36, 1.0), "base_few": (100, 33, 36, 1.0),
                   "base_zero": (0, 0, 36, 0.0)}
    won = {r.metric: r.met for r in reports.win_condition(metrics, "tuned_zero", "base_few").collect()}
    assert all(won.values())

    # Synthetic rows join the training set only.
    extra = synth.attach_postings(
        synth.sample_label_rows(spark, 100, 42),
        spark.range(100).selectExpr("id AS row_id", "'made up' AS raw_text"))
    hand = train.select("row_id", "posting", "labels", F.lit("ok").alias("status"))
    counts = {r["mode"]: r.train_rows for r in mix.mix_counts(mix.mix_table(hand, extra)).collect()}
    assert counts == {"hand": 14, "synthetic": 100, "mixed": 114}
