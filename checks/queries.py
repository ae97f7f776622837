"""One query per operator over the given tables, with flat columns for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from checks import testbed as B
from gleanframe.functions import draws as D
from gleanframe.functions import extract as X
from gleanframe.functions.json_text import labels_json
from gleanframe.operators import chat, contamination, mix, parse, score, split, synth
from gleanframe.plans import reports
from gleanframe.session import shared_path, staged
from gleanframe.sources import predictions, records, stored
from gleanframe.spec import JOB_POSTING, LIST, STRING, RecordSpec

SPEC = B.DOC_SPEC
SEED = 42
N_TEST, N_VAL = 30, 20
SIZES = (5, 100, 700, 1_000_000_000)
N_DEMOS = 3
TOP_FAILURES = 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _digits(column: str, n: int = 6) -> Column:
    return F.round(column, n).alias(column)


def _flat_labels(spec: RecordSpec) -> list[Column]:
    """Labels as flat columns: lists joined by '|'."""
    return [F.array_join(F.col(f"labels.{f.name}"), "|").alias(f.name) if f.kind == LIST
            else F.col(f"labels.{f.name}").alias(f.name) for f in spec.fields]


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    gold = B.doc_gold(spark, sf_dir)
    return gold, B.doc_preds(gold), B.run_config(spark)


def _metrics(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    gold, preds, runs = _inputs(spark, sf_dir)
    return reports.run_metrics(gold, preds, runs, SPEC), runs


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "documents")


# --- A: sources and sinks -------------------------------------------------------------

@query
def a1_read_records(spark, sf_dir):
    path = shared_path(spark, "records")
    records.write_records(B.doc_gold(spark, sf_dir), path, SPEC)
    back = records.read_records(spark, path, SPEC)
    return back.select(F.md5("posting").alias("posting_md5"), *_flat_labels(SPEC))


@query
def a2_write_records(spark, sf_dir):
    path = shared_path(spark, "records")
    records.write_records(B.doc_gold(spark, sf_dir), path, SPEC)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.md5("value").alias("line_md5"), F.length("value").alias("n_chars"))


@query
def a3_write_splits(spark, sf_dir):
    path = shared_path(spark, "splits")
    parts = split.split_exact(B.doc_gold(spark, sf_dir), "row_id", SEED, N_TEST, N_VAL)
    records.write_splits(parts, path, SPEC)
    back = records.read_records(spark, path, SPEC)
    return back.select("split", F.md5("posting").alias("posting_md5"), "labels.n_chars")


@query
def a4_read_predictions(spark, sf_dir):
    path = shared_path(spark, "answers")
    B.doc_preds(B.doc_gold(spark, sf_dir)).write.parquet(path)
    back = predictions.read_predictions(spark, path, row_id=T.LongType())
    return back.select("run", "row_id", F.md5("raw_text").alias("text_md5"))


@query
def a5_export_chat(spark, sf_dir):
    path = shared_path(spark, "chat")
    parts = split.split_exact(B.doc_gold(spark, sf_dir), "row_id", SEED, N_TEST, N_VAL)
    rows = chat.to_chat(parts.where(F.col("split") != "test"), SPEC)
    records.export_chat(rows.select("row_id", "messages", "split"), path)
    back = spark.read.parquet(path)
    return back.select("split", "row_id", F.size("messages").alias("n_turns"),
                       F.md5(F.col("messages")[2]["content"]).alias("answer_md5"))


# --- B: splits ------------------------------------------------------------------------

@query
def b1_split_exact(spark, sf_dir):
    parts = split.split_exact(_documents(spark, sf_dir), "doc_id", SEED, N_TEST, N_VAL)
    return parts.select("doc_id", "split")


@query
def b2_split_fraction(spark, sf_dir):
    parts = split.split_fraction(_documents(spark, sf_dir), "doc_id", SEED,
                                 {"test": 0.15, "val": 0.15})
    return parts.select("doc_id", "split")


@query
def b4_prefix_subsets(spark, sf_dir):
    subsets = split.prefix_subsets(_documents(spark, sf_dir), "doc_id", SEED, SIZES)
    return subsets.select("train_size", "doc_id")


@query
def b5_demos(spark, sf_dir):
    parts = split.split_exact(_documents(spark, sf_dir), "doc_id", SEED, N_TEST, N_VAL)
    first = split.demos(parts.where(F.col("split") == "train"), "doc_id", SEED, N_DEMOS)
    return first.select("rank", "doc_id")


@query
def b7_eval_purity(spark, sf_dir):
    hand, synthetic = B.origin_parts(spark, sf_dir)
    parts = split.split_exact(hand, "row_id", SEED, N_TEST, N_VAL).drop("split_key")
    return mix.eval_purity(mix.experiment_rows(parts, synthetic))


@query
def b3_split_grouped(spark, sf_dir):
    parts = split.split_grouped(_documents(spark, sf_dir), SEED, N_TEST, N_VAL)
    return parts.select("doc_id", "split")


@query
def b3_split_by_source(spark, sf_dir):
    """Groups of very different sizes: all documents of a source stay together."""
    docs = _documents(spark, sf_dir)
    parts = split.split_grouped(docs, SEED, 60, 40, group_key="source")
    return parts.select("doc_id", "split")


@query
def b6_leakage_audit(spark, sf_dir):
    parts = split.split_fraction(_documents(spark, sf_dir), "doc_id", SEED, {"test": 0.15, "val": 0.15})
    return split.leakage_audit(parts)


@query
def b8_contamination(spark, sf_dir):
    found = contamination.item_contamination(_documents(spark, sf_dir), B.table(spark, sf_dir, "benchmark"), 5)
    return found.withColumn("found_share", _digits("found_share"))


@query
def b8_contaminated_texts(spark, sf_dir):
    shared = contamination.text_contamination(_documents(spark, sf_dir), B.table(spark, sf_dir, "benchmark"), 5)
    return shared.withColumn("shared_share", _digits("shared_share"))


# --- C: chat rows and prompts -----------------------------------------------------------

@query
def c1_to_chat(spark, sf_dir):
    rows = chat.to_chat(B.doc_gold(spark, sf_dir), SPEC)
    return rows.select("row_id", F.posexplode("messages").alias("turn", "m")).select(
        "row_id", "turn", "m.role", "m.content")


def _demo_block(spark, sf_dir, gold):
    parts = split.split_exact(gold, "row_id", SEED, N_TEST, N_VAL)
    first = split.demos(parts.where(F.col("split") == "train"), "row_id", SEED, N_DEMOS)
    return chat.demo_block(first, SPEC)


@query
def c2_demo_block(spark, sf_dir):
    block = _demo_block(spark, sf_dir, B.doc_gold(spark, sf_dir))
    return block.select(F.posexplode("messages").alias("turn", "m")).select(
        "turn", "m.role", "m.content")


@query
def c3_prompts(spark, sf_dir):
    gold = B.doc_gold(spark, sf_dir)
    rows = chat.prompts(gold.select("row_id", "posting"), SPEC, _demo_block(spark, sf_dir, gold))
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(">"),
                                                                   m["content"])), "\n")
    return rows.select("row_id", F.size("messages").alias("n_turns"), F.md5(text).alias("prompt_md5"))


@query
def c3_prompts_zero_shot(spark, sf_dir):
    rows = chat.prompts(B.doc_gold(spark, sf_dir).select("row_id", "posting"), SPEC)
    return rows.select("row_id", F.size("messages").alias("n_turns"),
                       F.col("messages")[1]["content"].alias("question"))


@query
def c4_loss_targets(spark, sf_dir):
    turns = chat.loss_targets(chat.to_chat(B.doc_gold(spark, sf_dir), SPEC).select("row_id", "messages"))
    return turns.select("row_id", "turn", "role", "is_target", F.length("content").alias("n_chars"))


@query
def c4_loss_spans(spark, sf_dir):
    spans = chat.loss_spans(chat.to_chat(B.doc_gold(spark, sf_dir), SPEC).select("row_id", "messages"))
    return spans.select("row_id", "n_chars", "target_chars", _digits("target_share"))


def _prompt_lengths(spark, sf_dir):
    gold = B.doc_gold(spark, sf_dir)
    return chat.prompt_lengths(gold.select("row_id", "posting", "labels.lang"), SPEC,
                               {"zero": None, "few": _demo_block(spark, sf_dir, gold)})


@query
def c5_length_budget(spark, sf_dir):
    return chat.length_budget(_prompt_lengths(spark, sf_dir), 1024, "prompt").select(
        "prompt", "n_rows", "n_over", _digits("mean_words"), _digits("p95_words"), "max_words")


@query
def c5_length_sketches(spark, sf_dir):
    """Kept by language and merged: counts are exact, and the share of rows up to the estimated quantile is near it."""
    lengths = _prompt_lengths(spark, sf_dir)
    report = chat.length_report(chat.merge_length_sketches(chat.length_sketches(lengths, 1024, "prompt", "lang"), "prompt"))
    upto = lengths.join(report.select("prompt", "p95_words"), "prompt").groupBy("prompt").agg(
        F.avg((F.col("n_words") <= F.col("p95_words")).cast("double")).alias("share"))
    return report.join(upto, "prompt").select("prompt", "n_rows", "n_over", _digits("mean_words"), "max_words",
                                              (F.abs(F.col("share") - 0.95) < 0.02).alias("p95_is_near"))


# --- D: parse and validate ----------------------------------------------------------------

@query
def d1_slice_json(spark, sf_dir):
    sliced = parse.slice_text(B.doc_preds(B.doc_gold(spark, sf_dir)))
    return sliced.select("run", "row_id", "json_text")


@query
def d1_slice_pages(spark, sf_dir):
    sliced = parse.slice_text(B.table(spark, sf_dir, "pages"), "html")
    return sliced.select("page_id", F.length("json_text").alias("n_chars"),
                         F.md5("json_text").alias("slice_md5"))


@query
def d2_parse_object(spark, sf_dir):
    parsed = parse.parse_object(B.doc_preds(B.doc_gold(spark, sf_dir)))
    values = [f"{X.member_value('object', f.name, STRING)} AS {f.name}" for f in SPEC.scalars]
    return parsed.selectExpr("run", "row_id", "json_valid", *values)


@query
def d2_parse_events(spark, sf_dir):
    parsed = parse.parse_object(B.table(spark, sf_dir, "events"), "props")
    return parsed.select("event_id", "json_valid",
                         F.try_variant_get("object", "$.k", "double").alias("k"))


@query
def d2_parse_documents(spark, sf_dir):
    parsed = parse.parse_object(_documents(spark, sf_dir), "text")
    return parsed.select("doc_id", "json_valid")


@query
def d3_validate_schema(spark, sf_dir):
    return parse.validate_schema(B.doc_preds(B.doc_gold(spark, sf_dir)), SPEC)


def _faulty_gold(spark, sf_dir):
    """Gold with breaches of every kind: by the text's length, so that SQL can tell them too."""
    n = "labels.n_chars"
    return B.doc_gold(spark, sf_dir).selectExpr(
        "row_id", f"CASE WHEN {n} % 11 = 0 THEN NULL ELSE posting END AS posting",
        f"CASE WHEN {n} % 13 = 0 THEN NULL ELSE struct("
        f"CASE {n} % 7 WHEN 0 THEN 'xx' WHEN 1 THEN NULL ELSE labels.lang END AS lang, labels.source, labels.n_chars, "
        "labels.quality, labels.toxic, "
        f"CASE WHEN {n} % 5 = 0 THEN 'middling' ELSE labels.band END AS band, labels.last_terms, "
        f"CASE WHEN {n} % 3 = 0 THEN array(NULL) ELSE labels.more_terms END AS more_terms) END AS labels")


@query
def d4_validate_gold(spark, sf_dir):
    return parse.validate_gold(_faulty_gold(spark, sf_dir), SPEC)


def _faulty_lines(spark, sf_dir):
    """Raw lines of faulty records, some of them broken as a whole, by the text's length."""
    body = labels_json(SPEC)
    rows = _faulty_gold(spark, sf_dir).withColumn("n", F.col("labels.n_chars")).withColumn("body", F.expr(body)).join(
        _documents(spark, sf_dir).selectExpr("doc_id AS row_id", "n_chars AS n_all"), "row_id")
    labels = "CASE WHEN n % 2 = 0 THEN replace(body, '{', '{\"note\": 1, ') ELSE body END"
    posting = "CASE n_all % 17 WHEN 0 THEN 'null' WHEN 1 THEN '5' ELSE '\"x\"' END"
    head = f"CASE WHEN n_all % 17 = 2 THEN '' ELSE concat('\"posting\": ', {posting}, ', ') END"
    line = (f"concat('{{', {head}, '\"labels\": ', CASE WHEN labels IS NOT NULL THEN {labels} "
            "WHEN n_all % 26 = 0 THEN 'null' ELSE '[1]' END, CASE WHEN n_all % 19 = 3 THEN ', \"id\": 7' ELSE '' END, '}')")
    value = ("CASE n_all % 23 WHEN 1 THEN concat(line, ' trailing') WHEN 2 THEN replace(line, '\"', \"'\") "
             "WHEN 3 THEN concat(line, line) WHEN 4 THEN concat('[', line, ']') WHEN 5 THEN '  ' "
             "WHEN 6 THEN concat('  ', line, ' \\t') ELSE line END")
    return rows.selectExpr("row_id", "n_all", f"{line} AS line").selectExpr("row_id", f"{value} AS value")


@query
def d4_validate_lines(spark, sf_dir):
    """Raw lines with breaches of every kind, counted."""
    return parse.count_breaches(parse.validate_lines(_faulty_lines(spark, sf_dir), SPEC))


@query
def d4_records_of_lines(spark, sf_dir):
    """The lines that are records, and with them the quarantine: what is neither is blank."""
    checked = parse.checked_lines(_faulty_lines(spark, sf_dir), SPEC)
    return checked.select("row_id", (F.size("breaches") == 0).alias("is_record"), "labels.lang", "labels.n_chars")


# --- E: scores and comparisons ------------------------------------------------------------

@query
def e1_scalar_match(spark, sf_dir):
    gold, preds, _ = _inputs(spark, sf_dir)
    flags = [F.col(f"ok_{f.name}") for f in SPEC.scalars]
    return score.compare_fields(gold, preds, SPEC).select("run", "row_id", *flags)


@query
def e2_list_f1(spark, sf_dir):
    gold, preds, _ = _inputs(spark, sf_dir)
    values = [_digits(f"f1_{f.name}") for f in SPEC.lists]
    return score.compare_fields(gold, preds, SPEC).select("run", "row_id", *values)


@query
def e3_score_rows(spark, sf_dir):
    return score.score_rows(*_inputs(spark, sf_dir), SPEC).withColumn(
        "list_f1_sum", _digits("list_f1_sum"))


def _stored(spark, sf_dir):
    """Gold and answers as tables bucketed by row, replaced by the next call."""
    gold, preds, runs = _inputs(spark, sf_dir)
    return (stored.store_gold(gold.select("row_id", "labels"), "gleanframe_gold", 8, shared_path(spark, "gold")),
            stored.store_answers(preds, "gleanframe_answers", 8, shared_path(spark, "answers")), runs)


@query
def e3_score_stored_rows(spark, sf_dir):
    """As E3, over bucketed tables: without a shuffle by row."""
    return score.score_rows(*_stored(spark, sf_dir), SPEC).withColumn("list_f1_sum", _digits("list_f1_sum"))


@query
def e4_run_metrics(spark, sf_dir):
    metrics, _ = _metrics(spark, sf_dir)
    return metrics.select("run", "n_rows", "valid_rows", "scalar_correct", "scalar_total",
                          "list_count", *[_digits(m) for m in reports.METRICS])


@query
def e4_answer_check(spark, sf_dir):
    """Answers of every tenth row twice, and without the gold rows of one language."""
    gold, preds, runs = _inputs(spark, sf_dir)
    again = preds.where("row_id % 10 = 3")
    return score.answer_check(gold.where("labels.lang <> 'de'"), preds.unionByName(again), runs)


@query
def e4_job_postings(spark, sf_dir):
    """All fields of the job record: answers drawn with the gold's seed and with another. Gold is sampled once and stored."""
    orders = B.ids(spark, sf_dir, "orders", "o_orderkey")
    gold = staged(synth.sample_labels(orders, "o_orderkey", SEED), "postings")

    def answers(run, labels):
        return labels.selectExpr(f"'{run}' AS run", "row_id", f"{labels_json(JOB_POSTING)} AS raw_text")

    preds = answers("same", gold).unionByName(
        answers("other", synth.sample_labels(orders, "o_orderkey", SEED + 1)))
    runs = spark.sql("SELECT * FROM VALUES ('same'), ('other') AS t(run)")
    return reports.run_metrics(gold, preds, runs, JOB_POSTING).select(
        "run", "n_rows", "valid_rows", "scalar_correct", _digits("field_acc"), _digits("skills_f1"))


@query
def e5_metrics_report(spark, sf_dir):
    metrics, _ = _metrics(spark, sf_dir)
    return reports.metrics_report(metrics)


@query
def e6_compare_runs(spark, sf_dir):
    table = reports.compare_runs(*_metrics(spark, sf_dir))
    return table.select("prompt", *[_digits(c) for c in table.columns if c != "prompt"])


@query
def e7_win_condition(spark, sf_dir):
    metrics, _ = _metrics(spark, sf_dir)
    table = reports.win_condition(metrics, "tuned_zero", "base_few")
    return table.select("metric", _digits("tuned"), _digits("base"), _digits("delta"), "met")


@query
def e8_ablation_table(spark, sf_dir):
    table = reports.ablation_table(*_metrics(spark, sf_dir))
    return table.select("train_rows", *[_digits(c) for c in table.columns if c != "train_rows"])


@query
def e9_source_table(spark, sf_dir):
    metrics, runs = _metrics(spark, sf_dir)
    counts = mix.mix_counts(mix.mix_table(*B.origin_parts(spark, sf_dir)))
    return reports.source_table(metrics, runs, counts).select(
        "source", "train_rows", *[_digits(m) for m in reports.METRICS])


@query
def e10_field_accuracy(spark, sf_dir):
    return reports.field_accuracy(*_inputs(spark, sf_dir), SPEC).select(
        "run", "field", "kind", _digits("accuracy"))


@query
def e11_failures(spark, sf_dir):
    gold, preds, _ = _inputs(spark, sf_dir)
    return score.failures(gold, preds, SPEC)


@query
def e11_top_failures(spark, sf_dir):
    gold, preds, _ = _inputs(spark, sf_dir)
    return reports.top_failures(gold, preds, SPEC, TOP_FAILURES).select(
        "run", "field", "place", "row_id", "predicted", "gold")


@query
def e12_resolution(spark, sf_dir):
    table = reports.resolution(*_metrics(spark, sf_dir))
    return table.select("run", "comparison", _digits("field_step", 9), _digits("slot_step", 9),
                        "fields_behind", _digits("slots_behind"), "below_noise")


@query
def e13_confound_check(spark, sf_dir):
    table = reports.confound_check(*_metrics(spark, sf_dir), B.KNOBS)
    return table.withColumn("field_acc_spread", _digits("field_acc_spread"))


@query
def e13_confound_pairs(spark, sf_dir):
    pairs = reports.confound_pairs(*_metrics(spark, sf_dir), B.KNOBS)
    return pairs.withColumn("field_acc_delta", _digits("field_acc_delta"))


# --- F: synthetic labels and mixing ---------------------------------------------------------

def _sampled(spark, sf_dir):
    return synth.sample_labels(_documents(spark, sf_dir), "doc_id", SEED)


@query
def f1_uniform(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.round(F.expr(D.uniform(SEED, "doc_id", "x")), 9).alias("u"))


@query
def f2_choose(spark, sf_dir):
    drawn = D.with_draws(_documents(spark, sf_dir), SEED, "doc_id", ["education"])
    return drawn.selectExpr("doc_id", f"{D.choose('u_education', synth.JOB_POOLS.education)} AS education")


@query
def f3_choose_weighted(spark, sf_dir):
    drawn = D.with_draws(_documents(spark, sf_dir), SEED, "doc_id", ["seniority"])
    weights = list(synth.JOB_POOLS.seniority_weights.items())
    return drawn.selectExpr("doc_id", f"{D.choose_weighted('u_seniority', weights)} AS seniority")


@query
def f4_conditional_fields(spark, sf_dir):
    return _sampled(spark, sf_dir).select(
        "row_id", "labels.seniority", "labels.title", "labels.employment_type",
        "labels.min_years_experience")


@query
def f5_null_masks(spark, sf_dir):
    return _sampled(spark, sf_dir).select(
        "row_id", *[F.col(f"labels.{c}").isNull().alias(f"no_{c}") for c in (
            "workplace_type", "location", "salary_currency", "salary_min", "salary_max")])


@query
def f6_number_grids(spark, sf_dir):
    return _sampled(spark, sf_dir).select(
        "row_id", "labels.salary_period", "labels.salary_min", "labels.salary_max")


@query
def f7_shuffled_prefix(spark, sf_dir):
    return _sampled(spark, sf_dir).select(
        "row_id", F.array_join("labels.required_skills", "|").alias("required_skills"),
        F.array_join("labels.preferred_skills", "|").alias("preferred_skills"))


@query
def f8_sample_labels(spark, sf_dir):
    orders = B.ids(spark, sf_dir, "orders", "o_orderkey")
    sampled = synth.sample_labels(orders, "o_orderkey", SEED)
    return sampled.select("row_id", *_flat_labels(JOB_POSTING))


@query
def f8_teacher_requests(spark, sf_dir):
    requests = synth.teacher_requests(_sampled(spark, sf_dir), "Write one posting for these facts.")
    return requests.select("row_id", F.col("messages")[0]["content"].alias("system"),
                           F.col("messages")[1]["content"].alias("facts"))


@query
def f8_attach_postings(spark, sf_dir):
    documents = _documents(spark, sf_dir).selectExpr("doc_id AS row_id", "text AS raw_text")
    replies = documents.where("row_id % 5 <> 1").unionByName(documents.where("row_id % 5 = 2"))
    rows = synth.attach_postings(_sampled(spark, sf_dir), replies)
    return rows.select("row_id", F.md5("posting").alias("posting_md5"), "labels.title", "status")


@query
def f9_coverage_audit(spark, sf_dir):
    return synth.coverage_audit(_sampled(spark, sf_dir))


@query
def f9_field_profile(spark, sf_dir):
    """Null rates, distinct and frequent values of all fields, from sketches of three parts of the table."""
    parts = _sampled(spark, sf_dir).withColumn("part", F.col("row_id") % 3)
    profile = synth.field_profile(synth.merge_field_sketches(synth.field_sketches(parts, by=["part"])))
    return profile.withColumn("null_share", _digits("null_share")).withColumn(
        "top", F.expr("array_join(transform(top, x -> concat(x.value, ':', x.n_rows)), '|')"))


def _shares(audit):
    return audit.withColumns({c: _digits(c) for c in ("found_share", "clean_share")})


@query
def f10_grounding_audit(spark, sf_dir):
    return _shares(synth.grounding_audit(B.doc_gold(spark, sf_dir), SPEC, known={"quality": ["0", "1"], "more_terms": ["the", "of the"]}))


@query
def f10_grounding_postings(spark, sf_dir):
    """Sampled job labels beside texts that were not written for them: what is found is found by chance."""
    texts = _documents(spark, sf_dir).selectExpr("doc_id AS row_id", "text AS posting")
    known = {"salary_currency": synth.JOB_POOLS.currencies, "location": synth.JOB_POOLS.cities, "preferred_skills": ["Go", "R", "SQL"]}
    return _shares(synth.grounding_audit(_sampled(spark, sf_dir).join(texts, "row_id"), known=known))


@query
def f11_mix(spark, sf_dir):
    return mix.mix(*B.origin_parts(spark, sf_dir), "mixed").select("row_id", "source")


@query
def f12_mix_table(spark, sf_dir):
    return mix.mix_table(*B.origin_parts(spark, sf_dir)).select("mode", "source", "row_id")
