"""Run metrics and the comparisons built on them.

Everything below `run_metrics` works on one row per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleanframe.functions.sql import literal, name
from gleanframe.operators.score import compare_fields, failures, listed_answers, scored_answers
from gleanframe.spec import RecordSpec

METRICS = ("json_valid", "field_acc", "skills_f1")


def _row_count(gold: DataFrame) -> Column:
    return gold.agg(F.count("*")).scalar()


def run_metrics(gold: DataFrame, preds: DataFrame, runs: DataFrame, spec: RecordSpec) -> DataFrame:
    """json_valid, field_acc and skills_f1 per listed run, with the counts behind them.

    Sums over stored answers suffice: an absent answer adds nothing to a numerator
    and a constant to each denominator, so the gold table is counted, not
    multiplied by the runs. Every run partially aggregates before the shuffle, and
    answers of other runs are dropped at the scan. Without gold rows the metrics are
    NULL. More than one answer per (run, row_id) would count more than once; see
    `score.answer_check`.
    """
    sums = scored_answers(gold, listed_answers(preds, runs), spec).groupBy("run").agg(
        F.sum("json_valid").alias("valid"),
        F.sum("scalar_correct").alias("correct"),
        F.sum("list_f1_sum").alias("f1_sum"),
    )
    counted = runs.select("run").join(sums, "run", "left").withColumn("n_rows", _row_count(gold))
    return counted.selectExpr(
        "run", "n_rows",
        "coalesce(valid, 0L) AS valid_rows",
        "coalesce(correct, 0L) AS scalar_correct",
        "coalesce(f1_sum, 0D) AS list_f1_sum",
        f"n_rows * {len(spec.scalars)} AS scalar_total",
        f"n_rows * {len(spec.lists)} AS list_count",
    ).selectExpr(
        "*",
        "try_divide(valid_rows, n_rows) AS json_valid",
        "try_divide(scalar_correct, scalar_total) AS field_acc",
        "try_divide(list_f1_sum, list_count) AS skills_f1",
    )


def _two_digits(x: str) -> Column:
    """A number from 0 to 1 at two digits, a tie settled by the binary value.

    The number times 2^60 is whole up to what a double holds, so its hundredfold is compared
    with whole multiples of 2^60 exactly. What is half to the last bit goes to the even digit.
    """
    one = "cast(1152921504606846976 AS decimal(38, 0))"
    scaled = f"cast(cast({x} * 1152921504606846976D AS bigint) AS decimal(38, 0)) * 100"
    whole, rest = f"cast(({scaled}) div {one} AS bigint)", f"2 * (({scaled}) % {one})"
    return F.expr(f"({whole} + CASE WHEN {rest} > {one} OR {rest} = {one} AND {whole} % 2 = 1 "
                  f"THEN 1 ELSE 0 END) / 100D")


def metrics_report(metrics: DataFrame) -> DataFrame:
    """E5: counts and whole percents per run, F1 to two digits."""
    return metrics.select(
        "run",
        F.col("valid_rows").alias("json_valid_rows"), "n_rows",
        F.bround(100 * F.col("json_valid"), 0).cast("int").alias("json_valid_pct"),
        F.col("scalar_correct").alias("fields_correct"),
        F.col("scalar_total").alias("fields_total"),
        F.bround(100 * F.col("field_acc"), 0).cast("int").alias("field_acc_pct"),
        _two_digits("skills_f1").alias("skills_f1"),
    )


def compare_runs(metrics: DataFrame, runs: DataFrame, models: Sequence[str] = ("base", "tuned"),
                 comparison: str = "prompting") -> DataFrame:
    """Prompting style down, model across, each metric as <model>_<metric>."""
    table = metrics.join(runs.where(F.col("comparison") == comparison), "run")
    return table.groupBy("prompt").pivot("model", list(models)).agg(
        *[F.max(m).alias(m) for m in METRICS])


def win_condition(metrics: DataFrame, tuned: str, base: str) -> DataFrame:
    """Does the tuned model without examples match or beat the base model with them?

    One row per metric.
    """
    def of(run: str, metric: str) -> Column:
        return F.max(F.when(F.col("run") == run, F.col(metric)))

    wide = metrics.agg(*[of(run, m).alias(f"{m}_{side}") for m in METRICS
                         for side, run in (("tuned", tuned), ("base", base))])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_tuned").alias("tuned"),
                              F.col(f"{m}_base").alias("base")) for m in METRICS])
    return wide.select(F.explode(rows).alias("_r")).select("_r.*").select(
        "metric", "tuned", "base",
        (F.col("tuned") - F.col("base")).alias("delta"),
        (F.col("tuned") >= F.col("base")).alias("met"),
    )


def ablation_table(metrics: DataFrame, runs: DataFrame, comparison: str = "size") -> DataFrame:
    """Metrics by training size, with the gain over the size before.

    One row per compared size, so the window over all of them is small.
    """
    sizes = metrics.join(runs.where(F.col("comparison") == comparison)
                         .select("run", "train_rows"), "run")
    by_size = Window.orderBy("train_rows")
    return sizes.select("train_rows", *METRICS).withColumn(
        "field_acc_gain", F.col("field_acc") - F.lag("field_acc").over(by_size))


def source_table(metrics: DataFrame, runs: DataFrame, counts: DataFrame,
                 comparison: str = "source") -> DataFrame:
    """Metrics by training source beside the number of training rows of that source."""
    table = metrics.join(runs.where(F.col("comparison") == comparison).select("run", "source"), "run")
    sizes = counts.select(F.col("mode").alias("source"), "train_rows")
    return table.join(sizes, "source", "left").select("source", "train_rows", *METRICS)


def field_accuracy(gold: DataFrame, preds: DataFrame, runs: DataFrame, spec: RecordSpec) -> DataFrame:
    """Share of right values per (run, field); F1 for a list field.

    One wide aggregate per run, turned to rows after it.
    """
    sums = compare_fields(gold, listed_answers(preds, runs), spec).groupBy("run").agg(
        *[F.expr(f"sum(cast({name(f'ok_{f.name}')} AS double))").alias(f"h_{f.name}")
          for f in spec.scalars],
        *[F.sum(f"f1_{f.name}").alias(f"h_{f.name}") for f in spec.lists])
    rows = ", ".join(f"{literal(f.name)}, {literal(f.kind)}, {name(f'h_{f.name}')}"
                     for f in spec.fields)
    return (runs.select("run").join(sums, "run", "left").withColumn("n_rows", _row_count(gold))
            .selectExpr("run", "n_rows", f"stack({len(spec.fields)}, {rows}) AS (field, kind, hits)")
            .selectExpr("run", "field", "kind",
                        "try_divide(coalesce(hits, 0D), n_rows) AS accuracy"))


def top_failures(gold: DataFrame, preds: DataFrame, spec: RecordSpec, k: int) -> DataFrame:
    """The first k failures by row_id of every (run, field).

    Spark ranks within each input partition first and shuffles at most k rows per
    group from each, so a group that holds most failures stays cheap.
    """
    ranked = Window.partitionBy("run", "field").orderBy("row_id")
    return (failures(gold, preds, spec)
            .withColumn("place", F.row_number().over(ranked))
            .where(F.col("place") <= k))


def resolution(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """The smallest step the gold set can show, and the gap of each run to the best
    of its comparison. `below_noise` marks a gap of no more than one field and one list
    slot; it is NULL for a run that leads in both."""
    group = Window.partitionBy("comparison")
    table = metrics.join(runs.select("run", "comparison"), "run")
    fields = F.max("scalar_correct").over(group) - F.col("scalar_correct")
    slots = F.max("list_f1_sum").over(group) - F.col("list_f1_sum")
    return table.select(
        "run", "comparison",
        F.try_divide(F.lit(1.0), F.col("scalar_total")).alias("field_step"),
        F.try_divide(F.lit(1.0), F.col("list_count")).alias("slot_step"),
        fields.alias("fields_behind"), slots.alias("slots_behind"),
        F.when((fields > 0) | (slots > 0), (fields <= 1) & (slots <= 1)).alias("below_noise"),
    )


def confound_check(metrics: DataFrame, runs: DataFrame, knobs: Sequence[str]) -> DataFrame:
    """Per comparison, the knobs that differ between its runs and the spread of
    field_acc. More than one differing knob muddies the result.

    One aggregate by comparison: a knob differs if it has two distinct values, or a
    value on some runs only. No pair of runs is formed.
    """
    table = runs.join(metrics.select("run", "field_acc"), "run")
    stats = table.groupBy("comparison").agg(
        F.count("*").alias("n_runs"),
        (F.max("field_acc") - F.min("field_acc")).alias("field_acc_spread"),
        *[(F.coalesce(F.min(k) != F.max(k), F.lit(False))
           | ((F.count(k) > 0) & (F.count(k) < F.count("*")))).alias(f"_d_{k}") for k in knobs])
    differing = F.filter(F.array(*[F.when(F.col(f"_d_{k}"), F.lit(k)) for k in knobs]),
                         lambda k: k.isNotNull())
    return stats.select("comparison", "n_runs", "field_acc_spread",
                        F.array_join(differing, ",").alias("differing_knobs"),
                        (F.size(differing) > 1).alias("confounded"))


def confound_pairs(metrics: DataFrame, runs: DataFrame, knobs: Sequence[str]) -> DataFrame:
    """E13 by pairs: every two runs, of one comparison or of two, with the knobs that tell them apart.

    (run_a, run_b, comparisons, differing_knobs, n_differing, field_acc_delta, confounded), run_a before
    run_b; the delta is that of run_b over run_a. Two nulls of a knob are equal, a null and a value are not.
    A pair that differs in more than one knob cannot tell which of them moved the metric; one that
    differs in none is a repetition, and its delta is noise. The runs are one array value, from which each
    run takes those that follow: a table of runs is as short as the list of experiments.
    """
    known = runs.select("run", "comparison", *knobs).join(metrics.select("run", "field_acc"), "run")
    listed = known.agg(F.collect_list(F.struct("run", "comparison", "field_acc", *knobs)).alias("_all"))
    pairs = (listed.select(F.explode("_all").alias("a"), "_all").select("a", F.explode("_all").alias("b"))
             .where("a.run < b.run"))
    differing = F.filter(F.array(*[F.when(~F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")), F.lit(k)) for k in knobs]),
                         lambda k: k.isNotNull())
    return pairs.select(
        F.col("a.run").alias("run_a"), F.col("b.run").alias("run_b"),
        F.array_join(F.array_sort(F.array_distinct(F.array("a.comparison", "b.comparison"))), ",").alias("comparisons"),
        F.array_join(differing, ",").alias("differing_knobs"), F.size(differing).alias("n_differing"),
        (F.col("b.field_acc") - F.col("a.field_acc")).alias("field_acc_delta"), (F.size(differing) > 1).alias("confounded"))
