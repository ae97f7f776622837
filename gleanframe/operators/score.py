"""E1-E3 and E11 on row level: compare typed predictions with gold labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleanframe.functions import extract as X
from gleanframe.functions.json_text import json_value
from gleanframe.functions.sql import literal, name
from gleanframe.operators.parse import parse_object
from gleanframe.spec import LIST, RecordSpec


def _col(side: str, field: str) -> str:
    return name(f"{side}_{field}")


def typed_predictions(preds: DataFrame, spec: RecordSpec) -> DataFrame:
    """Parses each answer once and keeps only what scoring compares.

    Per scalar f: `p_f` its value if the type can match, `odd_f` whether it holds a
    non-null value of another type. Per list l: `p_l` its lower-cased set. Doing this
    before the join means that raw text is never shuffled; `object` stays for those
    who read it and is pruned otherwise.
    """
    parsed = parse_object(preds.select("run", "row_id", "raw_text")).selectExpr(
        "run", "row_id", "json_valid", "object",
        *[f"{X.member_type('object', f.name)} AS {_col('t', f.name)}" for f in spec.scalars])
    columns = []
    for f in spec.scalars:
        seen = _col("t", f.name)
        fits = f"coalesce({X.has_kind(seen, f.kind)}, false)"
        value = X.member_value("object", f.name, f.kind)
        columns += [f"CASE WHEN {fits} THEN {value} END AS {_col('p', f.name)}",
                    f"coalesce({seen} != 'VOID', false) AND NOT {fits} AS {_col('odd', f.name)}"]
    for f in spec.lists:
        value = X.lower_set(X.member_value("object", f.name, f.kind))
        columns.append(f"{value} AS {_col('p', f.name)}")
    return parsed.selectExpr("run", "row_id", "json_valid", "object", *columns)


def gold_columns(gold: DataFrame, spec: RecordSpec) -> DataFrame:
    """`row_id`, per field its value `g_f`, and per list its lower-cased set `gs_f`."""
    values = [f"{name(f'labels.{f.name}')} AS {_col('g', f.name)}" for f in spec.fields]
    sets = [f"{X.lower_set(name(f'labels.{f.name}'))} AS {_col('gs', f.name)}" for f in spec.lists]
    return gold.selectExpr("row_id", *values, *sets)


def compare_fields(gold: DataFrame, preds: DataFrame, spec: RecordSpec, how: str = "inner") -> DataFrame:
    """Every stored answer beside its gold row.

    Per scalar `ok_f`, per list `f1_f`; `object` and `g_f` for reading failures. One equi-join on `row_id`, which is unique
    in gold; `preds` holds at most one answer per (run, row_id). No join hint: the
    optimizer broadcasts a side only under its size threshold, and otherwise
    shuffles and splits skewed keys; tables bucketed by row_id (`sources.stored`) join where they lie.
    """
    both = typed_predictions(preds, spec).join(gold_columns(gold, spec), "row_id", how)
    flags = [f"json_valid AND NOT {_col('odd', f.name)} AND "
             f"{_col('p', f.name)} <=> {_col('g', f.name)} AS {_col('ok', f.name)}"
             for f in spec.scalars]
    flags += [f"CASE WHEN json_valid THEN {X.set_f1(_col('p', f.name), _col('gs', f.name))} "
              f"ELSE 0D END AS {_col('f1', f.name)}" for f in spec.lists]
    return both.selectExpr("run", "row_id", "json_valid", *flags, "object",
                           *[_col("g", f.name) for f in spec.fields])


def scored_answers(gold: DataFrame, preds: DataFrame, spec: RecordSpec, how: str = "inner") -> DataFrame:
    """Five counts per stored answer; an unparseable one keeps its full denominators."""
    correct = " + ".join(f"cast({_col('ok', f.name)} AS int)" for f in spec.scalars) or "0"
    f1_sum = " + ".join(_col("f1", f.name) for f in spec.lists) or "0D"
    return compare_fields(gold, preds, spec, how).selectExpr(
        "run", "row_id", "cast(json_valid AS int) AS json_valid",
        f"{correct} AS scalar_correct", f"{len(spec.scalars)} AS scalar_total",
        f"{f1_sum} AS list_f1_sum", f"{len(spec.lists)} AS list_count")


def _run_names(runs: DataFrame) -> Column:
    """The list of compared runs as one array value."""
    return runs.agg(F.collect_set("run")).scalar()


def listed_answers(preds: DataFrame, runs: DataFrame) -> DataFrame:
    """The answers of the compared runs. Stored by run, the others are not even read."""
    return preds.where(F.array_contains(_run_names(runs), F.col("run")))


def answer_check(gold: DataFrame, preds: DataFrame, runs: DataFrame) -> DataFrame:
    """Per listed run its answers, how many repeat a (run, row_id), and how many gold lacks.

    Metrics assume one answer per (run, row_id), all of gold rows; this tells whether that
    holds. Ids only; repeats are summed before they are shuffled, so a hot id is one row a task.
    """
    per_id = listed_answers(preds, runs).groupBy("run", "row_id").agg(F.count("*").alias("_n"))
    known = gold.select("row_id", F.lit(True).alias("_known"))
    sums = (per_id.join(known, "row_id", "left").groupBy("run")
            .agg(F.sum("_n").alias("n_answers"), F.sum(F.col("_n") - 1).alias("repeated_answers"),
                 F.sum(F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0)).alias("stray_answers")))
    zero = F.lit(0).cast("long")
    return runs.select("run").join(sums, "run", "left").select(
        "run", *[F.coalesce(c, zero).alias(c) for c in ("n_answers", "repeated_answers", "stray_answers")])


def score_rows(gold: DataFrame, preds: DataFrame, runs: DataFrame, spec: RecordSpec) -> DataFrame:
    """One row per (run, gold row); an absent answer scores as unparseable.

    Gold keeps its rows in the join, and the first row of each row_id adds the listed runs that have no answer for it:
    they are told within the partitions that the join has made. So answers and gold are shuffled once each, and
    not at all if they are bucketed by row_id.
    """
    scored = scored_answers(gold, listed_answers(preds, runs), spec, "right")
    of_row = Window.partitionBy("row_id").orderBy("run")
    whole = of_row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    told = scored.withColumns({"_answered": F.collect_set("run").over(whole), "_nth": F.row_number().over(of_row)})
    numbers = [("json_valid", "0"), ("scalar_correct", "0"), ("scalar_total", str(len(spec.scalars))), ("list_f1_sum", "0D"),
               ("list_count", str(len(spec.lists)))]
    own = ", ".join(["run", *[n for n, _ in numbers]])
    absent = ", ".join(["r AS run", *[f"{v} AS {n}" for n, v in numbers]])
    rows = (f"concat(filter(array(struct({own})), x -> x.run IS NOT NULL), "
            f"CASE WHEN _nth = 1 THEN transform(array_except(_runs, _answered), r -> struct({absent})) ELSE array() END)")
    return (told.withColumn("_runs", _run_names(runs)).selectExpr("row_id", f"inline_outer({rows})").where("run IS NOT NULL")
            .select("run", "row_id", *[n for n, _ in numbers]))


def failures(gold: DataFrame, preds: DataFrame, spec: RecordSpec) -> DataFrame:
    """(run, row_id, field, predicted, gold) as JSON text, for each field that is wrong.

    A list field is wrong below F1 = 1. An answer without a valid object gives one
    row with the field name ''. Narrow after the join.
    """
    entries = []
    for f in spec.fields:
        wrong = (f"{_col('f1', f.name)} < 1D" if f.kind == LIST else f"NOT {_col('ok', f.name)}")
        entries.append(f"CASE WHEN {wrong} THEN struct({literal(f.name)} AS field, "
                       f"to_json({X.member('object', f.name)}) AS predicted, "
                       f"{json_value(f.kind, _col('g', f.name))} AS gold) END")
    entry_type = "array<struct<field:string,predicted:string,gold:string>>"
    return compare_fields(gold, preds, spec).selectExpr(
        "run", "row_id",
        f"inline(CASE WHEN json_valid "
        f"THEN cast(array_compact(array({', '.join(entries)})) AS {entry_type}) "
        f"ELSE cast(array(struct('' AS field, NULL AS predicted, NULL AS gold)) AS {entry_type}) "
        f"END)")
