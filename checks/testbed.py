"""Gold records and model answers derived from the given tables, for checks and timing only.

The tables hold no postings, so `documents` and `labels` stand in: every document
is a record to extract, and ten runs answer it with known kinds of errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanframe.functions import json_text as J
from gleanframe.functions.draws import choose, with_draws
from gleanframe.spec import LIST, NUMBER, Field, RecordSpec

DOC_SPEC = RecordSpec(
    fields=(
        Field("lang", nullable=False, domain=("en", "fr", "de", "es")),
        Field("source", nullable=False),
        Field("n_chars", NUMBER, nullable=False),
        Field("quality", NUMBER),
        Field("toxic", NUMBER),
        Field("band", domain=("good", "poor")),
        Field("last_terms", LIST, nullable=False),
        Field("more_terms", LIST, nullable=False),
    ),
    prompt_head="Describe the document as one JSON object of this shape:",
    prompt_tail="Use null for what is unknown.",
)

# run, comparison, model, prompt, train_rows, source, epochs
RUNS = (
    ("base_zero", "prompting", "base", "zero", 0, None, 0),
    ("base_few", "prompting", "base", "few", 0, None, 0),
    ("tuned_zero", "prompting", "tuned", "zero", 14, "hand", 5),
    ("tuned_few", "prompting", "tuned", "few", 14, "hand", 5),
    ("size_5", "size", "tuned", "zero", 5, "hand", 5),
    ("size_10", "size", "tuned", "zero", 10, "hand", 5),
    ("size_14", "size", "tuned", "zero", 14, "hand", 5),
    ("src_hand", "source", "tuned", "zero", 14, "hand", 3),
    ("src_synthetic", "source", "tuned", "zero", 100, "synthetic", 3),
    ("src_mixed", "source", "tuned", "zero", 114, "mixed", 3),
)
KNOBS = ("model", "prompt", "train_rows", "source", "epochs")

ERROR_RATES = {
    "base_zero": 0.6, "base_few": 0.35, "tuned_zero": 0.2, "tuned_few": 0.15,
    "size_5": 0.5, "size_10": 0.3, "size_14": 0.2,
    "src_hand": 0.25, "src_synthetic": 0.3, "src_mixed": 0.1,
}
ERROR_KINDS = (
    "prose", "missing", "number_text", "truncated", "single_quotes", "trailing", "changed",
    "recased", "dropped_item", "no_text", "list_as_text", "bool_number", "extra", "null_required",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The keys of a table, spread over the cluster: a table of one file has one scan task.

    The number is given, as without one adaptive execution merges partitions of so few bytes again, down to
    one task for millions of keys.
    """
    return table(spark, sf_dir, name).select(key).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def run_config(spark: SparkSession) -> DataFrame:
    def text(v):
        return "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"

    rows = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in RUNS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS "
                     "t(run, comparison, model, prompt, train_rows, source, epochs)")


def doc_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, posting, labels). The list fields are the last distinct words in text order."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    terms = "sort_array(array_distinct(split(text, ' ')), false)"
    return docs.selectExpr("*", f"{terms} AS _terms").selectExpr(
        "doc_id AS row_id", "text AS posting",
        "struct(lang, source, cast(n_chars AS double) AS n_chars, "
        "cast(quality AS double) AS quality, cast(toxic AS double) AS toxic, "
        "CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS band, "
        "slice(_terms, 1, 4) AS last_terms, "
        "slice(_terms, 5, cast(n_chars % 3 AS int)) AS more_terms) AS labels")


def _answer() -> str:
    """The raw object of one answer: the gold object with the error named by `kind`."""
    normal = {f.name: J.json_value(f.kind, f"labels.{f.name}") for f in DOC_SPEC.fields}
    value = dict(normal)
    value["lang"] = (f"CASE kind WHEN 'changed' THEN '\"xx\"' WHEN 'null_required' THEN 'null' "
                     f"ELSE {normal['lang']} END")
    value["n_chars"] = (f"CASE kind WHEN 'missing' THEN NULL "
                        f"WHEN 'number_text' THEN concat('\"', {normal['n_chars']}, '\"') "
                        f"ELSE {normal['n_chars']} END")
    value["quality"] = (f"CASE WHEN kind != 'bool_number' THEN {normal['quality']} "
                        "WHEN labels.quality = 0 THEN 'false' ELSE 'true' END")
    value["last_terms"] = (
        f"CASE kind WHEN 'recased' THEN {J.json_list('transform(labels.last_terms, x -> lower(x))')} "
        f"WHEN 'dropped_item' THEN {J.json_list('slice(labels.last_terms, 2, 9)')} "
        f"WHEN 'list_as_text' THEN {J.json_string('array_join(labels.last_terms, chr(32))')} "
        f"ELSE {normal['last_terms']} END")
    value["note"] = "CASE kind WHEN 'extra' THEN '\"x\"' END"
    return J.json_object(list(value.items()))


def doc_preds(gold: DataFrame) -> DataFrame:
    """(run, row_id, raw_text): ten runs over all gold rows.

    The run `src_hand` answered the documents of `labels` only, so it lacks answers. The rows are
    spread by (run, row_id), as answers arrive as a table of their own and not beside gold.
    """
    rates = "array(" + ", ".join(f"struct('{r}' AS run, {ERROR_RATES[r]}D AS rate)"
                                 for r, *_ in RUNS) + ")"
    asked = (gold.selectExpr("row_id", "labels", f"inline({rates})")
             .where("run != 'src_hand' OR labels.quality IS NOT NULL").repartition("run", "row_id"))
    drawn = with_draws(asked, 7, "concat_ws(':', run, row_id)", ["err", "kind", "fence"])
    return drawn.selectExpr(
        "run", "row_id", "labels",
        f"CASE WHEN u_err < rate THEN {choose('u_kind', ERROR_KINDS)} "
        "WHEN u_fence < 0.3D THEN 'fenced' ELSE 'plain' END AS kind",
    ).selectExpr("run", "row_id", "kind", f"{_answer()} AS body").selectExpr(
        "run", "row_id",
        "CASE kind WHEN 'fenced' THEN concat('```json\n', body, '\n```') "
        "WHEN 'prose' THEN concat('Here it is: ', body, ' Done.') "
        "WHEN 'truncated' THEN substring(body, 1, length(body) - 5) "
        "WHEN 'single_quotes' THEN replace(body, '\"', \"'\") "
        "WHEN 'trailing' THEN concat(body, ' {\"lang\": \"en\"}') "
        "WHEN 'no_text' THEN NULL ELSE body END AS raw_text")


def origin_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents in two parts by `source`: src0 to src9 stand for hand, the rest for synthetic."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "text", F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("_n"))
    hand = docs.where(F.col("_n") < 10).drop("_n")
    synthetic = docs.where(~F.coalesce(F.col("_n") < 10, F.lit(False))).drop("_n")
    return hand, synthetic


