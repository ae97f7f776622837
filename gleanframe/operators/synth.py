"""Synthetic gold labels by seeded sampling, one record per id, no shuffle; their audits.

The labels come first and a teacher model writes a posting for them, so they are
right by construction. The call itself stays outside: `teacher_requests` is its
input table and `attach_postings` takes its output table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanframe.functions import draws as D
from gleanframe.functions.json_text import json_value, labels_json
from gleanframe.functions.sql import array, case, literal, name
from gleanframe.operators.chat import turns
from gleanframe.spec import JOB_POSTING, LIST, NUMBER, STRING, RecordSpec


@dataclass(frozen=True)
class Pools:
    """What the sampler draws from. Pass other pools to change or widen the data."""

    roles: Mapping[str, Sequence[str]]
    seniority_weights: Mapping[str, float]
    seniority_titles: Mapping[str, str]
    titles_without_role: Sequence[str]
    employment_weights: Mapping[str, float]
    workplace_weights: Sequence[tuple[str | None, float]]
    cities: Sequence[str]
    companies: Sequence[str]
    currencies: Sequence[str]
    education: Sequence[str | None]
    years: Mapping[str, Sequence[float | None]]
    period_weights: Mapping[str, float]
    salary_low: Mapping[str, tuple[int, int, int]]
    salary_gap: Mapping[str, tuple[int, int, int]]
    p_salary: float
    p_no_max: float
    p_no_min: float
    p_no_location: float
    required_count: tuple[int, int]
    preferred_count: tuple[int, int]


# Pools, weights and number grids of the job posting sampler.
# A number grid is (lowest, step, count).
JOB_POOLS = Pools(
    roles={
        "Backend Engineer": ["Go", "Python", "Java", "PostgreSQL", "Kafka", "Redis", "gRPC",
                             "Docker", "Kubernetes", "AWS"],
        "Frontend Developer": ["React", "TypeScript", "JavaScript", "CSS", "Next.js", "Redux",
                               "GraphQL", "Tailwind"],
        "Data Scientist": ["Python", "SQL", "pandas", "scikit-learn", "PyTorch", "TensorFlow",
                           "Spark", "R"],
        "DevOps Engineer": ["Terraform", "Kubernetes", "AWS", "Docker", "Ansible", "Prometheus",
                            "Linux", "CI/CD"],
        "Mobile Engineer": ["Swift", "Kotlin", "iOS", "Android", "React Native", "GraphQL"],
        "Data Engineer": ["Python", "SQL", "Spark", "Airflow", "dbt", "Snowflake", "Kafka", "AWS"],
        "Machine Learning Engineer": ["Python", "PyTorch", "TensorFlow", "Kubernetes", "MLflow",
                                      "AWS", "SQL"],
        "Product Manager": ["Roadmapping", "Analytics", "SQL", "A/B testing", "Figma",
                            "Stakeholder management"],
    },
    seniority_weights={"intern": 1, "junior": 3, "mid": 4, "senior": 4, "lead": 2, "manager": 2,
                       "executive": 1},
    seniority_titles={"intern": "Intern", "junior": "Junior", "mid": "", "senior": "Senior",
                      "lead": "Lead", "manager": "Engineering Manager",
                      "executive": "VP of Engineering"},
    titles_without_role=["manager", "executive"],
    employment_weights={"full_time": 8, "part_time": 1, "contract": 2, "internship": 0,
                        "temporary": 1},
    workplace_weights=[("remote", 3), ("hybrid", 3), ("onsite", 3), (None, 1)],
    cities=["San Francisco, CA", "Austin, TX", "New York, NY", "Seattle, WA", "London, UK",
            "Berlin, Germany", "Toronto, Canada", "Remote (US)"],
    companies=["Northwind Labs", "Brightside Studio", "Acme Cloud", "Lumen Analytics",
               "Pinecrest Systems", "Harborview Tech", "Cobalt Robotics", "Maplestone Health",
               "Quill Software", "Vantage AI"],
    currencies=["USD", "EUR", "GBP", "CAD"],
    education=[None, None, None, "Bachelor's degree", "Bachelor's in Computer Science",
               "Master's degree", "Master's in a quantitative field"],
    years={"intern": [None, 0], "junior": [1, 2], "mid": [3, 4, 5], "senior": [6, 7, 8],
           "lead": [8, 10, 12], "manager": [8, 10], "executive": [12, 15]},
    period_weights={"year": 6, "month": 1, "hour": 2},
    salary_low={"year": (60000, 5000, 24), "month": (4000, 1000, 10), "hour": (25, 5, 11)},
    salary_gap={"year": (15000, 5000, 9), "month": (1000, 1000, 3), "hour": (10, 5, 6)},
    p_salary=0.7,
    p_no_max=0.15,
    p_no_min=0.10,
    p_no_location=0.4,
    required_count=(2, 5),
    preferred_count=(0, 3),
)


_DRAWS = ("role", "seniority", "employment", "workplace", "location", "city", "company",
          "education", "years", "paid", "currency", "period", "low", "gap", "no_max", "no_min",
          "required", "preferred")


def _between(u: str, bounds: tuple[int, int]) -> str:
    low, high = bounds
    return f"{low} + {D.index_below(u, high - low + 1)}"


def sample_labels(ids: DataFrame, id_col: str, seed: int, pools: Pools = JOB_POOLS) -> DataFrame:
    """F8: (row_id, labels), one sampled record per id.

    Each field is a projection over named draws of (seed, id), so the whole table
    is one narrow stage and any row can be computed again on its own.
    """
    skills = "array(" + ", ".join(array(s) for s in pools.roles.values()) + ")"
    longest = max(len(s) for s in pools.roles.values())
    key = "cast(row_id AS string)"
    rows = ids.selectExpr(f"{name(id_col)} AS row_id")
    drawn = D.with_draws(rows, seed, key, _DRAWS).selectExpr(
        "*", f"{D.shuffle_digest(seed, key, longest)} AS _order")

    # the independent choices.
    chosen = drawn.selectExpr(
        "*",
        f"1 + {D.index_below('u_role', len(pools.roles))} AS role",
        f"{D.choose_weighted('u_seniority', list(pools.seniority_weights.items()))} AS seniority",
        f"{D.choose_weighted('u_workplace', pools.workplace_weights)} AS workplace_type",
        f"{D.choose_weighted('u_period', list(pools.period_weights.items()))} AS period",
        f"u_paid < {literal(pools.p_salary)} AS paid",
        f"{_between('u_required', pools.required_count)} AS n_required",
        f"{_between('u_preferred', pools.preferred_count)} AS n_preferred",
    )
    # what depends on them.
    titled = case("seniority", {s: literal(t) for s, t in pools.seniority_titles.items()})
    low = case("period", {p: D.grid("u_low", *g) for p, g in pools.salary_low.items()})
    gap = case("period", {p: D.grid("u_gap", *g) for p, g in pools.salary_gap.items()})
    shaped = chosen.selectExpr(
        "*",
        f"{titled} AS seniority_title",
        f"element_at({array(pools.roles)}, role) AS role_title",
        f"{low} AS low", f"{gap} AS gap",
        f"{D.shuffled('_order', f'element_at({skills}, role)')} AS skills",
    )
    # null masks, then the record in the declared field order.
    alone = ", ".join(literal(s) for s in pools.titles_without_role)
    years = {s: D.choose("u_years", [None if v is None else float(v) for v in values])
             for s, values in pools.years.items()}
    hired_as = D.choose_weighted("u_employment", list(pools.employment_weights.items()))
    fields = {
        "title": f"CASE WHEN seniority IN ({alone}) THEN seniority_title "
                 "ELSE trim(concat_ws(' ', seniority_title, role_title)) END",
        "company": D.choose("u_company", pools.companies),
        "location": f"CASE WHEN workplace_type IS NOT NULL OR u_location >= "
                    f"{literal(pools.p_no_location)} THEN {D.choose('u_city', pools.cities)} END",
        "workplace_type": "workplace_type",
        "employment_type": f"CASE WHEN seniority = 'intern' THEN 'internship' ELSE {hired_as} END",
        "seniority": "seniority",
        "salary_min": f"CASE WHEN paid AND u_no_min >= {literal(pools.p_no_min)} THEN low END",
        "salary_max": f"CASE WHEN paid AND u_no_max >= {literal(pools.p_no_max)} THEN low + gap END",
        "salary_currency": f"CASE WHEN paid THEN {D.choose('u_currency', pools.currencies)} END",
        "salary_period": "CASE WHEN paid THEN period END",
        "required_skills": "slice(skills, 1, n_required)",
        "preferred_skills": "slice(skills, n_required + 1, n_preferred)",
        "min_years_experience": case("seniority", years),
        "education": D.choose("u_education", pools.education),
    }
    members = ", ".join(f"{fields[f.name]} AS {name(f.name)}" for f in JOB_POSTING.fields)
    return shaped.selectExpr("row_id", f"struct({members}) AS labels")


def sample_label_rows(spark: SparkSession, n: int = 100, seed: int = 42,
                      pools: Pools = JOB_POOLS) -> DataFrame:
    """n records with ids from 0."""
    return sample_labels(spark.range(n), "id", seed, pools)


def teacher_requests(labels: DataFrame, system: str) -> DataFrame:
    """(row_id, messages): the facts of each sampled record as the user turn."""
    messages = turns(("system", literal(system)), ("user", labels_json(JOB_POSTING)))
    return labels.selectExpr("row_id", f"{messages} AS messages")


#: What a reply is trimmed of: all Unicode white space (fixed values).
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
          "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def attach_postings(labels: DataFrame, replies: DataFrame) -> DataFrame:
    """(row_id, posting, labels, status) from the sampled labels and the teacher's replies
    (row_id, raw_text).

    Every record stays: `ok`, `missing` without a reply (or with a null one), or `several`, which
    has no posting, as no reply is chosen for the caller. Replies are summed by id before the join.
    """
    by_id = replies.where("raw_text IS NOT NULL").groupBy("row_id").agg(
        F.count("*").alias("_n"), F.min("raw_text").alias("_text"))
    trimmed = f"trim(BOTH {literal(BLANKS)} FROM _text)"
    return labels.join(by_id, "row_id", "left").selectExpr(
        "row_id", f"CASE WHEN _n = 1 THEN {trimmed} END AS {JOB_POSTING.text_column}", "labels",
        "CASE WHEN _n IS NULL THEN 'missing' WHEN _n > 1 THEN 'several' ELSE 'ok' END AS status")


def coverage_audit(df: DataFrame, spec: RecordSpec = JOB_POSTING) -> DataFrame:
    """(field, value, n_rows) of every allowed value of the closed fields, and of null.

    The list of values is the spec's, so a value that never occurs shows 0. One wide
    aggregate, turned to rows after it.
    """
    counts, rows = [], []
    for i, (field, value) in enumerate((f.name, v) for f in spec.fields if f.domain for v in (*f.domain, None)):
        counts.append(F.expr(f"count_if({name(f'labels.{field}')} <=> {literal(value)})").alias(f"n{i}"))
        rows.append(f"struct({literal(field)} AS field, cast({literal(value)} AS string) AS value, n{i} AS n_rows)")
    return df.agg(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


#: Values that a sketch of frequent ones tracks, and the size of one that counts distinct ones.
_TRACKED, _LG_K = 1_000, 12


def field_sketches(df: DataFrame, spec: RecordSpec = JOB_POSTING, by: Sequence[str] = ()) -> DataFrame:
    """F9 for every field, open ones too: (*by, field, n_rows, n_null, distinct, frequent), to be kept and merged.

    `n_rows` and `n_null` are exact; a null or empty list is null. `distinct` (HyperLogLog) and `frequent` are
    sketches of the values as text, of a list's items one by one; their size does not grow with the table. One
    aggregate by field: tasks sum before the shuffle, so a row of each field leaves a task.
    """
    none = "cast(array() AS array<string>)"
    fields = []
    for f in spec.fields:
        value = name(f"labels.{f.name}")
        text = value if f.kind != NUMBER else json_value(f.kind, value)
        items = (f"coalesce(filter({value}, v -> v IS NOT NULL), {none})" if f.kind == LIST
                 else f"CASE WHEN {value} IS NULL THEN {none} ELSE array({text}) END")
        fields.append(f"struct({literal(f.name)} AS field, {items} AS items)")
    each = (df.selectExpr(*map(name, by), f"inline_outer(array({', '.join(fields)}))")
            .selectExpr(*map(name, by), "field", "posexplode_outer(items) AS (pos, value)"))
    first, null = F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("pos").isNull()
    return each.groupBy(*by, "field").agg(
        F.count_if(first).alias("n_rows"), F.count_if(null).alias("n_null"), F.hll_sketch_agg("value", _LG_K).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(value, {_TRACKED})").alias("frequent"))


def merge_field_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of parts of a table as those of the whole, or of the coarser `by`."""
    return sketches.groupBy(*by, "field").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(frequent, {_TRACKED})").alias("frequent"))


def field_profile(sketches: DataFrame, k: int = 5) -> DataFrame:
    """F9 as numbers: (..., field, n_rows, n_null, null_share, n_distinct, top), `top` the k most frequent values
    with their counts, equal counts in the order of the values.

    Counts of values are exact while a field has no more values than a sketch tracks.
    """
    others = [c for c in sketches.columns if c not in ("distinct", "frequent")]
    found = F.expr(f"approx_top_k_estimate(frequent, {_TRACKED})")
    ordered = F.expr("transform(array_sort(transform(filter(_found, x -> x.item IS NOT NULL), x -> struct(-x.count AS o, x.item AS item))), "
                     "x -> struct(x.item AS value, -x.o AS n_rows))")
    return (sketches.withColumn("_found", F.when(F.col("n_null") < F.col("n_rows"), found))
            .select(*others, F.try_divide("n_null", "n_rows").alias("null_share"), F.hll_sketch_estimate("distinct").alias("n_distinct"),
                    F.coalesce(F.slice(ordered, 1, k), F.expr("cast(array() AS array<struct<value:string,n_rows:bigint>>)")).alias("top")))


#: What a text is cut into: numbers with points or commas inside, and runs of letters, digits, + and #.
_TOKEN = r"'[0-9]+(?:[.,][0-9]+)+|[\\p{L}\\p{N}+#]+'"


def tokens(text: str) -> str:
    """The tokens of a text in lower case; 160,000 is 160000, and 31.50 is 31.5."""
    plain = "CASE WHEN contains(t, ',') AND t RLIKE '^[0-9]{1,3}(,[0-9]{3})+([.][0-9]+)?$' THEN replace(t, ',', '') ELSE t END"
    short = "CASE WHEN contains(t, '.') AND t RLIKE '^[0-9]+[.][0-9]+$' THEN regexp_replace(t, '[.]?0+$', '') ELSE t END"
    return f"transform(transform(regexp_extract_all(lower({text}), {_TOKEN}, 0), t -> {plain}), t -> {short})"


def _phrases(values: str) -> str:
    """Distinct values as their tokens joined by blanks."""
    return f"array_distinct(transform({values}, v -> array_join({tokens('v')}, ' ')))"


#: Values of a field that are searched one by one; more are looked up together in the set of a text's phrases.
_SEARCHED = 64


def grounding(df: DataFrame, spec: RecordSpec = JOB_POSTING,
              known: Mapping[str, Sequence[str]] | None = None, longest: int = 6) -> DataFrame:
    """per row and field (row_id, field, n_stated, n_found, n_mentioned), by search in the text.

    A stated value is found if its tokens stand in the text one after the other: "Go" is not found in
    "Google" nor 5 in "15". Case does not count, full_time is "full-time", and a list states each of its
    distinct items. Short forms and paraphrases count as not found. A null or empty field states
    nothing; `n_mentioned` then tells how many of the values that it could have had stand in the text: those of a
    closed field, and those that `known` lists for an open one. Without such values it gives no row.

    The text is cut once, into a line of its tokens, in which each value of a field is searched. A field of more than
    _SEARCHED values is looked up in the set of the text's phrases of up to `longest` tokens, which is made only for
    such rows; only a longer value is searched by itself. The values to ask for are cut once, when the function is
    called. Narrow.
    """
    none = "cast(array() AS array<string>)"
    asked = {f.name: list(f.domain) or list((known or {}).get(f.name, ())) for f in spec.fields}
    open_to = [f.name for f in spec.fields if asked[f.name]]
    if open_to:
        cut_once = df.sparkSession.sql("SELECT " + ", ".join(_phrases(array(asked[n])) for n in open_to)).first()
        asked.update(zip(open_to, cut_once))
    cut = [f"{tokens(f'coalesce({name(spec.text_column)}, {literal(str())})')} AS _words"]
    for i, f in enumerate(spec.fields):
        value = name(f"labels.{f.name}")
        items = (f"filter({value}, v -> v IS NOT NULL)" if f.kind == LIST
                 else f"array_compact(array({value if f.kind == STRING else json_value(f.kind, value)}))")
        if f.kind == NUMBER:
            items = f"CASE WHEN {value} IS NULL THEN {none} ELSE {items} END"
        cut.append(f"coalesce({_phrases(items)}, {none}) AS _s{i}")
        if asked[f.name]:
            null = f"coalesce(size({value}), 0) <= 0" if f.kind == LIST else f"{value} IS NULL"
            cut.append(f"CASE WHEN {null} THEN {array(asked[f.name])} END AS _a{i}")
    runs = ["_words"] + [f"CASE WHEN size(_words) >= {k} THEN transform(sequence(1, size(_words) - {k - 1}), "
                         f"i -> array_join(slice(_words, i, {k}), ' ')) ELSE {none} END" for k in range(2, longest + 1)]
    looked_up = [f"_s{i}" for i in range(len(spec.fields))] + [f"_a{i}" for i, f in enumerate(spec.fields) if asked[f.name]]
    many = " OR ".join(f"coalesce(size({v}), 0) > {_SEARCHED}" for v in looked_up)
    stands = "contains(_line, concat(' ', v, ' '))"
    rows = []
    for i, f in enumerate(spec.fields):
        found = lambda v: (f"CASE WHEN size({v}) > {_SEARCHED} THEN size(array_intersect({v}, _grams)) + "    # noqa: E731
                           f"size(filter({v}, v -> size(split(v, ' ')) > {longest} AND {stands})) "
                           f"ELSE size(filter({v}, v -> v <> '' AND {stands})) END")
        mentioned = f"CASE WHEN _a{i} IS NULL THEN 0 ELSE {found(f'_a{i}')} END" if asked[f.name] else "0"
        rows.append(f"struct({literal(f.name)} AS field, size(_s{i}) AS n_stated, "
                    f"{found(f'_s{i}')} AS n_found, {mentioned} AS n_mentioned, "
                    f"{f'_a{i} IS NOT NULL' if asked[f.name] else 'false'} AS asked)")
    return (df.selectExpr("row_id", *cut)
            .selectExpr("*", f"CASE WHEN {many} THEN array_distinct(flatten(array({', '.join(runs)}))) ELSE {none} END AS _grams", "concat(' ', array_join(_words, ' '), ' ') AS _line")
            .selectExpr("row_id", f"inline_outer(array({', '.join(rows)}))").where("n_stated > 0 OR asked").drop("asked"))


def grounding_audit(df: DataFrame, spec: RecordSpec = JOB_POSTING, known: Mapping[str, Sequence[str]] | None = None,
                    longest: int = 6) -> DataFrame:
    """per field both halves of "null if not stated": how many stated values are in the text, and how many
    rows leave a field null whose text mentions a value for it.

    `n_rows` rows state the field, `n_null` leave it null and were searched; `clean_share` of these mention no value.
    """
    stated, null = F.col("n_stated") > 0, F.col("n_stated") == 0
    found = grounding(df, spec, known, longest).groupBy("field").agg(
        F.count_if(stated).alias("n_rows"), F.sum("n_stated").alias("n_stated"), F.sum("n_found").alias("n_found"),
        F.count_if(null).alias("n_null"), F.count_if(null & (F.col("n_mentioned") > 0)).alias("n_null_mentioned"))
    return found.withColumn("found_share", F.try_divide("n_found", "n_stated")).withColumn(
        "clean_share", F.try_divide(F.col("n_null") - F.col("n_null_mentioned"), "n_null"))
