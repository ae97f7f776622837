"""Parse model text into one object; check it, and gold records, against the declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gleanframe.functions import extract as X
from gleanframe.functions.sql import array, literal, name
from gleanframe.session import allow_duplicate_keys
from gleanframe.spec import LIST, STRING, Field, RecordSpec


_BREACHES = "array<struct<field:string,violation:string>>"


def slice_text(df: DataFrame, text: str = "raw_text", into: str = "json_text") -> DataFrame:
    """The span that could hold the object."""
    return df.selectExpr("*", f"{X.slice_json(name(text))} AS {name(into)}")


def parse_object(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds `json_valid` and `object` (VARIANT, NULL where the text has no valid object).

    Valid means it parses, not that it fits the schema. The steps stay separate
    projections so that each row is parsed once whatever is read from it later.
    """
    allow_duplicate_keys(df.sparkSession)
    kept = [name(c) for c in df.columns]
    return (
        slice_text(df, text, "_piece")
        .selectExpr("*", "xxhash64(_piece) AS _seal")
        .selectExpr(*kept, "_seal", f"{X.sealed_array('_piece', '_seal')} AS _array")
        .selectExpr(*kept, "_array", f"{X.is_sealed('_array', '_seal')} AS json_valid")
        .selectExpr(*kept, "json_valid",
                    "CASE WHEN json_valid THEN try_variant_get(_array, '$[0]', 'variant') END"
                    " AS object")
    )


def _breach(field: str, violation: str) -> str:
    return f"struct({field} AS field, {literal(violation)} AS violation)"


def _check(f: Field, types: str = "_t_") -> str:
    """The first breach of one field, else NULL; `types` begins the columns that hold its type."""
    seen, named = name(f"{types}{f.name}"), literal(f.name)
    fits = X.has_kind(seen, f.kind)
    if f.kind == LIST:
        odd = (f"exists(try_variant_get(object, {X.path(f.name)}, 'array<variant>'), "
               "v -> coalesce(schema_of_variant(v), 'VOID') != 'STRING')")
        fits = f"({fits} AND NOT {odd})"
    else:
        fits = f"({fits} AND {seen} != 'BOOLEAN')"
    branches = [f"WHEN {seen} IS NULL THEN {_breach(named, 'missing')}"]
    if not f.nullable:
        branches.append(f"WHEN {seen} = 'VOID' THEN {_breach(named, 'null')}")
    branches.append(f"WHEN {seen} != 'VOID' AND NOT {fits} THEN {_breach(named, 'type')}")
    if f.domain:
        allowed = ", ".join(literal(v) for v in f.domain)
        value = X.member_value("object", f.name, f.kind)
        branches.append(f"WHEN {seen} != 'VOID' AND {value} NOT IN ({allowed}) "
                        f"THEN {_breach(named, 'enum')}")
    return "CASE " + " ".join(branches) + " END"


def validate_schema(preds: DataFrame, spec: RecordSpec) -> DataFrame:
    """D3: one row per breach of the schema: (run, row_id, field, violation).

    not_json, missing, null (where null is not allowed), type, enum, extra.
    Narrow: every breach comes from its own row.
    """
    parsed = parse_object(preds.select("run", "row_id", "raw_text")).selectExpr(
        "run", "row_id", "json_valid", "object",
        "map_keys(try_variant_get(object, '$', 'map<string,variant>')) AS _names",
        *[f"{X.member_type('object', f.name)} AS {name(f'_t_{f.name}')}" for f in spec.fields])
    checks = ", ".join(_check(f) for f in spec.fields)
    known = array(f.name for f in spec.fields)
    extra = f"transform(array_except(_names, {known}), n -> {_breach('n', 'extra')})"
    return parsed.selectExpr(
        "run", "row_id",
        f"inline(CASE WHEN json_valid THEN "
        f"concat(cast(array_compact(array({checks})) AS {_BREACHES}), "
        f"cast({extra} AS {_BREACHES})) "
        f"ELSE cast(array({_breach(literal(''), 'not_json')}) AS {_BREACHES}) END)")


def validate_gold(gold: DataFrame, spec: RecordSpec) -> DataFrame:
    """One row per breach of typed gold or synthetic labels: (row_id, field, violation).

    no_labels (the record has none), null (where null is not allowed, and in a list), enum.
    Types hold already. A missing text is a `null` of the text column. Narrow.
    """
    checks = [f"CASE WHEN {name(spec.text_column)} IS NULL THEN {_breach(literal(spec.text_column), 'null')} END"]
    for f in spec.fields:
        value, named, branches = name(f"labels.{f.name}"), literal(f.name), []
        if not f.nullable:
            branches.append(f"WHEN {value} IS NULL THEN {_breach(named, 'null')}")
        if f.kind == LIST:
            branches.append(f"WHEN exists({value}, v -> v IS NULL) THEN {_breach(named, 'null')}")
        if f.domain:
            branches.append(f"WHEN {value} NOT IN ({', '.join(literal(v) for v in f.domain)}) THEN {_breach(named, 'enum')}")
        if branches:
            checks.append(f"CASE WHEN labels IS NULL THEN NULL {' '.join(branches)} END")
    checks.append(f"CASE WHEN labels IS NULL THEN {_breach(literal('labels'), 'no_labels')} END")
    return gold.selectExpr("row_id", f"inline(cast(array_compact(array({', '.join(checks)})) AS {_BREACHES}))")


def _top_level(spec: RecordSpec) -> str:
    """The breaches of a line's own two members, and members it should not have."""
    checks = []
    for named, fits in ((spec.text_column, "= 'STRING'"), ("labels", "LIKE 'OBJECT%'")):
        seen, field = name(f"_t_{named}"), literal(named)
        checks.append(f"CASE WHEN {seen} IS NULL THEN {_breach(field, 'missing')} WHEN {seen} = 'VOID' THEN {_breach(field, 'null')} "
                      f"WHEN NOT {seen} {fits} THEN {_breach(field, 'type')} END")
    known = array([spec.text_column, "labels"])
    extra = f"transform(array_except(_top, {known}), n -> {_breach('n', 'extra')})"
    return f"concat(cast(array_compact(array({', '.join(checks)})) AS {_BREACHES}), cast({extra} AS {_BREACHES}))"


def checked_lines(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """D4 on raw lines (row_id, value): adds the typed text and labels of each line, and its `breaches`.

    The whole line must be one JSON object, nothing before or after it but blanks; single quotes,
    comments and text after the object make it `not_json`. Its members must be the text (a string) and `labels`
    (an object), which is checked as in D3. Each line is parsed once. Blank lines are dropped, as a
    reader of records drops them.
    """
    allow_duplicate_keys(lines.sparkSession)
    blanks = r"' \t\r\n'"
    parsed = (lines.selectExpr("row_id", "value", f"trim(BOTH {blanks} FROM value) AS _line").where("_line <> ''")
              .selectExpr("row_id", "value", "_line", "xxhash64(_line) AS _seal")
              .selectExpr("row_id", "value", "_line", "_seal", f"{X.sealed_array('_line', '_seal')} AS _array")
              # A seal says that the line is one JSON value, its first letter that the value is an object.
              .selectExpr("row_id", "value", f"CASE WHEN {X.is_sealed('_array', '_seal')} AND startswith(_line, '{{') "
                                             "THEN try_variant_get(_array, '$[0]', 'variant') END AS _record"))
    typed = (parsed
             .selectExpr("row_id", "value", "_record", "map_keys(try_variant_get(_record, '$', 'map<string,variant>')) AS _top",
                         *[f"{X.member_type('_record', n)} AS {name(f'_t_{n}')}" for n in (spec.text_column, "labels")],
                         f"CASE WHEN {X.member_type('_record', 'labels')} LIKE 'OBJECT%' THEN {X.member('_record', 'labels')} END AS object")
             .selectExpr("*", "map_keys(try_variant_get(object, '$', 'map<string,variant>')) AS _names",
                         *[f"{X.member_type('object', f.name)} AS {name(f'_t_labels_{f.name}')}" for f in spec.fields]))
    checks = ", ".join(_check(f, "_t_labels_") for f in spec.fields)
    extra = f"transform(array_except(_names, {array(f.name for f in spec.fields)}), n -> {_breach('n', 'extra')})"
    in_labels = (f"CASE WHEN object IS NULL THEN cast(array() AS {_BREACHES}) ELSE concat("
                 f"cast(array_compact(array({checks})) AS {_BREACHES}), cast({extra} AS {_BREACHES})) END")
    labels = ", ".join(f"{X.member_value('object', f.name, f.kind)} AS {name(f.name)}" for f in spec.fields)
    return typed.selectExpr(
        "row_id", "value", f"{X.member_value('_record', spec.text_column, STRING)} AS {name(spec.text_column)}",
        f"CASE WHEN object IS NOT NULL THEN struct({labels}) END AS labels",
        f"CASE WHEN _record IS NULL THEN cast(array({_breach(literal(''), 'not_json')}) AS {_BREACHES}) "
        f"ELSE concat({_top_level(spec)}, {in_labels}) END AS breaches")


def validate_lines(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """One row per breach of a raw line: (row_id, field, violation).

    not_json, missing, null, type, enum and extra, of the line's own members and of its labels.
    """
    # An outer one: for a plain one the optimizer would copy the whole check into a filter on its size.
    return checked_lines(lines, spec).selectExpr("row_id", "inline_outer(breaches)").where("violation IS NOT NULL")


def records_of_lines(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """(row_id, text, labels) of the lines without any breach: every line is here or among the breaches."""
    return checked_lines(lines, spec).where("size(breaches) = 0").select("row_id", spec.text_column, "labels")


def count_breaches(breaches: DataFrame) -> DataFrame:
    """(field, violation, n_rows) of D3 or D4 breaches."""
    return breaches.groupBy("field", "violation").count().withColumnRenamed("count", "n_rows")
