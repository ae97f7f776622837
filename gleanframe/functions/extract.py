"""Pulling one JSON object out of free model text, and typed access to its fields.

All arguments and results are Spark SQL text.
"""

from __future__ import annotations

from gleanframe.functions.sql import literal
from gleanframe.spec import NUMBER, STRING


def slice_json(text: str) -> str:
    """From the first '{' to the last '}'; NULL if either is missing, '' if they cross.

    Cuts off what lies before and after by two plain searches, so the time is linear
    in the text, unlike with a backtracking regex.
    """
    before = f"length(substring_index({text}, '{{', 1))"
    after = f"length(substring_index({text}, '}}', -1))"
    return (f"CASE WHEN contains({text}, '{{') AND contains({text}, '}}') THEN substring({text}, "
            f"{before} + 1, greatest(0, length({text}) - {before} - {after})) END")


def sealed_array(piece: str, seal: str) -> str:
    """`[piece, seal]` parsed as one JSON array.

    The parser ignores text after the value it has read. The seal, a hash of the
    piece, sits at the very end: it is element 1 only if the parser read the whole
    piece as exactly one value.
    """
    return f"try_parse_json(concat('[', {piece}, ',', {seal}, ']'))"


def is_sealed(array: str, seal: str) -> str:
    return f"coalesce(try_variant_get({array}, '$[1]', 'bigint') = {seal}, false)"


def path(member: str) -> str:
    return literal(f"$['{member}']")


def member(obj: str, field: str) -> str:
    return f"try_variant_get({obj}, {path(field)}, 'variant')"


def member_type(obj: str, field: str) -> str:
    """Type name of a member; NULL when it is missing, VOID when it is null."""
    return f"schema_of_variant({member(obj, field)})"


def has_kind(type_name: str, kind: str) -> str:
    """Whether a member of that type can equal a gold value of the kind.

    Truth values count as the numbers 1 and 0; text never equals a number.
    """
    if kind == STRING:
        return f"{type_name} = 'STRING'"
    if kind == NUMBER:
        return (f"({type_name} IN ('BIGINT', 'DOUBLE', 'BOOLEAN') "
                f"OR startswith({type_name}, 'DECIMAL'))")
    return f"startswith({type_name}, 'ARRAY')"


def member_value(obj: str, field: str, kind: str) -> str:
    spark_type = {STRING: "string", NUMBER: "double"}.get(kind, "array<string>")
    return f"try_variant_get({obj}, {path(field)}, '{spark_type}')"


def lower_set(values: str) -> str:
    """Distinct lower-cased items without nulls; a NULL list is the empty set."""
    return (f"coalesce(array_except(transform({values}, x -> lower(x)), "
            f"array(cast(NULL AS string))), cast(array() AS array<string>))")


def set_f1(left: str, right: str) -> str:
    """Harmonic mean of precision and recall of two sets; 1 when both are empty."""
    total = f"(size({left}) + size({right}))"
    return (f"CASE WHEN {total} = 0 THEN 1D "
            f"ELSE 2D * size(array_intersect({left}, {right})) / {total} END")
