"""JSON text with ", " and ": " separators, raw non-ASCII, nulls kept, whole numbers without a point.

`to_json` would write 160000.0 for a double and no spaces. The text is a training
target, so its bytes matter, not only its value. All arguments are SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from gleanframe.functions.sql import literal, name
from gleanframe.spec import LIST, NUMBER, RecordSpec


def json_string(x: str) -> str:
    """A quoted string or null: the only item of a JSON array, without its brackets.

    The item starts and ends with a quote, so no bracket of its own is trimmed.
    """
    return f"trim(BOTH '[]' FROM to_json(array({x})))"


def json_number(x: str) -> str:
    return (f"CASE WHEN abs({x}) < 1e18D AND {x} = floor({x}) "
            f"THEN cast(cast({x} AS bigint) AS string) "
            f"ELSE coalesce(cast({x} AS string), 'null') END")


def json_list(x: str) -> str:
    items = f"array_join(transform({x}, s -> {json_string('s')}), ', ')"
    return f"coalesce(concat('[', {items}, ']'), 'null')"


def json_value(kind: str, x: str) -> str:
    return {LIST: json_list, NUMBER: json_number}.get(kind, json_string)(x)


def json_object(pairs: Sequence[tuple[str, str]]) -> str:
    """An object from names and expressions of JSON text; a NULL text leaves its name out."""
    members = []
    for key, text in pairs:
        head = literal(f'"{key}": ')
        members.append(f"concat({head}, {text})")
    return "concat('{', concat_ws(', ', " + ", ".join(members) + "), '}')"


def labels_json(spec: RecordSpec, labels: str = "labels") -> str:
    return json_object([(f.name, json_value(f.kind, name(f"{labels}.{f.name}")))
                        for f in spec.fields])


def record_json(spec: RecordSpec) -> str:
    return json_object([(spec.text_column, json_string(name(spec.text_column))),
                        ("labels", labels_json(spec))])
