"""Small helpers for writing Spark SQL expressions."""

from __future__ import annotations

from typing import Any


def literal(value: Any) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column or struct member name, quoted part by part."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in column.split("."))


def array(values) -> str:
    return "array(" + ", ".join(literal(v) for v in values) + ")"


def case(of: str, cases: dict[str, str]) -> str:
    """CASE over the values of one expression, NULL for any other value."""
    branches = " ".join(f"WHEN {literal(value)} THEN {result}" for value, result in cases.items())
    return f"CASE {of} {branches} END"
