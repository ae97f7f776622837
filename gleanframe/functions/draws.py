"""Seeded draws as pure functions of a row's key, written as Spark SQL expressions.

A value depends only on (seed, key, draw name), so it is the same on any
partitioning, after a retry on another executor, and in any other SQL engine.
Expressions for the key are passed as SQL text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame

from gleanframe.functions.sql import array, literal

_HEX_PER_DRAW = 8                # 32 bits
_HEX_PER_ITEM = 6                # 24 bits order the items of a short list


def digest(seed: int, key: str, *parts: Any) -> str:
    """md5 of seed, key and parts joined by ':'."""
    tail = "".join(f", {literal(str(p))}" for p in parts)
    return f"md5(concat_ws(':', '{seed}', {key}{tail}))"


def order_key(seed: int, key: str) -> str:
    """Sort key of a seeded shuffle: 128 bits, so distinct keys do not tie."""
    return digest(seed, key)


def _fraction(digest_sql: str, start: int) -> str:
    bits = f"conv(substring({digest_sql}, {start}, {_HEX_PER_DRAW}), 16, 10)"
    return f"(cast({bits} AS double) / 4294967296D)"


def uniform(seed: int, key: str, draw: str) -> str:
    """A number in [0, 1) for this row and draw name."""
    return _fraction(digest(seed, key, draw), 1)


def with_draws(df: DataFrame, seed: int, key: str, names: Sequence[str]) -> DataFrame:
    """Adds `u_<name>` in [0, 1) for each name, the number that `uniform` gives for that name.

    The draws are columns of their own, so a later CASE over one does not hash again.
    """
    return df.selectExpr("*", *[f"{uniform(seed, key, n)} AS u_{n}" for n in names])


def index_below(u: str, n: int) -> str:
    return f"cast(floor({u} * {n}) AS int)"


def choose(u: str, values: Sequence[Any]) -> str:
    """Uniform choice; a value listed twice weighs double, None is a value."""
    return f"element_at({array(values)}, 1 + {index_below(u, len(values))})"


def choose_weighted(u: str, weighted: Sequence[tuple[Any, float]]) -> str:
    """Choice in proportion to the weights; a value of weight 0 never comes."""
    total = float(sum(w for _, w in weighted))
    drawn = [(v, w) for v, w in weighted if w > 0]
    upto, branches = 0.0, []
    for value, weight in drawn[:-1]:
        upto += weight
        branches.append(f"WHEN {u} < {literal(upto / total)} THEN {literal(value)}")
    last = literal(drawn[-1][0])
    return f"CASE {' '.join(branches)} ELSE {last} END" if branches else last


def grid(u: str, low: int, step: int, n: int) -> str:
    """One of the n numbers low, low + step, ..."""
    return f"cast({low} + {step} * {index_below(u, n)} AS double)"


def shuffle_digest(seed: int, key: str, longest: int) -> str:
    """Hex digits enough to order a list of up to `longest` items."""
    blocks = math.ceil(longest * _HEX_PER_ITEM / 32)
    return "concat(" + ", ".join(digest(seed, key, "order", b) for b in range(blocks)) + ")"


def shuffled(digest_sql: str, values: str) -> str:
    """The list in the order of its items' shares of the digest."""
    tagged = (f"transform({values}, (s, i) -> struct("
              f"substring({digest_sql}, 1 + {_HEX_PER_ITEM} * i, {_HEX_PER_ITEM}) AS d, s AS s))")
    return f"transform(array_sort({tagged}), t -> t.s)"
