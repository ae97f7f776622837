"""Seeded, leak-free splits and nested training subsets; B6: what leaks between splits.

Rows are ordered by a hash of (seed, key); the first n_test are test, the next
n_val validation, the rest train. No step moves whole rows: the cut points of
the order are found on the hash column alone, and the table is then labelled in
one narrow pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleanframe.functions.draws import order_key, uniform
from gleanframe.functions.sql import literal, name
from gleanframe.session import staged

_LEVELS = (4, 8)     # hex digits: 65,536 even buckets, then 65,536 in each that holds a cut


def rank_cuts(digests: DataFrame, ranks: Sequence[int], weight: str | None = None) -> DataFrame:
    """(rank, cut, upto): the digest at each 1-based rank of the sorted column `split_key`, and
    the rows up to it and its equals. With `weight` a row counts as that many.

    An exact selection without a global sort. Counts per digest prefix say which prefix holds
    each rank, then counts of the next digits inside it; what is left, one digest in 2^32, is
    counted and sorted. Every level counts before it shuffles, so a digest that most rows share is
    one row per task. A rank past the end gives no row.
    """
    wanted = "array(" + ", ".join(f"{r}L" for r in sorted(set(ranks))) + ")"
    size = F.count("*") if weight is None else F.sum(weight)
    digests = digests.select("split_key", *([weight] if weight else []))
    held = None
    for level in (*_LEVELS, None):
        part = F.col("split_key") if level is None else F.substring("split_key", 1, level)
        if held is None:
            counts = digests.groupBy(part.alias("part")).agg(size.alias("n"))
            counts = counts.select("part", "n", F.lit(0).cast("long").alias("before"), F.expr(f"explode({wanted})").alias("rank"))
        else:
            counts = (digests.withColumn("held", F.substring("split_key", 1, width))
                      .join(F.broadcast(held), "held").groupBy("rank", "before", part.alias("part"))
                      .agg(size.alias("n")))
        running = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        found = (counts.withColumn("upto", F.col("before") + F.sum("n").over(running))
                 .where("rank > upto - n AND rank <= upto"))
        if level is None:
            return found.select("rank", F.col("part").alias("cut"), "upto")
        # One row for each of the ranks.
        held, width = found.select("rank", F.col("part").alias("held"), (F.col("upto") - F.col("n")).alias("before")), level
    raise AssertionError


def _cut_map(digests: DataFrame, ranks: Sequence[int], exact: bool = False) -> Column:
    """The cuts as one map value, at most len(ranks) entries."""
    cut = F.expr("CASE WHEN upto > rank THEN raise_error('a key repeats across a cut; use split_grouped') ELSE cut END")
    entries = F.collect_list(F.struct("rank", cut.alias("cut") if exact else F.col("cut")))
    return rank_cuts(digests, ranks).agg(F.map_from_entries(entries)).scalar()


def _split(keyed: DataFrame, n_test: int, n_val: int, exact: bool) -> DataFrame:
    """Adds `split` to rows with a `split_key`."""
    ranks = [r for r in (n_test, n_test + n_val) if r > 0]
    if not ranks:
        return keyed.withColumn("split", F.lit("train"))
    held_out = n_test + n_val
    cuts = _cut_map(keyed.select("split_key"), ranks, exact)
    missing = f"raise_error('table has fewer than {held_out} rows to split off')"
    label = (f"CASE WHEN split_key > coalesce(try_element_at(_cuts, {held_out}L), {missing}) "
             f"THEN 'train' WHEN split_key <= try_element_at(_cuts, {n_test}L) THEN 'test' "
             "ELSE 'val' END")
    return keyed.withColumn("_cuts", cuts).withColumn("split", F.expr(label)).drop("_cuts")


def split_exact(df: DataFrame, key: str, seed: int, n_test: int, n_val: int) -> DataFrame:
    """B1: adds `split` and `split_key`; exactly n_test and n_val rows, for any table size.

    A key that repeats across a cut would break the sizes: that raises an error when the
    result is computed, as do fewer rows than n_test + n_val.
    """
    return _split(df.withColumn("split_key", F.expr(order_key(seed, name(key)))), n_test, n_val, True)


def text_key(text: str = "text") -> Column:
    """Hash of a text without regard to case and blanks; null text has none."""
    return F.expr(f"md5(trim(regexp_replace(lower({name(text)}), '[ \\t\\n\\r]+', ' ')))")


#: Rows left to fill from which on the last groups are chosen on the driver, among at most a few thousand.
_LAST_ROWS = 1_000


def _fill(groups: DataFrame, size: int, last_rows: int) -> DataFrame:
    """The groups (split_key, n) that make up `size` rows, in the order of their keys.

    Each group is taken if it fits into what is left, and passed over otherwise. Up to the first that does
    not fit this is a cut at a rank, found on counts; then it goes on behind that one, among
    groups that fit what is left. As soon as that is `last_rows` rows, the first left / n groups of each size n can matter
    and no others, left * (1 + 1/2 + ... ) in all: those are gone through one by one. If rows are left
    when no group fits, the smallest group that is not taken comes on top.
    """
    left, after, taken = size, "", []
    while left > last_rows:
        fit = groups.where((F.col("split_key") > after) & (F.col("n") <= left))
        cut = rank_cuts(fit, [left + 1], "n").first()
        upto = fit if cut is None else fit.where(F.col("split_key") < cut["cut"])
        taken.append(upto)
        left -= upto.agg(F.sum("n")).first()[0] or 0
        if cut is None:
            break
        after = cut["cut"]
    else:
        nth = F.row_number().over(Window.partitionBy("n").orderBy("split_key"))
        some = (groups.where((F.col("split_key") > after) & (F.col("n") <= left)).withColumn("_nth", nth)
                .where(f"_nth <= {max(left, 1)} AND _nth * n <= {left}"))
        fitting = []
        for row in sorted(some.select("split_key", "n").collect()):
            if row["n"] <= left:
                fitting.append((row["split_key"], row["n"]))
                left -= row["n"]
        taken.append(groups.sparkSession.createDataFrame(fitting, groups.schema))
    chosen = taken[0]
    for more in taken[1:]:
        chosen = chosen.unionByName(more)
    if left > 0:
        rest = groups.join(chosen.select("split_key"), "split_key", "left_anti").orderBy("n", "split_key").limit(1)
        chosen = chosen.unionByName(rest)
    chosen = staged(chosen, "split-groups")
    if left > 0 and (chosen.agg(F.sum("n")).first()[0] or 0) < size:
        raise ValueError(f"table has too few rows to split off {size}")
    return chosen


def split_grouped(df: DataFrame, seed: int, n_test: int, n_val: int, text: str = "text",
                  group_key: str | None = None, last_rows: int = _LAST_ROWS) -> DataFrame:
    """As B1, but all rows of one group land in one split; adds `split` and `split_key`.

    A group is a normalised text, or the value of any column `group_key`; rows without one (null) are one
    group. Groups go in seeded order, whole, to test until it has n_test rows, then those left to
    validation. A group larger than what is left to fill is passed over, so the sizes are exact unless no group
    fits; then the smallest one completes them. Groups are counted once, in a job of its own, and every cut is made on
    the staged counts; the labels come from a table of the groups held out, in one pass over the rows.
    """
    group = text_key(text) if group_key is None else F.concat(F.lit("="), F.col(group_key).cast("string"))
    keyed = df.withColumn("_group", F.coalesce(group, F.lit(""))).withColumn("split_key", F.expr(order_key(seed, "_group"))).drop("_group")
    groups = staged(keyed.groupBy("split_key").agg(F.count("*").alias("n")), "split-sizes")
    held = None
    for part, size in (("test", n_test), ("val", n_val)):
        if size > 0:
            left = groups if held is None else groups.join(held.select("split_key"), "split_key", "left_anti")
            mine = _fill(left, size, last_rows).select("split_key", F.lit(part).alias("split"))
            held = mine if held is None else held.unionByName(mine)
    if held is None:
        return keyed.withColumn("split", F.lit("train"))
    return keyed.join(held, "split_key", "left").select(
        *df.columns, "split_key", F.coalesce("split", F.lit("train")).alias("split"))


def leakage_audit(parts: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, splits, n_rows) of every normalised text that is in more than one split.

    Hashes and split names are shuffled, never texts, and summed before.
    """
    shared = parts.select(text_key(text).alias("text_key"), "split").where("text_key IS NOT NULL")
    return (shared.groupBy("text_key").agg(F.array_sort(F.collect_set("split")).alias("_s"), F.count("*").alias("n_rows"))
            .where(F.size("_s") > 1)
            .select("text_key", F.array_join("_s", ",").alias("splits"), "n_rows"))


def split_fraction(df: DataFrame, key: str, seed: int, fractions: Mapping[str, float],
                   rest: str = "train") -> DataFrame:
    """B2: the split by shares instead of counts: one narrow pass, no cut points."""
    if sum(fractions.values()) > 1:
        raise ValueError("the shares add up to more than 1")
    drawn = df.withColumn("_u", F.expr(uniform(seed, name(key), "split")))
    upto, branches = 0.0, ["WHEN false THEN NULL"]
    for part, share in fractions.items():
        upto += share
        branches.append(f"WHEN _u < {literal(upto)} THEN {literal(part)}")
    label = f"CASE {' '.join(branches)} ELSE {literal(rest)} END"
    return drawn.withColumn("split", F.expr(label)).drop("_u")


def prefix_subsets(train: DataFrame, key: str, seed: int, sizes: Sequence[int]) -> DataFrame:
    """Nested prefixes of the train order, one row per (train_size, member).

    A size above the table gives all rows, as a slice does.
    """
    keyed = train.withColumn("split_key", F.expr(order_key(seed, name(key))))
    wanted = sorted({s for s in sizes if s > 0})
    if not wanted:
        return keyed.withColumn("train_size", F.lit(0)).where(F.lit(False))
    cuts = _cut_map(keyed.select("split_key"), wanted)
    labelled = keyed.withColumn("_cuts", cuts)
    sizes_sql = "array(" + ", ".join(f"{s}L" for s in wanted) + ")"
    return labelled.selectExpr(
        *[name(c) for c in keyed.columns],
        f"explode(filter({sizes_sql}, s -> coalesce(split_key <= try_element_at(_cuts, s), true)))"
        " AS train_size")


def demos(train: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """The first n rows of the train order, with their `rank` from 1.

    n is the number of examples in one prompt, so the ranked rows are few.
    """
    first = (train.withColumn("split_key", F.expr(order_key(seed, name(key))))
             .orderBy("split_key").limit(n))
    return first.withColumn("rank", F.row_number().over(Window.orderBy("split_key")))
