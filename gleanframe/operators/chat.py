"""Chat-format training rows, few-shot blocks, prompts, training targets, lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from gleanframe.functions.json_text import labels_json
from gleanframe.functions.sql import literal, name
from gleanframe.spec import RecordSpec

_TURNS = "array<struct<role:string,content:string>>"


def turns(*pairs: tuple[str, str]) -> str:
    """A message array from roles and content expressions."""
    items = ", ".join(f"struct({literal(role)} AS role, {content} AS content)"
                      for role, content in pairs)
    return f"cast(array({items}) AS {_TURNS})"


def _system(spec: RecordSpec, system: str | None) -> str:
    return literal(spec.system_prompt() if system is None else system)


def to_chat(df: DataFrame, spec: RecordSpec, system: str | None = None) -> DataFrame:
    """Adds `messages`: system, the posting as user, the gold JSON as assistant."""
    messages = turns(("system", _system(spec, system)), ("user", name(spec.text_column)),
                     ("assistant", labels_json(spec)))
    return df.selectExpr("*", f"{messages} AS messages")


def demo_block(demos: DataFrame, spec: RecordSpec) -> DataFrame:
    """One row with `messages`: user and assistant turn of each demo, in rank order.

    Gives an empty list for no demos. `demos` are the few examples of one prompt.
    """
    pair = turns(("user", name(spec.text_column)), ("assistant", labels_json(spec)))
    in_order = "array_sort(collect_list(struct(rank, pair)))"
    return (demos.selectExpr("rank", f"{pair} AS pair")
            .groupBy().agg(F.expr(f"flatten(transform({in_order}, d -> d.pair))").alias("messages")))


def prompts(df: DataFrame, spec: RecordSpec, block: DataFrame | None = None,
            system: str | None = None) -> DataFrame:
    """Adds `messages`: system, then the demos, then the real question.

    The demo block is one value read once, not a join. Without a block the prompt
    is zero-shot.
    """
    head, question = ("system", _system(spec, system)), ("user", name(spec.text_column))
    if block is None:
        return df.selectExpr("*", f"{turns(head, question)} AS messages")
    examples = block.select("messages").scalar()
    return df.withColumn("messages", F.concat(
        F.expr(turns(head)), examples, F.expr(turns(question))))


def loss_targets(chat: DataFrame) -> DataFrame:
    """C4: one row per turn with `is_target`: only assistant turns are trained on."""
    others = [name(c) for c in chat.columns if c != "messages"]
    return (chat.selectExpr(*others, "posexplode(messages) AS (turn, _m)")
            .selectExpr(*others, "turn", "_m.role AS role", "_m.content AS content",
                        "_m.role = 'assistant' AS is_target"))


def loss_spans(chat: DataFrame) -> DataFrame:
    """C4: one row per chat row: characters in all turns, in training targets, and their share.

    Narrow: nothing is exploded. Sum both counts for the share of a whole table.
    """
    others = [name(c) for c in chat.columns if c != "messages"]

    def chars(turns: str) -> str:
        return f"aggregate({turns}, 0L, (n, m) -> n + coalesce(length(m.content), 0))"

    return chat.selectExpr(
        *others, f"{chars('messages')} AS n_chars",
        chars("filter(messages, m -> m.role = 'assistant')") + " AS target_chars",
    ).selectExpr("*", "try_divide(target_chars, n_chars) AS target_share")


def _words(content: str) -> str:
    return f"coalesce(size(filter(split({content}, '[ \\t\\n\\r]+'), w -> w != '')), 0)"


def row_lengths(chat: DataFrame) -> DataFrame:
    """Adds `n_words`, the words of all turns of a row (not model tokens). Narrow."""
    return chat.selectExpr("*", f"aggregate(messages, 0L, (n, m) -> n + greatest(0, {_words('m.content')})) AS n_words")


def prompt_lengths(df: DataFrame, spec: RecordSpec, blocks: Mapping[str, DataFrame | None],
                   system: str | None = None) -> DataFrame:
    """Adds `prompt` and `n_words`, one row per row and prompt style: the lengths of C3's prompts without the prompts.

    `blocks` has the demo block of each style, None for zero-shot. Lengths add up, so the system prompt and each
    block are counted once and the text once for all styles.
    """
    fixed = df.sparkSession.range(1).selectExpr(f"{_words(_system(spec, system))} AS n").scalar()
    own = df.withColumn("_own", F.expr(f"greatest(0, {_words(name(spec.text_column))})") + fixed)
    styles = []
    for style, block in blocks.items():
        extra = F.lit(0) if block is None else row_lengths(block).agg(F.sum("n_words")).scalar()
        styles.append(F.struct(F.lit(style).alias("prompt"), (F.col("_own") + extra).cast("long").alias("n_words")))
    return own.withColumn("_s", F.explode(F.array(*styles))).select(*df.columns, "_s.*")


def length_sketches(lengths: DataFrame, limit: int, *by: str) -> DataFrame:
    """C5, to be kept: per value of `by` the rows, those over `limit`, all words, the largest length, and a
    mergeable sketch of the lengths (KLL, of some kilobytes whatever it has seen)."""
    return lengths.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("n_words") > limit).alias("n_over"),
        F.sum("n_words").alias("words"), F.max("n_words").alias("max_words"), F.kll_sketch_agg_bigint("n_words").alias("lengths"))


def merge_length_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of days, shards or languages as those of the coarser `by`; no length is read again."""
    return sketches.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_over", "words")], F.max("max_words").alias("max_words"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"))


def length_report(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Sketches as numbers: exact counts, mean and maximum, and the quantiles (within 2 % of their ranks)."""
    others = [c for c in sketches.columns if c not in ("words", "lengths")]
    return sketches.select(*others, F.try_divide("words", "n_rows").alias("mean_words"), *[
        F.kll_sketch_get_quantile_bigint("lengths", F.lit(q)).alias(f"p{100 * q:g}_words") for q in quantiles])


def length_budget(chat: DataFrame, limit: int, by: str) -> DataFrame:
    """Per value of `by` (a prompt style, say) the rows, those over `limit` words, and the
    mean, 95th percentile and largest length. Rows over the limit are counted, never cut. Rows that have
    their `n_words` already (`prompt_lengths`) are not counted again.

    The percentile is exact: Spark sums equal lengths before the shuffle.
    """
    lengths = chat if "n_words" in chat.columns else row_lengths(chat)
    return lengths.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.sum((F.col("n_words") > limit).cast("long")).alias("n_over"),
        F.avg("n_words").alias("mean_words"), F.percentile("n_words", F.lit(0.95)).alias("p95_words"),
        F.max("n_words").alias("max_words"))
