"""Training sets by data source, with gold-only evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanframe.operators.split import text_key

MODES = ("hand", "synthetic", "mixed")


def mix(hand: DataFrame, synthetic: DataFrame, mode: str) -> DataFrame:
    """one training set; `source` tells where a row is from. Copies are kept."""
    parts = {"hand": hand.withColumn("source", F.lit("hand")),
             "synthetic": synthetic.withColumn("source", F.lit("synthetic"))}
    if mode in parts:
        return parts[mode]
    if mode != "mixed":
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return parts["hand"].unionByName(parts["synthetic"])


def mix_table(hand: DataFrame, synthetic: DataFrame) -> DataFrame:
    """all three training sets in one table by `mode`; each input is read once."""
    def under(df: DataFrame, source: str) -> DataFrame:
        modes = F.array(F.lit(source), F.lit("mixed"))
        return df.withColumn("source", F.lit(source)).withColumn("mode", F.explode(modes))

    return under(hand, "hand").unionByName(under(synthetic, "synthetic"))


def mix_counts(mixed: DataFrame) -> DataFrame:
    """Training rows per mode."""
    return mixed.groupBy("mode").agg(F.count("*").alias("train_rows"))


def experiment_rows(hand_splits: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Hand rows in their splits plus synthetic rows, which only ever join train."""
    return (hand_splits.withColumn("source", F.lit("hand"))
            .unionByName(synthetic.withColumn("split", F.lit("train"))
                         .withColumn("source", F.lit("synthetic"))))


def eval_purity(rows: DataFrame, text: str = "text") -> DataFrame:
    """(row_id, text_key) of the synthetic rows that bring an evaluation text into play.

    A row is listed if it is in val or test itself, or if its normalised text is that of a val
    or test row. An empty result is a clean evaluation. Hashes and ids are shuffled, not texts.
    """
    keyed = rows.select("row_id", "split", "source", text_key(text).alias("text_key"))
    evaluated = keyed.where("split IN ('val', 'test')")
    synthetic = keyed.where("source = 'synthetic'").select("row_id", "text_key")
    return synthetic.join(evaluated.select("text_key").distinct(), "text_key", "left_semi").select("row_id", "text_key")
