"""Shards by proportional stratified interleaving.

Rows of a source are put in a seeded random order; a row of rank r among the n rows of its
source stands at the fraction (r + shift) / n, with a shift in [0, 1) drawn per source, and all
rows are sorted by that fraction. Any stretch of the result then holds every source in its
share of the corpus, so shards cut from it at equal row counts all match the mixture.

All steps are DataFrame operations. Neither a source with a third of all rows nor the final
order passes through one task: rows are ranked inside hash buckets of a source, and placed
inside slices of the fraction, whose counts are summed up to the bases of the ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gleanframe.llm.common import staged

#: Rows that one bucket of a source, or one slice of the order, holds on average at most.
GROUP_ROWS = 50_000
ROW_BYTES = 16


def _bases(rows: DataFrame, group: list[str], slot: str, base: str) -> DataFrame:
    """(*group, slot, base): rows of the group in earlier slots; `_all` is the group's size."""
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.groupBy(*group, slot).agg(F.count("*").alias("_n"))
            .select(*group, slot, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(base),
                    F.sum("_n").over(whole).alias("_all")))


def shard(docs: DataFrame, n_shards: int = 40, seed: int = 42, stratum: str = "source") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, stratum.

    `size` is the text's UTF-8 bytes plus 16, a null text having none. The law is `rows`: shard
    sizes differ by one row at most. `slot` is the place in the shard, from 0 without gaps.
    Null is a stratum of its own. Rows equal in doc_id and text may change places, which
    changes nothing. Fewer rows than shards leave shards empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(bytearray()))
    slices = max(1, -(-docs.count() // GROUP_ROWS))     # of the hash, and of the fraction
    rows = docs.select(
        "doc_id", F.col(stratum).cast("string").alias("_s"),
        (F.length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    rows = staged(rows.withColumn("_b", F.pmod("_h", F.lit(slices))), "sharding-rows")

    # Null strata must meet in joins, so they get a flag and a text.
    rows = rows.select("*", F.col("_s").isNull().alias("_null"), F.coalesce("_s", F.lit("")).alias("_key"))
    of = ["_null", "_key"]
    order = ["_h", "doc_id", "size", "text_crc32"]
    within = F.row_number().over(Window.partitionBy(*of, "_b").orderBy(*order)) - 1
    shift = F.pmod(F.xxhash64(F.lit(seed + 1), *of), F.lit(1 << 30)) / float(1 << 30)
    placed = (rows.join(_bases(rows, of, "_b", "_base"), [*of, "_b"])
              .withColumn("_u", (F.col("_base") + within + shift) / F.col("_all"))
              .withColumn("_slice", F.least(F.floor(F.col("_u") * slices), F.lit(slices - 1)))
              .drop("_b", "_base", "_all", "_null", "_key"))
    placed = staged(placed, "sharding-fractions")

    at = F.row_number().over(Window.partitionBy("_slice").orderBy("_u", "_s", *order)) - 1
    position = F.col("_base") + at
    return (placed.join(_bases(placed, [], "_slice", "_base"), "_slice")
            .withColumn("_p", position)
            .withColumn("_shard", F.expr(f"_p * {n_shards} div _all"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.col("_shard").cast("int").alias("shard"),
                    # The first position p with p * n_shards div n equal to the shard.
                    F.expr(f"_p - (_shard * _all + {n_shards - 1}) div {n_shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("_s").alias("stratum")))
