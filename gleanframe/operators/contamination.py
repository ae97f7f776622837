"""Word n-grams of evaluation items that occur in training texts, from both sides.

The items' distinct n-grams are an inverted index. A text meets it with its own distinct n-grams and keeps
those it shares; texts that share the same ones are summed to one row before an item is
looked up, so a passage that a third of all texts hold costs no more than one that a single text holds.
N-grams travel as 64-bit hashes, texts and items never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleanframe.functions.sql import name


def ngrams(text: str, n: int) -> Column:
    """The distinct hashes of all runs of n words of a text, without regard to case and blanks.

    A text of fewer words, or null, has none.
    """
    words = f"filter(split(lower({name(text)}), '[ \\\\t\\\\n\\\\r]+'), w -> w != '')"
    runs = f"transform(sequence(1, size(w) - {n - 1}), i -> xxhash64(slice(w, i, {n})))"
    none = "cast(array() AS array<bigint>)"
    # `transform` over one element names the words, so that a text is split once.
    return F.expr(f"coalesce(array_distinct(flatten(transform(array({words}), w -> "
                  f"CASE WHEN size(w) >= {n} THEN {runs} ELSE {none} END))), {none})")


def item_index(items: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(item, gram): each distinct n-gram of an item once; rows of one item are one item."""
    return items.select(F.col(key).alias("item"), F.explode(ngrams(text, n)).alias("gram")).distinct()


def shared_grams(texts: DataFrame, index: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(text_id, n_grams, grams): of every text its number of distinct n-grams and the sorted ones that
    the index has. Rows of one id are one text; `n_grams` is then that of its longest row.

    An n-gram of the index is one row beside the texts, however many items have it. The join has no
    hint: an index under the optimizer's size threshold is broadcast, and then what is
    shuffled is one row per text; a larger one is joined by hash, its hot keys split at run time.
    """
    known = index.select("gram").distinct().withColumn("hit", F.col("gram"))
    own = texts.select(F.col(key).alias("text_id"), ngrams(text, n).alias("_g")).select(
        "text_id", F.size("_g").cast("long").alias("n_grams"), F.explode_outer("_g").alias("gram"))
    return (own.join(known, "gram", "left").groupBy("text_id")
            .agg(F.max("n_grams").alias("n_grams"), F.array_sort(F.collect_set("hit")).alias("grams")))


def text_contamination(texts: DataFrame, items: DataFrame, n: int = 8, text_key: str = "doc_id", item_key: str = "item_id",
                       text: str = "text", item_text: str = "text") -> DataFrame:
    """B8 by text: (text_id, n_grams, n_shared, shared_share), one row per text.

    The share of a text's distinct n-grams that some item has; null without n-grams.
    """
    shared = shared_grams(texts, item_index(items, item_key, item_text, n), text_key, text, n)
    return shared.select("text_id", "n_grams", F.size("grams").cast("long").alias("n_shared")).withColumn(
        "shared_share", F.try_divide("n_shared", "n_grams"))


def item_contamination(texts: DataFrame, items: DataFrame, n: int = 8, text_key: str = "doc_id", item_key: str = "item_id",
                       text: str = "text", item_text: str = "text") -> DataFrame:
    """B8 by item: (item, n_grams, n_found, found_share, n_texts, most_texts), one row per item.

    The share of an item's distinct n-grams that occur anywhere in the texts, the texts that hold any of
    them, and the texts that hold its most common one. Items of fewer than n words have no
    n-grams, and so a null share.
    """
    index = item_index(items, item_key, item_text, n)
    # Texts that share the same n-grams with the items are one row from here on.
    classes = (shared_grams(texts, index, text_key, text, n).where("size(grams) > 0").groupBy("grams")
               .agg(F.count("*").alias("texts"))
               .select(F.xxhash64("grams").alias("class"), "texts", F.explode("grams").alias("gram")))
    by_gram = classes.groupBy("gram").agg(F.sum("texts").alias("texts"))
    found = index.join(by_gram, "gram").groupBy("item").agg(F.count("*").alias("n_found"), F.max("texts").alias("most_texts"))
    holding = (index.join(classes, "gram").select("item", "class", "texts").distinct()
               .groupBy("item").agg(F.sum("texts").alias("n_texts")))
    counted = index.groupBy("item").agg(F.count("*").alias("n_grams"))
    zero = F.lit(0).cast("long")
    out = items.select(F.col(item_key).alias("item")).distinct()
    for part in (counted, found, holding):
        part = part.withColumnRenamed("item", "_item")
        out = out.join(part, F.col("item").eqNullSafe(F.col("_item")), "left").drop("_item")
    return out.select("item", *[F.coalesce(c, zero).alias(c) for c in ("n_grams", "n_found")],
                      F.when(F.col("n_grams") > 0, F.coalesce("n_found", zero) / F.col("n_grams")).alias("found_share"),
                      *[F.coalesce(c, zero).alias(c) for c in ("n_texts", "most_texts")])
