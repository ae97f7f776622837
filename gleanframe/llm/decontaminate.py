"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of 10 consecutive words (an item of fewer is one window).
To contain a window a text must hold every shingle of it, so one necessary shingle suffices to
find it: the window's rarest by the number of documents that have it. Then

1. one pass over all documents counts the documents of each benchmark shingle and sets aside the
   stretches of words that may hold a window at all. Both ask bit tables of fixed size, whatever
   the benchmark's, so nothing that grows is sent to the tasks; a wrong yes costs a row only;
2. the stretches are joined with the windows on the necessary shingle;
3. the place of the shingle in the window gives the only start to look at, which must leave room
   for the whole window (positional and length bounds), and the words there must be equal.

Documents are known by (doc_id, hash of the text): rows equal in both have the same findings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanframe.llm.common import (WORD_HASH, column, folded_words, per_batch, staged, text_bytes,
                                   window_hashes)

WINDOW, SHINGLE = 10, 3
#: Bits of the tables of windows and of shingles: 1 MB and 128 KB.
WINDOW_BITS, SHINGLE_BITS = 1 << 23, 1 << 20


def _bit_table(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """One byte per 8 values below `bits`: the set of a column, at most bits / 64 rows on the driver."""
    words = (rows.select(F.col(column).alias("b")).groupBy(F.expr("b div 64").alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 AS int)))").alias("m")).collect())
    table = np.zeros(bits // 64, np.int64)
    for r in words:
        table[r["w"]] = r["m"]
    return table.view(np.uint8)


def _has(table: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id as text, window, length, window_bit, shingles: (shingle, place, bit)) without repeats."""
    def rows(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("item_id", "window", "length", "window_bit", "shingles")}
        for item, text in zip(column(batch, "item_id"), column(batch, "_text")):
            words = folded_words(text)
            n = min(size, len(words))
            hashed = WORD_HASH.array(words)
            bits = window_hashes(hashed, n) % np.uint64(WINDOW_BITS) if n else []
            k = min(SHINGLE, n)
            small = window_hashes(hashed, k) % np.uint64(SHINGLE_BITS) if n else []
            for at in range(len(words) - n + 1 if n else 0):
                out["item_id"].append(item)
                out["window"].append(b" ".join(words[at:at + n]).decode("utf-8", "replace"))
                out["length"].append(n)
                out["window_bit"].append(int(bits[at]))
                out["shingles"].append([
                    {"shingle": b" ".join(words[at + j:at + j + k]).decode("utf-8", "replace"), "place": j,
                     "bit": int(small[at + j])} for j in range(n - k + 1)])
        return out

    made = per_batch(items.select(F.col("item_id").cast("string").alias("item_id"), text_bytes().alias("_text")),
                     rows, "item_id string, window string, length int, window_bit long, "
                           "shingles array<struct<shingle:string,place:int,bit:long>>")
    return staged(made.dropDuplicates(["item_id", "window"]), "decontaminate-windows")


def _first_pass(docs: DataFrame, lengths: list[int], window_table: np.ndarray, shingle_table: np.ndarray) -> DataFrame:
    """Three kinds of rows: a document's word count, a stretch of it, and a shingle's documents."""
    small = sorted({min(SHINGLE, n) for n in lengths})

    def rows(batch: pa.RecordBatch) -> dict:
        kind, owner, keys, n_words, start, text = [], [], [], [], [], []
        having = np.zeros(SHINGLE_BITS, np.int32)
        for i, (key, raw) in enumerate(zip(column(batch, "text_key"), column(batch, "_text"))):
            words = folded_words(raw)
            kind.append(0), owner.append(i), keys.append(key), n_words.append(len(words))
            start.append(None), text.append(None)
            hashed = WORD_HASH.array(words)
            for k in small:
                bits = window_hashes(hashed, k) % np.uint64(SHINGLE_BITS)
                having[np.unique(bits[_has(shingle_table, bits)]).astype(np.int64)] += 1
            cover = np.zeros(len(words) + 1, np.int64)
            for n in lengths:
                found = np.flatnonzero(_has(window_table, window_hashes(hashed, n) % np.uint64(WINDOW_BITS)))
                np.add.at(cover, found, 1)
                np.add.at(cover, found + n, -1)
            inside = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            for a, b in zip(edges[::2], edges[1::2]):
                kind.append(1), owner.append(i), keys.append(key), n_words.append(None)
                start.append(int(a)), text.append(b" ".join(words[a:b]).decode("utf-8", "replace"))
        counted = np.flatnonzero(having)
        more = len(counted)
        ids = batch.column(0).take(pa.array(owner + [None] * more, pa.int64()))
        return {"kind": kind + [2] * more, "doc_id": ids, "text_key": keys + [None] * more,
                "n_words": n_words + having[counted].tolist(), "start": start + counted.tolist(),
                "words": text + [None] * more}

    key = docs.schema["doc_id"].dataType.simpleString()
    return staged(per_batch(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("_text")), rows,
        f"kind int, doc_id {key}, text_key long, n_words long, start long, words string"), "decontaminate-documents")


def find(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit inside any occurrence of a window; items are those with an occurring window.
    Null and empty texts have no words; items without words have no window; items with a null
    item_id hit words but are not listed. An empty benchmark hits nothing, no documents give
    no rows, and repeated rows stay. Other columns are not read.
    """
    windows = windows_of(items, size)
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())        # <= size rows
    window_table = _bit_table(windows, "window_bit", WINDOW_BITS)
    shingles = windows.dropDuplicates(["window"]).select("window", "length", F.inline("shingles"))
    seen = _first_pass(docs, lengths, window_table, _bit_table(shingles, "bit", SHINGLE_BITS))

    rarity = seen.where("kind = 2").groupBy(F.col("start").alias("bit")).agg(F.sum("n_words").alias("n_docs"))
    needed = staged(
        shingles.join(rarity, "bit", "left").groupBy("window", "length")
        .agg(F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "shingle", "place", "bit")).alias("m"))
        .select("window", "length", "m.shingle", "m.place", "m.bit"), "decontaminate-prefixes")
    hits = _verified(seen.where("kind = 1"), needed, size)
    return _report(seen, hits, windows)


def _verified(stretches: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, window, start, length) of all occurrences."""
    prefix_table = _bit_table(needed, "bit", SHINGLE_BITS)
    sizes = sorted(r["n"] for r in needed.select(F.least(F.lit(SHINGLE), "length").alias("n")).distinct().collect())

    def rows(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("text_key", "shingle", "at", "low", "around")}
        owner = []
        for i, (key, start, text) in enumerate(zip(*(column(batch, n) for n in ("text_key", "start", "words")))):
            words = text.split(" ")
            hashed = WORD_HASH.array([w.encode() for w in words])
            for k in sizes:
                bits = window_hashes(hashed, k) % np.uint64(SHINGLE_BITS)
                for p in np.flatnonzero(_has(prefix_table, bits)).tolist():
                    low = max(0, p - size + 1)
                    owner.append(i)
                    out["text_key"].append(key)
                    out["shingle"].append(" ".join(words[p:p + k]))
                    out["at"].append(start + p)
                    out["low"].append(start + low)
                    out["around"].append(words[low:p + size])
        return {"doc_id": batch.column(0).take(pa.array(owner, pa.int64())), **out}

    key = stretches.schema["doc_id"].dataType.simpleString()
    places = per_batch(stretches.select("doc_id", "text_key", "start", "words"), rows,
                       f"doc_id {key}, text_key long, shingle string, at long, low long, around array<string>")
    return (places.join(needed, "shingle")
            .withColumn("start", F.col("at") - F.col("place"))
            .where("start >= low AND start + length <= low + size(around)")
            .where("array_join(slice(around, cast(start - low AS int) + 1, length), ' ') = window")
            .select("doc_id", "text_key", "window", "start", "length").distinct())


def _report(seen: DataFrame, hits: DataFrame, windows: DataFrame) -> DataFrame:
    hits = staged(hits, "decontaminate-hits")
    union = ("aggregate(array_sort(collect_set(struct(start, start + length AS stop))), "
             "named_struct('stop', 0L, 'n', 0L), (a, x) -> named_struct('stop', greatest(a.stop, x.stop), "
             "'n', a.n + greatest(0L, x.stop - greatest(a.stop, x.start))), a -> a.n)")
    key = ["doc_id", "text_key"]
    words = hits.groupBy(*key).agg(F.expr(union).alias("n_hit"))
    items = (hits.select(*key, "window").distinct().join(windows.select("window", "item_id"), "window")
             .groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("_items")))

    def with_key(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({k: f"_{k}" for k in key})
        return (left.join(right, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")),
                          "left").drop("_doc_id", "_text_key"))

    docs = seen.where("kind = 0").select(*key, "n_words")
    found = with_key(words, items)
    none = F.array().cast("array<string>")
    return (with_key(docs, found)
            .withColumn("_items", F.coalesce("_items", none))
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_key"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without any hit, with all their columns as they are."""
    bad = (find(docs, items, size).where("contaminated")
           .select(F.col("doc_id").alias("_gf_id"), F.col("text_key").alias("_gf_key")).distinct())
    keyed = docs.withColumn("_gf_text", F.xxhash64("text"))
    return (keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("_gf_id")) & (F.col("_gf_text") == F.col("_gf_key")),
                       "left_anti").drop("_gf_text"))
