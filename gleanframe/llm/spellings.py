"""Spelling variants by pairs of trie nodes.

Words go into two tries, one from the front and one from the back. Two words differ by a replaced
code point exactly if some position, when skipped, lies between the same prefix node and the same suffix node in both, and by
an inserted one if the nodes around a skipped position of one meet at a gap of the other. So every
word gives integer pairs (prefix node, suffix node), and an equality join of the pairs gives
all near words and no others. Skipped positions of a pair differ in one code point only, so a pair is shared by no
more words than the alphabet has letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gleanframe.llm.common import dense_ids, release, ship_package, staged

SHORTEST, LEAST, MORE, EVERY = 7, 2, 10, 31
#: A subtree with more words is dealt to tasks by its children.
SUBTREE_WORDS = 200_000
#: Code points whose node is numbered by themselves, and by which subtrees are dealt at first.
_OWN, _DEALT = 7, 3
_HELD = 200_000                       # distinct words counted before they are sent
_DEPTH_BITS = 24

_ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """(id, word, n): words of `shortest` code points or more that occur `least` times, ids dense. Staged.

    One in `every` pairs of document and run, by crc32, loses a code point of the run. Runs shorter
    than `shortest` cannot become words.
    """
    pattern = re.compile("[A-Za-zÀ-ÿ]{%d,}" % shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for word, n in Counter(pattern.findall((text.as_py() or "").translate(_ASCII))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < shortest:
                            continue
                    held[word] += n
                if len(held) >= _HELD:
                    yield out()
        yield out()

    ship_package(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    often = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "spelling-counted")
    words = staged(dense_ids(often, "word"), "spelling-words")
    release(often)
    return words


def _dealt(words: DataFrame, column: str, most: int) -> DataFrame:
    """The words sorted inside partitions that hold whole subtrees of the trie, with `depth`, the length of the
    prefix that a subtree is known by: the shortest (by threes) that `most` words share at most."""
    depth = F.lit(_DEALT)
    while True:
        dealt = words.withColumn("depth", depth).withColumn("_root", F.expr(f"substring({column}, 1, depth)"))
        # At most words / `most` rows; a root that is a whole word holds no subtree.
        large = (dealt.groupBy("_root", "depth").agg(F.count("*").alias("_n"), F.max(F.length(column)).alias("_long"))
                 .where(f"_n > {most} AND _long > depth").select("_root"))
        roots = [r["_root"] for r in large.limit(10_000).collect()]
        if not roots:
            return dealt.repartition("_root").sortWithinPartitions(column).drop("_root")
        words = dealt.withColumn("depth", F.when(F.col("_root").isin(roots), F.col("depth") + _DEALT).otherwise(F.col("depth"))).drop("_root")
        words = staged(words, "spelling-dealt")
        depth = F.col("depth")


def _top(prefix: bytes) -> int:
    """The number of a node near the root: its letters themselves, or a hash of more of them. Below 0."""
    if len(prefix) <= _OWN:
        return -(int.from_bytes(b"\1" + prefix, "big") + 1)
    return -(xxhash.xxh3_64_intdigest(prefix) >> 2 | 1 << 61) - 1


def node_numbers(words: Iterator[tuple[int, bytes, int]]) -> Iterator[np.ndarray]:
    """The numbers of the nodes of depth 0, 1, ... of each word (id, letters, depth of its root), in sorted order.

    Down to its root's depth a node is numbered by its letters. Below, where all words of the node are
    in this task, by the first word that passes it and its depth.
    """
    before, numbers = b"", np.empty(0, np.int64)
    tops: dict[bytes, int] = {}
    for word_id, word, depth in words:
        made = (word_id << _DEPTH_BITS) + np.arange(len(word) + 1)
        short = min(len(word), len(before))
        if word[:depth] == before[:depth] and short >= depth:
            other = np.flatnonzero(np.frombuffer(word, np.uint8, short) != np.frombuffer(before, np.uint8, short))
            shared = int(other[0]) if len(other) else short
            made[:shared + 1] = numbers[:shared + 1]
        else:
            if len(tops) > 100_000:
                tops.clear()
            for i in range(min(depth, len(word)) + 1):
                prefix = word[:i]
                if prefix not in tops:
                    tops[prefix] = _top(prefix)
                made[i] = tops[prefix]
        yield made
        before, numbers = word, made


def _numbered(dealt: DataFrame, column: str, name: str) -> DataFrame:
    """(id, word, and as `name` the array of node numbers of `column`'s letters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, numbers in _by_batch(batches, column):
            values = pa.array(np.concatenate(numbers) if numbers else np.empty(0, np.int64))
            ends = pa.array(np.cumsum([0, *map(len, numbers)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("word"), pa.ListArray.from_arrays(ends, values)],
                                             names=["id", "word", name])

    return dealt.select(*dict.fromkeys(["id", "word", column, "depth"])).mapInArrow(run, f"id long, word string, {name} array<long>")


def _by_batch(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the node numbers of its words; nodes go on from batch to batch."""
    sizes: list[pa.RecordBatch] = []

    def words() -> Iterator[tuple[int, bytes, int]]:
        for batch in batches:
            sizes.append(batch)
            yield from zip(batch.column("id").to_pylist(), (w.encode("latin-1") for w in batch.column(column).to_pylist()),
                           batch.column("depth").to_pylist())

    made: list[np.ndarray] = []
    for numbers in node_numbers(words()):
        made.append(numbers)
        if len(made) == sizes[0].num_rows:
            yield sizes.pop(0), made
            made = []
        while sizes and not sizes[0].num_rows:
            sizes.pop(0)


def near_pairs(words: DataFrame, most: int = SUBTREE_WORDS) -> DataFrame:
    """(a, b): ids of words that differ by one replaced, inserted or deleted code point, a < b. Staged."""
    ship_package(words.sparkSession)
    front = _numbered(_dealt(words.select("id", "word"), "word", most), "word", "front")
    back = _dealt(staged(front.withColumn("turned", F.reverse("word")), "spelling-front"), "turned", most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, numbers in _by_batch(batches, "turned"):
            lists = batch.column("front")
            starts, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            ids = batch.column("id").to_numpy()
            prefix, suffix, gap, owner = [], [], [], []
            for i, back_nodes in enumerate(numbers):
                m, p = len(back_nodes) - 1, flat[starts[i]:starts[i + 1]]
                s = back_nodes[::-1]                         # s[j]: the suffix from position j
                prefix += [p[:m], p]
                suffix += [s[1:], s]
                gap += [np.zeros(m, bool), np.ones(m + 1, bool)]
                owner.append(np.full(2 * m + 1, ids[i]))
            join = lambda x, t: np.concatenate(x) if x else np.empty(0, t)      # noqa: E731
            yield pa.RecordBatch.from_arrays([pa.array(join(prefix, np.int64)), pa.array(join(suffix, np.int64)),
                                              pa.array(join(gap, bool)), pa.array(join(owner, np.int64))],
                                             names=["prefix", "suffix", "gap", "id"])

    entries = back.select("id", "word", "turned", "depth", "front").mapInArrow(run, "prefix long, suffix long, gap boolean, id long")
    # Skipped positions and gaps of one pair of nodes: letters of the alphabet at most, and one gap.
    together = entries.groupBy("prefix", "suffix").agg(
        F.collect_list(F.when(~F.col("gap"), F.col("id"))).alias("skipped"), F.max(F.when(F.col("gap"), F.col("id"))).alias("gap"),
    ).where("size(skipped) > 1 OR size(skipped) = 1 AND gap IS NOT NULL")
    pairs = together.select(F.expr(
        "inline(concat(flatten(transform(skipped, x -> transform(filter(skipped, y -> y > x), y -> struct(x AS a, y AS b)))), "
        "if(gap IS NULL, array(), transform(skipped, x -> struct(least(x, gap) AS a, greatest(x, gap) AS b)))))"))
    return staged(pairs.distinct(), "spelling-pairs")


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, more: int = MORE, every: int = EVERY,
             most: int = SUBTREE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): spellings of whole `docs` and what each is a variant of.

    A word's form is its near word of largest n (the first in code-point order among several), if
    that occurs `more` times as often; forms are followed to the last, the root, which without a form
    is the word. Null and empty texts have no runs; a null doc_id counts as an empty one; repeated rows
    count as often as they come; no documents give no rows. Other columns are not read. Nodes of more
    than seven letters above a subtree that is dealt further are known by a hash; all other numbers are exact.
    """
    words = word_counts(docs, shortest, least, every)
    pairs = near_pairs(words, most)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.join(words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n")), "b")
    best = ranked.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("_o"), "form", "form_n")).alias("m"))
    formed = words.join(best, words["id"] == best["a"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("m.form_n") >= more * F.col("n"), F.col("m.form")).alias("form"),
        F.when(F.col("m.form_n") >= more * F.col("n"), F.col("m.form_n")).alias("form_n"))
    formed = staged(formed, "spelling-forms")
    release(pairs, words)
    # Every step of a chain is `more` times as frequent, so a few doublings reach its end.
    to = staged(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = to.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        doubled = staged(to.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                                  F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        release(to)
        to = doubled.drop("moved")
        to._gleanframe_path = doubled._gleanframe_path
        if doubled.where("moved").isEmpty():
            break
    return formed.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
