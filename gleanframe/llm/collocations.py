"""Phrase collocations by counting quotient filters.

Texts are read once, into blocks of word ids. A phrase as frequent as LEAST consists of words and
shorter phrases that are, so level by level every block counts in filters only what can still
be frequent; filters of one shard of the permuted numbers are merged as sorted lists, and each block gets
back one bit for each of its entries. Nothing is broadcast and no dictionary is held by a task:
a block's own distinct words meet the frequent ones in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gleanframe.llm import quotient as Q
from gleanframe.llm.common import dense_ids, release, ship_package, staged, text_bytes

LEAST, LONGEST, TOP, PERCENT = 100, 5, 2_000, 100
#: Words of a block, about.
BLOCK_WORDS = 1 << 20
#: Blocks' worth of words, of all languages, that a task holds before all of them are sent.
HELD_BLOCKS = 4
#: Filter entries that one task merges, about.
SHARD_ENTRIES = 1 << 22
_CHUNK = 1 << 20                      # bytes of a text that are split at once
_KNOWN = np.uint32(1 << 31)           # marks a position at which a phrase of the level before is frequent

#: A-Z are lowered, tabs are blanks, and every separator of pieces is a line feed.
_FOLD = bytes(0x0A if b in b".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b
              for b in range(256))


class _Ids(dict):
    """Numbers from 2 for the words of a block; 0 is no word and 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _numbered(text: bytes, ids: _Ids) -> Iterator[np.ndarray]:
    """The numbers of a whole text's words, with ends of pieces."""
    start = 0
    while start < len(text):
        stop = start + _CHUNK
        if stop < len(text):
            blank = min((p for p in (text.find(b" ", stop), text.find(b"\n", stop), text.find(b"\t", stop)) if p >= 0),
                        default=len(text))
            stop = blank
        words = text[start:stop].translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(ids.__getitem__, words), np.uint32, len(words))
        yield found[found > 0]
        start = stop


def blocks_of(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, lang, words, counts, stream): distinct words of a block and the order they come in. Staged.

    A block holds documents of one language from one task. In `stream` a word is its place in
    `words` from 1, and 0 ends a piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[_Ids, list[np.ndarray]]] = {}
        size: Counter[str] = Counter()
        total = 0

        def out(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal block, total
            for lang in langs:
                ids, parts = held.pop(lang)
                size.pop(lang)
                stream = np.concatenate(parts)
                counts = np.bincount(stream, minlength=len(ids))[2:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([lang]), pa.array([list(ids)[2:]], pa.list_(pa.binary())),
                     pa.array([counts], pa.list_(pa.int64())), pa.array([(stream - 1).astype("<u4").tobytes()])],
                    names=["block", "lang", "words", "counts", "stream"])
                block += 1
                total -= len(stream)

        end = np.ones(1, np.uint32)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                ids, parts = held.setdefault(lang, (_Ids(), []))
                for part in (*_numbered(text.as_py(), ids), end):
                    parts.append(part)
                    size[lang] += len(part)
                    total += len(part)
                if size[lang] >= block_words:
                    yield from out([lang])
                elif total >= HELD_BLOCKS * block_words:
                    yield from out(list(held))
        yield from out(list(held))

    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_bytes().alias("_text"))
    return staged(texts.mapInArrow(run, "block long, lang string, words array<binary>, counts array<long>, stream binary"),
                  "phrases-blocks")


def frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, f) of words with `f` of `least` or more; ids are dense from 1. Staged."""
    counted = staged(blocks.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("word"))
                     .agg(F.sum("counts").alias("f")).where(F.col("f") >= least), "phrases-counted")
    words = staged(dense_ids(counted, "lang", "word").select("id", "lang", "word", "f"), "phrases-words")
    release(counted)
    return words


def _first_state(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """(block, state): the stream of a block in ids of frequent words, 0 for a break. Staged."""
    own = blocks.select("block", "lang", F.posexplode("words").alias("pos", "word"))
    # A row for each word of a block, found or not; the list drops those that are not, in the tasks.
    known = own.join(words.select("lang", "word", "id"), ["lang", "word"], "left").groupBy("block").agg(
        F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "id"))).alias("ids"))  # words of one block

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(1)[i].values
                stream = np.frombuffer(batch.column(2)[i].as_buffer(), "<u4")
                to = np.zeros(int(stream.max(initial=0)) + 1, np.uint32)
                place = ids.field("pos").to_numpy() + 1
                inside = place < len(to)
                to[place[inside]] = ids.field("id").to_numpy()[inside]
                made = _squeezed(to[stream])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([made.astype("<u4").tobytes()])],
                                                 names=["block", "state"])

    return staged(known.join(blocks.select("block", "stream"), "block").select("block", "ids", "stream")
                  .mapInArrow(rows, "block long, state binary"), "phrases-state")


def _squeezed(state: np.ndarray) -> np.ndarray:
    """Without breaks beside breaks."""
    keep = np.ones(len(state), bool)
    keep[1:] = (state[1:] > 0) | (state[:-1] > 0)
    return state[keep]


def _grams(state: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, high, low): the permuted numbers of the n-grams of a block that may be frequent."""
    ids, m = state & ~_KNOWN, len(state) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    usable = np.ones(m, bool)
    for i in range(n):
        usable &= ids[i:m + i] > 0
    if n > 2:
        known = state >= _KNOWN
        usable &= known[:m] & known[1:m + 1]
    starts = np.flatnonzero(usable)
    left, right = Q.pack(np.stack([ids[starts + i] for i in range(n)], 1), bits)
    half = Q.half_bits(n, bits)
    return starts, *Q.joined(*Q.permute(left, right, half), half)


def _shards(high: np.ndarray, low: np.ndarray, total: int, shard_bits: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of sorted numbers."""
    if not len(low):
        return []
    shard = Q.shifted(high, low, total - shard_bits).astype(np.int64) if shard_bits else np.zeros(len(low), np.int64)
    begin = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return list(zip(shard[begin].tolist(), begin.tolist(), np.append(begin[1:], len(low)).tolist()))


def _level(state: DataFrame, n: int, bits: int, shard_bits: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, bitmaps): (ids, f) of the n-grams as frequent as `least`, and (block, shard, bitmap) of
    the entries of each block's filters that are. Both are in one staged table."""
    total = 2 * Q.half_bits(n, bits)
    shard_bits = min(shard_bits, total - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0), batch.column(1)):
                _, high, low = _grams(np.frombuffer(packed.as_buffer(), "<u4"), n, bits)
                high, low, counts, _ = Q.counted(high, low)
                rest = total - shard_bits
                made = [(s, Q.Filter(*Q.lower(high[a:b], low[a:b], rest), counts[a:b], rest).pack())
                        for s, a, b in _shards(high, low, total, shard_bits)]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(made), pa.int64()),
                                                  pa.array([s for s, _ in made], pa.int64()),
                                                  pa.array([f for _, f in made], pa.binary())], names=["block", "shard", "filter"])

    def merge(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        whole, places = Q.merged([Q.Filter.unpack(x) for x in table["filter"].to_pylist()])
        often = whole.count >= least
        high, low, rest = whole.high[often], whole.low[often], total - shard_bits
        if shard_bits and rest < 64:
            low = low | np.uint64(shard << rest & 0xFFFFFFFFFFFFFFFF)
        if shard_bits and rest + shard_bits > 64:
            high = high | np.uint64(shard << rest >> 64)
        half = Q.half_bits(n, bits)
        ids = Q.unpack(*Q.restore(*Q.parted(high, low, half), half), n, bits)
        m, blocks = int(often.sum()), table.num_rows
        return pa.table({"block": pa.concat_arrays([*table["block"].chunks, pa.nulls(m, pa.int64())]),
                         "shard": pa.array([shard] * (blocks + m), pa.int64()),
                         "bitmap": pa.array([np.packbits(often[p]).tobytes() for p in places] + [None] * m, pa.binary()),
                         "ids": pa.array([None] * blocks + ids.tolist(), pa.list_(pa.int64())),
                         "f": pa.array([None] * blocks + whole.count[often].tolist(), pa.int64())})

    found = staged(state.mapInArrow(count, "block long, shard long, filter binary").groupBy("shard").applyInArrow(
        merge, "block long, shard long, bitmap binary, ids array<long>, f long"), f"phrases-{n}")
    return found.where("ids IS NOT NULL").select("ids", "f"), found.where("block IS NOT NULL").select("block", "shard", "bitmap")


def _next_state(state: DataFrame, bitmaps: DataFrame, n: int, bits: int, shard_bits: int) -> DataFrame:
    """The blocks with what lies in frequent n-grams, their starts marked. Staged."""
    total = 2 * Q.half_bits(n, bits)
    shard_bits = min(shard_bits, total - 1)

    def rows(old: pa.Table, marks: pa.Table) -> pa.Table:
        made = []
        for block, packed in zip(old["block"].to_pylist(), old["state"].to_pylist()):
            state = np.frombuffer(packed, "<u4")
            often = dict(zip(marks["shard"].to_pylist(), marks["bitmap"].to_pylist()))
            starts, high, low = _grams(state, n, bits)
            high, low, _, place = Q.counted(high, low)
            bit = [np.unpackbits(np.frombuffer(often[shard], np.uint8), count=b - a)
                   for shard, a, b in _shards(high, low, total, shard_bits)]
            starts = starts[np.concatenate(bit).astype(bool)[place]] if bit else starts
            cover = np.zeros(len(state) + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + n, -1)
            new = np.where(np.cumsum(cover)[:-1] > 0, state & ~_KNOWN, np.uint32(0))
            new[starts] |= _KNOWN
            made.append((block, _squeezed(new).astype("<u4").tobytes()))
        return pa.table({"block": pa.array([b for b, _ in made], pa.int64()), "state": pa.array([s for _, s in made], pa.binary())})

    return staged(state.groupBy("block").cogroup(bitmaps.groupBy("block")).applyInArrow(rows, "block long, state binary"),
                  "phrases-state")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_words: int = BLOCK_WORDS,
                     shard_entries: int = SHARD_ENTRIES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): (id, lang, word, f), (ids, f) of 1 to `longest` words, and (lang, n). Staged."""
    blocks = blocks_of(docs, block_words)
    totals = staged(blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
                    .groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    words = frequent_words(blocks, least)
    bits = max(1, int(words.count()).bit_length())
    if bits > Q.MOST_BITS:
        raise ValueError(f"more than {2 ** Q.MOST_BITS} words are frequent: raise `least`")
    state = _first_state(blocks, words)
    release(blocks)
    entries = state.agg(F.sum(F.length("state"))).first()[0] or 0                        # one number
    shard_bits = max(0, (entries // 4 // shard_entries).bit_length())
    found = words.select(F.array("id").alias("ids"), "f")
    for n in range(2, longest + 1):
        phrases, bitmaps = _level(state, n, bits, shard_bits, least)
        found = found.unionByName(phrases)
        if n < longest:
            old, state = state, _next_state(state, bitmaps, n, bits, shard_bits)
            release(old)
    release(state)
    return words, staged(found, "phrases-found"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT,
                 block_words: int = BLOCK_WORDS, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that hold together best.

    A phrase has 2 to `longest` words of one piece and occurs a >= `least` times; l and r are the
    occurrences of the parts of its worst cut, n all words of the language, the score
    1000 * a * n / (l * r), rounded down, exact beyond 64 bits. Dropped are phrases inside a longer one
    that occurs `percent` % as often. Null and empty texts have no words, a null lang is `und`, repeated
    rows count as often as they come, and no documents or no frequent phrase give no rows. Other columns
    are not read. Words are told apart in full, phrases by their permuted number in full.
    """
    words, found, totals = frequent_phrases(docs, least, longest, block_words, shard_entries)
    phrases = found.where("size(ids) > 1").select("ids", F.col("f").alias("a"))
    inside = phrases.where("size(ids) > 2").select("a", F.expr(
        "inline(flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), "
        "s -> struct(slice(ids, s, m) AS ids)))))")).groupBy("ids").agg(F.max("a").alias("_longer"))
    kept = phrases.join(inside, "ids", "left").where(f"_longer IS NULL OR 100 * _longer < {percent} * a").select("ids", "a")
    cuts = kept.select("ids", "a", F.expr("inline(transform(sequence(1, size(ids) - 1), k -> struct(k AS k, "
                                          "slice(ids, 1, k) AS first, slice(ids, k + 1, size(ids) - k) AS rest)))"))
    part = lambda name, f: found.select(F.col("ids").alias(name), F.col("f").alias(f))       # noqa: E731
    language = words.select(F.col("id").alias("_id"), "lang").join(totals, "lang")
    scored = (cuts.join(part("first", "l"), "first").join(part("rest", "r"), "rest")
              .withColumn("_id", F.col("ids")[0]).join(language, "_id"))
    big = lambda c: f"cast({c} AS decimal(18, 0))"                                           # noqa: E731
    score = F.expr(f"({big('1000 * a')} * {big('n')}) div ({big('l')} * {big('r')})")
    worst = scored.groupBy("ids").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n", "lang")).alias("m")).select("ids", "m.*")
    spelled = (worst.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "word"), "id").groupBy("ids")
               .agg(F.expr("array_join(transform(array_sort(collect_list(struct(pos, cast(word AS string) AS word))), w -> w.word), ' ')")
                    .alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (worst.join(spelled, "ids").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
