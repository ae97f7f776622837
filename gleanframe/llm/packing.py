"""Packing of tokenized documents into sequences of one length: shortest pack first.

1. Every document is tokenized once, cut where a sequence is full, and its pieces are staged.
2. The histogram of piece lengths (at most `size` rows, whatever the corpus) goes to the driver.
   Lengths are placed from the longest to the shortest, each on the packs that are filled least;
   a pack is opened only when none has room. Equal packs are handled as one interval of
   sequence ids (a packing pattern and its count), so the work depends on `size`, not on rows.
3. Pieces of one length are ranked, and the rank says which pattern slot a piece takes. Ranks
   are counted per (length, hash bucket) first, so that a length which a third of all
   documents share is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gleanframe.llm.common import Cached, column, per_batch, staged, text_bytes

SIZE = 4096
END = 2
#: Pieces that one (length, bucket) group holds on average at most.
GROUP_ROWS = 50_000


#: A-Z lowered, line feeds as blanks.
_PARTS = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x0A else b for b in range(256))


@lru_cache(1)
def _encoder(path: str):
    """Little-endian 32-bit ids of a part of a text, remembered by part."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer, to_bytes = Tokenizer.from_file(path), ByteLevel(add_prefix_space=False, use_regex=False)
    model = tokenizer.model

    def ids(part: bytes) -> bytes:
        if part[-1:] in (b".", b",") and part[-2:-1].isalpha():
            return known[part[:-1]] + known[part[-1:]]    # a mark after a letter is its own token
        word = part.decode()
        if word.isalpha() and max(word) < "\u0250" and word.lower() == word:
            if not word.isascii():                        # one Latin word: nothing to cut or compose
                word = to_bytes.pre_tokenize_str(word)[0][0]
            found = [t.id for t in model.tokenize(word)]
        else:
            found = tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    known = Cached(ids)
    return known


def encode(text: bytes, path: str) -> bytes:
    """Little-endian 32-bit ids of a text, as the whole text's encoding gives them.

    The tokenizer lowers letters and drops white space, and no token spans white space. So a
    text is encoded as its parts between blanks and line feeds with A-Z lowered, and a part
    that came before is not encoded again. Other white space and letters are the tokenizer's
    own matter.
    """
    return b"".join(map(_encoder(path).__getitem__, text.translate(_PARTS).split(b" ")))


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document cut at `size` ids.

    A document is its ids and `end`; null text is empty, so each document has a piece.
    """
    stop = np.array([end], "<u4").tobytes()

    def rows(batch: pa.RecordBatch) -> dict:
        owner, start, length, crc, total = [], [], [], [], []
        for i, text in enumerate(column(batch, "_text")):
            ids = encode(text, tokenizer) + stop
            n = len(ids) // 4
            for at in range(0, n, size):
                part = ids[4 * at:4 * (at + size)]
                owner.append(i)
                start.append(at)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                total.append(n)
        of = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(owner, pa.int64()))
        return {"doc_id": of, "start": start, "length": length, "ids_crc32": crc, "doc_tokens": total}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", text_bytes().alias("_text")), rows,
                     f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long")


def place(histogram: dict[int, int], size: int = SIZE) -> tuple[list[tuple], int]:
    """Shortest pack first over {length: count}: slots, and the number of sequences.

    A slot (length, first rank, first sequence, packs, copies, offset) says: from that rank on,
    packs * copies pieces of the length go to `packs` consecutive sequences, `copies` in each,
    one after the other from the offset. At most 3 groups of equal packs arise per length and
    a pack holds fewer than sqrt(2 * size) different lengths, which bounds the slots by
    3 * size * sqrt(2 * size) for any corpus.
    """
    by_gap: dict[int, list[tuple[int, int]]] = {}        # room left: [(first sequence, packs)]
    slots, sequences = [], 0

    def keep(gap: int, first: int, packs: int) -> None:
        if packs and gap:
            by_gap.setdefault(gap, []).append((first, packs))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def put(gap: int, first: int, packs: int, left: int, rank: int) -> int:
            """Pieces taken by a group of equal packs: full copies, and one pack with the rest."""
            most = gap // length
            if left < packs:                            # one each, as the others are as short
                packs_used, copies = left, 1
                keep(gap, first + left, packs - left)
            else:
                copies = min(most, left // packs)
                packs_used = packs
            slots.append((length, rank, first, packs_used, copies, size - gap))
            keep(gap - copies * length, first, packs_used)
            return packs_used * copies

        while left:
            gap = max((g for g in by_gap if g >= length), default=0)
            if gap:
                group = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
                took = put(gap, *group, left, rank)
            else:
                most = size // length
                packs = max(1, left // most)
                took = put(size, sequences, packs, left, rank)
                sequences += packs
            left, rank = left - took, rank + took
    return slots, sequences


def ranked(rows: DataFrame, key: str, order: list, n_rows: int) -> DataFrame:
    """Adds `rank` from 0 within each value of `key`, in some fixed order of the rows.

    Groups of (key, hash of the row) are counted, their counts summed along the buckets of a
    key, and rows ranked inside their group: no task holds all rows of one key.
    """
    buckets = max(1, -(-n_rows // GROUP_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_bucket")
                              .rowsBetween(Window.unboundedPreceding, -1))
    bases = (rows.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
             .withColumn("_base", F.coalesce(before, F.lit(0))).drop("_n"))
    place_in = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order)) - 1
    return (rows.join(bases, [key, "_bucket"]).withColumn("rank", F.col("_base") + place_in)
            .drop("_bucket", "_base"))


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one token. Rows with equal or null doc_id are documents of their
    own. An empty table gives no rows. Other columns are not read.
    """
    cut = staged(pieces(docs, tokenizer, size, end), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}   # <= size rows
    slots, _ = place(histogram, size)
    made = np.array(sorted(slots), np.int64).reshape(-1, 6)
    keys = made[:, 0] << 40 | made[:, 1]

    kept = cut.columns

    def rows(batch: pa.RecordBatch) -> dict:
        got = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        length, rank = got["length"].to_numpy(), got["rank"].to_numpy()
        slot = made[np.searchsorted(keys, length << 40 | rank, side="right") - 1]
        nth, copies = rank - slot[:, 1], slot[:, 4]
        return {**{n: got[n] for n in kept}, "sequence_id": slot[:, 2] + nth // copies,
                "offset": slot[:, 5] + nth % copies * length}

    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    ranks = ranked(cut, "length", order, sum(histogram.values()))
    key = cut.schema["doc_id"].dataType.simpleString()
    return per_batch(ranks, rows, f"doc_id {key}, start long, length long, ids_crc32 long, "
                                  "doc_tokens long, sequence_id long, offset long")
