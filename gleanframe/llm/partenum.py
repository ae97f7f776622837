"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

Two sets of sizes a and b with a Jaccard similarity of t or more differ in at most
k = (1 - t) / (1 + t) * (a + b) elements. Within a band of sizes the feature domain is hashed
into T parts and each part into n2 smaller ones. At most k differences leave
T - k div (k2 + 1) parts with k2 differences or fewer, and in each of those some n2 - k2 of
the smaller parts are equal. So every subset of n2 - k2 smaller parts of a part is enumerated,
with the elements that a set has in it, as a signature: similar sets share one.

A signature without elements would be shared by sets that have nothing in common. It is
emitted only by sets with so many such parts that they might share no other; see `_Band.spare`.

Equal sets are one node, known by a 64-bit digest. Nodes that share a signature are compared in two steps:

1. neighbours in each bucket (by size) are verified, and what links is joined to components;
2. buckets that still hold several components are compared whole, in tiles of bounded rows.
   Pairs of one component are skipped, sizes and parity sketches (a lower bound of the
   difference) rule out most others, the rest is intersected: first the nearest one of each
   node, then, with the components that this leaves, every pair.

So all links between different sets are found up to connection, without writing out the pairs of
a group, and no bucket or group must fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gleanframe.llm.common import (WORD_HASH, column, lowered_words, mixed, per_batch, release, ship_package, signed, sliced, staged,
                                   text_bytes, window_hashes)
from gleanframe.llm.connect import components

SHINGLE, PERCENT = 4, 85
#: A band's largest size is about this many times its smallest.
BAND = 1.4
SKETCH_BITS = 512
#: Rows of one tile of a bucket, about.
TILE_ROWS = 4_000
#: Rounds that verify the nearest pairs only, before all that are left.
NEAREST_ROUNDS = 2
#: Bits of the table that says which documents to read again (2 MB).
READ_BITS = 1 << 24
_AT_ONCE = 250_000                # elements whose signatures are made together
_TEXTS = 500                      # texts whose sets are held together


def max_difference(total: int, percent: int = PERCENT) -> int:
    """Most differing elements of two linked sets whose sizes add up to `total`, at least."""
    return (100 - percent) * total // (100 + percent)


@dataclass(frozen=True)
class _Band:
    index: int
    low: int
    high: int
    k: int
    parts: int                       # T
    small: int                       # n2
    spread: int                      # k2

    @property
    def subsets(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.small), self.small - self.spread))

    @property
    def spare(self) -> int:
        """Parts, at least, in which a linked pair has an equal subset. If all of those subsets are
        empty, both sets have that many parts with an empty subset; such sets emit empty ones too."""
        return self.parts - self.k // (self.spread + 1)


@lru_cache(4)
def bands(most: int, percent: int = PERCENT) -> tuple[_Band, ...]:
    """Bands of sizes up to `most`; those in which only equal sets can link are left out."""
    made, low, index = [], 1, 0
    while low <= most:
        high = max(low, int(low * BAND))
        k = max_difference(2 * high, percent)
        if k > 0:
            if k <= 3:
                shape = 1, k + 2, k
            elif k < 20:
                shape = k // 3 + 2, 4, 2
            else:
                shape = k // 2 + 1 + max(2, k // 16), 2, 1
            made.append(_Band(index, low, high, k, *shape))
        low, index = high + 1, index + 1
    return tuple(made)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The ascending hashes of the distinct shingles; a text of fewer words is one shingle."""
    words = WORD_HASH.array(lowered_words(text))
    return np.unique(window_hashes(words, min(size, len(words)))) if len(words) else np.empty(0, np.uint64)


def digest(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def sketch(elements: np.ndarray) -> bytes:
    """Parities of the elements in SKETCH_BITS classes: sets differ at least where these do."""
    odd = np.bincount((elements >> np.uint64(7)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signatures(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) of all sets, for their own band and those of larger partners."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner, made = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for band in bands(int(sizes.max(initial=0)) * 100 // percent + 1, percent):
        mine = np.flatnonzero((sizes <= band.high) & (100 * sizes >= percent * band.low))
        ends = np.cumsum(sizes[mine])
        for part in np.split(mine, np.flatnonzero(np.diff(ends // _AT_ONCE)) + 1) if len(mine) else ():
            cells = band.parts * band.small
            salted = mixed(np.concatenate([sets[i] for i in part]) + np.uint64(0x9E3779B97F4A7C15 * (band.index + 1) % 2 ** 64))
            cell = ((salted >> np.uint64(40)) % np.uint64(cells)).astype(np.int64)
            cell += np.repeat(np.arange(len(part)), sizes[part]) * cells
            total = np.zeros(len(part) * cells, np.uint64)
            np.add.at(total, cell, mixed(salted))
            count = np.bincount(cell, minlength=len(total)).reshape(-1, band.parts, band.small)
            total = total.reshape(-1, band.parts, band.small)
            sums = np.stack([total[:, :, list(s)].sum(2, dtype=np.uint64) for s in band.subsets], 2)
            some = np.stack([count[:, :, list(s)].sum(2) for s in band.subsets], 2) > 0
            shown = some | ((~some).any(2).sum(1) >= band.spare)[:, None, None]
            place = np.arange(band.parts * len(band.subsets), dtype=np.uint64).reshape(band.parts, -1)
            salt = mixed(place + np.uint64(band.index + 1 << 32))
            at = np.nonzero(shown)
            owner.append(part[at[0]])
            made.append(mixed(sums + salt[None])[at])
    return np.concatenate(owner), np.concatenate(made)


def sets_of(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, sketch): every document's set in short. Staged."""
    def rows(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, size) for t in column(batch, "_text")]
        return {"doc_id": batch.column(0), "text_key": batch.column(1), "n_shingles": [len(s) for s in sets],
                "node": [digest(s) for s in sets], "sketch": [sketch(s) for s in sets]}

    key = docs.schema["doc_id"].dataType.simpleString()
    return staged(per_batch(docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("_text")),
                            rows, f"doc_id {key}, text_key long, n_shingles long, node long, sketch binary", _TEXTS),
                  "partenum-documents")


def _buckets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(signature, node, n): signatures that different sets share. Staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()                           # copies met lately in this task
        for batch in batches:
            for piece in sliced(batch, _TEXTS):
                sets, nodes = [], []
                for text in column(piece, "_text"):
                    s = shingle_set(text, size)
                    node = digest(s)
                    if node not in seen:
                        seen.add(node)
                        sets.append(s)
                        nodes.append(node)
                if len(seen) > 200_000:
                    seen.clear()
                owner, made = signatures(sets, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(made)), pa.array(np.array(nodes, np.int64)[owner] if len(owner) else np.empty(0, np.int64)),
                     pa.array(np.array([len(s) for s in sets], np.int32)[owner] if len(owner) else np.empty(0, np.int32))],
                    names=["signature", "node", "n"])

    ship_package(docs.sparkSession)
    made = docs.select(text_bytes().alias("_text")).mapInArrow(run, "signature long, node long, n int")
    of = Window.partitionBy("signature")
    shared = (made.withColumn("_low", F.min("node").over(of)).withColumn("_high", F.max("node").over(of))
              .where("_low <> _high").select("signature", "node", "n").distinct())
    return staged(shared, "partenum-buckets")


def _read_sets(docs: DataFrame, known: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, elements) of the given nodes, each once: one document of each is read again.

    Which documents, a bit table of fixed size tells the tasks; one read in vain is dropped when
    the nodes meet their sets, before a set is sent anywhere else.
    """
    from gleanframe.llm.decontaminate import _bit_table

    reader = (known.select("node", F.xxhash64("doc_id", "text_key").alias("h")).join(nodes, "node", "left_semi")
              .groupBy("node").agg(F.min("h").alias("h")))
    table = _bit_table(reader.select(F.pmod("h", F.lit(READ_BITS)).alias("bit")), "bit", READ_BITS)

    def rows(batch: pa.RecordBatch) -> dict:
        bit = batch.column(0).to_numpy()
        wanted = np.flatnonzero(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
        sets = [shingle_set(t, size) for t in column(batch.take(pa.array(wanted, pa.int64())), "_text")]
        return {"node": [digest(s) for s in sets], "elements": pa.array([s.tobytes() for s in sets], pa.binary())}

    keyed = docs.select(F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(READ_BITS)).alias("bit"), text_bytes().alias("_text"))
    return (per_batch(keyed, rows, "node long, elements binary", _TEXTS).join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def _could_link(a: np.ndarray, b: np.ndarray, n_a, n_b, percent: int) -> np.ndarray:
    """By sketches (words of 64 bits) and sizes."""
    differ = np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)
    total = n_a + n_b
    return (differ * (100 + percent) <= (100 - percent) * total) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the staged (a, b) whose sets link, by intersection. Staged."""
    nodes = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "partenum-nodes")
    full = _read_sets(docs, known, nodes, size)
    end = lambda c: full.select(F.col("node").alias(c), F.col("elements").alias(f"elements_{c}"))      # noqa: E731

    def rows(batch: pa.RecordBatch) -> dict:
        view = lambda x: np.frombuffer(x, np.uint64)             # noqa: E731
        keep = pa.array([linked(view(x), view(y), percent) for x, y in zip(column(batch, "elements_a"), column(batch, "elements_b"))],
                        pa.bool_())
        return {c: batch.column(batch.schema.get_field_index(c)).filter(keep) for c in "ab"}

    links = staged(per_batch(pairs.join(end("a"), "a").join(end("b"), "b"), rows, "a long, b long", _TEXTS), "partenum-links")
    release(nodes)
    return links


def _neighbour_pairs(buckets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): each node with the nearest of those that it follows, by size, in some bucket and may link with. Staged.

    A pair for each node at most; what a node links with besides is found between components.
    """
    follows = F.lead("node").over(Window.partitionBy("signature").orderBy("n", "node"))
    pairs = buckets.select(F.col("node").alias("a"), follows.alias("b")).where("b IS NOT NULL").distinct()
    end = lambda c: sketches.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))

    def rows(batch: pa.RecordBatch) -> dict:
        view = lambda n: np.frombuffer(b"".join(column(batch, n)), np.uint64).reshape(-1, SKETCH_BITS // 64)
        x, y = view("sketch_a"), view("sketch_b")
        keep = _could_link(x, y, np.array(column(batch, "n_a"), np.int64), np.array(column(batch, "n_b"), np.int64), percent)
        far = np.bitwise_count(x ^ y).sum(-1, dtype=np.int32)[keep]
        return {"far": far, **{c: batch.column(batch.schema.get_field_index(c)).filter(pa.array(keep)) for c in "ab"}}

    near = per_batch(pairs.join(end("a"), "a").join(end("b"), "b"), rows, "a long, b long, far int")
    near = near.groupBy("b").agg(F.min(F.struct("far", "a"))["a"].alias("a"))
    return staged(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "partenum-pairs")


def _apart(buckets: DataFrame, sketches: DataFrame, labels: DataFrame, percent: int, every: bool) -> DataFrame:
    """(signature, node, partner): pairs of a bucket in different components that may link. Staged.

    Each node with its nearest such partner, or with every one. A pair that may link has both nodes in the
    nearest pairs of its bucket, so those rows are all that later rounds need.
    """
    of = labels.withColumnsRenamed({"component": "_c"})
    rows = staged(buckets.join(of, "node", "left").select("signature", "node", F.coalesce("_c", "node").alias("component")),
                  "partenum-rows")
    mixed_up = (rows.groupBy("signature").agg(F.min("component").alias("_low"), F.max("component").alias("_high"),
                                              F.count("*").alias("_rows"))
                .where("_low <> _high").selectExpr("signature", f"cast(ceil(_rows / {TILE_ROWS}) AS int) AS tiles"))
    tiled = (rows.join(mixed_up, "signature").withColumn("tile", F.expr("cast(pmod(xxhash64(node), tiles) AS int)"))
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .select("signature", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                     "tile", "node", "component"))
    whole = (tiled.join(sketches, "node").repartition("signature", "low", "high")
             .sortWithinPartitions("signature", "low", "high", "n", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def out(made: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in made], pa.int64()) for i in range(3)],
                                              names=["signature", "node", "partner"])

        def close() -> list[tuple[int, int, int]]:
            return [(key[0], a, b) for a, b in _tile_pairs(group, percent, every)] if len(group) > 1 else []

        for batch in batches:
            made: list[tuple[int, int, int]] = []
            for row in zip(*(column(batch, c) for c in ("signature", "low", "high", "tile", "node", "component", "n", "sketch"))):
                if row[:3] != key:
                    made += close()
                    key, group = row[:3], []
                group.append(row[3:])
            yield out(made)
        yield out(close())

    found = staged(whole.mapInArrow(run, "signature long, node long, partner long"), "partenum-apart")
    release(rows)
    return found


def _tile_pairs(group: list[tuple], percent: int, every: bool) -> list[tuple[int, int]]:
    """Pairs of one tile of a bucket (tile, node, component, n, sketch; by n) that may link two components.

    A tile of a bucket with itself holds each pair once; of two parts, pairs across are enough.
    """
    tile, node, component = (np.array([g[i] for g in group], np.int64) for i in range(3))
    two = tile.min() != tile.max()
    n = np.array([g[3] for g in group], np.int64)
    sketches = np.frombuffer(b"".join(g[4] for g in group), np.uint64).reshape(len(group), -1)
    made, none = [], SKETCH_BITS + 1
    nearest, partner = np.full(len(group), none), np.zeros(len(group), np.int64)
    for i in range(len(group) - 1):
        stop = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
        if stop <= i + 1:
            continue
        other = slice(i + 1, stop)
        could = _could_link(sketches[i], sketches[other], n[i], n[other], percent) & (component[other] != component[i])
        if two:
            could &= tile[other] != tile[i]
        found = np.flatnonzero(could) + i + 1
        if not len(found):
            continue
        if every:
            made += [(int(node[i]), int(node[j])) for j in found]
            continue
        far = np.bitwise_count(sketches[i] ^ sketches[found]).sum(-1, dtype=np.int64)
        closer = far < nearest[found]
        nearest[found[closer]], partner[found[closer]] = far[closer], node[i]
        if far.min() < nearest[i]:
            nearest[i], partner[i] = far.min(), node[found[far.argmin()]]
    return made if every else [(int(node[i]), int(partner[i])) for i in np.flatnonzero(nearest < none)]


def groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, text_key.

    `class_id` is the least doc_id with an equal set, `component_id` the least that links
    reach. Null and empty texts have no set, link with nothing and keep their own doc_id. Rows with a
    null doc_id link as others do, but name no group. Repeated rows stay; other columns are not read.
    """
    known = sets_of(docs, size)
    buckets = _buckets(docs, size, percent)
    sketches = staged(known.join(buckets.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.first("n_shingles").cast("int").alias("n"), F.first("sketch").alias("sketch")), "partenum-sketches")
    tested = _neighbour_pairs(buckets, sketches, percent)
    links = _verified(tested, docs, known, size, percent)
    left = buckets.select("signature", "node")
    for every in (*[False] * NEAREST_ROUNDS, True):
        labels = components(links)
        found = _apart(left, sketches, labels, percent, every)
        release(labels)
        left = found.select("signature", "node").distinct()
        # A pair in different components that was tested before does not link.
        pairs = staged(found.select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b"))
                       .distinct().join(tested, ["a", "b"], "left_anti"), "partenum-pairs")
        tested = tested.unionByName(pairs)
        links = links.unionByName(_verified(pairs, docs, known, size, percent))
    release(buckets)
    labels = components(links)

    least = (known.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))
             .join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = staged(least, "partenum-classes")
    named = (least.join(least.groupBy("component").agg(F.min("class_id").alias("component_id")), "component")
             .select("node", "class_id", "component_id"))
    own = F.col("n_shingles") == 0
    return (known.join(named, "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    "text_key", "node"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns: that of the least doc_id.

    Texts without words are no copies of each other and all stay.
    """
    found = staged(groups(docs, size, percent), "partenum-groups")
    # Of a group without any doc_id nothing names it but a node, so groups are told apart by both.
    first = (found.where("n_shingles > 0")
             .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("node")).alias("_node"))
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("m"))
             .select(F.col("m.doc_id").alias("_gf_id"), F.col("m.text_key").alias("_gf_key"), F.lit(True).alias("_gf_once")))
    bare = (found.where("n_shingles = 0").select(F.col("doc_id").alias("_gf_id"), F.col("text_key").alias("_gf_key"),
                                                  F.lit(False).alias("_gf_once")).distinct())
    chosen = first.unionByName(bare)
    nth = F.row_number().over(Window.partitionBy("_gf_id", "_gf_key").orderBy(F.lit(1)))
    kept = (docs.withColumn("_gf_text", F.xxhash64("text"))
            .join(chosen, F.col("doc_id").eqNullSafe(F.col("_gf_id")) & (F.col("_gf_text") == F.col("_gf_key"))))
    return kept.withColumn("_gf_nth", nth).where("NOT _gf_once OR _gf_nth = 1").select(*docs.columns)
