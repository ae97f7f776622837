"""Near-duplicate embeddings by navigable small-world graphs: an index for each shard of a label, every
vector against every shard of its label, links counted and joined to components.

A shard is a bounded number of distinct vectors, chosen by hash, and its graph (`hnsw`) is one row
of a staged table. The vectors of a label go in blocks to each of its graphs. A block's beams
widen until its audit finds again what brute force finds. A search returns the number of rows
that a vector links with and one edge to each component of the shard that it reaches, so nothing grows with the
square of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanframe.llm import hnsw
from gleanframe.llm.common import joined_unequal, release, ship_package, staged
from gleanframe.llm.connect import components

THRESHOLD = 0.93
#: Numbers in the vectors of one shard, about: 16,384 vectors of 64 dimensions.
SHARD_NUMBERS = 1 << 20
#: Vectors that are searched for in one task, about.
BLOCK_ROWS = 16_384


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], pa.float64()).to_numpy()
    return hnsw.unit(flat.reshape(len(column), -1))


def _distinct(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows (vec_id, node; null where the vector links with nothing) and distinct vectors
    (space, node, embedding, n). Staged. A space is a label and a number of dimensions."""
    numbers = F.expr("transform(embedding, x -> cast(x AS double))")
    odd = F.expr("exists(_v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    zero = F.expr("forall(_v, x -> x = 0D)")
    usable = F.col("label").isNotNull() & F.col("_v").isNotNull() & ~odd & ~zero
    space, node = F.xxhash64("label", F.size("_v")), F.xxhash64("label", "_v")
    keyed = vectors.select("vec_id", "label", numbers.alias("_v")).select(
        "vec_id", F.when(F.coalesce(usable, F.lit(False)), F.struct(
            space.alias("space"), node.alias("node"), F.col("_v").alias("embedding"))).alias("_k"))
    rows = staged(keyed.select("vec_id", "_k.node"), "vectors-rows")
    nodes = (keyed.where("_k IS NOT NULL").select("_k.*", "vec_id").groupBy("space", "node")
             .agg(F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("least")))
    return rows, staged(nodes, "vectors-nodes")


def _dealt(nodes: DataFrame, shard_numbers: int, block_rows: int) -> DataFrame:
    """The nodes with the number of shards and of blocks of their space.

    Spaces that need more than one of either are at most the numbers of all vectors over
    `shard_numbers` plus all vectors over `block_rows`, which bounds their broadcast.
    """
    sizes = nodes.groupBy("space").agg(F.count("*").alias("_n"), F.first(F.size("embedding")).alias("_d")).select(
        "space", F.expr(f"cast(ceil(_n * _d / {shard_numbers}) AS int)").alias("shards"),
        F.expr(f"cast(ceil(_n / {block_rows}) AS int)").alias("blocks")).where("shards > 1 OR blocks > 1")
    one = F.lit(1)
    return nodes.join(F.broadcast(sizes), "space", "left").withColumns(
        {"shards": F.coalesce("shards", one), "blocks": F.coalesce("blocks", one)})


def found_links(nodes: DataFrame, threshold: float = THRESHOLD, shard_numbers: int = SHARD_NUMBERS,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, other, n, width): for each vector and component of a shard that it reaches, a node of that
    component, the rows it links with there (itself included), and the beam that sufficed. Staged."""
    ship_package(nodes.sparkSession)
    dealt = _dealt(nodes, shard_numbers, block_rows)
    hashed = lambda salt, n: F.expr(f"cast(pmod(xxhash64(node, {salt}), {n}) AS int)")       # noqa: E731

    def index(table: pa.Table) -> pa.Table:
        graph = hnsw.build(_matrix(table["embedding"]), table["node"].to_numpy(), table["n"].to_numpy(), threshold)
        return pa.table({"space": table["space"][:1], "shard": table["shard"][:1], "blocks": table["blocks"][:1],
                         "graph": pa.array([graph.pack()], pa.binary())})

    graphs = staged(dealt.withColumn("shard", hashed(1, "shards")).select("space", "shard", "blocks", "node", "embedding", "n")
                    .groupBy("space", "shard").applyInArrow(index, "space long, shard int, blocks int, graph binary"),
                    "vectors-graphs")

    def search(graph: pa.Table, block: pa.Table) -> pa.Table:
        none = np.empty(0, np.int64)
        if graph.num_rows and block.num_rows:
            names = block["node"].to_numpy()
            order = np.argsort(names)                        # names are hashes: the first ones are a fair audit
            row, other, n, width = hnsw.links(hnsw.Graph.unpack(graph["graph"][0].as_py()), _matrix(block["embedding"])[order],
                                              names[order], threshold)
            found = names[order][row], other, n, np.full(len(row), width, np.int32)
        else:
            found = none, none, none, none.astype(np.int32)
        return pa.table(dict(zip(("node", "other", "n", "width"), map(pa.array, found))))

    at = ["space", "shard", "block"]
    queries = (dealt.withColumn("block", hashed(2, "blocks")).withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)")))
               .select(*at, "node", "embedding"))
    copies = graphs.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*at, "graph")
    found = staged(copies.groupBy(*at).cogroup(queries.groupBy(*at)).applyInArrow(
        search, "node long, other long, n long, width int"), "vectors-links")
    release(graphs)
    return found


def dedup(vectors: DataFrame, threshold: float = THRESHOLD, shard_numbers: int = SHARD_NUMBERS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows link when their labels and numbers of dimensions are equal and their cosine, in double
    precision, is `threshold` or more. A null label, and a vector that is null, empty, zero or holds null or
    non-finite numbers, links with nothing. Copies are one vector in the search and count as
    many as they are, also rows that repeat a vec_id. `component_id` is the least vec_id reachable, `kept` whether it is
    the row's own; a row without vec_id links as others do, is not kept, and names no component.
    Equal vectors are known by a 64-bit hash of label and numbers. Other columns are not read; no
    vectors give no rows.
    """
    rows, nodes = _distinct(vectors)
    links = found_links(nodes, threshold, shard_numbers, block_rows)
    counted = links.groupBy("node").agg(F.sum("n").alias("n_links"))
    labels = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = staged(nodes.select("node", "n", "least").join(counted, "node", "left").join(labels, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "vectors-named")
    release(labels)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    summary = staged(joined_unequal(named, least, "component", "size")
                     .select("node", "n", (F.col("n_links") - 1).alias("n_links"), "component_id"), "vectors-summary")
    release(nodes, links, named)
    return joined_unequal(rows, summary, "node", "n").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")) == F.col("vec_id"),
                   F.lit(False)).alias("kept"))
