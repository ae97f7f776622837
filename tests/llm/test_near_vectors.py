"""Operator 11 against brute force: links, components and recall, on plain, odd, hot and empty tables."""

import numpy as np
import pytest

from gleanframe.llm import hnsw, near_vectors
from tests.llm import brute

KINDS = "vec_id long, embedding array<float>, label int, n long, node string, space string, component_id string"


def _expected(rows, threshold=0.93):
    """{place: (n_links, component_id)} of [(vec_id, vector, label)] by all pairs."""
    ok = [i for i, (_, v, label) in enumerate(rows)
          if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, edges = dict.fromkeys(range(len(rows)), 0), []
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.asarray(np.float32(rows[i][1]), float) for i in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a], links[b] = links[a] + 1, links[b] + 1
                    edges.append((a, b))
    least = brute.reachable([r[0] for r in rows], edges)
    return [(r[0], links[i], least[i], r[0] is not None and least[i] == r[0]) for i, r in enumerate(rows)]


def _got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def _made(seed, groups, alone, d=24, spread=0.08):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=d) for _ in range(alone)]
    for size in groups:
        middle = rng.normal(size=d)
        out += [middle * rng.uniform(0.5, 3) + spread * rng.normal(size=d) * np.linalg.norm(middle) / d ** 0.5
                for _ in range(size)]
    return [[float(x) for x in v] for v in out]


def test_links_and_components_are_those_of_all_pairs(spark):
    vectors = _made(1, [40, 7, 2, 2, 2], 150) + _made(2, [30], 20, spread=0.25)
    rows = [(i, v, i % 3 if i < 150 else 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, None, "x", None, "y") for r in rows], KINDS).repartition(3)
    for numbers, block in ((24 * 50, 64), (near_vectors.SHARD_NUMBERS, near_vectors.BLOCK_ROWS)):
        assert _got(near_vectors.dedup(df, shard_numbers=numbers, block_rows=block)) == sorted(_expected(rows), key=str)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    v, w = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [(1, v, 1), (2, w, 1), (3, v, 1), (3, v, 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
            (9, [1.0, None, 3.0], 1), (10, [inf, 1.0, 1.0], 1), (11, [nan, 1.0, 1.0], 1), (12, [1.0, 2.0], 1), (None, v, 1),
            (None, v, 9), (13, [-0.0, 0.0, 1.0], 5), (14, [0.0, 0.0, 1.0], 5), (15, [1e38, 2e38, 3e38], 1), (16, [1e-38, 2e-38, 3e-38], 1)]
    df = spark.createDataFrame([(*r, 1, None, "x", None) for r in rows], KINDS)
    want = _expected([r for r in rows if r[0] is not None] + [(None, v, 1)])
    got = _got(near_vectors.dedup(df))
    assert (None, 0, None, False) in got
    got.remove((None, 0, None, False))
    assert got == sorted(want, key=str)


def test_no_vectors(spark):
    assert near_vectors.dedup(spark.createDataFrame([], KINDS)).count() == 0


def test_a_hot_group_is_counted_without_its_pairs(spark):
    """Two thirds of all rows are near copies: rows of links stay in proportion, counts are exact."""
    vectors = _made(3, [2_000], 1_000, d=32)
    rows = [(i, v, 1, None, None, None, None) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, KINDS)
    _, nodes = near_vectors._distinct(df)
    links = near_vectors.found_links(nodes, shard_numbers=32 * 1_000, block_rows=500)
    assert links.count() <= 3 * 2 * len(rows)
    x = hnsw.unit(np.asarray(np.float32(vectors), float))
    want = (x @ x.T >= 0.93).sum(1) - 1
    got = {r.vec_id: r.n_links for r in near_vectors.dedup(df, shard_numbers=32 * 1_000, block_rows=500).collect()}
    true = want.sum()
    assert sum(abs(got[i] - n) for i, n in enumerate(want)) <= 0.01 * true
    assert all(got[i] <= n for i, n in enumerate(want))


def test_recall_of_the_graph_itself():
    """Nearest neighbours of random vectors, where no group helps the search."""
    rng = np.random.default_rng(5)
    x = hnsw.unit(rng.normal(size=(6_000, 16)))
    g = hnsw.build(x, np.arange(6_000), np.ones(6_000, np.int64), 0.93)
    row, node, n, _ = hnsw.links(g, x, np.arange(6_000), 0.93)
    true, got = (x @ x.T >= 0.93).sum(1), np.bincount(row, n, 6_000)
    assert (got <= true).all() and got.sum() >= 0.98 * true.sum()
    lead = g.vectors[:g.leaders]
    ids, _ = hnsw._descend(lead.astype(np.float32), g.layers, x[:300].astype(np.float32), hnsw.BEAM)[0]
    best = np.argsort(-(x[:300] @ lead.T), 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, best)]) >= 0.9


@pytest.mark.parametrize("broken", [True, False])
def test_beams_widen_until_the_audit_passes(broken):
    """A graph whose neighbours are cut to two is found out by the audit, and searched wider."""
    rng = np.random.default_rng(6)
    x = hnsw.unit(np.repeat(rng.normal(size=(1_500, 24)), 2, 0) + 0.13 * rng.normal(size=(3_000, 24)))
    g = hnsw.build(x, np.arange(3_000), np.ones(3_000, np.int64), 0.96)
    if broken:
        g.layers = [np.where(np.arange(layer.shape[1]) < 2, layer, -1) for layer in g.layers]
    row, _, n, width = hnsw.links(g, x, np.arange(3_000), 0.96)
    true = (x @ x.T >= 0.96).sum(1)
    assert np.bincount(row, n, 3_000).sum() >= 0.98 * true.sum()
    assert (width > hnsw.BEAM) == broken


def test_a_packed_graph_is_the_same_graph():
    x = hnsw.unit(np.random.default_rng(7).normal(size=(700, 8)))
    g = hnsw.build(x, np.arange(700), np.ones(700, np.int64), 0.93)
    again = hnsw.Graph.unpack(g.pack())
    turned = hnsw.build(x[::-1], np.arange(700)[::-1].copy(), np.ones(700, np.int64), 0.93)
    for a, b, c in zip(hnsw.links(g, x, np.arange(700), 0.93), hnsw.links(again, x, np.arange(700), 0.93),
                       hnsw.links(turned, x, np.arange(700), 0.93)):
        assert np.array_equal(a, b) and np.array_equal(a, c)


def test_rounds_of_components_grow_as_the_logarithm(spark, monkeypatch):
    """A path of 300 ascending ids, the worst order for pointers to the least id."""
    from gleanframe.llm import connect

    turns = []
    real = connect.staged
    monkeypatch.setattr(connect, "staged", lambda df, name: turns.append(name) or real(df, name))
    made = connect.components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"))
    assert made.select("component").distinct().count() == 1 and made.count() == 301
    assert turns.count("roots") <= 10
