"""A navigable small-world graph in layers over the vectors of one shard, in numpy.

Nodes of the graph are leaders: a vector within BALL of a leader joins the leader's ball instead of
the graph, so that a group of near copies is one node and not a clique that a beam must cross. Inserts and
searches go in batches: the beams of a batch move together. Similarities steer the search in
single precision; what counts as linked is decided in double precision, or for a whole ball by
the angles to its leader.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LINKS, UPPER_LINKS = 24, 12           # neighbours of a node in the lowest layer and above
BEAM = 48                             # width of the beam while building, and first width of a search
BATCH, AT_ONCE = 256, 4               # queries that move together, nodes that each opens in a step
#: Share of the angle of the threshold that a ball may reach.
BALL = 0.5
#: Links that an audit must find again, of those that brute force finds for its sample.
RECALL = 0.99
SCAN = 8                              # a beam of one in so many leaders costs more than reading all of them
AUDIT = 512                           # queries of a call that the audit compares with brute force
_SLACK = 1e-9                         # radians


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square overflows."""
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _angle(cosine):
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _beams(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities), the nearest first, -1 where there are fewer: the beam of each query.

    `links` has the neighbours of the first nodes, -1 where there are fewer; `entry` (queries, any
    number) says where each starts.
    """
    n, q = len(links), len(queries)
    ids = np.full((q, width), -1, np.int32)
    sims = np.full((q, width), -np.inf, np.float32)
    opened = np.ones((q, width), bool)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True                                       # -1 is never looked at
    live, fresh = np.arange(q), entry
    while len(live):
        fresh = np.sort(fresh, 1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        new = ~seen[live[:, None], fresh]
        seen[live[:, None], fresh] = True
        near = np.where(new, np.matmul(vectors[fresh], queries[live][:, :, None])[:, :, 0], -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[live], np.where(new, fresh, -1)], 1)
        all_sims = np.concatenate([sims[live], near], 1)
        all_open = np.concatenate([opened[live], ~new], 1)
        top = np.argpartition(-all_sims, width - 1, 1)[:, :width]
        ids[live], sims[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
        was = np.take_along_axis(all_open, top, 1)
        ahead = np.where(was, -np.inf, sims[live])
        k = min(max(AT_ONCE, width // 12), width)
        pick = np.argpartition(-ahead, k - 1, 1)[:, :k]
        usable = np.take_along_axis(ahead, pick, 1) > -np.inf
        np.put_along_axis(was, pick, True, 1)
        opened[live] = was
        at = np.where(usable, np.take_along_axis(ids[live], pick, 1), -1)
        going = usable.any(1)
        fresh = np.where((at >= 0)[:, :, None], links[at], -1).reshape(len(live), -1)[going]
        live = live[going]
    order = np.argsort(-sims, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """At most `most` of each row's candidates (nearest first): those nearer to the row than to a chosen one
    first, then the nearest others. -1 where there are fewer."""
    rows, width = ids.shape
    between = np.matmul(vectors[ids], vectors[ids].transpose(0, 2, 1))
    good = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int64)
    for j in range(width):
        closest = np.where(good, between[:, j], -np.inf).max(1)
        good[:, j] = (ids[:, j] >= 0) & (closest < sims[:, j]) & (count < most)
        count += good[:, j]
    rank = np.where(ids < 0, 2, np.where(good, 0, 1))
    first = np.argsort(rank, 1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, first, 1).astype(np.int32)
    return out if width >= most else np.pad(out, ((0, 0), (0, most - width)), constant_values=-1)


@dataclass
class Graph:
    """The index of one shard: `vectors` in graph order, leaders first, and who belongs to whom."""

    vectors: np.ndarray               # (n, d) double
    nodes: np.ndarray                 # long, the caller's name of each vector
    weights: np.ndarray               # long, how many rows each stands for
    leader: np.ndarray                # position of each vector's leader
    layers: list[np.ndarray]          # neighbours by layer, the lowest first
    component: np.ndarray             # of each leader: position of the leader that names its links' component
    radius: np.ndarray                # of each leader: largest angle of its ball

    @property
    def leaders(self) -> int:
        return len(self.layers[0])

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, nodes=self.nodes, weights=self.weights, leader=self.leader,
                 component=self.component, radius=self.radius, **{f"layer{i}": x for i, x in enumerate(self.layers)})
        return out.getvalue()

    @staticmethod
    def unpack(packed: bytes) -> Graph:
        with np.load(io.BytesIO(packed), allow_pickle=False) as f:
            layers = [f[f"layer{i}"] for i in range(sum(k.startswith("layer") for k in f.files))]
            return Graph(f["vectors"], f["nodes"], f["weights"], f["leader"], layers, f["component"], f["radius"])


def _levels(nodes: np.ndarray) -> np.ndarray:
    """The highest layer of each node, by a hash of its name: a share of 1 / UPPER_LINKS goes one higher."""
    x = nodes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)).astype(float) / 2.0 ** 53
    return np.minimum(8, (-np.log(np.maximum(u, 1e-18)) / math.log(UPPER_LINKS)).astype(np.int64))


def build(vectors: np.ndarray, nodes: np.ndarray, weights: np.ndarray, threshold: float) -> Graph:
    """The graph of distinct unit vectors. The same input in any order gives the same graph."""
    levels = _levels(nodes)
    order = np.lexsort((nodes, -levels))
    vectors, nodes, weights, levels = vectors[order], nodes[order], weights[order], levels[order]
    near = math.cos(BALL * math.acos(threshold))
    quick = vectors.astype(np.float32)

    led: list[int] = []               # position of each leader
    lead = np.empty((0, vectors.shape[1]), np.float32)
    leader = np.full(len(vectors), -1, np.int64)
    layers = [np.full((0, LINKS if i == 0 else UPPER_LINKS), -1, np.int32) for i in range(int(levels.max(initial=0)) + 1)]
    for start in range(0, len(vectors), BATCH):
        mine = np.arange(start, min(start + BATCH, len(vectors)))
        found = _descend(lead, layers, quick[mine], BEAM, int(levels[mine].max())) if len(led) else None
        best = found[0][0][:, 0] if found else np.full(len(mine), -1)
        inside = vectors[mine] @ vectors[mine].T
        new: list[int] = []
        for i, at in enumerate(mine):
            if best[i] >= 0 and vectors[at] @ vectors[led[best[i]]] >= near:
                leader[at] = led[best[i]]
            elif new and inside[i, new].max() >= near:
                leader[at] = mine[new[int(inside[i, new].argmax())]]
            else:
                leader[at] = at
                new.append(i)
        if not new:
            continue
        first = len(led)
        led += mine[new].tolist()
        lead = np.concatenate([lead, quick[mine[new]]])
        among = np.where(np.tri(len(new), k=-1, dtype=bool) | np.tri(len(new), k=-1, dtype=bool).T, inside[np.ix_(new, new)], -np.inf)
        among = among.astype(np.float32)
        for i, table in enumerate(layers):
            # Nodes come by descending level: those of a layer are the first ones.
            here = np.flatnonzero(levels[mine[new]] >= i)
            if not len(here):
                continue
            ids = np.broadcast_to(first + here, (len(here), len(here)))
            sims = among[np.ix_(here, here)]
            if found is not None and found[i] is not None:
                ids = np.concatenate([found[i][0][new][here], ids], 1)
                sims = np.concatenate([found[i][1][new][here], sims], 1)
            nearest = np.argsort(-sims, 1, kind="stable")[:, :BEAM]
            ids, sims = np.take_along_axis(ids, nearest, 1), np.take_along_axis(sims, nearest, 1)
            ids = np.where(sims > -np.inf, ids, -1)
            chosen = _diverse(lead, ids, sims, table.shape[1])
            layers[i] = _linked_back(lead, np.concatenate([table, chosen]), len(table))
    leaders = np.array(led, np.int64)
    rest = np.flatnonzero(leader != np.arange(len(vectors)))
    place = np.concatenate([leaders, rest])
    to = np.empty(len(vectors), np.int64)
    to[place] = np.arange(len(place))
    graph = Graph(vectors[place], nodes[place], weights[place], to[leader[place]] if len(place) else place, layers,
                  np.arange(len(leaders)), np.zeros(len(leaders)))
    angles = _angle(np.einsum("ij,ij->i", graph.vectors, graph.vectors[graph.leader]))
    angles[:len(leaders)] = 0
    np.maximum.at(graph.radius, graph.leader, angles)
    _join_leaders(graph, threshold)
    return graph


def _descend(lead: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int, joins: int = 0) -> list:
    """Beams by layer, the lowest first; None where no query needs that layer."""
    found: list = [None] * len(layers)
    entry = np.zeros((len(queries), 1), np.int32)
    for i in reversed(range(len(layers))):
        if len(layers[i]):
            # Above the layers that a query joins, one nearest node is enough to go on from.
            found[i] = _beams(lead, layers[i], queries, entry, width if i <= joins else 1)
            entry = found[i][0][:, :1]
    return found


def _linked_back(lead: np.ndarray, table: np.ndarray, first: int) -> np.ndarray:
    """The table of neighbours, in which those of the rows from `first` know these rows too."""
    source = np.repeat(np.arange(first, len(table)), table.shape[1])
    target = table[first:].reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    known = (table[target] == source[:, None]).any(1)
    source, target = source[~known], target[~known]
    if not len(target):
        return table
    sims = np.einsum("ij,ij->i", lead[source], lead[target])
    order = np.lexsort((source, -sims, target))
    source, target, sims = source[order], target[order], sims[order]
    rows, begin, count = np.unique(target, return_index=True, return_counts=True)
    nth = np.arange(len(target)) - np.repeat(begin, count)
    keep = nth < BEAM                                        # the nearest newcomers are candidates
    width, table = int(min(BEAM, count.max())), table.copy()
    fresh = np.full((len(rows), width), -1, np.int32)
    fresh[np.repeat(np.arange(len(rows)), count)[keep], nth[keep]] = source[keep]
    for part in np.array_split(np.arange(len(rows)), len(rows) // 1024 + 1):
        at = rows[part]
        ids = np.concatenate([table[at], fresh[part]], 1)
        near = np.where(ids >= 0, np.matmul(lead[ids], lead[at][:, :, None])[:, :, 0], -np.inf)
        nearest = np.argsort(-near, 1, kind="stable")
        ids, near = np.take_along_axis(ids, nearest, 1), np.take_along_axis(near, nearest, 1)
        full = (ids >= 0).sum(1) > table.shape[1]
        table[at[~full]] = ids[~full][:, :table.shape[1]]
        if full.any():
            table[at[full]] = _diverse(lead, ids[full], near[full], table.shape[1])
    return table


def _candidates(graph: Graph, quick: np.ndarray, queries: np.ndarray, limit: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, leader): leaders near enough that their ball may hold a link, by beams that widen until
    their last one is too far. A beam that would hold a good part of the leaders reads them all instead."""
    least = float(limit.min(initial=1.0)) - 1e-5
    todo = np.arange(len(queries))
    while len(todo):
        again = []
        whole = SCAN * width >= graph.leaders
        step = max(1, 4_000_000 // graph.leaders if whole else BATCH * BEAM // width)
        for start in range(0, len(todo), step):
            mine = todo[start:start + step]
            if whole:
                sims = queries[mine].astype(np.float32) @ quick.T
                row, ball = np.nonzero(sims >= limit - 1e-5)
                yield mine[row], ball
                continue
            ids, sims = _descend(quick, graph.layers, queries[mine].astype(np.float32), width)[0]
            open_ = sims[:, -1] >= least
            again.append(mine[open_])
            row, col = np.nonzero((sims >= limit[np.maximum(ids, 0)] - 1e-5) & (ids >= 0) & ~open_[:, None])
            yield mine[row], ids[row, col]
        todo = np.concatenate(again) if again else todo[:0]
        width *= 4


def _linked(graph: Graph, queries: np.ndarray, row: np.ndarray, ball: np.ndarray, threshold: float,
            by_ball: list[np.ndarray]) -> np.ndarray:
    """How many rows each (query, ball) links with; a ball at the border is compared vector by vector."""
    reach = math.acos(threshold)
    cosine = np.einsum("ij,ij->i", queries[row], graph.vectors[ball])
    angle = _angle(cosine)
    total = np.zeros(graph.leaders, np.int64)
    np.add.at(total, graph.leader, graph.weights)
    alone = graph.radius[ball] == 0
    n = np.where(np.where(alone, cosine >= threshold, angle + graph.radius[ball] <= reach - _SLACK), total[ball], 0)
    border = np.flatnonzero(~alone & (n == 0) & (angle - graph.radius[ball] <= reach + _SLACK))
    order = border[np.argsort(ball[border], kind="stable")]
    for part in np.split(order, np.flatnonzero(np.diff(ball[order])) + 1) if len(order) else ():
        members = by_ball[ball[part[0]]]
        for some in np.array_split(part, max(1, len(part) * len(members) // 2_000_000)):
            near = queries[row[some]] @ graph.vectors[members].T >= threshold
            n[some] = near.astype(np.float64) @ graph.weights[members]
    return n


def _balls(graph: Graph) -> list[np.ndarray]:
    order = np.argsort(graph.leader, kind="stable")
    return np.split(order, np.cumsum(np.bincount(graph.leader, minlength=graph.leaders))[:-1]) if graph.leaders else []


def _limits(graph: Graph, threshold: float) -> np.ndarray:
    """The least similarity of a query to each leader at which its ball may hold a link."""
    return np.cos(np.minimum(math.pi, math.acos(threshold) + graph.radius))


def _join_leaders(graph: Graph, threshold: float) -> None:
    """Names the component of leaders that link with each other. What a beam misses is found when
    the shard is queried; then the components meet as edges."""
    lead = graph.vectors[:graph.leaders]
    if not len(lead):
        return
    parent = np.arange(len(lead))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    quick = lead.astype(np.float32)
    for start in range(0, len(lead), BATCH):
        ids, sims = _descend(quick, graph.layers, quick[start:start + BATCH], BEAM)[0]
        row, col = np.nonzero(sims >= threshold - 1e-5)
        other, row = ids[row, col], row + start
        sure = np.einsum("ij,ij->i", lead[row], lead[other]) >= threshold
        for a, b in zip(row[sure].tolist(), other[sure].tolist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    graph.component = np.array([find(i) for i in range(len(lead))], np.int64)


def links(graph: Graph, queries: np.ndarray, names: np.ndarray, threshold: float, recall: float = RECALL,
          audit: int = AUDIT, width: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, node, n) and the width that was enough: a node of each component that the query links with, and
    the rows of it that it links with, itself included.

    The first `audit` queries (the caller deals them by hash) are compared with brute force. While the
    share of links found again is below `recall` the beam is four times as wide, up to reading all leaders,
    which is exact. A query that is a vector of the graph (by its name) and has not found itself reads them all.
    """
    by_ball, limit, quick = _balls(graph), _limits(graph, threshold), graph.vectors[:graph.leaders].astype(np.float32)
    none = np.empty(0, np.int64)
    if not len(queries) or not graph.leaders:
        return none, none, none, width
    sample = queries[:audit]
    true = np.concatenate([(part @ graph.vectors.T >= threshold) @ graph.weights
                           for part in np.array_split(sample, max(1, len(sample) * len(graph.vectors) // 4_000_000))])
    while True:
        found = list(_candidates(graph, quick, queries, limit, width))
        row, ball = (np.concatenate([f[i] for f in found]) for i in range(2))
        n = _linked(graph, queries, row, ball, threshold, by_ball)
        got = np.bincount(row, n, len(queries))[:len(sample)]
        if got.sum() >= recall * true.sum() or SCAN * width >= graph.leaders:
            break
        width *= 4
    lost = np.flatnonzero(np.isin(names, graph.nodes) & (np.bincount(row, n, len(queries)) == 0))
    if len(lost):
        again, ball_again = (np.concatenate(x) for x in zip(*_candidates(graph, quick, queries[lost], limit, graph.leaders)))
        row, ball = np.concatenate([row, lost[again]]), np.concatenate([ball, ball_again])
        n = np.concatenate([n, _linked(graph, queries, lost[again], ball_again, threshold, by_ball)])
    row, ball, n = row[n > 0], ball[n > 0], n[n > 0]
    component = graph.component[ball]
    order = np.lexsort((component, row))
    row, component, n = row[order], component[order], n[order]
    begin = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(component) != 0)]) if len(row) else none
    return row[begin], graph.nodes[component[begin]], (np.add.reduceat(n, begin) if len(row) else none).astype(np.int64), width
