"""Quality classifier: ordinal cumulative-link regression over hashed text features.

One weight per hashed feature is shared by all grades: P(grade <= k) = sigmoid(theta_k - w.x)
with ordered thresholds theta_0 < theta_1 < ... They are fitted to all rated rows: a step of L-BFGS takes the
gradient over a staged table of features, summed in the tasks and by Spark. Every document then gets its
expected grade and the probabilities of reaching each grade, in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gleanframe.llm.common import (Cached, blank_words, column, labelled_rows, nth_value, per_batch, release, ship_package,
                                   sliced, staged, text_bytes, where_text)

BITS = 14
#: Share of acceptable rated rows that the cut may reject at most.
MAX_REJECTED = 0.002
STEPS, RATE, DECAY = 250, 0.05, 1e-4
#: L-BFGS: gradients remembered, and the share of the loss that a step must gain for another one.
REMEMBERED, LEAST_GAINED = 10, 2e-4
#: Texts whose gradient is taken at once, and parts in which a gradient is summed.
AT_ONCE, PARTS = 500, 16
#: Texts whose words are held at once.
TEXTS_AT_ONCE = 500

_CLASS = bytes(ord("A") if 0x41 <= b <= 0x5A else ord("a") if 0x61 <= b <= 0x7A or b >= 0x80
               else ord("0") if 0x30 <= b <= 0x39 else b for b in range(256))


def _shape(word: bytes) -> bytes:
    """Letters, digits and marks of a word with runs of one kind as one: THEN!! gives A!."""
    kinds = word.translate(_CLASS)
    return bytes(k for i, k in enumerate(kinds) if i == 0 or k != kinds[i - 1])


def _features(word: bytes) -> int:
    """Three hashed features of a word, 20 bits each: itself, its shape, and its last characters."""
    low = word.lower().strip(b".,;:!?*#$%&\"'()")
    return (xxhash.xxh3_64_intdigest(b"w" + low) & _MASK) << 40 | _SHAPES[word.translate(_CLASS)] \
        | xxhash.xxh3_64_intdigest(b"e" + word[-4:]) & _MASK


_MASK = (1 << BITS) - 1
#: The feature of a word's shape in its place, by the kinds of its characters: words are many, these are few.
_SHAPES = Cached(lambda kinds: (xxhash.xxh3_64_intdigest(b"s" + _shape(kinds)) & _MASK) << 20, 10_000)
_ECHO = xxhash.xxh3_64_intdigest(b"echo") & (1 << BITS) - 1


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of features of each text, features, values), text by text, ascending in each.

    The distinct words of all texts are hashed once. The squares of the values of a feature group add up to 1.
    """
    split = [blank_words(t) for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    coded = pa.array(list(chain.from_iterable(split)), pa.binary()).dictionary_encode()
    packed = np.fromiter(map(_features, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))[coded.indices.to_numpy()]
    text = np.repeat(np.arange(len(texts)), n_words)
    echo = np.flatnonzero((packed[1:] == packed[:-1]) & (text[1:] == text[:-1]))
    ids = np.sort(np.concatenate([text << BITS | packed >> 40, text << BITS | packed >> 20 & 0xFFFFF, text << BITS | packed & 0xFFFFF,
                                  text[echo] << BITS | _ECHO]))
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[:len(ids)])
    owner = ids[at] >> BITS
    return np.bincount(owner, minlength=len(texts)), ids[at] & _MASK, np.sqrt(np.diff(np.append(at, len(ids))) / n_words[owner])


def vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features, values) of one text."""
    return vectors([text])[1:]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    thetas: np.ndarray               # len = grades - 1, ascending
    cut: float = 0.0                 # least P(grade >= 1) of a kept document

    @property
    def grades(self) -> int:
        return len(self.thetas) + 1

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1."""
        return 1 - _sigmoid(self.thetas[None, :] - scores[:, None])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        made = [np.zeros(0)]
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            sizes, feature, value = vectors(texts[i:i + TEXTS_AT_ONCE])
            ends, weight = np.cumsum(sizes), self.weights[feature]
            made.append(np.array([float(value[a:b] @ weight[a:b]) for a, b in zip(ends - sizes, ends)]))
        return np.concatenate(made)


def _thetas(p: np.ndarray) -> np.ndarray:
    """The thresholds are theta_0 and the logs of the gaps above it, so they stay ordered."""
    d = 1 << BITS
    return p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1:]))])


def _start(share: np.ndarray) -> np.ndarray:
    """Zero weights, and thresholds by the shares of rows up to each grade."""
    share = share.clip(0.01, 0.99)
    first = np.log(share / (1 - share))
    return np.concatenate([np.zeros(1 << BITS), first[:1], np.log(np.maximum(np.diff(first), 0.1))])


def _slope(p: np.ndarray, row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray]:
    """(negative log likelihood, its gradient) of the rows, summed, without decay."""
    n, d, grades = len(grade), 1 << BITS, len(p) - (1 << BITS) + 1
    s = np.bincount(row, p[feature] * value, n)
    at = np.concatenate([[-np.inf], _thetas(p), [np.inf]])
    up, low = _sigmoid(at[grade + 1] - s), _sigmoid(at[grade] - s)
    up[grade == grades - 1], low[grade == 0] = 1.0, 0.0
    like = np.maximum(up - low, 1e-9)
    d_up, d_low = up * (1 - up) / like, low * (1 - low) / like          # of log like by its two thresholds
    g = np.zeros_like(p)
    g[:d] = np.bincount(feature, (d_up - d_low)[row] * value, d)
    by_theta = np.array([np.sum(d_low[grade == k + 1]) - np.sum(d_up[grade == k]) for k in range(grades - 1)])
    g[d] = by_theta.sum()
    for j in range(grades - 2):
        g[d + 1 + j] = np.exp(p[d + 1 + j]) * by_theta[j + 1:].sum()
    return -float(np.log(like).sum()), g


def train(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Adam on the mean negative log likelihood of the cumulative-link model, for rows at hand."""
    n, d = len(grade), 1 << BITS
    p = _start(np.array([np.mean(grade <= k) for k in range(grades - 1)]))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        g = _slope(p, row, feature, value, grade)[1] / n
        g[:d] += DECAY * p[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(p[:d], _thetas(p))


def _joined(values: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(number of items of each value, items) of binary values, read where they lie."""
    wide = values.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    ends = np.frombuffer(offsets, np.int64, len(wide) + 1, 8 * wide.offset) if len(wide) else np.zeros(1, np.int64)
    size = np.dtype(dtype).itemsize
    return np.diff(ends) // size, np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]].view(dtype)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the texts of a batch."""
    sizes, feature = _joined(batch.column(batch.schema.get_field_index("feature")), "<u2")
    _, value = _joined(batch.column(batch.schema.get_field_index("value")), "<f8")
    return np.repeat(np.arange(batch.num_rows), sizes), feature.astype(np.int64), value


def _loss(rows: DataFrame, n: int, p: np.ndarray) -> tuple[float, np.ndarray]:
    """(mean negative log likelihood with decay, its gradient) over all `n` rows (grade, feature, value).

    A task sums its rows and sends one sum in PARTS parts; each part is summed over the tasks, and the sum alone reaches
    the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros(len(p) + 1), TaskContext.get().partitionId()
        for batch in batches:
            for piece in sliced(batch, AT_ONCE):
                loss, g = _slope(p, *_flat(piece), np.array(column(piece, "grade"), np.int64))
                total += np.append(g, loss)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int64()), pa.array([task] * PARTS, pa.int64()),
             pa.array([x.astype("<f8").tobytes() for x in np.array_split(total, PARTS)], pa.binary())], names=["part", "task", "total"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = sum(np.frombuffer(x, "<f8") for x in table["total"].to_pylist())
        return pa.table({"part": table["part"][:1], "total": pa.array([total.tobytes()], pa.binary())})

    ship_package(rows.sparkSession)
    got = (rows.select("grade", "feature", "value").mapInArrow(run, "part long, task long, total binary")
           .groupBy("part").applyInArrow(add, "part long, total binary").collect())              # PARTS rows
    total = np.concatenate([np.frombuffer(r.total, "<f8") for r in sorted(got)]) / n
    decayed = np.append(p[:1 << BITS], np.zeros(len(p) - (1 << BITS)))
    return total[-1] + DECAY * float(decayed @ decayed) / 2, total[:-1] + DECAY * decayed


def _minimum(of: Callable[[np.ndarray], tuple[float, np.ndarray]], p: np.ndarray) -> np.ndarray:
    """L-BFGS with halved steps from `p`, until a step gains less than LEAST_GAINED of the value."""
    value, g = of(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, shares = -g, []
        for s, y in reversed(past):
            shares.append((s @ way) / (s @ y))
            way = way - shares[-1] * y
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), share in zip(past, reversed(shares)):
            way = way + (share - (y @ way) / (s @ y)) * s
        step = 1.0 if past else 1.0 / max(1e-12, float(np.sqrt(g @ g)))
        while True:
            new, slope = of(p + step * way)
            if new <= value + 1e-4 * step * float(g @ way):
                break
            step /= 2
            if step < 1e-9:
                return p
        s, y = step * way, slope - g
        if s @ y > 0:
            past = [*past[1 - REMEMBERED:], (s, y)]
        gained, value, g, p = value - new, new, slope, p + s
        if gained < LEAST_GAINED * value:
            return p
    return p


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, max_rejected: float = MAX_REJECTED, seed: int = 42) -> Model:
    """A model from all rows of ratings (doc_id, grade: 0 .. grades - 1) and their whole texts.

    Three quarters, by a hash of doc_id, are learned from; the others set the cut, so that at most `max_rejected` of
    those of grade 1 or more fall below it, and never above a half. Without ratings every document scores alike
    and is kept.
    """
    def rows(texts: list[bytes]) -> dict:
        sizes, feature, value = vectors(texts)
        ends = np.cumsum(sizes)
        return {n: [x[a:b].tobytes() for a, b in zip(ends - sizes, ends)]
                for n, x in (("feature", feature.astype("<u2")), ("value", value.astype("<f8")))}

    rated = ratings.where((F.col("grade") >= 0) & (F.col("grade") < grades))
    every = labelled_rows(docs, rated, ["grade"], rows, "feature binary, value binary", "grades-rated")
    held = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(4)) == 0
    learn = every.where(~held)
    counts = dict(learn.groupBy("grade").count().collect())                                  # a row a grade
    if not counts:
        learn, counts = every, dict(every.groupBy("grade").count().collect())
    if not counts:
        return Model(np.zeros(1 << BITS), np.arange(grades - 1, dtype=float) - 40)
    n = sum(counts.values())
    share = np.cumsum([counts.get(k, 0) for k in range(grades - 1)]) / n
    p = _minimum(lambda p: _loss(learn, n, p), _start(share))
    model = Model(p[:1 << BITS], _thetas(p))

    def tail(batch: pa.RecordBatch) -> dict:
        pairs = zip(column(batch, "feature"), column(batch, "value"))
        score = [float(np.frombuffer(v, "<f8") @ model.weights[np.frombuffer(f, "<u2")]) for f, v in pairs]
        return {"tail": model.tails(np.array(score, float))[:, 0]}

    tails = staged(per_batch(every.where(held & (F.col("grade") >= 1)).select("feature", "value"), tail, "tail double"), "grades-tails")
    if n_tails := tails.count():
        model.cut = min(0.5, nth_value(tails, "tail", int(n_tails * max_rejected)))
    release(every, tails)
    return model


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, expected_grade, p_at_least_1, p_at_least_2, ..., kept.

    Null and empty texts have no features and get the grade of a zero score. Repeated rows get
    equal values; other columns are not read. An empty table gives no rows.
    """
    names = [f"p_at_least_{k}" for k in range(1, model.grades)]

    def rows(batch: pa.RecordBatch) -> dict:
        tails = model.tails(model.scores(column(batch, "_text")))
        return {"doc_id": batch.column(0), "expected_grade": tails.sum(1), "kept": tails[:, 0] >= model.cut,
                **{n: tails[:, k] for k, n in enumerate(names)}}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", text_bytes().alias("_text")), rows,
                     f"doc_id {key}, expected_grade double, " + ", ".join(f"{n} double" for n in names)
                     + ", kept boolean", TEXTS_AT_ONCE)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that reach grade 1 with at least the cut's probability, as they are."""
    return where_text(docs, lambda texts: model.tails(model.scores(texts))[:, 0] >= model.cut)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from two flags: 0 poor, 1 acceptable but toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("quality") > 0, F.when(
        F.col("toxic") > 0, 1).otherwise(2)).alias("grade"))
