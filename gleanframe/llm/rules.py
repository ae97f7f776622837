"""Quality rules: rule statistics of every text, and an isolation forest over them.

Trees split the range of all sampled rows at random, but their leaves are weighed by rows
that labels call good. Where few good rows lie, few splits lead to an empty side, so a short
mean path marks a document unlike the good ones. The threshold is calibrated on labelled rows
that did not grow the trees: at most `max_rejected` of the good ones may score above it.

All labelled rows take part. Each tree has, as the method asks, a few random rows, drawn from all of those for
growing; the threshold is the exact order statistic of all the others. Statistics and verdicts cover
every document, in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanframe.llm.common import (WORD_HASH, blank_words, column, dense_ids, labelled_rows, nth_value, per_batch, release,
                                   staged, text_bytes, where_text, window_hashes)

TREES, SUBSAMPLE, DEPTH = 100, 256, 10
#: Share of the good labelled rows that the method may reject at most.
MAX_REJECTED = 0.002
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts for the forest: words, capitals, digits, stressing marks, words equal to the one before.
MORE = ("n_lines", "n_capitals", "n_digits", "n_stress", "n_echoes")

_NOT_CHARS = bytes((*range(0x09, 0x0E), 0x20, *range(0x80, 0xC0)))      # white space, later bytes of a character
_SYMBOLS = b"#*$%&|<>"
_CAPITALS, _DIGITS, _STRESS = bytes(range(0x41, 0x5B)), b"0123456789", b"!?"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of `size` words that stand twice or more in the text."""
    windows = window_hashes(WORD_HASH.array(words), size)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(change)))


def statistics(text: bytes) -> list[int]:
    """STATS and MORE of one whole text."""
    words, n = blank_words(text), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = lambda chars: n - len(text.translate(None, chars))          # noqa: E731
    return [len(words), len(text.translate(None, _NOT_CHARS)), count(_SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), count(_CAPITALS), count(_DIGITS), count(_STRESS),
            sum(map(bytes.__eq__, words[1:], words[:-1]))]


def _statistics(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(STATS) + len(MORE))


def features(stats: np.ndarray) -> np.ndarray:
    """Rates of the statistics; length alone is no ground for a verdict."""
    s = np.maximum(stats, 0).astype(float)
    words, chars, lines = np.maximum(s[:, 0], 1), np.maximum(s[:, 1], 1), np.maximum(s[:, 5], 1)
    return np.column_stack([s[:, 1] / words, s[:, 2] / words, s[:, 3] / lines, s[:, 4] / words,
                            s[:, 6] / chars, s[:, 7] / chars, s[:, 8] / words, s[:, 9] / words])


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEATED_PERCENT * stats[:, 0])


def _rest(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows, the usual credit of a leaf."""
    n = np.maximum(n, 2).astype(float)
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Flat trees: a node's feature, cut, first child and, in a leaf, its path length."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / usual path): near 1 for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                below = x[rows, self.feature[t][at]] >= self.cut[t][at]
                at = np.where(self.child[t][at] < 0, at, self.child[t][at] + below)
            total += self.path[t][at]
        return 2.0 ** (-total / len(self.feature) / _rest(np.array([SUBSAMPLE]))[0])


def grow(x: np.ndarray, good: np.ndarray, seed: int = 42) -> Forest:
    """TREES trees over random subsamples of the good rows, split within the range of all rows."""
    rng = np.random.default_rng(seed)
    inside = np.flatnonzero(good) if good.any() else np.arange(len(x))
    return _grown(((x[rng.choice(inside, min(SUBSAMPLE, len(inside)), replace=False)],
                    x[rng.choice(len(x), min(SUBSAMPLE, len(x)), replace=False)]) for _ in range(TREES if len(x) else 0)), rng)


def _grown(draws: Iterable[tuple[np.ndarray, np.ndarray]], rng: np.random.Generator) -> Forest:
    """A tree for each (rows that weigh its leaves, other rows that widen its range)."""
    size = 2 ** (DEPTH + 1)
    feature, child = np.zeros((TREES, size), np.int64), np.full((TREES, size), -1, np.int64)
    cut, path = np.zeros((TREES, size)), np.zeros((TREES, size))
    for t, (mine, others) in enumerate(draws):
        low, high = np.minimum(mine.min(0), others.min(0)), np.maximum(mine.max(0), others.max(0))
        todo, used = [(0, mine, low, high, 0)], 1
        while todo:
            node, rows, a, b, depth = todo.pop()
            open_ = np.flatnonzero(b > a)
            if len(rows) <= 1 or depth == DEPTH or not len(open_):
                path[t, node] = depth + (_rest(np.array([len(rows)]))[0] if len(rows) > 1 else 0)
                continue
            f = rng.choice(open_)
            c = rng.uniform(a[f], b[f])
            feature[t, node], cut[t, node], child[t, node] = f, c, used
            left_b, right_a = b.copy(), a.copy()
            left_b[f] = right_a[f] = c
            todo += [(used, rows[rows[:, f] < c], a, left_b, depth + 1),
                     (used + 1, rows[rows[:, f] >= c], right_a, b, depth + 1)]
            used += 2
    return Forest(feature, cut, child, path)


def _drawn(rows: DataFrame, n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """For each tree SUBSAMPLE of the `n` rows (doc_id, x), without repeats: only rows that are drawn leave Spark."""
    places = [rng.choice(n, min(SUBSAMPLE, n), replace=False) + 1 for _ in range(TREES)]
    asked = np.unique(np.concatenate(places))
    wanted = rows.sparkSession.createDataFrame([(int(i),) for i in asked], "id long")        # <= TREES * SUBSAMPLE rows
    got = dense_ids(rows, "doc_id").join(F.broadcast(wanted), "id").select("id", "x").toPandas().sort_values("id")
    x = np.array(got.x.tolist())
    return [x[np.searchsorted(asked, p)] for p in places]


def fit(docs: DataFrame, labels: DataFrame, max_rejected: float = MAX_REJECTED, seed: int = 42) -> Forest:
    """A forest from all labelled rows (doc_id, quality: 0 or more) that pass the base rules.

    Two thirds of them, by a hash of doc_id, grow the trees, the rest sets the threshold. Without a good
    row in the rest nothing is rejected by the method.
    """
    def rows(texts: list[bytes]) -> dict:
        stats = _statistics(texts)
        return {"x": list(features(stats)), "failed": base_failed(stats)}

    got = labelled_rows(docs, labels, ["quality"], rows, "x array<double>, failed boolean", "rules-labelled")
    held, good = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(3)) == 0, F.col("quality") > 0
    usable = got.where(~F.col("failed"))
    growing = usable.where(~held).select("doc_id", "x", good.alias("good"))
    n, n_good = growing.agg(F.count("*"), F.count_if("good")).first()
    if not n:
        return grow(np.zeros((0, 8)), np.zeros(0, bool))
    rng = np.random.default_rng(seed)
    mine = _drawn(growing.where("good") if n_good else growing, n_good or n, rng)
    forest = _grown(zip(mine, _drawn(growing, n, rng)), rng)

    def score(batch: pa.RecordBatch) -> dict:
        return {"score": forest.score(np.array(batch.column(0).to_pylist()).reshape(batch.num_rows, -1)) if batch.num_rows
                else np.zeros(0)}

    usual = staged(per_batch(usable.where(held & good).select("x"), score, "score double"), "rules-scores")
    if n_usual := usual.count():
        place = min(n_usual - 1, int(np.ceil(n_usual * (1 - max_rejected))))
        forest.threshold = nth_value(usual, "score", place) + 1e-9
    release(got, usual)
    return forest


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per document: doc_id, STATS, base_failed, kept, anomaly.

    Null and empty texts have no words, so they fail. Rows are judged by themselves: repeated
    rows get the same verdict, and other columns are not read.
    """
    def rows(batch: pa.RecordBatch) -> dict:
        stats, failed, anomaly = _verdicts(column(batch, "_text"), forest)
        return {"doc_id": batch.column(0), **{n: stats[:, i] for i, n in enumerate(STATS)}, "base_failed": failed,
                "kept": ~failed & (anomaly <= forest.threshold), "anomaly": anomaly}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", text_bytes().alias("_text")), rows,
                     f"doc_id {key}, " + ", ".join(f"{n} long" for n in STATS)
                     + ", base_failed boolean, kept boolean, anomaly double")


def keep(docs: DataFrame, forest: Forest) -> DataFrame:
    """The documents whose verdict is `kept`, with all their columns as they are."""
    def passes(texts: list[bytes]) -> np.ndarray:
        _, failed, anomaly = _verdicts(texts, forest)
        return ~failed & (anomaly <= forest.threshold)

    return where_text(docs, passes)


def _verdicts(texts: list[bytes], forest: Forest):
    stats = _statistics(texts)
    return stats, base_failed(stats), forest.score(features(stats))
