"""The learned methods themselves against loops in plain Python: one gradient step, cumulative links, path lengths,
pooled filters; and the order of shards against a plain sort."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanframe.llm import grades, rules, sharding, toxicity


# --- ordinal regression ---------------------------------------------------------------------------

def _loss(weights, thetas, rows, grade):
    total = 0.0
    for features, g in zip(rows, grade):
        s = sum(weights[f] * v for f, v in features.items())
        upto = [1 / (1 + math.exp(s - t)) for t in thetas] + [1.0]
        total -= math.log(upto[g] - (upto[g - 1] if g else 0.0))
    return total / len(grade) + grades.DECAY * sum(w * w for w in weights.values()) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_a_step_goes_down_the_likelihood(monkeypatch, seed):
    """Adam's first step moves each parameter by RATE against its slope; the slopes come from differences of the loss."""
    rng = np.random.default_rng(seed)
    rows = [{int(f): float(rng.uniform(0.2, 1)) for f in rng.choice(12, 4, replace=False)} for _ in range(40)]
    grade = rng.integers(0, 3, 40)
    row = np.repeat(np.arange(40), 4)
    feature = np.array([f for r in rows for f in r])
    value = np.array([v for r in rows for v in r.values()])
    monkeypatch.setattr(grades, "STEPS", 0)
    start = grades.train(row, feature, value, grade, 3)
    monkeypatch.setattr(grades, "STEPS", 1)
    made = grades.train(row, feature, value, grade, 3)
    weights, h = {f: 0.0 for f in range(12)}, 1e-6
    for f in range(12):
        up = _loss({**weights, f: h}, start.thetas, rows, grade)
        slope = (up - _loss({**weights, f: -h}, start.thetas, rows, grade)) / (2 * h)
        if abs(slope) > 1e-5:
            assert made.weights[f] == pytest.approx(-grades.RATE * np.sign(slope), rel=1e-2)
    both = start.thetas + h
    slope = (_loss(weights, both, rows, grade) - _loss(weights, start.thetas - h, rows, grade)) / (2 * h)
    if abs(slope) > 1e-5:
        assert made.thetas[0] - start.thetas[0] == pytest.approx(-grades.RATE * np.sign(slope), rel=1e-2)
    monkeypatch.setattr(grades, "STEPS", 200)
    done = grades.train(row, feature, value, grade, 3)
    assert _loss(dict(enumerate(done.weights[:12])), done.thetas, rows, grade) < _loss(weights, start.thetas, rows, grade)
    assert done.thetas[0] < done.thetas[1]


def test_tails_and_expected_grade(spark):
    rng = np.random.default_rng(3)
    model = grades.Model(rng.normal(0, 0.7, 1 << grades.BITS), np.array([-0.4, 0.3, 1.1]), 0.45)
    texts = ["", None, "one two two", "THEN!! 12 x", "ünder ß"]
    got = grades.grade(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        at, v = grades.vector((text or "").encode())
        s = sum(model.weights[i] * x for i, x in zip(at, v))
        tails = [1 - 1 / (1 + math.exp(s - t)) for t in model.thetas]
        assert [r.p_at_least_1, r.p_at_least_2, r.p_at_least_3] == pytest.approx(tails)
        assert r.expected_grade == pytest.approx(sum(tails)) and r.kept == (tails[0] >= 0.45)


# --- isolation forest -------------------------------------------------------------------------------

def test_path_lengths_by_walking_each_tree():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (600, 8)), rng.normal(6, 1, (30, 8))])
    good = np.arange(len(x)) < 600
    forest = rules.grow(x, good, seed=9)
    usual = 2 * (math.log(rules.SUBSAMPLE - 1) + 0.5772156649) - 2 * (rules.SUBSAMPLE - 1) / rules.SUBSAMPLE
    scores = forest.score(x)
    for i in (0, 5, 300, 599, 600, 629):
        total = 0.0
        for t in range(rules.TREES):
            node = depth = 0
            while forest.child[t][node] >= 0:
                node = forest.child[t][node] + (x[i, forest.feature[t][node]] >= forest.cut[t][node])
                depth += 1
            assert forest.path[t][node] >= depth
            total += forest.path[t][node]
        assert scores[i] == pytest.approx(2 ** (-total / rules.TREES / usual))
    assert scores[~good].min() > np.median(scores[good])


def test_leaves_hold_the_good_rows_that_reach_them():
    """A leaf's path is its depth and the usual search among the good rows of the subsample that fell there."""
    x = np.random.default_rng(5).normal(0, 1, (200, 8))
    forest = rules.grow(x, np.ones(200, bool), seed=1)       # the subsample is all 200 rows
    rest = lambda n: 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 2 * 0.5772156649 - 1
    for t in range(3):
        fallen = {}
        for row in x:
            node = depth = 0
            while forest.child[t][node] >= 0:
                node = forest.child[t][node] + (row[forest.feature[t][node]] >= forest.cut[t][node])
                depth += 1
            fallen.setdefault((node, depth), []).append(1)
        for (node, depth), rows in fallen.items():
            assert forest.path[t][node] == pytest.approx(depth + rest(len(rows)))


# --- convolutional classifier -------------------------------------------------------------------------

def _model(seed):
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.5, (1 << toxicity.BITS, 6 * toxicity.FILTERS + 2)).astype(np.float32)
    return toxicity.Model(table, rng.normal(0, 0.3, toxicity._EACH), rng.normal(0, 0.5, toxicity._EACH), 0.1, np.array([-0.2, -1.0]), np.array([0.4, 0.6]))


@pytest.mark.parametrize("chunk", [4, 100_000])
def test_forward_pass_by_loops(monkeypatch, chunk):
    """Each filter over each window of words, the largest value of a text, the logistic unit, the language's cut."""
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    model, f = _model(6), toxicity.FILTERS
    texts = [toxicity.word_rows(t.encode()) for t in ("", "one", "one two", "a b c d e f g h i j k", "The cat! SAT on, the cat?")]
    for rows, got in zip(texts, model.score(texts)):
        pooled, first = [], 0
        for k, width in enumerate(toxicity.WIDTHS):
            for c in range(f):
                best = 0.0
                for at in range(len(rows) - width + 1):
                    z = model.bias[k * f + c]
                    for j in range(width):
                        z += sum(float(model.table[h, (first + j) * f + c]) for h in rows[at + j])
                    best = max(best, z)
                pooled.append(best)
            first += width
        z = sum(p * o for p, o in zip(pooled, model.out)) + model.out_bias
        tongue = [model.prior[n] + sum(float(model.table[h, 6 * f + n]) for word in rows for h in word) for n in range(2)]
        cut = model.cuts[int(np.argmax(tongue))]
        logit = lambda p: math.log(p / (1 - p))                                             # noqa: E731
        assert got == pytest.approx(1 / (1 + math.exp(-(z - logit(cut) + logit(toxicity.CUT)))), rel=1e-5)


def test_training_finds_the_words_that_tell():
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(60)]
    texts, toxic = [], rng.random(500) < 0.4
    for y in toxic:
        mine = list(rng.choice(words, 15))
        if y:
            at = rng.integers(13)
            mine[at:at + 2] = ["bad", "thing"]
        texts.append(toxicity.word_rows(" ".join(mine).encode()))
    model = toxicity.train(texts, toxic, ["en"] * 500)
    score = model.score(texts)
    assert score[toxic].min() > score[~toxic].max() and ((score >= toxicity.CUT) == toxic).mean() > 0.99


# --- sharding -----------------------------------------------------------------------------------------

def test_order_is_a_plain_sort_by_fractional_rank(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_ROWS", 37)           # many buckets and slices
    docs = spark.createDataFrame([(i, f"text {i % 90}", ["hot", "a", "b", None][min(3, i % 11 // 3)]) for i in range(700)],
                                 "doc_id long, text string, source string")
    got = sharding.shard(docs, 9).collect()
    text = F.col("text").cast("binary")
    hashed = docs.select("doc_id", F.col("source").alias("s"), F.length(text).alias("n"), F.crc32(text).alias("crc")).select(
        "*", F.xxhash64(F.lit(42), "doc_id", "crc", (F.col("n") + 16).cast("long")).alias("h"),
        (F.pmod(F.xxhash64(F.lit(43), F.col("s").isNull(), F.coalesce("s", F.lit(""))), F.lit(1 << 30)) / float(1 << 30)).alias("shift")).collect()
    slices = -(-700 // 37)
    by_source = {}
    for r in hashed:
        by_source.setdefault(r.s, []).append(r)
    placed = []
    for s, rows in by_source.items():
        # Within a source: hash buckets one after the other, each in the order of the hash.
        rows.sort(key=lambda r: (r.h % slices, r.h))
        placed += [((k + r.shift) / len(rows), s or "", r.h, r.doc_id) for k, r in enumerate(rows)]
    order = [p[-1] for p in sorted(placed, key=lambda p: (p[0], p[1], p[2]))]
    mine = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert mine == order
