"""B8 against plain Python, on odd rows, and with an n-gram that a third of all texts and many items hold."""

import random
import re
from collections import Counter

import pytest

from gleanframe.operators import contamination as C

TEXTS = "doc_id long, text string, item string, grams string, hit long"
ITEMS = "item_id string, text string, texts long, class string"


def grams(text, n):
    words = [w for w in re.split("[ \t\n\r]+", (text or "").lower()) if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def expected(texts, items, n):
    index = {}
    for item, text in items:
        index.setdefault(item, set()).update(grams(text, n))
    own = {}
    for i, text in texts:
        own.setdefault(i, set()).update(grams(text, n))
    every = set().union(*index.values()) if index else set()
    by_text = {i: (len(g), len(g & every)) for i, g in own.items()}
    by_item = {}
    for item, g in index.items():
        counts = Counter(x for o in own.values() for x in o & g)
        by_item[item] = (len(g), len(counts), sum(bool(o & g) for o in own.values()), max(counts.values(), default=0))
    return by_text, by_item


def got(spark, texts, items, n):
    t = spark.createDataFrame([(*r, "x", None, 1) for r in texts], TEXTS).repartition(3)
    i = spark.createDataFrame([(*r, 1, "x") for r in items], ITEMS)
    by_text = {r.text_id: (r.n_grams, r.n_shared) for r in C.text_contamination(t, i, n).collect()}
    rows = C.item_contamination(t, i, n).collect()
    for r in rows:
        assert r.found_share == (r.n_found / r.n_grams if r.n_grams else None)
    return by_text, {r.item: (r.n_grams, r.n_found, r.n_texts, r.most_texts) for r in rows}


def _random(seed, n_texts):
    rng = random.Random(seed)
    words = "the cat Sat on a mat\tand then\nleft".split(" ")
    text = lambda most: " ".join(rng.choice(words) for _ in range(rng.randrange(most)))      # noqa: E731
    return [(i, text(60)) for i in range(n_texts)], [(f"i{i}", text(25)) for i in range(15)]


@pytest.mark.parametrize("n", [2, 4])
def test_both_sides_are_those_of_plain_sets(spark, n):
    texts, items = _random(n, 120)
    texts += [(900, None), (901, ""), (902, " \n"), (903, "THE  CAT sat ON a"), (903, "THE  CAT sat ON a")]
    items += [("empty", ""), ("null", None), ("short", "cat"), ("i0", items[0][1]), (None, "the cat sat on a")]
    assert got(spark, texts, items, n) == expected(texts, items, n)


def test_no_texts_or_no_items(spark):
    texts, items = [(1, "a b c")], [("i", "a b c")]
    assert got(spark, [], items, 2) == ({}, {"i": (2, 0, 0, 0)})
    assert got(spark, texts, [], 2) == ({1: (2, 0)}, {})


def test_a_hot_gram_is_summed_before_items_are_looked_up(spark):
    """Two thirds of 3,000 texts hold the one passage that all of 200 items hold too: the texts become one
    row for each set of shared n-grams, and neither plan nor result grows with their product."""
    passage = "one two three four five"
    texts = [(i, f"{passage} tail{i} end{i}" if i % 3 else f"other{i} words{i} here{i}") for i in range(3_000)]
    items = [(f"i{i}", f"start{i} of{i} {passage}") for i in range(200)]
    t, i = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    index = C.item_index(i, "item_id", "text", 5)
    shared = C.shared_grams(t, index, "doc_id", "text", 5)
    assert shared.where("size(grams) > 0").select("grams").distinct().count() == 1
    rows = C.item_contamination(t, i, 5).collect()
    assert {(r.n_grams, r.n_found, r.n_texts, r.most_texts) for r in rows} == {(3, 1, 2_000, 2_000)}


def test_texts_stay_where_they_are(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    for df in (C.item_contamination(docs, items, 5), C.text_contamination(docs, items, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            assert not ("Exchange hashpartitioning" in line and "text#" in line)
        assert "Python" not in plan and "NestedLoop" not in plan
