"""Learned operators: accuracy on rows that they did not learn from, and their fixed rules."""

import numpy as np
import pytest

import corpus_pipeline
from gleanframe.llm import grades, rules, toxicity
from tests.llm import brute


@pytest.fixture(scope="module")
def labelled(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels


def ranking(score, positive):
    """Chance that a positive row scores above another one."""
    order = np.argsort(np.argsort(score))
    n = positive.sum()
    return (order[positive].sum() - n * (n - 1) / 2) / (n * (len(score) - n))


def test_grades_on_other_rows(labelled):
    docs, labels = labelled
    model = grades.fit(docs.where("doc_id % 2 = 0"), grades.ratings_of(labels))
    assert np.all(np.diff(model.thetas) > 0)
    got = grades.grade(docs.where("doc_id % 2 = 1"), model).toPandas().merge(labels.toPandas(), on="doc_id")
    assert ranking(got.p_at_least_1.to_numpy(), (got.quality > 0).to_numpy()) > 0.98
    assert np.allclose(got.expected_grade, got.p_at_least_1 + got.p_at_least_2)
    assert (got.p_at_least_1 >= got.p_at_least_2).all()
    assert got[got.quality > 0].kept.mean() > 0.985


def test_rules_on_other_rows(labelled):
    docs, labels = labelled
    forest = rules.fit(docs.where("doc_id % 2 = 0"), labels)
    got = rules.judge(docs.where("doc_id % 2 = 1"), forest).toPandas().merge(labels.toPandas(), on="doc_id")
    got = got[~got.base_failed]
    assert ranking(-got.anomaly.to_numpy(), (got.quality > 0).to_numpy()) > 0.95
    assert got[got.quality > 0].kept.mean() > 0.985 and got[got.quality == 0].kept.mean() < 0.7


def test_toxicity_on_the_held_out_fold(labelled):
    docs, labels = labelled
    got = toxicity.score(docs, toxicity.fit(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    assert all(got.held_out == [brute.fold_of(i, 4) == 2 for i in got.doc_id])
    held = got[got.held_out]
    assert ranking(held.score.to_numpy(), (held.toxic > 0).to_numpy()) > 0.93
    assert (held.predicted == (held.score >= 0.3)).all()
    assert held[held.toxic > 0].predicted.mean() > 0.8 and held[held.toxic == 0].predicted.mean() < 0.03


def test_score_needs_nothing_but_the_text(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, most=200)
    few = docs.limit(50)
    blank = few.selectExpr("doc_id + 1000000 AS doc_id", "text", "'?' AS lang", "'?' AS source")
    a = sorted(r.score for r in toxicity.score(few, model).collect())
    assert a == sorted(r.score for r in toxicity.score(blank, model).collect())


def test_pipeline_by_brute_force(spark, sf_dir, small):
    """Each stage on its own input: what it drops is what brute force, or its operator's verdict, drops."""
    docs, rows, labels, items = small
    texts = dict(rows)
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "quality_classifier", "ngram_jaccard", "decontamination", "packing"]
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}            # noqa: E731

    kept = steps["quality_rules"](spark, docs, sf_dir)
    verdicts = {r.doc_id: r.kept for r in rules.judge(docs, rules.fit(docs, labels)).collect()}
    assert ids(kept) == {i for i, k in verdicts.items() if k} and kept.columns == docs.columns
    graded = steps["quality_classifier"](spark, kept, sf_dir)
    model = grades.fit(kept, grades.ratings_of(labels))
    assert ids(graded) == {r.doc_id for r in grades.grade(kept, model).collect() if r.kept}
    one = steps["ngram_jaccard"](spark, graded, sf_dir)
    sets = [(i, brute.shingles(texts[i])) for i in sorted(ids(graded))]
    assert ids(one) == {c if s else i for (i, s), c in zip(sets, brute.components(sets))}
    clean = steps["decontamination"](spark, one, sf_dir)
    listed = [(r.item_id, r.text) for r in items.collect()]
    assert ids(clean) == {i for i in ids(one) if not brute.contamination(texts[i], listed)[4]}
    assert clean.columns == docs.columns
    assert {r.doc_id: r.text for r in clean.collect()} == {i: texts[i] for i in ids(clean)}
    packed = steps["packing"](spark, clean, sf_dir)
    assert ids(packed) == ids(clean)
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(clean)


def test_a_sample_is_bounded_in_rows_and_bytes(spark):
    """20,000 rows of one labelled id, and a text beyond the bound: one row of each id, and no long one."""
    from gleanframe.llm.common import labelled_sample

    copies = spark.range(20_000).selectExpr("5L AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'x' AS start")
    more = spark.createDataFrame([(i, "x" * (40_000 if i == 7 else i), None, None) for i in range(30) if i != 5],
                                 "doc_id long, text string, lang string, start string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(30)] + [(5, 0, 0)], "doc_id long, toxic int, quality int")
    got = labelled_sample(copies.unionByName(more), labels, 10, ["toxic"], "toxic > 0")
    rows = got.collect()
    assert got.columns == ["doc_id", "text", "lang", "toxic"]
    assert len(rows) == len({r.doc_id for r in rows}) <= 20 and all(len(r.text) <= 32_768 for r in rows)
    assert sum(r.toxic for r in rows) <= 10
    again = labelled_sample(copies.repartition(7).unionByName(more), labels, 10, ["toxic"], "toxic > 0").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    everything = labelled_sample(copies.unionByName(more), labels, 100, ["quality"])
    assert everything.count() == 29


def _graded(spark, n=300):
    """(docs, labels): good and bad texts, one of each beyond 32,768 bytes, one id in very many copies."""
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(50)]
    text = lambda i: " ".join(rng.choice(words, 40 if i > 1 else 6_000)) + (" %%% !!!" * 6 if i % 3 == 0 else "")           # noqa: E731
    rows = [(i, text(i)) for i in range(n)]
    docs = spark.createDataFrame(rows + [(4, f"{rows[4][1]} {k}") for k in range(500)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 3 > 0), int(i % 6 == 1)) for i in range(n)], "doc_id long, quality int, toxic int")


def test_every_labelled_row_is_learned_from(spark):
    """long texts too, and an id once however often it comes."""
    from gleanframe.llm.common import labelled_rows

    docs, labels = _graded(spark)
    got = labelled_rows(docs, labels, ["quality"], lambda texts: {"n": [len(t) for t in texts]}, "n long", "every").collect()
    assert sorted(r.doc_id for r in got) == list(range(300)) and max(r.n for r in got) > 32_768
    assert all(r.quality == int(r.doc_id % 3 > 0) for r in got)


def test_the_forest_is_fitted_to_all_rows(spark, monkeypatch):
    """the threshold is the order statistic of all good rows that grew no tree, and trees draw from all the others."""
    docs, labels = _graded(spark)
    drawn, known = [], rules._drawn
    monkeypatch.setattr(rules, "_drawn", lambda rows, n, rng: drawn.append((rows.count(), n)) or known(rows, n, rng))
    forest = rules.fit(docs, labels, max_rejected=0.05)
    held = {r.doc_id for r in docs.where("pmod(xxhash64(42, doc_id), 3) = 0").collect()}
    judged = {r.doc_id: r.anomaly for r in rules.judge(docs.where("doc_id <> 4"), forest).collect()}
    usual = sorted(a for i, a in judged.items() if i in held and i % 3 > 0)
    assert 4 not in held and forest.threshold == usual[int(np.ceil(len(usual) * 0.95))] + 1e-9
    assert drawn == [(sum(i % 3 > 0 for i in range(300) if i not in held),) * 2, (300 - len(held),) * 2]


def test_places_by_counting(spark):
    from gleanframe.llm.common import nth_value

    values = [*np.random.default_rng(1).random(500), 0.0, 1.0, *[0.25] * 300, *(0.5 + np.arange(200) * 1e-12)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for n in (0, 1, 100, 300, 400, 700, 800, 1001):
        assert nth_value(df, "v", n) == sorted(values)[n]


def test_the_gradient_over_the_tables_is_that_of_all_rows(spark):
    """the loss over partitions is that of all rows at once, and the fit tells good from bad."""
    docs, labels = _graded(spark)
    texts = {r.doc_id: r.text for r in docs.where("doc_id <> 4").collect()}
    made = [grades.vector(texts[i].encode()) for i in sorted(texts)]
    grade = np.array([i % 3 > 0 and 2 - (i % 6 == 1) for i in sorted(texts)], np.int64)
    row = np.repeat(np.arange(len(made)), [len(i) for i, _ in made])
    feature, value = np.concatenate([i for i, _ in made]), np.concatenate([v for _, v in made])
    table = spark.createDataFrame([(int(g), i.astype("<u2").tobytes(), v.astype("<f8").tobytes()) for g, (i, v) in zip(grade, made)],
                                  "grade long, feature binary, value binary").repartition(7)
    p = grades._start(np.array([0.3, 0.5])) + 0.01
    loss, g = grades._loss(table, len(grade), p)
    want, slope = grades._slope(p, row, feature, value, grade)
    assert loss == pytest.approx(want / len(grade) + grades.DECAY * (1 << grades.BITS) * 1e-4 / 2)
    slope[:1 << grades.BITS] += grades.DECAY * 0.01 * len(grade)
    assert np.allclose(g, slope / len(grade), atol=1e-12)
    model = grades.fit(docs, grades.ratings_of(labels))
    got = grades.grade(docs.where("doc_id <> 4"), model).collect()
    assert np.mean([(r.p_at_least_1 > 0.5) == (r.doc_id % 3 > 0) for r in got]) > 0.97


def test_texts_are_made_smaller_before_they_meet_their_labels(spark, monkeypatch):
    """op5, op7: no text is shuffled, unlabelled texts are not worked on, and ids may have two types."""
    from gleanframe.llm import common

    docs, labels = _graded(spark)
    plans, known = [], common.staged
    monkeypatch.setattr(common, "staged", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or known(df, name))
    some = labels.where("doc_id < 20")
    for one in (some, some.withColumn("doc_id", some.doc_id.cast("int")), some.where("false")):
        worked = spark.sparkContext.accumulator(0)
        rows = lambda texts: worked.add(len(texts)) or {"n": [len(t) for t in texts]}                        # noqa: E731
        got = common.labelled_rows(docs, one, ["quality"], rows, "n long", "smaller").collect()
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in one.collect())
        assert plans[-1].find("Join") < plans[-1].find("MapInArrow") or not got
    assert worked.value == 0


def test_features_of_many_texts_are_those_of_each(spark):
    """op5: texts without words and repeated words among others; the squares of a group add up to 1."""
    texts = [b"", b"one", b"THEN!! THEN!! x", b" \n", b"a b a b", "éü 12".encode(), b"word " * 300]
    sizes, feature, value = grades.vectors(texts)
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends):
        words, want = text.split(), {}
        for at, w in enumerate(words):
            low = w.lower().strip(b".,;:!?*#$%&\"'()")
            for part in (b"w" + low, b"s" + grades._shape(w), b"e" + w[-4:], *([b"echo"] if at and w == words[at - 1] else [])):
                f = grades.xxhash.xxh3_64_intdigest(part) % (1 << grades.BITS)
                want[f] = want.get(f, 0) + 1
        assert feature[a:b].tolist() == sorted(want)
        assert value[a:b].tolist() == [np.sqrt(want[f] / len(words)) for f in sorted(want)]
    table = spark.createDataFrame([(feature[a:b].astype("<u2").tobytes(), value[a:b].tobytes()) for a, b in zip(ends - sizes, ends)],
                                  "feature binary, value binary").coalesce(1).toArrow().combine_chunks().to_batches()[0]
    row, f, v = grades._flat(table.slice(2, 4))
    assert row.tolist() == np.repeat(np.arange(4), sizes[2:6]).tolist()
    assert f.tolist() == feature[ends[1]:ends[5]].tolist() and v.tolist() == value[ends[1]:ends[5]].tolist()
    assert [len(x) for x in grades._flat(table.slice(0, 0))] == [0, 0, 0]
