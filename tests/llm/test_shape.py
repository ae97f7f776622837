"""Every operator on odd and on empty tables: a row (or pieces) for each document, whatever it holds."""

import pytest
from public_tokenizers import path

from gleanframe.llm import (decontaminate, grades, licenses, packing, partenum, rules, sharding, suffix_tree,
                            token_counts, toxicity)

WORD_BPE, BYTE_BPE = path("word_bpe_49k.json"), path("byte_bpe_50k.json")
LABELS = "doc_id long, quality int, toxic int, start string"


def labels(docs, empty=False):
    rows = [] if empty else [(1, 1, 0, "x"), (1, 0, 1, None), (None, 1, 1, None), (7, None, None, None), (5, 1, 0, None),
                             (9, 0, 1, None), (99, 1, 1, None)]
    return docs.sparkSession.createDataFrame(rows, LABELS)


def benchmark(docs, empty=False):
    rows = [] if empty else [(1, None, "x"), (None, "one two three four", "x"), (2, "", None), (3, "one", "x"), (3, "one", "x")]
    return docs.sparkSession.createDataFrame(rows, "item_id long, text string, start string")


OPERATORS = {
    "packing": lambda d, e: packing.pack(d, WORD_BPE),
    "licenses": lambda d, e: licenses.scan(d),
    "partenum": lambda d, e: partenum.groups(d),
    "token_counts": lambda d, e: token_counts.counts(d.select("*", token_counts.sample_edits().alias("edits")), BYTE_BPE),
    "grades": lambda d, e: grades.grade(d, grades.fit(d, grades.ratings_of(labels(d, e)))),
    "sharding": lambda d, e: sharding.shard(d),
    "rules": lambda d, e: rules.judge(d, rules.fit(d, labels(d, e))),
    "toxicity": lambda d, e: toxicity.score(d, toxicity.fit(d, labels(d, e))),
    "suffix_tree": lambda d, e: suffix_tree.score(d, *suffix_tree.fit(d)),
    "decontaminate": lambda d, e: decontaminate.find(d, benchmark(d, e)),
    "keep_one": lambda d, e: partenum.keep_one(d),
    "keep_rules": lambda d, e: rules.keep(d, rules.fit(d, labels(d, e))),
    "keep_grades": lambda d, e: grades.keep(d, grades.fit(d, grades.ratings_of(labels(d, e)))),
    "keep_clean": lambda d, e: decontaminate.drop_contaminated(d, benchmark(d, e)),
}
FEWER = {"keep_one", "keep_rules", "keep_grades", "keep_clean"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_documents(odd_docs, name):
    made = OPERATORS[name](odd_docs, False)
    ids = lambda d: sorted((r[0] is None, r[0] or 0) for r in d.select("doc_id").collect())     # noqa: E731
    got, want = ids(made), ids(odd_docs)
    if name in FEWER:
        assert made.schema == odd_docs.schema or made.columns == odd_docs.columns
        assert len(got) <= len(want) and set(got) <= set(want)
    elif name == "packing":
        assert set(got) == set(want)
    else:
        assert got == want


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents(no_docs, name):
    assert OPERATORS[name](no_docs, True).count() == 0


@pytest.mark.parametrize("name", ["grades", "rules", "toxicity", "decontaminate"])
def test_without_labels_or_items(odd_docs, name):
    assert OPERATORS[name](odd_docs, True).count() == odd_docs.count()


def test_one_of_a_group_stays(odd_docs):
    kept = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:12]) for r in OPERATORS["keep_one"](odd_docs, False).collect())
    texts = [t for _, _, t in kept]
    assert texts.count("the0 watch40"[:12]) <= 1
    assert sum(1 for t in texts if not t.strip()) == 4          # texts without words are no copies
