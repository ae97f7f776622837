"""Operators against brute force over whole small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from gleanframe.llm import (connect, decontaminate, licenses, packing, partenum, rules, sharding, suffix_tree,
                            token_counts)
from tests.llm import brute

WORD_BPE, BYTE_BPE = path("word_bpe_49k.json"), path("byte_bpe_50k.json")


# --- packing ---------------------------------------------------------------------------------

def test_parts_encode_as_the_whole_text():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for text in ("", "Ünder's .. don't,.x <|endoftext|>a A\tb\r\nc é ́x İstanbul ΣΑΣ naïve., 12ab3", "a.b,c. .,",
                 "ﬁ é. É., ß Ǆ a\x1cb", "  THE. The, 's's"):
        assert np.frombuffer(packing.encode(text.encode(), WORD_BPE), "<u4").tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids


def test_pack_is_exact_gapless_and_tight(small):
    docs, rows, _, _ = small
    tokenizer = Tokenizer.from_file(WORD_BPE)
    size = 512
    pieces = packing.pack(docs, WORD_BPE, size=size).toPandas()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in rows}
    by_doc = pieces.sort_values(["doc_id", "start"])
    for i, mine in by_doc.groupby("doc_id"):
        assert mine.start.tolist() == np.cumsum([0, *mine.length[:-1]]).tolist()
        assert mine.length.sum() == len(ids[i]) == mine.doc_tokens.iloc[0]
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[i][r.start:r.start + r.length].tobytes())
    used = 0
    for _, mine in pieces.sort_values("offset").groupby("sequence_id"):
        assert mine.offset.tolist() == np.cumsum([0, *mine.length[:-1]]).tolist()
        assert mine.length.sum() <= size
        used += 1
    assert sorted(pieces.sequence_id.unique()) == list(range(used))
    assert used * size <= 1.02 * pieces.length.sum() + size


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
@settings(max_examples=150, deadline=None)
def test_slots_hold_every_piece_once(histogram):
    slots, sequences = packing.place(histogram, 40)
    fill = np.zeros((sequences, 40), int)
    for length, count in histogram.items():
        mine = sorted(s for s in slots if s[0] == length)
        assert [s[1] for s in mine] == np.cumsum([0, *[s[3] * s[4] for s in mine]])[:-1].tolist()
        assert sum(s[3] * s[4] for s in mine) == count
    for length, _, first, packs, copies, offset in slots:
        fill[first:first + packs, offset:offset + copies * length] += 1
    assert fill.max(initial=0) <= 1
    assert all((row[:row.sum()] == 1).all() for row in fill)


# --- licenses --------------------------------------------------------------------------------

def test_base_phrases_by_search(small):
    docs, rows, _, _ = small
    phrases = {tuple(p.split()): label for p, label in licenses.BASE_PHRASES.items()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    for i, text in rows:
        words = brute.folded(text)
        at = [(k, label) for k in range(len(words)) for p, label in phrases.items() if tuple(words[k:k + len(p)]) == p]
        starts = [k for k, _ in at]
        assert got[i] == (len(words), len(at), min(starts, default=None), max(starts, default=None),
                          ",".join(sorted({x for _, x in at})))


def test_templates():
    a = licenses.compile_template("free <<beginOptional>>and open <<var:1=source|code>><<endOptional>> use <<var:2>> granted")
    match = lambda text: a.match(text.encode().split(), 0)               # noqa: E731
    assert match("free use granted") == (3, 1.0)
    assert match("free and open code use is hereby granted")[0] == 8
    assert match("free and open code use is hereby granted")[1] == 1 - 2 / 8
    assert match("free and open use granted") is None
    assert match("free use is hereby now granted") is None
    for wrong in ("a <<endOptional>>", "a <<beginOptional>> b", "a <<huh>>", "<<beginOptional>>a<<endOptional>>", "a <<var:1=b c>>"):
        with pytest.raises(ValueError):
            licenses.compile_template(wrong)


def _as_regex(template):
    """The template as a pattern over blank-joined words, each with a blank after it."""
    import re

    out = []
    for i, part in enumerate(re.split("<<(.*?)>>", template)):
        if i % 2 == 0:
            out += [re.escape(w) + " " for w in part.split()]
        elif part == "beginOptional":
            out.append("(?:")
        elif part == "endOptional":
            out.append(")?")
        elif "=" in part:
            out.append("(?:" + "|".join(re.escape(" ".join(c.split())) + " " for c in part.split("=", 1)[1].split("|")) + ")")
        else:
            out.append("(?:[^ ]+ ){0,%s}" % part.split(":")[1])
    return "".join(out)


def _spoken(template, r):
    """A text that the template accepts, its choices drawn."""
    import re

    words, skip = [], []
    for i, part in enumerate(re.split("<<(.*?)>>", template)):
        if part == "beginOptional":
            skip.append(r.random() < 0.5)
        elif part == "endOptional":
            skip.pop()
        elif any(skip):
            continue
        elif i % 2 == 0:
            words += part.split()
        elif "=" in part:
            words += r.choice(part.split("=", 1)[1].split("|")).split()
        else:
            words += [f"name{k}" for k in range(r.randrange(int(part.split(":")[1]) + 1))]
    return words


def test_templates_accept_what_their_pattern_accepts():
    """Every template on texts that it accepts, and on the same with a word dropped, changed or repeated."""
    import regex

    r = random.Random(8)
    for name, (label, template) in licenses.TEMPLATES.items():
        a = licenses.compile_template(template, label)
        pattern = regex.compile(_as_regex(template))
        accepted = 0
        for k in range(12):
            words = _spoken(template, r)
            assert a.match([w.encode() for w in words], 0)[0] == len(words)
            assert a.least <= len(words)
            if k % 3:
                at = r.randrange(len(words))
                words = [words[:at] + words[at + 1:], words[:at] + ["odd"] + words[at + 1:], words[:at + 1] + words[at:]][r.randrange(3)]
            line = "".join(w + " " for w in words) + "after it "
            # The longest match of the pattern from the first word, as the automaton reports it.
            longest = max((m.end() for stop in range(len(line) + 1) if line[:stop].endswith(" ")
                           for m in [pattern.fullmatch(line, 0, stop)] if m), default=None)
            got = a.match(line.encode().split(), 0)
            assert (None if got is None else got[0]) == (None if longest is None else line[:longest].count(" ")), (name, line)
            accepted += got is not None
        assert accepted >= 4


MIT = licenses.TEMPLATES["mit"][1]


def _scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.labels, r.score) for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_whole_licenses_need_their_whole_wording(spark):
    whole = " ".join(_spoken(MIT, random.Random(1)))
    military = whole[:whole.index("subject to the following")] + "for military use only"
    changed = whole.replace("without warranty of any", "with warranty of any")
    bsd = {n: " ".join(_spoken(licenses.TEMPLATES[n][1], random.Random(2))) for n in ("bsd-2", "bsd-3")}
    got = _scanned(spark, [whole, military, changed, "Permission is hereby granted.", bsd["bsd-2"], bsd["bsd-3"], "x " + whole + " y " + bsd["bsd-2"]])
    assert got[0][0] == "mit" and got[0][1] > 0.9
    for label, score in got[1:3]:
        assert label == "" and 0 < score < 1
    assert got[3] == ("", 0.0)
    assert [g[0] for g in got[4:]] == ["bsd-2", "bsd-3", "bsd-2,mit"]


@pytest.mark.parametrize("text, labels", [
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
     "Software Foundation; either version 2.1 of the License", "lgpl"),
    ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gpl"),
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 3", "lgpl"),
    ("Creative Commons Attribution-NonCommercial 4.0 International", "cc-by-nc"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "cc-by-nc-sa"),
    ("Creative Commons Attribution 4.0 International Public License", "cc-by"),
    ("# SPDX-License-Identifier: Apache-2.0", "apache-2"), ("// SPDX-License-Identifier: GPL-2.0-only", "gpl"),
    ("released under the MIT license", "mit"), ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("This work is licensed under CC BY-NC 4.0", "cc-by-nc"), ("the general public has a license", ""),
])
def test_headers_titles_and_mentions(spark, text, labels):
    assert _scanned(spark, [text])[0][0] == labels


# --- Jaccard join ----------------------------------------------------------------------------

def near_copies(n, words, changes, seed):
    """Copies of one text with some words changed each."""
    r = random.Random(seed)
    first = [f"w{r.randrange(500)}" for _ in range(words)]
    made = []
    for i in range(n):
        mine = list(first)
        for _ in range(r.randrange(changes)):
            mine[r.randrange(words)] = f"x{r.randrange(10 ** 6)}"
        made.append((1000 * seed + i, " ".join(mine)))
    return made


def test_groups_by_all_pairs(small):
    docs, rows, _, _ = small
    sets = [(i, brute.shingles(t)) for i, t in rows]
    want = {i: (len(s), c if s else i) for (i, s), c in zip(sets, brute.components(sets))}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.groups(docs).collect()} == want


@pytest.mark.parametrize("tile", [4_000, 7])
def test_groups_of_near_copies_are_whole(spark, monkeypatch, tile):
    """Many sizes, links of every closeness, and buckets that must be cut into tiles."""
    monkeypatch.setattr(partenum, "TILE_ROWS", tile)
    rows = [r for s, (n, words, changes) in enumerate(
        [(60, 12, 3), (60, 30, 4), (60, 60, 6), (80, 150, 12), (40, 400, 30), (20, 1500, 90)], 1)
        for r in near_copies(n, words, changes, s)]
    sets = [(i, brute.shingles(t)) for i, t in rows]
    got = {r.doc_id: r.component_id for r in partenum.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for (i, _), c in zip(sets, brute.components(sets))}


@given(st.integers(1, 160), st.integers(0, 40), st.integers(0, 40), st.integers(0, 10 ** 6))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_signature(common, only_a, only_b, seed):
    r = np.random.default_rng(seed)
    made = np.unique(r.integers(0, 2 ** 63, common + only_a + only_b, dtype=np.uint64))
    r.shuffle(made)
    a, b = np.sort(made[:common + only_a]), np.sort(np.append(made[:common], made[common + only_a:]))
    owner, signature = partenum.signatures([a, b])
    if partenum.linked(a, b) and only_a + only_b:
        assert set(signature[owner == 0]) & set(signature[owner == 1])


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    got = {r["node"]: r["component"] for r in connect.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({(find(n), c) for n, c in got.items()}) == len({find(n) for n in got}) == len(set(got.values()))


# --- token counts ----------------------------------------------------------------------------

PIECES = st.sampled_from(["", " ", "  ", "\n", "x", " the end", "don't ' s", "é ü", ". ", " ", "a b c d e f g h " * 30])


@given(st.lists(PIECES, max_size=12), st.lists(st.tuples(st.integers(0, 400), st.integers(0, 60), PIECES), max_size=6))
@settings(max_examples=200, deadline=None)
def test_edited_trees_count_as_new_texts(pieces, edits):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    text = "".join(pieces)
    tree = token_counts.Tree.of(text, token_counts._counter(BYTE_BPE))
    for start, removed, inserted in edits:
        tree.edit(start, removed, inserted)
        start = min(start, len(text))
        text = text[:start] + inserted + text[start + removed:]
        assert tree.text == text and tree.chars[1] == len(text)
        assert tree.tokens[1] == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_a_table(spark, small):
    docs, rows, _, _ = small
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    edited = docs.select("doc_id", "text", token_counts.sample_edits().alias("edits"))
    texts = {}
    for r in edited.collect():
        text = r.text or ""
        for e in r.edits:
            text = text[:e.start] + e.inserted + text[e.start + e.removed:]
        texts[r.doc_id] = text
    n = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)        # noqa: E731
    before = dict(rows)
    for r in token_counts.counts(edited, BYTE_BPE).collect():
        text = texts[r.doc_id]
        assert (r.tokens_before, r.tokens_after, r.chars_after) == (n(before[r.doc_id] or ""), n(text), len(text))
        assert r.text_crc32 == zlib.crc32(text.encode())


def test_edits_from_a_table(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "four"), (1, 1, 4, 3, "five"), (2, 1, 9, 9, "new")],
                                  "doc_id long, nth int, start int, removed int, inserted string")
    state = token_counts.attach(token_counts.build(docs, BYTE_BPE), edits)
    got = {r.doc_id: "".join(r.leaves) for r in token_counts.apply(state, BYTE_BPE).collect()}
    assert got == {1: "four five three", 2: "new"}


# --- sharding --------------------------------------------------------------------------------

def test_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_ROWS", 17)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.shard(docs, 8).toPandas()
    rows = {r.doc_id: r for r in docs.collect()}
    sizes = got.groupby("shard").size()
    assert len(got) == len(rows) and sizes.max() - sizes.min() <= 1 and len(sizes) == 8
    for _, mine in got.groupby("shard"):
        assert sorted(mine.slot) == list(range(len(mine)))
    for r in got.itertuples():
        text = (rows[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    by_source = got.groupby(["stratum", "shard"]).size().unstack(fill_value=0)
    assert (by_source.max(axis=1) - by_source.min(axis=1)).max() <= 2
    again = sharding.shard(docs.repartition(5), 8).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


# --- rules, decontamination, language model --------------------------------------------------

def test_rule_statistics(small):
    docs, rows, labels, _ = small
    judged = {r.doc_id: r for r in rules.judge(docs, rules.fit(docs, labels)).collect()}
    for i, text in rows + [(None, "a b\n\na b\na b \n\x0b\n#x é|")]:
        want = brute.rule_stats(text)
        got = rules.statistics((text or "").encode())[:5]
        assert tuple(got) == want
        if i is not None:
            r = judged[i]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
            assert not (r.base_failed and r.kept)


def test_decontamination(spark, small):
    docs, rows, _, items = small
    listed = [(r.item_id, r.text) for r in items.collect()]
    short = [(900, "ouea onsh"), (901, listed[0][1]), (902, "the of"), (903, "nothere")]
    more = items.select("item_id", "text").unionByName(spark.createDataFrame(short, "item_id long, text string"))
    for given_items, want_items in ((items, listed), (more, listed + short)):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
               for r in decontaminate.find(docs, given_items).collect()}
        assert got == {i: brute.contamination(t, want_items) for i, t in rows}
    clean = {i for i, t in rows if not brute.contamination(t, listed)[4]}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).select("doc_id").collect()} == clean


def test_base_scores_and_held_out_fold(small):
    docs, rows, _, _ = small
    want = brute.unigram_scores(rows)
    for r in suffix_tree.score(docs, *suffix_tree.fit(docs)).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0


def _plain_tree(rows):
    """{doc_id: score} by dictionaries: the tree of the training rows, token by token."""
    S = suffix_tree
    texts = {i: [*brute.lowered(t), None] for i, t in rows}
    training = [ts for i, ts in texts.items() if brute.fold_of(i, 10)]
    words = Counter(w for ts in training for w in ts)
    tokens = sum(words.values())
    head = {w for w, n in words.items() if w is not None and n >= S.HEAD_SHARE * tokens}
    kind = lambda w: "end" if w is None else w if w in head else "other"                     # noqa: E731
    tail = sum(n for w, n in words.items() if kind(w) == "other")
    once = sum(n == 1 and w is not None for w, n in words.items())
    new = (once + 0.5) / (tail + 1) if tail else 1.0
    symbols = {"end": words[None], "other": tail, **{w: words[w] for w in head}}
    bottom = sum(symbols.values()) + 0.5 * len(symbols)
    follow = [defaultdict(Counter) for _ in range(S.DEPTH + 1)]
    line = lambda ts: ["start"] * S.DEPTH + [kind(w) for w in ts]                            # noqa: E731
    for ts in training:
        s = line(ts)
        for i in range(S.DEPTH, len(s)):
            for d in range(S.DEPTH + 1):
                follow[d][tuple(s[i - d:i])][s[i]] += 1
    least = max(S.LEAST_RUN, S.RUN_SHARE * tokens)
    follow = [{c: {k: n for k, n in m.items() if n >= least} for c, m in f.items()} for f in follow]
    states = []
    for d in range(1, S.DEPTH + 1):
        kept = {}
        for c, m in follow[d].items():
            total, shorter = sum(m.values()), follow[d - 1][c[1:]]
            gain = sum(n * math.log(n / total / (shorter[k] / sum(shorter.values()))) for k, n in m.items())
            if m and gain >= S.LEAST_GAIN + S.LEAST_EACH * len(m) and gain >= S.LEAST_DIVERGENCE * total:
                kept[c] = m
        states.append(kept)

    def probability(context, k):
        p = (symbols[k] + 0.5) / bottom
        for d in range(1, S.DEPTH + 1):
            m = states[d - 1].get(tuple(context[len(context) - d:]))
            if m is not None:
                weight = S.SMOOTHING + S.NOVELTY * len(m)
                p = (m.get(k, 0) + weight * p) / (sum(m.values()) + weight)
        return p

    out = {}
    for i, ts in texts.items():
        s, total = line(ts), 0.0
        for at, w in enumerate(ts):
            p = probability(s[at:at + S.DEPTH], s[at + S.DEPTH])
            if s[at + S.DEPTH] == "other":
                p *= (1 - new) * words[w] / tail if words[w] else new
            total += math.log10(p)
        out[i] = total
    return out, [len(k) for k in states]


def test_states_and_scores_are_those_of_a_plain_tree(small):
    docs, rows, _, _ = small
    want, sizes = _plain_tree(rows)
    model, counts = suffix_tree.fit(docs)
    assert [len(s) for s in model.states] == sizes and min(sizes) > 0
    for r in suffix_tree.score(docs, model, counts).collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


def test_the_tree_scores_held_out_texts_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = suffix_tree.score(docs, *suffix_tree.fit(docs)).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert made["sum(score)"] > 0.9 * made["sum(base_score)"]


def test_tree_probabilities_add_up_and_follow_contexts(spark):
    rows = [(i, "one two three two one four " * 20 + f"rare{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = suffix_tree.fit(docs)
    symbols = np.arange(len(model.head.words) + suffix_tree.FIRST)
    assert len(model.states[0]) and np.isclose(model.head.root().sum(), 1)
    for context in (0, *model.states[0].tolist(), *model.states[1].tolist()):
        code = np.full(len(symbols), context, np.int64) << suffix_tree.BITS | symbols
        assert np.isclose(model.probabilities(code, symbols).sum(), 1)
    texts = spark.createDataFrame([(1, "one two three"), (2, "one three two"), (3, "one two zzz")], docs.schema)
    usual, odd, new = [r.score for r in suffix_tree.score(texts, model, counts).orderBy("doc_id").collect()]
    assert usual > odd and usual > new


def test_few_sets_are_held_at_once(spark, monkeypatch):
    """pipeline: tasks make and compare the sets of 500 texts or pairs at once, whatever a batch holds."""
    asked, known = [], partenum.per_batch
    monkeypatch.setattr(partenum, "per_batch", lambda df, rows, schema, at_once=None:
                        asked.append((df.columns, at_once)) or known(df, rows, schema, at_once))
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[:50 + i % 3] if i < 1_500 else [f"{i}-{k}" for k in range(9)])) for i in range(1_600)],
                                 "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.component_id, r.class_id) for r in partenum.groups(docs).collect()}
    assert got == {i: (0, i % 3) if i < 1_500 else (i, i) for i in range(1_600)}
    held = [n for columns, n in asked if {"_text", "elements_a"} & set(columns)]
    assert len(held) > 2 and all(n and n <= 500 for n in held)
