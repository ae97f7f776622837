"""License scans by template markup: optional and replaceable regions compiled to automata.

A template is license wording with two kinds of markup, as license lists publish it:

    <<beginOptional>> ... <<endOptional>>     these words may be missing (regions may nest)
    <<var:N>>                                 up to N words that may be anything
    <<var:N=a|b c>>                           one of the given wordings, or nothing else

It compiles to a token automaton without empty moves: states are places in the wording, and a
move reads one word. A text holds the license where the automaton, started at some word, reaches
its end, so all mandatory wording stands there exactly and in order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanframe.llm.common import column, folded_words, per_batch, text_bytes

#: Base phrases and their labels (fixed values).
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_SOFTWARE = "<<var:3=the software|this software|the program>>"
_PARTY = "<<var:12>>"
_BSD_TERMS = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code "
    "must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice this "
    "list of conditions and the following disclaimer in the documentation and or other materials provided with the "
    "distribution ")
_BSD_NAMES = (
    "<<beginOptional>>3<<endOptional>> neither the name of " + _PARTY + " nor the names of "
    "<<var:3=its contributors|the contributors|contributors|other contributors>> may be used to endorse or promote "
    "products derived from this software without specific prior written permission ")
_BSD_DISCLAIMER = (
    "this software is provided by " + _PARTY + " as is and any express or implied warranties including but not limited "
    "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    + _PARTY + " be liable for any direct indirect incidental special exemplary or consequential damages including but "
    "not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
_GNU_NOTICE = (
    "you can redistribute it and or modify it under the terms of the gnu {name} <<beginOptional>>version <<var:2={versions}>>"
    "<<endOptional>> as published by the free software foundation <<beginOptional>><<beginOptional>>either<<endOptional>> "
    "version <<var:2={versions}>> of the license <<beginOptional>>or <<beginOptional>>at your option<<endOptional>> any later "
    "version<<endOptional>><<endOptional>>")
_CC = "creative commons {name} <<var:2=4 0|3 0|2 5|2 0|1 0>> <<beginOptional>><<var:1=international|unported|generic>><<endOptional>>"

#: Wording of public licenses, their headers and mentions as templates (fixed values).
TEMPLATES = {
    "mit": (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files <<beginOptional>>the software<<endOptional>> to deal in " + _SOFTWARE +
        " without restriction including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of " + _SOFTWARE + " and to permit persons to whom " + _SOFTWARE + " is furnished "
        "to do so subject to the following conditions the above copyright notice and this permission notice "
        "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial "
        "portions of " + _SOFTWARE + " " + _SOFTWARE + " is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "<<var:2=noninfringement|non infringement>> in no event shall " + _PARTY + " be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        + _SOFTWARE + " or the use or other dealings in " + _SOFTWARE),
    "bsd-2": ("bsd-2", _BSD_TERMS + _BSD_DISCLAIMER),
    "bsd-3": ("bsd-3", _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER),
    "isc": (
        "isc",
        "permission to use copy modify <<var:2=and or|and>> distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and " + _PARTY + " disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall " + _PARTY + " be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use "
        "or performance of this software"),
    "apache-header": (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at <<var:1=http|https>> www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license"),
    "mpl-header": (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at <<var:1=http|https>> <<beginOptional>>www<<endOptional>> mozilla org mpl 2 0"),
    "gpl-header": ("gpl", _GNU_NOTICE.format(name="general public license", versions="2|3|2 0|3 0")),
    "lgpl-header": ("lgpl", _GNU_NOTICE.format(name="<<var:1=lesser|library>> general public license", versions="2|2 1|3|2 0|3 0")),
    "agpl-header": ("agpl", _GNU_NOTICE.format(name="affero general public license", versions="3|3 0")),
    "gpl-title": ("gpl", "gnu general public license <<var:2=version|v>> <<var:2=2|3|2 0|3 0>>"),
    "lgpl-title": ("lgpl", "gnu <<var:1=lesser|library>> general public license <<var:2=version|v>> <<var:2=2|2 1|3|2 0|3 0>>"),
    "agpl-title": ("agpl", "gnu affero general public license <<var:2=version|v>> <<var:2=3|3 0>>"),
    "apache-title": ("apache-2", "apache license version 2 0 january 2004"),
    "cc-by-nc": ("cc-by-nc", _CC.format(name="<<var:3=attribution noncommercial|attribution non commercial>>")),
    "cc-by-nc-sa": ("cc-by-nc-sa", _CC.format(name="<<var:3=attribution noncommercial|attribution non commercial>> <<var:2=sharealike|share alike>>")),
    "cc-by-sa": ("cc-by-sa", _CC.format(name="attribution <<var:2=sharealike|share alike>>")),
    "cc-by": ("cc-by", _CC.format(name="attribution")),
    "mit-mention": (
        "mit", "<<var:1=released|licensed|distributed|available>> under the <<beginOptional>>terms of the"
               "<<endOptional>> mit license"),
    "apache-mention": (
        "apache-2",
        "<<var:1=released|licensed|distributed|available>> under the <<beginOptional>>terms of the<<endOptional>> "
        "apache license version 2 <<beginOptional>>0<<endOptional>>"),
    "cc-by-nc-mention": (
        "cc-by-nc",
        "<<var:1=licensed|released|available>> under <<beginOptional>><<var:1=a|the>><<endOptional>> "
        "<<var:2=cc|creative commons>> <<var:3=by nc|attribution noncommercial|attribution non commercial>> "
        "<<var:2=4 0|3 0|license>>"),
    "gpl-mention": (
        "gpl",
        "<<var:1=released|licensed|distributed|available>> under the <<beginOptional>>terms of the"
        "<<endOptional>> gnu general public license <<beginOptional>>version <<var:1=2|3>><<endOptional>>"),
}
#: Identifiers of SPDX lines and the labels they give (fixed values).
SPDX = {"mit": "mit", "isc": "isc", "bsd 2 clause": "bsd-2", "bsd 3 clause": "bsd-3", "apache 2 0": "apache-2", "mpl 2 0": "mpl-2",
        "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl",
        "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "cc by nc sa 4 0": "cc-by-nc-sa"}
TEMPLATES |= {f"spdx {name}": (label, f"spdx license identifier {name}") for name, label in SPDX.items()}
TEMPLATES |= {f"base {phrase}": (label, phrase) for phrase, label in BASE_PHRASES.items()}

_MARK = re.compile(r"<<(.*?)>>", re.S)


@dataclass
class Automaton:
    """moves[state] = {word: next states}; other[state] = next states for any word."""

    label: str
    base: bool
    starts: frozenset[int] = frozenset()
    accept: set[int] = field(default_factory=set)
    moves: list[dict[bytes, tuple[int, ...]]] = field(default_factory=list)
    other: list[tuple[int, ...]] = field(default_factory=list)
    loose: set[int] = field(default_factory=set)       # states entered by words of a free region
    least: int = 0                                     # words of the shortest text that it accepts

    @property
    def first_words(self) -> set[bytes]:
        return {w for s in self.starts for w in self.moves[s]}

    def match(self, words: list[bytes], at: int) -> tuple[int, float] | None:
        """The longest match from `at`: its end, and the share of its words that the template fixes."""
        return self.read(words, at)[0]

    def read(self, words: list[bytes], at: int) -> tuple[tuple[int, float] | None, int]:
        """The longest match from `at`, and the fixed words of the template that stand there one after the other, whether or
        not it matches."""
        live, best, read = {s: 0 for s in self.starts}, None, 0
        for i in range(at, len(words)):
            after: dict[int, int] = {}
            for state, free in live.items():
                for to in (*self.moves[state].get(words[i], ()), *self.other[state]):
                    spent = free + (to in self.loose)
                    if after.get(to, spent + 1) > spent:
                        after[to] = spent
            if not after:
                break
            live = after
            read = i + 1 - at - min(live.values())
            done = [n for s, n in live.items() if s in self.accept]
            if done:
                best = i + 1, 1 - min(done) / (i + 1 - at)
        return best, read


def compile_template(text: str, label: str = "", base: bool = False) -> Automaton:
    """Thompson's construction over the markup, then the empty moves are folded away."""
    empty: list[set[int]] = []
    steps: list[tuple[int, bytes | None, int]] = []
    loose: set[int] = set()

    def state() -> int:
        empty.append(set())
        return len(empty) - 1

    def read(at: int, wording: str) -> int:
        for word in folded_words(wording.encode()):
            to = state()
            steps.append((at, word, to))
            at = to
        return at

    begin = at = state()
    opened: list[int] = []
    for i, part in enumerate(_MARK.split(text)):
        if i % 2 == 0:
            at = read(at, part)
        elif part == "beginOptional":
            opened.append(at)
        elif part == "endOptional":
            if not opened:
                raise ValueError("endOptional without beginOptional")
            to = state()
            empty[at].add(to)
            empty[opened.pop()].add(to)
            at = to
        elif m := re.fullmatch(r"var:(\d+)(?:=(.*))?", part, re.S):
            end = state()
            if m[2] is None:
                for _ in range(int(m[1])):
                    empty[at].add(end)
                    to = state()
                    steps.append((at, None, to))
                    loose.add(to)
                    at = to
                empty[at].add(end)
            else:
                for choice in m[2].split("|"):
                    if len(folded_words(choice.encode())) > int(m[1]):
                        raise ValueError(f"{choice!r} has more than {m[1]} words")
                    empty[read(at, choice)].add(end)
            at = end
        else:
            raise ValueError(f"unknown markup <<{part}>>")
    if opened:
        raise ValueError("beginOptional without endOptional")

    def closure(s: int) -> set[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in empty[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return seen

    near = [closure(s) for s in range(len(empty))]
    made = Automaton(label, base, frozenset([begin]), loose=loose)
    distance, todo = {t: 0 for t in near[begin]}, list(near[begin])
    for s in todo:                                     # every step reads one word: nearest states first
        for a, _, b in steps:
            for t in near[b] if a == s else ():
                if t not in distance:
                    distance[t] = distance[s] + 1
                    todo.append(t)
    made.least = distance[at]
    for s in range(len(empty)):
        words: dict[bytes, set[int]] = {}
        free: set[int] = set()
        for a, word, b in steps:
            if a in near[s]:
                (free if word is None else words.setdefault(word, set())).add(b)
        made.moves.append({w: tuple(sorted(t)) for w, t in words.items()})
        made.other.append(tuple(sorted(free)))
        if at in near[s]:
            made.accept.add(s)
    if begin in made.accept or made.other[begin]:
        raise ValueError("a template must begin with mandatory wording or a choice")
    return made


@lru_cache(4)
def automata(templates: tuple[tuple[str, str, bool], ...]) -> tuple[Automaton, ...]:
    return tuple(compile_template(text, label, base) for label, text, base in templates)


#: Fixed words of a template that must stand one after the other for its beginning to count as a part of it.
LEAST_PART = 8


def find(words: list[bytes], compiled: tuple[Automaton, ...]) -> tuple[list[tuple[Automaton, int, int, float]], float]:
    """(automaton, first word, end, share of fixed words) of every place, by first word; and the largest part of a
    template, below 1, whose beginning stands somewhere without the rest.

    Only words that can begin a template are tried, so the time is linear in the text.
    """
    by_word: dict[bytes, list[Automaton]] = {}
    for a in compiled:
        for w in a.first_words:
            by_word.setdefault(w, []).append(a)
    found: list[tuple[Automaton, int, int, float]] = []
    if by_word.keys().isdisjoint(words):
        return found, 0.0
    part = 0.0
    for at, word in enumerate(words):
        for a in by_word.get(word, ()):
            hit, read = a.read(words, at)
            if hit:
                found.append((a, at, *hit))
            elif read >= LEAST_PART:
                part = max(part, min(0.99, read / max(a.least, 1)))
    return found, part


def scan(docs: DataFrame, templates: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, n_matches.

    A label needs all mandatory wording of a template, in order and exactly. The score is the share of
    fixed words in the best match; without a match, the part of a template (below 1) whose beginning stands in the
    text before the wording departs from it, from LEAST_PART words on; else 0.
    `templates` maps a name to (label, template); names that start with "base " count as base.
    Null and empty texts have no words and no labels. Each row is scanned by itself, whole, so
    repeated rows, ties and hot sources need nothing special. Other columns are not read.
    """
    chosen = tuple((label, text, name.startswith("base "))
                   for name, (label, text) in (templates or TEMPLATES).items())
    automata(chosen)                                    # a faulty template fails here, not in a task

    def rows(batch: pa.RecordBatch) -> dict:
        compiled = automata(chosen)
        out = {n: [] for n in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                               "score", "n_matches")}
        for text in column(batch, "_text"):
            words = folded_words(text)
            found, part = find(words, compiled)
            base = [at for a, at, _, _ in found if a.base]
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(min(base, default=None))
            out["last_word"].append(max(base, default=None))
            out["base_labels"].append(",".join(sorted({a.label for a, *_ in found if a.base})))
            out["labels"].append(",".join(sorted({a.label for a, *_ in found})))
            out["score"].append(float(np.clip(max((s for *_, s in found), default=part), 0, 1)))
            out["n_matches"].append(len(found))
        return {"doc_id": batch.column(0), **out}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", text_bytes().alias("_text")), rows,
                     f"doc_id {key}, n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double, n_matches long")
