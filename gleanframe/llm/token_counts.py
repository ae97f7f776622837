"""Token counts that follow edits: segment trees over the pre-tokens of a document.

A byte-level tokenizer never joins a blank to the word before it, so a text may be cut before
any single blank between two visible characters, and the cut parts are encoded apart with the same result.
Leaves hold a few dozen such parts; above them stands a binary tree of sums of characters and
tokens. An edit goes down the tree to the leaves it touches, takes one neighbour more where a cut is no longer
before a single blank, encodes that region alone and adds up the sums on its way to the root.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanframe.llm.common import Cached, column, per_batch

#: Parts in a leaf, and characters beyond which an edited leaf is cut anew.
LEAF_PARTS, LEAF_CHARS = 32, 4096

STATE = "leaves array<string>, chars array<int>, tokens array<int>"
EDITS = "array<struct<start:int,removed:int,inserted:string>>"


@lru_cache(1)
def _counter(path: str) -> Cached:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return Cached(lambda part: len(tokenizer.encode(part, add_special_tokens=False).ids))


def parts_of(text: str) -> list[str]:
    """The text cut before every single blank between visible characters."""
    made: list[str] = []
    for i, piece in enumerate(text.split(" ")):
        if i == 0:
            made.append(piece)
        elif piece and not piece[0].isspace() and made[-1] and not made[-1][-1].isspace():
            made.append(" " + piece)
        else:
            made[-1] += " " + piece
    return made if text else []


class Tree:
    """A document: leaf texts, and sums of their characters and tokens in heap order (root at 1)."""

    def __init__(self, leaves: list[str], chars: list[int], tokens: list[int], known: Cached):
        self.leaves, self.chars, self.tokens, self.known = leaves, chars, tokens, known
        self.size = len(chars) // 2
        self.encoded = 0                                # characters encoded since it was made

    @classmethod
    def of(cls, text: str, known: Cached) -> Tree:
        parts = parts_of(text)
        leaves = ["".join(parts[i:i + LEAF_PARTS]) for i in range(0, len(parts), LEAF_PARTS)]
        counts = [sum(map(known.__getitem__, parts[i:i + LEAF_PARTS])) for i in range(0, len(parts), LEAF_PARTS)]
        return cls.over(leaves, counts, known)

    @classmethod
    def over(cls, leaves: list[str], counts: list[int], known: Cached) -> Tree:
        size = 1
        while size < len(leaves):
            size *= 2
        sums = []
        for values in ([len(x) for x in leaves], counts):
            heap = [0] * size + values + [0] * (size - len(values))
            for i in range(size - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            sums.append(heap)
        return cls(leaves + [""] * (size - len(leaves)), *sums, known)

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def locate(self, at: int) -> tuple[int, int]:
        """(leaf, place in it) of the character `at`; the end of the text is in the last leaf with text."""
        at = min(at, self.chars[1])
        last = at == self.chars[1]
        node = 1
        while node < self.size:
            node *= 2
            # At the very end go where the last character is.
            if at > self.chars[node] or at == self.chars[node] and (not last or self.chars[node + 1]):
                at -= self.chars[node]
                node += 1
        return node - self.size, at

    def _set(self, leaf: int, text: str, count: int) -> None:
        node = leaf + self.size
        more_chars, more_tokens = len(text) - self.chars[node], count - self.tokens[node]
        self.leaves[leaf] = text
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replaces `removed` characters from `start` on. Both are kept within the text."""
        n = self.chars[1]
        start = max(0, min(start, n))
        removed = max(0, min(removed, n - start))
        if not removed and not inserted:
            return
        low, at = self.locate(start)
        high, end = self.locate(start + removed)
        if low == high:
            region = self.leaves[low][:at] + inserted + self.leaves[low][end:]
        else:
            region = self.leaves[low][:at] + inserted + self.leaves[high][end:]
        # Boundary context: leaves must begin with a single blank between visible characters.
        while True:
            left = next((i for i in range(low - 1, -1, -1) if self.leaves[i]), None)
            right = next((i for i in range(high + 1, self.size) if self.leaves[i]), None)
            if left is not None and not (len(region) > 1 and region[0] == " " and not region[1].isspace()) and (
                    region or right is None or self.leaves[right][0] != " "):
                low, region = left, self.leaves[left] + region
            elif right is not None and region and region[-1].isspace():
                high, region = right, region + self.leaves[right]
            else:
                break
        self.encoded += len(region)
        count = sum(map(self.known.__getitem__, parts_of(region)))
        self._set(low, region, count)
        for leaf in range(low + 1, high + 1):
            if self.leaves[leaf]:
                self._set(leaf, "", 0)
        if len(region) > LEAF_CHARS:
            self._recut(low)

    def _recut(self, leaf: int) -> None:
        """A leaf that grew large is cut into leaves; the tree is built again from the kept counts."""
        parts = parts_of(self.leaves[leaf])
        cut = [(parts[i:i + LEAF_PARTS]) for i in range(0, len(parts), LEAF_PARTS)]
        if len(cut) < 2:
            return
        leaves, counts = [], []
        for i, text in enumerate(self.leaves):
            if i == leaf:
                leaves += ["".join(c) for c in cut]
                counts += [sum(map(self.known.__getitem__, c)) for c in cut]
            elif text:
                leaves.append(text)
                counts.append(self.tokens[i + self.size])
        made = Tree.over(leaves, counts, self.known)
        self.leaves, self.chars, self.tokens, self.size = made.leaves, made.chars, made.tokens, made.size


def build(docs: DataFrame, tokenizer: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, leaves, chars, tokens): the tree of every document, to be kept as a table.

    tokens[1] is the document's count. Null and empty texts have one empty leaf and no tokens.
    """
    kept = ["doc_id", *carry]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]

    def rows(batch: pa.RecordBatch) -> dict:
        known = _counter(tokenizer)
        trees = [Tree.of(t or "", known) for t in column(batch, "_text")]
        return {**{c: batch.column(i) for i, c in enumerate(kept)}, "leaves": [t.leaves for t in trees],
                "chars": [t.chars for t in trees], "tokens": [t.tokens for t in trees]}

    return per_batch(docs.select(*kept, F.col("text").alias("_text")), rows, ", ".join([*kinds, STATE]))


def attach(state: DataFrame, edits: DataFrame) -> DataFrame:
    """The state with a column `edits`, from rows (doc_id, nth, start, removed, inserted) in order of nth.

    The edits of one document are one array, as they change one text one after the other.
    """
    one = F.struct("nth", F.struct(
        F.col("start").cast("int").alias("start"), F.col("removed").cast("int").alias("removed"), "inserted").alias("e"))
    by_doc = (edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("_all"))
              .select("doc_id", F.transform("_all", lambda x: x["e"]).alias("edits")))
    return state.join(by_doc, "doc_id", "left")


def apply(state: DataFrame, tokenizer: str) -> DataFrame:
    """The state after its column `edits`: with tokens_before, tokens_after, n_edits, chars_encoded.

    Places count in characters of the text at the time of the edit and are kept within it. A
    null start, length or text is 0, 0 or empty; a null array is no edit. Rows are edited by
    themselves, so repeated rows get the same result and a hot source needs nothing special.
    """
    key = state.schema["doc_id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        known = _counter(tokenizer)
        out = {n: [] for n in ("leaves", "chars", "tokens", "tokens_before", "tokens_after", "n_edits", "chars_encoded")}
        for leaves, chars, tokens, edits in zip(*(column(batch, c) for c in ("leaves", "chars", "tokens", "edits"))):
            tree = Tree(leaves, chars, tokens, known)
            out["tokens_before"].append(tree.tokens[1])
            for e in edits or ():
                tree.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
            out["leaves"].append(tree.leaves)
            out["chars"].append(tree.chars)
            out["tokens"].append(tree.tokens)
            out["tokens_after"].append(tree.tokens[1])
            out["n_edits"].append(len(edits or ()))
            out["chars_encoded"].append(tree.encoded)
        return {"doc_id": batch.column(0), **out}

    return per_batch(state.select("doc_id", "leaves", "chars", "tokens", "edits"), rows,
                     f"doc_id {key}, {STATE}, tokens_before long, tokens_after long, n_edits int, chars_encoded long")


def sample_edits(text: str = "text", key: str = "doc_id"):
    """Three edits of a row, drawn from its key: a replacement, an insertion and a deletion.

    The inserted words are the text's own, so that the query needs no other table.
    """
    n = f"length(coalesce({text}, ''))"
    place = lambda i: f"cast(pmod(xxhash64({key}, {i}), {n} + 1) AS int)"           # noqa: E731
    taken = lambda i, size: f"substring(coalesce({text}, ''), 1 + {place(i)}, {size})"      # noqa: E731
    return F.expr(
        f"array(named_struct('start', {place(1)}, 'removed', 40, 'inserted', {taken(2, 25)}), "
        f"named_struct('start', {place(3)}, 'removed', 0, 'inserted', {taken(4, 60)}), "
        f"named_struct('start', {place(5)}, 'removed', 60, 'inserted', ''))").cast(EDITS)


def counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per document: counts before and after its column `edits`, and a checksum of the edited text."""
    after = apply(build(docs, tokenizer, ("edits",)), tokenizer)
    joined = F.array_join("leaves", "")
    return after.select("doc_id", "n_edits", "tokens_before", "tokens_after", "chars_encoded",
                        F.length(joined).cast("long").alias("chars_after"),
                        F.crc32(joined.cast("binary")).alias("text_crc32"))
