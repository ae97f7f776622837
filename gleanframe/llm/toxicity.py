"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of three hashed embedding rows: of the word, and of its first four and six
characters. Filters of widths 1, 2 and 3 slide over the words, their largest values in the
whole text are pooled, and a logistic unit reads them. Training passes gradients through the
pooled places only. Because a filter is linear in the embeddings, a trained model is one table
of (hash row, width, place, filter), so scoring is a sum of table rows and a running maximum.

Cuts are calibrated by language, guessed from the words of the text itself (a small table in the
same hash rows, learned beside the filters), and moved onto one common score, CUT.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gleanframe.llm.common import Cached, column, labelled_sample, lowered_words, per_batch, text_bytes

#: Labelled rows of each class that the model is fitted to at most.
SAMPLE = 3_500
BITS, DIM, FILTERS, WIDTHS = 16, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 8, 32, 0.05
CUT = 0.3
HELD_OUT, FOLDS = 2, 4
#: Words scored at once.
CHUNK = 100_000
#: Toxic rows that a language needs for a cut of its own.
LEAST_TOXIC = 15

_STRIP = b".,;:!?*#$%&\"'()|"
_ROWS = 1 << BITS
_EACH = len(WIDTHS) * FILTERS


def _hashes(word: bytes) -> int:
    low = word.strip(_STRIP).decode("utf-8", "replace")
    packed = 0
    for part in ("w" + low, "4" + low[:4], "6" + low[:6]):
        packed = packed << 20 | xxhash.xxh3_64_intdigest(part.encode()) & _ROWS - 1
    return packed


_HASHES = Cached(_hashes)


def word_rows(text: bytes) -> np.ndarray:
    """(words, 3) hash rows of a whole text."""
    packed = _HASHES.array(lowered_words(text), np.int64)
    return np.column_stack([packed >> 40, packed >> 20 & 0xFFFFF, packed & 0xFFFFF]).astype(np.int32)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the rows whose labels are never learned."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    table: np.ndarray                # (hash rows, places of all widths * filters + languages)
    bias: np.ndarray                 # of the filters, width by width
    out: np.ndarray
    out_bias: float
    prior: np.ndarray                # of the languages
    cuts: np.ndarray                 # by language

    def pooled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(filters, languages) sums of every text. Long texts go through in overlapping pieces."""
        most = np.zeros((len(texts), _EACH))
        tongue = np.zeros((len(texts), len(self.prior))) + self.prior
        for i, rows in enumerate(texts):
            for at in range(0, len(rows), CHUNK):
                part = rows[max(0, at - max(WIDTHS) + 1):at + CHUNK]
                values = self.table[part[:, 0]] + self.table[part[:, 1]] + self.table[part[:, 2]]
                tongue[i] += values[min(at, max(WIDTHS) - 1):, 6 * FILTERS:].sum(0)
                first = 0
                for k, width in enumerate(WIDTHS):
                    n = len(part) - width + 1
                    if n > 0:
                        total = sum(values[j:j + n, (first + j) * FILTERS:(first + j + 1) * FILTERS]
                                    for j in range(width))
                        mine = slice(k * FILTERS, (k + 1) * FILTERS)
                        most[i, mine] = np.maximum(most[i, mine], total.max(0) + self.bias[mine])
                    first += width
        return most, tongue

    def raw(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, guessed language) of each text."""
        most, tongue = self.pooled(texts)
        return most @ self.out + self.out_bias, tongue.argmax(1)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        z, tongue = self.raw(texts)
        return _sigmoid(z - _logit(self.cuts[tongue]) + _logit(np.array(CUT)))


def _start(rows: list[np.ndarray], toxic: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Embeddings near 0; the first dimension starts at the smoothed log odds of a hash row."""
    emb = rng.normal(0, 0.1, (_ROWS, DIM))
    seen = [np.zeros(_ROWS), np.zeros(_ROWS)]
    for r, y in zip(rows, toxic):
        seen[int(y)][np.unique(r)] += 1
    share = [(s + 0.5) / (max(1, np.sum(toxic == y)) + 1) for y, s in enumerate(seen)]
    emb[:, 0] = np.clip(np.log(share[1] / share[0]), -1, 3) * (seen[0] + seen[1] >= 3) / 3
    return emb


def train(rows: list[np.ndarray], toxic: np.ndarray, langs: list[str | None], seed: int = 42) -> Model:
    """A model from texts as hash rows; a quarter of them calibrates the cuts."""
    rng = np.random.default_rng(seed)
    held = rng.random(len(rows)) < 0.25
    learn = np.flatnonzero(~held)
    known = sorted({x for x in langs if x is not None}) or [""]

    emb = _start([rows[i] for i in learn], toxic[learn], rng)
    filters = [rng.normal(0, 0.3, (w * DIM, FILTERS)) for w in WIDTHS]
    for f, w in zip(filters, WIDTHS):
        f[::DIM, :] += 1.0 / w                          # at the start each filter likes odd words
    bias, out, out_bias = np.zeros(_EACH), np.full(_EACH, 0.3), np.array(-1.0)
    params = [emb, *filters, bias, out, out_bias]
    squares = [np.full_like(p, 1e-2) for p in params]

    def step(k: int, grad: np.ndarray, at=...) -> None:
        squares[k][at] += grad * grad
        params[k][at] -= RATE * grad / np.sqrt(squares[k][at])

    for _ in range(EPOCHS if toxic[learn].any() and not toxic[learn].all() else 0):
        for batch in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
            grads = [np.zeros_like(p) for p in params[1:]]
            touched, pulled = [], []
            for i in batch:
                if not len(rows[i]):
                    continue
                x = emb[rows[i]].sum(1)
                pooled, where = np.zeros(_EACH), np.full(_EACH, -1)
                for k, w in enumerate(WIDTHS):
                    n = len(x) - w + 1
                    if n <= 0:
                        continue
                    z = sum(x[j:j + n] @ filters[k][j * DIM:(j + 1) * DIM] for j in range(w))
                    best = z.argmax(0)
                    value = z[best, np.arange(FILTERS)] + bias[k * FILTERS:(k + 1) * FILTERS]
                    pooled[k * FILTERS:(k + 1) * FILTERS] = np.maximum(value, 0)
                    where[k * FILTERS:(k + 1) * FILTERS] = np.where(value > 0, best, -1)
                error = float(_sigmoid(pooled @ out + out_bias) - toxic[i]) / len(batch)
                grads[-2] += error * pooled
                grads[-1] += error
                for f in np.flatnonzero(where >= 0):
                    k, c = divmod(f, FILTERS)
                    w, g = WIDTHS[k], error * out[f]
                    window = slice(where[f], where[f] + w)
                    grads[k][:, c] += g * x[window].ravel()
                    grads[-3][f] += g
                    pull = g * filters[k][:, c].reshape(w, DIM)
                    touched.append(rows[i][window].ravel())
                    pulled.append(np.repeat(pull, 3, axis=0))
            for k, g in enumerate(grads, 1):
                step(k, g)
            if touched:
                at, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                total = np.zeros((len(at), DIM))
                np.add.at(total, inverse, np.concatenate(pulled))
                step(0, total, at)

    table = np.concatenate([emb @ f[j * DIM:(j + 1) * DIM] for f, w in zip(filters, WIDTHS) for j in range(w)], axis=1)
    words = np.ones((len(known), _ROWS)) * 0.1
    docs = np.ones(len(known))
    for r, lang in zip(rows, langs):
        if lang is not None:
            words[known.index(lang)] += np.bincount(r.ravel(), minlength=_ROWS)
            docs[known.index(lang)] += 1
    tongue = np.log(words / words.sum(1, keepdims=True)).T
    tongue -= tongue.mean(1, keepdims=True)
    # Three rows are summed for a word; only its first one tells the language.
    model = Model(np.concatenate([table, np.zeros((_ROWS, len(known)))], 1).astype(np.float32), bias, out,
                  float(out_bias), np.log(docs / docs.sum()), np.full(len(known), 0.5))
    model.table[:, 6 * FILTERS:] = tongue
    _calibrate(model, [rows[i] for i in np.flatnonzero(held)], toxic[held])
    return model


def _best_cut(p: np.ndarray, toxic: np.ndarray) -> float:
    """Middle of the range of cuts with the best F1."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + toxic.sum())
    k = len(f1) - 1 - int(np.argmax(f1[::-1]))
    return float((p[order[k]] + (p[order[k + 1]] if k + 1 < len(p) else 0)) / 2)


def _calibrate(model: Model, rows: list[np.ndarray], toxic: np.ndarray) -> None:
    if not toxic.any():
        return
    z, tongue = model.raw(rows)
    p = _sigmoid(z)
    model.cuts[:] = _best_cut(p, toxic)
    for lang in range(len(model.cuts)):
        mine = tongue == lang
        if toxic[mine].sum() >= LEAST_TOXIC:
            model.cuts[lang] = _best_cut(p[mine], toxic[mine])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, seed: int = 42) -> Model:
    """A model from at most `most` toxic and `most` other labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels.where(~held_out()), most, ["toxic"], "toxic > 0")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def rows(batch: pa.RecordBatch) -> dict:
        return {"toxic": batch.column(0).cast(pa.int64()), "lang": batch.column(1),
                "rows": [word_rows(t).tobytes() for t in column(batch, "_text")]}

    got = per_batch(sample.select("toxic", lang.alias("lang"), text_bytes().alias("_text")), rows,
                    "toxic long, lang string, rows binary").toPandas()         # <= 2 * most rows
    got = got.sort_values(["toxic", "rows"])
    hashed = [np.frombuffer(r, np.int32).reshape(-1, 3) for r in got.rows]
    langs = [x if isinstance(x, str) else None for x in got.lang]
    return train(hashed, (got.toxic.to_numpy() > 0).astype(float), langs, seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from CUT on).

    The score reads the text alone, the whole of it. Null and empty texts have no words and get
    the score of no filter firing. A null doc_id counts as empty text for the fold. Repeated
    rows get equal scores; other columns are not read.
    """
    def rows(batch: pa.RecordBatch) -> dict:
        got = model.score([word_rows(t) for t in column(batch, "_text")]) if batch.num_rows else np.zeros(0)
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": got,
                "predicted": (got >= CUT).astype(np.int32)}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", held_out().alias("held_out"), text_bytes().alias("_text")), rows,
                     f"doc_id {key}, held_out boolean, score double, predicted int")
