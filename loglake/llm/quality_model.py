"""Quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded, a gated attention network weighs
the passages of a text, and the weighted sum of their encodings is scored. Only document
labels train it: the fit runs on a bounded sample, the scoring is one map over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.quality_rules import _again
from loglake.llm.toxicity import sample
from loglake.llm.words import IS_SPACE, Slice, shingles, slices, words

PASSAGE_WORDS = 64
ENCODING = 16
GATES = 8
EPOCHS = 400
RATE = 0.02
DECAY = 1e-4
SEED = 7

#: Byte classes whose share of a passage's bytes is a feature.
CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "symbol": b"#*$%&|<>",
    "loud": b"!?",
    "stop": b".",
    "comma": b",;:",
    "quote": b"\"'()[]{}",
    "path": b"/\\=_@~^`+-",
    "beyond": range(128, 256),
    "line": b"\n",
}
_CLASS = np.zeros((len(CLASSES), 256), np.int32)
for _row, _members in enumerate(CLASSES.values()):
    _CLASS[_row, list(_members)] = 1
FEATURES = len(CLASSES) + 7


@dataclass
class Passages:
    text: np.ndarray
    features: np.ndarray


def passages(piece: Slice) -> Passages:
    """Features of every passage of ``PASSAGE_WORDS`` words; a text without words has one empty passage."""
    found = words(piece)
    counts = found.counts
    per_text = np.maximum(1, -(-counts // PASSAGE_WORDS))
    offset = np.concatenate(([0], np.cumsum(per_text)))
    place = np.arange(len(found.text)) - found.first[found.text]
    passage = offset[found.text] + place // PASSAGE_WORDS
    total = int(offset[-1])
    text = np.repeat(np.arange(piece.size), per_text)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, minlength=total)

    letters = (piece.data & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(letters, dtype=np.int64)))
    length = (chars[found.end] - chars[found.start]).astype(float)
    n = np.maximum(np.bincount(passage, minlength=total), 1).astype(float)
    values, at = shingles(found, 3)
    _, repeated = _again(found.text[at], values)
    same = np.zeros(len(found.hash))
    same[at[repeated]] = 1
    seen, _ = _again(passage, found.hash)
    mean = summed(length) / n
    out = np.empty((total, FEATURES))
    out[:, 0] = np.log1p(n - (np.bincount(passage, minlength=total) == 0))
    out[:, 1] = mean
    out[:, 2] = np.sqrt(np.maximum(summed(length * length) / n - mean * mean, 0))
    out[:, 3] = summed(length <= 3) / n
    out[:, 4] = summed(length >= 20) / n
    out[:, 5] = summed(seen) / n
    out[:, 6] = summed(same) / n
    # a passage reaches from its first word to the next passage's first word
    first = np.zeros(total, np.int64)
    firsts = np.flatnonzero(place % PASSAGE_WORDS == 0)
    first[:] = piece.offsets[text]
    first[passage[firsts]] = found.start[firsts]
    first[offset[:-1]] = piece.offsets[:-1]
    ends = np.append(first[1:], len(piece.data))
    size = np.maximum(ends - first, 1)
    spoken = ~IS_SPACE[piece.data] | (piece.data == 10)
    for row in range(len(CLASSES)):
        seen_so_far = np.concatenate(([0], np.cumsum(_CLASS[row][piece.data] * spoken)))
        out[:, 7 + row] = (seen_so_far[ends] - seen_so_far[first]) / size
    return Passages(text, out)


def _logistic(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -x))


@dataclass
class GatedAttention:
    """Weights of the encoder (E), both attention branches (V, U, w) and the scorer (c)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, text: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for passages sorted by text; every text has one or more."""
        p = self.weights
        first = np.flatnonzero(np.diff(text, prepend=-1))
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), _logistic(h @ p["U"])
        raw = (v * u) @ p["w"]
        raw -= np.maximum.reduceat(raw, first)[text]
        a = np.exp(raw)
        a /= np.add.reduceat(a, first)[text]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "first": first, "logit": z @ p["c"] + p["d"]}

    def standard(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8)

    def scores(self, found: Passages) -> tuple[np.ndarray, np.ndarray]:
        """Score of every text and attention of every passage. Scores are rounded, since a
        matrix product's last digits depend on how many rows are multiplied together."""
        layers = self.forward(self.standard(found.features), found.text)
        return np.round(_logistic(layers["logit"]), 9), layers["a"]


def fit(texts: list[str], labels: np.ndarray) -> GatedAttention:
    """Full-batch gradient steps with both labels weighing the same, from seeded weights.

    Equal texts count once. Without any text all scores are 0.5, with one label near it.
    """
    _, once = np.unique(pd.util.hash_array(np.array(texts, object)), return_index=True) if texts else (0, [])
    texts, y = [texts[i] for i in once], np.asarray(labels, float)[once]
    draw = np.random.default_rng(SEED)
    shapes = {"E": (FEATURES, ENCODING), "e": (ENCODING,), "V": (ENCODING, GATES), "U": (ENCODING, GATES), "w": (GATES,), "c": (ENCODING,), "d": ()}
    p = {k: draw.normal(0, 0.3, s) if k in "EVUwc" else np.zeros(s) for k, s in shapes.items()}
    model = GatedAttention(np.zeros(FEATURES), np.ones(FEATURES), p)
    if not texts:
        model.weights["c"] = np.zeros(ENCODING)
        return model
    parts, bags, text = [], 0, []
    for piece in slices(pa.array(texts, pa.string())):
        found = passages(piece)
        parts.append(found.features)
        text.append(found.text + bags)
        bags += piece.size
    features, text = np.concatenate(parts), np.concatenate(text)
    model.mean, model.scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = model.standard(features)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, EPOCHS + 1):
        f = model.forward(x, text)
        dlogit = (_logistic(f["logit"]) - y) * share
        dz = dlogit[:, None] * p["c"]
        da = np.einsum("ij,ij->i", dz[text], f["h"])
        draw_ = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[text])
        dv = draw_[:, None] * p["w"] * f["u"] * (1 - f["v"] ** 2)
        du = draw_[:, None] * p["w"] * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[text] + dv @ p["V"].T + du @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        g = {
            "E": x.T @ dpre, "e": dpre.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
            "w": (f["v"] * f["u"]).T @ draw_, "c": f["z"].T @ dlogit, "d": dlogit.sum(),
        }
        for k in p:
            g[k] = g[k] + DECAY * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> GatedAttention:
    rows = sample(docs, labels, "quality", allowed)
    return fit(rows["text"].tolist(), rows["label"].to_numpy())


def score(docs: DataFrame, model: GatedAttention, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score`` and the ``attention`` on each passage of every text.

    A null or empty text is one empty passage and gets the score of that. Every row is
    scored by itself, repeated rows alike. Only ``keep`` and ``text`` are read.
    """
    slim = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column("_text")):
                found = passages(piece)
                scores, attention = model.scores(found)
                ends = np.searchsorted(found.text, np.arange(piece.size + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(attention))
                rows = batch.slice(piece.low, piece.size)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), pa.array(scores), lists], [*keep, "score", "attention"]
                )

    return slim.mapInArrow(run, ", ".join([*fields, "score double", "attention array<double>"]))
