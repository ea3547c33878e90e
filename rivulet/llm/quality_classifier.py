"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. A passage is encoded by how its words look: the hashed
shapes of its words (letter case, digits, signs), and how long, how varied and how repetitive they are.
From the labels of whole texts a gated attention learns which passages matter,

    h = tanh(E x),   a = softmax(w (tanh(V h) * sigmoid(U h))),   score = sigmoid(c sum(a h) + b),

trained in numpy on a bounded sample of labelled texts. Every text is scored over all its passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, fold, slices
from rivulet.session import bound_batches

PASSAGE = 64
SHAPES = 96  # hashed word shapes
WIDTH = SHAPES + 6
HIDDEN, GATE = 32, 16
MAX_TEXTS = 6_000  # labelled texts learned from, at most
MAX_PASSAGES = 64  # of a text in training, spread over it; scoring takes all
CACHED_TOKENS = 400_000

_RUNS = [(re.compile(p), s) for p, s in ((rb"[A-Z]+", b"A"), (rb"[a-z\x80-\xff]+", b"a"), (rb"[0-9]+", b"9"))]
_REPEAT = re.compile(rb"(.)\1+")


def shape(token: bytes) -> bytes:
    """Upper case as A, other letters as a, digits as 9, signs as they are; runs once."""
    for pattern, sign in _RUNS:
        token = pattern.sub(sign, token)
    return _REPEAT.sub(rb"\1", token)


class Encoder:
    """Passages of texts as rows of ``WIDTH`` numbers."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _token(self, token: bytes) -> int:
        """Shape, length and identity of a token in one number."""
        kind = xxhash.xxh3_64_intdigest(shape(token)) % SHAPES
        packed = (xxhash.xxh3_64_intdigest(token) & 0xFFFFFFFF) << 16 | min(len(token), 255) << 8 | kind
        self.known[token] = packed
        return packed

    def __call__(self, text: bytes) -> np.ndarray:
        if len(self.known) > CACHED_TOKENS:
            self.known.clear()
        tokens = text.split()
        if not tokens:
            return np.zeros((1, WIDTH), np.float32)
        get = self.known.get
        found = list(map(get, tokens))
        if None in found:
            found = [self._token(t) if (i := get(t)) is None else i for t in tokens]
        packed = np.array(found, np.int64)
        kind, size, word = packed & 0xFF, (packed >> 8) & 0xFF, packed >> 16
        n = -(-len(tokens) // PASSAGE)
        at = np.arange(len(tokens)) // PASSAGE
        held = np.bincount(at, minlength=n).astype(float)
        out = np.zeros((n, WIDTH), np.float32)
        shares = np.bincount(at * SHAPES + kind, minlength=n * SHAPES).reshape(n, SHAPES) / held[:, None]
        out[:, :SHAPES] = np.sqrt(shares)
        mean = np.bincount(at, size, n) / held
        out[:, SHAPES] = mean / 8
        out[:, SHAPES + 1] = np.sqrt(np.maximum(np.bincount(at, size * size, n) / held - mean**2, 0)) / 8
        same = np.zeros(len(tokens))
        same[1:] = word[1:] == word[:-1]
        out[:, SHAPES + 2] = np.bincount(at, same, n) / held
        distinct = np.unique(at.astype(np.int64) << 32 | word)
        out[:, SHAPES + 3] = np.bincount(distinct >> 32, minlength=n) / held
        out[:, SHAPES + 4] = np.log1p(held) / 4
        out[:, SHAPES + 5] = len(np.unique(word)) / len(tokens)  # over the whole text
        return out


def _bags(batches: Iterator[pa.RecordBatch]):
    encode = Encoder()
    for batch in batches:
        for part in slices(batch):
            rows = []
            for text in binaries(part, "text"):
                bag = encode(text)
                rows.append(bag[np.unique(np.linspace(0, len(bag) - 1, MAX_PASSAGES).astype(int))].astype("<f2").tobytes())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.binary())], names=["id", "bag"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """The model: parameters, scores of bags, and a gradient step's gradients."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def start(*size):
            return rng.normal(0, 1 / np.sqrt(size[-1]), size).astype(np.float32)

        self.p = {
            "E": start(HIDDEN, WIDTH), "e": np.zeros(HIDDEN, np.float32), "V": start(GATE, HIDDEN), "U": start(GATE, HIDDEN),
            "w": start(GATE), "c": start(HIDDEN), "b": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, begins: np.ndarray):
        """``x``: passages of all bags one after the other; ``begins``: where each bag begins."""
        p = self.p
        counts = np.diff(np.append(begins, len(x)))
        h = np.tanh(x @ p["E"].T + p["e"])
        t, s = np.tanh(h @ p["V"].T), _sigmoid(h @ p["U"].T)
        logits = (t * s) @ p["w"]
        logits -= np.repeat(np.maximum.reduceat(logits, begins), counts)
        a = np.exp(logits)
        a /= np.repeat(np.add.reduceat(a, begins), counts)
        z = np.add.reduceat(h * a[:, None], begins)
        return h, t, s, a, z, _sigmoid(z @ p["c"] + p["b"]), counts

    def scores(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.forward(x, begins)[5]

    def gradients(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h, t, s, a, z, score, counts = self.forward(x, begins)
        d = (score - y) / len(y)
        dz = np.repeat(d, counts)[:, None] * p["c"]
        da = (dz * h).sum(1)
        dl = a * (da - np.repeat(np.add.reduceat(a * da, begins), counts))
        dg = dl[:, None] * p["w"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (dz * a[:, None] + dt @ p["V"] + ds @ p["U"]) * (1 - h * h)
        return {
            "E": dh.T @ x, "e": dh.sum(0), "V": dt.T @ h, "U": ds.T @ h, "w": (dl[:, None] * t * s).sum(0),
            "c": z.T @ d, "b": d.sum(keepdims=True),
        }


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 60, batch: int = 64, seed: int = 11) -> GatedAttention:
    model = GatedAttention(seed)
    if not bags:
        return model
    share = min(max(float(labels.mean()), 0.01), 0.99)
    model.p["b"][:] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step, epochs = 0, max(epochs // 4, min(epochs, epochs * 1000 // len(bags) + 1))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), batch):
            at = order[begin : begin + batch]
            x = np.concatenate([bags[i] for i in at]).astype(np.float32)
            begins = np.cumsum([0, *[len(bags[i]) for i in at[:-1]]])
            step += 1
            for k, g in model.gradients(x, begins, labels[at]).items():
                m, v = moments[k]
                g = g + 1e-4 * model.p[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _scores(attention: GatedAttention, encode: Encoder, part: pa.RecordBatch, column: str) -> np.ndarray:
    bags = [encode(t) for t in binaries(part, column)]
    return attention.scores(np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])])).astype(float)


def _score(batches: Iterator[pa.RecordBatch], model):
    encode = Encoder()
    for batch in batches:
        for part in slices(batch, 200):
            scores = pa.array(_scores(model.value, encode, part, "text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), scores], names=["id", "held_out", "score"])


def _keep(batches: Iterator[pa.RecordBatch], model, column: str, cut: float):
    encode = Encoder()
    for batch in batches:
        for part in slices(batch, 200):
            yield part.filter(pa.array(_scores(model.value, encode, part, column) >= cut))


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    folds: int = 5, held_fold: int = 0,
) -> GatedAttention:
    """The model learned from at most ``MAX_TEXTS`` labelled texts outside the held fold, those with the
    smallest hashes of their ids. Null labels are left out; of several labels of an id the lowest counts."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(fold("id", folds) != held_fold)
    kind = docs.schema[id_column].dataType.simpleString()
    chosen = (
        labels.select(F.col(id_column).alias("id"), (F.col(label_column) == 1).alias("good")).dropna()
        .where(fold("id", folds) != held_fold)
        .groupBy("id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(MAX_TEXTS)
    )
    marks = {r["id"]: r["good"] for r in chosen.collect()}
    texts = rows.join(F.broadcast(chosen.select("id")), "id", "left_semi")  # at most MAX_TEXTS ids
    found = sorted((r["id"], r["bag"]) for r in texts.mapInArrow(_bags, f"id {kind}, bag binary").collect())
    bags = [np.frombuffer(b, "<f2").reshape(-1, WIDTH) for _, b in found]
    return train(bags, np.array([marks[i] for i, _ in found], np.float32))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    folds: int = 5, held_fold: int = 0, cut: float = 0.3,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (0 to 1, higher is better), ``predicted``.

    Null and empty texts are one passage without words. Without labels the model is untrained. A null id is
    in fold 0. An empty table gives an empty result.
    """
    held = fold(id_column, folds) == held_fold
    rows = docs.select(F.col(id_column).alias("id"), held.alias("held_out"), F.col(text_column).alias("text"))
    fitted = fit(docs, labels, id_column, text_column, label_column, folds, held_fold)
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    kind = docs.schema[id_column].dataType.simpleString()
    scored = rows.mapInArrow(partial(_score, model=model), f"id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int")).withColumnRenamed("id", id_column)


def keep_good(docs: DataFrame, labels: DataFrame, text_column: str = "text", cut: float = 0.3, **columns) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``cut``, with all their columns."""
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text_column=text_column, **columns))
    return docs.mapInArrow(partial(_keep, model=model, column=text_column, cut=cut), docs.schema)
