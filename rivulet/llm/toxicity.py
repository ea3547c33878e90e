"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

A text is the set of its tokens; a token has the features ``word`` and its prefixes, hashed and scaled by
how much more often positives have them. A linear classifier over them is trained in numpy on the PU risk
with the class prior p,

    p * R(positives as 1)  +  max(0, R(unlabelled as 0) - p * R(positives as 0)),

where the second part, which no true classifier makes negative, is pushed back whenever training does. Training takes a bounded sample; every text is scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, fold, slices

BITS = 18
PREFIXES = (4, 5, 6)
LETTERS = regex.compile(r"\p{L}+")
MAX_POSITIVE = 2_000  # texts learned from, at most
MAX_UNLABELLED = 4_000
MIN_TEXTS = 2  # positives that must have a feature
CACHED_TOKENS = 400_000


def features(token: bytes) -> list[int]:
    """Hashed features of a token's words: the word and its prefixes."""
    found = []
    for word in LETTERS.findall(token.decode().lower()):
        parts = [f"={word}", *[f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n]]
        found += [xxhash.xxh3_64_intdigest(p) & ((1 << BITS) - 1) for p in parts]
    return found


def _collect_features(batches: Iterator[pa.RecordBatch]):
    """The distinct tokens' features of each text, as int32 bytes."""
    known: dict[bytes, list[int]] = {}

    def of(token: bytes) -> list[int]:
        found = known.get(token)
        if found is None:
            if len(known) > CACHED_TOKENS:
                known.clear()
            found = known[token] = features(token)
        return found

    for batch in batches:
        for part in slices(batch):
            rows = [
                np.sort(np.fromiter((f for t in set(text.split()) for f in of(t)), np.int32)).tobytes()
                for text in binaries(part, "text")
            ]
            yield pa.RecordBatch.from_arrays([part.column("positive"), pa.array(rows, pa.binary())], names=["positive", "features"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def feature_scales(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """How much more often positives have a feature than texts at large, as a log ratio shrunk for rare ones.

    Features that positives do not have more often have scale 0 and stay out of the model.
    """

    def texts_with(rows: list[np.ndarray]) -> np.ndarray:
        seen = np.zeros(1 << BITS)
        for row in rows:
            seen[np.unique(row)] += 1
        return seen

    p, u = texts_with(positive), texts_with(unlabelled)
    ratio = np.log((p + 0.5) / (len(positive) + 1) * (len(unlabelled) + 1) / (u + 0.5))
    scale = np.maximum(ratio, 0) * p / (p + 3)
    return np.where((p >= MIN_TEXTS) & (scale > 0.3), scale, 0)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 400, rate: float = 1.0):
    """Weights and bias that minimise the non-negative PU risk of the logistic loss, by gradient descent."""
    weights, bias = np.zeros(1 << BITS, np.float32), math.log(prior / (1 - prior))
    if not positive or not unlabelled:
        return weights, bias
    scale = feature_scales(positive, unlabelled)
    used = np.flatnonzero(scale)
    place = np.cumsum(scale > 0) - 1

    def entries(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        kept = [place[r[scale[r] > 0]] for r in rows]
        return np.concatenate(kept), np.repeat(np.arange(len(rows)), [len(k) for k in kept])

    (pf, pr), (uf, ur) = entries(positive), entries(unlabelled)
    n_p, n_u, n, s = len(positive), len(unlabelled), len(used), scale[used]
    w, w_move, b_move = np.zeros(n), np.zeros(n), 0.0
    for step in range(steps):
        v = w * s
        ps = _sigmoid(bias + np.bincount(pr, v[pf], n_p))
        us = _sigmoid(bias + np.bincount(ur, v[uf], n_u))
        negative = -np.log1p(-us + 1e-9).mean() + prior * np.log1p(-ps + 1e-9).mean()
        # derivatives of the mean losses by each text's score
        p_one, p_zero, u_zero = (ps - 1) * prior / n_p, -ps * prior / n_p, us / n_u
        by_p, by_u = (p_one + p_zero, u_zero) if negative >= 0 else (-p_zero, -u_zero)
        gradient = (np.bincount(pf, by_p[pr], n) + np.bincount(uf, by_u[ur], n)) * s + 5e-4 * w
        w_move = 0.9 * w_move + gradient
        b_move = 0.9 * b_move + by_p.sum() + by_u.sum()
        now = rate * (1 - step / steps)
        w, bias = w - now * w_move, bias - now * b_move
    weights[used] = w * s
    return weights, float(bias)


def _score(batches: Iterator[pa.RecordBatch], model):
    weights, bias = model.value
    known: dict[bytes, float] = {}

    def of(token: bytes) -> float:
        found = known.get(token)
        if found is None:
            if len(known) > CACHED_TOKENS:
                known.clear()
            found = known[token] = float(weights[features(token)].sum())
        return found

    for batch in batches:
        for part in slices(batch):
            sums = [math.fsum(map(of, set(text.split()))) for text in binaries(part, "text")]
            scores = pa.array(_sigmoid(np.array(sums) + bias), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), scores], names=["id", "held_out", "score"])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    folds: int = 5, held_fold: int = 0, cut: float = 0.5,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (0 to 1), ``predicted``.

    Learns from at most ``MAX_POSITIVE`` texts labelled 1 and ``MAX_UNLABELLED`` texts whatever their label,
    none of the held fold, those with the smallest hashes of their ids. The class prior is the share of 1
    among the labels outside the held fold. Null and empty texts score the bias. Without positives all
    scores are the same. A null id is in fold 0; null labels are left out.
    """
    held = fold(id_column, folds) == held_fold
    rows = docs.select(F.col(id_column).alias("id"), held.alias("held_out"), F.col(text_column).alias("text"))
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")).dropna().where(
        fold("id", folds) != held_fold
    )
    n, ones = known.agg(F.count("*"), F.sum("label")).first()
    prior = min(max((ones or 0) / n if n else 0.0, 0.001), 0.9)
    learn = rows.where("NOT held_out")

    def sample(df: DataFrame, most: int, positive: bool) -> list[np.ndarray]:
        chosen = df.select("id").orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(most)
        texts = learn.join(F.broadcast(chosen), "id", "left_semi")  # at most ``most`` ids
        found = texts.select(F.lit(positive).alias("positive"), "text").mapInArrow(_collect_features, "positive boolean, features binary")
        return sorted((np.frombuffer(r["features"], np.int32) for r in found.select("features").collect()), key=lambda r: r.tobytes())

    positive = sample(known.where("label = 1"), MAX_POSITIVE, True)
    unlabelled = sample(learn, MAX_UNLABELLED, False)
    model = docs.sparkSession.sparkContext.broadcast(train(positive, unlabelled, prior))
    schema = f"id {docs.schema[id_column].dataType.simpleString()}, held_out boolean, score double"
    scored = rows.mapInArrow(partial(_score, model=model), schema)
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int")).withColumnRenamed("id", id_column)
