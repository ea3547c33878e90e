"""Periodic runs of words: maximal stretches that repeat with a period, and texts without the repeats.

A run is a stretch of words whose smallest period is q, at least twice as long as q and at least ``LEAST`` words,
that cannot be extended with that period. Any run of period q holds two neighbouring multiples of q in its first
2q words, at equal words: the harmonic grid of all (multiple of q, next multiple) has n ln n places, and those
with equal words that go on alike for long enough to be part of a run are the candidates. How far they go on, both
ways and exactly, the grammar of ``recompression`` tells. A stretch found with several periods has the least of them.

Texts of a batch share a word numbering, and those with candidates a grammar, between separators of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import compress
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, slices
from rivulet.llm.recompression import Grammar

LEAST = 12
GRID = 1 << 15  # words whose grid is kept
TOGETHER = 200_000  # words that share a grammar; a longer text has its own
QUERIES = 500_000  # extensions asked for at once
RIM = 3

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

Words = list[bytes]


def _grid(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(j, q) with q a divisor of j, low <= j < high, sorted by j: q and j / q are at most and at least the root."""
    places, periods = [], []
    for a in range(1, isqrt(high - 1) + 1):
        b = np.arange(max(a, -(-low // a)), (high - 1) // a + 1)
        places += [a * b, a * b[b > a]]
        periods += [np.full(len(b), a), b[b > a]]
    j, q = np.concatenate(places), np.concatenate(periods)
    order = np.argsort(j, kind="stable")
    return j[order], q[order]


@cache
def _first_grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grid of the first ``GRID`` words, and how many of its places come before each word."""
    j, q = _grid(1, GRID)
    return j - q, j, np.searchsorted(j, np.arange(GRID + 1))


def _grids(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the grid over n words, in parts."""
    i, j, before = _first_grid()
    upto = before[min(n, GRID)]
    yield i[:upto], j[:upto]
    for low in range(GRID, n, GRID):
        j, q = _grid(low, min(low + GRID, n))
        yield j - q, j


def candidates(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the grid where equal words may belong to a run.

    A run goes on alike for at least max(q, LEAST - q) >= LEAST / 2 words around i, so for RIM words to one side.
    """
    n = len(words)
    found = []
    if n >= LEAST:
        padded = np.concatenate([np.arange(-2 * RIM, -RIM), words, np.arange(-RIM, 0)])  # equal to nothing
        for i, j in _grids(n):
            hit = np.flatnonzero(words[i] == words[j])
            i, j = i[hit], j[hit]
            short = 2 * (j - i) <= n
            i, j = i[short], j[short]
            after, before = np.ones(len(i), bool), np.ones(len(i), bool)
            for k in range(1, RIM + 1):
                after &= padded[i + RIM + k] == padded[j + RIM + k]
                before &= padded[i + RIM - k] == padded[j + RIM - k]
            found.append((i[after | before], j[after | before]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs_of(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Rows (start, length, period) of each text, by start and period; texts are (words, i, j)."""
    separators = max(int(w.max()) for w, _, _ in texts) + 1
    pieces, begins, at = [np.array([separators])], [], 1
    for k, (w, _, _) in enumerate(texts):
        pieces += [w, [separators + k + 1]]
        begins.append(at)
        at += len(w) + 1
    grammar = Grammar(np.concatenate(pieces))
    owner = np.repeat(np.arange(len(texts)), [len(i) for _, i, _ in texts])
    base = np.array(begins)[owner]
    i = np.concatenate([i for _, i, _ in texts]) + base
    j = np.concatenate([j for _, _, j in texts]) + base
    found = []
    for part in range(0, len(i), QUERIES):
        x, y, own = i[part : part + QUERIES], j[part : part + QUERIES], owner[part : part + QUERIES]
        start = x - grammar.alike(x - 1, y - 1, -1)
        end, q = y + grammar.alike(x, y, 1), y - x
        long = end - start >= np.maximum(LEAST, 2 * q)
        found.append(np.stack([own, start - base[part : part + QUERIES], end - start, q], axis=1)[long])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[least]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[b:e, 1:] for b, e in zip(cuts[:-1], cuts[1:])]


def runs_of(texts: list[Words]) -> list[np.ndarray]:
    """For each list of words its runs as rows (start, length, period)."""
    numbers: dict[bytes, int] = {}
    out = [np.empty((0, 3), np.int64)] * len(texts)
    held, size = [], 0

    def close():
        for (k, *_), runs in zip(held, _runs_of([t for _, t in held]) if held else ()):
            out[k] = runs
        held.clear()

    for k, text in enumerate(texts):
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for w in text), np.int64, len(text))
        i, j = candidates(words)
        if len(i):
            if held and size + len(words) > TOGETHER:
                close()
                size = 0
            held.append((k, (words, i, j)))
            size += len(words)
    close()
    return out


def collapsed(words: Words, runs: np.ndarray) -> bytes:
    """The words, each run cut to its first period."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    rewrite: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``runs`` (start and length in words, period; by start, then period) and
    ``collapsed``, the text without the repeats, its words joined by one space.

    ``rewrite`` may change the words of a text (id, words) before they are searched. Null, empty and blank texts have
    no run and an empty collapsed text. Ids are passed through, null and repeated ones too; an empty table gives
    an empty result.
    """

    def search(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                texts = [t.split() for t in binaries(part, "text")]
                if rewrite is not None:
                    texts = [rewrite(d, t) for d, t in zip(part.column("id").to_pylist(), texts)]
                found = runs_of(texts)
                runs = [[dict(zip(("start", "length", "period"), r)) for r in x.tolist()] for x in found]
                kept = pa.array([collapsed(t, x) for t, x in zip(texts, found)], pa.binary()).cast(pa.string())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(runs, kind), kept], names=["id", "runs", "collapsed"])

    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    return given.mapInArrow(search, f"id bigint, runs {RUNS}, collapsed string").withColumnRenamed("id", id_column)
