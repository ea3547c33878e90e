"""Runs against a plain search over all starts and periods, extensions against a plain comparison."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import periodic_runs, recompression
from tests.helpers import rows
from tests.llm.corpora import awkward, frame, sentence


def plain_runs(words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: for each period the maximal stretches, less those with a smaller one."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or words[i] != words[i + q]:
                length = i - start + q
                if length >= max(12, 2 * q) and (start, length) not in found:
                    found[start, length] = q
                start = i + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_split(text: str | None) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_row(doc_id: int | None, text: str | None) -> tuple:
    words = plain_split(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def runs(words) -> list[tuple]:
    return [tuple(r) for r in periodic_runs.runs_of([[str(w).encode() for w in words]])[0].tolist()]


def plain_alike(s, i, j, step):
    k = 0
    while s[i + step * k] == s[j + step * k]:
        k += 1
    return k


texts = st.one_of(
    st.lists(st.integers(0, 1), max_size=70),
    st.lists(st.integers(0, 3), max_size=70),
    st.builds(lambda a, b, n, c: a + b * n + c, *[st.lists(st.integers(0, 5), max_size=9)] * 2, st.integers(1, 9), st.lists(st.integers(0, 5), max_size=9)),
)


@given(texts)
@settings(max_examples=300, deadline=None)
def test_runs(words):
    assert runs(words) == plain_runs(words)


@given(texts)
@settings(max_examples=200, deadline=None)
def test_extensions(words):
    s = np.array([7, *words, 8])
    grammar = recompression.Grammar(s)
    i, j = np.triu_indices(len(s) - 1, 1)
    assert grammar.alike(i, j, 1).tolist() == [plain_alike(s, a, b, 1) for a, b in zip(i, j)]
    i, j = i + 1, j + 1
    assert grammar.alike(i, j, -1).tolist() == [plain_alike(s, a, b, -1) for a, b in zip(i, j)]


def test_grammar_levels_derive_the_sequence():
    s = np.array([99, *[int(c) for c in "112112112333333331121121120000000000012121212"], 98])
    grammar = recompression.Grammar(s)
    assert len(grammar.levels[-1].symbols) == 1
    for level, above in zip(grammar.levels, grammar.levels[1:]):
        derived = {}
        for x, b, e in zip(above.symbols.tolist(), level.begins, level.ends):
            children = tuple(level.symbols[b : e + 1])
            assert derived.setdefault(x, children) == children  # one rule for each symbol
            assert len(children) == 1 or (len(set(children)) == 1 if level.blocks else len(children) == 2)


def test_words_that_follow_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert runs(b) == plain_runs(b)
    assert runs([0] * 500) == [(0, 500, 1)]
    assert runs([0, 1] * 5 + [0]) == []  # eleven words are too few
    assert runs([0, 1] * 6) == [(0, 12, 2)]


def test_a_text_longer_than_the_kept_grid_and_the_common_grammar(monkeypatch):
    rng = random.Random(4)
    words = [rng.randrange(900) for _ in range(300)]
    words = words + words[40:140] * 3 + [rng.randrange(900) for _ in range(50)] + [1, 2, 3] * 30
    want = plain_runs(words)
    periodic_runs._first_grid.cache_clear()
    monkeypatch.setattr(periodic_runs, "GRID", 64)
    monkeypatch.setattr(periodic_runs, "TOGETHER", 100)
    monkeypatch.setattr(periodic_runs, "QUERIES", 7)
    many = [[str(w).encode() for w in words[k:]] for k in (0, 5, 700)]
    got = periodic_runs.runs_of(many)
    periodic_runs._first_grid.cache_clear()
    assert [tuple(r) for r in got[0].tolist()] == want and want
    assert [[tuple(r) for r in x.tolist()] for x in got[1:]] == [plain_runs(words[5:]), plain_runs(words[700:])]


@pytest.mark.parametrize("clash", [False, True])
def test_documents_equal_brute_force(spark, clash):
    from rivulet.llm.queries import run_digests, with_planted_runs

    rng = random.Random(11)
    given_rows = [r for r in awkward() if len(r[1] or "") < 150_000]
    for k in range(100, 160):
        given_rows.append((k, " ".join(sentence(rng, rng.randrange(1, 160), 30))))
    given_rows += [(1000, "a b c " * 40), (1000, "a b c " * 40), (1001, "x\n" * 60), (1002, "")]
    found = periodic_runs.periodic_runs(frame(spark, given_rows, clash), rewrite=with_planted_runs)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = rows(run_digests(found))
    assert got == sorted((plain_row(r[0], r[1]) for r in given_rows), key=repr)


def test_very_long_text(spark):
    rng = random.Random(12)
    words = sentence(rng, 40_000, 5000)
    words[20_000:30_000] = words[:1000] * 10
    found = periodic_runs.periodic_runs(frame(spark, [(5, " ".join(words)), (6, "z " * 20_000)])).collect()
    assert [(r["start"], r["length"], r["period"]) for r in found[0]["runs"] if r["period"] == 1000 and r["length"] > 9000]
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 20_000, 1)] and found[1]["collapsed"] == "z"


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(frame(spark, [])).collect() == []


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    short = {d for d, t in docs if len(t or "") < 6000}
    assert got.count() == len(docs)
    assert [r for r in rows(got) if r[0] in short] == sorted((plain_row(d, t) for d, t in docs if d in short), key=repr)
