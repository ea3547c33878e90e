import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm.components import components
from rivulet.llm.near_dedup import CHUNKS, FLIPS, MOST_ERRORS, SYMBOLS, _near, alike, chunk_keys, chunks_at_slot, drop_near_copies, flips, may_pass, near_dedup, symbols
from tests.llm.corpora import awkward, frame, sentence


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    """doc -> smallest id reachable over links of at least 75 percent."""
    sets = {i: shingles(t) for i, t in docs.items()}
    lead = {i: i for i in docs}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    held = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            held[g].add(i)
    for i, s in sets.items():
        for j in {j for g in s for j in held[g] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                lead[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def edited(rng, words, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_components_as_by_hand(spark):
    rng = random.Random(2)
    docs = {}
    for base in range(12):
        words = sentence(rng, rng.choice([6, 30, 200, 600]), 5000)
        for copy in range(rng.choice([1, 3, 25])):
            docs[len(docs)] = " ".join(edited(rng, words, rng.choice([0, 0.005, 0.02, 0.04, 0.06])))
    passage = " ".join(sentence(rng, 40, 5000))  # shared by many that are otherwise different
    for _ in range(60):
        docs[len(docs)] = " ".join([passage, *sentence(rng, rng.choice([5, 20, 100]), 5000)])
    docs[len(docs)] = "Few WORDS"
    docs[len(docs)] = "few\twords"
    want = brute(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(frame(spark, list(docs.items()))).collect()}
    assert got == want


def test_awkward_rows(spark):
    rows = awkward()
    found = near_dedup(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert [by_id[k].component_id for k in (1, 2, 3)] == [1, 2, 3]
    assert by_id[10].component_id == 6 and not by_id[10].kept
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    left = drop_near_copies(frame(spark, rows, clash=True))
    assert left.columns == frame(spark, rows, clash=True).columns
    assert left.count() == len(rows) - 1
    assert near_dedup(frame(spark, [])).collect() == []


@pytest.mark.parametrize("wrong", [0, 1, MOST_ERRORS // 2, MOST_ERRORS])
def test_signatures_within_the_threshold_share_a_key(spark, wrong):
    rng = np.random.default_rng(wrong)
    one = rng.integers(0, 2**16, (100, SYMBOLS)).astype("<u2")
    two = one.copy()
    for row in two:
        row[rng.choice(SYMBOLS, wrong, replace=False)] ^= np.uint16(rng.integers(1, 2**16))

    def table(rows):
        longs = rows.view("<i8").tolist()
        df = spark.createDataFrame([(k, *r) for k, r in enumerate(longs)], ["rep", *CHUNKS])
        return df.select("rep", *CHUNKS, F.lit(100).cast("bigint").alias("n"), *[F.lit(0).cast("bigint").alias(f) for f in FLIPS], F.inline(chunk_keys())).select("*", *chunks_at_slot())

    x, y = table(one), table(two)
    y = y.drop("slot").toDF(*[f"{c}_" for c in y.drop("slot").columns])
    met = x.join(y, (x["rep"] == y["rep_"]) & (x["key"] == y["key_"]))
    assert met.select("rep").distinct().count() == 100  # they share a key
    for pairs in (met, met.where(may_pass(x, y))):
        sides = [c for c in pairs.columns if not c.startswith(("key", "n", "f", "own", "before"))]
        passed = pairs.select(*sides).mapInArrow(_near, "rep bigint, rep_ bigint")
        assert sorted(r[0] for r in passed.collect()) == list(range(100))  # and pass once


def test_bitmaps_and_sizes_bound_the_difference(spark):
    def table(*rows):
        return spark.createDataFrame([(k, n, f, *[0] * (len(FLIPS) - 1)) for k, n, f in rows], ", ".join(f"{c} bigint" for c in ["rep", "n", *FLIPS]))

    x = table((1, 200, 0))
    y = table((2, 200, 2**57 - 1), (3, 200, 2**58 - 1), (4, 150, 0), (5, 149, 0))  # 57 and 58 of 400 bits apart, three quarters and less
    y = y.toDF(*[f"{c}_" for c in y.columns])
    met = x.join(y, alike(x, y, 75))
    assert sorted(r[0] for r in met.select("rep_").collect()) == [2, 4]


def test_signatures_and_bitmaps_follow_the_sets():
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64) << np.uint64(1))
    alike = []
    for k in range(40):
        part = pool[50 * k : 50 * k + 900]
        sets = [part[:800], part[100:]]
        one, two = symbols(sets)
        alike.append((one == two).mean())
        a, b = flips(sets)
        assert np.bitwise_count((a ^ b).astype(np.uint64)).sum() <= 200
    assert abs(np.mean(alike) - 700 / 900) < 0.03


def test_components_of_a_long_chain(spark):
    n = 200
    links = [(i, i + 1) for i in range(n)] + [(1000, 2000), (2000, 1500)]
    random.Random(1).shuffle(links)
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(n + 1)} | {1000: 1000, 1500: 1000, 2000: 1000}
