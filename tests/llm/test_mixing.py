import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.llm.mixing import first_words, mix, mixed_rows, split_tree
from rivulet.llm.numeric import binomial_cdf, hypergeometric, ln_factorial
from tests.llm.corpora import awkward, frame, sentence


def fill(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Reshare the excess by weight, round by round."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), budget * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
        free -= set(over)
        left = budget * sum(sizes.values()) - sum(target.values())
    return target


def corpus(seed, n=400):
    rng = random.Random(seed)
    return [
        (i, " ".join(sentence(rng, rng.choice([0, 1, 20, 100, 700]))), "en", rng.choice(["a", "a", "a", "b", "c", "é", "Z", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, block", [(1, 1 << 16), (2, 500), (3, 50)])
def test_targets_and_words_taken(spark, seed, block):
    rows = corpus(seed)
    found = mix(frame(spark, rows, clash=True), block_words=block, shard_blocks=4).collect()
    assert len(found) == len(rows)
    source, size = {r[0]: r[3] for r in rows}, {r[0]: len(r[1].split()) for r in rows}
    sizes = Counter()
    for i, s in source.items():
        sizes[s] += size[i]
    want, taken = fill(sizes), Counter()
    for r in found:
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert r.taken <= 2 * r["size"] and r.taken == sum(c.words for c in r.copies)
        taken[source[r.doc_id]] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= 1
    cut = Counter(source[r.doc_id] for r in found if any(c.words < r["size"] for c in r.copies))
    assert all(n <= 1 for n in cut.values())
    again = mix(frame(spark, rows[::-1], clash=True).repartition(7), block_words=block, shard_blocks=4).collect()
    key = lambda rs: sorted((r.doc_id, r.taken, str(r.copies)) for r in rs)
    assert key(again) == key(found)


def test_shards_get_equal_numbers_of_draws(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 37), (3, 0), (4, 501)], "place int, n_draws bigint")
    ranges = split_tree(quotas, 4, 9).collect()
    per_shard, per_source = Counter(), defaultdict(list)
    for r in ranges:
        per_shard[r.shard] += r.high - r.low
        per_source[r.place].append((r.shard, r.low, r.high))
    assert len(per_shard) == 16 and max(per_shard.values()) - min(per_shard.values()) <= 1
    for place, n in ((1, 1000), (2, 37), (3, 0), (4, 501)):
        at = 0
        for _, low, high in sorted(per_source[place]):
            assert low == at
            at = high
        assert at == n


def test_draws_follow_the_hypergeometric_law(spark):
    cases = [(10, 4, 5), (60, 30, 30), (100, 3, 50), (5, 5, 2), (7, 0, 3), (1, 1, 0)]
    for population, marked, draws in cases:
        u = (F.col("id") + 0.5) / 2000
        c = [F.lit(x).cast("bigint") for x in (population, marked, draws)]
        counts = {r.x: r["count"] for r in spark.range(2000).select(hypergeometric(*c, u).alias("x")).groupBy("x").count().collect()}
        for x in range(draws + 1):
            p = math.comb(marked, x) * math.comb(population - marked, draws - x) / math.comb(population, draws) if x <= marked and draws - x <= population - marked else 0
            assert abs(counts.get(x, 0) / 2000 - p) <= 0.0011


def test_binomial_tail_and_factorials(spark):
    one = spark.range(1)
    for n, k, p in [(50, 1, 0.1), (500, 3, 0.02), (2000, 0, 0.004), (10, 0, 0.5), (40, 2, 0.2)]:
        want = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        got = one.select(binomial_cdf(F.lit(k), F.lit(n), F.lit(p))).first()[0]
        assert got == pytest.approx(want, rel=1e-9)
    got = spark.range(40).select(ln_factorial(F.col("id"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(i + 1) for i in range(40)], abs=1e-11)


def test_rows_of_the_mix(spark):
    rows = corpus(4, 120)
    docs = frame(spark, rows, clash=True)
    taken = {r.doc_id: r for r in mix(docs).collect()}
    out = mixed_rows(docs)
    words = Counter()
    texts = {r[0]: r[1] for r in rows}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r.kept == "kept!" and r.mix_shard == "mix_shard!"
    assert words == Counter({i: r.taken for i, r in taken.items() if r.taken})


def test_awkward_rows(spark):
    rows = awkward()
    found = mix(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    assert sum(r.taken for r in found) == pytest.approx(1.5 * sum(r["size"] for r in found), abs=3)
    assert mixed_rows(frame(spark, rows)).count() > 0
    assert mix(frame(spark, [])).collect() == []
    assert mix(frame(spark, [(1, ""), (2, None)])).select("taken").collect() == [(0,), (0,)]


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\nc d ",)], "t string")
    assert [df.select(first_words(F.col("t"), F.lit(k))).first()[0] for k in (1, 2, 3)] == [" a", " a  b", " a  b\nc"]
