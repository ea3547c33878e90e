"""SimHash near-dedup against a plain version that compares all pairs."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import simhash
from tests.helpers import rows
from tests.llm.corpora import awkward, frame, sentence


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    width = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int]) -> list[int]:
    """For each fingerprint the first place of its component."""
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(prints))]


def plain(given_rows):
    known = sorted((r for r in given_rows if r[0] is not None), key=lambda r: r[0])
    prints = [plain_fingerprint(r[1]) for r in known]
    places = plain_components(prints)
    out = [(r[0], f"{p:016x}", known[k][0], r[0] == known[k][0]) for r, p, k in zip(known, prints, places)]
    return out + [(None, f"{plain_fingerprint(r[1]):016x}", None, True) for r in given_rows if r[0] is None]


def linked_labels(spark, prints: list[int]) -> dict[int, int]:
    df = spark.createDataFrame([(simhash._signed(p),) for p in sorted(set(prints))], "bits bigint")
    return {r["node"]: r["label"] for r in simhash.link_prints(df).collect()}


@given(st.text(alphabet="aB ée\t\n.\x1f", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(sentence(random.Random(1), 999))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PART", 100)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def test_all_pairs_within_four_bits_are_found(spark):
    rng, prints = random.Random(5), []
    for _ in range(150):  # pairs that share nothing with others, apart by up to six bits at any places
        p = rng.getrandbits(64)
        q = p
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 4, 5, 6])):
            q ^= 1 << b
        prints += [p, q]
    for spread in ([0, 8, 16, 24], [7, 15, 39, 63], [0, 1, 2, 3], [0, 1, 8, 9], [0, 8, 9, 63]):
        p = rng.getrandbits(64)
        prints += [p, p ^ sum(1 << b for b in spread)]
    labels, places = linked_labels(spark, prints), plain_components(prints)
    for i, j in zip(range(0, len(prints), 2), range(1, len(prints), 2)):
        one, two = (labels.get(simhash._signed(prints[k]), prints[k]) for k in (i, j))
        assert (one == two) == (places[i] == places[j])


def test_crowds_and_chains(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    crowd = {centre}
    while len(crowd) < 300:  # a crowd around a centre, and another eight bits away, and a chain of steps
        crowd.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    chain = [rng.getrandbits(64)]
    for k in range(40):
        chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(range(64), 4)))
    prints = sorted({*crowd, *chain})
    labels, places = linked_labels(spark, prints), plain_components(prints)
    groups = {}
    for p, k in zip(prints, places):
        groups.setdefault(k, set()).add(labels.get(simhash._signed(p), simhash._signed(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_components_meet_once_however_many_fingerprints_link_them(spark, monkeypatch):
    rng, calls = random.Random(9), []
    centre = rng.getrandbits(64)
    crowd = {centre}
    while len(crowd) < 300:
        crowd.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    plain_labels = simhash.components

    def kept(links):
        found = plain_labels(links)
        calls.append((links.select("a", "b").collect(), {r["label"] for r in found.collect()}))
        return found

    monkeypatch.setattr(simhash, "components", kept)
    linked_labels(spark, sorted(crowd))
    (_, labels), (bridges, _) = calls
    own = {simhash._signed(p) for p in crowd}
    singles = own - {x for row in calls[0][0] for x in row}
    assert {x for row in bridges for x in row} <= labels | singles
    assert len(bridges) == len({tuple(sorted(row)) for row in bridges})


def test_tally(spark):
    rng = random.Random(2)
    pairs = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(50)]
    pairs += [(a, a ^ (b & 0xFF00FF0000000101)) for a, b in pairs]
    df = spark.createDataFrame([(simhash._signed(a), simhash._signed(b)) for a, b in pairs], "a bigint, b bigint")
    got = [r[0] for r in df.select(simhash.shared_bytes(F.col("a"), F.col("b"))).collect()]
    both = [zip(a.to_bytes(8, "big"), b.to_bytes(8, "big")) for a, b in pairs]
    assert got == [sum(x == y for x, y in z) for z in both]


@pytest.mark.parametrize("clash", [False, True])
def test_documents_equal_brute_force(spark, clash):
    rng = random.Random(3)
    given_rows = awkward()
    for k in range(20, 60):
        base = sentence(rng, rng.choice([3, 4, 12, 80, 400]))
        for c in range(rng.choice([1, 1, 2, 5])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
            given_rows.append((100 * k + c, " ".join(words)))
    got = simhash.simhash_dedup(frame(spark, given_rows, clash))
    assert got.columns == ["doc_id", "fingerprint", "component_id", "kept"]
    assert rows(got) == sorted(plain(given_rows), key=repr)


def test_empty_table(spark):
    assert simhash.simhash_dedup(frame(spark, [])).collect() == []


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = QUERIES["op13_simhash_near_dedup"](spark, "/root/testdata/sf0.001")
    assert rows(got) == sorted(plain(docs), key=repr)
    assert np.unique([r[0] for r in docs]).size == len(docs)
