"""Repair against a plain search over all cheapest edits, and the grammar against plain products."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import conversation_repair as cr
from rivulet.llm import repair_grammar as rg
from tests.helpers import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_faults(turns):
    """(role, text, fault) by turn."""
    out, seen = [], set()
    for _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])):
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_edits(turns):
    """(cost, audit, lines) of the cheapest, least edits: a search turn by turn over what the roles so far are."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(states):
        todo = list(states.items())
        while todo:
            last, (cost, audit, lines) = todo.pop()
            for c in set(follows[last]) & set("ua"):
                new = (cost + 2, audit + "I", (*lines, f"{names[c]}:"))
                if c not in states or new < states[c]:
                    states[c] = new
                    todo.append((c, new))
        return states

    states = {"": (0, "", ())}
    for role, text, fault in turns:
        extra, new = fault == "truncated", {}

        def take(c, value):
            if c not in new or value < new[c]:
                new[c] = value

        for last, (cost, audit, lines) in with_inserts(dict(states)).items():
            take(last, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] and role[0] in follows[last]:
                take(role[0], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for c in set(follows[last]) & set("ua"):
                take(c, (cost + extra + 2, audit + "R", (*lines, f"{names[c]}:{text}")))
        states = new
    ends = with_inserts(dict(states))
    return min(ends[c] for c in ("", "a") if c in ends)


def plain_conversation(turns) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash."""
    if not turns:
        return (0, 0, 0, 0, 0, 0, "", EMPTY)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faulty = plain_faults(turns)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
    cost, audit, lines = plain_edits(faulty)
    counts = [sum(f == x for _, _, f in faulty) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(given_rows):
    out = {}
    for conv, turn, role, text in given_rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain(given_rows):
    return sorted(((c, *plain_conversation(t)) for c, t in plain_damage(given_rows).items()), key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df, **options):
    report, turns = cr.repair(df, **options)
    hashes = cr.digests(turns)
    joined = report.join(hashes.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return rows(joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY))), *COLUMNS)


ROLES = ["system", "user", "assistant", "tool", "usr"]


def random_conversation(rng, conv, n):
    out = []
    for turn in range(n):
        role = rng.choice(ROLES) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
        text = rng.choice(["Yes.", "No!", "why?  ", "cut off", " \t", "", f"Turn {rng.randrange(5)}.", f"words {turn}."])
        out.append((conv, turn + (turn > 3) * rng.randrange(2), role, text))
    return out


letters = st.text(alphabet=[rg.letter(r, f) for r in range(4) for f in range(4)], max_size=12)


@given(st.lists(letters, min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_grammar_finds_the_cheapest_edits(strings):
    names = ["system", "user", "assistant", "tool"]
    faults = {rg.FINE: "", rg.BLANK: "blank", rg.DUPLICATE: "duplicate", rg.TRUNCATED: "truncated"}
    found = rg.Evaluated(strings)
    for x in strings:
        turns = [(names[(ord(c) - 65) // 4], "x", faults[(ord(c) - 65) % 4]) for c in x]
        assert found.whole(x) == plain_edits(turns)[:2]
        assert rg.finished(found.part(x)[rg.START]) == found.whole(x)


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=12))
@settings(max_examples=80, deadline=None)
def test_re_pair_derives_the_strings(strings):
    rules, written = rg.re_pair(strings, 3)

    def expand(x):
        return [x] if x < 3 else expand(rules[x - 3][0]) + expand(rules[x - 3][1])

    assert [[y for x in w if x >= 0 for y in expand(x)] for w in written] == strings
    pairs = {}
    for w in written:
        for p in zip(w[::2], w[1::2]):
            pairs[p] = pairs.get(p, 0) + (min(p) >= 0)
    assert all(n < rg.LEAST_USE for n in pairs.values())


def test_rules_serve_many_strings():
    strings = [rg.letter(1, 0) + rg.letter(2, 0)] * 3 + [(rg.letter(1, 0) + rg.letter(2, 0)) * k for k in range(1, 30)]
    found = rg.Evaluated(strings)
    assert max(map(len, found.written.values())) < 12  # of up to 58 letters
    assert found.whole(strings[-1]) == (0, "K" * 58)


def test_conversations_equal_brute_force(spark):
    rng, given_rows = random.Random(1), []
    for conv in range(150):
        given_rows += random_conversation(rng, conv, rng.randrange(1, 9))
    given_rows += random_conversation(rng, 900, 150)
    rng.shuffle(given_rows)
    got = repaired(spark.createDataFrame(given_rows, SCHEMA))
    by_conv = {}
    for c, t, r, x in given_rows:
        by_conv.setdefault(c, []).append((t, r, x))
    assert got == sorted(((c, *plain_conversation(t)) for c, t in by_conv.items()), key=repr)


@pytest.mark.parametrize(("block", "factors"), [(3, 2), (7, 3)])
def test_long_conversations_are_put_together_from_blocks(spark, block, factors):
    rng, given_rows = random.Random(block), []
    for conv, n in enumerate([1, 2, 3, 4, 6, 7, 8, 21, 64, 100]):
        given_rows += random_conversation(rng, conv, n)
    by_conv = {}
    for c, t, r, x in given_rows:
        by_conv.setdefault(c, []).append((t, r, x))
    got = repaired(spark.createDataFrame(given_rows, SCHEMA), block=block, factors=factors)
    assert got == sorted(((c, *plain_conversation(t)) for c, t in by_conv.items()), key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_conversations(spark, tmp_path, clash):
    from rivulet.llm.queries import QUERIES

    rng = random.Random(6)
    given_rows = [
        (None, 0, "user", "No id."), (None, None, None, None), (1, None, "user", "First."), (1, None, "assistant", None),
        (1, 5, "user", "x" * 200_000), (2, 0, None, "Who?"), (3, 0, "", "No role."), (3, 1, "user", ""),
        (4, 7, "user", "Same."), (4, 7, "user", "Same."), (4, 7, "assistant", "Same."), (5, -3, "système", "é ."),
    ]
    # by chance all turns of some conversations are dropped
    for conv in range(10, 300):
        given_rows += random_conversation(rng, conv, rng.randrange(1, 4))
    df = spark.createDataFrame(given_rows, SCHEMA)
    if clash:
        for c in ("place", "letter", "block", "audit", "head", "digest", "kind", "is_turn", "c", "_slice"):
            df = df.withColumn(c, F.lit("!"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    want = plain(given_rows)
    assert any(r[7] == "" for r in want)
    assert rows(QUERIES["op12_conversation_repair"](spark, str(tmp_path)), *COLUMNS) == want


def test_empty_table(spark):
    report, turns = cr.repair(spark.createDataFrame([], SCHEMA))
    assert report.collect() == [] and turns.collect() == [] and cr.digests(turns).collect() == []


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES

    given_rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.01")
    assert got.columns == COLUMNS
    assert rows(got) == plain(given_rows)
