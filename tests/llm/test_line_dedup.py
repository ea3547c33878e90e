import random

from rivulet import session
from rivulet.llm import line_dedup as module
from rivulet.llm.line_dedup import DEN, NUM, drop_similar_lines, line_dedup
from tests.llm.corpora import awkward, frame, sentence


def by_hand(rows):
    """(id, text) -> numbers of the lines that an earlier line resembles; rows in order."""
    seen, out = [], {}
    for i, text in rows:
        gone = []
        for k, line in enumerate((text or "").split("\n")):
            words = frozenset(line.lower().encode().split())
            if words:
                if any(DEN * len(words & s) >= NUM * len(words | s) for s in seen):
                    gone.append(k)
                seen.append(words)
        out[i] = gone
    return out


def corpus(seed):
    rng = random.Random(seed)
    stock = [sentence(rng, rng.choice([1, 2, 4, 9, 10, 11, 20, 21, 40]), 60) for _ in range(50)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(7)):
            words = list(rng.choice(stock)) if rng.random() < 0.7 else sentence(rng, rng.randrange(1, 25), 60)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [f"w{rng.randrange(60)}"], [words[at], f"v{rng.randrange(9)}"]])
                words = words or ["w1"]
            rng.shuffle(words)
            lines.append(rng.choice(["", " "]) + " ".join(w.upper() if rng.random() < 0.2 else w for w in words))
        rows.append((i, "\n".join(lines)))
    return rows


def removed(found):
    return {r.doc_id: [int(k) for k in r.removed.split(",") if k] for r in found}


def test_lines_as_by_hand(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        found = line_dedup(frame(spark, rows[::-1])).collect()
        assert removed(found) == by_hand(rows)
        assert all(r.n_removed == len(removed([r])[r.doc_id]) for r in found)


def test_large_group_of_similar_lines(spark):
    rng = random.Random(6)
    base = sentence(rng, 30, 10**6)
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(30)] = f"x{i}"
        if i % 3 == 0:
            words[rng.randrange(30)] = f"y{i}"
        rows.append((i, " ".join(words)))
    assert removed(line_dedup(frame(spark, rows)).collect()) == by_hand(rows)


def test_awkward_rows_and_texts_left(spark):
    rows = awkward()
    found = line_dedup(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    assert removed([r for r in found if r.doc_id == 10]) == {10: [0]}  # the line of 6 again
    assert [r.n_removed for r in found if r.doc_id == 6] == [0, 0]
    docs = frame(spark, [(1, "one two three\nfour"), (2, "three two one\nfive"), (3, None), (4, "")], clash=True)
    out = drop_similar_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "one two three\nfour", 2: "five", 3: None, 4: ""}
    assert line_dedup(frame(spark, [])).collect() == []


def test_rarity_table_has_a_fixed_size():
    assert module.BUCKETS == 1 << 14


def test_only_texts_with_lines_to_verify_are_moved(spark):
    rows = spark.range(5000).selectExpr("id", "xxhash64(id) AS h")
    wanted = rows.where("id % 100 = 0").selectExpr("h AS print")
    found = {r["id"] for r in module._marked(rows, wanted, "h", "print").collect()}
    assert found >= set(range(0, 5000, 100))
    assert len(found) < 300


def test_shuffle_files_go_with_each_step(spark, monkeypatch):
    seen = []
    write = module.settle_free

    def spy(df, label):
        out = write(df, label)
        seen.append(label)
        return out

    monkeypatch.setattr(module, "settle_free", spy)
    before = spark.conf.get(session.FREE_SHUFFLES)
    line_dedup(frame(spark, corpus(3))).collect()
    assert seen.count("spots") == 2 and "shared_prefixes" not in seen
    assert spark.conf.get(session.FREE_SHUFFLES) == before


def test_similar_lines_share_two_hashes(spark):
    rng = random.Random(11)
    rows = []
    for n in [9, 10, 11, 18, 19, 20, 29, 38, 57, 75, 76, 300, 1000, 1023, 1024, 1100, 2500]:
        words = [f"w{n}x{i}" for i in range(n)]
        for size in {n, -(-n * NUM // DEN)}:
            other = words[:size]
            while True:  # as far apart as similar sets of these sizes can be
                changed = [*other[:-1], f"y{rng.random()}"]
                rng.shuffle(changed)
                both = len(set(words) & set(changed))
                if DEN * both < NUM * len(set(words) | set(changed)):
                    break
                other = changed
            rows.append((len(rows), " ".join(words) + "\n" + " ".join(other)))
    keyed = module._keyed(module._lines(frame(spark, rows), "doc_id", "text"))
    assert keyed.where("level = 0").count() == 2 * len(rows)
    found = {}
    at = {(r.id, r.line_no): r.a for r in keyed.where("level = 0").collect()}
    for r in keyed.where("level > 0").collect():
        found.setdefault(r.a, set()).add(r.sig)
    for i, text in rows:
        a, b = at[i, 0], at[i, 1]
        assert a == b or len(found[a] & found[b]) >= 2, len(text.split())


def test_long_lines_as_by_hand(spark):
    rng = random.Random(12)
    rows = []
    for n in (300, 1020, 1030, 4000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for share in (0.02, 0.04, 0.06, 0.09):
            words = list(base)
            for k in rng.sample(range(n), int(n * share)):
                words[k] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
            rows.append((len(rows), " ".join(words[: int(n * 0.95)])))
    rng.shuffle(rows)
    assert removed(line_dedup(frame(spark, rows)).collect()) == by_hand(sorted(rows))


def test_frequent_hashes_as_by_hand(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT", 1)
    rows = corpus(4)
    assert removed(line_dedup(frame(spark, rows)).collect()) == by_hand(rows)


def test_only_lines_to_verify_are_read_again(spark, monkeypatch):
    sizes = {}
    write = module.settle_free

    def spy(df, label):
        out = write(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(module, "settle_free", spy)
    common = "the of and to in a is that for it"
    rows = [(i, f"{common} only{i} here{i}\n{common} more{i} there{i}") for i in range(200)]
    rows += [(200 + i, f"one two three four five six seven eight nine ten eleven twelve{' too' * i}") for i in range(2)]
    assert removed(line_dedup(frame(spark, rows)).collect()) == {**{i: [] for i in range(201)}, 201: [0]}
    assert sizes["line_pairs"][0] == 1 and sum(sizes["line_pairs"]) < 20 and sum(sizes["line_sets"]) < 40
