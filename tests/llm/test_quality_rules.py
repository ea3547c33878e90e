import math
import random
import re
from collections import Counter

import pytest

from rivulet.llm.quality_rules import RULES, certified_cutoffs, measures, quality_rules
from tests.llm.corpora import awkward, frame, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(3)
    some = [sentence(rng, rng.choice([0, 3, 5, 12, 80]), 30) for _ in range(40)]
    return [" ".join(w) for w in some] + [
        "a b c d e a b c d e", "a " * 11, "x y z\nx y z\n\n \nx y z ", "a\x85b c d", "\n", "p q r s t u p q r s t p q r s t u v w p q r s",
    ]


def test_measures_as_by_hand(spark):
    rows = [*awkward(), *((100 + i, t) for i, t in enumerate(texts()))]
    found = measures(frame(spark, rows)).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[2:] == by_hand(r.text), r.doc_id


def test_base_rule_and_awkward_rows(spark):
    rows = [*awkward(), *((100 + i, t) for i, t in enumerate(texts()))]
    labels = spark.createDataFrame([(100, 1), (101, None), (None, 1), (9999, 0)], "doc_id bigint, quality int")
    found = quality_rules(frame(spark, rows, clash=True), labels).collect()
    assert len(found) == len(rows)
    by_id = {r[0]: r[1] for r in rows if r[0] not in (None, 7)}
    for r in found:
        n, *_, repeat = (r.n_words, r.n_repeat_words)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (not r.base_failed)  # too few labels for any cutoff
        if r.doc_id in by_id:
            assert n == by_hand(by_id[r.doc_id])[0]
    assert quality_rules(frame(spark, []), labels).collect() == []


def tail(k, n, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


@pytest.mark.parametrize("alpha", [0.02, 0.1])
def test_cutoffs_are_certified_in_order(spark, alpha):
    """Cutoffs of one rule against the tests done by hand; other rules' measures are all lenient."""
    rng = random.Random(8)
    rows = []
    for stratum, n in (("en", 3000), (None, 2500), ("de", 40)):
        for _ in range(n):
            good = rng.random() < 0.8
            symbols = int(100 * (rng.betavariate(1, 30) if good else rng.betavariate(2, 4)))
            rows.append((stratum, good, symbols, 100, 0, 1, 0, 20, 0))
    df = spark.createDataFrame(rows, "stratum string, good boolean, n_symbols bigint, word_chars bigint, n_dup_lines bigint, n_lines bigint, n_repeat_words bigint, n_words bigint, n_upper bigint")
    found = {(r.stratum, r.rule): r for r in certified_cutoffs(df, alpha, 0.05).collect()}
    assert {rule for _, rule in found} <= {"symbol_share"}
    for stratum in ("en", None, "de"):
        held = [(r[1], r[2] / 100) for r in rows if r[0] == stratum]
        n_good, n_bad = sum(g for g, _ in held), sum(not g for g, _ in held)
        best = None
        for cut in RULES["symbol_share"]:
            k = sum(g and x > cut for g, x in held)
            if tail(k, n_good, alpha / len(RULES)) > 0.05 / (3 * len(RULES)):
                break
            bad = sum(not g and x > cut for g, x in held)
            gain = bad / n_bad - k / n_good
            if bad and (best is None or gain > best[0]):
                best = (gain, cut, n_good, k, bad)
        r = found.get((stratum, "symbol_share"))
        assert (None if r is None else (r.cutoff, r.n_good, r.good_rejected, r.bad_rejected)) == (best and best[1:])
    assert ("de", "symbol_share") not in found and ("en", "symbol_share") in found


def test_guarantee_on_fresh_texts(spark):
    rng = random.Random(4)

    def text(good):
        words = sentence(rng, 40, 3000)
        return " ".join(w + ("###" if rng.random() < (0.01 if good else 0.6) else "") for w in words)

    docs = [(i, text(i % 5 != 0)) for i in range(8000)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(4000)], "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules(frame(spark, docs), labels).collect()}
    fresh = range(4000, 8000)
    good, bad = [kept[i] for i in fresh if i % 5], [kept[i] for i in fresh if i % 5 == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)
