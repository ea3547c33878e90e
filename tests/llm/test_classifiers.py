import random

import numpy as np
import pytest

from rivulet.llm import quality_classifier, toxicity
from rivulet.llm.language import Scorer, grams, identify_language, train
from rivulet.llm.quality_classifier import Encoder, GatedAttention, keep_good, score_quality, shape
from rivulet.llm.toxicity import score_toxicity
from tests.llm.corpora import awkward, frame, sentence


def junk(rng):
    words = sentence(rng, rng.choice([30, 300]), 300)
    return " ".join(rng.choice([lambda w: w.upper() + "!!", lambda w: w + " |", lambda w: w + "###"])(w) for w in words)


def test_quality_is_learned_from_labels_outside_the_held_fold(spark):
    rng = random.Random(1)
    good = {i: rng.random() < 0.75 for i in range(500)}
    docs = [(i, " ".join(sentence(rng, rng.choice([20, 200, 900]), 300)) if g else junk(rng)) for i, g in good.items()]
    labels = spark.createDataFrame([(i, int(g)) for i, g in good.items()], "doc_id bigint, quality int")
    found = score_quality(frame(spark, docs), labels).collect()
    held = [r for r in found if r.held_out]
    assert 50 < len(held) < 150 and len(found) == 500
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert np.mean([r.predicted == good[r.doc_id] for r in held]) > 0.97
    # labels of the held fold change nothing
    flipped = spark.createDataFrame(
        [(r.doc_id, int(good[r.doc_id] != r.held_out)) for r in found], "doc_id bigint, quality int"
    )
    again = {r.doc_id: r.score for r in score_quality(frame(spark, docs), flipped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-6) for r in found)


def test_attention_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    model = GatedAttention()
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    x = rng.normal(size=(9, quality_classifier.WIDTH))
    begins, y = np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.scores(x, begins)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, g in model.gradients(x, begins, y).items():
        flat, at = model.p[name].reshape(-1), rng.integers(model.p[name].size)
        flat[at] += 1e-6
        up = loss()
        flat[at] -= 2e-6
        down = loss()
        flat[at] += 1e-6
        assert g.reshape(-1)[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_attention_weighs_passages():
    """One bad passage among many good ones decides, if labels say so."""
    rng = random.Random(5)
    encode = Encoder()
    plain = lambda n: " ".join(sentence(rng, 64 * n, 300))
    texts = [(plain(5), 1.0) for _ in range(60)] + [(plain(2) + " " + "BUY!! " * 64 + plain(2), 0.0) for _ in range(60)]
    model = quality_classifier.train([encode(t.encode()) for t, _ in texts], np.array([y for _, y in texts], np.float32))
    bag = encode((plain(3) + " " + "BUY!! " * 64 + plain(1)).encode())
    assert model.scores(bag, np.array([0]))[0] < 0.3 < model.scores(encode(plain(5).encode()), np.array([0]))[0]


def test_shapes():
    assert [shape(t) for t in (b"THE!!", b"word,", b"Word", b"A1b2", b"###", "é".encode())] == [b"A!", b"a,", b"Aa", b"A9a9", b"#", b"a"]


def test_toxicity_is_learned_from_positives_and_unlabelled(spark):
    rng = random.Random(3)
    bad = [f"vile{s}" for s in "abcdefgh"]
    toxic = {i: rng.random() < 0.15 for i in range(1500)}
    docs = []
    for i, t in toxic.items():
        words = sentence(rng, rng.choice([10, 60, 300]), 800)
        for _ in range(3 if t else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ",", "."]))
        docs.append((i, " ".join(words)))
    # half of the documents have no label at all
    labels = spark.createDataFrame([(i, int(t)) for i, t in toxic.items() if i % 2], "doc_id bigint, toxic int")
    found = score_toxicity(frame(spark, docs), labels).collect()
    held = [r for r in found if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert np.mean([r.predicted for r in held if toxic[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in held if not toxic[r.doc_id]]) < 0.03


def test_negative_part_of_the_risk_is_held_at_zero():
    """With few texts and many features a plain PU risk would run far below zero."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.integers(0, 5000, 200)).astype(np.int32) for _ in range(120)]
    weights, bias = toxicity.train(rows[:60], rows, 0.5)
    s = toxicity._sigmoid(np.array([weights[r].sum() for r in rows]) + bias)
    assert -np.log1p(-s + 1e-9).mean() + 0.5 * np.log1p(-s[:60] + 1e-9).mean() > -0.1


def languages(rng):
    stems = {"en": ["the", "and", "house", "thing"], "de": ["der", "und", "haus", "ding"], "fr": ["les", "et", "maison", "chose"]}
    ends = {"en": "ing", "de": "ung", "fr": "eau"}
    rows = []
    for i in range(400):
        g = rng.choice(list(stems))
        words = [rng.choice(stems[g]) if rng.random() < 0.7 else f"{''.join(rng.choices('abcdefgh', k=5))}{ends[g]}" for _ in range(rng.choice([5, 60]))]
        rows.append((i, " ".join(words), g if i % 50 else None))
    return rows


def test_languages(spark):
    rows = languages(random.Random(2))
    found = identify_language(frame(spark, rows)).collect()
    known = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out and known[r.doc_id]]
    assert len(held) > 60 and np.mean([r.lang_pred == known[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_unknown_words_back_off_to_the_longest_known_grams(spark):
    model = train(frame(spark, [(1, "laufungen laufung gehungen", "de"), (2, "walking talking", "en")]))
    score = Scorer(model)
    assert score.word("laufung") == model["words"]["laufung"]
    for word, size in (("springungen", 5), ("qqgen", 4), ("xxg", 2), ("qqq", 1)):
        tables = [model["grams"][n] for n in range(size, 6)]
        assert not any(g in t for n, t in enumerate(tables[1:], size + 1) for g in grams(word, n))
        known = [tables[0][g] for g in grams(word, size) if g in tables[0]]
        assert known and score.word(word) == pytest.approx(np.mean(known, axis=0).tolist())
    assert score("springungen".encode())[0] == "de" and score("parking".encode())[0] == "en"


def test_counts_are_whole_however_often_a_task_flushes(spark, monkeypatch):
    rows = languages(random.Random(9))
    whole = train(frame(spark, rows))
    monkeypatch.setattr("rivulet.llm.language.FLUSH", 3)
    assert train(frame(spark, rows)) == whole


def test_awkward_rows(spark):
    rows = awkward()
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = frame(spark, rows, clash=True)
    for found in (score_quality(docs, labels), score_toxicity(docs, labels), identify_language(docs)):
        out = found.collect()
        assert len(out) == len(rows)
        assert all(r.score is not None and 0 <= r.score <= 1 for r in out)
        assert {r.held_out for r in out if r.doc_id is None} == {found.columns[2] == "score"}
    found = {r.doc_id: r for r in identify_language(docs).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4
    nothing = spark.createDataFrame([], labels.schema)
    assert len(score_quality(docs, nothing).collect()) == len(score_toxicity(docs, nothing).collect()) == len(rows)
    none = frame(spark, [])
    assert [f.collect() for f in (score_quality(none, labels), score_toxicity(none, labels), identify_language(none))] == [[], [], []]
    assert keep_good(docs, labels).columns == docs.columns
    assert {r.lang_pred for r in identify_language(docs.withColumn("lang", docs["lang"].substr(9, 1))).collect()} <= {"und", ""}
