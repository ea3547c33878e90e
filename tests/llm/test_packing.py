import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm.common import slices
from rivulet.llm.packing import WordEncoder, cut, pack, shortest_pack_first, slots
from rivulet.llm.queries import word_bpe
from tests.llm.corpora import awkward, frame


@pytest.fixture(scope="module")
def encoder():
    return word_bpe()


@pytest.fixture(scope="module")
def public():
    """The public tokenizer, as it comes."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(public, text):
    return np.array(public.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("text", [
    "Plain words, and. more: it's 3.14 don't STOP!! ...", "Été naïve Über straße éa İstanbul", "ΣΣ σς ΟΣ ",
    "tabs\tand\nlines\x0band\x0cmore\r\n", "你好世界 \U0001f600\U0001f468‍\U0001f469 a b c", "", "  ", ",", "a,", "...", "x" * 5000,
    "<|startoftext|> in a text <|endoftext|>", "<|endoftext|> x", "A<|endoftext|>b <|ENDOFTEXT|> <|x|>", "  lead and trail  ", "a\x1fb\u2028c",
    "٠١٢ ½ Ⅷ ǅ ʰ ﬁ ẞ", "word&&& a.%%% b,### c's d!'s e'!s f..' (g) h-i é*** é\u0301*** ʼn!! x_y_ _z 3.! ,.,",
])
def test_words_encode_as_the_text_does(encoder, public, text):
    assert next(encoder([text.encode()])) == whole(public, text).tobytes()


def test_words_encode_alike_when_kept_words_are_full(public, monkeypatch):
    monkeypatch.setattr("rivulet.llm.packing.CACHED_WORDS", 0)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) + rng.choice(["", ",", ".", "!"]) for _ in range(200)) for _ in range(5)]
    small = word_bpe()
    assert list(small([t.encode() for t in texts])) == [whole(public, t).tobytes() for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_every_length_once(seed):
    rng = random.Random(seed)
    lengths = Counter(min(2048, max(1, int(rng.expovariate(1 / rng.choice([5, 300, 1500]))))) for _ in range(rng.choice([1, 50, 5000])))
    patterns = shortest_pack_first(lengths, 2048)
    assert all(sum(a * k for a, k in p) <= 2048 for _, p in patterns)
    placed = Counter()
    for n, pattern in patterns:
        for length, k in pattern:
            placed[length] += n * k
    assert placed == lengths
    covered = defaultdict(int)
    for length, low, high, *_ in slots(patterns):
        assert covered[length] == low
        covered[length] = high
    assert covered == lengths


def test_cut():
    assert cut(1, 2048) == [(0, 1)]
    assert cut(2048, 2048) == [(0, 2048)]
    assert cut(5000, 2048) == [(0, 2048), (2048, 2048), (4096, 904)]


def test_pieces_give_back_the_documents(spark, public):
    rng = random.Random(1)
    rows = awkward() + [(100 + i, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(900)))) for i in range(80)]
    found = pack(frame(spark, rows, clash=True), word_bpe, salt_rows=10).collect()
    ids = [(i, np.append(whole(public, t), np.uint32(1)).astype("<u4")) for i, t, *_ in rows]
    want = Counter((i, a, k, zlib.crc32(x[a : a + k].tobytes()), len(x)) for i, x in ids for a, k in cut(len(x), 2048))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(x) for _, x in ids)
    assert len(sequences) <= total / 2048 * 1.1 + 1


def test_empty(spark):
    assert pack(frame(spark, []), word_bpe).collect() == []


def test_a_worker_keeps_its_encoder_from_task_to_task(spark):
    def encoders(batches):
        for batch in batches:
            encoder = word_bpe()
            before = len(encoder.known)
            list(encoder([b"kept for the next task"]))
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "before": [before], "after": [len(encoder.known)]})

    found = spark.range(0, 32, 1, 32).mapInArrow(encoders, "pid bigint, before bigint, after bigint").collect()
    by_worker = {}
    for r in found:
        by_worker.setdefault(r["pid"], []).append(r)
    assert len(by_worker) < 32
    for rows in by_worker.values():  # only a worker's first task learns the words
        assert sum(r["after"] > r["before"] for r in rows) <= 1


def test_batches_of_long_texts_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.get_total_buffer_size()]})

    pack(frame(spark, [(1, "a b")]), word_bpe)
    texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('word ', 2000) AS text")
    assert max(r["bytes"] for r in texts.mapInArrow(sizes, "bytes bigint").collect()) < 16_000_000


def test_unused_memory_of_a_batch_is_given_back(monkeypatch):
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})()
    monkeypatch.setattr("rivulet.llm.common.pa.default_memory_pool", lambda: pool)
    batch = pa.RecordBatch.from_pydict({"x": list(range(10))})
    assert [p.num_rows for p in slices(batch, 4)] == [4, 4, 2]
    assert released == [1]


def test_the_tokenizer_is_asked_once_for_many_new_words_and_never_for_offsets(public, monkeypatch):
    small, asked = word_bpe.__wrapped__(), []

    class Spy:
        def encode(self, text, **kwargs):
            raise AssertionError("offsets are not needed")

        def encode_batch_fast(self, texts, **kwargs):
            asked.extend(texts)
            return public.encode_batch_fast(texts, **kwargs)

    monkeypatch.setattr(small, "tokenizer", Spy())
    texts = [" ".join(f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}{s}" for i in range(300)) for s in ("", ",", ".", "!")]
    texts += ["Ünïcode, naïve. 你好! ok", "a,b c.", "'tis it's", ""]
    assert list(small([t.encode() for t in texts])) == [whole(public, t).tobytes() for t in texts]
    assert len(asked) < 15
    list(small([t.encode() for t in texts[:4]]))
    assert len(asked) < 15
