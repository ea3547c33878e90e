"""Packing documents into training sequences: shortest pack first over the length histogram.

Documents are tokenized and cut into pieces of at most one sequence; the number of pieces of each length
is all that the packing needs. Lengths are placed longest first: pieces of one length go to the packs
that are shortest so far, if they fit there, else they open packs. Packs are never held one by one, only
as patterns with a count. The patterns give, for each length, ranges of ranks; a piece finds its
sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, slices
from rivulet.session import bound_batches, settle

PIECES = "doc_id bigint, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# Fixed value: the signs of ASCII but for the apostrophe.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
CACHED_WORDS = 400_000  # words whose ids an encoder keeps; others are encoded for each slice anew


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes, encoded once per white-space separated word.

    Exact for tokenizers that fold ASCII case, drop white space and never join across it. The words of many texts are
    split and numbered by Arrow, so Python sees each different word once. A text with one of the tokenizer's special
    strings, in any case, is given to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # the ids that close a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        # one text; offsets, which nobody asks for, are left out
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode(self, plain: list[str], others: list[str]) -> dict[str, bytes]:
        """Words of letters only, ``plain``, are encoded together: each then ends with its only closing id."""
        found = {w: self._ids(w).tobytes() for w in others}
        for begin in range(0, len(plain), 1000):
            part = plain[begin : begin + 1000]
            ids = self._ids(" ".join(part))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                raw, at = ids.tobytes(), [0, *(cuts * 4).tolist()]
                found.update(zip(part, map(raw.__getitem__, map(slice, at, at[1:]))))
            else:
                found.update((w, self._ids(w).tobytes()) for w in part)
        return found

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words not kept so far; those of a special string are never used. Letters and the signs behind them
        are encoded apart: the tokenizer never joins them (but for an apostrophe, which is not among the signs)."""
        plain, others, ended = set(), set(), []
        known = self.known
        for word in words:
            stem = word.rstrip(SIGNS)
            if not stem.isalpha():
                others.add(word)
                continue
            if len(stem) < len(word):
                signs = word[len(stem) :]
                ended.append((word, stem, signs))
                if signs not in known:
                    others.add(signs)
            if stem not in known:
                plain.add(stem)
        fresh = self._encode(list(plain), list(others))
        get = lambda w: known.get(w) or fresh[w]
        fresh.update([(word, get(stem) + get(signs)) for word, stem, signs in ended])
        if len(known) < CACHED_WORDS:
            known.update(fresh)
        return fresh

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        begin = 0
        for end in _together([len(t) for t in texts]):
            yield from self._together(texts[begin:end])
            begin = end

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        lowered = pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.large_string()))
        split = pc.ascii_split_whitespace(lowered)
        words = split.values.dictionary_encode()  # a word for each place, each different one once
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, different))
        missing = [w for w, i in zip(different, ids) if i is None]
        if missing:
            fresh = self._learn(missing)
            ids = [fresh[w] if i is None else i for w, i in zip(different, ids)]
        # the ids of all words in place, one after the other in one buffer
        placed = pa.array(ids, pa.large_binary()).take(words.indices)
        _, ends, data = placed.buffers()
        cuts = np.frombuffer(ends, np.int64)[placed.offset :][split.offsets.to_numpy()]
        odd = np.zeros(len(texts), bool)
        for token in self.special:
            odd |= pc.match_substring(lowered, token).to_numpy(zero_copy_only=False)
        for text, is_odd, begin, end in zip(texts, odd.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            if is_odd:
                yield self._ids(text.decode()).tobytes()
            else:
                yield data.slice(begin, end - begin).to_pybytes() if end > begin else b""


def _together(sizes: list[int], most: int = 1_000_000) -> Iterator[int]:
    """Where to cut a list of texts into parts of about ``most`` bytes; a longer text is a part of its own."""
    held = 0
    for k, size in enumerate(sizes):
        if held and held + size > most:
            yield k
            held = 0
        held += size
    if sizes:
        yield len(sizes)


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences and a rest."""
    return [(a, min(capacity, tokens - a)) for a in range(0, tokens, capacity)]


def _pieces(batches, encoder: Callable, capacity: int, end_id: int):
    encode, end = encoder(), np.array([end_id], "<u4").tobytes()
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "row", "start", "length", "ids_crc32", "doc_tokens")])
    for batch in batches:
        for part in slices(batch, 500):
            out = []
            keys = zip(part.column("doc_id").to_pylist(), part.column("row").to_pylist())
            for (doc, row), ids in zip(keys, encode(binaries(part, "text"))):
                raw = ids + end
                n = len(raw) // 4
                out += [(doc, row, a, k, zlib.crc32(raw[4 * a : 4 * (a + k)]), n) for a, k in cut(n, capacity)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns (count, ((length, pieces of it), ...)) with every piece of ``histogram`` in one pack.

    A length joins at most as many patterns as there are and splits one, so there are few more patterns
    than lengths, and a pattern has less than sqrt(2 * capacity) different lengths.
    """
    packs: dict[tuple, int] = {}  # pattern -> count
    shortest: list[tuple[int, tuple]] = []

    def put(pattern: tuple, count: int) -> None:
        if pattern in packs:
            packs[pattern] += count
        else:
            packs[pattern] = count
            heapq.heappush(shortest, (sum(a * k for a, k in pattern), pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not shortest or shortest[0][0] + length > capacity:
                put(((length, 1),), left)
                left = 0
                continue
            size, pattern = shortest[0]
            count = packs[pattern]
            used = min(left, count)
            if used == count:
                heapq.heappop(shortest)
                del packs[pattern]
            else:
                packs[pattern] -= used
            last, times = pattern[-1]
            put((*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1)), used)
            left -= used
    return sorted(((n, p) for p, n in packs.items()), key=lambda x: x[1])


def slots(patterns: list[tuple[int, tuple]]) -> list[tuple]:
    """Rows (length, first rank, end rank, pieces per pack, first sequence, offset in the sequence)."""
    rank: Counter = Counter()
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, rank[length], rank[length] + count * times, times, sequence, offset))
            rank[length] += count * times
            offset += length * times
        sequence += count
    return rows


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable],
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    salt_rows: int = 50_000,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``encoder()`` is asked for once in a task and maps texts (bytes) to token ids (uint32 bytes). Null and
    empty texts have the end id alone. Rows that repeat an id are packed like any other. An empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    pieces = settle(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.col(text_column).alias("text"),
        ).mapInArrow(partial(_pieces, encoder=encoder, capacity=capacity, end_id=end_id), PIECES),
        "pieces",
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = max(16, sum(histogram.values()) // salt_rows)
    places = spark.createDataFrame(
        slots(shortest_pack_first(histogram, capacity)) or [],
        "length bigint, low bigint, high bigint, times bigint, sequence bigint, begin bigint",
    )
    # ranks within a length: inside a part of it, plus what the parts before it hold
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(parts)).cast("int"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    base = salted.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", before.alias("base"))
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "row"))
    ranked = (
        salted.withColumn("local", local).join(base, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("local") - 1).drop("base", "local")
    )
    at = F.col("rank") - F.col("low")
    nth = F.floor(at / F.col("times")).cast("bigint")
    return (
        ranked.join(F.broadcast(places), "length")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .select(
            F.col("doc_id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens",
            (F.col("sequence") + nth).alias("sequence_id"),
            (F.col("begin") + (at - nth * F.col("times")) * F.col("length")).alias("offset"),
        )
    )
