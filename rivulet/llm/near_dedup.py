"""Near duplicates: MinHash signatures joined under a Hamming threshold by several indexes.

Texts with the same set of shingles are one class. A class has a signature of ``SYMBOLS`` MinHash symbols of
16 bits; four of them are a chunk, held in a long. Two signatures that differ in at most ``MOST_ERRORS``
symbols cannot have two errors in every chunk (pigeonhole: 2 * 12 > 22), so some chunk has at most one;
enumerating the symbol that may be wrong in each chunk gives keys that two such signatures are sure to
share. A pair passes the join once, at its first chunk with at most one error, if its symbol distance and
its set sizes allow, and if a bitmap does: each shingle flips one of 1024 bits, so that bitmaps cannot
differ in more bits than the sets differ in shingles.

Links are confirmed on full shingle sets, in two rounds. First every class is compared with one hub:
the class most central in the keys they share. Then all candidate pairs in different components are
compared. Pairs inside a component need no comparison, so that a large group of near copies costs
one comparison per member, and no link between components is lost.

At similarity 0.75 the symbol distance is binomial with mean 12 and deviation 3; the threshold lies 3.5
deviations above, so of pairs exactly at the threshold about 5 in 10,000 are missed, and fewer above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, slices
from rivulet.llm.components import components
from rivulet.session import bound_batches, settle

SHINGLE = 5
SYMBOLS, PER_CHUNK, MOST_ERRORS = 48, 4, 22
CHUNKS = [f"c{i}" for i in range(SYMBOLS // PER_CHUNK)]  # four 16-bit symbols each
FLIPS = [f"f{i}" for i in range(16)]  # 1024 bits
CACHED_WORDS = 500_000
RUNS = 64

_random = np.random.default_rng(20240)
FACTORS = _random.integers(0, 2**31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
OFFSETS = _random.integers(0, 2**32, SYMBOLS, dtype=np.uint32)
PLACES = _random.integers(0, 2**62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts (UTF-8 bytes)."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: ASCII letters and white space only
        if not words:
            return np.empty(0, np.uint64)
        found = list(map(self.words.get, words))
        if None in found:
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            found = [self.words.setdefault(w, xxhash.xxh3_64_intdigest(w)) if h is None else h for w, h in zip(words, found)]
        h = np.array(found, np.uint64)
        width = min(SHINGLE, len(h))
        sums = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            sums += h[k : k + len(sums)] * PLACES[k]
        sums ^= sums >> np.uint64(29)
        sums *= np.uint64(0xBF58476D1CE4E5B9)
        sums ^= sums >> np.uint64(32)
        return np.unique(sums)


def symbols(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``SYMBOLS`` 16-bit MinHash symbols per non-empty set."""
    x = np.concatenate(sets).astype(np.uint32)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), np.uint32)
    for j in range(SYMBOLS):
        out[:, j] = np.minimum.reduceat(x * FACTORS[j] + OFFSETS[j], begins)
    # the minima are small numbers: mix their bits before 16 of them are kept
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x7FEB352D)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x846CA68B)
    return (out >> np.uint32(16)).astype("<u2")


def flips(sets: list[np.ndarray]) -> np.ndarray:
    """A row of longs per set: the parity of the shingles that fall on each bit."""
    bits = 64 * len(FLIPS)
    at = np.repeat(np.arange(len(sets)) * bits, [len(s) for s in sets]) + (np.concatenate(sets) >> np.uint64(54)).astype(np.int64)
    parity = (np.bincount(at, minlength=len(sets) * bits) & 1).astype(np.uint8).reshape(len(sets), bits)
    return np.packbits(parity, axis=1, bitorder="little").view("<i8")


PRINTS = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("set", pa.binary()), *[(c, pa.int64()) for c in CHUNKS + FLIPS]]
)


def _prints(batches: Iterator[pa.RecordBatch]):
    """Size, digest, signature and bitmap of each text's shingle set."""
    shingles = Shingler()
    for batch in batches:
        for part in slices(batch, 200):
            sets = [shingles(t) for t in binaries(part, "text")]
            some = [k for k, s in enumerate(sets) if len(s)]
            longs = np.zeros((len(sets), len(CHUNKS) + len(FLIPS)), np.int64)
            if some:
                given = [sets[k] for k in some]
                longs[some] = np.concatenate([symbols(given).view("<i8"), flips(given)], axis=1)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array(map(len, sets), pa.int64()), pa.array(digests, pa.binary()),
                    *[pa.array(longs[:, i]) for i in range(longs.shape[1])],
                ],
                schema=PRINTS,
            )


def chunk_keys() -> Column:
    """(slot, key) for each chunk and each of its symbols: a hash of the chunk without that symbol."""
    keys = []
    for i, chunk in enumerate(CHUNKS):
        for gap in range(PER_CHUNK):
            slot, rest = i * PER_CHUNK + gap, ~(0xFFFF << 16 * gap) & (2**64 - 1)
            rest = F.lit(rest - 2**64 if rest >= 2**63 else rest).cast("bigint")
            keys.append(F.struct(F.lit(slot).alias("slot"), F.xxhash64(F.lit(slot), F.col(chunk).bitwiseAND(rest)).alias("key")))
    return F.array(*keys)


def alike(x: DataFrame, y: DataFrame, share: int) -> Column:
    """Whether sizes and bitmaps leave room for the similarity. ``y`` has the columns of ``x`` with an underscore behind them."""
    apart = reduce(lambda a, b: a + b, [F.bit_count(x[f].bitwiseXOR(y[f"{f}_"])) for f in FLIPS])
    # similarity of at least s means a difference of at most (1 - s) / (1 + s) of both sizes
    return (100 * F.least(x["n"], y["n_"]) >= share * F.greatest(x["n"], y["n_"])) & (
        apart * (100 + share) <= (x["n"] + y["n_"]) * (100 - share)
    )


def errors(x: Column, y: Column) -> Column:
    """In how many of its four symbols a chunk differs."""
    z = x.bitwiseXOR(y)
    for shift, kept in ((8, 0x00FF), (4, 0x000F), (2, 0x0003), (1, 0x0001)):
        mask = F.lit(kept * 0x0001000100010001).cast("bigint")
        z = z.bitwiseOR(F.shiftrightunsigned(z, shift)).bitwiseAND(mask)
    return F.bit_count(z)


def chunks_at_slot() -> list[Column]:
    """The chunk that a key is of, and the chunk before it (null for the first)."""
    at, chunks = F.floor(F.col("slot") / PER_CHUNK).cast("int"), F.array(*CHUNKS)
    return [F.get(chunks, at).alias("own"), F.when(at > 0, F.get(chunks, at - 1)).alias("before")]


def may_pass(x: DataFrame, y: DataFrame) -> Column:
    """Whether this can be the key at which a pair passes: of an equal chunk only the first key, and of chunks with at most
    one error that follow each other only the first. It spares most of a pair's other keys the way through Python."""
    return ((x["own"] != y["own_"]) | (x["slot"] % PER_CHUNK == 0)) & (x["before"].isNull() | (errors(x["before"], y["before_"]) >= 2))


def _near(batches: Iterator[pa.RecordBatch]):
    """Of pairs that share a key those whose signatures are near enough, each at the key at which it passes."""

    def signatures(part, tag: str) -> np.ndarray:
        return np.stack([part.column(f"{c}{tag}").to_numpy() for c in CHUNKS], axis=1).view("<u2")

    for batch in batches:
        for part in slices(batch, 20_000):
            wrong = (signatures(part, "") != signatures(part, "_")).reshape(-1, len(CHUNKS), PER_CHUNK).sum(axis=2)
            slot = part.column("slot").to_numpy()
            # the pair's first chunk with at most one error, and which of its symbols is left out
            first = (wrong <= 1).argmax(axis=1)
            left_out = np.where(wrong[np.arange(len(slot)), first] == 0, 0, slot % PER_CHUNK)
            kept = (wrong.sum(axis=1) <= MOST_ERRORS) & (slot == first * PER_CHUNK + left_out)
            yield part.filter(pa.array(kept)).select(["rep", "rep_"])


def _sets(batches: Iterator[pa.RecordBatch]):
    shingles = Shingler()
    for batch in batches:
        for part in slices(batch, 200):
            sets = [shingles(t).view(np.int64) for t in binaries(part, "text")]
            lists = pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=["rep", "shingles"])


def confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least ``share`` percent of their union in common."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - F.col("both")
    return (
        pairs.select("a", "b").join(one, "a").join(two, "b")
        .withColumn("both", both).where(100 * F.col("both") >= share * union).select("a", "b")
    )


def link_classes(classes: DataFrame, sets_of, share: int) -> DataFrame:
    """(node, label) of the classes that are linked with others.

    ``classes`` is (rep, n, chunks, flips); ``sets_of(reps)`` gives the shingle sets of some of them.
    """
    keys = settle(classes.select("rep", F.inline(chunk_keys())), "keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    held = settle(keys.join(shared, "key"), "shared_keys")
    scores = settle(held.groupBy("rep").agg(F.sum("members").alias("score")), "candidates")
    sets = sets_of(scores.select("rep"))

    # first round: one hub per class, the most central among the hubs of its keys
    scored = held.join(scores, "rep")
    hubs = scored.groupBy("key").agg(F.max_by("rep", F.struct("score", -F.col("rep"))).alias("hub"), F.max("score").alias("top"))
    met = (
        held.join(hubs, "key").where("rep <> hub")
        .groupBy("rep").agg(F.max_by("hub", F.struct("top", -F.col("hub"))).alias("hub"))
    )
    stars = settle(confirmed(met.select(F.col("rep").alias("a"), F.col("hub").alias("b")), sets, share), "stars")

    # second round: candidate pairs that are still apart. In each key the members of its largest component
    # only meet the others.
    first = components(stars).withColumnRenamed("node", "rep")
    labels = scores.select("rep").join(first, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    rows = settle(held.drop("members").join(labels, "rep"), "labelled_keys")
    sizes = rows.groupBy("key", "label").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("key").agg(
        F.max_by("label", F.struct("m", -F.col("label"))).alias("main"), F.count("*").alias("labels")
    ).where("labels > 1")
    still = rows.join(largest.drop("labels"), "key").join(classes, "rep").select("*", *chunks_at_slot())
    still = settle(still, "open_keys")
    x, y = still.where("label <> main"), still.drop("main", "slot").toDF(*[f"{c}_" for c in still.drop("main", "slot").columns])
    met = x.join(y, (x["key"] == y["key_"]) & (x["label"] != y["label_"]) & alike(x, y, share) & may_pass(x, y))
    sides = ["slot", *[f"{c}{tag}" for tag in ("", "_") for c in ["rep", *CHUNKS]]]
    pairs = met.select(*sides).mapInArrow(_near, "rep bigint, rep_ bigint")
    pairs = pairs.select(F.least("rep", "rep_").alias("a"), F.greatest("rep", "rep_").alias("b")).distinct()
    bridges = settle(confirmed(pairs, sets, share), "bridges")
    return components(stars.unionByName(bridges))


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = 75) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``, ``class_id``.

    ``class_id`` is the smallest id with the same shingle set, ``component_id`` the smallest id that links
    reach. Null and empty texts have no shingle and are linked with nothing. Rows with a null id are not
    linked and kept. Rows that repeat an id share its fate. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    prints = settle(given.mapInArrow(_prints, ", ".join(f"{f.name} {_SQL[f.type]}" for f in PRINTS)), "prints")
    prints = prints.withColumn("run", F.pmod(F.xxhash64("id"), F.lit(RUNS)))

    # classes in two steps, so that a third of all rows may have one text
    given_sets = prints.where("set IS NOT NULL AND id IS NOT NULL")
    first = given_sets.groupBy("run", "set").agg(F.min("id").alias("low"))
    whole = first.groupBy("set").agg(F.min("low").alias("rep"))
    members = settle(first.select("run", "set").join(whole, "set"), "classes")
    # a set of one shingle is only linked with its equals
    classes = settle(
        given_sets.where("n > 1").join(members, ["run", "set"]).where("id = rep")
        .select("rep", "n", *CHUNKS, *FLIPS).dropDuplicates(["rep"]),
        "signatures",
    )

    def sets_of(reps: DataFrame) -> DataFrame:
        texts = given.join(reps.withColumnRenamed("rep", "id"), "id", "left_semi")
        return settle(texts.mapInArrow(_sets, "rep bigint, shingles array<bigint>"), "shingle_sets")

    labels = link_classes(classes, sets_of, share).select(F.col("node").alias("rep"), "label")
    fates = members.join(labels, "rep", "left")
    return prints.join(fates, ["run", "set"], "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("label", "rep", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("label", "rep", "id"), F.lit(True)).alias("kept"),
        F.coalesce("rep", "id").alias("class_id"),
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = 75) -> DataFrame:
    """The rows of ``docs`` that stand for their component; rows with a null id stay."""
    gone = near_dedup(docs, id_column, text_column, share).where("NOT kept").select(F.col(id_column).alias("gone"))
    return docs.join(gone, docs[id_column] == gone["gone"], "left_anti")


_SQL = {pa.int64(): "bigint", pa.binary(): "binary"}
