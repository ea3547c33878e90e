"""Near duplicates by SimHash: an inverted index of fingerprint bytes by position, filtered by counts.

Two 64-bit fingerprints that differ in at most ``MOST_BITS`` = 4 bits differ in at most four of their eight
bytes, so they share at least ``LEAST_SHARED`` = 4 positional bytes. The index has a list of fingerprints
for positional bytes; a pair is a candidate if its tally of shared bytes reaches that minimum, and a link if its
bits agree well enough.

The list of a single byte would hold 1/256 of all fingerprints. The lists kept are those of several positions
at once, read off the tally: a pair shares either five positions or more, and so one of the 56 lists of five bytes
(40 bits); or just four, and then each of the other bytes is wrong in exactly one bit, which flips its parity.
Lists of four bytes (70 of them) therefore also hold the parities of the other bytes, up to flipping them all, and only
fingerprints of opposite ``side`` meet there. Of N fingerprints without likeness about 1.1e-9 N^2 / 2 pairs meet.

Only distinct fingerprints are indexed. In a list every fingerprint first meets the smallest one (a hub), and is linked
with the smallest hub that it is near to; then only fingerprints that are still in different components meet each
other. A crowd of near copies costs one comparison per fingerprint and list and one link per fingerprint, and no
link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, slices
from rivulet.llm.components import components
from rivulet.session import settle

SHINGLE, SEED = 4, 42
MOST_BITS, LEAST_SHARED = 4, 4
PART = 100_000  # shingles that are hashed at once

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = np.arange(8) * 256
UNITS = 0x0101010101010101  # the lowest bit of every byte


def fingerprint(text: bytes) -> int:
    """Majority of each bit over the hashes of all word shingles; 0 without words."""
    words = text.lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined, width = b" ".join(words), min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins, ends = (ends - lengths)[: len(words) - width + 1], ends[width - 1 :]
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, len(begins), PART):
        spans = zip(begins[at : at + PART].tolist(), ends[at : at + PART].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[b:e], SEED) for b, e in spans], "<u8")
        counts += np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    on = 2 * (counts @ _BITS_OF_BYTE) > len(begins)
    return int.from_bytes(np.packbits(on, axis=1, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch):
            prints = np.array([fingerprint(t) for t in binaries(part, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints)], names=["id", "bits"])


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _long(x: int) -> Column:
    return F.lit(_signed(x)).cast("bigint")


def _lists() -> Column:
    """(slot, kept, free, first) of each kind of list: the bytes it keeps, the parities of the others, the one that says
    the side. Lists of five bytes have no parities."""
    kinds = []
    for size in (5, 4):
        for places in combinations(range(8), size):
            rest = [p for p in range(8) if p not in places] if size == 4 else []
            kept = sum(0xFF << 8 * p for p in places)
            free = sum(1 << 8 * p for p in rest)
            kinds.append((len(kinds), kept, free, 1 << 8 * rest[0] if rest else 0))
    return F.array(
        *[
            F.struct(F.lit(i).cast("smallint").alias("slot"), _long(k).alias("kept"), _long(f).alias("free"), _long(s).alias("first"))
            for i, k, f, s in kinds
        ]
    )


def index_entries(prints: DataFrame) -> DataFrame:
    """(slot, entry, side, bits): the lists in which each of the distinct fingerprints ``bits`` stands."""
    parity = F.col("bits")
    for shift in (4, 2, 1):
        parity = parity.bitwiseXOR(F.shiftrightunsigned(parity, shift))
    rows = prints.select("bits", parity.bitwiseAND(_long(UNITS)).alias("parity"), F.inline(_lists()))
    side = F.col("parity").bitwiseAND(F.col("first")) != 0
    wrong = F.col("parity").bitwiseAND(F.col("free"))
    wrong = F.when(side, wrong.bitwiseXOR(F.col("free"))).otherwise(wrong)
    return rows.select("slot", F.col("bits").bitwiseAND(F.col("kept")).bitwiseOR(wrong).alias("entry"), side.alias("side"), "bits")


def shared_bytes(x: Column, y: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    z = x.bitwiseXOR(y)
    for shift, kept in ((4, 0x0F), (2, 0x03), (1, 0x01)):
        z = z.bitwiseOR(F.shiftrightunsigned(z, shift)).bitwiseAND(_long(kept * UNITS))
    return 8 - F.bit_count(z)


def linked(x: Column, y: Column) -> Column:
    """The tally first, then the bits."""
    return (shared_bytes(x, y) >= LEAST_SHARED) & (F.bit_count(x.bitwiseXOR(y)) <= MOST_BITS)


def link_prints(prints: DataFrame) -> DataFrame:
    """(node, label) of the fingerprints ``bits`` that are linked with others; label is the smallest in reach."""
    of_list = Window.partitionBy("slot", "entry")
    entries = index_entries(prints).select(
        "*",
        F.count("*").over(of_list).alias("n"),
        F.min(F.when(F.col("side"), F.col("bits"))).over(of_list).alias("hub_on"),
        F.min(F.when(~F.col("side"), F.col("bits"))).over(of_list).alias("hub_off"),
    )
    # lists of five bytes have one side only, on which all meet
    one_sided = F.col("slot") < 56
    held = settle(
        entries.where((F.col("n") > 1) & (one_sided | (F.col("hub_on").isNotNull() & F.col("hub_off").isNotNull())))
        .withColumn("hub", F.when(one_sided | F.col("side"), F.col("hub_off")).otherwise(F.col("hub_on")))
        .select("slot", "entry", "side", "bits", "hub"),
        "entries",
    )
    stars = settle(
        held.where((F.col("bits") != F.col("hub")) & linked(F.col("bits"), F.col("hub")))
        .groupBy(F.col("bits").alias("a")).agg(F.min("hub").alias("b")),
        "stars",
    )

    # fingerprints that hubs have not joined; the largest component of a list only meets the others
    first = components(stars).withColumnRenamed("node", "bits")
    rows = settle(
        held.drop("hub").join(first, "bits", "left").withColumn("label", F.coalesce("label", "bits")), "labelled_entries"
    )
    sizes = rows.groupBy("slot", "entry", "label").agg(F.count("*").alias("m"))
    mixed = sizes.groupBy("slot", "entry").agg(
        F.max_by("label", F.struct("m", -F.col("label"))).alias("main"), F.count("*").alias("labels")
    ).where("labels > 1")
    still = settle(rows.join(mixed.drop("labels"), ["slot", "entry"]), "open_entries")
    x, y = still.where("label <> main"), still.toDF(*[f"{c}_" for c in still.columns])
    meet = (
        (x["slot"] == y["slot_"]) & (x["entry"] == y["entry_"]) & (x["label"] != y["label_"])
        & ((y["label_"] == y["main_"]) | (x["bits"] < y["bits_"]))
        & ((x["slot"] < 56) | (x["side"] != y["side_"]))
        & linked(x["bits"], y["bits_"])
    )
    # what is linked already counts as one: components, not fingerprints, are joined from here on
    bridges = x.join(y, meet).select(F.least("label", "label_").alias("a"), F.greatest("label", "label_").alias("b")).distinct()
    second = components(settle(bridges, "bridges")).select(F.col("node").alias("old"), F.col("label").alias("new"))
    alone = second.select(F.col("old").alias("bits"), F.col("old").alias("label"))  # components of one have no star
    of_first = first.unionByName(alone.join(first, "bits", "left_anti"))
    return of_first.join(second, F.col("label") == F.col("old"), "left").select(
        F.col("bits").alias("node"), F.coalesce("new", "label").alias("label")
    )


def simhash_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``, ``kept``.

    ``component_id`` is the smallest id that links reach. Null, empty and blank texts have fingerprint zero and are
    linked like any other. Rows with a null id are fingerprinted, but not linked: their component is null and
    they are kept. Rows that repeat an id are linked each by its own text; the component of each is the smallest id in
    reach of that text. An empty table gives an empty result.
    """
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    prints = settle(given.mapInArrow(_fingerprints, "id bigint, bits bigint"), "fingerprints")
    classes = settle(prints.where("id IS NOT NULL").groupBy("bits").agg(F.min("id").alias("rep")), "fingerprint_classes")
    labels = link_prints(classes.select("bits"))
    labelled = classes.join(labels.withColumnRenamed("node", "bits"), "bits", "left").withColumn("label", F.coalesce("label", "bits"))
    lowest = labelled.groupBy("label").agg(F.min("rep").alias("component"))
    fates = settle(labelled.join(lowest, "label").select(F.col("bits").alias("bits_"), "component"), "fingerprint_components")
    found = prints.join(fates, (F.col("bits") == F.col("bits_")) & F.col("id").isNotNull(), "left")
    return found.select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
