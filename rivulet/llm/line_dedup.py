"""Near-equal lines by an exact set-similarity join; of similar lines all but the first go.

A line is the set of its lower-cased words, each a number: 63 bits of its hash, so that sorted numbers are words in
an order as good as random. Lines with equal sets are one class, which the first line stands for. Sets with Jaccard
similarity of at least ``NUM / DEN`` differ in no more than ``_apart`` words. If numbers are cut into two more equal
ranges than that, two ranges at least hold the same words in both sets; classes meet by the hash of what they have in
a range. The number of ranges goes by levels of size: that of the larger set, and the smaller is in its own level
or the next. What meets and is of similar size is verified on full sets.

Classes are first compared with one class per hash (and per two hot ones), the earliest: in a large group of similar lines that already
removes nearly all. Only classes that are left are then compared with all earlier ones. A hash of more than ``HOT``
classes is mostly a range with few and frequent words; there, classes meet only if they have two such hashes in common.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import text_or_empty
from rivulet.session import settle_free

NUM, DEN = 9, 10  # similarity 0.9
BUCKETS = 1 << 14  # words in the smallest table of marks
HOT = 32
LONG = 1 << 10
MOST_MARKS = 1 << 21  # words in the largest table of marks, 16 MB
SPACES = "\t\x0b\f\r"  # besides the space
LOWEST, NUMBERS = -(1 << 62), 1 << 63  # of the numbers of words: the first, and how many there are


def _lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, print, line_no, words) of lines with a word."""
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), F.posexplode(F.split(_plain(text), "\n")).alias("line_no", "line")
    )
    return rows.where(F.trim("line") != "").withColumn("words", _words(F.col("line"))).drop("line")


def _plain(text: Column) -> Column:
    """Lower case, with no white space but the space and the line feed."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.lower(text)


def _words(plain: Column) -> Column:
    """The distinct words in order."""
    numbers = F.transform(F.split(plain, " "), lambda w: F.shiftright(F.xxhash64(w), 1))
    return F.sort_array(F.array_distinct(F.array_remove(numbers, F.shiftright(F.xxhash64(F.lit("")), 1))))


def _bits() -> Column:
    """Each word flips one of 64 bits: bitmaps differ in no more bits than sets differ in words."""
    one = F.lit(1).cast("bigint")
    return F.aggregate(
        "words",
        F.lit(0).cast("bigint"),
        lambda seen, w: seen.bitwiseXOR(F.call_function("shiftleft", one, w.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))),
    )


def _apart(size: int) -> int:
    """In how many words a set may differ from one that is similar and no larger."""
    return 2 * size * (DEN - NUM) // (DEN + NUM)


def _levels() -> list[tuple[int, int, int]]:
    """(smallest size, outer ranges, inner ranges in each) of the levels; the first is of sets with no similar ones.

    Each level is wide enough for a set's similar ones to be in the next at most. From ``LONG`` on it doubles sizes.
    """
    low = next(n for n in range(1, 2 * DEN + 1) if _apart(n))
    levels = [(0, 1, 1)]
    while low < 1 << 31:
        high = 2 * low if low >= LONG else -(-low * 13 // 10)
        while low < LONG and _apart(high) == _apart(high - 1):
            high += 1
        high = LONG if low < LONG < 1.3 * high else high
        ranges = _apart(high - 1) + 2
        outer = math.isqrt(ranges) if ranges > 32 else 1  # ranges of long lines are found in two steps
        levels.append((low, outer, -(-ranges // outer)))
        low = high
    return levels


def _level(size: Column) -> Column:
    lows = [low for low, *_ in _levels()]
    table = F.array(*[F.lit(bisect.bisect(lows, n) - 1) for n in range(LONG)])
    return F.when(size < LONG, F.get(table, size.cast("int"))).otherwise(F.length(F.bin(size)) - LONG.bit_length() + lows.index(LONG))


def _per_level(numbers: list[int]) -> Column:
    return F.get(F.array(*[F.lit(x).cast("bigint") for x in numbers]), F.col("level"))


def _starts(first: Column, ranges: Column, width: Column) -> Column:
    return F.sequence(first, first + (ranges - 1) * width, width)


def _part(mixed: str, k: Column, start: Column, ranges: Column, width: Column) -> Column:
    """The words of range ``k`` in the sorted array of words and of where ranges start."""
    begin = F.array_position(mixed, start).cast("int")
    after = F.array_position(mixed, start + width).cast("int")
    end = F.when(k + 1 < ranges, after).otherwise(F.size(mixed) + 1)
    return F.slice(mixed, begin + 1, end - begin - 1)


def _keyed(lines: DataFrame) -> DataFrame:
    """Each line as a row of level 0, and rows (a, level, sig) with the hash of its words in each range of its levels.

    The words of an outer range are found by a lambda, those of inner ranges by generated code, which Java leaves
    uncompiled if one step has too much of it.
    """
    n = F.size("words")
    sized = lines.select("*", *_class_columns(), n.alias("n"), _bits().alias("bits"))
    larger = F.floor(F.col("n") * DEN / F.lit(NUM))
    levels = F.array_distinct(F.array(F.lit(0), _level(F.col("n")), _level(larger)))
    at = sized.select("*", F.explode(levels).alias("level"))
    whole = F.col("level") == 0
    widths = [min(NUMBERS // outer, NUMBERS - 1) for _, outer, _ in _levels()]
    lowest, width, ranges = F.lit(LOWEST).cast("bigint"), F.col("width"), F.col("ranges")
    outer = at.select(
        *[F.when(whole, F.col(c)).alias(c) for c in ("id", "print", "line_no", "b", "n", "bits")], "a", "level",
        F.when(whole, F.array().cast("array<bigint>")).otherwise(F.col("words")).alias("words"),
        _per_level(widths).alias("width"), _per_level([k for _, k, _ in _levels()]).alias("ranges"),
    ).withColumn("mixed", F.when(ranges > 1, F.sort_array(F.concat("words", _starts(lowest, ranges, width)))))
    parts = F.transform(_starts(lowest, ranges, width), lambda start, k: F.struct(start.alias("first"), _part("mixed", k, start, ranges, width).alias("words")))
    only = F.array(F.struct(lowest.alias("first"), F.col("words")))
    inner = outer.select(
        "id", "print", "line_no", "b", "n", "bits", "a", "level", F.when(ranges > 1, parts).otherwise(only).alias("parts"),
        _per_level([w // k for w, (*_, k) in zip(widths, _levels())]).alias("width"), _per_level([k for *_, k in _levels()]).alias("ranges"),
    ).select("*", F.posexplode("parts").alias("outer", "part")).drop("parts")
    starts = inner.withColumn("starts", _starts(F.col("part.first"), ranges, width))
    mixed = starts.withColumn("mixed", F.sort_array(F.concat("part.words", "starts"))).drop("part")
    each = mixed.select("*", F.posexplode("starts").alias("inner", "start")).drop("starts")
    sig = F.xxhash64("level", "outer", "inner", _part("mixed", F.col("inner"), F.col("start"), ranges, width))
    return each.select("id", "print", "line_no", "b", "n", "bits", "a", "level", sig.alias("sig"))


def _class_columns() -> list[Column]:
    return [F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b")]


def _pairs(x: DataFrame, y: DataFrame, on: list[str], meet: Column | None = None) -> DataFrame:
    """(a, first, other, other_first): classes of ``x`` and earlier ones of ``y`` that meet and may be similar by sizes and bitmaps."""
    y = y.select(*[F.col(c).alias(f"{c}_") for c in (*on, "a", "n", "bits", "first", *(["sigs"] if meet is not None else []))])
    met = [x[c] == y[f"{c}_"] for c in on]
    both = F.col("n") + F.col("n_")
    apart = both - 2 * F.ceil(both * NUM / F.lit(NUM + DEN))
    fit = (F.least("n", "n_") * DEN >= F.greatest("n", "n_") * NUM) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_"))) <= apart)
    return x.join(y, met).where((F.col("first_") < F.col("first")) & fit & (F.lit(True) if meet is None else meet)).select(
        "a", "first", F.col("a_").alias("other"), F.col("first_").alias("other_first")
    )


def _marked(rows: DataFrame, of: DataFrame, column: str, by: str) -> DataFrame:
    """The ``rows`` whose ``column`` may be a ``by`` of ``of``: all that are, and few others.

    A table of bits, 16 to 32 for each row of ``of``, is one row and goes to all tasks; beyond ``MOST_MARKS`` words of
    64 bits it lets more rows pass.
    """
    spark = rows.sparkSession
    size = min(MOST_MARKS, max(BUCKETS, 1 << (of.count() // 4).bit_length()))

    def place(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit(size - 1).cast("bigint")).cast("int")

    def bit(c: str) -> Column:
        return F.shiftrightunsigned(c, 58).cast("int")

    one = F.lit(1).cast("bigint")
    set_bits = of.select(place(by).alias("at"), F.call_function("shiftleft", one, bit(by)).alias("bits"))
    words = set_bits.union(spark.range(size).select(F.col("id").cast("int"), F.lit(0).cast("bigint"))).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda w: w["bits"]).alias("marks"))
    return rows.join(F.broadcast(table), F.getbit(F.get("marks", place(column)), bit(column)) == 1).drop("marks")


def later_matches(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a) of each pair (a, other) that is similar by its full sets."""
    one = sets.select("a", F.col("words").alias("w"))
    two = one.toDF("other", "w2")
    common = F.size(F.array_intersect("w", "w2"))
    return (
        pairs.select("a", "other").join(one, "a").join(two, "other")
        .withColumn("both", common)
        .where(F.col("both") * DEN >= NUM * (F.size("w") + F.size("w2") - F.col("both")))
        .select("a").distinct()
    )


def similar_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, print, line_no) of the lines to remove; ``print`` is a hash of the document's text.

    Lines come in order of id (null ids first), ``print`` and number.
    """
    key = F.struct("id", "print", "line_no")
    rows = settle_free(_keyed(_lines(docs, id_column, text_column)), "lines")
    whole = rows.where("level = 0")
    classes = settle_free(
        whole.groupBy("a", "b").agg(F.min(key).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.count("*").alias("lines")), "classes"
    )
    hashes = rows.where("level > 0").select("sig", "level", "a")
    shared = settle_free(
        hashes.groupBy("sig").agg(F.min("a").alias("low"), F.max("a").alias("high")).where("low <> high").select("sig"), "shared_hashes"
    )
    members = settle_free(
        _marked(hashes, shared, "sig", "sig").join(shared, "sig").distinct().join(classes.select("a", "first", "n", "bits"), "a"), "members"
    )
    hubs = settle_free(
        members.groupBy("sig").agg(F.count("*").alias("size"), F.min(F.struct("first", "a", "n", "bits")).alias("hub")).select("sig", "size", "hub.*"), "hubs"
    )

    def removed(found: DataFrame) -> DataFrame:
        found = settle_free(found.distinct(), "line_pairs")
        # one line stands for a class; it is read from its document again
        at = found.select("a", "first.*").union(found.select("other", "other_first.*")).distinct()
        spots = settle_free(at.withColumn("spot", F.xxhash64("id", "print", "line_no")), "spots")
        text = text_or_empty(text_column)
        held = docs.select(
            F.col(id_column).alias("did"), F.xxhash64(text).alias("dprint"), F.posexplode(F.split(text, "\n")).alias("at", "line")
        ).withColumn("key", F.xxhash64("did", "dprint", "at"))
        same = held["did"].eqNullSafe(spots["id"]) & (held["dprint"] == spots["print"]) & (held["at"] == spots["line_no"])
        texts = _marked(held, spots, "key", "spot").join(spots, same).select("a", "line").dropDuplicates(["a"])
        sets = settle_free(texts.select("a", _words(_plain(F.col("line"))).alias("words")), "line_sets")
        return settle_free(later_matches(found, sets), "later")

    some = members.join(hubs.where((F.col("size") > 2) & (F.col("size") <= HOT)).select("sig"), "sig", "left_semi")
    hot = members.join(hubs.where(F.col("size") > HOT).select("sig"), "sig", "left_semi")
    sets = hot.groupBy("a", "level", "first", "n", "bits").agg(F.sort_array(F.collect_set("sig")).alias("sigs"))
    one = sets.select("a", "first", "n", "bits", "sigs", F.posexplode("sigs").alias("at", "sig"))
    both = one.select("*", F.explode(F.slice("sigs", F.col("at") + 2, F.size("sigs"))).alias("sig2"))
    twice = settle_free(both.withColumn("two", F.xxhash64("sig", "sig2")).drop("at"), "hot_members")
    first_of_two = twice.groupBy("two").agg(F.min(F.struct("first", "a", "n", "bits")).alias("hub")).select("two", "hub.*")
    gone = removed(_pairs(members, hubs, ["sig"]).union(_pairs(twice, first_of_two, ["two"])))
    # classes with many hot hashes in common meet by the first two only
    meet = F.slice(F.array_intersect("sigs", "sigs_"), 1, 2) == F.array("sig", "sig2")
    more = removed(
        _pairs(some.join(gone, "a", "left_anti"), some, ["sig"]).union(_pairs(twice.join(gone, "a", "left_anti"), twice, ["two"], meet))
    )
    later = gone.union(more).withColumn("later", F.lit(True))
    fates = settle_free(
        classes.join(later, "a", "left").select("a", "b", "first", F.coalesce("later", F.lit(False)).alias("later"), "lines").where("lines > 1 OR later"), "fates"
    )
    return (
        _marked(whole.select("id", "print", "line_no", "a", "b"), fates, "a", "a").join(fates, ["a", "b"])
        .where((key != F.col("first")) | F.col("later")).select("id", "print", "line_no")
    )


def _by_document(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` as a struct ``doc`` with ``removed``: the numbers of the lines to remove, or null."""
    removed = similar_lines(docs, id_column, text_column).groupBy("id", "print").agg(
        F.array_sort(F.collect_set("line_no")).alias("removed")
    )
    held = docs.select(F.struct("*").alias("doc"), F.col(id_column).alias("did"), F.xxhash64(text_or_empty(text_column)).alias("dprint"))
    return held.join(removed, held["did"].eqNullSafe(removed["id"]) & (held["dprint"] == removed["print"]), "left")


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_removed``, ``removed`` (line numbers from 0, by comma).

    Lines without a word are never removed. Null and empty texts have one such line. Rows that repeat id
    and text are one document and share the result. An empty table gives an empty result.
    """
    similar = similar_lines(docs, id_column, text_column)
    removed = similar.groupBy("id", "print").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    text = text_or_empty(text_column)
    held = docs.select(
        F.col(id_column).alias("did"), F.xxhash64(text).alias("dprint"), F.size(F.split(text, "\n")).cast("bigint").alias("n_lines")
    )
    found = F.coalesce("removed", F.array().cast("array<int>"))
    return held.join(removed, held["did"].eqNullSafe(removed["id"]) & (held["dprint"] == removed["print"]), "left").select(
        F.col("did").alias(id_column),
        "n_lines",
        F.size(found).cast("bigint").alias("n_removed"),
        F.array_join(found.cast("array<string>"), ",").alias("removed"),
    )


def drop_similar_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the lines removed from the text; a null text stays null."""
    rows = _by_document(docs, id_column, text_column)
    old = F.col(f"doc.{text_column}")
    kept = F.filter(F.split(old, "\n"), lambda _, k: ~F.array_contains("removed", k))
    text = F.when(F.col("removed").isNull(), old).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[text.alias(c) if c == text_column else F.col(f"doc.{c}") for c in docs.columns])
