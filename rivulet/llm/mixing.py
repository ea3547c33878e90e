"""Mixing sources to target weights by a splitting tree of exact block quotas.

A source's words are dealt into blocks by the hash of the document; blocks are the unit of the draw. Each
source gets a target in words. Whole passes over it are drawn first, then blocks in a permuted order up
to the target; the block that crosses it is drawn in part, document by document, the last one in part, so
that the words taken meet the target. The number of draws per source is then split over output shards by
a binary tree: a node's draws go to its two children in equal halves, how many of each source being a
multivariate hypergeometric draw (one conditional draw per source). That is the law of a perfect shuffle of
all draws, but only counts pass through the tree. A shard takes the next ranges of each source's permuted
draws, disjoint from all others, and shuffles its documents locally.

All randomness is a hash of ``seed``, so reruns agree. Sources are a list that an array can hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import GAP, text_or_empty, unit
from rivulet.llm.numeric import hypergeometric, let
from rivulet.session import settle

WEIGHTS = (3, 1, 2)
SPACES = " \t\n\x0b\f\r"
LEVELS = 6  # levels of the tree that are planned together


def n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, place, source_size, target) from (source, source_size), one row per source.

    Targets are proportional to the weights and stop at ``cap`` times the source's size; the excess goes
    to the others by weight. In order of size per weight the capped sources come first, so one pass with
    running sums finds the level (words per unit of weight) at which the rest share what is left.
    """
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))))
    placed = placed.withColumns({"weight": weight, "most": F.lit(cap) * F.col("source_size")})
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), "place")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(budget) * F.sum("source_size").over(everything) - (F.sum("most").over(by_fill) - F.col("most"))) / (
        F.sum("weight").over(everything) - (F.sum("weight").over(by_fill) - F.col("weight"))
    )
    leveled = placed.withColumns({"level": level, "fill": F.row_number().over(by_fill)})
    reached = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("fill", "level"))
    share = F.min(reached).over(everything)["level"]  # of the first source that is not capped
    target = F.least(F.col("most"), F.coalesce(share * F.col("weight"), F.col("most")))
    return leveled.withColumn("target", target).select("source", "place", "source_size", "target")


def split_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(shard, place, low, high): the ranges of each source's draws that a shard gets.

    ``quotas`` is (place, n_draws), a row per source.
    """
    nodes = quotas.groupBy().agg(
        F.lit(0).cast("bigint").alias("node"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "n_draws"))), lambda s: s["n_draws"]).alias("counts"),
    )

    def left_half(level: int) -> Column:
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
        begin = F.struct(
            total.alias("population"),
            F.floor(total / 2).cast("bigint").alias("draws"),
            F.array().cast("array<bigint>").alias("left"),
        )

        def draw(a: Column, c: Column) -> Column:
            u = unit(F.lit(seed), F.lit(level), F.col("node"), F.size(a["left"]))
            return let(
                hypergeometric(a["population"], c, a["draws"], u),
                lambda x: F.struct(
                    (a["population"] - c).alias("population"),
                    (a["draws"] - x).alias("draws"),
                    F.concat(a["left"], F.array(x)).alias("left"),
                ),
            )

        return F.aggregate("counts", begin, draw, lambda a: a["left"])

    for level in range(depth):
        if level % LEVELS == LEVELS - 1:  # the plan is cut, and the nodes so far are spread over tasks
            nodes = settle(nodes.repartition("node"), "split_nodes")
        halves = nodes.withColumn("left", left_half(level))
        right = F.transform("counts", lambda c, i: c - F.get("left", i))
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("counts")),
        )
        nodes = halves.select(F.inline(both))
    leaves = nodes.select(F.col("node").alias("shard"), F.posexplode("counts").alias("at", "n"))
    high = F.sum("n").over(Window.partitionBy("at").orderBy("shard"))
    return leaves.select(
        "shard", (F.col("at") + 1).alias("place"), (high - F.col("n")).alias("low"), high.alias("high")
    )


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str, carried: list[str]) -> DataFrame:
    text = text_or_empty(text_column)
    return docs.select(
        *carried,
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        F.xxhash64(text).alias("print"),
        n_words(text).alias("size"),
    )


def _draws(sized: DataFrame, weights, budget, cap, seed, block_words, shard_blocks) -> tuple[DataFrame, DataFrame]:
    """``sized`` rows with their block, and one row per block with what is drawn of it."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(by_source, weights, budget, cap)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    targets = settle(
        targets.withColumn("passes", passes.cast("bigint"))
        .withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("bigint"))
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("bigint")),
        "targets",
    ).withColumnRenamed("source", "s")
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["s"])).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("n_blocks"))
    )
    source = ["place", "source_size", "target", "passes", "rest"]
    blocks = rows.groupBy(*source, "block").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 1), "place", "block"), "block")
    start = F.sum("words").over(permuted) - F.col("words")
    drawn = F.least(F.greatest(F.col("rest") - start, F.lit(0)), F.col("words"))
    blocks = settle(blocks.withColumn("drawn", drawn), "blocks")

    # a draw is a block in one pass; empty blocks and parts are not drawn
    times = F.when(F.col("words") > 0, F.col("passes") + F.when(F.col("drawn") > 0, 1).otherwise(0)).otherwise(0)
    draws = (
        blocks.withColumn("times", times).where("times > 0")
        .select("place", "block", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    )
    n = draws.count()
    depth = max(0, math.ceil(math.log2(max(1, n / shard_blocks))))
    order = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 2), "place", "block", "copy"), "block", "copy")
    ranked = draws.withColumn("rank", F.row_number().over(order) - 1)
    ranges = split_tree(draws.groupBy("place").agg(F.count("*").alias("n_draws")), depth, seed + 3)
    # split_tree numbers the sources that are drawn; give each its number
    numbered = draws.select("place").distinct().withColumn("at", F.row_number().over(Window.orderBy("place")))
    dealt = (
        ranges.where("high > low").withColumnRenamed("place", "at").join(numbered, "at")
        .select("place", "shard", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("rank"))
    )
    shards = (
        ranked.join(dealt, ["place", "rank"])
        .groupBy("place", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("copies"))
    )
    return rows.drop(*[c for c in source if c != "place"]), blocks.join(shards, ["place", "block"], "left")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights=WEIGHTS,
    budget: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    block_words: int = 1 << 16,
    shard_blocks: int = 64,
    row_column: str | None = None,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies; ``row_column`` if one is named.

    ``copies`` lists what the mix takes of the document: (copy, shard, words), fewer words than ``size``
    for at most one document per source. A null source is one of its own, the last. Null and empty texts
    have size 0 and are not taken. Rows that repeat an id are documents of their own. An empty
    table gives an empty result.
    """
    carried = [row_column] if row_column else []
    sized = settle(_sized(docs, id_column, text_column, source_column, carried), "sizes")
    rows, blocks = _draws(sized, weights, budget, cap, seed, block_words, shard_blocks)
    joined = rows.drop("s", "n_blocks").join(blocks, ["place", "block"])
    crossing = (F.col("drawn") > 0) & (F.col("drawn") < F.col("words")) & (F.col("size") > 0)
    within = Window.partitionBy("place", "block").orderBy(
        F.xxhash64(F.lit(seed + 4), "id"), "id", "print", "size"
    )
    before = F.sum("size").over(within) - F.col("size")
    part = joined.where(crossing).withColumn(
        "last", F.least(F.greatest(F.col("drawn") - before, F.lit(0)), F.col("size"))
    )
    whole = joined.where(~crossing).withColumn("last", F.when(F.col("drawn") > 0, F.col("size")).otherwise(0))
    copies = F.filter(
        F.transform(
            F.coalesce("copies", F.array().cast("array<struct<copy:int,shard:bigint>>")),
            lambda c: F.struct(
                c["copy"].alias("copy"),
                c["shard"].alias("shard"),
                F.when(c["copy"] <= F.col("passes"), F.col("size")).otherwise(F.col("last")).cast("bigint").alias("words"),
            ),
        ),
        lambda c: c["words"] > 0,
    )
    return (
        whole.unionByName(part).withColumn("copies", copies)
        .select(
            *carried, F.col("id").alias(id_column), "size", "source_size", "target",
            F.aggregate("copies", F.lit(0).cast("bigint"), lambda a, c: a + c["words"]).alias("taken"), "copies",
        )
    )


def first_words(text: Column, k: Column) -> Column:
    """The text up to the end of its ``k``-th word, white space kept as it is."""
    edges = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    return F.array_join(F.slice(F.split(text, edges), 1, k.cast("int")), "")


def mixed_rows(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: int = 17, **options
) -> DataFrame:
    """The rows of the mix, shard by shard and shuffled in each: ``docs`` columns, ``mix_shard``, ``mix_order``.

    A document taken twice comes twice; one that is taken in part comes with its first words. Rows with
    null text or without words are not part of a mix. If ``docs`` has columns of the two names, the new ones get
    underscores behind theirs.
    """
    shard, order = (_free(c, docs.columns) for c in ("mix_shard", "mix_order"))
    held = settle(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mix_docs")
    narrow = held.select("row", *[F.col(f"doc.{c}").alias(a) for c, a in ((id_column, "id"), (text_column, "text"), (source_column, "source"))])
    taken = mix(narrow, "id", "text", seed=seed, row_column="row", **options).where("taken > 0")
    rows = held.join(taken.select("row", F.col("size"), F.explode("copies").alias("copy")), "row")
    text, words = F.col(f"doc.{text_column}"), F.col("copy.words")
    cut = F.when(words < F.col("size"), first_words(text, words)).otherwise(text)
    return (
        rows.select(
            *[cut.alias(c) if c == text_column else F.col(f"doc.{c}") for c in docs.columns],
            F.col("copy.shard").alias(shard),
            F.xxhash64(F.lit(seed + 5), f"doc.{id_column}", "copy.copy").alias(order),
        )
        .repartition(shard).sortWithinPartitions(shard, order)
    )


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name
