"""The registered query of each operator, with its SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import table
from rivulet.llm.conversation_repair import digests, repair
from rivulet.llm.conversation_repair_sql import ORACLE as CONVERSATION_REPAIR_SQL
from rivulet.llm.exact_dedup import exact_dedup
from rivulet.llm.language import identify_language
from rivulet.llm.license_scan import scan_licenses
from rivulet.llm.line_dedup import line_dedup
from rivulet.llm.mixing import mix
from rivulet.llm.near_dedup import near_dedup
from rivulet.llm.packing import WordEncoder, pack
from rivulet.llm.periodic_runs import Words, periodic_runs
from rivulet.llm.quality_classifier import score_quality
from rivulet.llm.quality_rules import quality_rules
from rivulet.llm.quality_rules_sql import ORACLE as QUALITY_RULES_SQL
from rivulet.llm.simhash import simhash_dedup
from rivulet.llm.toxicity import score_toxicity
from rivulet.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


@query(
    "op4_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


@cache
def word_bpe() -> WordEncoder:
    import public_tokenizers

    return WordEncoder(public_tokenizers.path("word_bpe_49k.json"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_bpe)


@query("op8_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = F.transform("copies", lambda c: c["shard"])
    return mix(table(spark, sf_dir, "documents")).withColumn("shards", shards).drop("copies")


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op10_quality_rules", QUALITY_RULES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(doc_id: int | None, words: Words) -> Words:
    """Repeat a stretch to the end of about one text in ten, chosen by id, so that the table holds runs."""
    h, n = 1 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each text, and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("fewer"))))
    found = found.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.before"), -F.col("best.fewer")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.fewer").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_planted_runs))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults in a quarter of their turns, chosen by conversation and turn."""

    def shown(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


@query("op12_conversation_repair", CONVERSATION_REPAIR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    report, turns = repair(settle(damaged(given), "damaged"))
    of_all = given.select("conv_id").distinct()
    hashes = digests(turns).select(F.col("conv_id").alias("c"), "repaired_sha256")
    report = report.withColumnRenamed("conv_id", "r")
    found = of_all.join(report, F.col("conv_id").eqNullSafe(F.col("r")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))
