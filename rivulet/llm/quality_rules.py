"""Quality rules whose cutoffs carry a guarantee: risk-controlled thresholds.

Each rule rejects a text whose measure lies above a cutoff. Cutoffs are tried from lenient to strict on
labelled good texts. A cutoff is certified in a stratum if an exact binomial test refutes that it rejects
more than the allowed share of good texts there; testing stops at the first that fails, so the order of
cutoffs costs no confidence, and the error level is shared out over rules and strata (Bonferroni).
Among certified cutoffs the one that best tells bad texts from good is taken. With confidence ``1 -
delta``, no stratum loses more than ``alpha`` of its good texts to all rules together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import GAP, text_or_empty
from rivulet.llm.numeric import binomial_cdf
from rivulet.session import settle

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# rule -> cutoffs from lenient to strict; a text is rejected if its measure is above the cutoff
RULES: dict[str, list[float]] = {
    "symbol_share": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3],
    "repeat_share": [0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08],
    "mean_word": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0],
    "upper_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
}


def _covered(repeats: Column) -> Column:
    """Positions covered by windows that begin at ``repeats``, in order."""
    last = F.size(repeats) - 1
    return F.aggregate(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        F.lit(0).cast("bigint"),
        lambda total, k: total
        + F.when(k == last, WINDOW).otherwise(F.least(F.lit(WINDOW), F.get(repeats, k + 1) - F.get(repeats, k))),
    )


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper.

    Null text has none of anything. Whole texts are read, however long.
    """
    blank = F.array().cast("array<string>")
    text = text_or_empty(text_column)
    trimmed = F.btrim(text, F.lit(SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    windows = F.when(
        F.size("_hashes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.sort_array(
        F.transform(
            F.filter(
                F.transform(
                    "_order",
                    lambda s, k: F.struct(
                        s["i"].alias("i"),
                        (
                            F.coalesce(F.get("_order", k - 1)["h"] == s["h"], F.lit(False))
                            | F.coalesce(F.get("_order", k + 1)["h"] == s["h"], F.lit(False))
                        ).alias("again"),
                    ),
                ),
                lambda s: s["again"],
            ),
            lambda s: s["i"],
        )
    )
    has_repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return (
        docs.withColumn("_words", F.when(trimmed == "", blank).otherwise(F.split(trimmed, GAP)))
        .withColumn("_lines", lines)
        .withColumn("_hashes", hashes)
        .withColumn("_windows", windows)
        .withColumn("_order", F.when(has_repeats, order))
        .withColumn("_repeats", F.when(F.col("_order").isNotNull(), repeats))
        .withColumns(
            {
                "n_words": F.size("_words").cast("bigint"),
                "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
                "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
                "n_repeat_words": F.when(F.col("_repeats").isNull(), F.lit(0).cast("bigint")).otherwise(
                    _covered(F.col("_repeats"))
                ),
                "n_lines": F.size("_lines").cast("bigint"),
                "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint"),
            }
        )
        .drop("_words", "_lines", "_hashes", "_windows", "_order", "_repeats")
    )


def _shares() -> dict[str, Column]:
    def part(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return {
        "symbol_share": part("n_symbols", "word_chars"),
        "dup_line_share": part("n_dup_lines", "n_lines"),
        "repeat_share": part("n_repeat_words", "n_words"),
        "mean_word": part("word_chars", "n_words"),
        "upper_share": part("n_upper", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _first_failed(share: Column, cutoffs: list[float]) -> Column:
    """The place, from 1, of the most lenient cutoff that a text's measure lies above; 0 if of none."""
    failed = F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: share > c))
    return F.when(failed > 0, len(cutoffs) + 1 - failed).otherwise(0)


def certified_cutoffs(holdout: DataFrame, alpha: float, delta: float) -> DataFrame:
    """(stratum, rule, cutoff, n_good, good_rejected, bad_rejected) from measured rows with ``good``.

    Counts are taken per level (the first cutoff a text fails), so rows are reduced before they are
    shuffled, and summed over levels afterwards.
    """
    shares = _shares()
    levels = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                _first_failed(shares[rule], RULES[rule]).alias("level"),
            )
            for rule in RULES
        ]
    )
    good = F.col("good")
    counts = (
        holdout.select("stratum", good, F.explode(levels).alias("at"))
        .groupBy("stratum", "at.rule", "at.level")
        .agg(F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"))
    )
    grid = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(i + 1).alias("level"), F.lit(c).alias("cutoff"))
            for rule, cuts in RULES.items()
            for i, c in enumerate(cuts)
        ]
    )
    strata = counts.groupBy("stratum").agg(F.lit(1).alias("one"))
    steps = strata.select("stratum", F.inline(grid))
    rejected = Window.partitionBy("stratum", "rule").orderBy("level")
    whole = Window.partitionBy("stratum", "rule")
    same = [steps["stratum"].eqNullSafe(counts["stratum"]), steps["rule"] == counts["rule"]]
    # level 0 rows belong to no step but count as texts of the stratum
    passed = counts.where("level = 0").select(
        F.col("stratum").alias("s"), F.col("rule").alias("r"), F.col("n_good").alias("g0"), F.col("n_bad").alias("b0")
    )
    table = (
        steps.join(counts, [*same, steps["level"] == counts["level"]], "left")
        .select(
            steps["stratum"], steps["rule"], steps["level"], "cutoff",
            F.coalesce("n_good", F.lit(0)).alias("n_good"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
        )
        .withColumn("good_rejected", F.sum("n_good").over(rejected))
        .withColumn("bad_rejected", F.sum("n_bad").over(rejected))
        .withColumn("above_good", F.sum("n_good").over(whole))
        .withColumn("above_bad", F.sum("n_bad").over(whole))
    )
    table = (
        table.join(passed, [table["stratum"].eqNullSafe(passed["s"]), table["rule"] == passed["r"]], "left")
        .withColumn("good_total", F.col("above_good") + F.coalesce("g0", F.lit(0)))
        .withColumn("bad_total", F.col("above_bad") + F.coalesce("b0", F.lit(0)))
    )
    n_strata = strata.groupBy().agg(F.greatest(F.count("*"), F.lit(1)).alias("n_strata"))
    tests = F.col("n_strata") * len(RULES)
    risk = F.lit(alpha / len(RULES))
    ok = binomial_cdf(F.col("good_rejected"), F.col("good_total"), risk) <= F.lit(delta) / tests
    in_order = Window.partitionBy("stratum", "rule").orderBy("level")
    gain = F.col("bad_rejected") / F.greatest(F.col("bad_total"), F.lit(1)) - F.col("good_rejected") / F.greatest(
        F.col("good_total"), F.lit(1)
    )
    return (
        table.crossJoin(F.broadcast(n_strata))  # one row
        .withColumn("ok", ok)
        .withColumn("certified", F.min("ok").over(in_order))
        .where("certified AND bad_rejected > 0")
        .withColumn("gain", gain)
        .groupBy("stratum", "rule")
        .agg(
            F.max_by(
                F.struct("cutoff", F.col("good_total").alias("n_good"), "good_rejected", "bad_rejected"),
                F.struct("gain", -F.col("level")),
            ).alias("best")
        )
        .select("stratum", "rule", "best.*")
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    alpha: float = 0.02,
    delta: float = 0.05,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
    label_column: str = "quality",
) -> DataFrame:
    """One row per document: id, measures, ``base_failed``, ``kept``, ``failed_rules``.

    Null or empty text has no word and fails the base rule. A null stratum is a stratum of its own. A
    stratum with too few labelled good texts gets no cutoff and loses nothing beyond the base rules; the
    same holds without any labels. Labels that are null are left out; a document labelled more than once
    counts as often.
    """
    measured = settle(
        measures(
            docs.select(
                F.col(id_column).alias("id"), F.col(stratum_column).alias("stratum"), F.col(text_column).alias("text")
            )
        ).drop("text"),
        "measures",
    ).withColumn("base_failed", base_failed())
    marks = labels.select(F.col(id_column).alias("id"), (F.col(label_column) == 1).alias("good")).dropna()
    holdout = measured.where("NOT base_failed").join(marks, "id")
    chosen = certified_cutoffs(holdout, alpha, delta)
    cutoffs = settle(
        chosen.groupBy("stratum").agg(
            *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
        ),
        "cutoffs",
    )
    failed = F.filter(
        F.array(*[F.when(share > F.col(f"cut_{rule}"), F.lit(rule)) for rule, share in _shares().items()]),
        lambda r: r.isNotNull(),
    )
    rows = measured.join(cutoffs.withColumnRenamed("stratum", "s"), F.col("stratum").eqNullSafe(F.col("s")), "left")
    return rows.withColumn("failed_rules", failed).select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )
