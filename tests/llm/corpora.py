"""Small corpora for the operators' tests, with the awkward rows that every operator must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns whose names the operators use inside
CLASHES = ["id", "row", "run", "set", "label", "kept", "size", "copy", "doc", "gone", "sha", "words", "part", "mix_shard", "mix_order"]


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, rows, clash: bool = False):
    """``rows``: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"{c}!").alias(c) for c in CLASHES])
    return df


def awkward() -> list[tuple]:
    """Nulls in each column, empty and blank texts, a very long one, repeated rows and ids, odd signs."""
    rng = random.Random(7)
    long_text = " ".join(sentence(rng, 30_000))
    return [
        (None, "text without an id at all here", "en", "s0"), (None, None, None, None),
        (1, None, "en", "s0"), (2, "", "en", "s0"), (3, "  \n\t ", "en", "s1"), (4, "éß 你好 \U0001f600", None, "s1"),
        (5, long_text, "de", None), (6, "same words here in both", "en", "s1"), (6, "same words here in both", "en", "s1"),
        (7, "one id two texts a b c", "en", "s2"), (7, "another text for seven", "en", "s2"), (8, "!!! ### 123", "en", "s2"),
        (9, "a\x00b\x0bc\x0cd", "en", "s0"), (10, "same words here in both", "en", "s0"), (11, "x" * 100_000, "en", "s0"),
    ]
