"""Language identification by words first, and by shorter and shorter character n-grams for other words.

Training counts words per language over all labelled texts, and from the word counts the character n-grams
of ``^word$`` for n = 1 to 5. The model keeps, per language, the ``MAX_WORDS`` most frequent words and the
``MAX_GRAMS`` most frequent n-grams of each n: that bounds what is broadcast, whatever the corpus. A known
word scores its log frequency in each language. An unknown word scores the mean log frequency of its
n-grams for the largest n of which any is known. A text's scores are the sums over its words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, fold, slices
from rivulet.session import settle

LETTERS = regex.compile(r"\p{L}+")
LONGEST = 5
MAX_WORDS = 50_000  # per language
MAX_GRAMS = 10_000  # per language and length
MAX_LANGUAGES = 500  # labels with the most texts
FLUSH = 300_000  # different words a task counts before it passes them on
CACHED_TOKENS = 800_000
UNDETERMINED = "und"


def _count_words(batches: Iterator[pa.RecordBatch]):
    """Partial counts (lang, word, n) of a task."""
    counts: dict[str, Counter] = {}

    def flush():
        rows = [(g, w, n) for g, c in counts.items() for w, n in c.items()]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*rows)] if rows else [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64())],
            names=["lang", "word", "n"],
        )

    for batch in batches:
        for part in slices(batch):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            if sum(map(len, counts.values())) > FLUSH:
                yield flush()
    yield flush()


def grams(word: str, n: int) -> list[str]:
    framed = f"^{word}$"
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


def _top(counts: DataFrame, key: str, most: int, *within: str) -> DataFrame:
    order = Window.partitionBy("lang", *within).orderBy(F.desc("n"), key)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).drop("rank")


def train(labelled: DataFrame) -> dict:
    """The model from (lang, text): languages, log frequencies of words and of n-grams by length."""
    counted = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    main = [
        r["lang"]
        for r in counted.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    ]
    words = settle(
        counted.mapInArrow(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "word_counts",
    )
    framed = F.concat(F.lit("^"), "word", F.lit("$"))
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(framed))),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.length(framed) - size + 1),
                lambda i: F.struct(size.alias("size"), F.substring(framed, i, size).alias("gram")),
            ),
        )
    )
    short = (
        words.select("lang", "n", F.inline(pieces)).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    top_words = _top(words, "word", MAX_WORDS).collect()
    top_grams = _top(short, "gram", MAX_GRAMS, "size").collect()
    languages = sorted(main)
    place = {g: i for i, g in enumerate(languages)}

    def table(rows, key: str, total: dict[str, int]) -> dict[str, list[float]]:
        found: dict[str, list[float]] = {}
        least = [math.log(0.5 / (total.get(g, 0) + 1)) for g in languages]
        for r in rows:
            if r["lang"] in place:
                logs = found.setdefault(r[key], list(least))
                logs[place[r["lang"]]] = math.log(r["n"] / total[r["lang"]])
        return found

    by_size = {}
    for size in range(1, LONGEST + 1):
        rows = [r for r in top_grams if r["size"] == size]
        total = Counter()
        for r in rows:
            total[r["lang"]] += r["n"]
        by_size[size] = table(rows, "gram", total)
    return {"languages": languages, "words": table(top_words, "word", totals), "grams": by_size}


class Scorer:
    """Sums of log frequencies per language for texts given as bytes."""

    def __init__(self, model: dict):
        self.model = model
        self.width = len(model["languages"])
        self._clear()

    def _clear(self):
        self.place: dict[bytes, int] = {}
        self.logs = np.zeros((1024, self.width + 1))  # the last column counts words

    def word(self, word: str) -> list[float] | None:
        known = self.model["words"].get(word)
        if known is not None:
            return known
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            table = self.model["grams"][n]
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return [sum(logs) / len(found) for logs in zip(*found)]
        return None

    def _token(self, token: bytes) -> int:
        at = self.place[token] = len(self.place)
        if at >= len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        row = np.zeros(self.width + 1)
        for word in LETTERS.findall(token.decode().lower()):
            row[-1] += 1
            logs = self.word(word)
            if logs is not None:
                row[:-1] += logs
        self.logs[at] = row
        return at

    def __call__(self, text: bytes) -> tuple[str, float]:
        """The likeliest language and its share of the likelihood; ``und`` without a letter."""
        if len(self.place) > CACHED_TOKENS:
            self._clear()
        tokens = text.split()
        at = list(map(self.place.get, tokens))
        if None in at:
            get = self.place.get
            at = [self._token(t) if (i := get(t)) is None else i for t in tokens]
        total = self.logs[at].sum(axis=0)
        if total[-1] == 0 or not self.width:
            return UNDETERMINED, 0.0
        best = int(total[:-1].argmax())
        return self.model["languages"][best], float(1 / np.exp(np.minimum(total[:-1] - total[best], 0)).sum())


def _predict(batches: Iterator[pa.RecordBatch], model):
    score = Scorer(model.value)
    for batch in batches:
        for part in slices(batch):
            found = [score(t) for t in binaries(part, "text")]
            languages, scores = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("held_out"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "held_out", "lang_pred", "score"],
            )


def identify_language(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    folds: int = 4, held_fold: int = 2,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    Learns from texts with a language outside the held fold. Null texts and texts without a letter are
    ``und`` with score 0, as is everything if nothing can be learned from. A null id is in fold 0. Of
    equal scores the first language in order is taken.
    """
    held = fold(id_column, folds) == held_fold
    rows = docs.select(
        F.col(id_column).alias("id"), held.alias("held_out"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    model = docs.sparkSession.sparkContext.broadcast(train(rows.where("NOT held_out")))
    schema = f"id {docs.schema[id_column].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return (
        rows.select("id", "held_out", "text").mapInArrow(partial(_predict, model=model), schema)
        .withColumnRenamed("id", id_column)
    )
