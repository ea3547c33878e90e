"""A corpus made ready for training: quality, exact and near duplicates, the mix of sources, packing.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read back as the next
one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.common import table
from rivulet.llm.exact_dedup import drop_copies
from rivulet.llm.mixing import mixed_rows
from rivulet.llm.near_dedup import drop_near_copies
from rivulet.llm.packing import pack
from rivulet.llm.quality_classifier import keep_good
from rivulet.llm.queries import word_bpe
from rivulet.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, shard by shard; documents of scarce sources come twice."""
    return mixed_rows(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return pack(docs, word_bpe)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixture", mixture), ("packing", packing)]

# Training, hashed draws and tokens are beyond SQL; tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
