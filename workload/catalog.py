"""The registered queries and their SQL, filled by the modules imported at the bottom."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.inputs import Inputs, plain, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(inputs) -> DataFrame`` with the SQL that must give the same rows."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive(fn(Inputs(spark, sf_dir)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = plain(with_fixtures(oracle, extra))
        return fn

    return register


def naive(df: DataFrame) -> DataFrame:
    """Instants as naive UTC times, which is how the files and the SQL side hold them."""
    return df.select(
        *[
            df[f.name].cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else df[f.name]
            for f in df.schema.fields
        ]
    )


def load() -> None:
    from workload import (  # noqa: F401
        changes, control_plane, cycles, dimension, landing_tree, payloads, reconcile, roads, staging,
    )
