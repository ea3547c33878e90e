from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
