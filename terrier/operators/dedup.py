"""Latest-version rows of an append-only table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame, keys: list[str], version: str, tie_breakers: list[str | Column]
) -> DataFrame:
    """One row per key: the greatest version, ties settled by ``tie_breakers``.

    The tie-breakers make the choice repeatable and are not optional. Spark
    turns ``row_number() == 1`` into a group limit that runs before the shuffle
    too, so each task sends at most one row per key and a key with very many
    copies does not pile up in one task.
    """
    if not tie_breakers:
        raise ValueError("dedup_latest needs tie-breakers to be deterministic")
    ties = [c if isinstance(c, Column) else F.desc_nulls_last(c) for c in tie_breakers]
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(version), *ties)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
