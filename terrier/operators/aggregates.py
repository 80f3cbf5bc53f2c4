"""Grouped aggregates shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.numeric import mean


def count_rows(name: str, of: str | None = None) -> Column:
    """Number of rows; with ``of``, of rows where that column is known."""
    return F.count(F.lit(1) if of is None else of).alias(name)


def count_where(predicate: Column, name: str) -> Column:
    return F.count_if(predicate).alias(name)


def count_by_value(column: str, names: dict[str, str]) -> list[Column]:
    """One conditional count per value: ``{value: output column}``."""
    return [F.count_if(F.col(column) == value).alias(name) for value, name in names.items()]


def constant_of(column: str, name: str | None = None) -> Column:
    """Value of a column that is the same in all rows of a group, NULLs aside."""
    return F.max(column).alias(name or column)


def constants(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key with columns that are the same in all its rows, NULLs aside.

    Text cannot be aggregated by hash, so ``max`` over all rows would sort them.
    Distinct rows can, and leave about one row per key for the ``max``.
    """
    distinct = df.select(key, *columns).distinct()
    return distinct.groupBy(key).agg(*[constant_of(c) for c in columns])


def latest_of(column: str, order: str, name: str | None = None) -> Column:
    """Value in the last row (by ``order``) that has one."""
    known = F.when(F.col(column).isNotNull(), F.col(order))
    return F.max_by(F.col(column), known).alias(name or column)


def coarsen(
    df: DataFrame, keys: list[str], flows: list[str], levels: dict[str, tuple[str, int]],
    count_name: str | None = None,
) -> DataFrame:
    """Coarser time grain: flows are summed, levels averaged.

    ``levels`` maps a source column to its output name and digits.
    """
    parts = [F.sum(c).alias(c) for c in flows]
    parts += [mean(c, digits).alias(name) for c, (name, digits) in levels.items()]
    if count_name:
        parts.append(count_rows(count_name))
    return df.groupBy(*keys).agg(*parts)

