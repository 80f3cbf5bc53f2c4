"""Row filters and projections."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the wanted columns that are there; drop the unknown ones."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def rename_to_schema(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source names to target names; whatever has no target name is dropped."""
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items() if a in df.columns])


def exclude_columns(df: DataFrame, excluded: list[str]) -> list[str]:
    """Feature names: all columns but the excluded ones."""
    return [c for c in df.columns if c not in set(excluded)]


def require_key(df: DataFrame, column: str) -> DataFrame:
    """Drop the rows whose key is empty."""
    return df.where(F.col(column) != "")


def drop_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def positive_filter(df: DataFrame, columns: list[str], required: list[str] = ()) -> DataFrame:
    """Keep the rows where every column is above 0 and the required ones are known."""
    for c in columns:
        df = df.where(F.col(c) > 0)
    for c in required:
        df = df.where(F.col(c).isNotNull())
    return df


def open_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Keep ``low < column < high``."""
    return df.where((F.col(column) > low) & (F.col(column) < high))


def category_filter(df: DataFrame, column: str, value: str) -> DataFrame:
    """Keep one category, such as the line that totals the others."""
    return df.where(F.col(column) == value)


def valid_period(
    df: DataFrame, year: str = "annee", month: str = "mois", after: int = 2000
) -> DataFrame:
    """Months 1 to 12 of years after ``after``; the rest is corrupt."""
    return df.where(F.col(month).between(1, 12) & (F.col(year) > after))


def null_share(columns: list[str]) -> Column:
    """Share of the columns that are NULL in a row."""
    missing = reduce(add, [F.col(c).isNull().cast("int") for c in columns])
    return missing / F.lit(float(len(columns)))


def max_null_share(df: DataFrame, columns: list[str], limit: float = 0.5) -> DataFrame:
    """Keep the rows where less than ``limit`` of the columns are NULL."""
    return df.where(null_share(columns) < limit)


def min_group_size(df: DataFrame, count_column: str, minimum: int) -> DataFrame:
    return df.where(F.col(count_column) >= minimum)


def union_pages(frames: list[DataFrame]) -> DataFrame:
    """Append pages by column name; a column missing in one page is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted unique values."""
    return df.select(column).distinct().orderBy(column)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order: per-task top-k, then one merge of those."""
    return df.orderBy(*order).limit(k)
