"""High-water marks: what was loaded last, and which rows come after it."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.functions.numeric import period_key
from terrier.functions.text import quarter_label
from terrier.sources.schemas import TABLES, declare_table

STATE = "_ingestion_watermarks"


def ensure_state(spark: SparkSession, name: str = STATE) -> str:
    return declare_table(spark, TABLES[STATE], name)


def current_marks(state: DataFrame) -> DataFrame:
    """Newest value per source; equal times are settled by the greater value.

    Rows without a value (commits of loads that have no mark) move nothing.
    """
    newest = F.max(F.struct("updated_at", "last_value")).alias("_m")
    return state.where(F.col("last_value").isNotNull()).groupBy("source").agg(newest).select(
        "source", F.col("_m.last_value").alias("last_value"),
        F.col("_m.updated_at").alias("updated_at"),
    )


def get_watermark(spark: SparkSession, source: str, name: str = STATE) -> str | None:
    """Mark of a source, None before its first load."""
    row = current_marks(spark.table(name).where(F.col("source") == source)).first()
    return row["last_value"] if row else None


def set_watermark(spark: SparkSession, source: str, value: str, name: str = STATE) -> None:
    """Append a mark. Call it after the rows are written, never before."""
    row = spark.range(1).select(
        F.lit(source).alias("source"), F.lit(value).alias("last_value"),
        F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("updated_at"),
    )
    row.write.mode("append").insertInto(name)


# --- slices: rows after a mark ---------------------------------------------------

def years_to_load(mark: str | int | None, target: int, first: int = 2021) -> list[int]:
    """Years after the mark up to ``target``; from ``first`` without a mark."""
    start = first if mark in (None, "") else int(mark) + 1
    return list(range(start, target + 1))


def since_year(df: DataFrame, column: str, mark: int, target: int) -> DataFrame:
    """Rows of the years to load; on a partition column this prunes files."""
    return df.where((F.col(column) > mark) & (F.col(column) <= target))


def since_next_day(
    df: DataFrame, column: str, mark: str | None, default: str = "2021-01-01"
) -> DataFrame:
    """Rows from the day after the mark on, or from ``default``."""
    start = F.lit(default).cast("date") if mark is None else F.date_add(F.lit(mark).cast("date"), 1)
    return df.where(F.col(column) >= start)


def year_month_mark(mark: str | None) -> tuple[int, int] | None:
    """'2024-03' gives (2024, 3); anything else means a full load."""
    found = re.match(r"^(\d{4}).(\d{2})", mark or "")
    return (int(found[1]), int(found[2])) if found else None


def since_year_month(df: DataFrame, mark: tuple[int, int] | None) -> DataFrame:
    """Rows whose (year, month) comes after the mark."""
    if mark is None:
        return df
    year, month = mark
    return df.where(
        (F.col("annee") > year) | ((F.col("annee") == year) & (F.col("mois") > month))
    )


def since_quarter(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows whose 'YYYY-TQ' comes after the mark; text order is time order."""
    return df if not mark else df.where(F.col(column) > mark)


def since_month(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows after the first day of the mark's month."""
    return df if not mark else df.where(F.col(column) > F.to_date(F.lit(mark), "yyyy-MM"))


def new_vintages(df: DataFrame, mark: str | None, column: str = "millesime") -> DataFrame:
    """Vintages after the mark, in text order."""
    return df if not mark else df.where(F.col(column) > mark)


def same_vintage(last: str | None, latest: str) -> bool:
    """True when the newest vintage was loaded already."""
    return bool(last) and last == latest


# --- the next mark ------------------------------------------------------------------

def mark_of(kind: str, column: str | None = None) -> Column:
    """Aggregate that gives the mark of the rows it sees, NULL when there is none.

    ``kind``: 'date', 'month' or 'value' of a column, 'year_month' (annee, mois),
    'quarter' (annee, trimestre).
    """
    if kind == "date":
        return F.date_format(F.max(column), "yyyy-MM-dd")
    if kind == "month":
        return F.date_format(F.max(column), "yyyy-MM")
    if kind == "value":
        return F.max(F.col(column).cast("string"))
    if kind == "year_month":
        known = F.col("annee").isNotNull() & F.col("mois").isNotNull()
        last = F.max(F.when(known, period_key("annee", "mois")))
        text = F.format_string("%d-%02d", F.floor(last / 100).cast("int"), last % 100)
        return F.when(last.isNotNull(), text)
    if kind == "quarter":
        known = F.col("annee").isNotNull() & F.col("trimestre").isNotNull()
        return F.max(F.when(known, quarter_label("annee", "trimestre")))
    raise ValueError(f"unknown kind of mark: {kind}")


def max_mark(df: DataFrame, kind: str, column: str | None = None) -> DataFrame:
    """One row ``last_value``: the mark after loading ``df``, in one aggregate."""
    return df.agg(mark_of(kind, column).alias("last_value"))
