"""Lags, rolling means, gap filling and sequences over a series per entity.

These run on panels: one row per entity and month, so a partition holds at most
one row for each month of the calendar, however many raw rows it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from terrier.functions.numeric import rate, settle


def series(entity: str, *order: str) -> WindowSpec:
    """One partition and order, shared by all expressions of a panel."""
    return Window.partitionBy(entity).orderBy(*order)


def lags(column: str, w: WindowSpec, names: dict[int, str]) -> dict[str, Column]:
    """Values ``k`` present rows earlier (not ``k`` calendar months)."""
    return {name: F.lag(column, k).over(w) for k, name in names.items()}


def rolling_means(
    column: str, w: WindowSpec, names: dict[int, str], digits: int = 2
) -> dict[str, Column]:
    """Mean of the row and the ``k - 1`` before it; fewer at the start."""
    return {
        name: settle(F.avg(column).over(w.rowsBetween(1 - k, 0)), digits)
        for k, name in names.items()
    }


def pct_changes(
    column: str, w: WindowSpec, names: dict[int, str], digits: int = 2
) -> dict[str, Column]:
    """Change in percent against ``k`` present rows earlier; NULL on a zero base."""
    return {
        name: rate(F.col(column) - F.lag(column, k).over(w), F.lag(column, k).over(w), digits, 100.0)
        for k, name in names.items()
    }


def calendar_lags(column: str, date: str, entity: str, names: dict[int, str]) -> dict[str, Column]:
    """Values exactly ``k`` calendar months earlier, NULL if that month is absent."""
    index = F.year(date) * 12 + F.month(date)
    w = Window.partitionBy(entity).orderBy(index)
    return {name: F.max(column).over(w.rangeBetween(-k, -k)) for k, name in names.items()}


def fill_series(
    df: DataFrame, entity: str, order: list[str], columns: list[str], forward_only: bool = False
) -> DataFrame:
    """Last known value, else the next known one, else 0.

    After the forward pass only leading gaps are left, and the next known value
    of a leading gap is the first known one of the entity, so no backward frame
    is needed. ``forward_only`` skips that step, which looks into the future.
    """
    w = series(entity, *order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {}
    for c in columns:
        parts = [F.last(c, ignorenulls=True).over(so_far)]
        if not forward_only:
            parts.append(F.first(c, ignorenulls=True).over(whole))
        filled[c] = F.coalesce(*parts, F.lit(0.0))
    return df.withColumns(filled)


def sliding_sequences(
    df: DataFrame, entity: str, order: list[str], features: list[str] | str, ahead: dict[str, str],
    lookback: int = 12, horizon: int = 3, period: str | None = None,
) -> DataFrame:
    """Windows of ``lookback`` rows x features with what comes in the next ``horizon`` rows.

    ``features`` are columns, or one array column. ``x`` holds the rows before the current one. ``ahead`` maps an output array
    to the column it takes from the current row on. Only complete windows are
    kept. Inputs must be filled, as collected lists skip NULLs. ``period`` adds
    the first period of ``x``, the last one ahead and all periods ahead.
    """
    w = series(entity, *order)
    before = w.rowsBetween(-lookback, -1)

    def upcoming(column: str) -> Column:
        return F.array(*[F.lead(column, h).over(w) if h else F.col(column) for h in range(horizon)])

    if isinstance(features, str):
        vector = F.col(features)
    else:
        vector = F.array(*[F.col(c).cast("double") for c in features])
    columns = {
        "x": F.collect_list(vector).over(before),
        "_left": F.lead(F.lit(1), horizon - 1).over(w) if horizon > 1 else F.lit(1),
        **{name: upcoming(column) for name, column in ahead.items()},
    }
    if period:
        columns["x_first_period"] = F.first(period).over(before)
        columns["y_last_period"] = F.lead(period, horizon - 1).over(w)
        columns["y_periods"] = upcoming(period)
    made = df.withColumns(columns)
    return made.where((F.size("x") == lookback) & F.col("_left").isNotNull()).drop("_left")
