"""Errors of predictions: by fold, horizon, group, and as a histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.numeric import clip, mean, settle
from terrier.operators.aggregates import count_rows
from terrier.operators.quantiles import BAND_LIMIT, aggregate_with_quantiles, exact_quantiles


def error(actual: str, predicted: str) -> Column:
    return F.col(predicted).cast("double") - F.col(actual).cast("double")


def mae(actual: str, predicted: str, digits: int = 4) -> Column:
    return settle(F.avg(F.abs(error(actual, predicted))), digits)


def rmse(actual: str, predicted: str, digits: int = 4) -> Column:
    return settle(F.sqrt(F.avg(F.pow(error(actual, predicted), 2))), digits)


def mape(actual: str, predicted: str, digits: int = 4) -> Column:
    """Mean absolute error in percent over actuals above 0; 0 without any."""
    ratio = F.abs(F.try_divide(error(actual, predicted), F.col(actual)))
    over = F.avg(F.when(F.col(actual) > 0, ratio)) * 100
    return settle(F.coalesce(over, F.lit(0.0)), digits)


def r2(actual: str, predicted: str, digits: int = 4) -> Column:
    """Share of variance explained, over rows with both values."""
    known = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    y = F.when(known, F.col(actual).cast("double"))
    residual = F.sum(F.pow(error(actual, predicted), 2))
    return settle(1 - F.try_divide(residual, F.count(y) * F.var_pop(y)), digits)


def error_metrics(
    df: DataFrame, actual: str, predicted: str, keys: list[str] = (), entity: str | None = None,
    digits: int = 4,
) -> DataFrame:
    """MAE, RMSE and MAPE with the number of rows (and entities) behind them."""
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    parts = [
        count_rows("n_samples"), mae(actual, predicted, digits).alias("mae"),
        rmse(actual, predicted, digits).alias("rmse"), mape(actual, predicted, digits).alias("mape"),
    ]
    if entity:
        parts.append(F.countDistinct(entity).alias("n_communes"))
    return known.groupBy(*keys).agg(*parts) if keys else known.agg(*parts)


def metrics_by_group(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    """Error, rows and median actual of every group."""
    parts = {"mae": mae(actual, predicted, 2), "n": F.count(actual)}
    rows = df.select(group, actual, predicted)
    wanted = {"prix_reel_med": 0.5}
    return aggregate_with_quantiles(rows, [group], parts, actual, wanted, 2, BAND_LIMIT)


def mean_over_folds(metrics: DataFrame, digits: int = 1) -> DataFrame:
    return metrics.agg(*[mean(c, digits).alias(c) for c in ("mae", "rmse", "mape")])


def error_histogram(
    df: DataFrame, actual: str, predicted: str, bins: int = 60, limit: float = 1000.0
) -> DataFrame:
    """Clipped absolute errors in equal bins over their own range, with the median.

    The largest value belongs to the last bin. Empty bins are left out.
    """
    errors = df.select(F.abs(error(actual, predicted)).alias("_raw")).where("_raw IS NOT NULL")
    clipped = errors.select(clip("_raw", 0.0, limit).alias("_e"), "_raw")
    span = clipped.agg(F.min("_e").alias("lo"), F.max("_e").alias("hi"))  # one row
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    width = F.try_divide(hi - lo, F.lit(float(bins)))
    index = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("_e") - lo, width)), F.lit(0)), F.lit(bins - 1)
    )
    counts = clipped.groupBy(index.cast("int").alias("bin")).agg(count_rows("n"))
    median = exact_quantiles(errors, [], "_raw", {"m": 0.5}, 2)
    return counts.select(
        "bin", "n", settle(lo + F.col("bin") * width, 4).alias("borne"),
        median.select("m").scalar().alias("mediane"),
    )
