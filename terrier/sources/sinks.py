"""Writers: stamped appends, materialised models, predictions and metrics."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrier.sources.schemas import TABLES, TableSpec, conform, declare_table


def laid_out(df: DataFrame, sort_key: list[str], partition: str | None = None) -> DataFrame:
    """Rows arranged for writing: clustered by the sort key, evenly over tasks.

    With a partition column the rows are rebalanced by it: adaptive execution
    cuts a large partition into pieces of the advisory size and joins small
    ones, so one year with a third of the rows is still written by many tasks.
    Without one, rows are ranged by the sort key and then by a hash, so that
    rows with equal keys can be cut too.
    """
    if partition:
        return df.hint("rebalance", partition).sortWithinPartitions(
            partition, *[k for k in sort_key if k != partition])
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(*sort_key, spread).sortWithinPartitions(*sort_key)


def stamped(df: DataFrame, spec: TableSpec, at: datetime | None = None) -> DataFrame:
    """Declared columns plus the version column.

    The time is fixed when the plan is built, so a task that runs again writes
    the same version.
    """
    at = at or datetime.now(timezone.utc)
    return conform(df.drop(spec.version), spec).withColumn(
        spec.version, F.lit(at).cast("timestamp")
    )


def append_observed(
    df: DataFrame, spec: TableSpec, table: str | None = None, at: datetime | None = None,
    **metrics: Column,
) -> dict[str, object]:
    """Append rows with a load time; returns ``n`` and the given aggregates.

    The aggregates are taken while writing, so the source is read once. They are
    observed in the writing stage itself, whose tasks count once even when an
    executor is lost. Writing nothing leaves the table as it is.
    """
    spark = df.sparkSession
    name = declare_table(spark, spec, table)
    out = stamped(df, spec, at)
    if spec.partition:
        order = [spec.partition, *[k for k in spec.keys if k != spec.partition]]
        out = laid_out(out, order, spec.partition)
    seen = Observation()
    columns = spark.table(name).columns
    out = out.select(*columns).observe(
        seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in metrics.items()]
    )
    out.write.mode("append").insertInto(name)
    return dict(seen.get)


def append_with_load_ts(
    df: DataFrame, spec: TableSpec, table: str | None = None, at: datetime | None = None
) -> int:
    """Append rows with a load time and return how many were written."""
    return int(append_observed(df, spec, table, at)["n"])


def materialize(
    df: DataFrame, name: str, mode: str = "view", sort_key: list[str] | None = None,
    partition: str | None = None, location: str | None = None,
) -> DataFrame:
    """Keep a model as a view, or as a table laid out by its sort key.

    The sort key clusters rows so that file statistics can skip row groups.
    ``location`` puts the files there instead of the warehouse folder.
    """
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode != "table":
        raise ValueError("mode is 'view' or 'table'")
    out = laid_out(df, sort_key, partition) if sort_key else df
    writer = out.write.mode("overwrite").format("parquet")
    if partition:
        writer = writer.partitionBy(partition)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return spark.table(name)


def bucketed(
    df: DataFrame, name: str, keys: list[str], buckets: int, sort: list[str] | None = None,
    location: str | None = None, spread: bool = True,
) -> DataFrame:
    """A table whose rows with equal ``keys`` lie in one of ``buckets`` files, sorted.

    What groups, ranks or joins on the keys (or, for one table alone, on more columns than
    the keys) reads the buckets as they are, without an exchange; two tables are joined so
    if they have the same keys and as many buckets. One shuffle at the time of writing
    replaces one at every reading. A bucket is read by one task: take keys without hot
    values, such as an identifier, and enough buckets for one to fit in a task. Rows that a
    shuffle has put by ``keys`` into as many partitions need no other one (``spread=False``);
    with an empty ``sort`` a bucket is not sorted.
    """
    order = keys if sort is None else sort
    if spread:
        df = df.repartition(buckets, *keys)  # one file a bucket
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if order:
        writer = writer.sortBy(*order)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_predictions(df: DataFrame, horizons: bool, table: str | None = None) -> int:
    """Append versioned predictions, one or several horizons ahead."""
    spec = TABLES["preds_lstm_prix_m2" if horizons else "preds_ml_prix_m2"]
    return append_with_load_ts(df, spec, table)


def params_json(params: dict[str, object]) -> str:
    return json.dumps(params)


def write_metrics(df: DataFrame, table: str | None = None) -> int:
    """Append metrics of folds or horizons."""
    return append_with_load_ts(df, TABLES["model_perf_runs"], table)
