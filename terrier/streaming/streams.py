"""Structured Streaming variants of loading, deduplication and the panel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from terrier.sources.schemas import TableSpec
from terrier.sources.sinks import append_with_load_ts


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; local ones are read as session time."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def read_landing(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files that land in a folder, with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_ingest(
    stream: DataFrame, spec: TableSpec, parse: Callable[[DataFrame], DataFrame], checkpoint: str,
    table: str | None = None,
) -> StreamingQuery:
    """Load everything that landed since the last run, then stop.

    The stream's checkpoint takes the place of the high-water mark. A batch that
    runs again after a crash appends its rows again; the replacing key of the
    table absorbs the repeat on reading. ``commits.ingest_once`` has each batch once.
    """
    def load(batch: DataFrame, _: int) -> None:
        append_with_load_ts(parse(batch), spec, table)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First row of a key within ``delay``; state older than the watermark is dropped."""
    return event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def stream_tumbling_panel(
    stream: DataFrame, time: str, value: str, keys: list[str], every: str, delay: str
) -> DataFrame:
    """Count and sum per window and key. In append mode a window is emitted once it is closed."""
    return (
        event_time(stream, time)
        .withWatermark(time, delay)
        .groupBy(F.window(time, every).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.col("_w.start").alias("debut"), *keys, "n", "total")
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what is available into files and read them back."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_to_first_rows(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]
) -> DataFrame:
    """Process what is available and keep the first row of every key, however far apart repeats lie.

    The rows written so far are the table of known keys: a batch keeps its first row of each
    key by ``order`` (ties by the other columns) and drops keys of earlier batches in a join
    on disk, so no key is held in the memory of the stream and no delay is needed. A batch
    writes into a folder of its own and looks at earlier folders only, so a batch that runs
    again replaces itself. NULL keys equal each other.
    """
    spark = stream.sparkSession
    values = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("_batch", LongType())])
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/_batch=-1")

    def fresh(batch: DataFrame, number: int) -> None:
        first = F.min(F.struct(*order, *[c for c in values if c not in order])).alias("_first")
        own = batch.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*stream.columns)
        known = batch.sparkSession.read.schema(schema).parquet(path).where(F.col("_batch") < number)
        known = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
        same = [own[k].eqNullSafe(known[f"_known_{k}"]) for k in keys]
        own.join(known, same, "left_anti").write.mode("overwrite").parquet(f"{path}/_batch={number}")

    query = (
        stream.writeStream.foreachBatch(fresh).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path).select(*stream.columns)


def run_to_versions(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Process what is available in update mode and read the newest row of every key.

    A batch writes only the rows it changed, into a folder of its own, so a batch that runs
    again replaces itself; state older than the watermark is dropped.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/_batch=-1")

    def changed(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={number}")

    query = (
        stream.writeStream.foreachBatch(changed).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("_batch", LongType())])
    rows = spark.read.schema(schema).parquet(path)
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_new"))
    return newest.select(*keys, "_new.*").select(*stream.columns)
