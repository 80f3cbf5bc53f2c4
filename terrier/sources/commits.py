"""Loads that become visible in one step, with their mark, and count once when repeated.

A ledger is a raw table kept as attempts: every write of a unit goes to a folder of its own
and is invisible until one row of the commit table names it. That row also carries the mark,
so rows and mark appear together: a load that dies in between leaves files that no reader
sees and a mark that has not moved, and the next run loads the unit again. A unit that is
committed twice (a batch of a stream that runs again after a crash) is read from its newest
attempt only.

The commit table has the columns of the mark table, so ``get_watermark`` and everything
built on it work on it unchanged.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from terrier.sources.loaders import SourceSpec, Unit
from terrier.sources.schemas import TABLES, TableSpec, declare_table
from terrier.sources.sinks import laid_out, stamped
from terrier.sources.state import get_watermark

COMMITS = "_ingestion_commits"
UNIT, ATTEMPT = "_unit", "_attempt"


@dataclass(frozen=True)
class Attempt:
    """Rows that are written but not yet visible."""

    unit: str
    attempt: str
    rows: int
    mark: object = None


@dataclass(frozen=True)
class Ledger:
    """A raw table below ``path`` whose attempts are listed in the table ``commits``."""

    spec: TableSpec
    path: str
    commits: str = COMMITS

    def stage(
        self, df: DataFrame, unit: str, mark: Column | None = None, at: datetime | None = None
    ) -> Attempt:
        """Write rows with a load time as an attempt of ``unit``; nobody sees them yet.

        ``mark`` is an aggregate of the rows, taken while they are written.
        """
        attempt = uuid.uuid4().hex
        out = stamped(df, self.spec, at)
        if self.spec.partition:
            out = laid_out(out, [self.spec.partition, *self.spec.keys], self.spec.partition)
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("n"), *([mark.alias("mark")] if mark is not None else [])]
        out = out.observe(seen, *metrics)
        out.write.parquet(f"{self.path}/{UNIT}={unit}/{ATTEMPT}={attempt}")
        found = dict(seen.get)
        return Attempt(unit, attempt, int(found["n"]), found.get("mark"))

    def commit(
        self, spark: SparkSession, done: Attempt, source: str, mark: str | None = None,
        also: tuple[tuple[str, str], ...] = (),
    ) -> None:
        """Make an attempt visible and move the marks, by one row in one file each source.

        All rows of a commit are written by one task, so they appear together.
        """
        declare_table(spark, TABLES[COMMITS], self.commits)
        rows = [(source, mark, self.spec.name, done.unit, done.attempt, done.rows)]
        rows += [(s, m, None, None, None, None) for s, m in also]
        fields = TABLES[COMMITS].schema.fields[:-1]
        df = spark.createDataFrame(rows, T.StructType(fields)).withColumn(
            TABLES[COMMITS].version, F.lit(datetime.now(timezone.utc)).cast("timestamp"))
        df.coalesce(1).write.mode("append").insertInto(self.commits)

    def committed(self, spark: SparkSession) -> DataFrame:
        """The newest attempt of every unit: one row per unit."""
        declare_table(spark, TABLES[COMMITS], self.commits)
        mine = spark.table(self.commits).where(F.col("table_name") == self.spec.name)
        newest = Window.partitionBy("unit").orderBy(F.desc(TABLES[COMMITS].version), F.desc("attempt"))
        ranked = mine.withColumn("_r", F.row_number().over(newest)).where("_r = 1")
        return ranked.select(F.col("unit").alias(UNIT), F.col("attempt").alias(ATTEMPT))

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of the committed attempts, in the columns of the table.

        The commits meet the folders on their partition columns, so Spark reads only
        committed folders.
        """
        declared = self.spec.schema
        found = self.committed(spark)
        if not found.head(1):
            return spark.createDataFrame([], declared)
        schema = T.StructType([
            *declared.fields, T.StructField(UNIT, T.StringType()), T.StructField(ATTEMPT, T.StringType())])
        rows = spark.read.schema(schema).parquet(self.path)
        return rows.join(found, [UNIT, ATTEMPT], "left_semi").select(*declared.fieldNames())


def _side_by_side(work: Callable, items: Iterable, parallel: int) -> Iterator:
    """Results in the order of the items, of which ``parallel`` are worked on at a time.

    An item that cannot be made, or whose work fails, raises after all results before it.
    """
    items, ahead = iter(items), deque()

    def start(pool: ThreadPoolExecutor) -> None:
        try:
            ahead.append(pool.submit(work, next(items)))
        except StopIteration:
            pass
        except Exception as e:
            ahead.append(Future())
            ahead[-1].set_exception(e)

    with ThreadPoolExecutor(parallel) as pool:
        for _ in range(parallel):
            start(pool)
        while ahead:
            yield ahead.popleft().result()
            start(pool)


def committed_load(
    spark: SparkSession, source: SourceSpec, ledger: Ledger, full_refresh: bool = False,
    since: str | None = None, parallel: int = 4,
) -> int:
    """Load what follows the mark; every unit appears together with its mark.

    Up to ``parallel`` units are written side by side, as one alone leaves cores idle, and
    committed in their order. A crash leaves complete units with their marks and no part of
    another one.
    """
    declare_table(spark, TABLES[COMMITS], ledger.commits)
    # A commit of a unit without a mark (a keyless reload) does not hide the mark before it.
    mark = None if full_refresh else (since or get_watermark(spark, source.name, ledger.commits))

    def stage(unit: Unit) -> tuple[Unit, Attempt]:
        mark = unit.mark if isinstance(unit.mark, Column) else None
        return unit, ledger.stage(unit.rows, uuid.uuid4().hex, mark)

    written = 0
    run = inheritable_thread_target(spark)(stage)
    for unit, done in _side_by_side(run, source.units(spark, mark), parallel):
        value = done.mark if isinstance(unit.mark, Column) else unit.mark
        if done.rows or value is not None:
            ledger.commit(spark, done, source.name, value, unit.also if value is not None else ())
        written += done.rows
    return written


def committed_reload(spark: SparkSession, rows: DataFrame, ledger: Ledger, source: str) -> int:
    """A small source as a whole: the new state replaces the one before it in one step."""
    done = ledger.stage(rows, "all")
    ledger.commit(spark, done, source)
    return done.rows


def ingest_once(
    stream: DataFrame, ledger: Ledger, parse: Callable[[DataFrame], DataFrame], checkpoint: str, name: str
) -> StreamingQuery:
    """Load everything that landed since the last run, each batch exactly once, then stop.

    A batch is the unit ``<name>-<number>``. If it runs again, after a crash between its
    commit and the stream's own, its rows replace those of the first time. ``name`` belongs
    to one checkpoint.
    """
    def load(batch: DataFrame, number: int) -> None:
        load_batch(batch.sparkSession, parse(batch), ledger, name, number)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_batch(spark: SparkSession, rows: DataFrame, ledger: Ledger, name: str, number: int) -> None:
    """One batch of a stream as a unit of the ledger."""
    done = ledger.stage(rows, f"{name}-{number:09d}")
    ledger.commit(spark, done, name)
