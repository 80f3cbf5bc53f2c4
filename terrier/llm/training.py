"""Means of large arrays over all tasks, and bounded samples of labelled rows."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = "part int, weight double, data binary"
SCHEMA = pa.schema([("part", pa.int32()), ("weight", pa.float64()), ("data", pa.binary())])


def emit(array: np.ndarray, weight: float, parts: int = 16, kind=np.float16) -> pa.RecordBatch:
    """Rows that ``averaged`` takes, with their weight: the array in a few parts, in half precision or ``kind``."""
    pieces = np.array_split(np.ascontiguousarray(np.clip(array, -6e4, 6e4), kind).reshape(-1), parts)
    return pa.RecordBatch.from_arrays([
        pa.array(range(len(pieces)), pa.int32()), pa.array([weight] * len(pieces)),
        pa.array([x.tobytes() for x in pieces], pa.binary())], schema=SCHEMA)


def _add(batches, kind=np.float16):
    sums: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            values = np.frombuffer(row["data"], kind).astype(np.float64) * row["weight"]
            if row["part"] in sums:
                sums[row["part"]][0] += row["weight"]
                sums[row["part"]][1] += values
            else:
                sums[row["part"]] = [row["weight"], values]
    for part, (weight, values) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([weight]), pa.array([(values / max(weight, 1e-9)).astype(kind).tobytes()], pa.binary())], schema=SCHEMA)


def averaged(parts: DataFrame, fan_in: int = 64, kind=np.float16) -> tuple[np.ndarray, float]:
    """The weighted mean of the arrays of all tasks (rows of ``emit``) and the sum of weights.

    Tasks of the first level add up the rows of ``fan_in`` sources or so, those of the
    second the rest; each holds one array at a time. Only the mean reaches the driver.
    """
    add = partial(_add, kind=kind)
    sources = max(1, parts.rdd.getNumPartitions())
    if sources > fan_in:
        parts = parts.repartition(-(-sources // fan_in) * 4, "part", F.spark_partition_id() % (-(-sources // fan_in))).mapInArrow(add, PARTS)
    rows = sorted(parts.repartition(8, "part").mapInArrow(add, PARTS).collect(), key=lambda r: r["part"])
    if not rows:
        return np.zeros(0, np.float32), 0.0
    return np.concatenate([np.frombuffer(r["data"], kind) for r in rows]).astype(np.float32), rows[0]["weight"]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Texts with labels: at most ``most`` rows, those of the smallest hash of the id.

    Rows without a label, and ids with more than one label, count once with the smallest.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    chosen = marks.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
