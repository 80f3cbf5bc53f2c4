"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "terrier", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution; ANSI mode stays on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, one machine) a local folder is made for the session and removed at
    the end of the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL:
        made = tempfile.mkdtemp(prefix="terrier-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _LOCAL[context.applicationId] = made
    return _LOCAL[context.applicationId]


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Remove what the block wrote to the shared folder when it ends.

    Results must be saved inside the block: a DataFrame made there reads files that are
    gone afterwards. Without it the files stay, as they do for the registered queries.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _OPEN.pop():
            for made in (path, path + "-checkpoint"):
                place = jvm.org.apache.hadoop.fs.Path(made)
                place.getFileSystem(conf).delete(place, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; an open ``scratch`` block removes it."""
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def cut_lineage(df, label: str):
    """Write ``df`` to the shared folder and read it back.

    The written files survive the loss of executors, unlike cached blocks, and
    several consumers read them without running the plan above again.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
