"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PORTABLE_SEPARATOR = ","


def key_digest(keys: list[str], seed: int | None = None) -> Column:
    """Digest of a row's keys, the same on every run and in other engines."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.md5(F.concat_ws(PORTABLE_SEPARATOR, *parts))


def hash_bucket(keys: list[str], buckets: int, seed: int | None = None) -> Column:
    """Bucket of a row by the first 32 bits of its digest."""
    head = F.substring(key_digest(keys, seed), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % buckets


def fast_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket by Spark's own hash: cheaper, not portable."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def hash_sample(
    df: DataFrame, keys: list[str], buckets: int = 20, keep: int = 0, portable: bool = True
) -> DataFrame:
    """About one row in ``buckets``, chosen by the keys."""
    bucket = hash_bucket if portable else fast_bucket
    return df.where(bucket(keys, buckets) == keep)


def random_split(df: DataFrame, keys: list[str], train_share: float = 0.8, seed: int = 42):
    """Disjoint train and test rows.

    The side of a row depends on its keys and the seed, not on its partition, so
    a task that runs again puts every row on the same side.
    """
    train = hash_bucket(keys, 10_000, seed) < round(train_share * 10_000)
    return df.where(train), df.where(~train)


def random_sample(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows: the smallest digests, taken task by task, then merged."""
    return df.orderBy(key_digest(keys, seed), *keys).limit(n)
