"""Left enrichment joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Same rows, but the job fails when a key occurs twice.

    A second row would multiply the rows of the left side. The check is part of
    the plan: it groups on the join keys, so the join reuses that partitioning
    and no extra job runs. Numbers aggregate by hash, without a sort.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_n")
    )
    message = F.concat(F.lit("more than one row for join key "), F.to_json(F.struct(*keys)))
    return counted.where(F.assert_true(F.col("_n") == 1, message).isNull()).drop("_n")


def merge_contexts(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of small contexts on one key set.

    Several lookups on the same keys become one wide table, so the large side
    is shuffled (or streamed past a hash table) once instead of once a lookup.
    """
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)


def left_enrich(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    defaults: dict[str, object] | None = None,
    salts: int = 1,
) -> DataFrame:
    """Left equi-join that keeps every left row.

    ``defaults`` gives the value of right columns that are never NULL in the
    source, for rows without a match. No broadcast is forced: Spark picks it
    when the measured size of the right side allows, and otherwise adaptive
    execution cuts skewed partitions of the left side. ``salts`` > 1 spreads a
    hot key over that many tasks whatever follows in the plan; each right row is
    then sent that many times. The salt is a hash of the whole left row, so a
    task that runs again gives every row the same one.
    """
    if salts > 1:
        spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
        left = left.withColumn("_salt", spread)
        right = right.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        )
        joined = left.join(right, [*keys, "_salt"], "left").drop("_salt")
    else:
        joined = left.join(right, keys, "left")
    return with_defaults(joined, defaults or {})


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    present = {k: v for k, v in defaults.items() if k in df.columns}
    if not present:
        return df
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in present.items()})

