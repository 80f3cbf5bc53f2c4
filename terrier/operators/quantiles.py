"""Exact interpolated quantiles that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here the
values of a group are split into ordered bands, the bands are counted, and only
the bands that hold a wanted rank are ranked value by value:

1. count equal values, ``(group, band, value) -> n`` (combined before the shuffle);
2. count the bands and take running totals over the bands of a group; the
   number of bands is bounded by the range of a double, not by the data;
3. keep the few bands a wanted rank falls into and rank their values;
4. interpolate between the two neighbours of every rank.

A band is a fixed step on a logarithmic scale, so one band of a group may still hold very
many distinct values. With ``limit`` such a band is cut again, into equal steps between its
least and greatest value, counted, and only the steps with a wanted rank are kept; this is
repeated until none holds more than ``limit`` distinct values. Steps are equal on a
logarithmic scale while a band spans more than a factor of 16, as the one round zero may.
Each round splits a band, so it ends for any values. The counted values are written once for it, as every round reads
them.

The keys travel as one struct: a struct with NULL fields still equals itself, so
NULL keys need no null-safe join, and one partitioning serves both the join and
the window of step 3.

Where no group can be large, the steps above cost several shuffles of nearly all rows for
groups of a few values. ``aggregate_with_quantiles`` may then rank the rows of a group in
the one shuffle that groups them, if ``largest_cell`` shows that every group is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.functions.numeric import mean, round_he, settle
from terrier.session import cut_lineage

BANDS_PER_E_FOLD = 256
ROW = "_row"
#: Most distinct values of a band that one task ranks, where a limit is asked for.
BAND_LIMIT = 65_536
STEPS = 4096
#: Most rows of a group that one task ranks beside each other, where groups may be ranked whole.
GROUP_LIMIT = 1_000_000
CELLS = 65_536


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def value_band(value: str) -> str:
    """SQL for the order-preserving band of a number: equal steps on a logarithmic scale.

    Never NULL, so that no plan around it adds a filter on it. Infinities have the bands
    at the ends, NaN the one after them, as it sorts last.
    """
    scaled = f"signum({value}) * least(log1p(abs({value})), 1000D) * {BANDS_PER_E_FOLD}"
    return f"CASE WHEN isnan({value}) THEN 1000000L ELSE coalesce(floor({scaled}), 0L) END"


def _rank(p: float) -> str:
    return f"({float(p)!r}D * (_size - 1))"


def _inside(rank: str) -> str:
    return f"({rank} >= _start AND {rank} < _end)"


def _refined(cells: DataFrame, hit: str, limit: int) -> DataFrame:
    """``cells`` of the bands with a wanted rank, until no band has over ``limit`` values.

    A band is told by its group and ``_before``, the rows of the group below it.
    """
    while True:
        spans = cells.groupBy("_g", "_before").agg(
            F.expr("min(_v) AS _least"), F.expr("max(_v) AS _most"), F.expr("count(1) AS _c"),
            F.expr("min(CASE WHEN _v <> 0 THEN abs(_v) END) AS _tiny"), F.expr("max(abs(_v)) AS _big"))
        largest = spans.agg(F.max("_c")).first()[0]  # one number
        if largest is None or largest <= limit:
            return cells
        scaled = {x: f"CASE WHEN _big <= 16 * _tiny THEN {x} WHEN {x} = 0 THEN 0D "
                     f"ELSE signum({x}) * (ln(abs({x})) - ln(_tiny) + 1) END" for x in ("_v", "_least", "_most")}
        low = scaled["_least"]
        step = f"floor(({scaled['_v']} - {low}) / ({scaled['_most']} - {low}) * {STEPS}D)"
        cut = cells.join(spans, ["_g", "_before"]).selectExpr(
            "_g", "_before", "_size", "_v", "_n",
            f"CASE WHEN _c > {limit} THEN least({step}, {STEPS - 1}L) ELSE 0L END AS _step")
        steps = (
            cut.groupBy("_g", "_before", "_step").agg(F.expr("sum(_n) AS _m"), F.expr("max(_size) AS _size"))
            .selectExpr("*", "_before + sum(_m) OVER (PARTITION BY _g, _before ORDER BY _step"
                             " ROWS UNBOUNDED PRECEDING) AS _end")
            .selectExpr("_g", "_before", "_step", "_size", "_end", "_end - _m AS _start")
            .where(hit).select("_g", "_before", "_step", "_start")
        )
        cells = cut_lineage(
            cut.join(steps, ["_g", "_before", "_step"])
            .selectExpr("_g", "_start AS _before", "_size", "_v", "_n"), "band")


def _edges(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], limit: int | None = None
) -> DataFrame:
    """Rows ``(_g, _size, _lo_*, _hi_*)`` with the neighbours of every wanted rank.

    The expressions are SQL text: they are many, and each text is one call to the JVM.
    """
    group = ", ".join(f"'{k}', {_name(k)}" for k in keys) if keys else "'_', 0"
    v = f"CAST({_name(value)} AS DOUBLE)"
    cells = (
        df.selectExpr(f"named_struct({group}) AS _g", f"{v} AS _v")
        .where("_v IS NOT NULL")
        .selectExpr("_g", f"{value_band('_v')} AS _band", "_v")
        .groupBy("_g", "_band", "_v")
        .agg(F.expr("count(1) AS _n"))
    )
    if limit is not None:
        cells = cut_lineage(cells, "cells")
    bands = (
        cells.groupBy("_g", "_band")
        .agg(F.expr("sum(_n) AS _m"))
        .selectExpr(
            "_g", "_band", "_m",
            "sum(_m) OVER (PARTITION BY _g ORDER BY _band ROWS UNBOUNDED PRECEDING) AS _end",
            "sum(_m) OVER (PARTITION BY _g) AS _size",
        )
        .selectExpr("*", "_end - _m AS _start")
    )
    ends = {
        name: (f"floor({_rank(p)})", f"ceil({_rank(p)})") for name, p in wanted.items()
    }
    hit = " OR ".join(_inside(end) for pair in ends.values() for end in pair)
    bands = bands.where(hit).selectExpr("_g", "_band", "_start AS _before", "_size")
    cells, band = cells.join(bands, ["_g", "_band"]), "_band"
    if limit is not None:
        kept = cells.select("_g", "_before", "_size", "_v", "_n")
        cells, band = _refined(cut_lineage(kept, "band"), hit, limit), "_before"
    ranked = (
        cells.selectExpr(
            "_g", "_v", "_n", "_size",
            f"_before + sum(_n) OVER (PARTITION BY _g, {band} ORDER BY _v ROWS UNBOUNDED PRECEDING)"
            " AS _end",
        )
        .selectExpr("*", "_end - _n AS _start")
        .where(hit)
    )
    picked = [
        f"CASE WHEN {_inside(end)} THEN _v END AS {_name(side + name)}"
        for name, pair in ends.items() for side, end in zip(("_lo_", "_hi_"), pair)
    ]
    return ranked.selectExpr("_g", "_size", *picked)


def _interpolated(wanted: dict[str, float], digits: int | None) -> list[Column]:
    result = []
    for name, p in wanted.items():
        rank = _rank(p)
        lo, hi = _name("_lo_" + name), _name("_hi_" + name)
        q = F.expr(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * ({rank} - floor({rank})) END")
        result.append((settle(q, digits) if digits is not None else q).alias(name))
    return result


def largest_cell(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest of ``CELLS`` cells of group hashes: no group has more.

    Reads the keys alone, and every task sends one row a cell at most.
    """
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int").alias("_cell")
    return df.groupBy(cell).count().agg(F.max("count")).first()[0] or 0  # one number


def _ranked_groups(
    df: DataFrame, keys: list[str], parts: dict[str, Column], value: str, wanted: dict[str, float],
) -> DataFrame:
    """Rows ranked inside their group and aggregated there, in one shuffle at most.

    The value is ordered by as it stands and made a double after the ranks, so that the
    shuffle carries it once.
    """
    ordered = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(_name(value)))
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = df.withColumns({
        "_rank": F.row_number().over(ordered) - 1, "_size": F.count(_name(value)).over(whole)})
    ranked = ranked.withColumns({ROW: F.lit(True), "_v": F.expr(f"CAST({_name(value)} AS DOUBLE) + 0D")})
    found = {"_size": F.max("_size")}
    for name, p in wanted.items():
        for side, end in (("_lo_", "floor"), ("_hi_", "ceil")):
            found[side + name] = F.expr(f"max(CASE WHEN _rank = {end}({_rank(p)}) THEN _v END)")
    return ranked.groupBy(*keys).agg(
        *[c.alias(n) for n, c in parts.items()], *[c.alias(n) for n, c in found.items()])


def aggregate_with_quantiles(
    df: DataFrame, keys: list[str], parts: dict[str, Column], value: str,
    wanted: dict[str, float], digits: int | None = None, limit: int | None = None,
    whole: int | None = None,
) -> DataFrame:
    """Aggregates of a group together with exact quantiles of one column.

    The rows and the rank neighbours are grouped in the same shuffle. The rows
    carry a column ``_row``; the aggregates in ``parts`` must skip NULLs and
    count rows with ``count_rows`` / ``share``, which count that column.

    ``df`` is read twice, so it should be a table or a short plan. Groups
    without any value get NULL quantiles. Quantiles are linear between
    neighbours and ignore NULLs; with ``digits`` they are rounded. ``limit`` is for raw
    numbers; values rounded to a few digits have few of them in a band. With ``whole``,
    groups are ranked as they are if none has more rows than that: ``df`` is then shuffled
    once, or not at all if it lies by some of the keys already.
    """
    if whole is not None and keys and largest_cell(df, keys) <= whole:
        grouped = _ranked_groups(df, keys, parts, value, wanted)
        return grouped.select(*keys, *parts, *_interpolated(wanted, digits))
    edges = _edges(df, keys, value, wanted, limit)
    found = [c for c in edges.columns if c != "_g"]
    edges = edges.select(*[F.col(f"_g.{k}").alias(k) for k in keys], *found)
    rows = df.withColumn(ROW, F.lit(True))
    both = rows.unionByName(edges, allowMissingColumns=True)
    grouped = both.groupBy(*keys).agg(
        *[c.alias(n) for n, c in parts.items()], *[F.max(c).alias(c) for c in found]
    )
    return grouped.select(*keys, *parts, *_interpolated(wanted, digits))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float],
    digits: int | None = None, limit: int | None = BAND_LIMIT,
) -> DataFrame:
    """Quantiles per group; groups without any value are absent.

    ``wanted`` maps output column to probability.
    """
    edges = _edges(df, keys, value, wanted, limit)
    found = [c for c in edges.columns if c != "_g"]
    grouped = edges.groupBy("_g").agg(*[F.max(c).alias(c) for c in found])
    names = [F.col(f"_g.{k}").alias(k) for k in keys]
    return grouped.select(*names, *_interpolated(wanted, digits))


def profile_columns(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """One row per column: count, mean, deviation, extremes and exact quartiles.

    Every column is one group of the quantile plan, which splits a group of any
    size over tasks.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).cast("double").alias("_v0")) for c in columns
    ])
    parts = {
        "n": F.count("_v0"),
        "moyenne": mean("_v0", digits),
        "ecart_type": settle(F.stddev_samp("_v0"), digits),
        "mini": round_he(F.min("_v0"), digits),
        "maxi": round_he(F.max("_v0"), digits),
    }
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    return aggregate_with_quantiles(
        df.select(F.inline(pairs)), ["colonne"], parts, "_v0", quartiles, digits, BAND_LIMIT
    )


def approx_quantiles(
    value: str, wanted: dict[str, float], digits: int, accuracy: int = 10000
) -> list[Column]:
    """Aggregates with bounded memory and a bounded rank error; opt-in."""
    return [
        settle(F.percentile_approx(F.col(value), F.lit(float(p)), accuracy), digits).alias(name)
        for name, p in wanted.items()
    ]
