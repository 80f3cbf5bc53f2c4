"""Incremental loads: choose a slice, parse, append, then move the mark."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from terrier.sources import parsers, readers
from terrier.sources.schemas import TABLES
from terrier.sources.sinks import append_observed, append_with_load_ts
from terrier.sources.state import (
    STATE, ensure_state, get_watermark, mark_of, new_vintages, same_vintage, set_watermark,
    since_next_day, year_month_mark, years_to_load,
)


@dataclass(frozen=True)
class Unit:
    """One load: parsed rows and the mark to set once they are written.

    ``mark`` is a fixed value, or an aggregate of the written rows.
    """

    rows: DataFrame
    mark: str | Column | None = None
    also: tuple[tuple[str, str], ...] = ()


Slice = Callable[[SparkSession, str | None], Iterable[Unit]]


@dataclass(frozen=True)
class SourceSpec:
    """A source: its table and how to list the loads that follow a mark."""

    name: str
    table: str
    units: Slice


def incremental_load(
    spark: SparkSession, spec: SourceSpec, full_refresh: bool = False, dry_run: bool = False,
    since: str | None = None, keep_mark: bool = False, table: str | None = None,
    state: str = STATE,
) -> int:
    """Load what follows the mark and return the rows written.

    The mark moves after each unit is written, so a crash repeats at most one
    unit and the replacing key absorbs the repeat. A dry run writes nothing.
    ``keep_mark`` loads without moving the mark (an explicit year).
    """
    ensure_state(spark, state)
    mark = None if full_refresh else (since or get_watermark(spark, spec.name, state))
    written = 0
    for unit in spec.units(spark, mark):
        if dry_run:
            unit.rows.count()
            continue
        found = isinstance(unit.mark, Column)
        seen = append_observed(
            unit.rows, TABLES[spec.table], table, **({"mark": unit.mark} if found else {})
        )
        written += int(seen["n"])
        if keep_mark:
            continue
        value = seen["mark"] if found else unit.mark
        if value is not None:
            set_watermark(spark, spec.name, value, state)
            for source, extra in unit.also:
                set_watermark(spark, source, extra, state)
    return written


def full_reload(
    spark: SparkSession, rows: DataFrame, table: str, dry_run: bool = False,
    name: str | None = None,
) -> int:
    """Append a small source as a whole; the newest version wins on reading."""
    if dry_run:
        rows.count()
        return 0
    return append_with_load_ts(rows, TABLES[table], name)


# --- the sources -------------------------------------------------------------------

def yearly_files(
    name: str, table: str, path_of: Callable[[int], str], parse: Callable[[DataFrame], DataFrame],
    target: int, first: int, gzip: bool = False, year: int | None = None,
) -> SourceSpec:
    """One file a year, marked year by year."""
    read = readers.read_csv_gz if gzip else readers.read_plain_csv

    def units(spark: SparkSession, mark: str | None):
        wanted = [year] if year is not None else years_to_load(mark, target, first)
        for y in wanted:
            yield Unit(parse(read(spark, path_of(y))), str(y))

    return SourceSpec(name, table, units)


def dvf(path_of, target: int, year: int | None = None) -> SourceSpec:
    return yearly_files("dvf", "raw_dvf", path_of, parsers.parse_dvf, target, 2021, True, year)


def insee(path_of, target: int, year: int | None = None) -> SourceSpec:
    return yearly_files(
        "insee_communes", "raw_insee_communes", path_of, parsers.parse_insee, target, 2017, False,
        year,
    )


def dpe(path: str, full_refresh: bool = False, lines: bool = False) -> SourceSpec:
    """Landed certificate pages; one mark after all complete dates are written.

    The mark is set once for the whole load, not page by page, so a crash in the
    middle of a date cannot skip the rest of that date.
    """
    record = ", ".join(f"{c} STRING" for c in parsers.DPE_NAMES)

    def units(spark: SparkSession, mark: str | None):
        parsed = parsers.parse_dpe(readers.read_json_pages(spark, path, record, "results", lines=lines))
        fresh = parsed if full_refresh else since_next_day(parsed, "date_etablissement_dpe", mark)
        yield Unit(fresh, mark_of("date", "date_etablissement_dpe"))

    return SourceSpec("dpe", "raw_dpe", units)


def sitadel(
    path_of: Callable[[str], str], vintage: str, full_refresh: bool = False, state: str = STATE
) -> SourceSpec:
    """Newest vintage of permits; nothing to do when it was loaded already.

    A full refresh ignores both the month mark and the vintage mark.
    """
    def units(spark: SparkSession, mark: str | None):
        last = None if full_refresh else get_watermark(spark, "sitadel_millesime", state)
        if same_vintage(last, vintage):
            return
        raw = readers.read_csv(spark, path_of(vintage), ";")
        yield Unit(
            parsers.parse_sitadel(raw, year_month_mark(mark)),
            mark_of("year_month"),
            (("sitadel_millesime", vintage),),
        )

    return SourceSpec("sitadel", "raw_sitadel", units)


def ecln(path: str, lines: bool = False) -> SourceSpec:
    record = ", ".join(f"{c} STRING" for c in parsers.ECLN_NAMES)

    def units(spark: SparkSession, mark: str | None):
        pages = readers.read_json_pages(spark, path, record, lines=lines)
        yield Unit(parsers.parse_ecln(pages, mark), mark_of("quarter"))

    return SourceSpec("ecln", "raw_ecln", units)


def rpls(path_of: Callable[[str], str], vintages: DataFrame) -> SourceSpec:
    """Every vintage after the mark, marked one by one."""
    def units(spark: SparkSession, mark: str | None):
        # A catalogue lists a handful of vintages.
        todo = [r["millesime"] for r in new_vintages(vintages, mark).collect()]
        for vintage in sorted(todo):
            raw = readers.read_csv(spark, path_of(vintage), ";")
            yield Unit(parsers.parse_rpls(raw, parsers.vintage_year(vintage)), vintage)

    return SourceSpec("rpls", "raw_rpls", units)


def macro(path: str) -> SourceSpec:
    def units(spark: SparkSession, mark: str | None):
        raw = readers.read_plain_csv(spark, path)
        yield Unit(parsers.parse_macro(raw, mark), mark_of("month", "date"))

    return SourceSpec("macro_taux", "raw_macro_taux", units)


def eptb(spark: SparkSession, land_path: str, houses_path: str) -> DataFrame:
    """Land and house pages merged, for ``full_reload``."""
    land = readers.read_json_pages(
        spark, land_path, ", ".join(f"{c} STRING" for c in parsers.LAND_NAMES))
    houses = readers.read_json_pages(
        spark, houses_path, ", ".join(f"{c} STRING" for c in parsers.HOUSE_NAMES))
    return parsers.parse_eptb(land, houses)
