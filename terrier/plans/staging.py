"""Staging views: newest version of every row, blanks as NULL, keys present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions.text import null_blank
from terrier.operators.dedup import dedup_latest
from terrier.operators.rows import require_key
from terrier.sources.schemas import TABLES


def _stage(
    raw: DataFrame, table: str, blanks: tuple[str, ...], key: str | None
) -> DataFrame:
    spec = TABLES[table]
    # The key is part of the replacing key, so dropping empty ones first is the
    # same and lets the filter reach the scan.
    kept = require_key(raw, key) if key else raw
    newest = dedup_latest(kept, list(spec.keys), spec.version, spec.all_ties)
    return newest.select(*[
        null_blank(c).alias(c) if c in blanks else F.col(c) for c in spec.data_columns
    ])


def stg_dvf(raw: DataFrame) -> DataFrame:
    """Transactions, one row per lot."""
    return _stage(raw, "raw_dvf", ("type_local",), "id_mutation")


def stg_dpe(raw: DataFrame) -> DataFrame:
    """Energy certificates, one row per certificate."""
    blanks = ("etiquette_dpe", "type_energie_principale_chauffage",
              "type_installation_chauffage", "periode_construction", "type_batiment")
    return _stage(raw, "raw_dpe", blanks, "numero_dpe")


def stg_sitadel(raw: DataFrame) -> DataFrame:
    """Building permits by month, commune and kind of dwelling."""
    return _stage(raw, "raw_sitadel", ("type_logement",), "code_commune")


def stg_ecln(raw: DataFrame) -> DataFrame:
    """New-build sales by quarter, department and kind of dwelling."""
    return _stage(raw, "raw_ecln", ("libelle_departement", "type_logement"), "code_departement")


def stg_eptb(raw: DataFrame) -> DataFrame:
    """Prices of land and new houses by year and zone; no key filter."""
    return _stage(raw, "raw_eptb", ("zone_code", "zone_libelle"), None)


def stg_rpls(raw: DataFrame) -> DataFrame:
    """Social housing by vintage, commune and funding (the coarse key is kept)."""
    return _stage(raw, "raw_rpls", ("financement", "classe_energie_dpe"), "code_commune")
