"""Raw source text to the typed columns of the raw tables, one projection each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions import text as tx
from terrier.operators.rows import drop_null, project_known, rename_to_schema
from terrier.sources.schemas import TABLES
from terrier.sources.state import since_month, since_quarter, since_year_month

Convert = Callable[[Column], Column]

# Source names of the columns.
DPE_NAMES = {
    "numero_dpe": "numero_dpe",
    "date_etablissement_dpe": "date_etablissement_dpe",
    "code_insee_ban": "code_commune",
    "etiquette_dpe": "etiquette_dpe",
    "conso_5_usages_par_m2_ep": "consommation_energie_primaire",
    "conso_5_usages_par_m2_ef": "consommation_energie_finale",
    "emission_ges_5_usages_par_m2": "emission_ges",
    "type_energie_principale_chauffage": "type_energie_principale_chauffage",
    "type_installation_chauffage": "type_installation_chauffage",
    "surface_habitable_immeuble": "surface_habitable_logement",
    "periode_construction": "periode_construction",
    "type_batiment": "type_batiment",
}
SITADEL_NAMES = {
    "ANNEE": "annee", "MOIS": "mois", "CODE_INSEE": "code_commune", "TYPE_LGT": "type_logement",
    "LOG_AUT": "nb_logements_autorises", "LOG_COM": "nb_logements_commences",
    "SDP_AUT": "surface_autorisee", "SDP_COM": "surface_commencee",
}
ECLN_NAMES = {
    "TRIMESTRE": "periode", "DEP_CODE": "code_departement", "DEP_LIBELLE": "libelle_departement",
    "TYPE_LGT": "type_logement", "MEV": "nb_mises_en_vente", "RESA": "nb_reservations",
    "ANNUL": "nb_annulations", "STOCK": "stock", "DELAI_ECOUL": "delai_ecoulement",
    "PRIX_M2": "prix_m2", "PRIX_MOY_IND": "prix_moyen_individuel",
}
ZONE_NAMES = {"ANNEE": "annee", "ZONE_CODE": "zone_code", "ZONE_LIBELLE": "zone_libelle"}
LAND_NAMES = {
    **ZONE_NAMES, "NB_TERRAINS": "nb_terrains", "PTM2_MOY": "prix_terrain_m2_moy",
    "PTM2_MED": "prix_terrain_m2_med", "SURFT_MOY": "surface_terrain_moy",
    "PT_MOY": "prix_terrain_total",
}
HOUSE_NAMES = {
    **ZONE_NAMES, "NB_MAISONS": "nb_maisons", "PMM2_MOY": "prix_maison_m2_moy",
    "PMM2_MED": "prix_maison_m2_med", "SURFM_MOY": "surface_maison_moy",
    "PM_MOY": "prix_maison_total",
}
RPLS_NAMES = {
    "DEPCOM": "code_commune", "DEP_CODE": "code_departement", "REG_CODE": "code_region",
    "FINAN_CODE": "financement", "DPEENERGIE": "classe_energie_dpe",
    "CONSTRUCT": "annee_construction", "SURFHAB": "surface", "NBPIECE": "nb_pieces",
}


def _typed(df: DataFrame, table: str, number: Convert = tx.to_double_or_null) -> DataFrame:
    """Coerce the columns that are there to the declared types of the table.

    Text keeps '' for NULL; ``number`` reads doubles.
    """
    convert: dict[str, Convert] = {
        "string": tx.blank_null, "double": number, "int": tx.to_int_or_null,
        "date": tx.to_date_or_null,
    }
    kinds = {f.name: f.dataType.simpleString() for f in TABLES[table].schema.fields}
    return df.select(*[
        convert[kinds[c]](F.col(c)).alias(c) if c in kinds else F.col(c) for c in df.columns
    ])


def _ordered(df: DataFrame, table: str) -> DataFrame:
    return project_known(df, TABLES[table].data_columns)


def parse_dvf(raw: DataFrame) -> DataFrame:
    """Transactions: decimal commas, blanks in numbers, year of the deed."""
    known = project_known(raw, [c for c in TABLES["raw_dvf"].data_columns if c != "annee"])
    df = _typed(known, "raw_dvf", tx.fr_number)
    if "date_mutation" in df.columns:
        df = df.withColumn("annee", F.year("date_mutation"))
    return _ordered(df, "raw_dvf")


def parse_dpe(raw: DataFrame) -> DataFrame:
    """Energy certificates: renamed, with year and department."""
    df = _typed(rename_to_schema(raw, DPE_NAMES), "raw_dpe")
    if "date_etablissement_dpe" in df.columns:
        df = df.withColumn("annee", F.year("date_etablissement_dpe"))
    if "code_commune" in df.columns:
        df = df.withColumn("code_departement", tx.dept_from_commune("code_commune"))
    return _ordered(df, "raw_dpe")


def parse_sitadel(raw: DataFrame, since: tuple[int, int] | None = None) -> DataFrame:
    """Permits: renamed, with department, optionally only after a month."""
    df = _typed(rename_to_schema(raw, SITADEL_NAMES), "raw_sitadel")
    if "code_commune" in df.columns:
        df = df.withColumn("code_departement", tx.dept_from_commune("code_commune"))
    if since and {"annee", "mois"} <= set(df.columns):
        df = since_year_month(df, since)
    return _ordered(df, "raw_sitadel")


def parse_ecln(raw: DataFrame, since: str | None = None) -> DataFrame:
    """New-build sales: quarter split in two, optionally only after a quarter."""
    df = rename_to_schema(raw, ECLN_NAMES)
    if "periode" in df.columns:
        if since:
            df = since_quarter(df, "periode", since)
        year, quarter = tx.split_quarter("periode")
        df = df.withColumns({"annee": year, "trimestre": quarter}).drop("periode")
    return _ordered(_typed(df, "raw_ecln"), "raw_ecln")


def parse_eptb(land: DataFrame, houses: DataFrame) -> DataFrame:
    """Land and house prices side by side; a missing side is NULL.

    A missing part of a zone's key is blank on both sides, so its halves meet.
    """
    zone = list(ZONE_NAMES.values())
    sides = [
        df.withColumns({c: tx.blank_null(c) for c in zone if c in df.columns})
        for df in (rename_to_schema(land, LAND_NAMES), rename_to_schema(houses, HOUSE_NAMES))
    ]
    both = sides[0].join(sides[1], zone, "full")
    return _ordered(_typed(both, "raw_eptb"), "raw_eptb")


def parse_rpls(raw: DataFrame, annee: int) -> DataFrame:
    """Social housing of one vintage."""
    df = rename_to_schema(raw, RPLS_NAMES).withColumn("annee", F.lit(int(annee)))
    return _ordered(_typed(df, "raw_rpls"), "raw_rpls")


def vintage_year(vintage: str) -> int:
    return int(vintage[:4])


def parse_insee(raw: DataFrame) -> DataFrame:
    """Income and demography: decimal commas, 'ND' is missing."""
    known = project_known(raw, TABLES["raw_insee_communes"].data_columns)
    return _typed(known, "raw_insee_communes", tx.comma_number)


def parse_macro(raw: DataFrame, since: str | None = None) -> DataFrame:
    """Interest rates: rows without a date are dropped, optionally only after a month."""
    known = project_known(
        raw, [c for c in TABLES["raw_macro_taux"].data_columns if c not in ("annee", "mois")]
    )
    if "date" in known.columns:
        known = known.withColumn("date", tx.to_date_or_null("date", "yyyy-MM", "dd/MM/yyyy", "yyyy/MM/dd"))
    df = _typed(known, "raw_macro_taux", tx.comma_number)
    if "date" in df.columns:
        df = drop_null(df, ["date"])
        if since:
            df = since_month(df, "date", since)
        df = df.withColumns({"annee": F.year("date"), "mois": F.month("date")})
    return _ordered(df, "raw_macro_taux")
