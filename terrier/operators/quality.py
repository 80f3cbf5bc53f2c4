"""Declared data checks; each gives one row (check, table, column, failures)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import cut_lineage

SHAPE = ["check", "table", "column", "failures"]


def row_checks(
    df: DataFrame, table: str, known: list[str], accepted: dict[str, list] | None = None
) -> DataFrame:
    """All checks of single rows in one pass: missing and unexpected values."""
    wrong = [("not_null", c, F.col(c).isNull()) for c in known]
    wrong += [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in (accepted or {}).items()]
    counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(wrong)])
    lines = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"),
                 F.lit(column).alias("column"), F.col(f"_{i}").alias("failures"))
        for i, (check, column, _) in enumerate(wrong)
    ])
    return counts.select(F.inline(lines))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Missing values of all columns in one pass."""
    return row_checks(df, table, columns)


def accepted_values(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Rows with a value outside the list; NULLs pass."""
    return row_checks(df, table, [], {column: values})


def _repeated(df: DataFrame, check: str, table: str, keys: list[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        F.lit(",".join(keys)).alias("column"), "failures",
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not values."""
    return _repeated(df.where(F.col(column).isNotNull()), "unique", table, [column])


def unique_grain(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return _repeated(df, "unique_grain", table, keys)


def quality_report(checks: list[DataFrame]) -> DataFrame:
    """All checks in one table."""
    return reduce(lambda a, b: a.unionByName(b), checks).select(*SHAPE)


def check_once(
    df: DataFrame, table: str, known: list[str] = (), accepted: dict[str, list] | None = None,
    unique_columns: list[str] = (), grains: list[list[str]] = (),
) -> DataFrame:
    """All checks of one table in one pass over it, the same lines as the single checks.

    Every row gives one cell for each check of single rows that it fails, and the hash of
    its key for each key that must be unique; equal cells are counted, combined before the
    shuffle. Only keys whose hash came twice are counted exactly, in a second look at the
    rows with these hashes; a table without repeats is read once.
    """
    wrong = [("not_null", c, F.col(c).isNull()) for c in known]
    wrong += [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in (accepted or {}).items()]
    keys = [("unique", [c], F.col(c).isNotNull()) for c in unique_columns]
    keys += [("unique_grain", list(g), F.lit(True)) for g in grains]

    def cell(i: int, when, value):
        return F.when(when, F.struct(F.lit(i).alias("i"), value.alias("h")))

    cells = [cell(i, bad, F.lit(0).cast("long")) for i, (_, _, bad) in enumerate(wrong)]
    cells += [cell(len(wrong) + j, there, F.xxhash64(*k)) for j, (_, k, there) in enumerate(keys)]
    each = df.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("_c"))
    counted = each.groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).select("_c.i", "_c.h", "_n")
    found = cut_lineage(counted.where((F.col("i") < len(wrong)) | (F.col("_n") > 1)), "checks")
    seen = {r["i"] for r in found.select("i").distinct().collect()}  # at most one row per check

    lines = []
    for i, (check, column, _) in enumerate(wrong):
        total = found.where(F.col("i") == i).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
        lines.append((check, column, total if i in seen else None))
    for j, (check, k, there) in enumerate(keys, len(wrong)):
        repeats = found.where(F.col("i") == j).select(F.col("h").alias("_h"))
        again = df.where(there).join(repeats, F.xxhash64(*k) == F.col("_h"), "left_semi")
        groups = again.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
        exact = groups.agg(F.count_if(F.col("_n") > 1).alias("failures"))
        lines.append((check, ",".join(k), exact if j in seen else None))
    clean = [(check, table, column) for check, column, rows in lines if rows is None]
    pages = [df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("check"), F.lit(b).alias("table"), F.lit(c).alias("column"),
                 F.lit(0).cast("long").alias("failures")) for a, b, c in clean])))] if clean else []
    pages += [
        rows.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                    F.lit(column).alias("column"), F.col("failures").cast("long").alias("failures"))
        for check, column, rows in lines if rows is not None]
    return quality_report(pages)


# The declared checks of the warehouse tables.
DECLARED: dict[str, dict] = {
    "stg_dvf": {"not_null": ["date_mutation", "annee", "code_departement"]},
    "stg_dpe": {
        "not_null": ["numero_dpe", "date_etablissement_dpe", "code_departement"],
        "unique": ["numero_dpe"],
        "accepted": {"etiquette_dpe": ["A", "B", "C", "D", "E", "F", "G"]},
    },
    "stg_sitadel": {"not_null": ["annee", "mois", "code_commune"]},
    "stg_ecln": {"not_null": ["annee", "trimestre", "code_departement"]},
    "stg_eptb": {"not_null": ["annee"]},
    "stg_rpls": {"not_null": ["annee", "code_commune"]},
    "fct_transactions": {
        "not_null": ["id_mutation", "date_mutation", "prix_m2", "type_local", "code_departement"],
        "accepted": {"type_local": [
            "Appartement", "Maison", "Local industriel. commercial ou assimilé", "Dépendance"]},
    },
    "dim_commune": {
        "not_null": ["code_commune", "nom_commune", "code_departement"], "unique": ["code_commune"],
    },
    "dim_departement": {
        "not_null": ["code_departement", "libelle_departement"], "unique": ["code_departement"],
    },
    "fct_construction": {
        "not_null": ["annee", "code_commune"], "grain": [["annee", "code_commune"]],
    },
    "fct_marche_neuf": {
        "not_null": ["annee", "trimestre", "code_departement"],
        "grain": [["annee", "trimestre", "code_departement"]],
    },
    "fct_logement_social": {
        "not_null": ["annee", "code_commune"], "grain": [["annee", "code_commune"]],
    },
    "fct_prix_terrain": {
        "not_null": ["annee", "zone_code"], "grain": [["annee", "zone_code"]],
    },
    "fct_transactions_enriched": {"not_null": ["id_mutation", "prix_m2", "code_departement"]},
    "fct_dpe_commune": {
        "not_null": ["annee", "code_commune", "nb_dpe_total"], "grain": [["annee", "code_commune"]],
    },
    "int_ecln_dept_annee": {
        "not_null": ["annee", "code_departement"], "grain": [["annee", "code_departement"]],
    },
    "int_rpls_commune": {
        "not_null": ["annee", "code_commune"], "grain": [["annee", "code_commune"]],
    },
    "int_sitadel_commune": {
        "not_null": ["annee", "code_commune"], "grain": [["annee", "code_commune"]],
    },
    "rpt_dynamique_marche_dept": {
        "not_null": ["annee", "code_departement"], "grain": [["annee", "code_departement"]],
    },
    "rpt_performance_energetique_dept": {
        "not_null": ["annee", "code_departement"], "grain": [["annee", "code_departement"]],
    },
    "rpt_tension_immobiliere_dept": {
        "not_null": ["annee", "code_departement"], "grain": [["annee", "code_departement"]],
    },
    "rpt_prix_commune": {
        "not_null": ["annee", "code_commune", "type_local"],
        "grain": [["annee", "code_commune", "type_local"]],
    },
}


def declared_checks(df: DataFrame, table: str) -> DataFrame:
    """The declared checks of one table, in one pass."""
    rules = DECLARED[table]
    return check_once(
        df, table, rules["not_null"], rules.get("accepted"), rules.get("unique", []),
        rules.get("grain", []))
