"""Facts, dimensions and market reports of the warehouse.

Every function takes staged or derived tables and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.functions.numeric import mean, rate, round_he, settle, share
from terrier.operators.aggregates import (
    coarsen, constants, count_by_value, count_rows, count_where,
)
from terrier.operators.joins import left_enrich, merge_contexts, one_row_per_key, with_defaults
from terrier.operators.quantiles import GROUP_LIMIT, ROW, aggregate_with_quantiles
from terrier.operators.rows import category_filter, positive_filter, require_key

# Categories of the sources.
ALL_PERMITS = "Tous Logements"
ALL_NEW_BUILD = "Tous logements"
FLAT = "Appartement"
HOUSE = "Maison"
ENERGY_LABELS = ("A", "B", "C", "D", "E", "F", "G")
LEAKY_LABELS = ("F", "G")
FUNDINGS = ("PLAI", "PLUS", "PLS")

# Right-hand columns that are 0 or '' rather than NULL without a match.
JOIN_DEFAULTS: dict[str, object] = {
    "nb_dpe_total": 0,
    "pct_passoires_thermiques": 0.0,
    "nb_entrees_ls": 0,
    "nb_plai": 0,
    "nb_plus": 0,
    "nb_pls": 0,
    "pct_passoires_ls": 0.0,
    "code_region": "",
}

COMMUNE_YEAR = ["annee", "code_commune"]
DEPT_YEAR = ["annee", "code_departement"]
COMMUNE_GRAIN = [*COMMUNE_YEAR, "code_departement"]


# --- core facts and dimensions -------------------------------------------------

def fct_transactions(stg_dvf: DataFrame) -> DataFrame:
    """Sold lots with a surface and a price, and the price per square metre."""
    sold = positive_filter(stg_dvf, ["valeur_fonciere", "surface_reelle_bati"], ["type_local"])
    price = settle(F.col("valeur_fonciere") / F.col("surface_reelle_bati"), 2)
    return sold.drop("adresse_numero").withColumn("prix_m2", price)


def fct_dpe_commune(stg_dpe: DataFrame) -> DataFrame:
    """Energy labels and consumption by commune and year."""
    rated = positive_filter(stg_dpe, ["surface_habitable_logement"], ["etiquette_dpe"])
    labels = {label: f"nb_dpe_{label.lower()}" for label in ENERGY_LABELS}
    return rated.groupBy(*COMMUNE_GRAIN).agg(
        *count_by_value("etiquette_dpe", labels),
        count_rows("nb_dpe_total"),
        share(F.col("etiquette_dpe").isin(*LEAKY_LABELS)).alias("pct_passoires_thermiques"),
        mean("consommation_energie_primaire", 1).alias("conso_ep_moy"),
        mean("consommation_energie_finale", 1).alias("conso_ef_moy"),
        mean("emission_ges", 1).alias("emission_ges_moy"),
        mean("surface_habitable_logement", 1).alias("surface_moy"),
    )


def fct_construction(stg_sitadel: DataFrame) -> DataFrame:
    """Permits and starts by commune and year, from the line that totals all kinds."""
    yearly = category_filter(stg_sitadel, "type_logement", ALL_PERMITS).groupBy(*COMMUNE_GRAIN).agg(
        F.sum("nb_logements_autorises").alias("nb_autorises"),
        F.sum("nb_logements_commences").alias("nb_commences"),
        settle(F.sum("surface_autorisee"), 6).alias("surface_autorisee"),
        settle(F.sum("surface_commencee"), 6).alias("surface_commencee"),
    )
    return yearly.withColumn("taux_concretisation", rate("nb_commences", "nb_autorises", 1, 100.0))


def fct_logement_social(stg_rpls: DataFrame, fundings: tuple[str, ...] = FUNDINGS) -> DataFrame:
    """Social housing by commune and vintage."""
    leaky = F.col("classe_energie_dpe").isin(*LEAKY_LABELS)
    return stg_rpls.groupBy(*COMMUNE_GRAIN).agg(
        count_rows("nb_entrees_ls"),
        *count_by_value("financement", {f: f"nb_{f.lower()}" for f in fundings}),
        count_where(leaky, "nb_passoires_ls"),
        share(leaky).alias("pct_passoires_ls"),
        mean("surface", 1).alias("surface_moy_ls"),
        mean("nb_pieces", 1).alias("nb_pieces_moy_ls"),
        mean("annee_construction", 0).alias("annee_construction_moy_ls"),
    )


def fct_marche_neuf(stg_ecln: DataFrame) -> DataFrame:
    """New-build market by quarter and department with the reservation rate."""
    return category_filter(stg_ecln, "type_logement", ALL_NEW_BUILD).select(
        "annee", "trimestre", "code_departement", "nb_mises_en_vente", "nb_reservations",
        "nb_annulations", "stock", "delai_ecoulement", F.col("prix_m2").alias("prix_m2_neuf"),
        "prix_moyen_individuel",
        rate("nb_reservations", "nb_mises_en_vente", 1, 100.0).alias("taux_reservation"),
    )


def fct_prix_terrain(stg_eptb: DataFrame) -> DataFrame:
    """Land and house prices, as staged."""
    return stg_eptb


def dim_commune(stg_dvf: DataFrame, stg_rpls: DataFrame) -> DataFrame:
    """One row per commune with its region."""
    named = constants(
        require_key(stg_dvf, "code_commune"), "code_commune",
        ["nom_commune", "code_departement", "code_postal"],
    )
    regions = constants(require_key(stg_rpls, "code_commune"), "code_commune", ["code_region"])
    return left_enrich(named, regions, ["code_commune"], JOIN_DEFAULTS)


def dim_departement(stg_ecln: DataFrame) -> DataFrame:
    """One label per department."""
    known = require_key(stg_ecln, "code_departement")
    return constants(known, "code_departement", ["libelle_departement"])


# --- intermediate ----------------------------------------------------------------

def int_ecln_dept_annee(marche_neuf: DataFrame) -> DataFrame:
    """New-build market by year: flows summed, levels averaged, then the rate."""
    yearly = coarsen(
        marche_neuf, DEPT_YEAR,
        flows=["nb_mises_en_vente", "nb_reservations", "nb_annulations"],
        levels={
            "stock": ("stock_moy", 0),
            "delai_ecoulement": ("delai_ecoulement_moy", 1),
            "prix_m2_neuf": ("prix_m2_neuf_moy", 0),
            "prix_moyen_individuel": ("prix_moyen_individuel_moy", 0),
        },
        count_name="nb_trimestres",
    )
    return yearly.withColumn(
        "taux_reservation", rate("nb_reservations", "nb_mises_en_vente", 1, 100.0)
    )


def int_rpls_commune(logement_social: DataFrame) -> DataFrame:
    """Social housing, exposed for joins."""
    return logement_social


def int_sitadel_commune(construction: DataFrame) -> DataFrame:
    """Construction, exposed for joins."""
    return construction


# --- enrichment --------------------------------------------------------------------

DPE_CONTEXT = ["nb_dpe_total", "pct_passoires_thermiques", "conso_ep_moy", "conso_ef_moy",
               "emission_ges_moy"]
SOCIAL_CONTEXT = ["nb_entrees_ls", "nb_plai", "nb_plus", "nb_pls", "pct_passoires_ls",
                  "surface_moy_ls", "nb_pieces_moy_ls"]
PERMIT_CONTEXT = ["nb_autorises", "nb_commences", "taux_concretisation"]
NEW_BUILD_CONTEXT = ["prix_m2_neuf_moy", "stock_moy", "delai_ecoulement_moy", "taux_reservation",
                     "nb_mises_en_vente", "nb_reservations"]


def commune_context(dpe: DataFrame, social: DataFrame, permits: DataFrame) -> DataFrame:
    """Everything known of a commune in a year, one row each."""
    sides = [
        one_row_per_key(side.select(*COMMUNE_YEAR, *columns), COMMUNE_YEAR)
        for side, columns in (
            (dpe, DPE_CONTEXT), (social, SOCIAL_CONTEXT), (permits, PERMIT_CONTEXT),
        )
    ]
    return merge_contexts(sides, COMMUNE_YEAR)


def enrich(spine: DataFrame, communes: DataFrame, ecln_year: DataFrame, salts: int = 1) -> DataFrame:
    """Add commune and department context to rows that carry year, commune, department."""
    depts = ecln_year.select(*DEPT_YEAR, *NEW_BUILD_CONTEXT)
    joined = left_enrich(spine, communes, COMMUNE_YEAR, JOIN_DEFAULTS, salts)
    return left_enrich(joined, depts, DEPT_YEAR, salts=salts)


ENRICHED_COLUMNS = [
    "id_mutation", "id_parcelle", "date_mutation", "annee", "nature_mutation",
    "code_commune", "nom_commune", "code_departement", "code_postal", "adresse_nom_voie",
    "latitude", "longitude",
    "type_local", "surface_reelle_bati", "nombre_pieces_principales", "surface_terrain",
    "valeur_fonciere", "prix_m2",
    *DPE_CONTEXT, *SOCIAL_CONTEXT, *PERMIT_CONTEXT, *NEW_BUILD_CONTEXT,
]


def fct_transactions_enriched(
    transactions: DataFrame, dpe: DataFrame, social: DataFrame, permits: DataFrame,
    ecln_year: DataFrame, salts: int = 1,
) -> DataFrame:
    """Every transaction with its local context, 39 columns.

    The three commune contexts are merged before the transactions see them: one
    join on (year, commune) instead of three.
    """
    return enriched_transactions(
        transactions, commune_context(dpe, social, permits), ecln_year, salts)


def enriched_transactions(
    transactions: DataFrame, communes: DataFrame, ecln_year: DataFrame, salts: int = 1
) -> DataFrame:
    """The same over contexts that are merged, and best written, already."""
    return enrich(transactions, communes, ecln_year, salts).select(*ENRICHED_COLUMNS)


# --- reports -----------------------------------------------------------------------

def rpt_prix_commune(transactions: DataFrame) -> DataFrame:
    """Price statistics by year, commune and kind of property."""
    keys = [*COMMUNE_YEAR, "nom_commune", "code_departement", "type_local"]
    parts = {
        "nb_transactions": F.count(ROW),
        "prix_m2_moyen": mean("prix_m2", 0),
        "prix_m2_min": round_he(F.min("prix_m2"), 0),
        "prix_m2_max": round_he(F.max("prix_m2"), 0),
        "prix_moyen": mean("valeur_fonciere", 0),
        "surface_moy": mean("surface_reelle_bati", 1),
        "nb_pieces_moy": mean("nombre_pieces_principales", 1),
    }
    quartiles = {"prix_m2_median": 0.5, "prix_m2_q1": 0.25, "prix_m2_q3": 0.75}
    return aggregate_with_quantiles(
        transactions, keys, parts, "prix_m2", quartiles, 0, whole=GROUP_LIMIT)


def _permits_by_dept(construction: DataFrame) -> DataFrame:
    return construction.groupBy(*DEPT_YEAR).agg(
        F.sum("nb_autorises").alias("nb_autorises"), F.sum("nb_commences").alias("nb_commences")
    )


def rpt_dynamique_marche_dept(
    transactions: DataFrame, ecln_year: DataFrame, construction: DataFrame, dpe: DataFrame,
    departements: DataFrame,
) -> DataFrame:
    """Resale, new-build, construction and energy by year and department.

    Each side is aggregated to the report's grain before the joins. The
    transactions are read twice: pass a table.
    """
    parts = {
        "nb_transactions": F.count(ROW),
        "prix_m2_moyen_ancien": mean("prix_m2", 0),
        "surface_moy": mean("surface_reelle_bati", 1),
    }
    old = aggregate_with_quantiles(
        transactions, DEPT_YEAR, parts, "prix_m2", {"prix_m2_median_ancien": 0.5}, 0
    )
    energy = dpe.groupBy(*DEPT_YEAR).agg(
        rate(F.sum(F.col("nb_dpe_f") + F.col("nb_dpe_g")), F.sum("nb_dpe_total"), 1, 100.0)
        .alias("pct_passoires"),
        mean("conso_ep_moy", 1).alias("conso_ep_moy"),
        mean("emission_ges_moy", 1).alias("emission_ges_moy"),
        F.sum("nb_dpe_total").alias("nb_dpe_total"),
    )
    new = ecln_year.select(*DEPT_YEAR, *NEW_BUILD_CONTEXT)
    joined = old.join(departements, "code_departement", "left")
    for side in (new, _permits_by_dept(construction), energy):
        joined = joined.join(side, DEPT_YEAR, "left")
    joined = with_defaults(joined, JOIN_DEFAULTS)
    return joined.select(
        *DEPT_YEAR, "libelle_departement", "nb_transactions", "prix_m2_moyen_ancien",
        "prix_m2_median_ancien", "surface_moy", *NEW_BUILD_CONTEXT,
        rate("prix_m2_neuf_moy", "prix_m2_moyen_ancien", 2).alias("ratio_prix_neuf_ancien"),
        "nb_autorises", "nb_commences", "pct_passoires", "conso_ep_moy", "emission_ges_moy",
        "nb_dpe_total",
    )


def rpt_tension_immobiliere_dept(
    transactions: DataFrame, ecln_year: DataFrame, construction: DataFrame, social: DataFrame,
    departements: DataFrame,
) -> DataFrame:
    """Demand and supply by year and department."""
    parts = {
        "nb_ventes": F.count(ROW),
        "nb_ventes_appt": F.count_if(F.col("type_local") == FLAT),
        "nb_ventes_maison": F.count_if(F.col("type_local") == HOUSE),
        "prix_m2_moy": mean("prix_m2", 0),
        "surface_moy": mean("surface_reelle_bati", 1),
    }
    demand = aggregate_with_quantiles(
        transactions, DEPT_YEAR, parts, "prix_m2", {"prix_m2_med": 0.5}, 0
    )
    housing = social.groupBy(*DEPT_YEAR).agg(
        F.sum("nb_entrees_ls").alias("nb_entrees_ls"),
        mean("pct_passoires_ls", 1).alias("pct_passoires_ls"),
    )
    new = ecln_year.select(*DEPT_YEAR, *NEW_BUILD_CONTEXT).withColumnRenamed(
        "stock_moy", "stock_neuf_moy"
    )
    joined = demand.join(departements, "code_departement", "left")
    for side in (new, _permits_by_dept(construction), housing):
        joined = joined.join(side, DEPT_YEAR, "left")
    return with_defaults(joined, JOIN_DEFAULTS)


def rpt_performance_energetique_dept(dpe: DataFrame, departements: DataFrame) -> DataFrame:
    """Energy labels by year and department, rolled up from the communes."""
    counts = [f"nb_dpe_{label.lower()}" for label in ENERGY_LABELS] + ["nb_dpe_total"]
    levels = ("conso_ep_moy", "conso_ef_moy", "emission_ges_moy", "surface_moy")
    rolled = dpe.groupBy(*DEPT_YEAR).agg(
        *[F.sum(c).alias(c) for c in counts], *[mean(c, 1).alias(c) for c in levels]
    )
    good = F.col("nb_dpe_a") + F.col("nb_dpe_b") + F.col("nb_dpe_c")
    leaky = F.col("nb_dpe_f") + F.col("nb_dpe_g")
    rolled = rolled.withColumns({
        "pct_bonne_classe": rate(good, "nb_dpe_total", 1, 100.0),
        "pct_passoires": rate(leaky, "nb_dpe_total", 1, 100.0),
    })
    return rolled.join(departements, "code_departement", "left")
