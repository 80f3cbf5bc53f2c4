"""Monthly feature panel and cross-section per commune."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.functions.numeric import cyclic, mean, rate, share
from terrier.operators.aggregates import latest_of
from terrier.operators.quantiles import GROUP_LIMIT, ROW, aggregate_with_quantiles
from terrier.operators.rows import min_group_size, open_range
from terrier.operators.sampling import hash_sample
from terrier.operators.windows import lags, pct_changes, rolling_means, series
from terrier.plans.warehouse import FLAT, HOUSE, enrich

PANEL_CONTEXT = [
    "nb_dpe_total", "pct_passoires_thermiques", "conso_ep_moy", "conso_ef_moy",
    "emission_ges_moy", "nb_autorises", "nb_commences", "taux_concretisation",
    "nb_entrees_ls", "pct_passoires_ls", "surface_moy_ls", "prix_m2_neuf_moy", "stock_moy",
    "delai_ecoulement_moy", "taux_reservation", "nb_mises_en_vente", "nb_reservations",
]

# Names of the cross-section columns that differ from the panel's.
SECTION_NAMES = {
    "nb_entrees_ls": "nb_logements_sociaux",
    "prix_m2_neuf_moy": "prix_m2_neuf_dept",
    "stock_moy": "stock_neuf_dept",
    "delai_ecoulement_moy": "delai_ecoulement_dept",
    "taux_reservation": "taux_reservation_dept",
    "nb_mises_en_vente": "nb_mises_en_vente_dept",
}

MONTH_GRAIN = ["annee", "mois", "code_commune", "code_departement"]


def _sold(digits: int) -> dict[str, Column]:
    """Aggregates of the sold lots."""
    return {
        "prix_m2_moy": mean("prix_m2", digits),
        "surface_moy": mean("surface_reelle_bati", 1),
        "nb_pieces_moy": mean("nombre_pieces_principales", 1),
        "pct_appt": share(F.col("type_local") == FLAT, of=ROW),
        "pct_maison": share(F.col("type_local") == HOUSE, of=ROW),
    }


def monthly_means(transactions: DataFrame) -> DataFrame:
    """The mean price of the panel alone: one aggregate, without the quantiles and the mix."""
    priced = transactions.where("prix_m2 > 0").withColumn("mois", F.month("date_mutation"))
    return priced.groupBy(*MONTH_GRAIN).agg(mean("prix_m2", 2).alias("prix_m2_moy"))


def panel_commune_mois(
    transactions: DataFrame, communes: DataFrame | None = None, ecln_year: DataFrame | None = None,
) -> DataFrame:
    """Target and context by commune and month; months without sales are absent.

    The context depends on commune and year only, so it is joined to the panel
    and not to every transaction: the join sees one row per group.
    """
    priced = transactions.where("prix_m2 > 0").withColumn("mois", F.month("date_mutation"))
    parts = {"nb_transactions": F.count(ROW), **_sold(2)}
    quantiles = {"prix_m2_med": 0.5, "prix_m2_p10": 0.1, "prix_m2_p90": 0.9}
    panel = aggregate_with_quantiles(priced, MONTH_GRAIN, parts, "prix_m2", quantiles, 2, whole=GROUP_LIMIT)
    if communes is not None:
        kept = [*panel.columns, *PANEL_CONTEXT]
        panel = enrich(panel, communes, ecln_year).select(*kept)
    sine, cosine = cyclic("mois", 12)
    return panel.withColumns({
        "date_mois": F.make_date(F.col("annee"), F.col("mois"), F.lit(1)),
        "mois_sin": sine,
        "mois_cos": cosine,
    })


def rpt_features_commune_mois(panel: DataFrame, entity: str = "code_commune") -> DataFrame:
    """Panel with lags, rolling means and momentum of the mean price."""
    w = series(entity, "annee", "mois")
    price = "prix_m2_moy"
    return panel.withColumns({
        **lags(price, w, {k: f"prix_m2_lag_{k}m" for k in (1, 3, 6, 12)}),
        **rolling_means(price, w, {k: f"prix_m2_roll{k}m" for k in (3, 6, 12)}),
        **pct_changes(price, w, {k: f"evol_{k}m_pct" for k in (1, 12)}),
    })


def rpt_shap_commune(
    transactions: DataFrame, communes: DataFrame, ecln_year: DataFrame,
    low: float = 500, high: float = 30000, minimum: int = 20, months: float = 60.0,
) -> DataFrame:
    """Cross-section: one row per commune with enough plausible sales.

    Context columns take the value of the latest year of sales that has one.
    """
    keys = ["code_commune", "code_departement"]
    plausible = open_range(transactions, "prix_m2", low, high)
    parts = {
        "nb_transactions_total": F.count(ROW),
        **_sold(0),
        "annee_min": F.min("annee"),
        "annee_max": F.max("annee"),
    }
    quantiles = {"prix_m2_med": 0.5, "prix_m2_q25": 0.25, "prix_m2_q75": 0.75}
    base = aggregate_with_quantiles(plausible, keys, parts, "prix_m2", quantiles, 0, whole=GROUP_LIMIT)
    base = min_group_size(base, "nb_transactions_total", minimum).withColumn(
        "transactions_par_mois", rate("nb_transactions_total", F.lit(float(months)), 1)
    )
    years = plausible.select(*keys, "annee").distinct()
    kept = [c for c in PANEL_CONTEXT if c != "nb_reservations"]
    context = enrich(years, communes, ecln_year).groupBy(*keys).agg(
        *[latest_of(c, "annee", SECTION_NAMES.get(c, c)) for c in kept]
    )
    return base.join(context, keys, "left")


def rpt_shap_sample(features: DataFrame, minimum: int = 5, buckets: int = 20) -> DataFrame:
    """One row in ``buckets`` with a full year of history and enough sales."""
    full = features.where(
        F.col("prix_m2_lag_12m").isNotNull()
        & (F.col("nb_transactions") >= minimum)
        & (F.col("prix_m2_moy") > 0)
    )
    return hash_sample(full, ["code_commune", "annee", "mois"], buckets)
