"""Named building blocks of the comparison SQL."""

from __future__ import annotations

import re

from terrier.catalogue import roles
from terrier.catalogue.roles import quantile, ratio, rnd, rnd_once
from terrier.sources.schemas import TABLES

LABELS = "ABCDEFG"


def newest(table: str, key: str | None, blanks: tuple[str, ...], have: set[str] | None = None) -> str:
    """SQL of a staging view."""
    spec = TABLES[table]
    cols = [c for c in spec.data_columns]
    picked = ", ".join(f"nullif({c}, '') AS {c}" if c in blanks else c for c in cols)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in (spec.version, *spec.all_ties))
    where = f"WHERE {key} <> ''" if key else ""
    return (
        f"SELECT {picked} FROM {table} {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(spec.keys)} ORDER BY {order}) = 1"
    )


def pct(pred: str, digits: int = 1) -> str:
    return ratio(f"count(*) FILTER ({pred})", "count(*)", digits, 100)


def avg(expr: str, digits: int) -> str:
    return rnd(f"avg({expr})", digits)


_NEW_BUILD = ("prix_m2_neuf_moy, stock_moy, delai_ecoulement_moy, taux_reservation, "
              "nb_mises_en_vente, nb_reservations")

BLOCKS: dict[str, str] = {
    "raw_dvf": roles.RAW_DVF,
    "raw_dpe": roles.RAW_DPE,
    "raw_sitadel_": roles.RAW_SITADEL,
    "raw_sitadel": "SELECT *, make_date(annee, mois, 1) AS _loaded_at FROM raw_sitadel_",
    "raw_ecln_": roles.RAW_ECLN,
    "raw_ecln": "SELECT *, make_date(annee, trimestre, 1) AS _loaded_at FROM raw_ecln_",
    "raw_rpls": roles.RAW_RPLS,
    "raw_eptb_": roles.RAW_EPTB,
    "raw_eptb": "SELECT *, make_date(annee, 1, 1) AS _loaded_at FROM raw_eptb_",
    "stg_dvf": newest("raw_dvf", "id_mutation", ("type_local",)),
    "stg_dpe": newest("raw_dpe", "numero_dpe", (
        "etiquette_dpe", "type_energie_principale_chauffage", "type_installation_chauffage",
        "periode_construction", "type_batiment")),
    "stg_sitadel": newest("raw_sitadel", "code_commune", ("type_logement",)),
    "stg_ecln": newest("raw_ecln", "code_departement", ("libelle_departement", "type_logement")),
    "stg_eptb": newest("raw_eptb", None, ("zone_code", "zone_libelle")),
    "stg_rpls": newest("raw_rpls", "code_commune", ("financement", "classe_energie_dpe")),
    "fct_transactions": (
        "SELECT * EXCLUDE (adresse_numero), "
        f"{rnd('valeur_fonciere / surface_reelle_bati', 2)} AS prix_m2 FROM stg_dvf "
        "WHERE valeur_fonciere > 0 AND surface_reelle_bati > 0 AND type_local IS NOT NULL"
    ),
    "fct_dpe_commune": (
        "SELECT annee, code_commune, code_departement, "
        + ", ".join(f"count(*) FILTER (etiquette_dpe = '{x}') AS nb_dpe_{x.lower()}" for x in LABELS)
        + ", count(*) AS nb_dpe_total, "
        f"{pct('''etiquette_dpe IN ('F', 'G')''')} AS pct_passoires_thermiques, "
        f"{avg('consommation_energie_primaire', 1)} AS conso_ep_moy, "
        f"{avg('consommation_energie_finale', 1)} AS conso_ef_moy, "
        f"{avg('emission_ges', 1)} AS emission_ges_moy, "
        f"{avg('surface_habitable_logement', 1)} AS surface_moy FROM stg_dpe "
        "WHERE etiquette_dpe IS NOT NULL AND surface_habitable_logement > 0 GROUP BY ALL"
    ),
    "fct_construction": (
        "SELECT *, " + ratio("nb_commences", "nb_autorises", 1, 100) + " AS taux_concretisation "
        "FROM (SELECT annee, code_commune, code_departement, "
        "sum(nb_logements_autorises)::BIGINT AS nb_autorises, "
        "sum(nb_logements_commences)::BIGINT AS nb_commences, "
        "sum(surface_autorisee) AS surface_autorisee, sum(surface_commencee) AS surface_commencee "
        "FROM stg_sitadel WHERE type_logement = 'Tous Logements' GROUP BY ALL)"
    ),
    "fct_logement_social": (
        "SELECT annee, code_commune, code_departement, count(*) AS nb_entrees_ls, "
        + ", ".join(f"count(*) FILTER (financement = '{f}') AS nb_{f.lower()}"
                    for f in ("PLAI", "PLUS", "PLS"))
        + ", count(*) FILTER (classe_energie_dpe IN ('F', 'G')) AS nb_passoires_ls, "
        f"{pct('''classe_energie_dpe IN ('F', 'G')''')} AS pct_passoires_ls, "
        f"{avg('surface', 1)} AS surface_moy_ls, {avg('nb_pieces', 1)} AS nb_pieces_moy_ls, "
        f"{avg('annee_construction', 0)} AS annee_construction_moy_ls FROM stg_rpls GROUP BY ALL"
    ),
    "fct_marche_neuf": (
        "SELECT annee, trimestre, code_departement, nb_mises_en_vente, nb_reservations, "
        "nb_annulations, stock, delai_ecoulement, prix_m2 AS prix_m2_neuf, prix_moyen_individuel, "
        + ratio("nb_reservations", "nb_mises_en_vente", 1, 100)
        + " AS taux_reservation FROM stg_ecln WHERE type_logement = 'Tous logements'"
    ),
    "dim_commune": (
        "SELECT c.*, coalesce(code_region, '') AS code_region FROM ("
        "SELECT code_commune, max(nom_commune) AS nom_commune, "
        "max(code_departement) AS code_departement, max(code_postal) AS code_postal "
        "FROM stg_dvf WHERE code_commune <> '' GROUP BY 1) c LEFT JOIN ("
        "SELECT code_commune, max(code_region) AS code_region FROM stg_rpls "
        "WHERE code_commune <> '' GROUP BY 1) r USING (code_commune)"
    ),
    "dim_departement": (
        "SELECT code_departement, max(libelle_departement) AS libelle_departement FROM stg_ecln "
        "WHERE code_departement <> '' GROUP BY 1"
    ),
    "int_ecln_dept_annee": (
        "SELECT *, " + ratio("nb_reservations", "nb_mises_en_vente", 1, 100)
        + " AS taux_reservation FROM (SELECT annee, code_departement, "
        "sum(nb_mises_en_vente)::BIGINT AS nb_mises_en_vente, "
        "sum(nb_reservations)::BIGINT AS nb_reservations, "
        "sum(nb_annulations)::BIGINT AS nb_annulations, "
        f"{avg('stock', 0)} AS stock_moy, {avg('delai_ecoulement', 1)} AS delai_ecoulement_moy, "
        f"{avg('prix_m2_neuf', 0)} AS prix_m2_neuf_moy, "
        f"{avg('prix_moyen_individuel', 0)} AS prix_moyen_individuel_moy, "
        "count(*) AS nb_trimestres FROM fct_marche_neuf GROUP BY annee, code_departement)"
    ),
    "fct_transactions_enriched": (
        "SELECT t.*, coalesce(nb_dpe_total, 0) AS nb_dpe_total, "
        "coalesce(pct_passoires_thermiques, 0) AS pct_passoires_thermiques, "
        "conso_ep_moy, conso_ef_moy, emission_ges_moy, "
        "coalesce(nb_entrees_ls, 0) AS nb_entrees_ls, coalesce(nb_plai, 0) AS nb_plai, "
        "coalesce(nb_plus, 0) AS nb_plus, coalesce(nb_pls, 0) AS nb_pls, "
        "coalesce(pct_passoires_ls, 0) AS pct_passoires_ls, surface_moy_ls, nb_pieces_moy_ls, "
        f"nb_autorises, nb_commences, taux_concretisation, {_NEW_BUILD} "
        "FROM fct_transactions t "
        "LEFT JOIN fct_dpe_commune d ON t.code_commune = d.code_commune AND t.annee = d.annee "
        "LEFT JOIN fct_logement_social r ON t.code_commune = r.code_commune AND t.annee = r.annee "
        "LEFT JOIN fct_construction s ON t.code_commune = s.code_commune AND t.annee = s.annee "
        "LEFT JOIN int_ecln_dept_annee e "
        "ON t.code_departement = e.code_departement AND t.annee = e.annee"
    ),
    "rpt_prix_commune": (
        "SELECT annee, code_commune, nom_commune, code_departement, type_local, "
        f"count(*) AS nb_transactions, {avg('prix_m2', 0)} AS prix_m2_moyen, "
        f"{quantile('prix_m2', 0.5, 0)} AS prix_m2_median, "
        f"{quantile('prix_m2', 0.25, 0)} AS prix_m2_q1, "
        f"{quantile('prix_m2', 0.75, 0)} AS prix_m2_q3, "
        f"{rnd_once('min(prix_m2)', 0)} AS prix_m2_min, "
        f"{rnd_once('max(prix_m2)', 0)} AS prix_m2_max, {avg('valeur_fonciere', 0)} AS prix_moyen, "
        f"{avg('surface_reelle_bati', 1)} AS surface_moy, "
        f"{avg('nombre_pieces_principales', 1)} AS nb_pieces_moy "
        "FROM fct_transactions GROUP BY ALL"
    ),
    "permits_dept": (
        "SELECT annee, code_departement, sum(nb_autorises)::BIGINT AS nb_autorises, "
        "sum(nb_commences)::BIGINT AS nb_commences FROM fct_construction GROUP BY ALL"
    ),
    "rpt_dynamique_marche_dept": (
        "SELECT a.*, libelle_departement, "
        f"{_NEW_BUILD}, {ratio('prix_m2_neuf_moy', 'prix_m2_moyen_ancien', 2)} "
        "AS ratio_prix_neuf_ancien, nb_autorises, nb_commences, pct_passoires, conso_ep_moy, "
        "emission_ges_moy, coalesce(nb_dpe_total, 0) AS nb_dpe_total FROM ("
        f"SELECT annee, code_departement, count(*) AS nb_transactions, "
        f"{avg('prix_m2', 0)} AS prix_m2_moyen_ancien, "
        f"{quantile('prix_m2', 0.5, 0)} AS prix_m2_median_ancien, "
        f"{avg('surface_reelle_bati', 1)} AS surface_moy FROM fct_transactions GROUP BY ALL) a "
        "LEFT JOIN dim_departement USING (code_departement) "
        "LEFT JOIN int_ecln_dept_annee USING (annee, code_departement) "
        "LEFT JOIN permits_dept USING (annee, code_departement) "
        "LEFT JOIN (SELECT annee, code_departement, "
        + ratio("sum(nb_dpe_f) + sum(nb_dpe_g)", "sum(nb_dpe_total)", 1, 100)
        + f" AS pct_passoires, {avg('conso_ep_moy', 1)} AS conso_ep_moy, "
        f"{avg('emission_ges_moy', 1)} AS emission_ges_moy, "
        "sum(nb_dpe_total)::BIGINT AS nb_dpe_total FROM fct_dpe_commune GROUP BY ALL) "
        "USING (annee, code_departement)"
    ),
    "rpt_tension_immobiliere_dept": (
        "SELECT t.*, libelle_departement, prix_m2_neuf_moy, stock_moy AS stock_neuf_moy, "
        "delai_ecoulement_moy, taux_reservation, nb_mises_en_vente, nb_reservations, "
        "nb_autorises, nb_commences, coalesce(nb_entrees_ls, 0) AS nb_entrees_ls, "
        "coalesce(pct_passoires_ls, 0) AS pct_passoires_ls FROM ("
        "SELECT annee, code_departement, count(*) AS nb_ventes, "
        "count(*) FILTER (type_local = 'Appartement') AS nb_ventes_appt, "
        "count(*) FILTER (type_local = 'Maison') AS nb_ventes_maison, "
        f"{avg('prix_m2', 0)} AS prix_m2_moy, {quantile('prix_m2', 0.5, 0)} AS prix_m2_med, "
        f"{avg('surface_reelle_bati', 1)} AS surface_moy FROM fct_transactions GROUP BY ALL) t "
        "LEFT JOIN dim_departement USING (code_departement) "
        "LEFT JOIN int_ecln_dept_annee USING (annee, code_departement) "
        "LEFT JOIN permits_dept USING (annee, code_departement) "
        "LEFT JOIN (SELECT annee, code_departement, sum(nb_entrees_ls)::BIGINT AS nb_entrees_ls, "
        f"{avg('pct_passoires_ls', 1)} AS pct_passoires_ls FROM fct_logement_social GROUP BY ALL) "
        "USING (annee, code_departement)"
    ),
    "rpt_performance_energetique_dept": (
        "SELECT *, " + ratio("nb_dpe_a + nb_dpe_b + nb_dpe_c", "nb_dpe_total", 1, 100)
        + " AS pct_bonne_classe, " + ratio("nb_dpe_f + nb_dpe_g", "nb_dpe_total", 1, 100)
        + " AS pct_passoires FROM (SELECT annee, code_departement, "
        + ", ".join(f"sum(nb_dpe_{x})::BIGINT AS nb_dpe_{x}" for x in [*LABELS.lower(), "total"])
        + "".join(f", {avg(c, 1)} AS {c}" for c in
                  ("conso_ep_moy", "conso_ef_moy", "emission_ges_moy", "surface_moy"))
        + " FROM fct_dpe_commune GROUP BY annee, code_departement) "
        "LEFT JOIN dim_departement USING (code_departement)"
    ),
}

_CONTEXT = (
    "nb_dpe_total pct_passoires_thermiques conso_ep_moy conso_ef_moy emission_ges_moy "
    "nb_autorises nb_commences taux_concretisation nb_entrees_ls pct_passoires_ls surface_moy_ls "
    "prix_m2_neuf_moy stock_moy delai_ecoulement_moy taux_reservation nb_mises_en_vente "
    "nb_reservations"
).split()


def panel_sql(source: str, context: list[str]) -> str:
    """Panel by commune and month over ``source``."""
    mix = ", ".join(f"{pct(f'''type_local = '{kind}' ''')} AS {name}" for kind, name in
                    (("Appartement", "pct_appt"), ("Maison", "pct_maison")))
    any_of = "".join(f", any_value({c}) AS {c}" for c in context)
    return (
        "SELECT annee, month(date_mutation)::INTEGER AS mois, "
        "make_date(annee, month(date_mutation), 1) AS date_mois, code_commune, code_departement, "
        f"{avg('prix_m2', 2)} AS prix_m2_moy, {quantile('prix_m2', 0.5, 2)} AS prix_m2_med, "
        f"{quantile('prix_m2', 0.1, 2)} AS prix_m2_p10, {quantile('prix_m2', 0.9, 2)} AS prix_m2_p90, "
        f"count(*) AS nb_transactions, {avg('surface_reelle_bati', 1)} AS surface_moy, "
        f"{avg('nombre_pieces_principales', 1)} AS nb_pieces_moy, {mix}{any_of}, "
        f"{rnd_once('sin(2 * pi() * month(date_mutation) / 12)', 6)} AS mois_sin, "
        f"{rnd_once('cos(2 * pi() * month(date_mutation) / 12)', 6)} AS mois_cos "
        f"FROM {source} WHERE prix_m2 > 0 GROUP BY ALL"
    )


def lag_columns(price: str = "prix_m2_moy") -> str:
    return ", ".join(f"lag({price}, {k}) OVER w AS prix_m2_lag_{k}m" for k in (1, 3, 6, 12))


def roll_columns(price: str = "prix_m2_moy", entity: str = "code_commune") -> str:
    return ", ".join(
        rnd(f"avg({price}) OVER (PARTITION BY {entity} ORDER BY annee, mois "
            f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)", 2) + f" AS prix_m2_roll{k}m"
        for k in (3, 6, 12)
    )


def change_columns(price: str = "prix_m2_moy") -> str:
    return ", ".join(
        ratio(f"{price} - lag({price}, {k}) OVER w", f"lag({price}, {k}) OVER w", 2, 100)
        + f" AS evol_{k}m_pct" for k in (1, 12)
    )


_WINDOW = "WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois)"


def features_sql(panel: str) -> str:
    return f"SELECT *, {lag_columns()}, {roll_columns()}, {change_columns()} FROM {panel} {_WINDOW}"


_SECTION = {
    "nb_entrees_ls": "nb_logements_sociaux", "prix_m2_neuf_moy": "prix_m2_neuf_dept",
    "stock_moy": "stock_neuf_dept", "delai_ecoulement_moy": "delai_ecoulement_dept",
    "taux_reservation": "taux_reservation_dept", "nb_mises_en_vente": "nb_mises_en_vente_dept",
}

BLOCKS |= {
    "panel_commune_mois": panel_sql("fct_transactions_enriched", _CONTEXT),
    "rpt_features_commune_mois": features_sql("panel_commune_mois"),
    "rpt_shap_commune": (
        "SELECT code_commune, code_departement, "
        f"{quantile('prix_m2', 0.5, 0)} AS prix_m2_med, {avg('prix_m2', 0)} AS prix_m2_moy, "
        f"{quantile('prix_m2', 0.25, 0)} AS prix_m2_q25, {quantile('prix_m2', 0.75, 0)} AS prix_m2_q75, "
        "count(*) AS nb_transactions_total, "
        f"{pct('''type_local = 'Appartement' ''')} AS pct_appt, "
        f"{pct('''type_local = 'Maison' ''')} AS pct_maison, "
        f"{avg('surface_reelle_bati', 1)} AS surface_moy, "
        f"{avg('nombre_pieces_principales', 1)} AS nb_pieces_moy, "
        f"{ratio('count(*)', '60', 1)} AS transactions_par_mois, "
        + ", ".join(
            f"arg_max({c}, annee) FILTER ({c} IS NOT NULL) AS {_SECTION.get(c, c)}"
            for c in _CONTEXT if c != "nb_reservations")
        + ", min(annee) AS annee_min, max(annee) AS annee_max FROM fct_transactions_enriched "
        "WHERE prix_m2 > 500 AND prix_m2 < 30000 GROUP BY ALL HAVING count(*) >= 20"
    ),
    # one entity per supplier: few entities, a row in nearly every month
    "lots_dense": (
        "SELECT s_suppkey::VARCHAR AS code_commune, s_nationkey::VARCHAR AS code_departement, "
        "l_shipdate::DATE AS date_mutation, year(l_shipdate)::INTEGER AS annee, "
        "CASE l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'R' THEN 'Maison' "
        "ELSE 'Dépendance' END AS type_local, l_quantity AS surface_reelle_bati, "
        "l_linenumber AS nombre_pieces_principales, "
        f"{rnd('l_extendedprice / l_quantity', 2)} AS prix_m2 "
        "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
    ),
    "panel_dense": panel_sql("lots_dense", []),
    "features_dense": features_sql("panel_dense"),
    # the same panel with the context of its commune and department
    "panel_wide": (
        "SELECT p.*, coalesce(pct_passoires_thermiques, 0) AS pct_passoires_thermiques, conso_ep_moy, "
        "nb_commences, taux_concretisation, coalesce(nb_entrees_ls, 0) AS nb_entrees_ls, "
        "prix_m2_neuf_moy, delai_ecoulement_moy FROM panel_dense p "
        "LEFT JOIN fct_dpe_commune d ON p.code_commune = d.code_commune AND p.annee = d.annee "
        "LEFT JOIN fct_logement_social r ON p.code_commune = r.code_commune AND p.annee = r.annee "
        "LEFT JOIN fct_construction s ON p.code_commune = s.code_commune AND p.annee = s.annee "
        "LEFT JOIN int_ecln_dept_annee e "
        "ON p.code_departement = e.code_departement AND p.annee = e.annee"
    ),
    "features_wide": features_sql("panel_wide"),
    # one entity per customer: months without an order are absent
    "panel_sparse": (
        "SELECT o_custkey::VARCHAR AS code_commune, year(o_orderdate)::INTEGER AS annee, "
        "month(o_orderdate)::INTEGER AS mois, "
        f"{avg('o_totalprice', 2)} AS prix, count(*) AS nb, "
        f"{rnd('''avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END)''', 2)} AS prix_f "
        "FROM orders GROUP BY ALL"
    ),
    "grid_sparse": (
        "SELECT code_commune, year(d)::INTEGER AS annee, month(d)::INTEGER AS mois FROM ("
        "SELECT code_commune, unnest(generate_series(min(make_date(annee, mois, 1)), "
        "max(make_date(annee, mois, 1)), INTERVAL 1 MONTH)) AS d FROM panel_sparse GROUP BY 1)"
    ),
}


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` behind a WITH list of the blocks it needs."""
    blocks = {**BLOCKS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in blocks:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(blocks[name]) if blocks[name] is not text else None
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({blocks[n].strip()})" for n in ordered) + "\n" + final


def select(block: str, columns: str = "*") -> str:
    return compose(f"SELECT {columns} FROM {block}")
