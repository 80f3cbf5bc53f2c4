"""Source texts with dirty values, written with expressions both engines read.

Every seventh key or so carries a bad number, a blank, a bad date or a decimal
comma, so the parsers meet what they must tolerate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrier.catalogue.roles import table

NBSP = " "


def cents_text(column: str, mark: str = ",") -> str:
    """A two-digit amount as text with the given decimal mark."""
    c = f"CAST(round({column} * 100) AS BIGINT)"
    return (f"concat(CAST(CAST(floor({c} / 100) AS BIGINT) AS STRING), '{mark}', "
            f"lpad(CAST({c} % 100 AS STRING), 2, '0'))")


def grouped_text(column: str, blank: str) -> str:
    """The amount with a blank before its last three whole digits."""
    c = f"CAST(round({column} * 100) AS BIGINT)"
    return (f"concat(CAST(CAST(floor({c} / 100000) AS BIGINT) AS STRING), '{blank}', "
            f"lpad(CAST(CAST(floor({c} / 100) AS BIGINT) % 1000 AS STRING), 3, '0'), ',', "
            f"lpad(CAST({c} % 100 AS STRING), 2, '0'))")


def iso(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS STRING)"


TEXTS: dict[str, tuple[str, dict[str, str]]] = {
    "dvf_text": ("lineitem", {
        "id_mutation": "CAST(l_orderkey AS STRING)",
        "date_mutation": f"CASE WHEN l_orderkey % 11 = 0 THEN 'not-a-date' ELSE {iso('l_shipdate')} END",
        "nature_mutation": "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE 'Vente' END",
        "valeur_fonciere": (
            "CASE WHEN l_orderkey % 7 = 0 THEN 'N/D' WHEN l_orderkey % 7 = 1 THEN '' "
            f"WHEN l_orderkey % 7 = 2 THEN {grouped_text('l_extendedprice', ' ')} "
            f"WHEN l_orderkey % 7 = 3 THEN {grouped_text('l_extendedprice', NBSP)} "
            f"ELSE {cents_text('l_extendedprice')} END"),
        "code_commune": "CAST(l_suppkey AS STRING)",
        "id_parcelle": "CAST(l_partkey AS STRING)",
        "type_local": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END",
        "surface_reelle_bati": (
            f"CASE WHEN l_orderkey % 7 = 4 THEN '' ELSE {cents_text('l_quantity', '.')} END"),
        "nombre_pieces_principales": (
            "CASE WHEN l_orderkey % 7 = 5 THEN 'trois' WHEN l_orderkey % 7 = 6 "
            "THEN concat(CAST(l_linenumber AS STRING), '.0') ELSE CAST(l_linenumber AS STRING) END"),
        "colonne_inconnue": "l_linestatus",
    }),
    "dpe_text": ("orders", {
        "numero_dpe": "CAST(o_orderkey AS STRING)",
        "date_etablissement_dpe": (
            f"CASE WHEN o_orderkey % 13 = 0 THEN '2024-02-30' ELSE {iso('o_orderdate')} END"),
        "code_insee_ban": (
            "CASE WHEN o_orderkey % 5 = 0 THEN concat('97', lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')) "
            "WHEN o_orderkey % 5 = 1 THEN '2A004' WHEN o_orderkey % 5 = 2 THEN NULL "
            "ELSE lpad(CAST(o_custkey % 95000 AS STRING), 5, '0') END"),
        "etiquette_dpe": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END",
        "conso_5_usages_par_m2_ep": (
            f"CASE WHEN o_orderkey % 7 = 1 THEN 'x' ELSE {cents_text('o_totalprice', '.')} END"),
        "emission_ges_5_usages_par_m2": "CASE WHEN o_orderkey % 7 = 2 THEN '' ELSE '28.5' END",
        "autre": "o_orderpriority",
    }),
    "sitadel_text": ("orders", {
        "ANNEE": "CASE WHEN o_orderkey % 17 = 0 THEN 'NC' ELSE substr(" + iso("o_orderdate") + ", 1, 4) END",
        "MOIS": "substr(" + iso("o_orderdate") + ", 6, 2)",
        "CODE_INSEE": "lpad(CAST(o_custkey % 99000 AS STRING), 5, '0')",
        "TYPE_LGT": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END",
        "LOG_AUT": "CASE WHEN o_orderkey % 7 = 1 THEN 'N/D' ELSE CAST(o_orderkey % 50 AS STRING) END",
        "LOG_COM": "concat(CAST(o_orderkey % 30 AS STRING), '.0')",
        "SDP_AUT": cents_text("o_totalprice", "."),
    }),
    "ecln_text": ("orders", {
        "TRIMESTRE": (
            "CASE WHEN o_orderkey % 17 = 0 THEN 'bad' WHEN o_orderkey % 17 = 1 THEN NULL ELSE "
            f"concat(substr({iso('o_orderdate')}, 1, 4), '-T', CAST(quarter(o_orderdate) AS STRING)) END"),
        "DEP_CODE": "CAST(o_custkey % 96 AS STRING)",
        "DEP_LIBELLE": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END",
        "TYPE_LGT": "o_orderstatus",
        "MEV": "CASE WHEN o_orderkey % 7 = 1 THEN '' ELSE CAST(o_orderkey % 90 AS STRING) END",
        "RESA": "CAST(o_orderkey % 40 AS STRING)",
        "PRIX_M2": "CASE WHEN o_orderkey % 7 = 2 THEN 'nan?' ELSE " + cents_text("o_totalprice", ".") + " END",
    }),
    "rpls_text": ("lineitem", {
        "DEPCOM": "CAST(l_suppkey AS STRING)",
        "DEP_CODE": "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 96 AS STRING) END",
        "REG_CODE": "CAST(l_suppkey % 13 AS STRING)",
        "FINAN_CODE": "l_returnflag",
        "CONSTRUCT": "CASE WHEN l_orderkey % 7 = 0 THEN 'NC' ELSE CAST(1900 + l_partkey % 120 AS STRING) END",
        "SURFHAB": cents_text("l_quantity", "."),
        "NBPIECE": "CAST(l_linenumber AS STRING)",
        "IGNORE": "l_linestatus",
    }),
    "insee_text": ("customer", {
        "code_commune": "lpad(CAST(c_custkey AS STRING), 9, '0')",
        "libelle_commune": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END",
        "annee": "CAST(2017 + c_custkey % 6 AS STRING)",
        "revenu_disponible_median": (
            f"CASE WHEN c_custkey % 7 = 1 THEN 'ND' ELSE {cents_text('abs(c_acctbal)')} END"),
        "taux_pauvrete": "CASE WHEN c_custkey % 7 = 2 THEN '' ELSE '10,2' END",
        "population_municipale": "CASE WHEN c_custkey % 7 = 3 THEN 'ND' ELSE CAST(c_custkey % 9000 AS STRING) END",
        "autre": "c_mktsegment",
    }),
    "macro_text": ("orders", {
        "date": (
            "CASE WHEN o_orderkey % 19 = 0 THEN 'pas de date' WHEN o_orderkey % 19 = 1 THEN "
            f"substr({iso('o_orderdate')}, 1, 7) ELSE {iso('o_orderdate')} END"),
        "taux_credit_immobilier": "CASE WHEN o_orderkey % 7 = 0 THEN 'ND' ELSE '3,75' END",
        "taux_inflation": cents_text("o_totalprice / 100000"),
        "inconnu": "o_orderstatus",
    }),
    "land_text": ("customer", {
        "ANNEE": "CASE WHEN c_custkey % 31 = 0 THEN 'x' ELSE CAST(2015 + c_custkey % 9 AS STRING) END",
        "ZONE_CODE": "CAST(c_custkey AS STRING)",
        "ZONE_LIBELLE": "c_mktsegment",
        "NB_TERRAINS": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey % 300 AS STRING) END",
        "PTM2_MOY": cents_text("abs(c_acctbal)", "."),
        "AUTRE": "c_name",
    }),
    "houses_text": ("supplier", {
        "ANNEE": "CAST(2015 + s_suppkey % 9 AS STRING)",
        "ZONE_CODE": "CAST(s_suppkey AS STRING)",
        "ZONE_LIBELLE": "CASE WHEN s_suppkey % 3 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END",
        "NB_MAISONS": "CAST(s_suppkey % 300 AS STRING)",
        "PM_MOY": cents_text("abs(s_acctbal)", "."),
    }),
}


def text_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    base, columns = TEXTS[name]
    return table(spark, sf, base).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


TEXT_BLOCKS = {
    name: "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {base}"
    for name, (base, columns) in TEXTS.items()
}
