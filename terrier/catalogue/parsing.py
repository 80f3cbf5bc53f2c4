"""Parsing, filters, deduplication, staging of pages and joins."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from terrier.catalogue import roles
from terrier.catalogue.marts import Warehouse
from terrier.catalogue.registry import query
from terrier.catalogue.roles import table
from terrier.catalogue.sql import compose as _compose
from terrier.catalogue.texts import NBSP, TEXT_BLOCKS, text_table
from terrier.functions import text as tx
from terrier.operators import rows
from terrier.operators.dedup import dedup_latest
from terrier.operators.joins import left_enrich
from terrier.plans.staging import stg_eptb
from terrier.plans.warehouse import fct_prix_terrain
from terrier.session import fresh_path
from terrier.sources import parsers, schemas

compose = partial(_compose, extra=TEXT_BLOCKS)


def number(c: str, drop: str = "", comma: bool = False) -> str:
    if comma:
        c = f"replace({c}, ',', '.')"
    for blank in drop:
        c = f"replace({c}, '{blank}', '')"
    return f"TRY_CAST({c} AS DOUBLE)"


def whole(c: str) -> str:
    return f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INTEGER)"


# --- projections ---------------------------------------------------------------------

@query("P01_project_known", "SELECT o_orderkey, o_totalprice FROM orders")
def project_known(spark, sf):
    return rows.project_known(table(spark, sf, "orders"), ["o_orderkey", "absent", "o_totalprice"])


@query("P02_rename_to_schema", "SELECT o_orderkey AS id, o_orderdate::DATE AS jour FROM "
       "(SELECT o_orderkey, o_orderdate FROM orders)")
def rename(spark, sf):
    df = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return rows.rename_to_schema(df, {"o_orderkey": "id", "o_orderdate": "jour", "absent": "x"})


@query("P03_to_date_or_null", compose("""
SELECT "date" AS texte, coalesce(TRY_CAST(CASE WHEN length("date") = 10 THEN "date" END AS DATE),
  try_strptime("date", '%Y-%m')::DATE) AS jour, count(*) AS n FROM macro_text GROUP BY ALL"""))
def to_date(spark, sf):
    texts = text_table(spark, sf, "macro_text")
    day = tx.to_date_or_null("date", "yyyy-MM")
    return texts.groupBy(F.col("date").alias("texte"), day.alias("jour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("P04_fr_number", compose(
    f"SELECT id_mutation, valeur_fonciere AS texte, "
    f"{number('valeur_fonciere', ' ' + NBSP, True)} AS valeur FROM dvf_text"))
def fr_number(spark, sf):
    return text_table(spark, sf, "dvf_text").select(
        "id_mutation", F.col("valeur_fonciere").alias("texte"),
        tx.fr_number("valeur_fonciere").alias("valeur"))


@query("P05_comma_number", compose(
    f"SELECT code_commune, {number('revenu_disponible_median', '', True)} AS revenu, "
    f"{number('taux_pauvrete', '', True)} AS taux FROM insee_text"))
def comma_number(spark, sf):
    return text_table(spark, sf, "insee_text").select(
        "code_commune", tx.comma_number("revenu_disponible_median").alias("revenu"),
        tx.comma_number("taux_pauvrete").alias("taux"))


@query("P06_to_double_or_null", compose(
    f"SELECT numero_dpe, {number('conso_5_usages_par_m2_ep')} AS conso FROM dpe_text"))
def to_double(spark, sf):
    return text_table(spark, sf, "dpe_text").select(
        "numero_dpe", tx.to_double_or_null("conso_5_usages_par_m2_ep").alias("conso"))


@query("P07_to_int_or_null", compose(
    f"SELECT id_mutation, nombre_pieces_principales AS texte, "
    f"{whole('nombre_pieces_principales')} AS pieces FROM dvf_text"))
def to_int(spark, sf):
    return text_table(spark, sf, "dvf_text").select(
        "id_mutation", F.col("nombre_pieces_principales").alias("texte"),
        tx.to_int_or_null("nombre_pieces_principales").alias("pieces"))


@query("P08_blank_null", compose(
    "SELECT numero_dpe, coalesce(etiquette_dpe, '') AS etiquette FROM dpe_text"))
def blank_null(spark, sf):
    return text_table(spark, sf, "dpe_text").select(
        "numero_dpe", tx.blank_null("etiquette_dpe").alias("etiquette"))


@query("P09_null_blank", compose(
    "SELECT numero_dpe, nullif(etiquette_dpe, '') AS etiquette FROM raw_dpe"))
def null_blank(spark, sf):
    return roles.raw_dpe(spark, sf).select(
        "numero_dpe", tx.null_blank("etiquette_dpe").alias("etiquette"))


@query("P10_require_key", compose(
    "SELECT numero_dpe, etiquette_dpe FROM raw_dpe WHERE etiquette_dpe <> ''"))
def require_key(spark, sf):
    return rows.require_key(
        roles.raw_dpe(spark, sf).select("numero_dpe", "etiquette_dpe"), "etiquette_dpe")


@query("P11_add_year_month", "SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS jour, "
       "year(l_shipdate)::INTEGER AS annee, month(l_shipdate)::INTEGER AS mois FROM lineitem")
def add_year_month(spark, sf):
    day = F.to_date("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", day.alias("jour"), F.year(day).alias("annee"),
        F.month(day).alias("mois"))


@query("P12_dept_from_commune", compose("""
SELECT code_insee_ban AS commune, CASE WHEN left(code_insee_ban, 2) IN ('97', '98')
  THEN left(code_insee_ban, 3) ELSE left(code_insee_ban, 2) END AS dept, count(*) AS n
FROM dpe_text GROUP BY ALL"""))
def dept(spark, sf):
    return text_table(spark, sf, "dpe_text").groupBy(
        F.col("code_insee_ban").alias("commune"),
        tx.dept_from_commune("code_insee_ban").alias("dept"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("P13_split_quarter", compose(r"""
SELECT "TRIMESTRE" AS texte,
  TRY_CAST(regexp_extract("TRIMESTRE", '^(\d+)-T(\d+)$', 1) AS INTEGER) AS annee,
  TRY_CAST(regexp_extract("TRIMESTRE", '^(\d+)-T(\d+)$', 2) AS INTEGER) AS trimestre,
  count(*) AS n FROM ecln_text GROUP BY ALL"""))
def split_quarter(spark, sf):
    year, quarter = tx.split_quarter("TRIMESTRE")
    return text_table(spark, sf, "ecln_text").groupBy(
        F.col("TRIMESTRE").alias("texte"), year.alias("annee"), quarter.alias("trimestre")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("P14_add_constant", compose('SELECT "DEPCOM" AS code, 2024 AS annee FROM rpls_text'))
def add_constant(spark, sf):
    return text_table(spark, sf, "rpls_text").select(
        F.col("DEPCOM").alias("code"), F.lit(parsers.vintage_year("2024-01")).alias("annee"))


@query("P15_drop_null", compose(
    'SELECT numero_dpe, etiquette_dpe FROM dpe_text WHERE etiquette_dpe IS NOT NULL'))
def drop_null(spark, sf):
    return rows.drop_null(
        text_table(spark, sf, "dpe_text").select("numero_dpe", "etiquette_dpe"), ["etiquette_dpe"])


@query("P16_positive_filter", compose("""
SELECT id_mutation, id_parcelle, valeur_fonciere FROM stg_dvf WHERE valeur_fonciere > 0
  AND surface_reelle_bati > 0 AND type_local IS NOT NULL AND valeur_fonciere > 500
  AND valeur_fonciere < 30000"""))
def positive_filter(spark, sf):
    df = rows.positive_filter(
        Warehouse(spark, sf).stg("dvf"), ["valeur_fonciere", "surface_reelle_bati"], ["type_local"])
    return rows.open_range(df, "valeur_fonciere", 500, 30000).select(
        "id_mutation", "id_parcelle", "valeur_fonciere")


@query("P17_category_filter", compose(
    "SELECT annee, mois, code_commune, nb_logements_autorises FROM stg_sitadel "
    "WHERE type_logement = 'Tous Logements'"))
def category_filter(spark, sf):
    return rows.category_filter(
        Warehouse(spark, sf).stg("sitadel"), "type_logement", "Tous Logements"
    ).select("annee", "mois", "code_commune", "nb_logements_autorises")


@query("P18_valid_period", compose(
    "SELECT annee, mois, count(*) AS n FROM (SELECT year(l_shipdate)::INTEGER AS annee, "
    "(l_linenumber * 2)::INTEGER AS mois FROM lineitem) WHERE mois BETWEEN 1 AND 12 "
    "AND annee > 2000 GROUP BY ALL"))
def valid_period(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("annee"), (F.col("l_linenumber") * 2).alias("mois"))
    return rows.valid_period(df).groupBy("annee", "mois").agg(F.count(F.lit(1)).alias("n"))


_NULLABLE = ["conso", "ges", "etiquette"]


@query("P19_max_null_share", compose(f"""
SELECT * FROM (SELECT numero_dpe, {number('conso_5_usages_par_m2_ep')} AS conso,
  {number('emission_ges_5_usages_par_m2')} AS ges, etiquette_dpe AS etiquette,
  TRY_CAST(code_insee_ban AS INTEGER) AS code FROM dpe_text)
WHERE ((conso IS NULL)::INTEGER + (ges IS NULL)::INTEGER + (etiquette IS NULL)::INTEGER
  + (code IS NULL)::INTEGER) / 4::DOUBLE < 0.5"""))
def max_null_share(spark, sf):
    df = text_table(spark, sf, "dpe_text").select(
        "numero_dpe", tx.to_double_or_null("conso_5_usages_par_m2_ep").alias("conso"),
        tx.to_double_or_null("emission_ges_5_usages_par_m2").alias("ges"),
        F.col("etiquette_dpe").alias("etiquette"),
        F.col("code_insee_ban").try_cast("int").alias("code"))
    return rows.max_null_share(df, [*_NULLABLE, "code"], 0.5)


@query("P20_min_group_size",
       "SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) >= 200")
def min_group_size(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))
    return rows.min_group_size(counted, "n", 200)


# --- deduplication and staging ---------------------------------------------------------

_TIES = ["l_partkey", "l_suppkey", "l_extendedprice"]


@query("T01_dedup_latest", """
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_extendedprice DESC NULLS LAST) = 1""")
def dedup(spark, sf):
    return dedup_latest(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", _TIES)


@query("W07_row_number_dedup", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  max(o_orderdate)::DATE AS jour FROM orders GROUP BY 1""")
def last_order(spark, sf):
    return dedup_latest(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]
    ).select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("jour"))


def _eptb(spark, sf):
    return parsers.parse_eptb(*roles.land_and_houses(spark, sf)).withColumn(
        "_loaded_at", F.make_date(F.col("annee"), F.lit(1), F.lit(1)))


@query("T06_stg_eptb", compose("SELECT * FROM stg_eptb"))
def stg_eptb_query(spark, sf):
    return stg_eptb(_eptb(spark, sf).withColumns({
        c: F.lit(None).cast("double") for c in ("prix_terrain_m2_med", "prix_maison_m2_med")}))


@query("A17_fct_prix_terrain", compose("SELECT * FROM stg_eptb"))
def fct_prix_terrain_query(spark, sf):
    return fct_prix_terrain(stg_eptb_query(spark, sf))


# --- whole parsers ------------------------------------------------------------------------

_DAY = "TRY_CAST(CASE WHEN length({c}) = 10 THEN {c} END AS DATE)"


@query("T08_parse_dvf", compose(f"""
SELECT * REPLACE (d AS date_mutation) FROM (SELECT
  id_mutation, {_DAY.format(c='date_mutation')} AS d, NULL::DATE AS date_mutation,
  year({_DAY.format(c='date_mutation')})::INTEGER AS annee,
  coalesce(nature_mutation, '') AS nature_mutation,
  {number('valeur_fonciere', ' ' + NBSP, True)} AS valeur_fonciere, code_commune, id_parcelle,
  coalesce(type_local, '') AS type_local, {number('surface_reelle_bati')} AS surface_reelle_bati,
  {whole('nombre_pieces_principales')} AS nombre_pieces_principales FROM dvf_text)
""").replace("SELECT * REPLACE (d AS date_mutation)", "SELECT * EXCLUDE (d) REPLACE (d AS date_mutation)"))
def parse_dvf(spark, sf):
    return parsers.parse_dvf(text_table(spark, sf, "dvf_text"))


@query("T08_parse_dpe", compose(f"""
SELECT numero_dpe, {_DAY.format(c='date_etablissement_dpe')} AS date_etablissement_dpe,
  year({_DAY.format(c='date_etablissement_dpe')})::INTEGER AS annee,
  coalesce(code_insee_ban, '') AS code_commune,
  CASE WHEN left(coalesce(code_insee_ban, ''), 2) IN ('97', '98') THEN left(code_insee_ban, 3)
       ELSE left(coalesce(code_insee_ban, ''), 2) END AS code_departement,
  coalesce(etiquette_dpe, '') AS etiquette_dpe,
  {number('conso_5_usages_par_m2_ep')} AS consommation_energie_primaire,
  {number('emission_ges_5_usages_par_m2')} AS emission_ges FROM dpe_text"""))
def parse_dpe(spark, sf):
    return parsers.parse_dpe(text_table(spark, sf, "dpe_text"))


@query("T08_parse_sitadel", compose(f"""
SELECT * FROM (SELECT {whole('"ANNEE"')} AS annee, {whole('"MOIS"')} AS mois,
  "CODE_INSEE" AS code_commune, CASE WHEN left("CODE_INSEE", 2) IN ('97', '98')
  THEN left("CODE_INSEE", 3) ELSE left("CODE_INSEE", 2) END AS code_departement,
  coalesce("TYPE_LGT", '') AS type_logement, {whole('"LOG_AUT"')} AS nb_logements_autorises,
  {whole('"LOG_COM"')} AS nb_logements_commences, {number('"SDP_AUT"')} AS surface_autorisee
  FROM sitadel_text) WHERE annee > 1998 OR (annee = 1998 AND mois > 3)"""))
def parse_sitadel(spark, sf):
    return parsers.parse_sitadel(text_table(spark, sf, "sitadel_text"), (1998, 3))


@query("T08_parse_ecln", compose(rf"""
SELECT TRY_CAST(regexp_extract("TRIMESTRE", '^(\d+)-T(\d+)$', 1) AS INTEGER) AS annee,
  TRY_CAST(regexp_extract("TRIMESTRE", '^(\d+)-T(\d+)$', 2) AS INTEGER) AS trimestre,
  "DEP_CODE" AS code_departement, coalesce("DEP_LIBELLE", '') AS libelle_departement,
  "TYPE_LGT" AS type_logement, {whole('"MEV"')} AS nb_mises_en_vente,
  {whole('"RESA"')} AS nb_reservations, {number('"PRIX_M2"')} AS prix_m2
FROM ecln_text WHERE "TRIMESTRE" > '1998-T2'"""))
def parse_ecln(spark, sf):
    return parsers.parse_ecln(text_table(spark, sf, "ecln_text"), "1998-T2")


@query("T08_parse_rpls", compose(f"""
SELECT 2024 AS annee, "DEPCOM" AS code_commune, coalesce("DEP_CODE", '') AS code_departement,
  "REG_CODE" AS code_region, "FINAN_CODE" AS financement,
  {whole('"CONSTRUCT"')} AS annee_construction, {number('"SURFHAB"')} AS surface,
  {whole('"NBPIECE"')} AS nb_pieces FROM rpls_text"""))
def parse_rpls(spark, sf):
    return parsers.parse_rpls(text_table(spark, sf, "rpls_text"), parsers.vintage_year("2024-01"))


@query("T08_parse_insee", compose(f"""
SELECT code_commune, coalesce(libelle_commune, '') AS libelle_commune, {whole('annee')} AS annee,
  {number('revenu_disponible_median', '', True)} AS revenu_disponible_median,
  {number('taux_pauvrete', '', True)} AS taux_pauvrete,
  {whole('population_municipale')} AS population_municipale FROM insee_text"""))
def parse_insee(spark, sf):
    return parsers.parse_insee(text_table(spark, sf, "insee_text"))


@query("T08_parse_macro", compose(f"""
SELECT d AS "date", year(d)::INTEGER AS annee, month(d)::INTEGER AS mois, taux_credit_immobilier,
  taux_inflation FROM (SELECT coalesce({_DAY.format(c='"date"')},
    try_strptime("date", '%Y-%m')::DATE) AS d,
  {number('taux_credit_immobilier', '', True)} AS taux_credit_immobilier,
  {number('taux_inflation', '', True)} AS taux_inflation FROM macro_text)
WHERE d > DATE '1998-03-01'"""))
def parse_macro(spark, sf):
    return parsers.parse_macro(text_table(spark, sf, "macro_text"), "1998-03")


_ZONE = '"ANNEE", "ZONE_CODE", "ZONE_LIBELLE"'


@query("T08_parse_eptb", compose(f"""
SELECT {whole('"ANNEE"')} AS annee, coalesce("ZONE_CODE", '') AS zone_code,
  coalesce("ZONE_LIBELLE", '') AS zone_libelle, {whole('"NB_TERRAINS"')} AS nb_terrains,
  {number('"PTM2_MOY"')} AS prix_terrain_m2_moy, {whole('"NB_MAISONS"')} AS nb_maisons,
  {number('"PM_MOY"')} AS prix_maison_total
FROM land_text FULL JOIN houses_text USING ({_ZONE})"""))
def parse_eptb(spark, sf):
    return parsers.parse_eptb(
        text_table(spark, sf, "land_text"), text_table(spark, sf, "houses_text"))


# --- pages and joins ---------------------------------------------------------------------

@query("S09_union_pages", """
SELECT o_orderkey AS id, o_totalprice AS valeur, NULL::INTEGER AS ligne FROM orders
UNION ALL SELECT l_orderkey, NULL, l_linenumber FROM lineitem""")
def union_pages(spark, sf):
    return rows.union_pages([
        table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("valeur")),
        table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("ligne")),
    ])


@query("S12_scan_source", compose(
    "SELECT id_mutation, annee, valeur_fonciere FROM raw_dvf"))
def scan_source(spark, sf):
    path = fresh_path(spark, "raw_dvf")
    schemas.conform(roles.raw_dvf(spark, sf), schemas.TABLES["raw_dvf"]).write.parquet(path)
    return schemas.scan_source(spark, "raw_dvf", path).select(
        "id_mutation", "annee", "valeur_fonciere")


@query("J01_full_outer_join", compose("SELECT * FROM raw_eptb_").replace(
    "SELECT * FROM raw_eptb_", "SELECT * EXCLUDE (prix_terrain_m2_med, prix_maison_m2_med) FROM raw_eptb_"))
def full_outer(spark, sf):
    return _eptb(spark, sf).drop("_loaded_at")


@query("J02_left_join_dimension", """
SELECT c_custkey, n_name AS pays, coalesce(derniere, '') AS derniere_priorite FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS derniere FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def left_dimension(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("pays"))
    last = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.max("o_orderpriority").alias("derniere_priorite"))
    named = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(
        nation, "c_nationkey", "left").drop("c_nationkey")
    return left_enrich(named, last, ["c_custkey"], {"derniere_priorite": ""})


@query("J03_left_enrich", compose("""
SELECT id_mutation, id_parcelle, type_local, date_mutation, valeur_fonciere, prix_m2,
  nb_dpe_total, pct_passoires_thermiques, conso_ep_moy FROM fct_transactions_enriched"""))
def left_enrich_query(spark, sf):
    w = Warehouse(spark, sf)
    spine = w.transactions.select(
        "annee", "code_commune", "id_mutation", "id_parcelle", "type_local", "date_mutation",
        "valeur_fonciere", "prix_m2")
    right = w.dpe.select(
        "annee", "code_commune", "nb_dpe_total", "pct_passoires_thermiques", "conso_ep_moy")
    joined = left_enrich(
        spine, right, ["annee", "code_commune"],
        {"nb_dpe_total": 0, "pct_passoires_thermiques": 0.0}, salts=4)
    return joined.drop("annee", "code_commune")


@query("J04_left_join_spine", compose("""
SELECT annee, code_departement, n, stock_moy, nb_autorises FROM (
  SELECT annee, code_departement, count(*) AS n FROM fct_transactions GROUP BY ALL)
LEFT JOIN int_ecln_dept_annee USING (annee, code_departement)
LEFT JOIN permits_dept USING (annee, code_departement)"""))
def left_spine(spark, sf):
    w = Warehouse(spark, sf)
    keys = ["annee", "code_departement"]
    spine = w.transactions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    permits = w.construction.groupBy(*keys).agg(F.sum("nb_autorises").alias("nb_autorises"))
    return left_enrich(
        left_enrich(spine, w.ecln_year.select(*keys, "stock_moy"), keys), permits, keys)
