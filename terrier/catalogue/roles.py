"""Raw tables of the warehouse derived from the star schema, in Spark and in SQL.

Both sides state the same mapping, so every plan can run on whole tables and be
compared with an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrier.functions.numeric import mean

NO_LABEL_STATUS = "P"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once a process."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _places(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("_cust"),
        F.col("c_custkey").cast("string").alias("code_commune"),
        F.col("c_name").alias("nom_commune"),
        F.col("n_nationkey").cast("string").alias("code_departement"),
        F.col("n_name").alias("libelle_departement"),
        F.col("n_regionkey").cast("string").alias("code_region"),
        F.col("c_mktsegment").alias("segment"),
    )


def _orders_placed(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    places = _places(spark, sf)
    return orders.join(places, orders.o_custkey == places["_cust"])


#: Columns of the placed items that only the lots read.
LOT_COLUMNS = (
    "l_orderkey", "l_extendedprice", "l_discount", "l_tax", "nom_commune", "segment")


def placed_items(spark: SparkSession, sf: str, lots: bool = True) -> DataFrame:
    """Line items with their order and place: two large sides, so a merge join.

    Without ``lots`` only the columns that permits and social housing read.
    """
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    placed = _orders_placed(spark, sf).select(
        "o_orderkey", "code_commune", "nom_commune", "code_departement", "code_region", "segment",
    )
    joined = items.hint("merge").join(placed, items.l_orderkey == placed.o_orderkey)
    joined = joined.drop("o_orderkey", *(() if lots else LOT_COLUMNS))
    return joined.withColumn("annee", F.year("l_shipdate"))


def raw_dvf(
    spark: SparkSession, sf: str, placed: DataFrame | None = None
) -> DataFrame:
    """Lots: line items placed in the customer's commune."""
    kind = (
        F.when(F.col("l_returnflag") == "A", "Appartement")
        .when(F.col("l_returnflag") == "R", "Maison")
        .when(F.col("l_linestatus") == "F", "Dépendance")
        .otherwise("")
    )
    items = placed_items(spark, sf) if placed is None else placed
    return items.select(
        F.col("l_orderkey").cast("string").alias("id_mutation"),
        F.to_date("l_shipdate").alias("date_mutation"),
        "annee",
        F.lit("Vente").alias("nature_mutation"),
        F.col("l_extendedprice").alias("valeur_fonciere"),
        F.col("l_linenumber").cast("string").alias("adresse_numero"),
        F.col("segment").alias("adresse_nom_voie"),
        F.concat("code_departement", F.lit("000")).alias("code_postal"),
        "code_commune", "nom_commune", "code_departement",
        F.col("l_linenumber").cast("string").alias("id_parcelle"),
        kind.alias("type_local"),
        F.col("l_quantity").alias("surface_reelle_bati"),
        F.col("l_linenumber").alias("nombre_pieces_principales"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 10).alias("surface_terrain"),
        (F.lit(45.0) + F.col("l_tax")).alias("latitude"),
        (F.lit(2.0) + F.col("l_discount")).alias("longitude"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


RAW_DVF = """
SELECT l_orderkey::VARCHAR AS id_mutation, l_shipdate::DATE AS date_mutation,
  year(l_shipdate)::INTEGER AS annee, 'Vente' AS nature_mutation,
  l_extendedprice AS valeur_fonciere, l_linenumber::VARCHAR AS adresse_numero,
  c_mktsegment AS adresse_nom_voie, n_nationkey::VARCHAR || '000' AS code_postal,
  c_custkey::VARCHAR AS code_commune, c_name AS nom_commune,
  n_nationkey::VARCHAR AS code_departement, l_linenumber::VARCHAR AS id_parcelle,
  CASE WHEN l_returnflag = 'A' THEN 'Appartement' WHEN l_returnflag = 'R' THEN 'Maison'
       WHEN l_linestatus = 'F' THEN 'Dépendance' ELSE '' END AS type_local,
  l_quantity AS surface_reelle_bati, l_linenumber AS nombre_pieces_principales,
  CASE WHEN l_returnflag = 'R' THEN l_quantity * 10 END AS surface_terrain,
  45::DOUBLE + l_tax AS latitude, 2::DOUBLE + l_discount AS longitude,
  l_shipdate AS _loaded_at, n_regionkey::VARCHAR AS code_region
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def raw_dpe(spark: SparkSession, sf: str) -> DataFrame:
    """Certificates: orders, the priority as label."""
    placed = _orders_placed(spark, sf)
    rank = F.substring("o_orderpriority", 1, 1)
    silent = (F.col("o_orderstatus") == NO_LABEL_STATUS) & (rank == "3")
    flat = (F.col("o_orderstatus") == NO_LABEL_STATUS) & (rank == "2")
    label = F.when(silent, "").otherwise(F.translate(rank, "12345", "ACEFG"))
    return placed.select(
        F.col("o_orderkey").cast("string").alias("numero_dpe"),
        F.to_date("o_orderdate").alias("date_etablissement_dpe"),
        F.year("o_orderdate").alias("annee"),
        "code_commune", "code_departement",
        label.alias("etiquette_dpe"),
        F.col("o_totalprice").alias("consommation_energie_primaire"),
        (F.col("o_totalprice") * 0.5).alias("consommation_energie_finale"),
        F.when(~(F.col("o_orderstatus") == "O"), F.col("o_totalprice") * 0.25).alias("emission_ges"),
        F.when(silent, "").otherwise(F.col("segment")).alias("type_energie_principale_chauffage"),
        F.col("o_orderstatus").alias("type_installation_chauffage"),
        F.when(flat, 0.0).otherwise(F.col("o_totalprice") * 0.125)
        .alias("surface_habitable_logement"),
        F.lit("").alias("periode_construction"),
        F.lit("maison").alias("type_batiment"),
        F.col("o_orderdate").alias("_loaded_at"),
    )


RAW_DPE = """
SELECT o_orderkey::VARCHAR AS numero_dpe, o_orderdate::DATE AS date_etablissement_dpe,
  year(o_orderdate)::INTEGER AS annee, c_custkey::VARCHAR AS code_commune,
  c_nationkey::VARCHAR AS code_departement,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '3%' THEN ''
       ELSE translate(substr(o_orderpriority, 1, 1), '12345', 'ACEFG') END AS etiquette_dpe,
  o_totalprice AS consommation_energie_primaire,
  o_totalprice * 0.5::DOUBLE AS consommation_energie_finale,
  CASE WHEN o_orderstatus <> 'O' THEN o_totalprice * 0.25::DOUBLE END AS emission_ges,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '3%' THEN '' ELSE c_mktsegment END
    AS type_energie_principale_chauffage,
  o_orderstatus AS type_installation_chauffage,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '2%' THEN 0::DOUBLE
       ELSE o_totalprice * 0.125::DOUBLE END AS surface_habitable_logement,
  '' AS periode_construction, 'maison' AS type_batiment, o_orderdate AS _loaded_at
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def raw_sitadel(
    spark: SparkSession, sf: str, placed: DataFrame | None = None
) -> DataFrame:
    """Permits: lots by month and kind, plus the line that totals the kinds."""
    items = placed_items(spark, sf) if placed is None else placed
    kinds = (
        items
        .groupBy(
            "annee", F.month("l_shipdate").alias("mois"),
            "code_commune", "code_departement", F.col("l_returnflag").alias("type_logement"),
        )
        .agg(
            F.count(F.lit(1)).alias("aut"),
            F.count_if(F.col("l_linestatus") == "F").alias("com"),
            F.sum("l_quantity").alias("s_aut"),
            F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("s_com"),
        )
    )
    period = ["annee", "mois", "code_commune", "code_departement"]
    # A month of a commune has a few kinds: they stay beside their total, where they lie.
    measures = ["aut", "com", "s_aut", "s_com"]
    every = F.struct(F.lit("Tous Logements").alias("type_logement"), *[F.sum(c).alias(c) for c in measures])
    each = kinds.groupBy(*period).agg(
        F.concat(F.collect_list(F.struct("type_logement", *measures)), F.array(every)).alias("_kinds"))
    return each.select(*period, F.inline("_kinds")).select(
        *period, "type_logement",
        F.col("aut").cast("int").alias("nb_logements_autorises"),
        F.col("com").cast("int").alias("nb_logements_commences"),
        F.col("s_aut").alias("surface_autorisee"), F.col("s_com").alias("surface_commencee"),
        F.make_date("annee", "mois", F.lit(1)).cast("timestamp_ntz").alias("_loaded_at"),
    )


RAW_SITADEL = """
SELECT year(l_shipdate)::INTEGER AS annee, month(l_shipdate)::INTEGER AS mois,
  c_custkey::VARCHAR AS code_commune, c_nationkey::VARCHAR AS code_departement,
  CASE WHEN grouping(l_returnflag) = 1 THEN 'Tous Logements' ELSE l_returnflag END
    AS type_logement,
  count(*)::INTEGER AS nb_logements_autorises,
  (count(*) FILTER (l_linestatus = 'F'))::INTEGER AS nb_logements_commences,
  sum(l_quantity) AS surface_autorisee,
  sum(l_quantity) FILTER (l_linestatus = 'F') AS surface_commencee
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY GROUPING SETS (
  (year(l_shipdate), month(l_shipdate), c_custkey, c_nationkey, l_returnflag),
  (year(l_shipdate), month(l_shipdate), c_custkey, c_nationkey))
"""


def raw_ecln(spark: SparkSession, sf: str) -> DataFrame:
    """New-build sales: orders by department and quarter, in total and by segment."""
    period = ["annee", "trimestre", "code_departement", "libelle_departement"]
    # Every order counts for its segment and for the total, in one pass and one shuffle.
    placed = _orders_placed(spark, sf).select(
        F.year("o_orderdate").alias("annee"), F.quarter("o_orderdate").alias("trimestre"),
        "code_departement", "libelle_departement", "o_orderstatus", "o_orderdate",
        "o_totalprice", "segment",
        F.explode(F.array("segment", F.lit("Tous logements"))).alias("type_logement"),
    )
    measures = [
        F.count(F.lit(1)).cast("int").alias("nb_mises_en_vente"),
        F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("nb_reservations"),
        F.count_if(F.col("o_orderstatus") == "P").cast("int").alias("nb_annulations"),
        F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("stock"),
        mean(F.dayofmonth("o_orderdate"), 2).alias("delai_ecoulement"),
        mean("o_totalprice", 2).alias("prix_m2"),
        mean(F.when(F.col("segment") == "BUILDING", F.col("o_totalprice")), 2)
        .alias("prix_moyen_individuel"),
    ]
    return placed.groupBy(*period, "type_logement").agg(*measures).withColumn(
        "_loaded_at", F.make_date("annee", "trimestre", F.lit(1)).cast("timestamp_ntz")
    )


def _avg(expr: str, digits: int) -> str:
    return rnd(f"avg({expr})", digits)


def rnd(expr: str, digits: int) -> str:
    """SQL twin of ``settle``."""
    six = f"(round_even(({expr})::DOUBLE * 1000000::DOUBLE, 0) / 1000000::DOUBLE)"
    power = 10**digits
    return f"(round_even({six} * {power}::DOUBLE, 0) / {power}::DOUBLE)"


def rnd_once(expr: str, digits: int) -> str:
    """SQL twin of ``round_he``."""
    power = 10**digits
    return f"(round_even(({expr})::DOUBLE * {power}::DOUBLE, 0) / {power}::DOUBLE)"


def ratio(num: str, den: str, digits: int, scale: float = 1.0) -> str:
    """SQL twin of ``rate``."""
    return rnd(f"{scale}::DOUBLE * ({num})::DOUBLE / nullif(({den})::DOUBLE, 0)", digits)


def quantile(expr: str, q: float, digits: int) -> str:
    return rnd(f"quantile_cont({expr}, {q})", digits)


RAW_ECLN = f"""
SELECT year(o_orderdate)::INTEGER AS annee, quarter(o_orderdate)::INTEGER AS trimestre,
  c_nationkey::VARCHAR AS code_departement, n_name AS libelle_departement,
  CASE WHEN grouping(c_mktsegment) = 1 THEN 'Tous logements' ELSE c_mktsegment END
    AS type_logement,
  count(*)::INTEGER AS nb_mises_en_vente,
  (count(*) FILTER (o_orderstatus = 'F'))::INTEGER AS nb_reservations,
  (count(*) FILTER (o_orderstatus = 'P'))::INTEGER AS nb_annulations,
  (count(*) FILTER (o_orderstatus = 'O'))::INTEGER AS stock,
  {rnd("avg(day(o_orderdate))", 2)} AS delai_ecoulement,
  {rnd("avg(o_totalprice)", 2)} AS prix_m2,
  {rnd("avg(CASE WHEN c_mktsegment = 'BUILDING' THEN o_totalprice END)", 2)}
    AS prix_moyen_individuel
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY GROUPING SETS (
  (year(o_orderdate), quarter(o_orderdate), c_nationkey, n_name, c_mktsegment),
  (year(o_orderdate), quarter(o_orderdate), c_nationkey, n_name))
"""


def raw_rpls(
    spark: SparkSession, sf: str, placed: DataFrame | None = None
) -> DataFrame:
    """Social housing: line items by kind of part; many dwellings share one key."""
    part = table(spark, sf, "part")
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    items = placed_items(spark, sf) if placed is None else placed
    joined = items.join(part, F.col("l_partkey") == part.p_partkey)
    return joined.select(
        "annee", "code_commune", "code_departement", "code_region",
        F.when(F.col("p_type") == "ECONOMY", "PLAI").when(F.col("p_type") == "STANDARD", "PLUS")
        .when(F.col("p_type") == "PROMO", "PLS").otherwise(F.col("p_type")).alias("financement"),
        F.char(F.lit(65) + brand % 7).alias("classe_energie_dpe"),
        (F.lit(1950) + F.col("p_size")).alias("annee_construction"),
        F.col("l_quantity").alias("surface"),
        F.col("l_linenumber").alias("nb_pieces"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


RAW_RPLS = r"""
SELECT year(l_shipdate)::INTEGER AS annee, c_custkey::VARCHAR AS code_commune,
  n_nationkey::VARCHAR AS code_departement, n_regionkey::VARCHAR AS code_region,
  CASE p_type WHEN 'ECONOMY' THEN 'PLAI' WHEN 'STANDARD' THEN 'PLUS' WHEN 'PROMO' THEN 'PLS'
       ELSE p_type END AS financement,
  chr((65 + regexp_extract(p_brand, '(\d+)', 1)::INTEGER % 7)::INTEGER) AS classe_energie_dpe,
  1950 + p_size AS annee_construction, l_quantity AS surface, l_linenumber AS nb_pieces,
  l_shipdate AS _loaded_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def land_and_houses(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Land prices and house prices by year and zone, in source names."""
    lots = raw_dvf(spark, sf)
    keys = [F.col("annee").cast("string").alias("ANNEE"), F.col("code_commune").alias("ZONE_CODE"),
            F.col("nom_commune").alias("ZONE_LIBELLE")]
    ratio_m2 = F.col("valeur_fonciere") / F.col("surface_reelle_bati")

    def side(kind: str, count: str, price: str, surface: str, value: str) -> DataFrame:
        return lots.where(F.col("type_local") == kind).groupBy(*keys).agg(
            F.count(F.lit(1)).alias(count),
            mean(ratio_m2, 2).alias(price),
            mean("surface_reelle_bati", 2).alias(surface),
            mean("valeur_fonciere", 2).alias(value),
        )

    return (side("Appartement", "NB_TERRAINS", "PTM2_MOY", "SURFT_MOY", "PT_MOY"),
            side("Maison", "NB_MAISONS", "PMM2_MOY", "SURFM_MOY", "PM_MOY"))


def _side_sql(kind: str, count: str, price: str, surface: str, value: str) -> str:
    return f"""SELECT annee, code_commune AS zone_code, nom_commune AS zone_libelle,
      count(*)::INTEGER AS {count},
      {_avg("valeur_fonciere / surface_reelle_bati", 2)} AS {price},
      {_avg("surface_reelle_bati", 2)} AS {surface}, {_avg("valeur_fonciere", 2)} AS {value}
    FROM raw_dvf WHERE type_local = '{kind}' GROUP BY ALL"""


# reads the name raw_dvf, so it comes after it in a WITH list
RAW_EPTB = f"""
SELECT coalesce(t.annee, m.annee) AS annee, coalesce(t.zone_code, m.zone_code) AS zone_code,
  coalesce(t.zone_libelle, m.zone_libelle) AS zone_libelle,
  nb_terrains, prix_terrain_m2_moy, NULL::DOUBLE AS prix_terrain_m2_med, surface_terrain_moy,
  prix_terrain_total, nb_maisons, prix_maison_m2_moy, NULL::DOUBLE AS prix_maison_m2_med,
  surface_maison_moy, prix_maison_total
FROM ({_side_sql("Appartement", "nb_terrains", "prix_terrain_m2_moy", "surface_terrain_moy",
                 "prix_terrain_total")}) t
FULL JOIN ({_side_sql("Maison", "nb_maisons", "prix_maison_m2_moy", "surface_maison_moy",
                      "prix_maison_total")}) m
  ON t.annee = m.annee AND t.zone_code = m.zone_code AND t.zone_libelle = m.zone_libelle
"""
